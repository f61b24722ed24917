"""Queries registered with the driver: one per operator or pipeline.

Each takes ``(spark, sf_dir)``, builds its OMOP-shaped input from the
bundled tables (see ``sources.testdata``) and returns a DataFrame over the
whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from omoplate import catalogue
from omoplate.functions.text import normalize_text
from omoplate.operators import conform as cf
from omoplate.operators import intervals as iv
from omoplate.operators import quality as qa
from omoplate.operators import visits as vi
from omoplate.operators import vocab as vo
from omoplate.plans import condition_occurrence, drug_exposure, measurement, observation_period, visit_occurrence
from omoplate.plans import dimensions as dims
from omoplate.session import cut_lineage, ensure_checkpoint_dir, side_by_side
from omoplate.sources import delimited as dl
from omoplate.sources import testdata as td

N_DAYS = 90
IV_TIEBREAK = list(td.INTERVAL_TIEBREAK)
IV_OUT = ["person_id", "start_date", "end_date", "type_concept", "l_orderkey", "l_partkey", "l_suppkey"]

VISIT_RULES = [("duration_code", 9201, {"time_lims": [1, 3]}),
               ("single_code", 9202, {}),
               ("field_code", 9203, {"colname": "person_id", "colvalue": 7})]

VISIT_PARAMS = {
    "visit_concept_dict": {
        "views": [("duration_code", 9201, {"time_lims": [1, 3]}), ("single_code", 9202, {})],
        "shipments": [("single_code", 9203, {})],
    },
    "visit_concept_order": [9201, 9203, 9202],
    "remove_overlap": {"sorting_columns": ["person_id", "start_date", "end_date", "visit_concept_id"],
                       "ascending_order": [True, True, False, True]},
}


def q_observation_period(spark: SparkSession, sf: str, lines: DataFrame | None = None) -> DataFrame:
    return observation_period.build({"shipments": td.intervals(spark, sf, lines)}, N_DAYS)


def q_overlap_flag(spark: SparkSession, sf: str) -> DataFrame:
    out = iv.overlap_flag(td.intervals(spark, sf), tiebreak=IV_TIEBREAK)
    return out.select(*IV_OUT, "is_contained")


def q_remove_overlap(spark: SparkSession, sf: str) -> DataFrame:
    df = td.intervals(spark, sf)
    out = iv.remove_overlap(df, ["person_id", "start_date", "end_date", *IV_TIEBREAK],
                            [True, True, False, True, True, True, True])
    return out.select(*IV_OUT)


def q_group_dates(spark: SparkSession, sf: str) -> DataFrame:
    return iv.group_dates(td.intervals(spark, sf), N_DAYS)


def q_person_row_flags(spark: SparkSession, sf: str) -> DataFrame:
    out = iv.person_row_flags(td.intervals(spark, sf), tiebreak=IV_TIEBREAK)
    return out.select(*IV_OUT, "is_first", "is_last", "is_only")


def q_melt_start_end(spark: SparkSession, sf: str) -> DataFrame:
    return iv.melt_start_end(td.intervals(spark, sf))


def q_remove_end_date(spark: SparkSession, sf: str) -> DataFrame:
    return iv.remove_end_date(td.intervals(spark, sf)).select(*IV_OUT)


def q_visit_lookup(spark: SparkSession, sf: str) -> DataFrame:
    ev = td.clinical_events(spark, sf).select("event_id", "person_id", "start_date")
    return vi.link_visits(ev, ["person_id", "start_date", "event_id"], td.visits(spark, sf))


def q_visit_concept(spark: SparkSession, sf: str) -> DataFrame:
    out = vi.visit_concept_id(td.visit_intervals(spark, sf), VISIT_RULES)
    return out.select("visit_occurrence_id", "person_id", "visit_concept_id")


def q_visit_occurrence(spark: SparkSession, sf: str, lines: DataFrame | None = None) -> DataFrame:
    files = {"views": td.visit_intervals(spark, sf),
             "shipments": td.intervals(spark, sf, lines).withColumn("type_concept", F.lit(32810).cast("long"))}
    return visit_occurrence.build(files, VISIT_PARAMS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "observation_period": q_observation_period,
    "overlap_flag": q_overlap_flag,
    "remove_overlap": q_remove_overlap,
    "group_dates": q_group_dates,
    "person_row_flags": q_person_row_flags,
    "melt_start_end": q_melt_start_end,
    "remove_end_date": q_remove_end_date,
    "visit_lookup": q_visit_lookup,
    "visit_concept": q_visit_concept,
    "visit_occurrence": q_visit_occurrence,
}


# -- vocabulary -------------------------------------------------------------------


# brands 1-15 map by name, 16-20 by code, 21-25 are not configured
TARGET_VOCAB = {f"Brand#{i}": ("concept_name" if i <= 15 else "concept_code") for i in range(1, 21)}
FALLBACK_VOCABS = {"Brand#21": "concept_name", "Brand#22": "concept_code"}
OVERRIDES = {"red plate": 1001, "small widget": 1002, "C7": 1003}
MAP_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _mapped(spark: SparkSession, sf: str) -> DataFrame:
    df = vo.map_source_value(td.mapping_data(spark, sf), TARGET_VOCAB, td.concept(spark, sf))
    return vo.map_source_concept_id(df, td.concept_relationship(spark, sf))


def q_map_source_value(spark: SparkSession, sf: str) -> DataFrame:
    return vo.map_source_value(td.mapping_data(spark, sf), TARGET_VOCAB, td.concept(spark, sf))


def q_map_standard(spark: SparkSession, sf: str) -> DataFrame:
    return _mapped(spark, sf)


def q_fallback_mapping(spark: SparkSession, sf: str) -> DataFrame:
    out, still = vo.fallback_mapping(_mapped(spark, sf), td.concept(spark, sf), td.concept_relationship(spark, sf),
                                     FALLBACK_VOCABS, "source_value", "source_concept_id", "concept_id")
    return out.withColumn("still_unmapped", still)


def q_override_mappings(spark: SparkSession, sf: str) -> DataFrame:
    return vo.update_concept_mappings(_mapped(spark, sf), "source_value", "concept_id", OVERRIDES)


def q_unmapped_values(spark: SparkSession, sf: str) -> DataFrame:
    return vo.find_unmapped_values(_mapped(spark, sf), "source_value", "concept_id")


def q_unmapped_report(spark: SparkSession, sf: str) -> DataFrame:
    df = _mapped(spark, sf)
    values = vo.find_unmapped_values(df, "source_value", "concept_id")
    return vo.report_unmapped(df, values, "source_value", "source_concept_id", "concept_id", ["vocabulary_id"])


def q_unit_mapping(spark: SparkSession, sf: str) -> DataFrame:
    part = td.table(spark, sf, "part").select("p_partkey", "p_name")
    df = td.mapping_data(spark, sf).join(part, F.col("l_partkey") == part.p_partkey).select(
        *MAP_KEYS, F.col("p_name").alias("measurement_source_value"))
    df = vo.apply_value_lookup(df, td.unit_table(spark, sf), "measurement_source_value", "NombreConvCLC",
                               "UnidadConv", "unit_source_value")
    return vo.map_units(df, td.unit_concept(spark, sf))


def q_wide_relationship(spark: SparkSession, sf: str) -> DataFrame:
    c = td.concept(spark, sf).select("concept_id", "concept_name", "vocabulary_id", "standard_concept")
    return vo.wide_relationship(c, td.concept_relationship(spark, sf))


QUERIES.update({
    "map_source_value": q_map_source_value,
    "map_standard": q_map_standard,
    "fallback_mapping": q_fallback_mapping,
    "override_mappings": q_override_mappings,
    "unmapped_values": q_unmapped_values,
    "unmapped_report": q_unmapped_report,
    "unit_mapping": q_unit_mapping,
    "wide_relationship": q_wide_relationship,
})


# -- clinical event tables ---------------------------------------------------------


CONDITION_PARAMS = {"column_map": {"dx": {"source_value": "condition_source_value"}},
                    "vocabulary_config": {"dx": TARGET_VOCAB},
                    "fallback_vocabs": FALLBACK_VOCABS}
DRUG_PARAMS = {"column_map": {"rx": {"source_value": "drug_source_value"}},
               "vocabulary_config": {"rx": TARGET_VOCAB},
               "unmapped_drug": {"red plate": 99, "C8": 12}}
MEASUREMENT_PARAMS = {
    "column_map": {"values": {"source_value": "measurement_source_value"},
                   "tests": {"source_value": "measurement_source_value"}},
    "vocabulary_config": {"values": TARGET_VOCAB, "tests": TARGET_VOCAB},
    "value_map": {"values": "numeric", "tests": "concept"},
    "unmapped_measurement": {"hot ring": 198},
    "unmapped_unit": {"u3": 8003},
}


def _linked(spark: SparkSession, sf: str, records: DataFrame | None = None,
            visits: vi.ReadyVisits | None = None) -> tuple[DataFrame, DataFrame | vi.ReadyVisits]:
    """The records of an event table and the visits they are linked to; both may be there already."""
    return (td.clinical_records(spark, sf) if records is None else records,
            td.order_visits(spark, sf) if visits is None else visits)


def _measurement_files(spark: SparkSession, sf: str, rec: DataFrame) -> dict[str, DataFrame]:
    part = td.table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    values = rec.filter(F.col("l_linenumber") <= 4).withColumn("value_source_value",
                                                              F.col("l_quantity").cast("string"))
    tests = (rec.filter(F.col("l_linenumber") > 4).join(part, F.col("l_partkey") == part.p_partkey)
             .withColumns({"value_source_value": F.col("p_name"), "value_vocabulary_id": F.col("p_brand")})
             .drop("p_partkey", "p_name", "p_brand"))
    drop = ["l_linenumber", "l_quantity", "l_partkey"]
    return {"values": values.drop(*drop), "tests": tests.drop(*drop)}


def q_condition(spark: SparkSession, sf: str, records: DataFrame | None = None,
                visits: vi.ReadyVisits | None = None) -> DataFrame:
    rec, visits = _linked(spark, sf, records, visits)
    files = {"dx": rec.drop("l_linenumber", "l_quantity", "l_partkey")}
    out, _ = condition_occurrence.build(files, CONDITION_PARAMS, td.concept(spark, sf),
                                        td.concept_relationship(spark, sf), visits)
    return out


def q_drug(spark: SparkSession, sf: str, records: DataFrame | None = None,
           visits: vi.ReadyVisits | None = None) -> DataFrame:
    rec, visits = _linked(spark, sf, records, visits)
    files = {"rx": rec.drop("l_linenumber", "l_quantity", "l_partkey")}
    return drug_exposure.build(files, DRUG_PARAMS, td.concept(spark, sf), td.concept_relationship(spark, sf), visits)


def q_measurement(spark: SparkSession, sf: str, records: DataFrame | None = None,
                  visits: vi.ReadyVisits | None = None) -> DataFrame:
    rec, visits = _linked(spark, sf, records, visits)
    concept = td.concept(spark, sf).unionByName(td.unit_concept(spark, sf))
    return measurement.build(_measurement_files(spark, sf, rec), MEASUREMENT_PARAMS, concept,
                             td.concept_relationship(spark, sf), td.unit_table(spark, sf), visits)


QUERIES.update({"condition": q_condition, "drug": q_drug, "measurement": q_measurement})


# -- dimensions -------------------------------------------------------------------


LOCATION_PARAMS = {"column_name_map": {"addresses": {"loc_id": "location_id"}},
                   "constant_values": {"addresses": {"country_concept_id": 4330442, "country_source_value": "ES"}}}
PERSON_PARAMS = {
    "column_name_map": {"sociodemo": {"desc_sexo": "gender_source_value"}},
    "column_values_map": {"sociodemo": {"gender_source_value": {"Mujer": 8532, "Hombre": 8507}}},
    "constant_values": {"sociodemo": {"race_concept_id": 0, "ethnicity_concept_id": 0}},
    "source_to_location": {"sociodemo": {"c_nationkey": "zip"}},
}
PROVIDER_PARAMS = {
    "column_name_map": {"suppliers": {"s_name": "provider_name", "spec": "specialty_source_value",
                                      "sid": "provider_source_value"}},
    "column_values_map": {"suppliers": {"specialty_source_value": {
        "spec_0": 38004451, "spec_1": 38004477, "spec_2": 38003902, "spec_3": 38004455}}},
    "unmapped_specialty": {"spec_5": 38004446, "spec_6": 0},
}
COHORT_PARAMS = {"cohorts": {
    "building": {"cohort_definition_id": 1, "cohort_definition_name": "Building segment",
                 "subject_concept_id": 1147314, "definition_type_concept_id": 32882,
                 "cohort_start_date": "2017-01-01", "cohort_end_date": "2023-12-01"},
    "machinery": {"cohort_definition_id": 2, "cohort_definition_name": "Machinery segment",
                  "subject_concept_id": 1147314, "definition_type_concept_id": 32882,
                  "cohort_start_date": "2018-01-01", "cohort_end_date": "2023-12-01"},
    "no_file": {"cohort_definition_id": 3, "cohort_definition_name": "Skipped",
                "subject_concept_id": 1147314, "definition_type_concept_id": 32882,
                "cohort_start_date": "2018-01-01", "cohort_end_date": "2023-12-01"},
}}
CDM_SOURCE_FIELDS = {"cdm_source_name": "omoplate", "cdm_source_abbreviation": "omoplate", "cdm_holder": "Example holder",
                     "source_description": "OMOP instance built from the benchmark tables",
                     "cdm_etl_reference": "etl-7", "cdm_release_date": "2024-03-04", "cdm_version": "5.4",
                     "cdm_version_concept_id": 756265, "vocabulary_version": "vocabulary-3"}
STANDARDISE_PARAMS = {"person_columns": {"orders": "NUHSA"}, "date_columns": {"orders": ["fec_fin", "fec_ini"]},
                      "type_concept_mapping": {"orders": 32817}}


def q_location(spark: SparkSession, sf: str) -> DataFrame:
    return dims.location({"addresses": td.locations(spark, sf)}, LOCATION_PARAMS)


def q_person(spark: SparkSession, sf: str) -> DataFrame:
    return dims.person({"sociodemo": td.sociodemo(spark, sf)}, PERSON_PARAMS, q_location(spark, sf))


def q_provider(spark: SparkSession, sf: str) -> DataFrame:
    return dims.provider({"suppliers": td.suppliers(spark, sf)}, PROVIDER_PARAMS)


def q_death(spark: SparkSession, sf: str) -> DataFrame:
    return dims.death({"deaths": td.deaths(spark, sf)}, {})


def q_cohort(spark: SparkSession, sf: str) -> DataFrame:
    people = td.sociodemo(spark, sf)
    files = {"building": people.filter(F.col("c_mktsegment") == "BUILDING"),
             "machinery": people.filter(F.col("c_mktsegment") == "MACHINERY"), "no_file": None}
    cohort, _ = dims.cohort(spark, files, COHORT_PARAMS)
    return cohort


def q_cdm_source(spark: SparkSession, sf: str) -> DataFrame:
    latest = td.table(spark, sf, "orders").agg(F.max("o_orderdate"))
    return dims.cdm_source(spark, CDM_SOURCE_FIELDS, latest)


def q_standardise(spark: SparkSession, sf: str) -> DataFrame:
    return dims.standardise_files({"orders": td.raw_orders(spark, sf)}, STANDARDISE_PARAMS)["orders"]


QUERIES.update({"location": q_location, "person": q_person, "provider": q_provider, "death": q_death,
                "cohort": q_cohort, "cdm_source": q_cdm_source, "standardise": q_standardise})


# -- ingest, text, integrity checks ------------------------------------------------


READ_CANDIDATES = {"sep": [",", "|", ";"], "encoding": ["utf-8", "latin1"]}
DATE_FORMATS = ["%Y-%m-%d", "%d/%m/%Y"]


def q_csv_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Orders written as a raw ';'-separated extract (in the shared
    checkpoint folder), then probed and ingested: S2 -> S3 -> S4 -> S1."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ingest-{uuid.uuid4().hex}"
    o = td.table(spark, sf, "orders")
    raw = o.select(F.concat(F.lit("AN"), F.lpad(F.col("o_custkey").cast("string"), 10, "0")).alias("NUHSA"),
                   F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderstatus",
                   F.date_format("o_orderdate", "dd/MM/yyyy").alias("fec_pedido"), "o_orderpriority")
    raw.write.option("header", True).option("sep", ";").csv(folder)
    opts = dl.probe_read_options(spark, folder, READ_CANDIDATES, checks=[dl.check_id_column])
    head = dl.read_delimited(spark, folder, opts)
    chosen, _ = dl.probe_date_formats(head, dl.find_date_columns(head.columns), DATE_FORMATS)
    return dl.ingest_files(spark, {"orders": folder}, {"orders": {"read": opts, "dates": chosen}})["orders"]


def q_normalize_text(spark: SparkSession, sf: str) -> DataFrame:
    docs = td.table(spark, sf, "documents")
    return docs.select("doc_id", normalize_text("text").alias("text_normalized"))


def q_icd_expand(spark: SparkSession, sf: str) -> DataFrame:
    df = td.mapping_data(spark, sf).select(*MAP_KEYS, F.concat(F.lit("P"), (F.col("l_partkey") % 700)
                                                                 .cast("string")).alias("pathology_code"))
    return vo.icd_expand(df, "pathology_code", td.icd_crosswalk(spark, sf))


def q_pk_check(spark: SparkSession, sf: str) -> DataFrame:
    return qa.pk_violations(td.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_fk_check(spark: SparkSession, sf: str) -> DataFrame:
    t = lambda n: td.table(spark, sf, n)
    checks = [qa.fk_violations(t("lineitem"), "l_orderkey", t("orders"), "o_orderkey", "lineitem"),
              qa.fk_violations(t("lineitem"), "l_partkey", t("part"), "p_partkey", "lineitem"),
              qa.fk_violations(t("lineitem"), "l_suppkey", t("supplier"), "s_suppkey", "lineitem"),
              qa.fk_violations(t("orders"), "o_custkey", t("customer"), "c_custkey", "orders"),
              qa.fk_violations(t("events"), "user_id", t("customer"), "c_custkey", "events"),
              # every event that is no view dangles here
              qa.fk_violations(t("events"), "event_id", td.visits(spark, sf), "visit_occurrence_id", "events"),
              qa.fk_violations(q_person(spark, sf), "location_id", q_location(spark, sf), "location_id", "PERSON")]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def q_null_check(spark: SparkSession, sf: str) -> DataFrame:
    return qa.null_counts(td.table(spark, sf, "lineitem"))


def q_length_check(spark: SparkSession, sf: str) -> DataFrame:
    return qa.length_violations(td.table(spark, sf, "part"), {"p_name": 10, "p_type": 6, "p_brand": 7})


def q_date_rules(spark: SparkSession, sf: str) -> DataFrame:
    return qa.date_rules(td.clinical_records(spark, sf), q_person(spark, sf), q_death(spark, sf))


def q_key_check(spark: SparkSession, sf: str) -> DataFrame:
    return qa.key_check(q_provider(spark, sf), "provider_id")


QUERIES.update({"csv_ingest": q_csv_ingest, "normalize_text": q_normalize_text, "icd_expand": q_icd_expand,
                "pk_check": q_pk_check, "fk_check": q_fk_check, "null_check": q_null_check,
                "length_check": q_length_check, "date_rules": q_date_rules, "key_check": q_key_check})


def q_cdm_constraints(spark: SparkSession, sf: str) -> DataFrame:
    """Q1-Q5 over every table built here, two of the catalogue's others (S11) and the vocabulary."""
    # what several tables are made of is made once, and tables that do not need each other are built at a time
    lines = cut_lineage(td.shipped_lines(spark, sf))
    records, visits = side_by_side(spark, [lambda: cut_lineage(td.clinical_records(spark, sf, lines)),
                                           lambda: vi.ready_visits(td.order_visits(spark, sf))])
    tables = {"CONDITION_OCCURRENCE": lambda: q_condition(spark, sf, records, visits),
              "DRUG_EXPOSURE": lambda: q_drug(spark, sf, records, visits),
              "MEASUREMENT": lambda: q_measurement(spark, sf, records, visits),
              "OBSERVATION_PERIOD": lambda: q_observation_period(spark, sf, lines),
              "VISIT_OCCURRENCE": lambda: q_visit_occurrence(spark, sf, lines)}
    rest = {"PERSON": q_person, "LOCATION": q_location, "PROVIDER": q_provider, "DEATH": q_death,
            "CONCEPT": td.concept, "CONCEPT_RELATIONSHIP": td.concept_relationship, "VOCABULARY": td.vocabulary,
            "DOMAIN": td.domain, "CARE_SITE": q_care_site, "PROCEDURE_OCCURRENCE": q_procedure}
    tables |= {t: partial(make, spark, sf) for t, make in rest.items()}
    # a table is child and parent: build each once
    built = side_by_side(spark, [lambda make=make: cut_lineage(make()) for make in tables.values()])
    return qa.validate_cdm(dict(zip(tables, built)))


def q_care_site(spark: SparkSession, sf: str) -> DataFrame:
    return cf.format_table(td.care_sites(spark, sf), catalogue.schema("CARE_SITE"))


def q_procedure(spark: SparkSession, sf: str) -> DataFrame:
    """P2-P4 with a schema of the catalogue."""
    return cf.format_table(td.procedures(spark, sf), catalogue.schema("PROCEDURE_OCCURRENCE"))


QUERIES.update({"care_site": q_care_site, "procedure": q_procedure})
QUERIES["cdm_constraints"] = q_cdm_constraints


SHIPMENT_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def q_shipment_visit_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """J10 with a composite event key: every shipment against its
    customer's order visits."""
    li = td.table(spark, sf, "lineitem").select(*SHIPMENT_KEYS, "l_shipdate")
    od = td.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    ev = li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("o_custkey").cast("long").alias("person_id"), F.col("l_shipdate").alias("start_date"), *SHIPMENT_KEYS)
    return vi.link_visits(ev, ["person_id", "start_date", *SHIPMENT_KEYS], td.order_visits(spark, sf))


QUERIES["shipment_visit_lookup"] = q_shipment_visit_lookup


# -- operators that no table pipeline above uses --------------------------------------


LINE_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType(), False), T.StructField("line", T.LongType(), False),
    T.StructField("vocabulary_id", T.StringType(), False), T.StructField("quantity", T.DoubleType(), True),
    T.StructField("score", T.DoubleType(), False), T.StructField("note", T.StringType(), True)])


def q_conform_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Rename, set the vocabulary, fill, reorder and cast to a schema."""
    li = td.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    li = cf.rename_strict(li, {"l_orderkey": "order_id", "l_linenumber": "line", "l_quantity": "quantity"})
    return cf.format_table(cf.set_vocabulary(li, "LINES"), LINE_SCHEMA)


def q_transform_registry(spark: SparkSession, sf: str) -> DataFrame:
    """Transformations applied by name, one after the other."""
    return iv.apply_transformations(td.intervals(spark, sf), ["remove_end_date", "melt_start_end"])


def q_gender(spark: SparkSession, sf: str) -> DataFrame:
    """Gender concept from a code column."""
    c = td.table(spark, sf, "customer").select(
        "c_custkey", (F.col("c_nationkey") % 2).cast("long").alias("code"),
        F.when(F.col("c_nationkey") % 2 == 0, "even").otherwise("odd").alias("label"))
    return vo.transform_gender(c, "code", "label", {0: 8507, 1: 8532}).select(
        "c_custkey", F.col("gender_concept_id").cast("long").alias("gender_concept_id"),
        "gender_source_concept_id", "gender_source_value")


def q_provider_link(spark: SparkSession, sf: str) -> DataFrame:
    """Every line item's supplier as provider."""
    li = td.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").cast("string").alias("sid"))
    li = li.withColumn("sid", F.when(F.col("l_linenumber") < 7, F.col("sid")))
    return visit_occurrence.link_provider(li, q_provider(spark, sf), "sid", "provider_source_value")


def q_cohort_definition(spark: SparkSession, sf: str) -> DataFrame:
    """The definitions, each with the date of the last order of its members."""
    people = td.sociodemo(spark, sf)
    files = {"building": people.filter(F.col("c_mktsegment") == "BUILDING"),
             "machinery": people.filter(F.col("c_mktsegment") == "MACHINERY"), "no_file": None}
    cohort, definition = dims.cohort(spark, files, COHORT_PARAMS)
    sizes = cohort.groupBy("cohort_definition_id").agg(F.count(F.lit(1)).alias("members"))
    return definition.join(sizes, "cohort_definition_id").select(
        "cohort_definition_id", "cohort_definition_name", "definition_type_concept_id", "subject_concept_id", "members")


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q_unmapped_conditions(spark: SparkSession, sf: str) -> DataFrame:
    """T7's second output through S8: the report as CSV, read back."""
    files = {"dx": td.clinical_records(spark, sf).drop("l_linenumber", "l_quantity", "l_partkey")}
    _, report = condition_occurrence.build(files, CONDITION_PARAMS, td.concept(spark, sf),
                                           td.concept_relationship(spark, sf))
    folder = _folder(spark, "report")
    dl.write_report(report, folder)
    return dl.read_delimited(spark, folder).select(
        "condition_source_value", *(F.col(c).cast("long").alias(c) for c in ("condition_source_concept_id", "condition_concept_id")),
        "vocabulary_id", F.col("type_concept").cast("long").alias("type_concept"))


VOCABULARY_SCHEMA = "concept_id long, concept_name string, vocabulary_id string, concept_code string, valid_start_date date"


def q_vocabulary_load(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as a tab-separated vocabulary file with quotes in the names, read with its schema."""
    part = td.table(spark, sf, "part").select(
        F.col("p_partkey").cast("long").alias("concept_id"),
        F.concat(F.lit('5" '), "p_name", F.lit(' "x')).alias("concept_name"), F.col("p_brand").alias("vocabulary_id"),
        F.concat(F.lit("C"), F.col("p_partkey").cast("string")).alias("concept_code"), F.lit("19700101").alias("valid_start_date"))
    folder = _folder(spark, "vocabulary")
    part.write.option("sep", "\t").option("header", True).option("quote", "\u0008").csv(folder)
    return dl.read_vocabulary(spark, folder, T.StructType.fromDDL(VOCABULARY_SCHEMA))


def q_vocabulary_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as a vocabulary of two files, a customer being the repeated key; the last row of the last file wins."""
    orders, later = td.table(spark, sf, "orders"), 1_000_000_000
    columns = [F.lit("name").alias("concept_name"), F.lit("ORDERS").alias("vocabulary_id"),
               F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("concept_code"), F.lit("19700101").alias("valid_start_date")]
    parts = [(orders.orderBy("o_orderkey"), F.col("o_orderkey").cast("long")),
             (orders.filter("o_orderstatus = 'F'").orderBy(F.desc("o_orderkey")), F.col("o_orderkey").cast("long") + later)]
    folder = _folder(spark, "vocabulary")
    paths = [f"{folder}/{i}" for i in range(len(parts))]
    for (rows, concept_id), path in zip(parts, paths):
        rows.select(concept_id.alias("concept_id"), *columns).write.option("sep", "\t").option("header", True).csv(path)
    concept = dl.read_vocabulary(spark, paths, T.StructType.fromDDL(VOCABULARY_SCHEMA), order_column="place")
    found = vo.source_value_lookup(concept, {"ORDERS": "concept_code"}, "place")
    return found.select(F.col("_key").alias("concept_code"), F.col("_cid").alias("concept_id"))


def q_parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The line items written and read back."""
    folder = _folder(spark, "table")
    dl.write_parquet(td.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"), folder)
    return spark.read.parquet(folder)


def q_coerced_dates(spark: SparkSession, sf: str) -> DataFrame:
    """D2 and the automatic retry: dates of which every tenth order's does not parse."""
    o = td.table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 10 == 0, F.lit("unknown")).otherwise(
        F.date_format("o_orderdate", "dd/MM/yyyy")).alias("fec"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("fin"))
    return dl.parse_dates(o, dl.settle_dates(o, {"fec": "%d/%m/%Y", "fin": "%Y-%m-%d"}))


def q_csv_ingest_hard(spark: SparkSession, sf: str) -> DataFrame:
    """S1 on whole document texts: separators, doubled quotes and line breaks inside quoted fields, in files of
    several splits."""
    folder = _folder(spark, "texts")
    docs = td.table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.concat(F.lit('"; '), F.regexp_replace("text", r"\.", '."";'), F.lit('"')).alias("text"))
    docs.write.options(header=True, sep=";", quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False,
                       ignoreTrailingWhiteSpace=False).csv(folder)
    return dl.read_delimited(spark, folder, {"sep": ";"})


def q_csv_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """What a read leaves out. Orders as raw text with quoted line breaks; some have a field too many, some an
    empty one and another behind it."""
    folder, key = _folder(spark, "rejects"), F.col("o_orderkey")
    lines = td.table(spark, sf, "orders").select(F.concat(
        key.cast("string"), F.lit(';"'), "o_orderpriority", F.when(key % 3 == 0, F.lit("\n")).otherwise(F.lit(" ")),
        F.lit('""so"" ; text"'), F.when(key % 7 == 0, F.lit(";EXTRA")).otherwise(F.lit("")),
        F.when(key % 11 == 0, F.lit(";;X")).otherwise(F.lit(""))).alias("value"))

    def titled(batches):  # every file of an extract has its header
        yield pa.RecordBatch.from_pydict({"value": ["order;priority"]})
        yield from batches

    lines.mapInArrow(titled, "value string").write.text(folder)
    found = dl.rejected_records(spark, folder, {"sep": ";"})
    return found.select(F.get("fields", F.lit(0)).alias("o_orderkey"), "reason", F.array_join("fields", "|").alias("record"))


QUERIES.update({"conform_schema": q_conform_schema, "transform_registry": q_transform_registry, "gender": q_gender,
                "provider_link": q_provider_link, "cohort_definition": q_cohort_definition,
                "unmapped_conditions": q_unmapped_conditions, "vocabulary_load": q_vocabulary_load,
                "parquet_roundtrip": q_parquet_roundtrip, "coerced_dates": q_coerced_dates,
                "csv_ingest_hard": q_csv_ingest_hard, "csv_rejects": q_csv_rejects,
                "vocabulary_last_wins": q_vocabulary_last_wins})
