"""All tables in dependency order, written and read back, then validated."""

import datetime as dt
import tempfile

from helpers import ts
from omoplate.plans.cdm import build_cdm, check_cdm
from omoplate.session import tables_made


def test_build_cdm(spark):
    concept = spark.createDataFrame([
        (8507, "MALE", "Gender", "Gender", "S", "M"), (8532, "FEMALE", "Gender", "Gender", "S", "F"),
        (0, "No matching concept", "Metadata", "None", None, "No matching concept"),
        (32817, "EHR", "Type Concept", "Type Concept", "S", "OMOP4976890"),
        (9202, "Outpatient Visit", "Visit", "Visit", "S", "OP"),
        (44821949, "Essential hypertension", "Condition", "ICD10CM", None, "I10"),
        (320128, "Essential hypertension", "Condition", "SNOMED", "S", "59621000")],
        "concept_id long, concept_name string, domain_id string, vocabulary_id string, standard_concept string,"
        " concept_code string")
    rel = spark.createDataFrame([(44821949, "Maps to", 320128)],
                                "concept_id_1 long, relationship_id string, concept_id_2 long")
    loc = spark.createDataFrame([("1", "41001")], "loc string, zip string")
    socio = spark.createDataFrame([(1, dt.datetime(1980, 5, 17), "Mujer", "41001")],
                                  "person_id long, start_date timestamp_ntz, sexo string, cp string")
    visits = spark.createDataFrame([(1, ts("2020-01-01"), ts("2020-01-03"), 32817)],
                                   "person_id long, start_date timestamp_ntz, end_date timestamp_ntz, type_concept long")
    dx = spark.createDataFrame([(1, "2020-01-02", "2020-01-02", 32817, "I10")],
                               "person_id long, start_date string, end_date string, type_concept long,"
                               " condition_source_value string")
    inputs = {"LOCATION": {"l": loc}, "PERSON": {"s": socio}, "OBSERVATION_PERIOD": {"v": visits},
              "VISIT_OCCURRENCE": {"v": visits}, "CONDITION_OCCURRENCE": {"dx": dx}}
    params = {"LOCATION": {"column_name_map": {"l": {"loc": "location_id"}}},
              "PERSON": {"column_name_map": {"s": {"sexo": "gender_source_value"}},
                         "column_values_map": {"s": {"gender_source_value": {"Mujer": 8532}}},
                         "source_to_location": {"s": {"cp": "zip"}}},
              "VISIT_OCCURRENCE": {"visit_concept_dict": {"v": [("single_code", 9202)]}, "visit_concept_order": [9202]},
              "CONDITION_OCCURRENCE": {"append_vocabulary": {"dx": "ICD10CM"},
                                       "vocabulary_config": {"dx": {"ICD10CM": "concept_code"}}}}
    out_dir = tempfile.mkdtemp(prefix="omoplate-cdm-")
    vocab = {"CONCEPT": concept, "CONCEPT_RELATIONSHIP": rel}
    before = tables_made()
    tables = build_cdm(spark, inputs, params, vocab, out_dir)
    assert tables_made() == before  # its intermediate tables are gone
    assert spark.read.csv(f"{out_dir}/unmapped_conditions", header=True).count() == 0
    assert set(tables) == {"LOCATION", "PERSON", "OBSERVATION_PERIOD", "VISIT_OCCURRENCE", "CONDITION_OCCURRENCE"}
    cond = tables["CONDITION_OCCURRENCE"].collect()[0]
    assert (cond.condition_concept_id, cond.visit_occurrence_id) == (320128, 0)
    assert tables["PERSON"].collect()[0].location_id == 1
    problems = {(r.check, r.table, r.column) for r in check_cdm(tables, vocab).collect()}
    # the fixture vocabulary has no race/ethnicity concept rows beyond 0, and LOCATION lacks address text
    assert ("fk", "CONDITION_OCCURRENCE", "condition_concept_id") not in problems
    assert not any(c == "pk" for c, _, _ in problems)
