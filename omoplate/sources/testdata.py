"""Adapters from the bundled benchmark tables to OMOP-shaped inputs.

The parquet tables under a scale-factor directory carry no clinical data,
so each adapter derives the shape an operator expects:

* intervals: a line item is an interval of its order's customer
  (start = ship date, end = start + quantity mod 30 days, type = line
  number; tie-break columns make the order total);
* visits: ``view`` events, lasting ``event_id mod 72`` hours;
* clinical events: every other event;
* CONCEPT / CONCEPT_RELATIONSHIP: built from ``part``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INTERVAL_TIEBREAK = ("l_linenumber", "l_orderkey", "l_partkey", "l_suppkey")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shipped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the customer of their order."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                                 "l_quantity", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(od, li.l_orderkey == od.o_orderkey).drop("o_orderkey")


def intervals(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """``lines`` may hand over ``shipped_lines`` where several tables are made of them."""
    lines = shipped_lines(spark, sf_dir) if lines is None else lines
    return lines.select(
        F.col("o_custkey").cast("long").alias("person_id"),
        F.col("l_shipdate").alias("start_date"),
        F.expr("timestampadd(DAY, CAST(l_quantity AS BIGINT) % 30, l_shipdate)").alias("end_date"),
        F.col("l_linenumber").cast("long").alias("type_concept"),
        *INTERVAL_TIEBREAK,
    )


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").filter(F.col("event_type") == "view")
    return ev.select(
        F.col("event_id").alias("visit_occurrence_id"),
        F.col("user_id").alias("person_id"),
        F.col("ts").alias("visit_start_datetime"),
        F.expr("timestampadd(HOUR, event_id % 72, ts)").alias("visit_end_datetime"),
    )


def visit_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits as a raw interval file (input of VISIT_OCCURRENCE)."""
    return visits(spark, sf_dir).select(
        "person_id",
        F.col("visit_start_datetime").alias("start_date"),
        F.col("visit_end_datetime").alias("end_date"),
        F.lit(32817).cast("long").alias("type_concept"),
        "visit_occurrence_id",
    )


def clinical_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").filter(F.col("event_type") != "view")
    return ev.select(
        F.col("event_id"),
        F.col("user_id").alias("person_id"),
        F.col("ts").alias("start_date"),
        F.col("event_type"),
        F.col("value"),
    )


def concept(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").cast("long").alias("concept_id"),
        F.col("p_name").alias("concept_name"),
        F.col("p_type").alias("domain_id"),
        F.col("p_brand").alias("vocabulary_id"),
        F.lit("Clinical Finding").alias("concept_class_id"),
        F.when(F.col("p_partkey") % 3 == 0, F.lit("S")).alias("standard_concept"),
        F.concat(F.lit("C"), F.col("p_partkey").cast("string")).alias("concept_code"),
    )


def concept_relationship(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    k = F.col("p_partkey").cast("long")
    return part.select(
        k.alias("concept_id_1"),
        F.when(k % 2 == 0, F.lit("Maps to")).otherwise(F.lit("Is a")).alias("relationship_id"),
        (k - k % 3).alias("concept_id_2"),
    )


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VOCABULARY from the brands, without those whose number ends in 5."""
    part = table(spark, sf_dir, "part").filter(~F.col("p_brand").endswith("5"))
    return part.groupBy(F.col("p_brand").alias("vocabulary_id")).agg(
        F.concat(F.lit("The vocabulary "), F.first("p_brand")).alias("vocabulary_name"),
        F.min("p_partkey").cast("long").alias("vocabulary_concept_id"))


def domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DOMAIN from the part types; the concepts of the domains do not exist."""
    return table(spark, sf_dir, "part").groupBy(F.col("p_type").alias("domain_id")).agg(
        F.first("p_type").alias("domain_name"), (-F.max("p_partkey")).cast("long").alias("domain_concept_id"))


def care_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("long").alias("care_site_id"), F.col("n_name").alias("care_site_name"),
        (F.col("n_nationkey") * 7).cast("long").alias("location_id"),
        (F.col("n_nationkey") * 100).cast("long").alias("place_of_service_concept_id"),
        F.repeat("n_name", F.lit(8)).alias("care_site_source_value"))


def procedures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line item is a procedure: several share an id, every second concept is missing, some have no concept."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("long").alias("procedure_occurrence_id"), (F.col("l_suppkey") * 3).cast("long").alias("person_id"),
        (F.col("l_partkey") * 2).cast("long").alias("procedure_concept_id"), F.to_date("l_shipdate").alias("procedure_date"),
        F.date_sub(F.to_date("l_shipdate"), (F.col("l_linenumber") - 3).cast("int")).alias("procedure_end_date"),
        F.col("l_linenumber").cast("long").alias("procedure_type_concept_id"), F.col("l_suppkey").cast("long").alias("provider_id"),
        F.when(F.col("l_linenumber") > 2, F.col("l_linenumber") + 40).cast("long").alias("visit_occurrence_id"))


# -- vocabulary-shaped inputs ---------------------------------------------------

def mapping_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coded records: a line item's part as (vocabulary, source value).

    Odd lines carry the part name, even lines its code; lines after the
    fifth claim another brand, so some values do not match.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    j = li.join(part, li.l_partkey == part.p_partkey)
    other_brand = F.concat(F.lit("Brand#"), ((F.col("l_partkey") + F.col("l_suppkey")) % 25 + 1).cast("string"))
    return j.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_linenumber") <= 5, F.col("p_brand")).otherwise(other_brand).alias("vocabulary_id"),
        F.when(F.col("l_linenumber") % 2 == 1, F.col("p_name"))
         .otherwise(F.concat(F.lit("C"), F.col("l_partkey").cast("string"))).alias("source_value"),
    )


def unit_concept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit concepts from ``nation``: UCUM (by code) or SNOMED (by name)."""
    n = table(spark, sf_dir, "nation")
    return n.select(
        (F.col("n_nationkey") + 8000).cast("long").alias("concept_id"),
        F.lower("n_name").alias("concept_name"),
        F.lit("Unit").alias("domain_id"),
        F.when(F.col("n_regionkey") % 2 == 0, F.lit("UCUM")).otherwise(F.lit("SNOMED")).alias("vocabulary_id"),
        F.lit("Unit").alias("concept_class_id"),
        F.lit("S").alias("standard_concept"),
        F.concat(F.lit("u"), F.col("n_nationkey").cast("string")).alias("concept_code"),
    )


def unit_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lab-name -> unit text table (the CLC shape) from ``part``."""
    p = table(spark, sf_dir, "part")
    k = (F.col("p_partkey") % 25).cast("string")
    return p.select(F.col("p_name").alias("NombreConvCLC"),
                    F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("u"), k))
                     .otherwise(F.concat(F.lit("nation_"), k)).alias("UnidadConv"))


def clinical_records(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Coded, dated records of a person: the ``mapping_data`` coding, the
    order's customer as person and the shipment as the record's interval
    (one scan of ``lineitem`` joined to ``part`` and ``orders``). ``lines``
    may hand over ``shipped_lines``."""
    lines = shipped_lines(spark, sf_dir) if lines is None else lines
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    # the orders first: what they are joined to is numbers only, the texts come last
    j = lines.join(part, lines.l_partkey == part.p_partkey)
    other_brand = F.concat(F.lit("Brand#"), ((F.col("l_partkey") + F.col("l_suppkey")) % 25 + 1).cast("string"))
    return j.select(
        F.col("o_custkey").cast("long").alias("person_id"),
        F.col("l_shipdate").alias("start_date"),
        F.expr("timestampadd(DAY, CAST(l_quantity AS BIGINT) % 30, l_shipdate)").alias("end_date"),
        F.lit(32817).cast("long").alias("type_concept"),
        F.when(F.col("l_linenumber") <= 5, F.col("p_brand")).otherwise(other_brand).alias("vocabulary_id"),
        F.when(F.col("l_linenumber") % 2 == 1, F.col("p_name"))
         .otherwise(F.concat(F.lit("C"), F.col("l_partkey").cast("string"))).alias("source_value"),
        "l_linenumber", "l_quantity", "l_partkey",
    )


def order_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VISIT_OCCURRENCE-shaped: an order is a visit of its customer lasting
    ``orderkey mod 20`` days."""
    od = table(spark, sf_dir, "orders")
    return od.select(
        F.col("o_orderkey").cast("long").alias("visit_occurrence_id"),
        F.col("o_custkey").cast("long").alias("person_id"),
        F.col("o_orderdate").alias("visit_start_datetime"),
        F.expr("timestampadd(DAY, o_orderkey % 20, o_orderdate)").alias("visit_end_datetime"),
    )


# -- dimension-shaped inputs ---------------------------------------------------------

def sociodemo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A person file from ``customer``: birth date, sex label, nation."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("long").alias("person_id"),
        F.expr("timestampadd(DAY, (c_custkey * 37) % 25000, TIMESTAMP_NTZ'1940-01-01 00:00:00')").alias("start_date"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("Mujer")).otherwise(F.lit("Hombre")).alias("desc_sexo"),
        "c_nationkey", "c_mktsegment",
    )


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One address per customer: its nation as city, region as state."""
    c = table(spark, sf_dir, "customer")
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return j.select((F.col("c_custkey") + 100).cast("long").alias("loc_id"),
                    F.concat(F.lit("Street of "), F.col("c_name")).alias("address_1"),
                    F.col("n_name").alias("city"), F.col("r_name").alias("state"),
                    F.col("n_nationkey").cast("string").alias("zip"), F.col("r_name").alias("county"),
                    F.col("c_name").alias("location_source_value"))


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").cast("string").alias("sid"), "s_name",
                    F.concat(F.lit("spec_"), (F.col("s_nationkey") % 7).cast("string")).alias("spec"),
                    "s_acctbal")


def deaths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer; the death date is the last date of its
    finished orders, null when it has none."""
    c = table(spark, sf_dir, "customer").select("c_custkey")
    last = (table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
            .groupBy("o_custkey").agg(F.max("o_orderdate").alias("death_date")))
    return c.join(last, c.c_custkey == last.o_custkey, "left").select(
        F.col("c_custkey").cast("long").alias("person_id"), "death_date",
        F.lit(32817).cast("long").alias("type_concept"))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw extract: health-card style person id, two date columns given
    end-first, and other fields."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit("AN"), F.lpad(F.col("o_custkey").cast("string"), 10, "0")).alias("NUHSA"),
        F.expr("timestampadd(DAY, o_orderkey % 20, o_orderdate)").alias("fec_fin"),
        F.col("o_orderdate").alias("fec_ini"),
        "o_orderkey", "o_orderstatus", "o_totalprice",
    )


def icd_crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local pathology code -> ICD code crosswalk from ``part``."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.concat(F.lit("P"), (F.col("p_partkey") % 500).cast("string")).alias("CODIGO_PATOLOGIA"),
        F.concat(F.upper(F.substring("p_name", 1, 1)), F.col("p_size").cast("string")).alias("COD_CIE_NORMALIZADO"),
        F.when(F.col("p_size") % 2 == 0, F.lit("CIE10ES")).otherwise(F.lit("CIE9MC")).alias("TIPO_CIE"),
    )
