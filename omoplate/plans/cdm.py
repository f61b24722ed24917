"""All tables in dependency order (LOCATION -> PERSON, PROVIDER -> VISIT,
VISIT -> CONDITION / MEASUREMENT / DRUG; the rest are independent)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from omoplate.operators.quality import validate_cdm
from omoplate.plans import (condition_occurrence, dimensions, drug_exposure, measurement, observation_period,
                            visit_occurrence)
from omoplate.session import release_tables, tables_made
from omoplate.sources.delimited import write_parquet, write_report


def build_cdm(spark: SparkSession, inputs: Mapping[str, Mapping[str, DataFrame]], params: Mapping[str, Mapping],
              vocabulary: Mapping[str, DataFrame], out_dir: str | None = None) -> dict[str, DataFrame]:
    """Build every table that has inputs, in dependency order.

    ``inputs[TABLE]`` maps file names to DataFrames, ``params[TABLE]`` holds
    that table's configuration; ``vocabulary`` holds CONCEPT,
    CONCEPT_RELATIONSHIP and optionally the unit table (UNITS). With
    ``out_dir`` each table is written (S6) and read back before the tables
    that depend on it are built, as separate stages of one run, the report of
    unmapped conditions is written as CSV beside them, and the intermediate
    tables of this build are deleted at the end. Returns the tables by name.
    """
    out: dict[str, DataFrame] = {}
    before = tables_made()

    def done(name: str, df: DataFrame) -> DataFrame:
        if out_dir:
            path = f"{out_dir.rstrip('/')}/{name}"
            write_parquet(df, path)
            df = spark.read.parquet(path)
        out[name] = df
        return df

    concept, rel = vocabulary.get("CONCEPT"), vocabulary.get("CONCEPT_RELATIONSHIP")
    p = lambda t: params.get(t, {})
    if "LOCATION" in inputs:
        done("LOCATION", dimensions.location(inputs["LOCATION"], p("LOCATION")))
    if "PERSON" in inputs:
        done("PERSON", dimensions.person(inputs["PERSON"], p("PERSON"), out.get("LOCATION")))
    if "PROVIDER" in inputs:
        done("PROVIDER", dimensions.provider(inputs["PROVIDER"], p("PROVIDER")))
    if "OBSERVATION_PERIOD" in inputs:
        cfg = p("OBSERVATION_PERIOD")
        done("OBSERVATION_PERIOD", observation_period.build(inputs["OBSERVATION_PERIOD"], cfg.get("n_days", 365),
                                                            cfg.get("transformations")))
    if "VISIT_OCCURRENCE" in inputs:
        done("VISIT_OCCURRENCE", visit_occurrence.build(inputs["VISIT_OCCURRENCE"], p("VISIT_OCCURRENCE"),
                                                        out.get("PROVIDER")))
    visits = out.get("VISIT_OCCURRENCE")
    if "CONDITION_OCCURRENCE" in inputs:
        table, report = condition_occurrence.build(inputs["CONDITION_OCCURRENCE"], p("CONDITION_OCCURRENCE"),
                                                   concept, rel, visits, report=out_dir is not None)
        if out_dir:
            write_report(report, f"{out_dir.rstrip('/')}/unmapped_conditions")
        done("CONDITION_OCCURRENCE", table)
    if "MEASUREMENT" in inputs:
        done("MEASUREMENT", measurement.build(inputs["MEASUREMENT"], p("MEASUREMENT"), concept, rel,
                                              vocabulary["UNITS"], visits))
    if "DRUG_EXPOSURE" in inputs:
        done("DRUG_EXPOSURE", drug_exposure.build(inputs["DRUG_EXPOSURE"], p("DRUG_EXPOSURE"), concept, rel, visits))
    if "DEATH" in inputs:
        done("DEATH", dimensions.death(inputs["DEATH"], p("DEATH")))
    if "COHORT" in inputs:
        cohort, definition = dimensions.cohort(spark, inputs["COHORT"], p("COHORT"))
        done("COHORT", cohort)
        done("COHORT_DEFINITION", definition)
    if "CDM_SOURCE" in params:
        done("CDM_SOURCE", dimensions.cdm_source(spark, params["CDM_SOURCE"]))
    if out_dir:  # every result is written, so nothing reads the intermediate tables any more
        release_tables(spark, before)
    return out


def check_cdm(tables: Mapping[str, DataFrame], vocabulary: Mapping[str, DataFrame]) -> DataFrame:
    """Q1-Q5 over the built tables and the vocabulary (``validate_cdm``)."""
    return validate_cdm({**{k: v for k, v in vocabulary.items() if k != "UNITS"}, **tables})
