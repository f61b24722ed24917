"""Target schemas of the OMOP CDM tables.

Each schema is written as a Spark DDL column list and parsed into a
``StructType``. Types used: BIGINT, STRING, DOUBLE, DATE, TIMESTAMP_NTZ.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "STRING": T.StringType(),
    "DOUBLE": T.DoubleType(),
    "DATE": T.DateType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


def parse_ddl(ddl: str) -> T.StructType:
    """Parse ``name TYPE [NOT NULL], ...`` into a StructType."""
    fields = []
    for part in ddl.split(","):
        words = part.split()
        if not words:
            continue
        name, typ, rest = words[0], words[1].upper(), [w.upper() for w in words[2:]]
        fields.append(T.StructField(name, _TYPES[typ], nullable=rest != ["NOT", "NULL"]))
    return T.StructType(fields)


# OMOP CDM 5.4 column names, order, types and nullability of the
# tables this package writes or reads (the target registry).
_DDL = {
    "CDM_SOURCE": """
        cdm_source_name STRING NOT NULL, cdm_source_abbreviation STRING NOT NULL,
        cdm_holder STRING NOT NULL, source_description STRING,
        source_documentation_reference STRING, cdm_etl_reference STRING,
        source_release_date DATE NOT NULL, cdm_release_date DATE NOT NULL,
        cdm_version STRING, cdm_version_concept_id BIGINT NOT NULL,
        vocabulary_version STRING NOT NULL""",
    "PERSON": """
        person_id BIGINT NOT NULL, gender_concept_id BIGINT NOT NULL,
        year_of_birth BIGINT NOT NULL, month_of_birth BIGINT, day_of_birth BIGINT,
        birth_datetime TIMESTAMP_NTZ, race_concept_id BIGINT NOT NULL,
        ethnicity_concept_id BIGINT NOT NULL, location_id BIGINT, provider_id BIGINT,
        care_site_id BIGINT, person_source_value STRING, gender_source_value STRING,
        gender_source_concept_id BIGINT, race_source_value STRING,
        race_source_concept_id BIGINT, ethnicity_source_value STRING,
        ethnicity_source_concept_id BIGINT""",
    "OBSERVATION_PERIOD": """
        observation_period_id BIGINT NOT NULL, person_id BIGINT NOT NULL,
        observation_period_start_date DATE NOT NULL,
        observation_period_end_date DATE NOT NULL,
        period_type_concept_id BIGINT NOT NULL""",
    "VISIT_OCCURRENCE": """
        visit_occurrence_id BIGINT NOT NULL, person_id BIGINT NOT NULL,
        visit_concept_id BIGINT NOT NULL, visit_start_date DATE NOT NULL,
        visit_start_datetime TIMESTAMP_NTZ, visit_end_date DATE NOT NULL,
        visit_end_datetime TIMESTAMP_NTZ, visit_type_concept_id BIGINT NOT NULL,
        provider_id BIGINT, care_site_id BIGINT, visit_source_value STRING,
        visit_source_concept_id BIGINT, admitted_from_concept_id BIGINT,
        admitted_from_source_value STRING, discharged_to_concept_id BIGINT,
        discharged_to_source_value STRING, preceding_visit_occurrence_id BIGINT""",
    "CONDITION_OCCURRENCE": """
        condition_occurrence_id BIGINT NOT NULL, person_id BIGINT NOT NULL,
        condition_concept_id BIGINT NOT NULL, condition_start_date DATE NOT NULL,
        condition_start_datetime TIMESTAMP_NTZ, condition_end_date DATE,
        condition_end_datetime TIMESTAMP_NTZ, condition_type_concept_id BIGINT NOT NULL,
        condition_status_concept_id BIGINT, stop_reason STRING, provider_id BIGINT,
        visit_occurrence_id BIGINT, visit_detail_id BIGINT,
        condition_source_value STRING, condition_source_concept_id BIGINT,
        condition_status_source_value STRING""",
    "CONCEPT": """
        concept_id BIGINT NOT NULL, concept_name STRING NOT NULL,
        domain_id STRING NOT NULL, vocabulary_id STRING NOT NULL,
        concept_class_id STRING NOT NULL, standard_concept STRING,
        concept_code STRING NOT NULL, valid_start_date DATE NOT NULL,
        valid_end_date DATE NOT NULL, invalid_reason STRING""",
    "CONCEPT_RELATIONSHIP": """
        concept_id_1 BIGINT NOT NULL, concept_id_2 BIGINT NOT NULL,
        relationship_id STRING NOT NULL, valid_start_date DATE NOT NULL,
        valid_end_date DATE NOT NULL, invalid_reason STRING""",
    "SOURCE_TO_CONCEPT_MAP": """
        source_code STRING NOT NULL, source_concept_id BIGINT NOT NULL,
        source_vocabulary_id STRING NOT NULL, source_code_description STRING,
        target_concept_id BIGINT NOT NULL, target_vocabulary_id STRING,
        valid_start_date DATE NOT NULL, valid_end_date DATE NOT NULL,
        invalid_reason STRING""",
    "VOCABULARY": """
        vocabulary_id STRING NOT NULL, vocabulary_name STRING NOT NULL,
        vocabulary_reference STRING, vocabulary_version STRING,
        vocabulary_concept_id BIGINT NOT NULL""",
    "MEASUREMENT": """
        measurement_id BIGINT NOT NULL, person_id BIGINT NOT NULL,
        measurement_concept_id BIGINT NOT NULL, measurement_date DATE NOT NULL,
        measurement_datetime TIMESTAMP_NTZ, measurement_time STRING,
        measurement_type_concept_id BIGINT NOT NULL, operator_concept_id BIGINT,
        value_as_number DOUBLE, value_as_concept_id BIGINT, unit_concept_id BIGINT,
        range_low DOUBLE, range_high DOUBLE, provider_id BIGINT,
        visit_occurrence_id BIGINT, visit_detail_id BIGINT,
        measurement_source_value STRING, measurement_source_concept_id BIGINT,
        unit_source_value STRING, unit_source_concept_id BIGINT,
        value_source_value STRING, measurement_event_id BIGINT,
        meas_event_field_concept_id BIGINT""",
    "PROVIDER": """
        provider_id BIGINT NOT NULL, provider_name STRING, npi STRING, dea STRING,
        specialty_concept_id BIGINT, care_site_id BIGINT, year_of_birth BIGINT,
        gender_concept_id BIGINT, provider_source_value STRING,
        specialty_source_value STRING, specialty_source_concept_id BIGINT,
        gender_source_value STRING, gender_source_concept_id BIGINT""",
    "DEATH": """
        person_id BIGINT NOT NULL, death_date DATE NOT NULL,
        death_datetime TIMESTAMP_NTZ, death_type_concept_id BIGINT,
        cause_concept_id BIGINT, cause_source_value STRING,
        cause_source_concept_id BIGINT""",
    "COHORT": """
        cohort_definition_id BIGINT NOT NULL, subject_id BIGINT NOT NULL,
        cohort_start_date DATE NOT NULL, cohort_end_date DATE NOT NULL""",
    "COHORT_DEFINITION": """
        cohort_definition_id BIGINT NOT NULL, cohort_definition_name STRING NOT NULL,
        cohort_definition_description STRING,
        definition_type_concept_id BIGINT NOT NULL, cohort_definition_syntax STRING,
        subject_concept_id BIGINT NOT NULL, cohort_initiation_date DATE""",
    "LOCATION": """
        location_id BIGINT NOT NULL, address_1 STRING NOT NULL,
        address_2 STRING NOT NULL, city STRING, state STRING, zip STRING,
        county STRING NOT NULL, location_source_value STRING NOT NULL,
        country_concept_id BIGINT, country_source_value STRING, latitude DOUBLE,
        longitude DOUBLE""",
    "DRUG_EXPOSURE": """
        drug_exposure_id BIGINT NOT NULL, person_id BIGINT NOT NULL,
        drug_concept_id BIGINT NOT NULL, drug_exposure_start_date DATE NOT NULL,
        drug_exposure_start_datetime TIMESTAMP_NTZ,
        drug_exposure_end_date DATE NOT NULL,
        drug_exposure_end_datetime TIMESTAMP_NTZ, verbatim_end_date DATE,
        drug_type_concept_id BIGINT NOT NULL, stop_reason STRING, refills BIGINT,
        quantity DOUBLE, days_supply BIGINT, sig STRING, route_concept_id BIGINT,
        lot_number STRING, provider_id BIGINT, visit_occurrence_id BIGINT,
        visit_detail_id BIGINT, drug_source_value STRING,
        drug_source_concept_id BIGINT, route_source_value STRING,
        dose_unit_source_value STRING""",
}

OMOP_SCHEMAS: dict[str, T.StructType] = {name: parse_ddl(ddl) for name, ddl in _DDL.items()}


def schema(name: str) -> T.StructType:
    try:
        return OMOP_SCHEMAS[name.upper()]
    except KeyError:
        raise KeyError(f"unknown OMOP table {name!r}") from None


# OMOP CDM 5.4 text column limits (varchar lengths) of the
# registry tables, as "TABLE.column length".
TEXT_LENGTHS_TEXT = """
PERSON.person_source_value 50
PERSON.gender_source_value 50
PERSON.race_source_value 50
PERSON.ethnicity_source_value 50
VISIT_OCCURRENCE.visit_source_value 50
VISIT_OCCURRENCE.admitted_from_source_value 50
VISIT_OCCURRENCE.discharged_to_source_value 50
CONDITION_OCCURRENCE.stop_reason 20
CONDITION_OCCURRENCE.condition_source_value 50
CONDITION_OCCURRENCE.condition_status_source_value 50
DRUG_EXPOSURE.stop_reason 20
DRUG_EXPOSURE.lot_number 50
DRUG_EXPOSURE.drug_source_value 50
DRUG_EXPOSURE.route_source_value 50
DRUG_EXPOSURE.dose_unit_source_value 50
MEASUREMENT.measurement_time 10
MEASUREMENT.measurement_source_value 50
MEASUREMENT.unit_source_value 50
MEASUREMENT.value_source_value 50
DEATH.cause_source_value 50
PROVIDER.provider_name 255
PROVIDER.npi 20
PROVIDER.dea 20
PROVIDER.provider_source_value 50
PROVIDER.specialty_source_value 50
PROVIDER.gender_source_value 50
LOCATION.address_1 50
LOCATION.address_2 50
LOCATION.city 50
LOCATION.state 2
LOCATION.zip 9
LOCATION.county 20
LOCATION.location_source_value 50
LOCATION.country_source_value 80
COHORT_DEFINITION.cohort_definition_name 255
CDM_SOURCE.cdm_source_name 255
CDM_SOURCE.cdm_source_abbreviation 25
CDM_SOURCE.cdm_holder 255
CDM_SOURCE.source_documentation_reference 255
CDM_SOURCE.cdm_etl_reference 255
CDM_SOURCE.cdm_version 10
CDM_SOURCE.vocabulary_version 20
CONCEPT.concept_name 255
CONCEPT.domain_id 20
CONCEPT.vocabulary_id 20
CONCEPT.concept_class_id 20
CONCEPT.standard_concept 1
CONCEPT.concept_code 50
CONCEPT.invalid_reason 1
CONCEPT_RELATIONSHIP.relationship_id 20
CONCEPT_RELATIONSHIP.invalid_reason 1
VOCABULARY.vocabulary_id 20
VOCABULARY.vocabulary_name 255
VOCABULARY.vocabulary_reference 255
VOCABULARY.vocabulary_version 255
SOURCE_TO_CONCEPT_MAP.source_code 50
SOURCE_TO_CONCEPT_MAP.source_vocabulary_id 20
SOURCE_TO_CONCEPT_MAP.source_code_description 255
SOURCE_TO_CONCEPT_MAP.target_vocabulary_id 20
SOURCE_TO_CONCEPT_MAP.invalid_reason 1
"""


def text_lengths(table: str) -> dict[str, int]:
    """Column -> maximum length for one table."""
    out = {}
    for line in TEXT_LENGTHS_TEXT.strip().splitlines():
        name, n = line.split()
        t, c = name.split(".")
        if t == table.upper():
            out[c] = int(n)
    return out
