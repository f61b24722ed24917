"""J1-J9, J13, J14, A8, A9."""

import pytest
from pyspark.sql import functions as F

from omoplate.operators import vocab as vo

CONCEPT = "concept_id long, concept_name string, domain_id string, vocabulary_id string, standard_concept string, concept_code string"
REL = "concept_id_1 long, relationship_id string, concept_id_2 long"


@pytest.fixture
def concept(spark):
    return spark.createDataFrame([
        (1, "Fever", "Condition", "LOCAL", None, "F01"),
        (2, "Cough", "Condition", "LOCAL", None, "C02"),
        (3, "Fever", "Condition", "LOCAL", None, "F03"),  # duplicate name: greatest id wins
        (10, "Fever", "Condition", "SNOMED", "S", "386661006"),
        (44821949, "Essential hypertension", "Condition", "ICD10CM", None, "I10"),
        (35207668, "Essential hypertension", "Condition", "ICD9CM", None, "401.9"),
        (320128, "Essential hypertension", "Condition", "SNOMED", "S", "59621000"),
        (8713, "gram per deciliter", "Unit", "UCUM", "S", "g/dL"),
        (8500, "milligram", "Unit", "SNOMED", "S", "mg"),
    ], CONCEPT)


@pytest.fixture
def rel(spark):
    return spark.createDataFrame([(1, "Maps to", 10), (3, "Maps to", 10), (2, "Is a", 10),
                                  (35207668, "Maps to", 320128), (44821949, "Maps to", 320128),
                                  (320128, "Maps to", 320128), (320128, "Mapped from", 320128)], REL)


def test_map_source_value(spark, concept):
    df = spark.createDataFrame([("LOCAL", "Fever"), ("LOCAL", "Nope"), ("SNOMED", "Fever"), ("OTHER", "Fever"),
                                ("LOCAL", "C02")], "vocabulary_id string, source_value string")
    out = vo.map_source_value(df, {"LOCAL": "concept_name", "SNOMED": "concept_name"}, concept)
    got = {(r.vocabulary_id, r.source_value): r.source_concept_id for r in out.collect()}
    assert got == {("LOCAL", "Fever"): 3, ("LOCAL", "Nope"): None, ("SNOMED", "Fever"): 10,
                   ("OTHER", "Fever"): None, ("LOCAL", "C02"): None}
    by_code = vo.map_source_value(df, {"LOCAL": "concept_code"}, concept)
    assert {r.source_value: r.source_concept_id for r in by_code.collect() if r.vocabulary_id == "LOCAL"}["C02"] == 2


def test_map_source_concept_id(spark, rel):
    df = spark.createDataFrame([(1,), (2,), (99,), (None,)], "source_concept_id long")
    out = vo.map_source_concept_id(df, rel)
    assert sorted((r.source_concept_id or -1, r.concept_id) for r in out.collect()) == [
        (-1, 0), (1, 10), (2, 0), (99, 0)]


def test_fallback_mapping_reference_cases(spark, concept, rel):
    fb = {"ICD10CM": "concept_code", "ICD9CM": "concept_code"}
    df = spark.createDataFrame([("I10", "ICD10CM", 44821949, 320128), ("I10", "ICD10CM", 44821949, 0),
                                ("401.9", "ICD10CM", None, 0), ("155296003", "Nebraska Lexicon", None, 0)],
                               "source_value string, vocabulary_id string, source_concept_id long, concept_id long")
    out, still = vo.fallback_mapping(df, concept, rel, fb, "source_value", "source_concept_id", "concept_id")
    got = sorted(tuple(r) for r in out.withColumn("still", still).collect())
    assert got == [("155296003", "ICD9CM", None, 0, True), ("401.9", "ICD9CM", 35207668, 320128, False),
                   ("I10", "ICD10CM", 44821949, 320128, False), ("I10", "ICD10CM", 44821949, 320128, False)]


def test_fallback_unmapped_value_kinds(spark, concept, rel):
    fb = {"ICD10CM": "concept_code", "ICD9CM": "concept_code"}
    df = spark.createDataFrame([("I10", "ICD10CM", "0", "0"), ("I10", "ICD10CM", "", ""),
                                ("I10", "ICD10CM", None, None)],
                               "source_value string, vocabulary_id string, source_concept_id string, concept_id string")
    out, _ = vo.fallback_mapping(df, concept, rel, fb, "source_value", "source_concept_id", "concept_id")
    # the text "0" is a value like any other; "" and null are unmapped
    assert sorted((r.source_concept_id, r.concept_id) for r in out.collect()) == [(0, 0)] + [(44821949, 320128)] * 2


def test_fallback_takes_the_first_that_reaches_a_standard_concept(spark):
    """By hand, vocabulary after vocabulary, for every kind of key; the data meet one lookup."""
    concept = spark.createDataFrame(
        [(1, "A", "x"), (2, "B", "x"), (3, "B", "y"), (4, "C", "y"), (5, "C", "z"), (6, "A", "z"), (7, "A", "only")],
        "concept_id long, vocabulary_id string, concept_code string").withColumn("concept_name", F.lit("n"))
    rel = spark.createDataFrame([(2, "Maps to", 20), (4, "Maps to", 40), (3, "Maps to", 30), (7, "Is a", 70)],
                                "concept_id_1 long, relationship_id string, concept_id_2 long")
    df = spark.createDataFrame([(k, "old", None, 0) for k in ("x", "y", "z", "only", "none", None)] + [("x", "old", 9, 90)],
                               "v string, vocabulary_id string, s long, c long")
    for order, want in (("ABC", {("x", "B", 2, 20), ("y", "B", 3, 30), ("z", "C", 5, 0), ("only", "C", None, 0)}),
                        ("CBA", {("x", "B", 2, 20), ("y", "C", 4, 40), ("z", "A", 6, 0), ("only", "A", 7, 0)})):
        out, still = vo.fallback_mapping(df, concept, rel, dict.fromkeys(order, "concept_code"), "v", "s", "c")
        none = {(k, order[-1], None, 0) for k in ("none", None)}
        rows = out.select("v", "vocabulary_id", "s", "c").collect()
        assert {tuple(r) for r in rows} == want | none | {("x", "old", 9, 90)} and len(rows) == 7
        assert out.columns == df.columns and out.filter(still).count() == 4
        assert out._jdf.queryExecution().optimizedPlan().toString().count("LeftOuter") == 2  # the lookup's edges, the data


def test_unit_texts_by_order_column(spark, concept, rel):
    units = spark.createDataFrame([("lab", "z", 1), ("lab", "a", 2)], "name string, unit string, place int")
    df = spark.createDataFrame([("lab",)], "l string")
    for table, want in ((units, "a"), (units.drop("place"), "z")):
        out = vo.map_lab_units(df, table, concept.withColumns({"place": F.lit(1), "domain_id": F.lit("Unit")}),
                               rel.withColumn("place", F.lit(1)), "l", "name", "unit", "place")
        assert out.first().unit_source_value == want


def test_update_concept_mappings(spark):
    df = spark.createDataFrame([("A1", 123), ("B2", 0), ("C3", 789), ("D4", None)], "src string, cid long")
    out = vo.update_concept_mappings(df, "src", "cid", {"B2": 456, "C3": 1, "D4": 7})
    assert {r.src: r.cid for r in out.collect()} == {"A1": 123, "B2": 456, "C3": 789, "D4": 7}
    assert vo.update_concept_mappings(df, "src", "cid", {}) is df
    with pytest.raises(KeyError):
        vo.update_concept_mappings(df, "nope", "cid", {"B2": 1})
    with pytest.raises(KeyError):
        vo.update_concept_mappings(df, "src", "nope", {"B2": 1})
    with pytest.raises(ValueError):
        vo.update_concept_mappings(df.limit(0), "src", "cid", {"B2": 1})
    sdf = spark.createDataFrame([("A1", ""), ("B2", "5")], "src string, cid string")
    out = vo.update_concept_mappings(sdf, "src", "cid", {"A1": 9})
    assert {r.src: r.cid for r in out.collect()} == {"A1": "9", "B2": "5"}


def test_check_unmapped_values_standard(spark, concept):
    df = spark.createDataFrame([("x", 0)], "measurement_source_value string, measurement_concept_id long")
    out = vo.check_unmapped_values(df, {"unmapped_measurement": {"x": 320128}}, ["measurement"], concept)
    assert out.collect()[0].measurement_concept_id == 320128
    with pytest.raises(AssertionError):
        vo.check_unmapped_values(df, {"unmapped_measurement": {"x": 1}}, ["measurement"], concept)
    # zero is allowed for measurements, not for drugs
    vo.check_unmapped_values(df, {"unmapped_measurement": {"x": 0}}, ["measurement"], concept)
    ddf = df.withColumnsRenamed({"measurement_source_value": "drug_source_value",
                                 "measurement_concept_id": "drug_concept_id"})
    with pytest.raises(AssertionError):
        vo.check_unmapped_values(ddf, {"unmapped_drug": {"x": 0}}, ["drug"], concept, variant="drug")


def test_unmapped_values_and_report(spark):
    df = spark.createDataFrame([("a", 1, 5, "V1"), ("a", None, 0, "V2"), ("b", 2, 6, "V1"), ("c", None, None, "V1")],
                               "sv string, sc long, cid long, vocabulary_id string")
    vals = sorted(r.sv for r in vo.find_unmapped_values(df, "sv", "cid").collect())
    assert vals == ["a", "c"]
    rep = vo.report_unmapped(df, vo.find_unmapped_values(df, "sv", "cid"), "sv", "sc", "cid", ["vocabulary_id"])
    rows = [tuple(r) for r in rep.collect()]
    assert [r[0] for r in rows] == ["a", "a", "c"]  # includes the row where "a" did map


def test_units(spark, concept):
    df = spark.createDataFrame([("g/dL",), ("milligram",), ("?",), (None,)], "unit_source_value string")
    out = {r.unit_source_value: (r.unit_vocabulary_id, r.unit_source_concept_id)
           for r in vo.map_units(df, concept).collect()}
    assert out == {"g/dL": ("UCUM", 8713), "milligram": ("SNOMED", 8500), "?": ("SNOMED", None),
                   None: ("SNOMED", None)}


def test_value_lookup_and_literals(spark):
    df = spark.createDataFrame([("Hb",), ("Pl",), ("Zz",)], "name string")
    clc = spark.createDataFrame([("Hb", "g/dL"), ("Pl", "x 10^3/uL"), ("Pl", "x 10^3/uL")], "k string, v string")
    out = {r.name: r.unit for r in vo.apply_value_lookup(df, clc, "name", "k", "v", "unit").collect()}
    assert out == {"Hb": "g/dL", "Pl": "x 10^3/uL", "Zz": None}
    g = spark.createDataFrame([("M", "Hombre"), ("F", "Mujer")], "code string, label string")
    got = vo.transform_gender(g, "code", "label", {"M": 8507, "F": 8532})
    assert {r.code: r.gender_concept_id for r in got.collect()} == {"M": 8507, "F": 8532}
    with pytest.raises(TypeError):
        vo.transform_gender(g, "code", "label", {"M": 8507})
    s = spark.createDataFrame([("CARDIOLOGIA",), ("X",)], "specialty_source_value string")
    out = vo.apply_source_mapping(s, {"specialty_source_value": {"CARDIOLOGIA": 38004451}})
    assert {r.specialty_source_value: r.specialty_concept_id for r in out.collect()} == {
        "CARDIOLOGIA": 38004451, "X": None}


def test_wide_relationship_and_icd(spark, concept, rel):
    wide = vo.wide_relationship(concept.select("concept_id", "concept_name"), rel)
    assert set(wide.columns) == {"concept_id_1", "concept_name_1", "ci_1", "relationship", "ci_2",
                                 "concept_id_2", "concept_name_2"}
    assert wide.filter("concept_id_1 = 1").collect()[0].concept_name_2 == "Fever"
    cw = spark.createDataFrame([("P1", "I10", "CIE10ES"), ("P1", "401.9", "CIE9MC")],
                               "CODIGO_PATOLOGIA string, COD_CIE_NORMALIZADO string, TIPO_CIE string")
    df = spark.createDataFrame([("P1",), ("P2",)], "code string")
    got = sorted((r.code, r.icd_code or "", r.icd_vocabulary_id or "") for r in vo.icd_expand(df, "code", cw).collect())
    assert got == [("P1", "401.9", "ICD9CM"), ("P1", "I10", "ICD10CM"), ("P2", "", "")]


def test_update_concept_mappings_reference_variants(spark):
    df = spark.createDataFrame([("SNOMED", "187033005", 4092846), ("test_is_a", "AA00", 0), ("test_is_a", "AA00", 0),
                                ("test_no_rel", "AA01", 0)], "vocabulary_id string, source_value string, concept_id long")
    out = vo.update_concept_mappings(df, "source_value", "concept_id", {"AA00": 999, "AA01": 111})
    assert sorted(r.concept_id for r in out.collect()) == [111, 999, 999, 4092846]
    part = vo.update_concept_mappings(df, "source_value", "concept_id", {"X1": 999})
    assert sorted(r.concept_id for r in part.collect()) == [0, 0, 0, 4092846]
    mixed = spark.createDataFrame([(1, "A"), (2, None), (3, "")], "source_value long, concept_id string")
    out = vo.update_concept_mappings(mixed, "source_value", "concept_id", {2: "B", 3: "C"})
    assert [r.concept_id for r in out.orderBy("source_value").collect()] == ["A", "B", "C"]


def test_map_source_value_by_code_reference(spark):
    concept = spark.createDataFrame([(2000001178, "Virus de la hepatitis B (Ag c), Ac", "Measurement", "CLC", None,
                                      "CLC00229")], CONCEPT)
    df = spark.createDataFrame([("CLC", "CLC00229"), ("CLC", "CLC999")], "vocabulary_id string, source_value string")
    out = vo.map_source_value(df, {"CLC": "concept_code"}, concept)
    assert {r.source_value: r.source_concept_id for r in out.collect()} == {"CLC00229": 2000001178, "CLC999": None}


def test_large_dictionary_behaves_like_a_small_one(spark, monkeypatch):
    df = spark.createDataFrame([("1", 1), ("x", 2), (None, 3)], "sex_source_value string, n long")
    for mapping in ({"1": "one", "x": "ex"}, {1: 10, 2: 20}):
        small = vo.apply_source_mapping(df, {"sex_source_value": mapping})
        with monkeypatch.context() as m:
            m.setattr(vo, "INLINE_MAP_ENTRIES", 0)
            large = vo.apply_source_mapping(df, {"sex_source_value": mapping})
        assert dict(small.dtypes)["sex_concept_id"] == dict(large.dtypes)["sex_concept_id"]
        assert sorted(map(str, small.collect())) == sorted(map(str, large.select(*small.columns).collect()))


def test_composed_lookup_equals_two_steps(spark, concept, rel):
    df = spark.createDataFrame([("ICD10CM", "I10"), ("ICD10CM", "none"), ("OTHER", "I10"), (None, None)],
                               "vocabulary_id string, source_value string")
    vocab = {"ICD10CM": "concept_code", "SNOMED": "concept_name"}
    two = vo.map_source_concept_id(vo.map_source_value(df, vocab, concept), rel)
    one = vo.map_to_standard(df, vocab, concept, rel, "source_value", "vocabulary_id", "source_concept_id", "concept_id")
    assert sorted(map(str, two.collect())) == sorted(map(str, one.select(*two.columns).collect()))


def test_order_column_decides_repeated_keys(spark):
    concept = spark.createDataFrame([(5, "a", "V", "a", 1), (3, "a", "V", "a", 2)],
                                    "concept_id long, concept_name string, vocabulary_id string, concept_code string, line long")
    rel = spark.createDataFrame([(3, "Maps to", 30, 2), (3, "Maps to", 40, 1)],
                                "concept_id_1 long, relationship_id string, concept_id_2 long, line long")
    df = spark.createDataFrame([("V", "a")], "vocabulary_id string, source_value string")
    out = vo.map_to_standard(df, {"V": "concept_code"}, concept, rel, "source_value", "vocabulary_id", "s", "c", "line")
    assert [(r.s, r.c) for r in out.collect()] == [(3, 30)]
