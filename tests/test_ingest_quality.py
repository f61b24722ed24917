"""S1-S4, S7, S9, P7-P10, Q1-Q6, D10, D11."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from omoplate.functions.numbers import is_number, strict_number, try_number
from omoplate.functions.text import normalize_text
from omoplate.operators import person as pe
from omoplate.operators import quality as qa
from omoplate.sources import delimited as dl


@pytest.fixture
def raw_csv(spark):
    folder = tempfile.mkdtemp(prefix="omoplate-csv-")
    path = os.path.join(folder, "visits.csv")
    with open(path, "w", encoding="latin-1") as f:
        f.write("NUHSA;fecha_inicio;fec_fin;servicio\n")
        f.write("AN0000000001;01/02/2020;05/02/2020;Cardiología\n")
        f.write("AN0000000002;31/12/2021;02/01/2022;Pediatría\n")
        f.write("AN0000000003;;03/03/2022;Urgencias\n")
    return path


def test_probe_read_and_dates(spark, raw_csv):
    opts = dl.probe_read_options(spark, raw_csv, {"sep": [",", ";"], "encoding": ["latin1"]},
                                 checks=[dl.check_id_column])
    assert opts["sep"] == ";"
    df = dl.read_delimited(spark, raw_csv, opts)
    assert dict(df.dtypes) == {c: "string" for c in df.columns}
    dates = dl.find_date_columns(df.columns)
    assert dates == ["fecha_inicio", "fec_fin"]
    chosen, coerced = dl.probe_date_formats(df, dates, ["%Y-%m-%d", "%d/%m/%Y"])
    assert chosen["fecha_inicio"] == {"format": "%d/%m/%Y", "errors": "raise"} and coerced == {}
    out = dl.ingest_files(spark, {"v": raw_csv}, {"v": {"read": opts, "dates": chosen}})["v"]
    r = out.orderBy("NUHSA").collect()
    assert r[0].fecha_inicio == dt.datetime(2020, 2, 1) and r[2].fecha_inicio is None
    assert r[0].servicio == "Cardiología"
    with pytest.raises(AssertionError):
        dl.probe_read_options(spark, raw_csv, {"sep": [","]})


def test_date_probe_coerces(spark):
    df = spark.createDataFrame([("2020-01-01",), ("garbage",), (None,)], "f string")
    chosen, coerced = dl.probe_date_formats(df, ["f"], ["%Y-%m-%d", "%d/%m/%Y"])
    assert chosen["f"]["errors"] == "coerce" and coerced["f"]["nulls"] == 2
    with pytest.raises(Exception):
        dl.parse_dates(df, {"f": "%Y-%m-%d"}).collect()
    assert dl.parse_dates(df, {"f": {"format": "%Y-%m-%d", "errors": "coerce"}}).filter("f is null").count() == 2
    iso = spark.createDataFrame([("20200102",), ("2020/01/03",), ("2020-01-04",)], "f string")
    assert dl.parse_dates(iso, {"f": "ISO8601"}).filter("f is null").count() == 0


def test_vocabulary_rows_keep_their_place(spark, tmp_path):
    """Over files, and splits of a file, the last row of a key is found; a greatest value would be another."""
    for name, ids in (("b", range(900, 500, -1)), ("a", range(5000, 4000, -1))):
        (tmp_path / f"{name}.csv").write_text("concept_id\tcode\n" + "".join(f"{i}\tk{i % 7}\n" for i in ids))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    try:
        schema = T.StructType.fromDDL("concept_id long, code string")
        rows = dl.read_vocabulary(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], schema, order_column="place")
        assert rows.select("place.file", "place.block").distinct().count() > 10
        got = rows.groupBy("code").agg(F.max_by("concept_id", "place")).collect()
        assert [r.concept_id for r in rows.orderBy("place").collect()] == [*range(5000, 4000, -1), *range(900, 500, -1)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {tuple(r) for r in got} == {(f"k{i % 7}", i) for i in range(501, 508)}


def test_vocabulary_file_keeps_quotes(spark):
    folder = tempfile.mkdtemp(prefix="omoplate-vocab-")
    path = os.path.join(folder, "CONCEPT.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("concept_id\tconcept_name\tvalid_start_date\n")
        f.write('1\tThe "quoted" name\t19700101\n')
    sch = T.StructType([T.StructField("concept_id", T.LongType()), T.StructField("concept_name", T.StringType()),
                        T.StructField("valid_start_date", T.DateType())])
    r = dl.read_vocabulary(spark, path, sch).collect()[0]
    assert r.concept_name == 'The "quoted" name' and r.valid_start_date == dt.date(1970, 1, 1)
    rows = dl.literal_rows(spark, [{"concept_id": 5}], sch).collect()
    assert rows[0].concept_id == 5 and rows[0].concept_name is None


def test_person_standardisation(spark):
    df = spark.createDataFrame([("AN0000000042", dt.datetime(2020, 1, 5), dt.datetime(2020, 1, 1), "x", 1)],
                               "NUHSA string, fin timestamp_ntz, ini timestamp_ntz, other string, __index_level_0__ long")
    out = pe.standardise_source(df, "NUHSA", ["fin", "ini"], 32817)
    assert out.columns == ["person_id", "start_date", "end_date", "type_concept", "person_source_value", "other"]
    r = out.collect()[0]
    assert (r.person_id, r.start_date, r.end_date) == (42, dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 5))
    mixed = spark.createDataFrame([(1, 2), (3, 1)], "a long, b long")
    with pytest.raises(ValueError):
        pe.find_start_end(mixed, ["a", "b"])
    with pytest.raises(TypeError):
        pe.find_start_end(mixed, [])
    with pytest.raises(ValueError):
        pe.find_start_end(mixed, ["a", "b", "a"])
    assert pe.find_start_end(mixed, ["a"]) == ("a", "a")
    births = pe.birth_parts(spark.createDataFrame([(dt.datetime(1990, 5, 17),)], "start_date timestamp_ntz"))
    assert tuple(births.collect()[0])[1:] == (1990, 5, 17)
    with pytest.raises(ValueError):
        pe.birth_parts(spark.createDataFrame([("x",)], "start_date string"))


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "bb", 2), (2, None, 3)], "k long, s string, f long")
    assert [tuple(r) for r in qa.pk_violations(df, ["k"]).collect()] == [(1, 2)]
    parent = spark.createDataFrame([(2,)], "f long")
    assert [tuple(r) for r in qa.fk_violations(df, "f", parent, "f", "T").collect()] == [("T", "f", "3", 1)]
    nulls = {r.column: r.n_null for r in qa.null_counts(df).collect()}
    assert nulls == {"k": 0, "s": 1, "f": 1}
    assert [tuple(r) for r in qa.length_violations(df, {"s": 1}).collect()] == [("s", 1, 1)]
    keys = spark.range(5).withColumnRenamed("id", "pid")
    assert qa.key_check(keys, "pid").collect()[0].is_dense
    assert not qa.key_check(keys.filter("pid != 2"), "pid").collect()[0].is_dense


def test_date_rules(spark):
    ev = spark.createDataFrame([(1, dt.datetime(2020, 1, 1), dt.datetime(2019, 1, 1)),
                                (1, None, dt.datetime(2020, 1, 1)),
                                (2, dt.datetime(1950, 1, 1), dt.datetime(2030, 1, 1))],
                               "person_id long, start_date timestamp_ntz, end_date timestamp_ntz")
    person = spark.createDataFrame([(1, dt.datetime(1980, 1, 1), 1980, 1, 1), (2, None, 1960, None, None)],
                                   "person_id long, birth_datetime timestamp_ntz, year_of_birth long,"
                                   " month_of_birth long, day_of_birth long")
    death = spark.createDataFrame([(2, dt.date(2025, 1, 1))], "person_id long, death_date date")
    got = {r.rule: r.n_violations for r in qa.date_rules(ev, person, death).collect()}
    assert got == {"start_missing": 1, "end_before_start": 1, "start_before_birth": 1, "start_after_death": 0,
                   "end_after_death_grace": 1}


def test_numbers(spark):
    df = spark.createDataFrame([("1.5",), (" -2e3 ",), ("1.0d",), ("nan",), ("abc",), (None,)], "v string")
    got = [tuple(r) for r in df.select(try_number("v"), is_number("v")).collect()]
    assert got == [(1.5, True), (-2000.0, True), (None, False), (None, False), (None, False), (None, False)]
    with pytest.raises(Exception, match="numeric"):
        df.select(strict_number("v")).collect()
    ok = df.filter("v in ('1.5', 'nan')").select(strict_number("v").alias("x")).collect()
    assert len(ok) == 2


def test_normalize_text_matches_python(spark):
    """D10 against the definition in plain Python, on every document."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r.t for r in docs.select("doc_id", normalize_text("text").alias("t")).collect()}
    table = str.maketrans({"á": "a", "é": "e", "í": "i", "ó": "o", "ú": "u", "ü": "u", "ñ": "n"})
    want = {r.doc_id: (r.text.lower().translate(table) if r.text is not None else None)
            for r in docs.select("doc_id", "text").collect()}
    assert got == want
    assert spark.createDataFrame([("ÁRBOL Ñandú",)], "t string").select(normalize_text("t")).collect()[0][0] == "arbol nandu"


def test_validate_cdm(spark):
    person = spark.createDataFrame([(1, 8507, 1980, "x" * 60), (1, 8532, None, "ok"), (2, 99, 1990, None)],
                                   "person_id long, gender_concept_id long, year_of_birth long,"
                                   " person_source_value string")
    concept = spark.createDataFrame([(8507,), (8532,)], "concept_id long")
    got = {(r.check, r.table, r.column, r.value, r.n) for r in qa.validate_cdm({"PERSON": person, "CONCEPT": concept}).collect()}
    assert got == {("pk", "PERSON", "person_id", "1", 2), ("fk", "PERSON", "gender_concept_id", "99", 1),
                   ("null", "PERSON", "year_of_birth", None, 1), ("length", "PERSON", "person_source_value", None, 1)}


def test_latin9_file(spark):
    folder = tempfile.mkdtemp(prefix="omoplate-enc-")
    path = os.path.join(folder, "f.csv")
    with open(path, "wb") as f:
        f.write("a;b\n€uro;ñu\n".encode("iso-8859-15"))
    rows = dl.read_delimited(spark, path, {"sep": ";", "encoding": "latin9"}).collect()
    assert [tuple(r) for r in rows] == [("€uro", "ñu")]


def test_validate_cdm_date_rules(spark):
    person = spark.createDataFrame([(1, dt.datetime(1990, 1, 1))], "person_id long, birth_datetime timestamp_ntz")
    op = spark.createDataFrame([(0, 1, dt.date(1985, 1, 1), dt.date(1984, 1, 1), 1)],
                               "observation_period_id long, person_id long, observation_period_start_date date,"
                               " observation_period_end_date date, period_type_concept_id long")
    got = {(r.check, r.table, r.column, r.n) for r in qa.validate_cdm({"PERSON": person, "OBSERVATION_PERIOD": op}).collect()
           if r.check == "date"}
    assert got == {("date", "OBSERVATION_PERIOD", "end_before_start", 1),
                   ("date", "OBSERVATION_PERIOD", "start_before_birth", 1)}


def _read(spark, tmp_path, text, **options):
    (tmp_path / "x.csv").write_text(text, encoding=options.pop("write_as", "utf-8"), newline="")
    return [tuple(r) for r in dl.read_delimited(spark, str(tmp_path / "x.csv"), {"sep": ";", **options}).collect()]


def test_quoted_fields(spark, tmp_path):
    text = 'a;b\n"x;""y"" z";1\n"line1\nline2";2\n'
    assert _read(spark, tmp_path, text, multiline=True) == [('x;"y" z', "1"), ("line1\nline2", "2")]


def test_surplus_fields_fail_or_are_skipped(spark, tmp_path):
    text = "a;b\n1;2\n3;4;EXTRA\n5\n"
    with pytest.raises(Exception, match="EXTRA"):
        _read(spark, tmp_path, text)
    assert _read(spark, tmp_path, text, on_bad_lines="skip") == [("1", "2"), ("5", None)]


def test_missing_value_spellings(spark, tmp_path):
    text = "a;b\nNA;NULL\nnan;-\n"
    assert _read(spark, tmp_path, text) == [(None, None), (None, "-")]
    assert _read(spark, tmp_path, text, na_values=["-"], keep_default_na=False) == [("NA", "NULL"), ("nan", None)]


def test_single_byte_encodings_leave_the_session_alone(spark, tmp_path):
    before = spark.conf.get("spark.sql.legacy.javaCharsets", "false")
    text = "a\u0160;b\n\u20ac;\u0153\n"
    assert _read(spark, tmp_path, text, encoding="latin9", write_as="latin9") == [("\u20ac", "\u0153")]
    assert _read(spark, tmp_path, text, encoding="cp1252", write_as="cp1252") == [("\u20ac", "\u0153")]
    assert spark.conf.get("spark.sql.legacy.javaCharsets", "false") == before


def test_a_late_bad_date_is_seen_and_coerced(spark):
    rows = [(f"{1 + i % 28:02d}/01/2020",) for i in range(1500)] + [("not a date",)]
    df = spark.createDataFrame(rows, "d string").coalesce(1)
    chosen, coerced = dl.probe_date_formats(df, ["d"], ["%d/%m/%Y", "%Y-%m-%d"])
    assert chosen["d"] == {"format": "%d/%m/%Y", "errors": "coerce"} and coerced["d"]["nulls"] == 1
    assert dl.settle_dates(df, {"d": "%d/%m/%Y"}) == {"d": {"format": "%d/%m/%Y", "errors": "coerce"}}
    assert dl.settle_dates(df.limit(1500), {"d": "%d/%m/%Y"})["d"]["errors"] == "raise"
    assert dl.parse_dates(df, dl.settle_dates(df, {"d": "%d/%m/%Y"})).filter("d is null").count() == 1
