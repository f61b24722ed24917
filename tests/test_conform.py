"""P1-P6, P16, P20, W5."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from omoplate.operators import conform as cf
from omoplate.schemas import schema

TARGET = T.StructType([
    T.StructField("var_int", T.LongType(), False), T.StructField("var_float", T.DoubleType(), False),
    T.StructField("var_string", T.StringType(), False), T.StructField("var_date", T.DateType(), False),
    T.StructField("var_timestamp", T.TimestampNTZType(), False),
    T.StructField("var_int_nullable", T.LongType(), True), T.StructField("var_float_nullable", T.DoubleType(), True),
    T.StructField("var_string_nullable", T.StringType(), True)])


def test_fill_missing_defaults(spark):
    df = spark.createDataFrame([(1, "a", dt.date(2020, 1, 1), dt.datetime(2020, 1, 1, 5))],
                               "var_int long, var_string string, var_date date, var_timestamp timestamp_ntz")
    out = cf.format_table(df, TARGET)
    assert out.columns == TARGET.names
    r = out.collect()[0]
    assert r.var_float == 0.0 and r.var_int_nullable is None and r.var_float_nullable is None
    assert r.var_string_nullable is None


def test_missing_required_date_raises(spark):
    df = spark.createDataFrame([(1,)], "var_int long")
    with pytest.raises(ValueError):
        cf.fill_missing(df, TARGET)


def test_reorder_drops_extras_and_casts(spark):
    df = spark.createDataFrame([("2020-01-02", 3.0, "x")], "d string, n double, extra string")
    sch = T.StructType([T.StructField("n", T.LongType(), False), T.StructField("d", T.DateType(), False)])
    out = cf.format_table(df, sch)
    assert out.columns == ["n", "d"] and out.collect()[0] == (3, dt.date(2020, 1, 2))


def test_fractional_to_long_raises(spark):
    df = spark.createDataFrame([(3.5,)], "n double")
    sch = T.StructType([T.StructField("n", T.LongType(), True)])
    with pytest.raises(Exception, match="fractional"):
        cf.format_table(df, sch).collect()


def test_null_in_required_raises(spark):
    df = spark.createDataFrame([(None,)], "n long")
    sch = T.StructType([T.StructField("n", T.LongType(), False)])
    with pytest.raises(Exception, match="required"):
        cf.format_table(df, sch).collect()


def test_rename(spark):
    df = spark.createDataFrame([(1, 2)], "a long, b long")
    assert cf.rename_strict(df, {"a": "x"}).columns == ["x", "b"]
    with pytest.raises(ValueError):
        cf.rename_strict(df, {"zz": "x"})
    assert cf.rename_lenient(df, {"zz": "x", "b": "y"}).columns == ["a", "y"]
    assert cf.add_suffix(df, "_1").columns == ["a_1", "b_1"]


def test_constants_and_vocabulary(spark):
    df = spark.createDataFrame([(1,)], "a long")
    out = cf.add_constants(df, {"n": 3, "s": "v"})
    assert dict(out.dtypes) == {"a": "bigint", "n": "double", "s": "string"}
    assert cf.set_vocabulary(out, "ICD10").collect()[0].vocabulary_id == "ICD10"


def test_keep_schema_columns(spark):
    df = spark.createDataFrame([(1, "x", "y")], "provider_id long, junk string, specialty_source_value string")
    assert cf.keep_schema_columns(df, schema("PROVIDER")).columns == ["provider_id", "specialty_source_value"]


def test_dense_key_is_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).alias("k"), F.lit("x").alias("v"))
    out = cf.dense_key(df, "key", ["k"], num_partitions=7).collect()
    assert sorted(r.key for r in out) == list(range(5000))
    assert all(r.key == r.k for r in out)
    one = cf.dense_key(df.limit(0), "key", ["k"])
    assert one.count() == 0


def test_dense_key_ties_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(1, x) for x in "dbca"] + [(0, "z")], "k long, v string")
    keys = [{r.v: r.key for r in cf.dense_key(df, "key", ["k"], num_partitions=n).collect()} for n in (1, 2, 5)]
    assert keys[0] == keys[1] == keys[2] == {"z": 0, "a": 1, "b": 2, "c": 3, "d": 4}
