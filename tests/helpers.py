import datetime as dt

from pyspark.sql import types as T


def ts(s):
    if s is None:
        return None
    if len(s) == 10:
        return dt.datetime.fromisoformat(s)
    return dt.datetime.fromisoformat(s)


INTERVAL_SCHEMA = T.StructType([
    T.StructField("person_id", T.LongType()),
    T.StructField("start_date", T.TimestampNTZType()),
    T.StructField("end_date", T.TimestampNTZType()),
    T.StructField("visit_type", T.StringType()),
])


def intervals(spark, rows, schema=INTERVAL_SCHEMA):
    return spark.createDataFrame([(p, ts(s), ts(e), *rest) for p, s, e, *rest in rows], schema)
