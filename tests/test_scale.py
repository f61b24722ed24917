"""Steps that must not shuffle or write the data more than the job needs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from omoplate import session
from omoplate.operators import conform, vocab
from omoplate.operators.visits import link_visits
from omoplate.plans import events as ev

START = dt.datetime(2024, 1, 1)


def records(spark, seed, n=300):
    rng = random.Random(seed)
    rows = [(rng.choice([None, 1, 1, 1, 2, 3, 4, 5]), START + dt.timedelta(hours=rng.randrange(400)) if rng.random() < 0.95 else None,
             rng.choice("abc"), rng.randrange(3)) for _ in range(n)]
    days = [(i, rng.choice([1, 2, 3, 9]), START + dt.timedelta(hours=(h := rng.randrange(400))), START + dt.timedelta(hours=h + rng.randrange(60)))
            for i in range(40)]
    return (spark.createDataFrame(rows, "person_id long, start_date timestamp_ntz, source string, kind int"),
            spark.createDataFrame(days, "visit_occurrence_id long, person_id long, visit_start_datetime timestamp_ntz, visit_end_datetime timestamp_ntz"))


@pytest.mark.parametrize("how", [{}, {"max_broadcast_rows": 0}, {"max_broadcast_rows": 0, "block_rows": 30}, {"block_rows": 30}])
@pytest.mark.parametrize("linked", [True, False])
def test_numbers_by_person_are_those_of_a_dense_key(spark, how, linked):
    df, visits = records(spark, 5 + len(how))
    order = ["person_id", "start_date", "source"]
    if linked:
        want = conform.dense_key(link_visits(df, ["person_id", "start_date", "person_id"], visits), "key", order)
    else:
        want = conform.dense_key(df.withColumn("visit_occurrence_id", F.lit(None).cast("long")), "key", order)
    got = ev.key_and_link(df, "key", order, visits if linked else None, **how)
    assert got.dtypes == want.dtypes
    assert sorted(got.collect(), key=lambda r: r.key) == sorted(want.collect(), key=lambda r: r.key)


def test_rows_before_over_partitions(spark):
    counts = spark.createDataFrame([(k, k % 4 + 1) for k in range(50)], "k long, _n long")
    for n in (1, 6):
        got = {r.k: r._before for r in conform.rows_before(counts, "k", n).collect()}
        assert got == {k: sum(i % 4 + 1 for i in range(k)) for k in range(50)}


def test_events_are_not_written_to_be_numbered(spark):
    df, visits = records(spark, 1)
    known = df.filter("person_id IS NOT NULL")
    before = session.tables_made()
    out = ev.key_and_link(known, "key", ["person_id", "start_date"], visits, max_broadcast_rows=0)
    assert not [p for p in session._made[before:] if "source" in spark.read.parquet(p).columns]
    plan = out._jdf.queryExecution().executedPlan().toString()
    rows = [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x and "_e" not in x]
    assert not [x for x in rows if "source" in x], plan  # one exchange by person links and numbers them


def test_a_small_lookup_does_not_shuffle_the_data(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([("a", 1), ("b", 2)], "code string, n int")
        table = spark.createDataFrame([("a", "x")], "c string, v string")
        out = vocab.apply_value_lookup(df, table, "code", "c", "v", "found")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert sorted(map(tuple, out.collect())) == [("a", 1, "x"), ("b", 2, None)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_the_report_of_unmapped_values_writes_nothing(spark):
    df = spark.createDataFrame([("a", 1, 0), ("a", 1, 5), ("a", 1, 5), ("b", 2, 7), (None, 3, 0), ("c", None, None)],
                               "value string, source long, concept long")
    before = session.tables_made()
    out = vocab.unmapped_summary(df, "value", "source", "concept", [])
    assert session.tables_made() == before
    values = vocab.find_unmapped_values(df, "value", "concept")
    want = vocab.report_unmapped(df, values, "value", "source", "concept", [])
    assert sorted(map(str, out.collect())) == sorted(map(str, want.collect())) and out.count() == 3
