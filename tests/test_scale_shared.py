"""Work that several tables need is done once, and tables that do not need each other are built side by side."""

import datetime as dt
import threading

import pytest

from omoplate.operators import quality, visits
from omoplate.plans import registry
from omoplate.session import side_by_side
from omoplate.sources import testdata as td

SF = "/root/testdata/sf0.001"


def test_builds_run_at_a_time_and_keep_their_order(spark):
    meet = threading.Barrier(2, timeout=60)  # breaks unless two run together
    counted = lambda n: (meet.wait(), spark.range(n).count())[1]
    assert side_by_side(spark, [lambda n=n: counted(n) for n in (5, 3, 9, 1)], 2) == [5, 3, 9, 1]
    done = []
    with pytest.raises(ZeroDivisionError):
        side_by_side(spark, [lambda: 1 // 0, lambda: done.append(spark.range(4).count())], 2)
    assert done == [4]


def test_constraints_join_lines_and_reduce_visits_once(spark, monkeypatch):
    calls = []
    for module, name in ((visits, "unique_visits"), (td, "shipped_lines"), (td, "clinical_records")):
        monkeypatch.setattr(module, name, lambda *a, f=getattr(module, name), n=name, **k: (calls.append(n), f(*a, **k))[1])
    assert registry.q_cdm_constraints(spark, SF).count() > 0
    assert sorted(calls) == ["clinical_records", "shipped_lines", "unique_visits"]


@pytest.mark.parametrize("bound", [0, 2_000_000])
def test_ready_visits_link_as_visits_do(spark, bound):
    vs = td.order_visits(spark, SF)
    events = td.clinical_records(spark, SF).select("person_id", "start_date", "l_partkey")
    ready = visits.ready_visits(vs)
    link = lambda v: visits.link_visits(events, ["person_id", "start_date", "l_partkey"], v, max_broadcast_rows=bound)
    want, got = link(vs), link(ready)
    assert want.filter("visit_occurrence_id IS NOT NULL").count() > 0
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    with pytest.raises(ValueError, match="visits lack"):
        visits.ready_visits(vs.drop("person_id"))


def test_lives_beyond_the_bound_are_hashed_not_sorted(spark, monkeypatch):
    day = dt.date
    person = spark.createDataFrame([(1, dt.datetime(2000, 1, 1)), (2, dt.datetime(2010, 1, 1))], "person_id long, birth_datetime timestamp_ntz")
    death = spark.createDataFrame([(1, day(2005, 1, 1)), (1, day(2004, 1, 1))], "person_id long, death_date date")
    rows = [(1, day(1999, 1, 1), day(2004, 6, 1)), (1, day(2004, 2, 1), day(2004, 2, 2)), (2, day(2010, 1, 1), day(2009, 1, 1)),
            (3, None, day(2009, 1, 1)), (None, day(1900, 1, 1), day(1900, 1, 1))]
    seen = spark.createDataFrame(rows, "person_id long, observation_period_start_date date, observation_period_end_date date")
    tables = {"PERSON": person, "DEATH": death, "OBSERVATION_PERIOD": seen}
    want = {("date", "OBSERVATION_PERIOD", rule, None, 1) for rule in quality.RULES}
    assert {tuple(r) for r in quality.date_checks(tables).collect()} == want
    monkeypatch.setattr(quality, "fits", lambda df: False, raising=False)
    monkeypatch.setattr(quality, "broadcast_if_small", lambda df: df, raising=False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = quality.date_checks(tables)
        assert {tuple(r) for r in out.collect()} == want
        assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
