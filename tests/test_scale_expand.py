"""Expansion of codes with many entries: in blocks, dealt evenly."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from omoplate.operators import vocab as vo

CROSSWALK = "CODIGO_PATOLOGIA string, COD_CIE_NORMALIZADO string, TIPO_CIE string"


def _entries(spark):
    hot = [("P1", f"I{i % 13}", ("CIE10ES", "CIE9MC", "OTHER")[i % 3]) for i in range(40)]  # some are copies
    return spark.createDataFrame([*hot, ("P2", "J1", "CIE10ES"), ("P2", None, None), ("P3", "K1", "CIE9MC"), (None, "X", "CIE9MC"),
                                  *[("P4", "same", "CIE9MC")] * 9], CROSSWALK)


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("block", [1, 3, 32_768])
def test_blocks_lose_and_repeat_no_match(spark, monkeypatch, block, broadcast):
    codes = ["P1"] * 30 + ["P2", "P3", "P3", "P4", "P4", "P9", "P9", None, None]
    df = spark.createDataFrame(list(enumerate(codes)), "n long, code string")
    df = df.union(df.limit(3))  # equal rows
    monkeypatch.setattr(vo, "ENTRIES_PER_BLOCK", block)
    monkeypatch.setattr(vo, "ROWS_PER_TASK", 20)
    if not broadcast:
        monkeypatch.setattr(vo, "DEFAULT_BROADCAST_ROWS", 1)
    by_code, names = {}, {"CIE10ES": "ICD10CM", "CIE9MC": "ICD9CM"}
    for lc, icd, kind in _entries(spark).collect():
        by_code.setdefault(lc, []).append((icd, names.get(kind)))
    want = Counter((n, c, *e) for n, c in map(tuple, df.collect()) for e in (by_code.get(c) if c and c in by_code else [(None, None)]))
    out = vo.icd_expand(df, "code", _entries(spark))
    assert out.columns == ["n", "code", "icd_code", "icd_vocabulary_id"]
    assert Counter(map(tuple, out.collect())) == want


@pytest.mark.parametrize("broadcast", [True, False])
def test_hot_code_is_dealt_to_many_tasks(spark, monkeypatch, broadcast):
    """All rows lie in one partition and have one code: their results still spread over the tasks."""
    monkeypatch.setattr(vo, "ROWS_PER_TASK", 1_000, raising=False)
    if not broadcast:
        monkeypatch.setattr(vo, "DEFAULT_BROADCAST_ROWS", 1, raising=False)
    code = F.concat(F.lit("P"), (F.col("id") % 1 + 1).cast("string"))  # no literal, which would be a filter
    df = spark.range(400).select(F.col("id").alias("n"), code.alias("code")).coalesce(1)
    out = vo.icd_expand(df, "code", _entries(spark)).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in out) == 400 * 40
    assert len(out) >= 6 and max(r["count"] for r in out) <= 5_000


def test_wide_values_and_few_entries(spark):
    """Rows may hold columns that cannot be hashed; a crosswalk of few entries for a code is joined as it is."""
    df = spark.createDataFrame([("P2", {"a": 1}), ("P9", None)], "code string, more map<string,int>")
    few = _entries(spark).filter("CODIGO_PATOLOGIA <> 'P1'")
    out = vo.icd_expand(df, "code", few)
    assert sorted((r.code, r.icd_code or "") for r in out.collect()) == [("P2", ""), ("P2", "J1"), ("P9", "")]
    assert "Generate" not in out._jdf.queryExecution().optimizedPlan().toString()
    out = vo.icd_expand(df, "code", _entries(spark))
    assert sorted((r.code, r.icd_code or "") for r in out.collect()) == [("P2", ""), ("P2", "J1"), ("P9", "")]
    empty = vo.icd_expand(df, "code", _entries(spark).limit(0))
    assert sorted((r.code, r.icd_code or "") for r in empty.collect()) == [("P2", ""), ("P9", "")]
    assert vo.icd_expand(df.limit(0), "code", _entries(spark)).count() == 0
