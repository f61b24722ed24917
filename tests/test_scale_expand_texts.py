"""What the expansion of codes makes a row at a time."""

from collections import Counter

import pytest

from omoplate.operators import vocab as vo


@pytest.mark.parametrize("block", [2, 32_768])
def test_a_row_takes_one_text_and_its_vocabulary_lies_with_the_block(spark, monkeypatch, block):
    monkeypatch.setattr(vo, "ENTRIES_PER_BLOCK", block)
    kinds = {"CIE10ES": "ICD10CM", "CIE9MC": "ICD9CM", "OTHER": None, None: None}
    entries = [("P1", None if i % 7 == 0 else f"I{i % 5}", list(kinds)[i % 4]) for i in range(50)] + [("P2", None, None)]
    crosswalk = spark.createDataFrame(entries, "CODIGO_PATOLOGIA string, COD_CIE_NORMALIZADO string, TIPO_CIE string")
    df = spark.createDataFrame([(1, "P1"), (2, "P1"), (3, "P2"), (4, "P9"), (5, None)], "n long, code string")
    out = vo.icd_expand(df, "code", crosswalk)
    want = Counter()
    for n, code in map(tuple, df.collect()):
        want.update([(n, code, icd, kinds[kind]) for lc, icd, kind in entries if lc == code] or [(n, code, None, None)])
    assert out.columns == ["n", "code", "icd_code", "icd_vocabulary_id"]
    assert Counter(map(tuple, out.collect())) == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    made = next(x for x in plan.splitlines() if "Generate" in x)  # the last step
    assert "explode(_codes" in made and "inline" not in made
