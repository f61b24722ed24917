"""The pipeline against its stages done by hand, on a small table."""

import random
from collections import Counter

import pytest

import corpus_pipeline
from conftest import documents
from omoplate.llm import queries
from omoplate.llm.simhash import fingerprint
from omoplate.llm.toxicity import toxicity_scores
from test_dedup import components_by_hand
from test_scans import base_by_hand


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice(["re", "an", "tion", "wh", "ed", "ly"]) for _ in range(rng.randint(1, 4)))
    rows, labels = [], []
    for i in range(260):
        words = [word() for _ in range(rng.randint(30, 80))]
        bad = i % 5 == 0
        if bad:
            words[3], words[9], words[17] = "idiot", "scum", "moron"
        if i % 7 == 0:
            words[5] = f"password={i:016d}"
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad), 1))
    rows += [(300, rows[1][1]), (301, rows[2][1]), (302, rows[1][1]), (303, None), (304, "")]
    long = [word() for _ in range(5000)]
    rows += [(305, " ".join(long)), (306, " ".join(long[:450] + ["other"] + long[451:]))]
    path = tmp_path_factory.mktemp("pipeline")
    documents(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{path}/labels.parquet")
    return str(path), rows


def test_stages(spark, folder):
    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, path))
        seen[name] = docs.collect()
        if name != "packing":
            assert docs.columns == columns
    texts = dict(rows)
    kept = {r.doc_id for r in seen["toxicity"]}
    scores = toxicity_scores(spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet"))
    assert kept == {r.doc_id for r in scores.collect() if not r.predicted}
    assert len(kept ^ {i for i, t in rows if "idiot" not in (t or "")}) <= 0.04 * len(rows)
    best = {}
    for i in kept:
        best[texts[i] or ""] = max(best.get(texts[i] or "", i), i)
    kept = set(best.values())
    assert {r.doc_id for r in seen["exact_dedup"]} == kept and 300 not in kept and 301 in kept
    order = sorted(kept)
    fps = [fingerprint(texts[i] or "") for i in order]
    of = components_by_hand([(a, b) for a in range(len(fps)) for b in range(a, len(fps)) if (fps[a] ^ fps[b]).bit_count() <= 4])
    kept = {i for n, i in enumerate(order) if of[n] == n}
    assert {r.doc_id for r in seen["near_dedup"]} == kept and 305 in kept and 306 not in kept
    masked = {r.doc_id: r.text for r in seen["secrets"]}
    assert set(masked) == kept
    for i in kept:
        assert ("[SECRET]" in (masked[i] or "")) == bool(base_by_hand(texts[i] or ""))
    assert {r.doc_id for r in seen["packing"]} == kept
    assert Counter(tuple(r)[:5] for r in corpus_pipeline.run(spark, path).collect()) == Counter(tuple(r)[:5] for r in seen["packing"])


def test_names():
    assert len(queries.QUERIES) == 13 and set(queries.ORACLE_SQL) <= set(queries.QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "secrets", "packing"]
