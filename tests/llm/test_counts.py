"""Prefix token counts, the Merkle manifest and periodic runs against brute force."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import documents
from omoplate.llm import merkle, periodic, prefix_counts

BYTE = public_tokenizers.path("byte_bpe_50k.json")
BITS = ["a", "the", "ing", "'s", "'re", "'", "'ll", "LL", "'v", "  ", " ", "\n", "\t", " ", "\x85", "\x1c", "　", "᠎",
        "​", "1", "23", "²", "!", "!!", "...", "—", "é", "ß", "各个", "日本", "😀", "é", "<|endoftext|>", "<|endof", "|>",
        "tion", " =", "=====", " " * 17, "\r\n", "rawdownload", "embedreportprint", "''​"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(BYTE)
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


def test_every_prefix_as_the_library_counts_it(library):
    rng, own = random.Random(5), prefix_counts.PrefixCounter(BYTE, most=(40, 20, 50))  # memories that are soon full
    for _ in range(1500):
        text = "".join(rng.choice(BITS) for _ in range(rng.randint(0, 14)))
        want = [library(text[:n + 1]) for n in range(len(text))]
        assert own.counts(text) == want
        assert np.cumsum(np.frombuffer(own.steps(text), prefix_counts.STEP)).tolist() == want


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        prefix_counts.PrefixCounter(public_tokenizers.path("word_bpe_49k.json"))


def test_token_counts(spark, edge_rows, edge_docs, no_docs, library):
    got = prefix_counts.token_counts(edge_docs, BYTE, limit=50).collect()
    want = [(i, len((t or "").encode()), library(t or ""), library(t or "") > 50) for i, t in edge_rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert prefix_counts.token_counts(no_docs, BYTE).count() == 0


def test_questions_are_answered_from_the_steps(spark, library):
    texts = ["Some words, and don't <|endoftext|> stop   here \n ok", "rawdownloadcloneembedreportprint", "", "各个 é"]
    rows = [(i, t, n) for i, t in enumerate(texts) for n in (-1, 0, 1, 3, 7, 500, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int").select("*")
    table = prefix_counts.prefix_table(docs.dropDuplicates(["doc_id"]), BYTE).join(docs.select("doc_id", "n"), "doc_id")
    got = table.select("doc_id", "n", prefix_counts.tokens_of_prefix(F.col("steps"), F.col("n")),
                       prefix_counts.longest_prefix(F.col("steps"), F.col("n")),
                       prefix_counts.shortest_prefix(F.col("steps"), F.col("n"))).collect()
    assert len(got) == len(rows)
    for i, n, tokens, longest, shortest in got:
        text = texts[i]
        if n is None:
            assert (tokens, longest, shortest) == (None, None, None)
            continue
        counts = [library(text[:k]) for k in range(len(text) + 1)]
        assert tokens == counts[max(0, min(n, len(text)))]
        assert longest == max((k for k, c in enumerate(counts) if c <= n), default=0)
        assert shortest == next((k for k, c in enumerate(counts) if c >= n), None)
    one = table.filter("doc_id = 0 and n = 1").select(prefix_counts.longest_prefix(F.col("steps"), 3)).collect()[0][0]
    assert library(texts[0][:one]) <= 3 < library(texts[0][:one + 1])


# ---- Merkle manifest

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, more=0):
    values = [row[0], row[3], row[2], None if row[4] is None else row[4] + more, row[1]]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute_tree(leaves, fanout):
    """Root, and for each leaf its siblings level by level as (left, right)."""
    paths, level, places = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for i, p in enumerate(places):
            run = range(p - p % fanout, min(p - p % fanout + fanout, len(level)))
            paths[i].append(("".join(level[x] for x in run if x < p), "".join(level[x] for x in run if x > p)))
        level = [sha("".join(level[x:x + fanout])) for x in range(0, len(level), fanout)]
        places = [p // fanout for p in places]
    return level[0], paths


def brute_manifest(rows, fanout, tampered):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append(r)
    names = sorted(by_lang, key=lambda k: (k is not None, (k or "").encode()))
    trees = {}
    for k in names:
        by_lang[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[k] = brute_tree([leaf_of(r) for r in by_lang[k]], fanout)
    root, upper = brute_tree([trees[k][0] for k in names], fanout)
    out = []
    for k, above in zip(names, upper):
        for r, path in zip(by_lang[k], trees[k][1]):
            path = path + above
            node = leaf_of(r, 1 if tampered(r[0]) else 0)
            for left, right in path:
                node = sha(left + node + right)
            out.append((r[0], leaf_of(r), trees[k][0], root, sha("".join(a + b for a, b in path)), node, node == root))
    return sorted(map(str, out))


def manifest_rows():
    rng = random.Random(2)
    rows = [(i, f"text {i}" * (i % 5), rng.choice(["en", "en", "en", "de", "fr", "é", "Z"]), "s", 7 * i) for i in range(150)]
    rows += [(3, "other", "en", None, None), (3, "other", "en", None, None), (None, "x", "en", "s", 1), (None, None, "en", "s", None),
             (7, None, None, None, None), (8, "", "", "", 0), (9, "a" * 300_000, "lone", "s", 5)]
    return rows


@pytest.mark.parametrize("fanout, depth", [(2, 1), (2, 3), (2, 11), (3, 1), (3, 2)])
def test_manifest(spark, fanout, depth):
    rows = manifest_rows()
    docs = spark.createDataFrame([(*r, "k", "p", 1) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, grp string, leaf string, at int")
    bad = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    got = merkle.manifest(docs, fanout, depth, bad).collect()
    want = brute_manifest(rows, fanout, lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 0)
    assert sorted(str(tuple(r)) for r in got) == want
    assert {r["verified"] for r in got} == {True, False}


def test_manifest_of_little(spark, no_docs):
    assert merkle.manifest(no_docs).count() == 0
    one = spark.createDataFrame([(5, "t", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    row = merkle.manifest(one).collect()[0]
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["proof_sha256"] == sha("") and row["verified"]


# ---- periodic runs

def brute_runs(w, least=12):
    out = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(least, 2 * q):
                out.setdefault((s, i + q), q)
            i += i == s
    return sorted(((s, e - s, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def test_runs_of_random_words():
    rng = random.Random(11)
    for _ in range(1500):
        k = rng.choice([1, 2, 2, 3, 8])
        w = [rng.randrange(k) for _ in range(rng.randint(0, 120))]
        for _ in range(rng.randint(0, 3)):
            if w:
                a, p = rng.randrange(len(w)), rng.randint(1, 30)
                w = w[:a] + (w[a:a + p] * 10)[:rng.randint(0, 80)] + w[a + rng.randint(0, 5):]
        if rng.random() < 0.2:  # two runs of one period out of step: a run for every odd period around the place they meet
            w = [0, 1] * rng.randint(0, 30) + [0] * rng.randint(0, 2) + [1, 0] * rng.randint(0, 40) + w
        assert periodic.runs(np.array(w, np.int32)) == brute_runs(w)
        assert periodic.runs(np.array(w, np.int32), 20) == brute_runs(w, 20)


def test_long_repetitions_take_no_square_of_time():
    n = 100_000
    assert periodic.runs(np.zeros(n, np.int32)) == [(0, n, 1)]
    assert periodic.runs((np.arange(n) % 3).astype(np.int32)) == [(0, n, 3)]
    out_of_step = np.concatenate([np.arange(20_001) % 2, np.arange(20_000) % 2]).astype(np.int32)
    assert len(periodic.runs(out_of_step)) == 9_999  # odd periods from 7, the two runs themselves
    with pytest.raises(ValueError):
        periodic.runs(np.zeros(5, np.int32), 6)


def planted(words, doc_id):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def brute_row(doc_id, text, plant):
    words = (text or "").encode().split()
    if plant and doc_id is not None:
        words = planted(words, doc_id)
    found = brute_runs(words)
    gone = {x for s, n, q in found for x in range(s + q, s + n)}
    top = min(((-n, s, q) for s, n, q in found), default=None)
    best = (None,) * 4 if top is None else (top[1], -top[0], top[2], 1000 * -top[0] // top[2])
    return (doc_id, len(found), *best, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)),
            hashlib.sha256(b" ".join(w for x, w in enumerate(words) if x not in gone)).hexdigest())


@pytest.mark.parametrize("plant", [False, True])
def test_periodic_runs(spark, edge_rows, no_docs, plant):
    rows = [r for r in edge_rows if len(r[1] or "") < 12_000]
    rows += [(i, "one two three four five\n" * (i % 9) + "end", ) for i in range(100, 160)]
    got = periodic.periodic_runs(documents(spark, rows), plant).collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(str(brute_row(i, t, plant)) for i, t in rows)
    assert periodic.periodic_runs(no_docs, plant).count() == 0


def test_runs_of_very_long_texts(spark, edge_docs):
    rows = {r["doc_id"]: r for r in periodic.periodic_runs(edge_docs.filter("doc_id > 42")).collect()}
    assert (rows[43]["n_runs"], rows[43]["start"], rows[43]["length"], rows[43]["period"]) == (1, 0, 3000, 1)
    assert rows[43]["collapsed_sha256"] == sha("same") and rows[44]["collapsed_sha256"] == sha("same end")
