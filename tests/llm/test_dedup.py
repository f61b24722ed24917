"""Exact, SimHash and substring deduplication against brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from conftest import documents
from omoplate.llm import exact_dedup, simhash, superkmer
from omoplate.llm.components import connected_components


def rows_of(df):
    return Counter(map(tuple, df.collect()))


# -- exact -----------------------------------------------------------------------

def exact_by_hand(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return Counter((i, keep[t or ""], len(groups[t or ""]), i == keep[t or ""],
                    hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)


@pytest.mark.parametrize("moduli, long_bytes", [(exact_dedup.MODULI, exact_dedup.LONG_BYTES),
                                                (exact_dedup.MODULI, 100), (((3, 2), (2, 1)), 1000)])
def test_exact_groups(edge_docs, edge_rows, moduli, long_bytes):
    """Also with every longer text in parallel chunks, and with fingerprints that collide all the time."""
    got = exact_dedup.exact_groups(edge_docs, moduli, long_bytes)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert rows_of(got) == exact_by_hand(edge_rows)


#: equally long different texts under a null and a repeated doc_id, each with a copy elsewhere
SAME_LENGTH = [(None, "ab"), (None, "cd"), (7, "ab"), (None, "ef"), (None, "ef"), (5, "gh"), (5, "ij"), (5, "kl"), (9, "ij"), (3, "kl")]


@pytest.mark.parametrize("moduli", [exact_dedup.MODULI, ((3, 2), (2, 1))])
def test_exact_groups_of_equally_long_texts(spark, monkeypatch, moduli):
    tables = []

    def bounded(df):
        tables.append(df)
        assert len(tables) < 25, "the rounds do not end"
        return cut_lineage(df)

    cut_lineage = exact_dedup.cut_lineage
    monkeypatch.setattr(exact_dedup, "cut_lineage", bounded)
    assert rows_of(exact_dedup.exact_groups(documents(spark, SAME_LENGTH), moduli)) == exact_by_hand(SAME_LENGTH)


def test_exact_empty_table(no_docs):
    assert exact_dedup.exact_groups(no_docs).count() == 0
    assert exact_dedup.drop_copies(no_docs).count() == 0


def test_drop_copies(edge_docs, edge_rows):
    got = exact_dedup.drop_copies(edge_docs)
    assert got.columns == edge_docs.columns
    best = {}
    for i, t in edge_rows:
        best[t or ""] = max((x for x in (best.get(t or ""), i) if x is not None), default=None)
    assert Counter((r.doc_id, r.text or "") for r in got.collect()) == Counter((i, t) for t, i in best.items())


def test_drop_copies_keeps_every_distinct_text(spark):
    rows = [(5, "ab"), (5, "cde"), (7, "ab"), (8, "x"), (8, "y"), (8, "y"), (None, "p"), (None, "q"), (None, "q"), (None, "cde")]
    got = exact_dedup.drop_copies(documents(spark, rows))
    assert rows_of(got.select("doc_id", "text")) == Counter([(5, "cde"), (7, "ab"), (8, "x"), (8, "y"), (None, "p"), (None, "q")])


def test_hashes_compose():
    poly = exact_dedup.Polynomials()
    data = bytes(np.random.default_rng(0).integers(0, 256, 100_001, dtype=np.uint8))
    parts = [poly.shifted(data[a:a + poly.chunk], max(0, len(data) - a - poly.chunk)) for a in range(0, len(data), poly.chunk)]
    assert [sum(x) % p for x, (p, _) in zip(zip(*parts), poly.moduli)] == poly.of_text(data)


# -- components ------------------------------------------------------------------

def components_by_hand(edges):
    up = {x: x for e in edges for x in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}


def test_connected_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))]
    edges += [(1000 + i, 1001 + i) for i in range(40)] + [(5000, i) for i in range(2000, 2100)] + edges[:20]
    df = spark.createDataFrame([*edges, (None, 3), (7, None)], "a long, b long")
    assert dict(map(tuple, connected_components(df).collect())) == components_by_hand(edges)
    assert connected_components(df.limit(0)).count() == 0


# -- SimHash ---------------------------------------------------------------------

def fingerprint_by_hand(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if counts[b] * 2 > len(shingles))


@pytest.mark.parametrize("tile, block", [(simhash.TILE, simhash.BLOCK), (4, 2)])
def test_simhash_groups(edge_docs, edge_rows, tile, block):
    fps = [fingerprint_by_hand(t) for _, t in edge_rows]
    links = [(a, b) for a in range(len(fps)) for b in range(a, len(fps)) if (fps[a] ^ fps[b]).bit_count() <= 4]
    of = components_by_hand(links)
    least = {}
    for n, (i, _) in enumerate(edge_rows):
        if i is not None:
            least[of[n]] = min(least.get(of[n], i), i)
    want = Counter((i, f"{f:016x}", least.get(of[n])) for n, ((i, _), f) in enumerate(zip(edge_rows, fps)))
    assert rows_of(simhash.simhash_groups(edge_docs, tile=tile, block=block)) == want


def near_texts():
    """a - b - c in a chain whose ends are not near, and x far from all."""
    rng = np.random.default_rng(3)
    base = [f"w{n}" for n in rng.integers(0, 10 ** 6, 300)]
    fp = lambda words: fingerprint_by_hand(" ".join(words))
    far = lambda p, q: (p ^ q).bit_count()
    while True:
        b, c = list(base), list(base)
        for n in rng.integers(0, 300, 8):
            b[n] = c[n] = f"b{n}"
        for n in rng.integers(0, 300, 12):
            c[n] = f"c{n}"
        if far(fp(base), fp(b)) <= 4 and far(fp(b), fp(c)) <= 4 and far(fp(base), fp(c)) > 4:
            return [" ".join(t) for t in (base, b, c)] + ["unlike any of the others in every way " * 3]


def test_rows_without_a_doc_id_connect(spark):
    a, b, c, x = near_texts()
    rows = [(1, a), (None, b), (2, c), (None, x)]
    got = simhash.simhash_groups(documents(spark, rows)).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (None, 1), (2, 1), (None, None)}
    kept = simhash.drop_near_copies(documents(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(1, a), (0, x)])


def test_repeated_doc_ids_of_unlike_texts(spark):
    a, b, _, x = near_texts()
    rows = [(5, a), (0, b), (5, x), (9, x), (None, x), (None, None), (None, "")]
    got = simhash.simhash_groups(documents(spark, rows)).collect()
    assert Counter((r.doc_id, r.component_id) for r in got) == Counter(
        [(5, 0), (0, 0), (5, 5), (9, 5), (None, 5), (None, None), (None, None)])
    kept = simhash.drop_near_copies(documents(spark, rows)).collect()
    assert len(kept) == 3 and {(0, b), (5, x)} < {(r.doc_id, r.text) for r in kept}
    assert [r.text or "" for r in kept if r.doc_id is None] == [""]


def test_simhash_empty_and_drop(edge_docs, no_docs):
    assert simhash.simhash_groups(no_docs).count() == 0
    got = simhash.drop_near_copies(edge_docs)
    assert got.columns == edge_docs.columns
    marks = simhash.simhash_groups(edge_docs).collect()
    known = {r.component_id for r in marks} - {None}
    kept = Counter(r.doc_id for r in got.collect())
    fps = {int(r.fingerprint, 16) for r in marks if r.component_id is None}
    alone = components_by_hand([(a, b) for a in fps for b in fps if (a ^ b).bit_count() <= 4])
    assert kept == Counter([*known, *[None] * len(set(alone.values()))])


def test_tile_links_connect_what_all_links_connect():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    fps = np.unique(np.concatenate([base ^ np.uint64(1 << int(k)) for k in rng.integers(0, 60, 40)]))
    i, j = simhash.tile_links(fps, None, 4, 16)
    got = components_by_hand([*zip(i.tolist(), j.tolist()), *((k, k) for k in range(len(fps)))])
    near = np.argwhere(np.bitwise_count(fps[:, None] ^ fps) <= 4)
    assert got == components_by_hand([tuple(x) for x in near.tolist()])
    half = len(fps) // 2
    i, j = simhash.tile_links(fps[:half], fps[half:], 0, 8)
    assert len(i) == 0


# -- substrings ------------------------------------------------------------------

def repeats_by_hand(rows, k):
    big = float("inf")
    low = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for j in range(len(w) - k + 1):
            x = tuple(w[j:j + k])
            low[x] = min(low.get(x, big), big if i is None else i)
    out = Counter()
    for i, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for j in range(len(w) - k + 1):
            if low[tuple(w[j:j + k])] < (big if i is None else i):
                gone[j:j + k] = [True] * k
        out[i, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()] += 1
    return out


@pytest.mark.parametrize("k, chunk, bucket", [(13, 1 << 20, 1 << 20), (3, 20_000, 20_000)])
def test_remove_repeats(edge_docs, edge_rows, k, chunk, bucket):
    want = repeats_by_hand(edge_rows, k)
    assert sum(n for _, _, n, _ in want) > 0
    assert rows_of(superkmer.remove_repeats(edge_docs, k, chunk, bucket)) == want


def test_rows_without_or_with_one_doc_id_are_spread(spark):
    """No chunk gets them all, and the answers are those of brute force."""
    rng = np.random.default_rng(4)
    text = lambda: " ".join(f"w{x}" for x in rng.integers(0, 12, 40))
    rows = [(i, text()) for i in [None] * 60 + [8] * 60 + list(range(20))]
    docs = documents(spark, rows)
    chunks = superkmer.dealt_texts(docs, 16).groupBy("chunk").count().collect()
    assert len(chunks) > 8 and max(r["count"] for r in chunks) < 50
    assert rows_of(superkmer.remove_repeats(docs, 3, 1500, 1500)) == repeats_by_hand(rows, 3)


def test_least_two():
    x = np.random.default_rng(5).integers(0, 6, 200).astype(np.uint64)
    for span in (1, 2, 3, 7, 12):
        a, b = superkmer.least_two(x, span)
        want = [sorted(set(x[i:i + span].tolist())) + [int(superkmer.TOP)] for i in range(len(x) - span + 1)]
        assert a.tolist() == [w[0] for w in want] and b.tolist() == [w[1] for w in want]


def test_windows_of_a_frequent_pair_are_split(spark):
    """No bucket key holds them all, and the answers are those of brute force at every level of splitting."""
    rng = np.random.default_rng(6)
    frequent = min((f"f{i} g" for i in range(4000)), key=lambda p: superkmer.least_two(_pair_hashes(p), 1)[0][0])
    rows = [(i, " ".join([*(f"w{x}" for x in rng.integers(0, 900, 8)), frequent, *(f"w{x}" for x in rng.integers(0, 900, 8))]))
            for i in range(150)]
    rows += [(200 + i, rows[i][1]) for i in range(20)] + [(None, rows[30][1]), (300, "same " * 400), (301, "same " * 40)]
    docs, k, most = documents(spark, rows), 13, 60

    def largest(heavy):
        c = superkmer.Chunk([i for i, _ in rows], [t for _, t in rows], k)
        c.superkmers(heavy)
        windows = Counter()
        for text, key in zip(c.text, c.bucket_key.tolist()):
            windows[key] += len(text.split()) - k + 1
        return max(windows.values())

    heavy, n_bytes = superkmer.heavy_keys(docs, k, most)
    assert n_bytes == sum(len(t) for _, t in rows)
    none = np.zeros(0, np.uint64)
    assert len(heavy[0]) and largest((none, none)) > 800 and largest(heavy) <= most
    want = repeats_by_hand(rows, k)
    for most in (0, 3, 60):
        assert rows_of(superkmer.remove_repeats(docs, k, 2000, 2000, heavy_windows=most)) == want


def test_words_and_their_hashes(monkeypatch):
    """Words as bytes are split at the six white spaces, and equal words hash alike wherever they lie."""
    monkeypatch.setattr(superkmer, "HASH_BYTES", 16)
    texts = ["", " \t\n\x0b\x0c\r", "  a\u00a0b  c\r\nd", "x" * 40 + " a " + "x" * 40, "\u2003a", "a c", "\x1c\x85"]
    c = superkmer.Chunk(list(range(len(texts))), texts, 13)
    words = [t.encode().split() for t in texts]
    assert c.counts.tolist() == [len(w) for w in words]
    flat = [w for own in words for w in own]
    assert [c.slice(i, 1) for i in range(c.n_words)] == flat
    hashes = superkmer.word_hashes(c.bytes, c.at).tolist()
    assert len(set(zip(flat, hashes))) == len(set(flat)) == len(set(hashes))


def test_heavy_keys_are_counted_over_pieces(spark, monkeypatch):
    """A key is found by its sum over tasks and pieces, by as much as the pieces leave out too low."""
    monkeypatch.setattr(superkmer, "COUNT_BYTES", 200)
    monkeypatch.setattr(superkmer, "PIECE_BYTES", 400)
    docs = documents(spark, [(i, "same " * 60) for i in range(40)] + [(99, " ".join(f"w{i}" for i in range(500)))])
    (low, two), _ = superkmer.heavy_keys(docs.repartition(4), 13, 40 * 48 - 1)
    assert len(low) == len(two) == 1
    assert [len(x) for x in superkmer.heavy_keys(docs, 13, 40 * 48)[0]] == [0, 0]


def _pair_hashes(text):
    c = superkmer.Chunk([1], [text], superkmer.SEED_WORDS)
    c.windows()
    return c.low


def test_remove_repeats_empty(no_docs):
    assert superkmer.remove_repeats(no_docs).count() == 0


def test_window_lows_with_colliding_hashes(monkeypatch):
    texts = [b"a b c d e", b"b c d", b"c d e f", b"x y z"]
    low = np.array([5, 3, 4, 9])
    want = superkmer.window_lows(texts, low, 3)
    assert want[1].tolist() == [5, 3, 4, 3, 4, 4, 9]
    monkeypatch.setattr(superkmer, "_mixed", lambda x: np.zeros_like(x))
    assert superkmer.window_lows(texts, low, 3)[1].tolist() == want[1].tolist()
