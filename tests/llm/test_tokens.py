"""Token files, distinct-word encoding and packing against the tokenizers library."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from omoplate.llm import packing, token_files, tokens, word_table

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
TRICKY = ["a b", "  a  b ", "x \n y\n\n z", " lead", "trail ", "a b c\x1c d \x85 e", "é̈ a <|endoftext|> b<|endoftext|>", "", "  ",
          "don't  we'll 12 34  \t q", "ΑΣ Σ İ ﬁ 各 个", "a  b  c", "a\x0b \x0cb"]


def ids_by_library(path, text):
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t.encode(text or "", add_special_tokens=False).ids


def packed(ids):
    return np.array(ids, "<u4").tobytes()


@pytest.mark.parametrize("path, pieces", [(WORD, tokens.words), (BYTE, tokens.spaced_words)])
def test_piecewise_ids(path, pieces, edge_rows):
    coder = tokens.PieceEncoder(path, pieces)
    for text in TRICKY + [t or "" for _, t in edge_rows]:
        assert coder.ids(text) == packed(ids_by_library(path, text))


@pytest.mark.parametrize("path, pieces", [(WORD, tokens.words), (BYTE, tokens.spaced_words)])
def test_simple_words_as_the_library_has_them(path, pieces):
    coder = tokens.PieceEncoder(path, pieces)
    assert coder.straight is not None
    letters = "".join(map(chr, [*range(65, 91), *range(97, 123), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))
    marks = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
    text = " ".join([*letters, *("w" + m for m in marks), "word...", "a'b", "don't", "x" + marks, letters, "Das Straßen-Café, ØRE!"])
    assert coder.ids(text) == packed(ids_by_library(path, text))


def test_kept_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "MOST_PIECES", 3)
    monkeypatch.setattr(tokens, "MOST_LETTERS", 2)
    coder = tokens.PieceEncoder(WORD, tokens.words)
    for text in ("a b c d e", "f g", "h a i", "a"):
        assert coder.ids(text) == packed(ids_by_library(WORD, text))


@pytest.mark.parametrize("n", [1, 7, 1024, 1025, 300_000])
@pytest.mark.parametrize("high", [1, 2, 50_000, 2 ** 32 - 1])
def test_blocks_round_trip(n, high):
    ids = (np.random.default_rng(n).pareto(1, n) * high / 50).clip(0, high).astype(np.uint32)
    assert (token_files.unpack(token_files.pack(ids)) == ids).all()


def test_file_reads_any_run_of_ids(tmp_path):
    rng = np.random.default_rng(0)
    docs = [(i if i != 2 else None, rng.integers(0, 49_000, n).astype("<u4")) for i, n in enumerate([0, 5, 3000, 1, 1024, 600_000])]
    out = token_files.FileWriter(f"file://{tmp_path}/x/a.ids")
    for i, ids in docs:
        out.add(i, ids.tobytes())
    out.close()
    reader = token_files.FileReader(f"file://{tmp_path}/x/a.ids")
    assert [(i, d) for i, d in reader.documents()] == [(i, x.tobytes()) for i, x in docs]
    flat = np.concatenate([x for _, x in docs])
    for first, n in ((0, 1), (1023, 2), (5000, 10_000), (len(flat) - 3, 3), (7, 0)):
        assert (reader.ids(first, n) == flat[first:first + n]).all()


def test_token_file_rows(edge_docs, edge_rows, no_docs):
    at, want = 0, []
    for i, t in sorted(edge_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = packed([*ids_by_library(WORD, t), 1])
        want.append((i, at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    assert Counter(map(tuple, token_files.token_file_rows(edge_docs, WORD).collect())) == Counter(want)
    assert token_files.token_file_rows(no_docs, WORD).count() == 0


@pytest.mark.parametrize("chunk, bucket", [(1 << 20, 1 << 20), (20_000, 20_000)])
def test_encode_decode(edge_docs, edge_rows, no_docs, chunk, bucket):
    library, want = Tokenizer.from_file(WORD), Counter()
    for i, t in edge_rows:
        ids = ids_by_library(WORD, t)
        text = library.decode(ids, skip_special_tokens=False)
        want[i, len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    got = word_table.encode_decode_digests(edge_docs, WORD, chunk, bucket)
    assert Counter(map(tuple, got.collect())) == want
    assert word_table.encode_decode_digests(no_docs, WORD).count() == 0
    ids = {r.doc_id: r.ids for r in word_table.encode_decode(edge_docs, WORD, chunk, bucket).collect()}
    assert ids[43] == packed(ids_by_library(WORD, "same " * 3000))


def test_pack_histogram_keeps_counts_and_room():
    rng = np.random.default_rng(1)
    counts = Counter(rng.integers(1, 1025, 5000).tolist())
    patterns = packing.pack_histogram(counts)
    assert all(sum(p) <= 1024 for p, _ in patterns)
    used = Counter()
    for p, n in patterns:
        for length in p:
            used[length] += n
    assert used == counts
    assert sum(n for _, n in patterns) * 1024 < 1.02 * sum(k * n for k, n in counts.items())
    assert packing.pack_histogram({}) == []


def test_pack_documents(edge_docs, edge_rows, no_docs):
    rows = packing.pack_documents(edge_docs, BYTE).collect()
    want = Counter()
    for i, t in edge_rows:
        ids = [*ids_by_library(BYTE, t), 0]
        for a in range(0, len(ids), 1024):
            want[i, a, len(ids[a:a + 1024]), zlib.crc32(packed(ids[a:a + 1024])), len(ids)] += 1
    assert Counter(tuple(r)[:5] for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack_documents(no_docs, BYTE).count() == 0
