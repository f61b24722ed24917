"""Exact token counts of every prefix of a text, by dynamic programming over prefixes.

The tokens of a byte-pair encoding are the one way to cut a text in which
every two neighbours, encoded together, stay apart as they are. So the last
token of a prefix is the one token that ends there and agrees with the last
token of what is before it, and the prefix's count is one more than that
shorter prefix's. An automaton over the vocabulary lists the tokens that
end at each place; a text is passed once however long its words are.

A tokenizer first cuts a text, and a prefix of a text may be cut otherwise
than the text: white space at a prefix's end stays together, a contraction
or special token that is not complete is ordinary text. The counts are those
of each prefix on its own.

A text is cut at single spaces, across which no token goes, and the counts
within a piece are kept; a text's are joined from those of its pieces. They
are stored as the step from each character to the next, and questions on
truncation and budgets are answered from the steps alone.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator
from itertools import accumulate
from operator import sub

import ahocorasick
import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from omoplate.llm.common import doc_texts, ready, table
from omoplate.llm.tokens import BEFORE, SIMPLE, Memory, byte_alphabet, spaced_words

LIMIT = 512
#: Entries of a worker's newer memory of pieces, and of letters, an older one as large is kept beside it; and of
#: token pairs. About 300 MB a worker at most.
MOST_PIECES = 400_000
MOST_LETTERS = 200_000
MOST_PAIRS = 600_000
STEP = np.dtype("<i2")
#: Contractions of two letters that byte-level pre-tokenizers keep in one cut (fixed values).
LONG_CONTRACTIONS = ("'re", "'ve", "'ll")


def _as_steps(counts: list[int]) -> bytes:
    """Raises OverflowError if a step takes more than 15 bits; tokens have 128 bytes at most."""
    return array("h", map(sub, counts, [0, *counts[:-1]])).tobytes()


class PrefixCounter:
    """Counts by the ``tokenizers`` library's byte-level vocabulary at ``path``."""

    def __init__(self, path: str, most: tuple[int, int, int] = (MOST_PIECES, MOST_LETTERS, MOST_PAIRS)):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        whole.no_truncation()
        whole.no_padding()
        if type(whole.pre_tokenizer).__name__ != "ByteLevel" or whole.normalizer is not None:
            raise ValueError(f"{path} is not a plain byte-level vocabulary")
        self.cutter, self.model = whole.pre_tokenizer, whole.model
        self.special = sorted((t.content for t in whole.get_added_tokens_decoder().values()), key=len, reverse=True)
        special = set(self.special)
        self.alphabet = byte_alphabet()
        back = {c: chr(b) for b, c in self.alphabet.items()}
        self.automaton = ahocorasick.Automaton()  # over bytes as the characters below 256
        for token, i in whole.get_vocab(with_added_tokens=False).items():
            if token not in special:
                self.automaton.add_word("".join(back[c] for c in token), (len(token), i))
        self.automaton.make_automaton()
        self.pieces, self.letters = Memory(most[0]), Memory(most[1])
        self.pairs: dict[int, bool] = {}
        self.most_pairs = most[2]
        self.blank: dict[str, bool] = {}

    def _apart(self, pair: int) -> bool:
        """True if the text of the two tokens, the first times 2^24 plus the second, is encoded as these two."""
        a, b = pair >> 24, pair & 0xFFFFFF
        text = self.model.id_to_token(a) + self.model.id_to_token(b)
        if len(self.pairs) >= self.most_pairs:
            self.pairs.clear()
        known = self.pairs[pair] = [t.id for t in self.model.tokenize(text)] == [a, b]
        return known

    def _model_counts(self, text: str) -> list[int]:
        """Counts of every prefix, in characters, of a text that is encoded in one go."""
        raw = text.encode().decode("latin-1")
        count, last, known = [], [], self.pairs.get  # last: the last token of the prefix that ends here
        at = 0
        for end, (size, token) in self.automaton.iter(raw):  # of one end, the longest token first
            if end == at:
                before = end - size
                if before < 0:
                    last.append(token)
                    count.append(1)
                    at += 1
                else:
                    pair = last[before] << 24 | token
                    apart = known(pair)
                    if apart or apart is None and self._apart(pair):
                        last.append(token)
                        count.append(count[before] + 1)
                        at += 1
        if len(raw) == len(text):
            return count
        # a character ends at the byte before the next that is not a continuation
        ends = [x for x in range(len(raw)) if x + 1 == len(raw) or not "\x80" <= raw[x + 1] < "\xc0"]
        return [count[x] for x in ends]

    def _cut_counts(self, text: str) -> list[int]:
        """The same for a text that the pre-tokenizer sees as one cut."""
        return list(accumulate(array("h", self._cut_steps(text))))

    def _cut_steps(self, text: str) -> bytes:
        known = self.letters.seek(text)
        if known is None:
            known = _as_steps(self._model_counts(text))
            if len(text) <= 64:
                self.letters.make_room(1)
                self.letters.fresh[text] = known
        return known

    def _is_blank(self, c: str) -> bool:
        """White space as the pre-tokenizer has it: two of it are not kept together before a letter."""
        known = self.blank.get(c)
        if known is None:
            cuts = [at for _, at in self.cutter.pre_tokenize_str("a" + c + c + "a")]
            known = self.blank[c] = (1, 2) in cuts
        return known

    def _plain_counts(self, text: str) -> list[int]:
        """The same for any text without special tokens."""
        out: list[int] = []
        done = 0  # tokens of the cuts before
        cuts = [at for _, at in self.cutter.pre_tokenize_str(text)]
        x = 0
        while x < len(cuts):
            a, b = cuts[x]
            if self._is_blank(text[a]) and self._is_blank(text[b - 1]):  # a prefix that ends in white space keeps all of it together
                z = b
                while z < len(text) and self._is_blank(text[z]):
                    z += 1
                out += [done + n for n in self._cut_counts(text[a:z])]
                if z == b:
                    done = out[-1]
                    x += 1
                    continue
                # the run's last character goes with what follows or is a cut of its own
                done += self._cut_counts(text[a:b])[-1]
                a, b = cuts[x + 1]
                own = self._cut_counts(text[a:b])
                out += [done + n for n in own[z - a:]]
                done += own[-1]
                x += 2
                continue
            own = self._cut_counts(text[a:b])
            if text[a:b] in LONG_CONTRACTIONS:  # without its second letter it is an apostrophe and a letter
                own = [own[0], self._cut_counts("'")[-1] + self._cut_counts(text[a + 1])[-1], own[-1]]
            out += [done + n for n in own]
            done += own[-1]
            x += 1
        return out

    def counts(self, text: str) -> list[int]:
        """``counts(text)[n - 1]`` is the number of tokens of the first n characters."""
        out: list[int] = []
        at = done = 0
        while True:
            hits = [(text.find(s, at), -len(s), s) for s in self.special if s in text[at:]]
            if not hits:
                return out + [done + n for n in self._plain_counts(text[at:])] if at < len(text) else out
            start, _, special = min(hits)
            rest = self._plain_counts(text[at:start + len(special) - 1])  # a special token that is not complete is text
            out += [done + n for n in rest]
            done = (out[start - 1] if start else 0) + 1
            out.append(done)
            at = start + len(special)

    def _piece(self, text: str) -> bytes:
        m = SIMPLE.fullmatch(text)
        if m:
            return self._cut_steps(m[1]) + (self._cut_steps(m[2]) if m[2] else b"")
        return _as_steps(self.counts(text))

    def steps(self, text: str) -> bytes:
        """How the count changes with each character, as little-endian signed 16-bit integers."""
        if not text:
            return b""
        own = spaced_words(text)
        before = BEFORE[spaced_words]
        first = self._piece(own[0])
        del own[0]
        new = set(own)
        self.pieces.make_room(len(new))
        known = self.pieces.fresh
        for p in new.difference(known):
            if self.pieces.seek(p) is None:
                known[p] = self._piece(before + p)
        return first + b"".join(map(known.__getitem__, own))


_counters: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """This worker's counter for a file."""
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def total(steps: bytes) -> int:
    return int(np.frombuffer(steps, STEP).sum(dtype=np.int64))


def prefix_table(docs: DataFrame, path: str) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_chars, n_bytes, n_tokens, steps``; ``steps`` answers
    ``tokens_of_prefix``, ``longest_prefix`` and ``shortest_prefix``.

    A null or empty text has no step. A special token's string counts as
    the library's default has it, as that token. Rows that repeat a doc_id,
    or have none, are rows of their own. A text of any length is passed
    once, in one task, with about 2 bytes a character kept and some 20
    while a piece without single spaces is worked on; a row holds texts of
    up to 2^30 characters. An empty table gives no rows; other columns are
    ignored.
    """
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for b in batches:
            texts = [t.as_py() for t in b.column("text")]
            steps = [own.steps(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(map(len, texts), pa.int64()),
                 pa.array((len(t.encode("utf-8", "surrogatepass")) for t in texts), pa.int64()),
                 pa.array(map(total, steps), pa.int64()), pa.array(steps, pa.binary())],
                names=["doc_id", "n_chars", "n_bytes", "n_tokens", "steps"])

    return doc_texts(docs).mapInArrow(run, "doc_id long, n_chars long, n_bytes long, n_tokens long, steps binary")


def _answer(one, steps: Column, of: Column | int) -> Column:
    @F.pandas_udf("long")
    def answer(s: pd.Series, x: pd.Series) -> pd.Series:
        found = [None if a is None or pd.isna(n) else one(np.cumsum(np.frombuffer(a, STEP), dtype=np.int64), int(n))
                 for a, n in zip(s, x)]
        return pd.Series(found, dtype="Int64")

    return answer(steps, F.lit(of) if isinstance(of, int) else of)


def tokens_of_prefix(steps: Column, chars: Column | int) -> Column:
    """Tokens of the first ``chars`` characters: of the whole text if it is shorter, 0 if chars is below 1."""
    return _answer(lambda c, n: int(c[min(n, len(c)) - 1]) if n > 0 and len(c) else 0, steps, chars)


def longest_prefix(steps: Column, budget: Column | int) -> Column:
    """Characters of the longest prefix of ``budget`` tokens or fewer; 0 if there is none but the empty one."""
    return _answer(lambda c, n: int(np.flatnonzero(c <= n).max(initial=-1)) + 1, steps, budget)


def shortest_prefix(steps: Column, tokens: Column | int) -> Column:
    """Characters of the shortest prefix of ``tokens`` tokens or more; null if the text has none such."""
    def one(c, n):
        if n <= 0:
            return 0
        reached = np.flatnonzero(c >= n)
        return int(reached[0]) + 1 if len(reached) else None

    return _answer(one, steps, tokens)


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``docs``, from the prefix table; the
    cases are those of ``prefix_table``."""
    return prefix_table(docs, path).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


ORACLE_SQL: dict[str, str] = {}
