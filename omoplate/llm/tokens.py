"""Token ids of whole texts, each distinct piece of text through the tokenizer once.

A piece function cuts a text where no token can cross: the ids of a text
are those of its pieces in order. A worker keeps the ids of the pieces it
has met and asks the tokenizer only for new ones.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable

#: Entries of a worker's newer memory of pieces, and of letters; an older one as large is kept beside it.
MOST_PIECES = 400_000
MOST_LETTERS = 450_000

_ALONE = re.compile(r"(?<=[^\s\x1c-\x1f\x85]) (?=[^\s\x1c-\x1f\x85])")
_RUN = re.compile(r"\s\s")


def words(text: str) -> list[bytes]:
    """For tokenizers that drop white space: cut at ASCII white space."""
    return text.encode("utf-8", "surrogatepass").split()


def spaced_words(text: str) -> list[str]:
    """For tokenizers whose tokens may begin with a space: cut at each single space between two other
    characters; the space belongs to the piece behind it. A run of white space stays in one piece
    with its neighbours."""
    if _RUN.search(text) or text[:1] == " " or text[-1:] == " ":
        return _ALONE.split(text)
    return text.split(" ")


#: What was cut away before every piece but the first.
BEFORE = {words: "", spaced_words: " "}

#: A word of ASCII and Latin-1 letters, which are their own normal form, and ASCII punctuation
#: behind it other than the apostrophe of contractions. Pre-tokenizers cut between the two.
SIMPLE = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


def byte_alphabet() -> dict[int, str]:
    """Byte-level vocabularies write a printable byte as itself and the others, in order, as the
    characters from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b if b in shown else next(rest)) for b in range(256)}


class Memory:
    """What was met lately: when full, all but the entries met since it was last full are dropped."""

    def __init__(self, most: int):
        self.most, self.fresh, self.older = most, {}, {}

    def seek(self, key):
        """The value, or None; a value found among the older ones is kept on."""
        value = self.fresh.get(key)
        if value is None:
            value = self.older.get(key)
            if value is not None:
                self.fresh[key] = value
        return value

    def make_room(self, n: int) -> None:
        if len(self.fresh) + n > self.most:
            self.older, self.fresh = self.fresh, {}


class PieceEncoder:
    """Truncation and padding of the file are not used; special tokens are never added.

    Simple words are cut once more, into letters and punctuation, and the
    letters go straight to the tokenizer's model if that gives what the
    whole tokenizer gives on a few probes.
    """

    PROBES = ("word", " Word", "ÀÉÎõüß", " straße", "x", " Zz", "ingeringtionation")

    def __init__(self, path: str, pieces: Callable[[str], list], share: float = 1.0):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model, self.alphabet = self.tokenizer.model, byte_alphabet()
        self.pieces, self.known, self.parts = pieces, Memory(int(share * MOST_PIECES)), Memory(int(share * MOST_LETTERS))
        probes = [p if pieces is spaced_words else p.strip() for p in self.PROBES]
        whole = [self._library([p])[0] for p in probes]
        self.straight = None
        for change in (str, str.lower):
            if [self._model(p, change) for p in probes] == whole:
                self.straight = change

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _model(self, letters: str, change: Callable[[str], str]) -> bytes:
        shown = change(letters).encode().decode("latin-1").translate(self.alphabet)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _part(self, text: str, letters: bool) -> bytes:
        ids = self.parts.seek(text)
        if ids is None:
            ids = self._model(text, self.straight) if letters else self._library([text])[0]
            self.parts.make_room(1)
            self.parts.fresh[text] = ids
        return ids

    def _learn(self, pieces: set, before: str) -> None:
        """Afterwards the fresh memory has the ids of all ``pieces``."""
        self.known.make_room(len(pieces))
        known = self.known.fresh
        new = [p for p in pieces.difference(known) if self.known.seek(p) is None]
        other, texts = [], []
        for p in new:
            text = p.decode("utf-8", "surrogatepass") if isinstance(p, bytes) else before + p
            m = SIMPLE.fullmatch(text) if self.straight else None
            if m:
                known[p] = self._part(m[1], True) + (self._part(m[2], False) if m[2] else b"")
            else:
                other.append(p)
                texts.append(text)
        for at in range(0, len(other), 10_000):
            known.update(zip(other[at:at + 10_000], self._library(texts[at:at + 10_000])))

    def ids(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        own, before = self.pieces(text), BEFORE[self.pieces]
        first = b""
        if before:
            first = self._library([own[0]])[0]
            del own[0]
        self._learn(set(own), before)
        return first + b"".join(map(self.known.fresh.__getitem__, own))


_encoders: dict = {}


def encoder(path: str, pieces: Callable[[str], list], share: float = 1.0) -> PieceEncoder:
    """This worker's encoder for a file; ``share`` of the usual memory."""
    key = (path, pieces.__name__, share)
    if key not in _encoders:
        _encoders[key] = PieceEncoder(path, pieces, share)
    return _encoders[key]
