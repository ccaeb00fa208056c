"""Byte-level BPE by dynamic programming over prefixes.

Two tokens may stand side by side in an encoding only if merging their joint bytes gives just
these two, and a row of tokens is the encoding of its bytes exactly if all its neighbours may. So
every byte prefix has one valid last token, given those of shorter prefixes.  That table of last
tokens *is* the state: bytes can be appended, and after an edit only the part near it is redone.

Spark runs the texts in batches; each match of the pre-tokenisation pattern is encoded alone, and
a bounded table of already encoded matches is kept in each Python worker.

Defined results: a null text counts as empty and has no ids; invalid ids never occur, since every
single byte is a token; very long texts or matches take time in proportion to their length.
Repeated ids and rows give a result each; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import with_id

CACHE = 300_000  # matches that a worker remembers


class PrefixBpe:
    """Encoder and decoder for a table of ranks in the public text format (base64 bytes, rank)."""

    def __init__(self, table: bytes) -> None:
        rows = (line.split() for line in table.splitlines() if line)
        self.ranks = {base64.b64decode(a): int(b) for a, b in rows}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for piece, rank in self.ranks.items():
            self.tokens[rank] = piece
        self.longest = max(map(len, self.ranks))
        #: every suffix of a token: a longer candidate can only exist while the bytes are one
        self.tails = {p[i:] for p in self.ranks for i in range(len(p))}
        self.joined = {}
        for piece, rank in self.ranks.items():
            for i in range(1, len(piece)):
                a, b = self.ranks.get(piece[:i]), self.ranks.get(piece[i:])
                if a is not None and b is not None:
                    self.joined[a, b] = rank
        self.parts = {rank: self._halves(piece) for piece, rank in self.ranks.items()}
        self._right: dict[int, tuple] = {}
        self._left: dict[int, tuple] = {}
        self._fits: dict[tuple[int, int], bool] = {}
        self._done: dict[str, bytes] = {}
        self._prefixes: dict[bytes, int] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Encoding by definition: merge the leftmost pair of least rank, again and again."""
        return self._merge(piece, 1)

    def _merge(self, piece: bytes, least: int) -> list[int]:
        ids = [self.ranks[piece[i : i + 1]] for i in range(len(piece))]
        while len(ids) > least:
            found = min(((self.joined[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in self.joined), default=None)
            if found is None:
                break
            ids[found[1] : found[1] + 2] = [found[0]]
        return ids

    def _halves(self, piece: bytes) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a byte."""
        ids = self._merge(piece, 2)
        return (ids[0], ids[1]) if len(ids) == 2 else None

    def _spine(self, token: int, side: int) -> tuple:
        """(token, rank of the merge that ends it) along one edge, from the byte to the whole."""
        known = (self._left, self._right)[side]
        if token not in known:
            out, end = [], 1 << 40
            while True:
                out.append((token, end))
                if self.parts[token] is None:
                    break
                end, token = token, self.parts[token][side]
            known[out[0][0]] = tuple(reversed(out))
            return known[out[0][0]]
        return known[token]

    def fits(self, a: int, b: int) -> bool:
        """Whether a may stand just before b: no merge crosses their border before both are whole."""
        known = self._fits.get((a, b))
        if known is None:
            known = self._fits[a, b] = self._may(self._spine(a, 1), self._spine(b, 0))
            if len(self._fits) > 3 * CACHE:
                self._fits.clear()
        return known

    def _may(self, left: tuple, right: tuple) -> bool:
        i = j = 0
        while True:
            (a, a_end), (b, b_end) = left[i], right[j]
            rank = self.joined.get((a, b))
            # At equal rank the leftmost pair merges first.
            if rank is not None and rank < a_end and rank <= b_end:
                return False
            if i == len(left) - 1 and j == len(right) - 1:
                return True
            if a_end <= b_end:
                i += 1
            else:
                j += 1

    def prefixes(self, piece: bytes, last: list[int] | None = None) -> list[int]:
        """The valid last token of each prefix (index: length; 0 has -1). ``last``: of a known prefix."""
        last = list(last) if last else [-1]
        for end in range(len(last), len(piece) + 1):
            last.append(self._last(piece, end, last))
        return last

    def _last(self, piece: bytes, end: int, last: list[int]) -> int:
        ranks, known = self.ranks, self._fits
        for start in range(end - 1, max(0, end - self.longest) - 1, -1):
            part = piece[start:end]
            token = ranks.get(part)
            if token is not None:
                if start == 0:
                    return token
                fits = known.get((last[start], token))
                if fits or fits is None and self.fits(last[start], token):
                    return token
            elif part not in self.tails:
                break
        raise ValueError("no valid last token")

    def edited(self, piece: bytes, last: list[int], start: int, stop: int, new: bytes) -> tuple[bytes, list[int]]:
        """Replace bytes [start, stop): prefixes before stay, those after are redone until they agree again."""
        whole = piece[:start] + new + piece[stop:]
        out, shift, agree = last[: start + 1], len(new) - (stop - start), 0
        while len(out) <= len(whole):
            end = len(out)
            token = self._last(whole, end, out)
            agree = agree + 1 if end - shift > stop and last[end - shift] == token else 0
            out.append(token)
            if agree >= self.longest:
                out.extend(last[end - shift + 1 :])
        return whole, out

    def encode(self, piece: bytes) -> list[int]:
        token = self.ranks.get(piece)
        if token is not None:
            return [token]
        if len(piece) > 60:
            return self.ids(self.prefixes(piece))
        # Short matches share prefixes, whose last tokens are remembered.
        last, known = [-1], self._prefixes
        if len(known) > 3 * CACHE:
            known.clear()
        for end in range(1, len(piece) + 1):
            part = piece[:end]
            token = known.get(part)
            if token is None:
                token = known[part] = self._last(piece, end, last)
            last.append(token)
        return self.ids(last)

    def ids(self, last: list[int]) -> list[int]:
        """Walk back from the end of the text by last tokens."""
        out, at = [], len(last) - 1
        while at > 0:
            out.append(last[at])
            at -= len(self.tokens[last[at]])
        return out[::-1]

    def encode_text(self, text: str, pattern) -> bytes:
        """All ids as little-endian 32-bit integers."""
        done, out = self._done, []
        for word in pattern.findall(text):
            ids = done.get(word)
            if ids is None:
                if len(done) >= CACHE:
                    done.clear()
                ids = array("I", self.encode(word.encode())).tobytes()
                if len(word) < 100:
                    done[word] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(ids).cast("I")))


_loaded: dict[str, tuple] = {}


def loaded(table: bytes, pattern: str) -> tuple:
    """One encoder and compiled pattern for each worker and vocabulary."""
    import regex

    key = hashlib.sha256(table + pattern.encode()).hexdigest()
    if key not in _loaded:
        _loaded[key] = (PrefixBpe(table), regex.compile(pattern))
    return _loaded[key]


def tokenize(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, n_bytes for every row.

    ``vocabulary``: path of the rank table on the driver; its bytes (a file of fixed size) are sent
    to the workers.
    """
    spark = docs.sparkSession
    with open(vocabulary, "rb") as f:
        table = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe, compiled = loaded(table.value, pattern)
        for b in batches:
            n, coded, back, size = [], [], [], []
            for text in b["t"]:
                ids = bpe.encode_text(text, compiled)
                plain = bpe.decode(ids)
                n.append(len(ids) // 4)
                coded.append(hashlib.sha256(ids).hexdigest())
                back.append(hashlib.sha256(plain).hexdigest())
                size.append(len(plain))
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_tokens": n, "ids_sha256": coded, "decoded_sha256": back, "n_bytes": size})

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("t"))
    return with_id(rows.mapInPandas(run, "doc_id string, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long"), kind)
