"""Vector best-fit packing of tokenised documents into sequences.

A sequence has a vector of capacities: tokens, documents (what a packed-attention kernel takes as
segments) and attention cost (the tiles of ``TILE`` by ``TILE`` that block-diagonal attention
computes: a piece of n tokens needs ceil(n / TILE) squared).  Pieces are placed in order of falling
length; among the open sequences that hold a piece under *every* constraint, the chosen one has the
least weighted norm of what is left (``norm``) or the greatest weighted dot product of demand and
rest (``dot``).

The capacities of documents and of attention are parameters, for kernels that have such limits, and bind
then.  By default they follow from the lengths (:func:`loose`): no set of pieces that fits the tokens exceeds them, since
a lower limit costs sequences, and their number is what counts.  Weights favour tokens; the others break near ties.

Tokenising is one narrow stage, and only piece lengths are kept and packed.  Pieces of full
length are sequences by themselves.  The others are dealt at random into groups of about
``GROUP`` pieces, as many groups as the data needs, and each is packed in one task; a group wastes
less than a few sequences.  What a group leaves open is packed once more with other groups' rests.

Ids are those of a JSON vocabulary of the tokenizers library, computed from its rank table, which takes
less than a third of that library's time; tests compare the two on every code point.

Defined results: a null text counts as empty and gives one piece, the end id alone.  Only longer
documents are cut, and their first piece is the shorter one.  Repeated ids and rows are packed one by
one; ties go to the oldest sequence; other columns are ignored, whatever their names.  No rows give
no pieces.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, with_id

GROUP = 20_000
END_ID = 0
TILE = 64  # tokens a side of an attention tile
WEIGHTS = (1.0, 0.05, 0.05)


def added_tokens(vocabulary: str) -> dict[str, int]:
    """The added tokens of a JSON vocabulary; a text is split at them before anything else."""
    with open(vocabulary, encoding="utf-8") as f:
        tokens = json.load(f)["added_tokens"]
    if any(t[k] for t in tokens for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("an added token that does not match literally")
    return {t["content"]: t["id"] for t in tokens}


def _encoder(table: bytes, pattern: str, added: dict[str, int], known: dict = {}):  # noqa: B006  one encoder a worker
    import tiktoken

    key = pattern, *added.items()
    if key not in known:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in table.splitlines() if x)}
        known[key] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)
    return known[key]


def pieces(docs: DataFrame, vocabulary: str, pattern: str, capacity: int, added: dict[str, int] | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    with open(vocabulary, "rb") as f:
        table = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = _encoder(table.value, pattern, added or {})
        for b in batches:
            out = []
            for doc, text in zip(b["doc_id"], b["t"]):
                ids = np.append(enc.encode_to_numpy(text, allowed_special="all"), END_ID).astype("<u4")
                first = (len(ids) - 1) % capacity + 1
                for k, stop in enumerate(range(first, len(ids) + 1, capacity)):
                    start = max(0, stop - capacity) if k else 0
                    out.append((doc, k, start, stop - start, zlib.crc32(ids[start:stop].tobytes())))
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("t"))
    return with_id(rows.mapInPandas(run, "doc_id string, piece int, start long, length long, ids_crc32 long"), kind)


def best_fit(demand: np.ndarray, capacity: np.ndarray, weights: np.ndarray, score: str = "norm") -> np.ndarray:
    """The bin of each row of ``demand`` (items by dimensions), placed in the order given."""
    size = demand / capacity
    floor = np.minimum.accumulate(demand[::-1], axis=0)[::-1]  # the least that still comes
    rest, names = np.empty((64, demand.shape[1])), np.empty(64, dtype=np.int64)
    used, made, out = 0, 0, np.empty(len(demand), dtype=np.int64)
    for i, need in enumerate(demand):
        if i % 512 == 0 and used:  # sequences that no later piece fits into are closed
            alive = np.flatnonzero((rest[:used] >= floor[i]).all(axis=1))
            rest[: len(alive)], names[: len(alive)], used = rest[alive], names[alive], len(alive)
        room = rest[:used]
        fits = np.flatnonzero((room >= need).all(axis=1))
        if len(fits):
            left = room[fits] / capacity
            at = fits[np.argmin((weights * (left - size[i]) ** 2).sum(axis=1))] if score == "norm" else fits[np.argmax((weights * left * size[i]).sum(axis=1))]
        else:
            if used == len(rest):
                rest, names = np.concatenate([rest, np.empty_like(rest)]), np.concatenate([names, np.empty_like(names)])
            at = used
            rest[at], names[at], used, made = capacity, made, used + 1, made + 1
        rest[at] -= need
        out[i] = names[at]
    return out


def tiles(length):
    """Attention tiles of a piece (numbers or a Column of them)."""
    side = -(-length // TILE) if not isinstance(length, Column) else F.ceil(length / TILE)
    return side * side


def loose(lengths: dict[int, int], capacity: int) -> tuple[int, int]:
    """(documents, tiles) that no sequence of ``capacity`` tokens exceeds, given how many pieces have each length.

    The shortest pieces give the most documents.  A piece of n tokens needs at most (n / TILE + 1)^2 tiles; the squares
    sum to those of one full piece at most, and what is linear to 2 * capacity / TILE and one for each document.
    """
    room, most = capacity, 0
    for n in sorted(lengths):
        k = min(lengths[n], room // n)
        most, room = most + k, room - k * n
        if k < lengths[n]:
            break
    return max(1, most), tiles(capacity) + 2 * -(-capacity // TILE) + most


def pack(
    docs: DataFrame, vocabulary: str, pattern: str, capacity: int = 2048, max_docs: int | None = None, max_attention: int | None = None,
    weights: tuple[float, float, float] = WEIGHTS, score: str = "norm", group: int = GROUP, added: dict[str, int] | None = None,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece.

    ``max_docs``, ``max_attention`` (in tiles): by default what any full sequence can need.
    ``added``: tokens that stand for themselves wherever a text holds them, from :func:`added_tokens`.

    A piece that breaks ``max_attention`` by itself is an error: nothing could hold it.
    """
    made = materialize(pieces(docs, vocabulary, pattern, capacity, added), "pieces")
    made = made.withColumn("id", F.monotonically_increasing_id())
    full = made.where(F.col("length") == capacity)
    part = made.where(F.col("length") < capacity)
    lengths = {r["length"]: r["n"] for r in part.groupBy("length").agg(F.count("*").alias("n")).collect()}  # a row a length
    n, (documents, most) = sum(lengths.values()), loose(lengths, capacity)
    documents, most = documents if max_docs is None else max_docs, most if max_attention is None else max_attention
    caps, factor = np.array([capacity, documents, most], dtype=float), np.array(weights)
    if max_attention is not None and made.where(tiles(F.col("length")) > most).limit(1).count():
        raise ValueError("a piece exceeds max_attention")
    groups = max(1, -(-n // group))

    def first(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values(["length", "doc_id", "piece", "id"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
        length = b["length"].to_numpy(float)
        b["bin"] = best_fit(np.column_stack([length, np.ones(len(b)), tiles(length)]), caps, factor, score) if len(b) else []
        b["offset"] = b.groupby("bin")["length"].cumsum() - b["length"]
        b["bin"] += b["group"] * (1 << 32)
        return b[["doc_id", "piece", "start", "length", "ids_crc32", "id", "bin", "offset"]]

    kind = docs.schema["doc_id"].dataType.simpleString()
    row = "doc_id string, piece int, start long, length long, ids_crc32 long, id long, bin long, offset long"
    # Dealt by the row's number, so repeated ids spread too.
    dealt = part.withColumn("doc_id", F.col("doc_id").cast("string")).withColumn("group", F.pmod(F.xxhash64("id"), F.lit(groups)))
    packed = dealt.groupBy("group").applyInPandas(first, row)
    if groups > 1:
        packed = _again(materialize(packed, "packed"), caps, factor, score, group)
    ends = with_id(packed, kind).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("bin") * 2).alias("sequence_id"), "offset")
    whole = full.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("id") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return ends.unionByName(whole)


def _again(packed: DataFrame, caps: np.ndarray, factor: np.ndarray, score: str, group: int) -> DataFrame:
    """Pack the sequences that are at most half full once more, each as one item."""
    bins = packed.groupBy("bin").agg(F.sum("length").alias("length"), F.count("*").alias("docs"), F.sum(tiles(F.col("length"))).alias("cost"))
    open_bins = materialize(bins.where(F.col("length") * 2 <= F.lit(int(caps[0]))), "open")
    n = open_bins.count()
    if n < 2:
        return packed

    def second(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values(["length", "bin"], ascending=[False, True]).reset_index(drop=True)
        b["into"] = best_fit(b[["length", "docs", "cost"]].to_numpy(float), caps, factor, score)
        b["shift"] = b.groupby("into")["length"].cumsum() - b["length"]
        b["into"] = b.groupby("into")["bin"].transform("first")
        return b[["bin", "into", "shift"]]

    moved = open_bins.withColumn("group", F.pmod(F.xxhash64("bin"), F.lit(max(1, -(-n // group))))).groupBy("group").applyInPandas(second, "bin long, into long, shift long")
    return packed.join(moved.hint("merge"), "bin", "left").withColumn("offset", F.col("offset") + F.coalesce("shift", F.lit(0))).withColumn("bin", F.coalesce("into", "bin")).drop("into", "shift")
