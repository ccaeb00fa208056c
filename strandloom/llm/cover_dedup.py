"""Removal of repeated word windows through difference-cover anchors.

A word goes if a window of ``window`` words that covers it also starts in a document with a smaller doc_id.

1. *Anchors.*  A difference cover modulo a period v holds, for any two places, a common shift below v that
   brings both to cover positions.  Hashes of window - v + 1 words are taken at cover positions only (3 of 7
   for 13 words), so two equal windows share at least one anchor at the same distance from their starts.
   Anchors that several documents hold are found by counting.
2. *Extension.*  Around each such anchor the windows that contain it are put together from hashes to its left
   and right.  A chunk of documents keeps the least id of each window: its other documents lose the window at
   once, and one row for each distinct window asks the others.
3. *Answers.*  The asked windows meet by hash; where another chunk knows a smaller id, the place in the asking
   chunk goes back, and the chunk turns places into spans of its documents.
4. Spans meet the texts; only texts with something to remove are shuffled.

Skew: a window that a third of all documents hold is one row a chunk; a hot anchor is a bit, and never a group.
What is broadcast is one bitmap of bounded size for anchors and one for touched documents; a false hit costs
time and never changes results.  Windows meet by 96 bits of hash, which joins two 64-bit hashes of their halves.

Defined results: a null text has no words; ids are whole numbers, and a null id comes after all others
(between such rows nothing goes).  Rows that repeat an id do not remove each other's words.  Texts shorter
than a window lose nothing.  Other columns are ignored, whatever their names.  No rows give no rows.  Long
texts are cut into words in blocks.
"""

from __future__ import annotations

import hashlib
import io
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Bitmap, materialize, remove, with_id

WINDOW = 13
CHUNK = 500_000  # words of the documents that are combined before they ask others
BUCKET = 1_000_000  # anchors or windows that meet in a task
BLOCK = 1 << 22  # bytes of a text that are cut into words at a time
# Perfect difference sets (fixed values): every difference modulo the period occurs.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
SPACE = re.compile(rb"[\x20\x09-\x0D]")
LAST = (1 << 63) - 1
U = np.uint64


def difference_cover(window: int) -> tuple[int, tuple[int, ...]]:
    """(period, cover positions) with anchors at least as long as the period."""
    period = max(p for p in COVERS if 2 * p - 1 <= window)
    return period, COVERS[period]


def blocks(data: bytes, size: int = BLOCK) -> Iterator[bytes]:
    """``data`` in pieces of about ``size`` bytes that end where white space begins."""
    at = 0
    while at < len(data):
        stop = at + size
        if stop < len(data):
            found = SPACE.search(data, stop)
            stop = found.start() if found else len(data)
        yield data[at:stop]
        at = stop


def word_hashes(data: bytes) -> np.ndarray:
    import xxhash

    parts = []
    for block in blocks(data):
        words = block.split()
        parts.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), U, len(words)))
    return np.concatenate(parts) if parts else np.array([], U)


def _mix(a: np.ndarray, b: np.ndarray, k: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    h = a * U(k)
    h ^= h >> U(32)
    h += b
    h *= U(0xD6E8FEB86659FD93)
    return h ^ (h >> U(29))


def gram_hashes(one: np.ndarray, size: int) -> np.ndarray:
    """Hashes of ``size`` consecutive items, by doubling."""
    if len(one) < size:
        return one[:0]
    n = 1
    while n < size:
        step = min(n, size - n)
        one, n = _mix(one[: len(one) - step], one[step:]), n + step
    return one


def anchors(one: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes at all places, cover positions) of anchors; 48 bits count."""
    period, cover = difference_cover(window)
    h = gram_hashes(one, window - period + 1)
    at = np.arange(len(h))
    return h, at[np.isin(at % period, cover)]


def extended(h: np.ndarray, hits: np.ndarray, window: int) -> np.ndarray:
    """Starts of the windows that contain an anchor at ``hits``; ``h`` are the anchors' hashes."""
    period, _ = difference_cover(window)
    n = len(h) - period + 1  # windows of the document
    low, high = np.maximum(hits - period + 1, 0), np.minimum(hits, n - 1)
    some = low <= high
    edge = np.zeros(max(n, 0) + 1, np.int64)
    np.add.at(edge, low[some], 1)
    np.add.at(edge, high[some] + 1, -1)
    return np.flatnonzero(np.cumsum(edge[:-1]) > 0)


def _raw48(h: np.ndarray) -> bytes:
    return np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from48(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view(U)


def _bounds(sorted_keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Where runs of equal keys begin and end."""
    edges = np.flatnonzero(np.diff(sorted_keys, prepend=-1, append=-1)) if len(sorted_keys) else []
    return zip(edges[:-1], edges[1:])


def _rows(docs: DataFrame) -> DataFrame:
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    return docs.select("doc_id", data.alias("data"), order.alias("ord"), F.xxhash64(data, "doc_id").alias("tag"))


def _repeated_anchors(rows: DataFrame, window: int, bits: int, chunk: int) -> DataFrame:
    """h: anchors (in the upper 48 bits) that several rows hold."""

    def pack(held: list[np.ndarray]) -> pd.DataFrame:
        h, n = np.unique(np.concatenate(held), return_counts=True)
        out = []
        for several in (False, True):
            some = h[(n > 1) == several]
            out += [(int(some[i] >> U(48 - bits)), several, _raw48(some[i:j])) for i, j in _bounds((some >> U(48 - bits)).astype(np.int64))]
        return pd.DataFrame(out, columns=["bucket", "several", "h"])

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for b in batches:
            for data in b["data"]:
                h, at = anchors(word_hashes(data), window)
                held.append(np.unique(h[at] >> U(16)))
                size += len(h)
                if size >= chunk:
                    yield pack(held)
                    held, size = [], 0
        if held:
            yield pack(held)

    def count(b: pd.DataFrame) -> pd.DataFrame:
        once, more = (_from48(b"".join(b["h"][b["several"] == several])) for several in (False, True))
        h, n = np.unique(once, return_counts=True)
        return pd.DataFrame({"h": (np.union1d(h[n > 1], more) << U(16)).view(np.int64)})

    return rows.select("data").mapInPandas(send, "bucket long, several boolean, h binary").groupBy("bucket").applyInPandas(count, "h long")


def _spans(rows: DataFrame, known: Bitmap, window: int, bits: int, chunk: int) -> DataFrame:
    """tag, ord, spans (first and last word of each, as packed longs) of rows that lose words."""
    cols = ["bucket", "chunk", "a", "b", "c", "d"]

    def ask(tags: list[int], ords: list[int], found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], name: int) -> pd.DataFrame:
        tag, ord_ = np.array(tags, np.int64), np.array(ords, np.int64)
        counts = np.array([len(f[0]) for f in found])
        start, w, v = (np.concatenate(x) for x in zip(*found))
        own = np.repeat(ord_, counts)
        order = np.lexsort((own, v, w))
        new = np.append(True, (np.diff(w[order].view(np.int64)) != 0) | (np.diff(v[order].view(np.int32)) != 0))
        group = np.cumsum(new) - 1
        first = order[np.flatnonzero(new)]  # the least id of each window; of equals the first place
        lost = np.zeros(len(w), bool)
        lost[order] = own[order] > own[first][group]
        same = np.zeros(len(w), np.int64)
        same[order] = first[group]
        again = np.flatnonzero(~lost & (same != np.arange(len(w))))
        out = []
        for i, j in _bounds((w[first] >> U(64 - bits)).astype(np.int64)):
            f = first[i:j]
            out.append((int(w[f[0]] >> U(64 - bits)), name, w[f].tobytes(), v[f].tobytes(), own[f].tobytes(), f.astype(np.uint32).tobytes()))
        state = io.BytesIO()
        np.savez_compressed(state, tag=tag, ord=ord_, counts=counts, start=np.diff(start, prepend=0), lost=np.packbits(lost), again=again, same=same[again], asked=len(out))
        return pd.DataFrame([*out, (-1 - (name & LAST), name, state.getvalue(), b"", b"", b"")], columns=cols)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        tags, ords, found, size = [], [], [], 0

        def flush() -> pd.DataFrame:
            name = xxhash.xxh3_64_intdigest(np.array([tags, ords], np.int64).tobytes(), seed=len(tags))
            return ask(tags, ords, found, int(np.array([name], U).view(np.int64)[0]))

        for b in batches:
            for data, tag, ord_ in zip(b["data"], b["tag"], b["ord"]):
                h, at = anchors(word_hashes(data), window)
                size += len(h)
                starts = extended(h, at[known(h[at] >> U(16) << U(16))], window)
                if len(starts):
                    left, right = h[starts], h[starts + difference_cover(window)[0] - 1]
                    tags.append(tag), ords.append(ord_)
                    found.append((starts, _mix(left, right), (_mix(right, left, 0xC2B2AE3D27D4EB4F) >> U(32)).astype(np.uint32)))
                if size >= chunk and tags:
                    yield flush()
                    tags, ords, found = [], [], []
                    size = 0
        if tags:
            yield flush()

    def judge(b: pd.DataFrame) -> pd.DataFrame:
        if b["bucket"].iloc[0] < 0:  # what chunks keep for themselves passes
            return b[["chunk", "a"]].assign(state=True)
        w, v, own = np.frombuffer(b"".join(b["a"]), U), np.frombuffer(b"".join(b["b"]), np.uint32), np.frombuffer(b"".join(b["c"]), np.int64)
        place, size = np.frombuffer(b"".join(b["d"]), np.uint32), (b["d"].str.len() // 4).to_numpy()
        order = np.lexsort((own, v, w))
        new = np.append(True, (np.diff(w[order].view(np.int64)) != 0) | (np.diff(v[order].view(np.int32)) != 0))
        least = own[order][np.flatnonzero(new)][np.cumsum(new) - 1]
        lost = np.zeros(len(w), bool)
        lost[order] = own[order] > least
        ends = np.cumsum(size)
        back = [place[e - s : e][lost[e - s : e]].tobytes() for s, e in zip(size, ends)]
        return pd.DataFrame({"chunk": b["chunk"], "a": back, "state": False})

    def assemble(b: pd.DataFrame) -> pd.DataFrame:
        with np.load(io.BytesIO(b["a"][b["state"]].iloc[0])) as kept:
            tag, ord_, counts, start, again, same = kept["tag"], kept["ord"], kept["counts"], np.cumsum(kept["start"]), kept["again"], kept["same"]
            lost = np.unpackbits(kept["lost"], count=len(start)).astype(bool)
            if int(kept["asked"]) != int((~b["state"]).sum()):
                raise RuntimeError("a chunk was read again in another order; write the documents to a table first")
        lost[np.frombuffer(b"".join(b["a"][~b["state"]]), np.uint32)] = True
        lost[again] = lost[same]
        out, ends = [], np.cumsum(counts)
        for t, o, n, end in zip(tag.tolist(), ord_.tolist(), counts, ends):
            s = start[end - n : end][lost[end - n : end]]
            if len(s):
                far = np.flatnonzero(np.diff(s) > window)
                first, last = np.append(s[0], s[far + 1]), np.append(s[far], s[-1]) + window
                out.append((t, o, np.column_stack([first, last]).astype(np.int64).tobytes()))
        return pd.DataFrame(out, columns=["tag", "ord", "spans"])

    asked = rows.select("data", "tag", "ord").mapInPandas(send, "bucket long, chunk long, a binary, b binary, c binary, d binary")
    told = asked.groupBy("bucket").applyInPandas(judge, "chunk long, a binary, state boolean")
    return told.groupBy("chunk").applyInPandas(assemble, "tag long, ord long, spans binary")


def _without(data: bytes, spans: bytes | None) -> tuple[int, int, bytes]:
    """(words, removed words, kept words joined by one space)."""
    n, at, removed, kept = 0, 0, 0, []
    cut = np.frombuffer(spans, np.int64).reshape(-1, 2).tolist() if spans is not None else []
    for block in blocks(data):
        words = block.split()
        low = 0
        while at < len(cut) and cut[at][0] < n + len(words):
            first, last = max(cut[at][0] - n, low), min(cut[at][1] - n, len(words))
            kept += words[low:first]
            removed += last - first
            low = last
            if cut[at][1] > n + len(words):
                break
            at += 1
        kept += words[low:]
        n += len(words)
    return n, removed, b" ".join(kept)


def cover_dedup(docs: DataFrame, window: int = WINDOW, chunk: int = CHUNK, bucket: int = BUCKET) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept (bytes) of every row of ``docs`` (doc_id, text)."""
    rows = _rows(docs)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(40, max(3, int(size // (6 * bucket)).bit_length()))  # words and the space behind them take some six bytes
    shared = materialize(_repeated_anchors(rows, window, bits, chunk), "anchors")
    known = Bitmap(shared, "h")
    found = materialize(_spans(rows, known, window, bits, chunk).dropDuplicates(["tag", "ord"]), "spans")
    known.release()
    remove(shared)
    hit = Bitmap(found, "tag")
    touched = F.pandas_udf(lambda v: pd.Series(hit(v.to_numpy())), "boolean")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [_without(x, s) for x, s in zip(b["data"], b["spans"])]
            f = pd.DataFrame(out, columns=["n_words", "n_removed", "kept"])
            f.insert(0, "doc_id", b["doc_id"].to_numpy())
            f["kept_sha256"] = [hashlib.sha256(k).hexdigest() for k in f["kept"]]
            yield f

    kind = docs.schema["doc_id"].dataType.simpleString()
    marked = rows.withColumn("doc_id", F.col("doc_id").cast("string")).withColumn("touched", touched("tag"))
    changed = marked.where("touched").join(found, ["tag", "ord"], "left").select("doc_id", "data", "spans")
    same = marked.where("NOT touched").select("doc_id", "data", F.lit(None).cast("binary").alias("spans"))
    shape = "doc_id string, n_words long, n_removed long, kept binary, kept_sha256 string"
    return with_id(changed.mapInPandas(cut, shape).unionByName(same.mapInPandas(cut, shape)), kind)


ORACLE = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []::VARCHAR[]) AS w FROM documents),
s AS (SELECT doc_id, r, i, array_to_string(w[i:i + 12], ' ') AS t FROM (SELECT doc_id, r, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
m AS (SELECT t, min(doc_id) AS least FROM s GROUP BY t),
g AS (SELECT DISTINCT r, i + k AS p FROM (SELECT r, i, unnest(range(0, 13)) AS k FROM s JOIN m ON m.t = s.t AND m.least < s.doc_id)),
x AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
l AS (SELECT x.r, count(*) - count(g.p) AS n, string_agg(x, ' ' ORDER BY x.p) FILTER (WHERE g.p IS NULL) AS kept FROM x LEFT JOIN g ON g.r = x.r AND g.p = x.p GROUP BY x.r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN l ON l.r = d.r
"""
