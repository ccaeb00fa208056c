"""N-gram Jaccard self-join by T-occurrence search, complete and without pair lists.

Two documents link when 100 * |intersection| >= 80 * |union| of their sets of 5-word shingles.

1. *Signatures.*  One pass makes each text's set of 64-bit shingle hashes and keeps its digest and
   a prefix in hash order.  Equal sets collapse to one representative.
2. *Prefix counts.*  A set of size n keeps its first n - ceil(0.8 n) + s(n) hashes, where
   s(n) = floor(n / 10) + 1.  Linked sets share at least floor(n / 10) hashes of their prefixes, for either
   n, so a set with fewer hashes that any other prefix holds is alone.  Of the others' shared hashes all but
   the floor(n / 10) - 1 most frequent still hold one in common with each partner.
3. *Coarse components* over those hashes (hash to its least document, then star contraction) hold
   every link.  Sets are fetched for their members only.
4. *T-occurrence search* in each coarse component: for a query with n shingles the documents that
   occur in at least T = ceil(0.8 n) of its inverted lists are wanted.  DivideSkip sets the longest
   lists aside, heap-merges the short ones, and binary-probes the long ones for what can still reach T.
   Documents already known to be connected leave the index, so a group of thousands of near copies costs about
   one search for each and yields a spanning forest of links, not all pairs.  Components too large
   for a task are cut into bands of size (partners are in the same or the next) and salted
   blocks, and each pair of blocks that can hold links is searched.
5. Components of the links are the classes.

Skew: copies collapse before anything is grouped; hashes held by more than N/512 documents
are found first (a list bounded by 1024 times the mean prefix) and never meet in one Python group.
What is broadcast: that list and a bitmap of fixed size (8 MB) that thins the second pass; an exact join
follows it.

Defined results: null texts and texts without words have an empty set, link with nothing and are
their own component; with one to four words the whole sequence is the one shingle.  Repeated ids
and rows are nodes of their own and end in one component through their equal sets.  Other columns
are ignored, whatever their names.  No rows give no rows.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, materialize, remove, with_id

WORDS = 5
CHUNK_BITS = 13  # documents in a chunk: 2**13
BUCKET = 2_000_000  # prefix hashes in a counting task
BLOCK = 4_000_000  # shingles in a search task
MAP_BITS = 26
SALTS = 16
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
HOT = (1 << 31) - 1


def shingles(text: str) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if len(words) < WORDS:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))] if words else [], dtype=np.uint64)
    one = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = len(words) - WORDS + 1
    h = one[:n].copy()
    for k in range(1, WORDS):
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h += one[k : k + n]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return np.unique(h)


def _spare(n):
    """floor(n / 10) - 1, at least 0: shared prefix hashes that a set can do without."""
    return np.maximum(n // 10 - 1, 0)


def _prefix(h: np.ndarray) -> bytes:
    n = len(h)
    kept = h[: n - -(-4 * n // 5) + n // 10 + 1] >> np.uint64(16)
    return kept.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _hashes48(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view(np.uint64)


def _raw48(h: np.ndarray) -> bytes:
    return np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("t"), F.xxhash64(text, "doc_id").alias("tag"))


def signatures(docs: DataFrame) -> DataFrame:
    """key, doc_id, tag, n, digest, prefix of every row; written to the shared folder."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sets = [shingles(t) for t in b["t"]]
            digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            yield pd.DataFrame({"key": b["key"], "doc_id": b["doc_id"], "tag": b["tag"], "n": [len(s) for s in sets], "digest": digest, "prefix": [_prefix(s) for s in sets]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = _rows(docs).withColumn("doc_id", F.col("doc_id").cast("string")).withColumn("key", F.monotonically_increasing_id())
    return materialize(with_id(keyed.mapInPandas(run, "key long, doc_id string, tag long, n long, digest binary, prefix binary"), kind), "signatures")


def _with_chunk(df: DataFrame) -> DataFrame:
    return df.withColumn("chunk", F.shiftright("key", CHUNK_BITS))


def _hot(sig: DataFrame, n_docs: int) -> np.ndarray:
    """Prefix hashes of more than N/512 documents (and 128 at least), counted over all of them."""

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            h, c = np.unique(_hashes48(b"".join(b["prefix"])), return_counts=True)
            often = c >= max(4, len(b) // 1024)
            yield pd.DataFrame({"h": h[often].astype(np.int64), "c": c[often]})

    counted = sig.select("prefix").mapInPandas(local, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
    rows = counted.where(F.col("c") >= max(64, n_docs // 1024)).select("h").collect()
    return np.sort(np.array([r.h for r in rows], dtype=np.uint64))


def _shared(sig: DataFrame, reps: DataFrame, hot: np.ndarray, buckets: int) -> DataFrame:
    """(h, key): shared prefix hashes of the sets that are not alone, without the most frequent."""
    spark = sig.sparkSession
    known = spark.sparkContext.broadcast(hot)
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    low = (1 << CHUNK_BITS) - 1

    def send(wide: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        b = wide[wide["key"].isin(own["key"])]
        cols = ["bucket", "chunk", "h", "at"]
        if not len(b):
            return pd.DataFrame(columns=cols)
        h = _hashes48(b"".join(b["prefix"]))
        at = np.repeat((b["key"].to_numpy() & low).astype(np.uint16), b["prefix"].str.len().to_numpy() // 6)
        chunk = int(b["key"].iloc[0]) >> CHUNK_BITS
        usual = ~np.isin(h, known.value)
        out = [(-1 - chunk, chunk, _raw48(h[~usual]), at[~usual].tobytes())] if not usual.all() else []
        h, at = h[usual], at[usual]
        # Prefixes hold small hashes, so these are mixed anew for an even deal.
        to = ((h * np.uint64(0xD6E8FEB86659FD93) ^ h >> np.uint64(7)) * np.uint64(0x9E3779B97F4A7C15) >> shift).astype(np.int64)
        order = np.argsort(to, kind="stable")
        h, at, to = h[order], at[order], to[order]
        edges = np.flatnonzero(np.diff(to, prepend=-1, append=-1)) if len(to) else []
        out += [(int(to[i]), chunk, _raw48(h[i:j]), at[i:j].tobytes()) for i, j in zip(edges[:-1], edges[1:])] if len(to) else []
        return pd.DataFrame(out, columns=cols)

    def count(b: pd.DataFrame) -> pd.DataFrame:
        cols = ["chunk", "h", "at", "c"]
        if b["bucket"].iloc[0] < 0:
            return pd.DataFrame([(c, h, a, np.full(len(a) // 2, HOT, np.int32).tobytes()) for c, h, a in zip(b["chunk"], b["h"], b["at"])], columns=cols)
        h, at = _hashes48(b"".join(b["h"])), np.frombuffer(b"".join(b["at"]), np.uint16)
        chunk = np.repeat(b["chunk"].to_numpy(), b["at"].str.len().to_numpy() // 2)
        _, back, n = np.unique(h, return_inverse=True, return_counts=True)
        n = n[back]
        more = n > 1
        h, at, chunk, n = h[more], at[more], chunk[more], n[more].astype(np.int32)
        order = np.argsort(chunk, kind="stable")
        h, at, chunk, n = h[order], at[order], chunk[order], n[order]
        edges = np.flatnonzero(np.diff(chunk, prepend=-1, append=-1)) if len(chunk) else []
        return pd.DataFrame([(int(chunk[i]), _raw48(h[i:j]), at[i:j].tobytes(), n[i:j].tobytes()) for i, j in zip(edges[:-1], edges[1:])], columns=cols)

    def decide(sizes: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(b):
            return pd.DataFrame(columns=["h", "key"])
        h, at, c = _hashes48(b"".join(b["h"])), np.frombuffer(b"".join(b["at"]), np.uint16), np.frombuffer(b"".join(b["c"]), np.int32)
        spare = np.zeros(low + 1, np.int64)
        spare[sizes["key"].to_numpy() & low] = _spare(sizes["n"].to_numpy())
        order = np.lexsort((h, c, at))
        h, at = h[order], at[order].astype(np.int64)
        total = np.bincount(at, minlength=low + 1)
        rank = np.arange(len(at)) - (np.cumsum(total) - total)[at]
        keep = rank < (total - spare)[at]
        return pd.DataFrame({"h": h[keep].astype(np.int64), "key": at[keep] + (int(b["chunk"].iloc[0]) << CHUNK_BITS)})

    wide = _with_chunk(sig.select("key", "prefix")).groupBy("chunk")
    sent = wide.cogroup(_with_chunk(reps.select("key")).groupBy("chunk")).applyInPandas(send, "bucket long, chunk long, h binary, at binary")
    counted = sent.groupBy("bucket").applyInPandas(count, "chunk long, h binary, at binary, c binary")
    sizes = _with_chunk(sig.select("key", "n")).groupBy("chunk")
    return sizes.cogroup(counted.groupBy("chunk")).applyInPandas(decide, "h long, key long")


class Index:
    """Inverted lists of sets, for T-occurrence search."""

    def __init__(self, sets: list[np.ndarray], ids: np.ndarray) -> None:
        tokens = np.concatenate([sets[i] for i in ids]) if len(ids) else np.array([], np.uint64)
        owner = np.repeat(ids, [len(sets[i]) for i in ids]) if len(ids) else np.array([], np.int64)
        order = np.argsort(tokens, kind="stable")
        self.tokens, self.start = np.unique(tokens[order], return_index=True)
        self.owner, self.stop = owner[order], np.append(self.start[1:], len(tokens))

    def lists(self, query: np.ndarray) -> list[np.ndarray]:
        at = np.minimum(np.searchsorted(self.tokens, query), max(0, len(self.tokens) - 1))
        at = at[self.tokens[at] == query] if len(self.tokens) else at[:0]
        return [self.owner[a:b] for a, b in zip(self.start[at], self.stop[at])]


def divide_skip(lists: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, occurrences) of all ids in at least ``least`` of the sorted lists."""
    none = np.array([], np.int64)
    if len(lists) < least:
        return none, none
    lists = sorted(lists, key=len)
    long = min(least - 1, int(least / (0.0085 * np.log2(len(lists[-1]) + 1) + 1)))
    short, aside = lists[: len(lists) - long], lists[len(lists) - long :]
    if len(short) == 1:
        ids, n = short[0], np.ones(len(short[0]), np.int64)
    else:
        merged = [(i, sum(1 for _ in g)) for i, g in groupby(heapq.merge(*[s.tolist() for s in short]))]
        got = [x for x in merged if x[1] >= least - long]
        ids, n = np.array([x[0] for x in got], np.int64), np.array([x[1] for x in got], np.int64)
    for k, probe in enumerate(aside):
        live = n + (len(aside) - k) >= least
        ids, n = ids[live], n[live]
        if not len(ids):
            break
        at = np.minimum(np.searchsorted(probe, ids), len(probe) - 1)
        n = n + (probe[at] == ids)
    ok = n >= least
    return ids[ok], n[ok]


def forest(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect exactly what all links connect."""
    size = np.array([len(s) for s in sets])
    alive = np.ones(len(sets), bool)
    index, indexed, left, out = Index(sets, np.arange(len(sets))), len(sets), len(sets), []
    for seed in range(len(sets)):
        if not alive[seed]:
            continue
        alive[seed] = False
        left -= 1
        queue = [seed]
        while queue and left:
            if left < indexed // 2:
                index, indexed = Index(sets, np.flatnonzero(alive)), left
            q = queue.pop()
            least = -(-4 * len(sets[q]) // 5)
            lists = index.lists(sets[q])
            lists = [x for x in (x[alive[x]] for x in lists) if len(x)] if len(lists) >= least else []
            ids, n = divide_skip(lists, least)
            ids = ids[100 * n >= 80 * (len(sets[q]) + size[ids] - n)] if len(ids) else ids
            alive[ids] = False
            left -= len(ids)
            queue += ids.tolist()
            out += [(q, i) for i in ids.tolist()]
    return out


def _links(members: DataFrame, block: int) -> DataFrame:
    """(a, b) links of ``members`` (component, key, n, hashes)."""
    totals = members.groupBy("component").agg(F.sum("n").alias("tokens"))
    # Sizes that can link differ by a factor of 1.25 at most, so they are in one band or in neighbours.
    band = F.floor(F.log("n") / F.lit(float(np.log(1.26)))).cast("int")
    sized = members.select("component", "key", "n").join(totals.where(F.col("tokens") > block), "component")
    bands = sized.groupBy("component", band.alias("band")).agg(F.ceil(F.sum("n") / (block // 2)).cast("int").alias("k"))
    near = bands.select("component", "band", "k")
    up = bands.select("component", (F.col("band") - 1).alias("band"), F.col("k").alias("k_up"))
    down = bands.select("component", (F.col("band") + 1).alias("band"), F.col("k").alias("k_down"))
    cut = near.join(up, ["component", "band"], "left").join(down, ["component", "band"], "left")
    # A component may hold a third of all sets, so its members are dealt over salts.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    told = cut.select("*", salts)
    salted = members.withColumn("band", band).withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int"))
    placed = salted.join(told, ["component", "band", "salt"], "left")
    own = F.pmod(F.xxhash64("key"), F.col("k")).cast("int")
    every = lambda k: F.when(k > 0, F.sequence(F.lit(0), k - 1))
    none = F.array().cast("array<string>")
    name = lambda *p: F.concat_ws(":", *p)
    tasks = F.when(F.col("k").isNull(), F.array(F.lit("all"))).otherwise(F.concat(
        F.transform(every(F.col("k")), lambda j: name(F.col("band"), F.least(own, j), F.greatest(own, j))),
        F.coalesce(F.transform(every(F.col("k_up")), lambda j: name(F.col("band"), own, F.lit("up"), j)), none),
        F.coalesce(F.transform(every(F.col("k_down")), lambda j: name(F.col("band") - 1, j, F.lit("up"), own)), none),
    ))

    def search(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values(["n", "key"], ascending=[False, True])
        key = b["key"].to_numpy()
        found = forest([np.frombuffer(x, np.uint64) for x in b["hashes"]])
        return pd.DataFrame([(key[i], key[j]) for i, j in found], columns=["a", "b"])

    return placed.select("component", "key", "n", "hashes", F.explode(tasks).alias("task")).groupBy("component", "task").applyInPandas(search, "a long, b long")


def _fetch(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """component, key, n, hashes for ``wanted`` (component, key, tag, digest), from a second pass."""
    place = F.shiftrightunsigned("tag", 64 - MAP_BITS) + 1
    bits = wanted.groupBy(F.bitmap_bucket_number(place).alias("at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    marks = np.zeros((1 << MAP_BITS) // 8, np.uint8)  # of fixed size, whatever the number of rows
    for r in bits.toLocalIterator():
        marks[(r["at"] - 1) * 4096 : r["at"] * 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    known = docs.sparkSession.sparkContext.broadcast(marks)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            at = b["tag"].to_numpy().view(np.uint64) >> np.uint64(64 - MAP_BITS)
            b = b[(known.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1]
            sets = [shingles(t).tobytes() for t in b["t"]]
            yield pd.DataFrame({"tag": b["tag"], "digest": [hashlib.blake2b(s, digest_size=16).digest() for s in sets], "n": [len(s) // 8 for s in sets], "hashes": sets})

    made = _rows(docs).select("t", "tag").mapInPandas(run, "tag long, digest binary, n long, hashes binary")
    return made.join(wanted, ["tag", "digest"]).dropDuplicates(["key"]).select("component", "key", "n", "hashes")


def components(docs: DataFrame, bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """key, doc_id, tag, n, head (the key that stands for the component) of every row."""
    sig = signatures(docs)
    groups = sig.where("n > 0").groupBy("digest").agg(F.min_by("key", F.struct("doc_id", "key")).alias("rep"), F.count("*").alias("copies"))
    reps = materialize(groups, "representatives")
    n_docs, n_hashes = reps.count(), sig.agg(F.sum(F.octet_length("prefix")) / 6).first()[0] or 0
    buckets = 1 << max(3, int(n_hashes // bucket).bit_length())
    own = reps.select(F.col("rep").alias("key"))
    shared = materialize(_shared(sig, own, _hot(sig, n_docs), buckets), "shared")
    least = shared.groupBy("h").agg(F.min("key").alias("b"), F.count("*").alias("c")).where("c > 1").select("h", "b")
    coarse = connected_components(shared.join(least, "h").where("key <> b").select(F.col("key").alias("a"), "b").distinct())
    wanted = coarse.select(F.col("node").alias("key"), "component").join(sig.select("key", "tag", "digest"), "key")
    wanted = materialize(wanted, "wanted")
    members = materialize(_fetch(docs, wanted), "members")
    linked = connected_components(_links(members, block))
    remove(shared, wanted, members, coarse)
    linked = linked.select(F.col("node").alias("rep"), F.col("component").alias("head"))
    # Copies: only groups of two or more and linked ones are joined, the copies dealt over salts.
    known = reps.join(linked, "rep", "left").where("copies > 1 OR head IS NOT NULL").select("digest", F.coalesce("head", "rep").alias("head"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    rows = sig.select("key", "doc_id", "tag", "n", "digest", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int").alias("salt"))
    joined = rows.join(known.select("digest", "head", salts), ["digest", "salt"], "left")
    return joined.select("key", "doc_id", "tag", "n", F.coalesce("head", "key").alias("head"))


def jaccard_join(docs: DataFrame, bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text)."""
    rows = materialize(components(docs, bucket, block), "components")
    # Single rows name themselves, so only true groups meet by head; copies are summed before they move.
    least = rows.groupBy("head").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("c")).where("c > 1")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    out = rows.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")).join(least.select("head", "component_id", salts), ["head", "salt"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component (least doc_id, then first read); all columns kept."""
    rows = materialize(components(docs), "components")
    # Heads of single rows never meet another row; of the others the counts combine before they move.
    groups = rows.groupBy("head").agg(F.min_by("key", F.struct("doc_id", "key")).alias("stay"), F.count("*").alias("c")).where("c > 1")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    placed = rows.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")).join(groups.select("head", "stay", salts), ["head", "salt"])
    # Rows that repeat id and text are settled by exact_dedup.keep_one, not here: they stay or go together.
    ids = placed.groupBy("doc_id", "tag").agg(F.max(F.col("key") == F.col("stay")).alias("stays")).where("NOT stays")
    gone = ids.select(F.col("doc_id").alias("gone_id"), "tag")
    text = F.coalesce(F.col("text"), F.lit(""))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("own_id"), F.xxhash64(text, "doc_id").alias("own_tag"))
    # The tag alone could be that of another document; with the id it is not.
    kept = whole.join(gone, (F.col("own_tag") == F.col("tag")) & F.col("own_id").eqNullSafe(F.col("gone_id")), "left_anti")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
