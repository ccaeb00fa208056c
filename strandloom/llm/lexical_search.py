"""Exact ranked lexical search with hashed max-sketches.

A document's impact of a term is (10^9 tf) div (1000 tf + 20 m), with m from its length; an item's score sums
weight times impact over its terms.

1. One pass counts N, L and the document frequency of every term of the items, from which weights follow.
2. Each document's impacts fold into a *sketch*: terms are hashed to coordinates, and a coordinate keeps the
   greatest impact of its terms.  Looking up an item's terms there can only overstate, so weights times looked
   up impacts bound the score from above.  A batch of sketches times a matrix of weights bounds a batch of
   documents for all items at once.
3. A task scores documents of an item exactly in the order of falling bounds, until the bound is below the
   ``k``-th best score that it has seen; that threshold stays for its later batches.
4. Each task hands on ``k`` rows an item; they are merged in two steps.

Items are taken in blocks of at most ``TERMS`` distinct terms, so what is broadcast is bounded; their number
multiplies the passes over documents.  No list of a term's documents is ever gathered.

Defined results: a null text has no terms; a document without terms is never found, and an item without
terms finds nothing.  Ids of documents are whole numbers; equal scores go by ascending id, null ids last, and rows
that repeat an id are ranked one after the other.  Other columns are ignored, whatever their names.  Every row of
the items gives its own ranks, repeated ids too.  No rows give no rows.  Long texts are cut in blocks.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

K = 50
WIDTH = 1 << 14  # coordinates of a sketch
TERMS = 100_000  # distinct terms of the items that are searched together
BATCH = 256  # documents bounded together
MERGED = 32  # tasks whose rows meet in the first merge
BLOCK = 1 << 22  # bytes of a text that are cut into terms at a time
LAST = (1 << 63) - 1
SPACE = re.compile(b" ")
# What is no part of a term becomes a space; only A-Z change case; bytes of code points above 7F stay.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def term_counts(text: str | None) -> Counter[bytes]:
    data, at, out = (text or "").encode("utf-8", "surrogatepass").translate(TABLE), 0, Counter()
    while at < len(data):
        stop = at + BLOCK
        if stop < len(data):
            found = SPACE.search(data, stop)
            stop = found.start() if found else len(data)
        out.update(data[at:stop].split())
        at = stop
    return out


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_factor(n: int, n_docs: int, total: int) -> int:
    return 50 + (50 * n * n_docs) // total


def impacts(tf: np.ndarray, m: int) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def _statistics(docs: DataFrame, terms: dict[bytes, int]) -> tuple[int, int, np.ndarray]:
    """N, L and the document frequencies of ``terms``."""
    known = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = len(known.value)
        df, docs_, total = np.zeros(size + 1, np.int64), 0, 0
        for b in batches:
            for text in b["text"]:
                c = term_counts(text)
                docs_ += bool(c)
                total += c.total()
                df[[known.value.get(t, size) for t in c]] += 1
        at = np.flatnonzero(df[:size])
        yield pd.DataFrame({"term": [-1, -2, *at.tolist()], "n": [docs_, total, *df[at].tolist()]})

    rows = docs.select("text").mapInPandas(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()  # a row a term of the items
    told = {r.term: r.n for r in rows}
    return told.get(-1, 0), told.get(-2, 0), np.array([told.get(i, 0) for i in range(len(terms))], np.int64)


class _Best:
    """The ``k`` best (score, id) of an item so far; of equal scores the lesser id."""

    def __init__(self, k: int) -> None:
        self.k, self.heap = k, []

    def least(self) -> int:
        """No lower score can enter; scores start at 1."""
        return self.heap[0][0] if len(self.heap) == self.k else 1

    def add(self, score: int, doc: int) -> None:
        if len(self.heap) < self.k:
            heapq.heappush(self.heap, (score, -doc))
        elif (score, -doc) > self.heap[0]:
            heapq.heapreplace(self.heap, (score, -doc))


class Searcher:
    """Bounds and scores of batches of documents for a block of items."""

    def __init__(self, terms: dict[bytes, int], items: list[np.ndarray], n_docs: int, total: int, df: np.ndarray, k: int, width: int) -> None:
        import xxhash

        self.hash, self.terms, self.items, self.n_docs, self.total, self.width = xxhash.xxh3_64_intdigest, terms, items, n_docs, total, width
        weights = np.array([weight(n_docs, int(d)) for d in df], np.int64)
        self.weights = [weights[i] for i in items]
        coordinate = np.fromiter((self.hash(t) % width for t in terms), np.int64, len(terms))
        used = np.unique(coordinate)
        self.column = np.full(width, -1)
        self.column[used] = np.arange(len(used))
        self.matrix = np.zeros((len(used), len(items)))
        for k_, (i, w) in enumerate(zip(items, self.weights)):
            np.add.at(self.matrix[:, k_], self.column[coordinate[i]], w)
        self.best, self.scored = [_Best(k) for _ in items], 0

    def add(self, texts: list[str | None], docs: list[int]) -> None:
        sketch, exact, ids = np.zeros((len(texts), self.matrix.shape[0])), [], []
        for text, doc in zip(texts, docs):
            c = term_counts(text)
            if not c:
                continue
            tf = np.fromiter(c.values(), np.int64, len(c))
            impact = impacts(tf, length_factor(int(tf.sum()), self.n_docs, self.total))
            column = self.column[np.fromiter((self.hash(t) % self.width for t in c), np.int64, len(c))]
            some = column >= 0
            np.maximum.at(sketch[len(ids)], column[some], impact[some])
            own = np.fromiter((self.terms.get(t, -1) for t in c), np.int64, len(c))
            exact.append((own[own >= 0], impact[own >= 0]))
            ids.append(doc)
        bounds = sketch[: len(ids)] @ self.matrix * (1 + 1e-9)
        impact_of = np.zeros(len(self.terms), np.int64)
        for item, best in enumerate(self.best):
            hope = np.flatnonzero(bounds[:, item] >= best.least())
            for row in hope[np.argsort(-bounds[hope, item], kind="stable")]:
                if bounds[row, item] < best.least():
                    break
                at, value = exact[row]
                impact_of[at] = value
                score = int((impact_of[self.items[item]] * self.weights[item]).sum())
                impact_of[at] = 0
                self.scored += 1
                if score > 0:
                    best.add(score, ids[row])


def _blocks(items: DataFrame, most: int) -> Iterator[tuple[list[Row], dict[bytes, int], list[np.ndarray]]]:
    """Items one by one from the cluster, in blocks of at most ``most`` distinct terms (one item at least)."""
    rows, terms, lists = [], {}, []
    for r in items.select("item_id", "text").toLocalIterator():
        own = term_counts(r.text)
        if rows and len(terms) + len(own) > most:
            yield rows, terms, lists
            rows, terms, lists = [], {}, []
        rows.append(r)
        lists.append(np.array([terms.setdefault(t, len(terms)) for t in own], np.int64))
    if rows:
        yield rows, terms, lists


def search(docs: DataFrame, items: DataFrame, k: int = K, width: int = WIDTH, terms: int = TERMS, batch: int = BATCH) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best of ``docs`` (doc_id, text) for each row of ``items`` (item_id, text)."""
    spark = docs.sparkSession
    rows = docs.select("text", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("ord"))
    out = None
    for block, known, lists in _blocks(items, terms):
        n_docs, total, df = _statistics(docs, known)
        told = spark.sparkContext.broadcast((known, lists, n_docs, total, df))

        def run(batches: Iterator[pd.DataFrame], told=told) -> Iterator[pd.DataFrame]:
            s = Searcher(*told.value, k, width)
            for b in batches:
                text, ids = b["text"].tolist(), b["ord"].tolist()
                for i in range(0, len(b), batch):
                    s.add(text[i : i + batch], ids[i : i + batch])
            found = [(i, score, -doc) for i, best in enumerate(s.best) for score, doc in best.heap]
            yield pd.DataFrame(found, columns=["item", "score", "ord"])

        found = rows.mapInPandas(run, "item int, score long, ord long").withColumn("part", F.floor(F.spark_partition_id() / MERGED))
        order = [F.desc("score"), "ord"]
        for keys in (["item", "part"], ["item"]):
            found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
        ids = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(block)], f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")
        doc = F.when(F.col("ord") < LAST, F.col("ord"))
        part = found.join(F.broadcast(ids), "item").select("item_id", F.col("rank").cast("int").alias("rank"), doc.cast(docs.schema["doc_id"].dataType).alias("doc_id"), "score")
        out = part if out is None else out.unionByName(part)
    if out is None:
        none = items.select("item_id").where(F.lit(False))
        return none.select("item_id", F.lit(0).alias("rank"), F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"), F.lit(0).cast("long").alias("score"))
    return out


ORACLE = r"""
WITH t AS (SELECT r, doc_id, unnest(regexp_extract_all(x, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM
 (SELECT row_number() OVER () AS r, doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents)),
d AS (SELECT r, doc_id, count(*) AS n FROM t GROUP BY r, doc_id),
g AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM d),
q AS (SELECT DISTINCT r AS item, item_id, unnest(regexp_extract_all(x, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM
 (SELECT row_number() OVER () AS r, item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM benchmark)),
f AS (SELECT r, doc_id, t, count(*) AS tf FROM t GROUP BY r, doc_id, t),
w AS (SELECT t, floor(1000 * ln((2.0::DOUBLE * big_n + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w FROM f, g GROUP BY t, big_n),
i AS (SELECT f.r, f.doc_id, f.t, (1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * big_n) // big_l))) AS s FROM f JOIN d ON d.r = f.r, g),
a AS (SELECT item, item_id, i.r, i.doc_id, sum(w * s)::BIGINT AS score FROM q JOIN i ON i.t = q.t JOIN w ON w.t = q.t GROUP BY item, item_id, i.r, i.doc_id),
k AS (SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM a WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 50
"""
