"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words.  Each passage is encoded from its own words
alone (letter classes, word shapes, repeated words and lines, hashed words; then a learned layer), a
gated attention learned from document labels alone weighs the passages, and the weighted sum is
scored by a logistic layer:

    h = tanh(W x + b);  a = softmax(w . (tanh(V h) * sigmoid(U h)));  score = sigmoid(c . sum(a h) + d)

Labels are learned only from rows with crc32(doc_id as text) mod 3 <> 1.  The fit takes a bounded
sample of rows, the same at every size: the ``SAMPLE`` labels of least hash, one document each, until their texts
reach ``SAMPLE_BYTES`` together, each with all its passages.  Their measures (some half of the texts' size) reach the
driver, where the few thousand weights are fitted; scoring reads every passage of every whole text in one narrow
stage and holds the measures of ``SCORED_BYTES`` of text at a time.

Defined results: null and empty texts are one empty passage and get a score like all others; without
labels of both kinds the score is the known share of label 1 (0.5 without any).  Labels that are null or whose
document is missing are left out; of several labels of one doc_id the greatest counts, of several
documents the one of least hash.  Repeated ids and rows are scored one by one.  Labels, lang, source,
doc_id and any further column are never inputs of a score.  No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import with_id

PASSAGE = 100
SAMPLE = 4000
SAMPLE_BYTES = 128 << 20  # of the texts of the fitted sample together
SCORED_BYTES = 8 << 20  # of texts whose measures are held at once
BINS = 64
HIDDEN = 24
ATTENTION = 12
# Classes of bytes, one a row; a byte belongs to the first class that holds it.
CLASSES = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b".", b",", b"!", b"?", b"|", b"#*$%&<>~^", b"\"'`", b"-_", b"()[]{}", b"/:@;=+\\")
_CLASS = np.full(256, len(CLASSES), np.int64)
_CLASS[128:192], _CLASS[192:] = len(CLASSES) + 1, len(CLASSES) + 2
for _k, _c in enumerate(CLASSES):
    _CLASS[list(_c)] = _k
N_CLASSES = len(CLASSES) + 3
WIDTH = N_CLASSES + BINS + 6


def passages(text: str) -> np.ndarray:
    """One row of measures for each passage of a text."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return np.zeros((1, WIDTH), np.float32)
    n = -(-len(words) // PASSAGE)
    start = np.arange(0, len(words), PASSAGE)
    size = np.diff(np.append(start, len(words)))
    of = np.repeat(np.arange(n), size)
    length = np.fromiter(map(len, words), np.int64, len(words))
    code = np.fromiter(map(crc32, words), np.int64, len(words))
    chars = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    byte_of = np.repeat(of, length + 1)
    kinds = np.bincount(byte_of * N_CLASSES + _CLASS[chars], minlength=n * N_CLASSES).reshape(n, -1)
    bins = np.bincount(of * BINS + code % BINS, minlength=n * BINS).reshape(n, -1)
    different = np.bincount(np.unique(of << 32 | code) >> 32, minlength=n)
    mean = np.add.reduceat(length, start) / size
    again, breaks = _line_measures(data, words, n)
    more = np.column_stack([np.log1p(size), mean, np.maximum.reduceat(length, start) ** 0.5, different / size, again, breaks / size])
    return np.hstack([kinds / np.bincount(byte_of)[:, None], np.sqrt(bins / size[:, None]), more]).astype(np.float32)


def _line_measures(data: bytes, words: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each passage: the share of its lines that repeat one of its own, and how many lines end in it."""
    again, breaks, at = np.zeros(n), np.zeros(n), 0
    lines: dict[int, list[int]] = {}
    for line in data.split(b"\n"):
        k = len(line.split())
        if k:
            passage = min(at // PASSAGE, n - 1)
            at += k
            breaks[passage] += 1
            lines.setdefault(passage, []).append(hash(line))
    for passage, own in lines.items():
        again[passage] = 1 - len(set(own)) / len(own)
    return again, breaks


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class AttentionModel:
    """Encoder, gated attention and logistic score over bags of passages."""

    def __init__(self, width: int = WIDTH, seed: int = 7, attend: bool = True) -> None:
        self.attend = attend  # without it passages weigh the same (to tell what attention adds)
        rng = np.random.default_rng(seed)
        init = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
        self.p = {"W": init(width, HIDDEN), "b": np.zeros(HIDDEN), "V": init(HIDDEN, ATTENTION), "U": init(HIDDEN, ATTENTION), "w": init(ATTENTION), "c": init(HIDDEN), "d": np.zeros(1)}
        self.mean, self.std, self.constant = np.zeros(width), np.ones(width), None

    def forward(self, x: np.ndarray, start: np.ndarray) -> dict:
        """``start``: the first row of each bag in ``x``."""
        p, n = self.p, np.diff(np.append(start, len(x)))
        of = np.repeat(np.arange(len(start)), n)
        x = (x - self.mean) / self.std
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * g) @ p["w"] if self.attend else np.zeros(len(x))
        e = np.exp(e - np.maximum.reduceat(e, start)[of])
        a = e / np.add.reduceat(e, start)[of]
        z = np.add.reduceat(a[:, None] * h, start)
        return {"x": x, "of": of, "h": h, "t": t, "g": g, "a": a, "z": z, "y": _sigmoid(z @ p["c"] + p["d"])}

    def gradients(self, f: dict, start: np.ndarray, y: np.ndarray) -> dict:
        p, of = self.p, f["of"]
        dy = (f["y"] - y) / len(y)
        dz = dy[:, None] * p["c"]
        da = (dz[of] * f["h"]).sum(1)
        de = self.attend * f["a"] * (da - np.add.reduceat(f["a"] * da, start)[of])
        dtg = de[:, None] * p["w"]
        dt, dg = dtg * f["g"] * (1 - f["t"] ** 2), dtg * f["t"] * f["g"] * (1 - f["g"])
        dh = f["a"][:, None] * dz[of] + dt @ p["V"].T + dg @ p["U"].T
        du = dh * (1 - f["h"] ** 2)
        return {"W": f["x"].T @ du, "b": du.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ dg, "w": (f["t"] * f["g"]).T @ de, "c": f["z"].T @ dy, "d": np.array([dy.sum()])}

    def fit(self, bags: list[np.ndarray], y: np.ndarray, epochs: int = 40, rate: float = 0.01, decay: float = 1e-4, batch: int = 64) -> AttentionModel:
        if len(set(y.tolist())) < 2:
            self.constant = float(y.mean()) if len(y) else 0.5
            return self
        every = np.concatenate(bags)
        self.mean, self.std = every.mean(0), every.std(0) + 1e-3
        rng, step = np.random.default_rng(11), 0
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        for _ in range(epochs):
            order = rng.permutation(len(bags))
            for low in range(0, len(bags), batch):
                some = order[low : low + batch]
                size = np.array([len(bags[i]) for i in some])
                start = np.cumsum(size) - size
                g = self.gradients(self.forward(np.concatenate([bags[i] for i in some]), start), start, y[some])
                step += 1
                for k, x in self.p.items():
                    d = g[k] + decay * x
                    m[k], v[k] = 0.9 * m[k] + 0.1 * d, 0.999 * v[k] + 0.001 * d * d
                    x -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def score(self, bags: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Score of each bag and the greatest attention weight in it."""
        if self.constant is not None or not bags:
            return np.full(len(bags), self.constant if self.constant is not None else 0.5), np.ones(len(bags))
        size = np.array([len(b) for b in bags])
        start = np.cumsum(size) - size
        f = self.forward(np.concatenate(bags), start)
        return f["y"], np.maximum.reduceat(f["a"], start)


def _held_out(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES, attend: bool = True) -> AttentionModel:
    """Fit on all passages of at most ``sample`` labelled documents outside the held-out third.

    The sample is dealt by a hash of the id and ends where its texts reach ``sample_bytes`` together; a text longer than
    that by itself is never sampled.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("int").alias("label")).where(~_held_out())
    few = known.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select("doc_id", F.octet_length(text).cast("long").alias("size")).join(F.broadcast(few), "doc_id")  # few: bounded by sample
    sized = sized.groupBy("doc_id").agg(F.max("size").alias("size")).where(F.col("size") <= sample_bytes)
    upto = F.sum("size").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))  # at most sample rows, of two numbers each
    chosen = few.join(sized.withColumn("upto", upto).where(F.col("upto") <= sample_bytes).select("doc_id"), "doc_id")
    rows = docs.select("doc_id", text.alias("t")).join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id", "label").agg(F.min_by("t", F.xxhash64("t")).alias("t"))  # at most sample rows

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part in slices(b, SCORED_BYTES):
                yield pd.DataFrame({"doc_id": part["doc_id"].astype(str), "label": part["label"], "x": [passages(t).tobytes() for t in part["t"]]})

    got = rows.mapInPandas(run, "doc_id string, label int, x binary").toLocalIterator()
    got = sorted(((r["doc_id"], r["label"], np.frombuffer(bytes(r["x"]), np.float32).reshape(-1, WIDTH)) for r in got), key=lambda r: r[0])
    return AttentionModel(attend=attend).fit([x for *_, x in got], np.array([y for _, y, _ in got], float))


def slices(b: pd.DataFrame, size: int) -> Iterator[pd.DataFrame]:
    """``b`` in parts of about ``size`` characters of text, a row at least."""
    of = (b["t"].str.len().cumsum() // size).to_numpy()
    cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(b)]
    for low, high in zip(cuts[:-1], cuts[1:]):
        if low < high:
            yield b.iloc[low:high]


def score(docs: DataFrame, model: AttentionModel) -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages, top_weight of every row."""
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for b in slices(whole, SCORED_BYTES):
                bags = [passages(t) for t in b["t"]]
                y, top = known.value.score(bags)
                yield pd.DataFrame({"doc_id": b["doc_id"], "held_out": b["held_out"], "score": y, "predicted": (y >= 0.5).astype(int), "n_passages": [len(x) for x in bags], "top_weight": top})

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce(_held_out(), F.lit(False)).alias("held_out"), F.coalesce(F.col("text"), F.lit("")).alias("t"))
    return with_id(rows.mapInPandas(run, "doc_id string, held_out boolean, score double, predicted int, n_passages long, top_weight double"), kind)


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> DataFrame:
    return score(docs, train(docs, labels, label, sample))
