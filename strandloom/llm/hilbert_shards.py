"""Sharding along a Hilbert curve: quantise several metadata columns, sort by curve index, cut runs.

Rows close on the curve are close in every dimension, so each shard (a run of the curve) covers a
small box of the metadata space, and a filter on any dimension skips the shards whose box misses it.

Numeric dimensions are cut at equal-depth quantiles taken over all rows; text dimensions in the order of
their values at the same depths (a value with many rows takes the cells it fills), so neighbouring cells
hold neighbouring values and range filters prune as well as equality.  Texts never move: only ids, sizes,
checksums and curve indexes are sorted.  The rank of a row is its partition's offset plus its place
there, so no task or driver ever holds more than a range of the curve, and a cell with a third of
all rows is spread by the further sort keys (checksum, id, place of reading).

As doc_id is a dimension, rows with equal texts may lie in different shards.

Law ``rows``: shard s holds ranks [ceil(s*n/S), ceil((s+1)*n/S)), so counts differ by one at most.

Defined results: a null text has no bytes; null metadata is in the lowest cell; ties of the curve index follow checksum and id; repeated rows are placed one by one; an empty
table gives no rows.  Columns that are not dimensions are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize

BITS = 8
DIMENSIONS = ("lang", "source", "size", "doc_id")


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of each row of ``cells`` (n rows, one column a dimension, values < 2**bits)."""
    x = [c.astype(np.int64).copy() for c in cells.T]
    dims, q = len(x), 1 << (bits - 1)
    while q > 1:  # undo the rotations of each level, coarse to fine
        p = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
        q >>= 1
    for i in range(1, dims):
        x[i] = x[i] ^ x[i - 1]
    t, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        t = np.where((x[-1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    out = np.zeros_like(t)
    for b in range(bits - 1, -1, -1):
        for v in x:
            out = (out << 1) | (((v ^ t) >> b) & 1)
    return out


def _cells(frame: DataFrame, dims: tuple[str, ...], bits: int) -> list[Column]:
    """The cell of each dimension: the share of rows before the value, in steps of 1 / 2**bits."""
    kinds = {c: frame.schema[c].dataType for c in dims}
    numbers = [c for c in dims if isinstance(kinds[c], T.NumericType)]
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = frame.agg(*[F.percentile_approx(F.col(c), steps, 20_000).alias(c) for c in numbers]).first() if numbers else None

    def cell(c: str) -> Column:
        if c not in numbers:
            first = _text_cuts(frame, c, 1 << bits)
            at, depth = np.array([v for v, _ in first], dtype=object), np.array([0] + [k for _, k in first])
            return _place(at, depth)(F.coalesce(F.col(c).cast("string"), F.lit("")))
        at = np.array(cuts[c] or [], dtype=float)
        return _place(at, np.arange(len(at) + 1))(F.coalesce(F.col(c), F.lit(int(at[0]) - 1 if len(at) else 0)).cast("double"))

    return [cell(c) for c in dims]


def _place(cuts: np.ndarray, cell: np.ndarray):
    @F.pandas_udf("int")
    def place(v: pd.Series) -> pd.Series:
        return pd.Series(cell[np.searchsorted(cuts, v.to_numpy(cuts.dtype), side="right")])

    return place


def _text_cuts(frame: DataFrame, c: str, cells: int) -> list[tuple[str, int]]:
    """The first value of each cell, at most ``cells`` of them: a value's cell is the share of rows before it.

    Values are counted over all rows; the running share is taken by ranges of values, so neither a
    task nor the driver holds more than ``cells`` of them.
    """
    counted = frame.groupBy(F.coalesce(F.col(c).cast("string"), F.lit("")).alias("v")).agg(F.count("*").alias("n"))
    ranged = counted.repartitionByRange("v").sortWithinPartitions("v").select("v", "n", F.spark_partition_id().alias("part"))
    ranged = materialize(ranged, "shard-values")
    sums = ranged.groupBy("part").agg(F.sum("n").alias("sum"))  # one row a partition
    before = F.coalesce(F.sum("sum").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select("part", before.alias("before"), F.sum("sum").over(Window.partitionBy()).alias("total"))
    running = F.sum("n").over(Window.partitionBy("part").orderBy("v")) + F.col("before")
    cell = F.floor((F.col("upto") - F.col("n")) * cells / F.col("total")).cast("int")
    first = ranged.join(sums, "part").select("v", "n", "total", running.alias("upto")).groupBy(cell.alias("cell")).agg(F.min("v").alias("v"))
    return sorted((r.v, r.cell) for r in first.collect())


def hilbert_shards(docs: DataFrame, shards: int = 8, dims: tuple[str, ...] = DIMENSIONS, bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, curve for every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    own = {"size": F.octet_length(text).cast("long") + 1, "text_crc32": F.crc32(text.cast("binary")), "doc_id": F.col("doc_id")}
    rest = [c for c in dims if c not in own]
    meta = materialize(docs.select(*[v.alias(k) for k, v in own.items()], *[F.col(f"`{c}`").alias(f"dim_{c}") for c in rest]), "shard-meta")
    dims = tuple(c if c in own else f"dim_{c}" for c in dims)

    @F.pandas_udf("long")
    def index(*cols: pd.Series) -> pd.Series:
        return pd.Series(curve_index(np.column_stack([c.to_numpy() for c in cols]), bits))

    rows = meta.select("doc_id", "size", "text_crc32", index(*_cells(meta, dims, bits)).alias("curve"), F.monotonically_increasing_id().alias("read_at"))
    keys = ["curve", "text_crc32", "doc_id", "read_at"]
    run = materialize(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("*", F.monotonically_increasing_id().alias("at")), "shard-run")
    low = (1 << 33) - 1  # the bits below the partition's number
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit(low))
    # One row a partition, so a single window over them is small; it is joined without a broadcast hint.
    sizes = run.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    total = F.sum("n").over(Window.partitionBy())
    offsets = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"), total.alias("total"))
    ranked = run.withColumn("part", part).join(offsets, "part").withColumn("rank", F.col("before") + place)
    n, s = F.col("total"), F.lit(shards)
    shard = F.expr(f"(rank * {shards}) div total").cast("int")
    start = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return ranked.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("rank") - start).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve"
    )


def boxes(placed: DataFrame, dims: list[str]) -> DataFrame:
    """The least and greatest value of each dimension in each shard: what a filter prunes by."""
    sides = [f(c).alias(f"{n}_{c}") for c in dims for n, f in (("min", F.min), ("max", F.max))]
    return placed.groupBy("shard").agg(F.count("*").alias("n"), *sides)
