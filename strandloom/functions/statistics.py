"""Closed-form statistics as Columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Z95 = 1.959963984540054  # the normal quantile of a 95 % interval


def wilson(k: Column, n: Column) -> tuple[Column, Column, Column]:
    """(fraction, low, high): Wilson's interval, widened to hold the fraction; NULL without trials."""
    p, z2 = k / n, Z95 * Z95
    scale = 1 + z2 / n
    middle = (p + z2 / (2 * n)) / scale
    half = F.lit(Z95) * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n)) / scale
    some = n > 0
    return F.when(some, p), F.when(some, F.greatest(F.lit(0.0), F.least(p, middle - half))), F.when(some, F.least(F.lit(1.0), F.greatest(p, middle + half)))


def odds_ratio(a: Column, b: Column, c: Column, d: Column) -> Column:
    """(a/b) over (c/d), each count raised by a half."""
    return ((a + 0.5) * (d + 0.5)) / ((b + 0.5) * (c + 0.5))


def rank_score(seed: int, key: Column, replicate: int | None = None, domain: bytes = b"subsample-v1\0") -> Column:
    """A hex digest that ranks ids for seeded sampling, the same on every engine and at every size.

    ``domain`` separates uses of one seed; give the prefix of another tool to draw its samples.
    """
    parts = [domain, seed.to_bytes(8, "little")]
    if replicate is not None:
        parts.append(replicate.to_bytes(8, "little"))
    head = b"".join(parts) + b"\0"
    return F.sha2(F.concat(F.lit(bytearray(head)), F.encode(key, "utf-8")), 256)


def quantiles(rows: DataFrame, keys: list[str], value: str, at: dict[str, float]) -> DataFrame:
    """``keys`` and a column for each entry of ``at``: exact quantiles that interpolate linearly, NULL values left out.

    Equal values are counted before anything is ordered, and running sums of counts tell which value has a rank: a
    window of distinct values that can spill, where an aggregate would hold a group in one buffer.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    order = Window.partitionBy(*keys).orderBy(value)
    told = counts.withColumn("upto", F.sum("n").over(order)).withColumn("all", F.sum("n").over(Window.partitionBy(*keys)))
    rank = {name: (F.col("all") - 1) * q for name, q in at.items()}
    has = lambda k: F.min(F.when(F.col("upto") > k, F.col(value)))
    ends = [e for name, r in rank.items() for e in (has(F.floor(r)).alias(f"{name}_low"), has(F.ceil(r)).alias(f"{name}_high"), F.max(r - F.floor(r)).alias(f"{name}_part"))]
    between = lambda name: F.col(f"{name}_low") + (F.col(f"{name}_high") - F.col(f"{name}_low")) * F.col(f"{name}_part")
    return told.groupBy(*keys).agg(*ends).select(*keys, *[between(name).alias(name) for name in at])
