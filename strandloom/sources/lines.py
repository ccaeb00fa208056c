"""Text files with what depends on all lines before: numbers of lines, and places in the sequences of FASTA files.

Nothing runs over a whole file.  Each split of a file is summed up in a row, a prefix scan over these rows tells
what each split begins with, and the lines take it from there.  The rows of splits are few (one for each task that
reads), so they are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SPLIT = ["path", "block"]


def _raw(spark: SparkSession, path: str) -> DataFrame:
    """path, block (start of the split), i (rising by one from line to line of a split), value."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("i"), "value")


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """path, line (from 1, as editors count), value of the files at ``path``."""
    raw = _raw(spark, path)
    splits = raw.groupBy(*SPLIT).agg(F.min("i").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = splits.select(*SPLIT, (F.coalesce(F.sum("n").over(before), F.lit(0)) + 1 - F.col("first")).alias("shift"))
    return raw.join(F.broadcast(placed), SPLIT).select("path", (F.col("i") + F.col("shift")).alias("line"), "value")


def sequences(spark: SparkSession, path: str) -> DataFrame:
    """chrom, at, value: the lines of bases of FASTA files with their places in their sequences."""
    shape = "path string, block long, i long, head string, at long, value string"

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split, head, at = None, None, 0
        for b in batches:
            for key, part in b.groupby(SPLIT, sort=False):
                if key != split:
                    split, head, at = key, None, 0
                part = part.reset_index(drop=True)
                text = part["value"].str.rstrip()
                named = text.str.startswith(">")
                size = text.str.len().where(~named, 0)
                run = named.cumsum().to_numpy()
                before = size.groupby(run).cumsum() - size
                heads = [head, *(x[1:].split(maxsplit=1)[0] if x[1:].strip() else "" for x in text[named])]
                part["head"] = [heads[k] for k in run]
                part["at"] = before + at * (run == 0)
                part["value"] = text.where(~named)
                head, at = heads[-1], int(part["at"].iloc[-1] + size.iloc[-1])
                yield part[["path", "block", "i", "head", "at", "value"]]

    lines = _raw(spark, path).mapInPandas(place, shape)
    end = F.struct("head", (F.col("at") + F.coalesce(F.length("value"), F.lit(0))).alias("at"))
    splits = lines.groupBy(*SPLIT).agg(F.max_by(end, "i").alias("end")).select(*SPLIT, "end.head", F.col("end.at").alias("tail"))
    order = Window.partitionBy("path").orderBy("block")
    runs = splits.withColumn("run", F.count("head").over(order))
    # A split without a header goes on with the sequence that the splits before it ended in.
    summed = runs.withColumn("far", F.sum("tail").over(Window.partitionBy("path", "run").orderBy("block")))
    carried = summed.select(*SPLIT, F.last("head", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("open"), F.coalesce(F.lag("far").over(order), F.lit(0)).alias("shift"))
    whole = lines.where("value <> ''").join(F.broadcast(carried), SPLIT)
    return whole.select(F.coalesce("head", "open").alias("chrom"), (F.col("at") + F.when(F.col("head").isNull(), F.col("shift")).otherwise(0)).alias("at"), "value").where("chrom IS NOT NULL")
