"""Helpers shared by the training-data operators: shared storage, cut lineage, components."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAP_BITS = 28  # bits of the largest bitmap


def shared_dir(spark: SparkSession, tag: str) -> str:
    """A new folder name below the cluster's shared checkpoint folder.

    Only where the session names none and runs on this machine alone a folder of this machine is set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="strandloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/strandloom/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, and survives lost executors."""
    path = shared_dir(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_id(df: DataFrame, kind: str) -> DataFrame:
    """Give back the type of doc_id, which passes pandas as text: NULLs would make floats of integers there."""
    return df.withColumn("doc_id", F.col("doc_id").cast(kind))


def remove(*frames: DataFrame) -> None:
    """Delete the files that materialized frames read, once nothing reads them any more."""
    for df in frames:
        spark = df.sparkSession
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for parent in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(parent)
            path.getFileSystem(conf).delete(path, True)


class Bitmap:
    """A bitmap over 64-bit numbers, made by Spark and held as one broadcast until it is released.

    It has 16 bits a row, but no more than 2**MAP_BITS: beyond that false hits become frequent.
    """

    def __init__(self, rows: DataFrame, column: str) -> None:
        self.bits = min(MAP_BITS, max(15, int(16 * rows.count()).bit_length()))
        at = F.shiftrightunsigned(column, 64 - self.bits) + 1
        found = rows.groupBy(F.bitmap_bucket_number(at).alias("at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
        marks = np.zeros((1 << self.bits) // 8, np.uint8)
        for r in found.toLocalIterator():
            marks[(r["at"] - 1) * 4096 : r["at"] * 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
        self.marks = rows.sparkSession.sparkContext.broadcast(marks)

    def __call__(self, v: np.ndarray) -> np.ndarray:
        at = v.view(np.uint64) >> np.uint64(64 - self.bits)
        return (self.marks.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def release(self) -> None:
        """Once what was made with it is written, so that no lost task can ask for it again."""
        self.marks.destroy()


def connected_components(edges: DataFrame, max_rounds: int = 60, heavy: int = 512) -> DataFrame:
    """(node, component) for every node of ``edges`` (a long, b long); component is the least node.

    Alternates large-star and small-star steps: each round is two shuffles of the edge list, the
    number of rounds is logarithmic, and no list of neighbours is ever collected.  Least neighbours
    are found by an aggregate that combines before it shuffles.  A hub's edges are not gathered to
    learn them: nodes with more than 1/``heavy`` of the edges (so at most 2 * ``heavy`` of them) are
    looked up in a broadcast of that bounded size, the others meet by shuffle.  Each round's
    edges go to the shared folder.  Loops and repeated edges are allowed; no rows give no rows.
    """
    cur = materialize(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "cc"
    )
    rows = cur.count()

    def step(e: DataFrame, large: bool, most: int) -> DataFrame:
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else e
        low = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("degree")).select("a", F.least("a", "m").alias("m"), "degree")
        hubs = F.broadcast(low.where(F.col("degree") > most).select("a", F.col("m").alias("hub")))
        told = both.join(hubs, "a", "left")
        usual = told.where("hub IS NULL").drop("hub").join(low.where(F.col("degree") <= most).select("a", "m"), "a")
        joined = usual.select("a", "b", "m").union(told.where("hub IS NOT NULL").select("a", "b", "hub"))
        if large:
            return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        hub = low.where("m < a").select("a", F.col("m").alias("b"))
        rest = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return hub.union(rest).where("a <> b").distinct()

    for _ in range(max_rounds):
        most = max(1000, rows // heavy)
        wide = materialize(step(cur, True, most), "cc")
        nxt = materialize(step(wide, False, most), "cc")
        rows, tails = nxt.agg(F.count("*"), F.count_distinct("a")).first()
        # Done when each node points at one other, and that one at none: then it is the least.
        done = rows == tails and not nxt.select("b").distinct().join(nxt.select(F.col("a").alias("b")), "b", "left_semi").limit(1).count()
        remove(cur, wide)
        cur = nxt
        if done:
            break
    else:
        raise RuntimeError("components did not settle")
    heads = cur.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return heads.union(cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
