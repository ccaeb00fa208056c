"""Exact deduplication with skew-safe combining, in DataFrame operations only.

Three stages, each comparing the full content and not only its digest:

1. local: the map side of the first aggregate merges equal (digest, salt, text) rows of a task;
2. salted: its reduce side merges what tasks sent, a group of copies being spread over salts;
3. global: the salt winners, ``salts`` rows a text at most, meet by digest.

Defined results: a null text equals an empty one; of equal texts the row with the largest doc_id
stays (null ids are the smallest); of rows that repeat that doc_id too, exactly one stays, a text rather
than a null.  Rows that repeat one id share a salt, and merge locally before they move.  No rows give no rows.
Other input columns are ignored whatever their names.  Two different contents under one SHA-256
digest end the job with an error instead of being merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 16


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _salt(salts: int) -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt")


def _base(docs: DataFrame, salts: int, digest) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), digest(text).alias("digest"), _salt(salts))


def classes(docs: DataFrame, salts: int = SALTS, digest=_digest) -> DataFrame:
    """One row per distinct text: digest, keep_id, group_size."""
    salted = _base(docs, salts, digest).groupBy("digest", "salt", "text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n"))
    merged = salted.repartition("digest").groupBy("digest", "text").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("n"))
    one = merged.groupBy("digest").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"), F.count("*").alias("contents"))
    clash = F.raise_error(F.lit("two different texts share a digest"))
    return one.select("digest", "keep_id", F.when(F.col("contents") > 1, clash.cast("long")).otherwise(F.col("group_size")).alias("group_size"))


def exact_dedup(docs: DataFrame, salts: int = SALTS, digest=_digest) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs`` (doc_id, text)."""
    groups = classes(docs, salts, digest).where("group_size > 1")
    groups = groups.select("digest", "keep_id", "group_size", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    rows = _base(docs, salts, digest).select("doc_id", "digest", "salt", F.sha2("text", 256).alias("text_sha256"))
    joined = rows.join(groups, ["digest", "salt"], "left")
    # Rows that repeat doc_id and text share digest and salt, so this window needs no further shuffle.
    again = F.row_number().over(Window.partitionBy("digest", "salt", "doc_id").orderBy(F.lit(1)))
    single = F.col("group_size").isNull()
    keep = F.when(single, F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.withColumn("again", again).select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (keep.eqNullSafe(F.col("doc_id")) & (F.col("again") == 1)).alias("kept"), "text_sha256",
    )


def keep_one(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """``docs`` with one whole row of each text: the winner of :func:`exact_dedup`, all columns kept."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rest = [c for c in docs.columns if c != "text"]
    # Of rows with one id a text comes before a null; then a hash of the rest decides.
    rank = F.struct(F.col("doc_id").alias("id"), F.col("text").isNotNull().alias("whole"), F.xxhash64(*[F.col(f"`{c}`") for c in rest]).alias("tie"))
    packed = docs.select(
        text.alias("text"), _digest(text).alias("digest"), _salt(salts), rank.alias("rank"),
        F.struct(F.col("text").isNull().alias("null"), F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest")).alias("row"),
    )
    best = [F.max_by("row", "rank").alias("row"), F.max("rank").alias("rank")]
    won = packed.groupBy("digest", "salt", "text").agg(*best).groupBy("digest", "text").agg(*best)
    body = F.when(~F.col("row.null"), F.col("text"))
    return won.select(*[(body if c == "text" else F.col("row.rest").getField(c)).alias(c) for c in docs.columns])


ORACLE = """
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t,
             max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
             count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size
      FROM documents)
"""
