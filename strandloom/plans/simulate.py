"""Transcripts, reads, calls and tails derived from the driver's tables by integer arithmetic.

A part is an isoform of gene p_brand: 1 to 4 exons of 100 bases, 200 apart, from p_partkey * 20, so the
density of the genome is the same at every size.  A line item is a read of its part: up to two leading
exons are missing, and both ends are cut.  Events are calls on reads. ``SQL`` says the same for an oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..sources.tables import EXPLICIT, IMPLICIT, UNKNOWN


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _strand(key: str):
    return F.when(F.col(key) % 3 == 0, "+").when(F.col(key) % 3 == 1, "-").otherwise(".")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, name, gene_id, chrom, strand, tx_start, tx_end, exons, n."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    low, n = F.col("p_partkey") * 20, F.col("p_size") % 4 + 1
    p = p.select(F.col("p_partkey").alias("id"), F.concat(F.lit("t"), "p_partkey").alias("name"), F.col("p_brand").alias("gene_id"), F.concat(F.lit("chr"), F.col("p_partkey") % 5).alias("chrom"), _strand("p_partkey").alias("strand"), low.alias("low"), n.alias("n"))
    exons = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: G.interval(F.col("low") + i * 200, F.col("low") + i * 200 + 100))
    return p.select("id", "name", "gene_id", "chrom", "strand", F.col("low").alias("tx_start"), (F.col("low") + (F.col("n") - 1) * 200 + 100).alias("tx_end"), exons.alias("exons"), "n", F.lit(0).alias("score"))


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """name, sample, part, chrom, strand, tx_start, tx_end, exons, gene_id (none), score, instance_id."""
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("long").alias("cut"))
    c = catalog(spark, sf_dir).select(F.col("id").alias("l_partkey"), "chrom", "strand", F.col("tx_start").alias("low"), "n")
    j = l.join(c, "l_partkey").withColumn("first", F.least(F.col("l_linenumber") % 3, F.col("n") - 1))
    exon = lambda i: G.interval(F.col("low") + i * 200 + F.when(i == F.col("first"), F.col("l_linenumber")).otherwise(0), F.col("low") + i * 200 + 100 - F.when(i == F.col("n") - 1, F.col("cut")).otherwise(0))
    j = j.withColumn("exons", F.transform(F.sequence(F.col("first"), F.col("n") - 1), exon))
    name = F.concat_ws("_", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "cut")])
    return j.select(
        name.alias("name"), (F.col("l_orderkey") % 8).alias("sample"), F.concat(F.lit("t"), "l_partkey").alias("part"), "chrom", "strand",
        F.get(F.col("exons"), 0)["start"].alias("tx_start"), F.element_at("exons", -1)["end"].alias("tx_end"), "exons", F.lit("none").alias("gene_id"),
        ((F.col("l_suppkey") * 7) % 1001).cast("int").alias("score"), F.xxhash64(name).alias("instance_id"), F.col("l_orderkey").alias("molecule"),
    )


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("read_id"), F.col("l_partkey").alias("isoform_id"), (F.col("l_orderkey") % 8).alias("sample"))


def genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("isoform_id"), F.col("p_brand").alias("gene"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls: sample, read_id, site, probability, state; a read belongs to isoform user_id % 12 of gene user_id % 6."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    state = F.when(F.col("event_id") % 7 == 0, IMPLICIT).when(F.col("event_id") % 11 == 0, UNKNOWN).otherwise(EXPLICIT)
    return e.select(
        (F.col("event_id") % 4).alias("sample"), F.col("event_id").alias("read_id"), F.concat(F.lit("chr"), F.col("user_id") % 3).alias("chrom"), (F.col("user_id") % 6 * 100 + 10).alias("pos"),
        F.lit("+").alias("strand"), F.lit("A+a").alias("mod_code"), (F.col("value") / 500).alias("probability"), state.alias("observation_state"), "event_type", "value",
    )


def read_isoforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sample, read_id, gene, isoform_id; one event in thirteen has no isoform."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id").where("event_id % 13 <> 0")
    return e.select((F.col("event_id") % 4).alias("sample"), F.col("event_id").alias("read_id"), (F.col("user_id") % 6).alias("gene"), (F.col("user_id") % 6 + 6 * (F.floor(F.col("event_id") / 4) % 2)).alias("isoform_id"))


def study(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(calls, inputs, mapping, isoforms) of a study whose genes and sites are the users, so they grow with the tables.

    Gene u has the isoforms ua and ub and a site in both, or in ua alone where u is divisible by 3. Events are
    calls of four samples; one read in thirteen has no isoform. Of an implicit call the probability is below 0.05.
    """
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    sample = F.concat(F.lit("s"), F.col("event_id") % 4)
    read, gene = F.concat_ws("::", sample, F.col("event_id").cast("string")), F.concat(F.lit("g"), "user_id")
    isoform = F.concat(F.col("user_id").cast("string"), F.when(F.floor(F.col("event_id") / 4) % 2 == 0, "a").otherwise("b"))
    state = F.when(F.col("event_id") % 7 == 0, IMPLICIT).when(F.col("event_id") % 501 == 0, UNKNOWN).otherwise(EXPLICIT)
    none = F.lit(None).cast("string")
    calls = e.select(
        F.lit("m").alias("assay_id"), sample.alias("sample"), read.alias("read_id"), F.lit("chr1").alias("chrom"), (F.col("user_id") * 1000 + 110).alias("pos0"), F.lit("+").alias("strand"), F.lit("A+a").alias("mod_code"),
        F.when(state == EXPLICIT, F.least(F.col("value") / 200, F.lit(1.0))).alias("probability"), state.alias("observation_state"), none.alias("context"), none.alias("source_transcript_id"), F.lit(None).cast("long").alias("source_pos0"),
    )
    said = {
        "assay_id": F.lit("m"), "group": F.when(F.col("sample").isin("s0", "s1"), "control").otherwise("treated"), "analysis_threshold": F.lit(0.5), "has_coverage": F.lit(False), "caller": F.lit("x"), "provenance_status": F.lit("user_declared"),
        "candidate_rule": F.lit("A"), "source_emission_threshold": F.lit(0.05), "implicit_skip_policy": F.lit("low_probability"), "candidate_observations_complete": F.lit(True),
    }
    inputs = calls.select("sample").distinct().withColumns(said)
    mapping = e.where("event_id % 13 <> 0").select(sample.alias("sample"), read.alias("read_id"), isoform.alias("isoform_id"))
    low = F.col("user_id") * 1000 + 100
    exon = lambda start: F.array(G.interval(start, start + 100))
    each = F.array(F.struct(F.lit("a").alias("k"), exon(low).alias("exons")), F.struct(F.lit("b").alias("k"), exon(low + F.when(F.col("user_id") % 3 == 0, 200).otherwise(0)).alias("exons")))
    genes = e.select("user_id").distinct().select("user_id", gene.alias("gene"), F.explode(each).alias("x"))
    return calls, inputs, mapping, genes.select(F.concat(F.col("user_id").cast("string"), "x.k").alias("isoform_id"), "gene", F.lit("chr1").alias("chrom"), F.lit("+").alias("strand"), "x.exons")


SQL = """
WITH cat AS (SELECT p_partkey AS id, 't' || p_partkey AS name, p_brand AS gene, 'chr' || (p_partkey % 5) AS chrom,
                    CASE p_partkey % 3 WHEN 0 THEN '+' WHEN 1 THEN '-' ELSE '.' END AS strand,
                    p_partkey * 20 AS low, p_size % 4 + 1 AS n, p_partkey * 20 AS tx_start, p_partkey * 20 + (p_size % 4) * 200 + 100 AS tx_end FROM part),
cat_x AS (SELECT name, i, low + i * 200 AS s, low + i * 200 + 100 AS e FROM (SELECT *, unnest(range(n)) AS i FROM cat)),
rd0 AS (SELECT concat_ws('_', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT)) AS name, l_orderkey AS molecule, l_orderkey % 8 AS sample, 't' || l_partkey AS part,
               chrom, strand, low, n, least(l_linenumber % 3, n - 1) AS f, l_linenumber AS ln, CAST(l_quantity AS BIGINT) AS cut, (l_suppkey * 7) % 1001 AS score
        FROM lineitem JOIN cat ON l_partkey = id),
rd AS (SELECT *, low + f * 200 + ln AS tx_start, low + (n - 1) * 200 + 100 - cut AS tx_end FROM rd0),
rd_x AS (SELECT name, i, low + i * 200 + CASE WHEN i = f THEN ln ELSE 0 END AS s, low + i * 200 + 100 - CASE WHEN i = n - 1 THEN cut ELSE 0 END AS e
         FROM (SELECT *, unnest(range(f, n)) AS i FROM rd)),
obs AS (SELECT event_id % 4 AS sample, event_id AS read_id, 'chr' || (user_id % 3) AS chrom, user_id % 6 * 100 + 10 AS pos, '+' AS strand, 'A+a' AS mod_code,
               value / 500 AS probability, CASE WHEN event_id % 7 = 0 THEN 'implicit' WHEN event_id % 11 = 0 THEN 'unknown' ELSE 'explicit' END AS state, event_type, value FROM events),
iso AS (SELECT event_id % 4 AS sample, event_id AS read_id, user_id % 6 AS gene, user_id % 6 + 6 * (event_id // 4 % 2) AS isoform_id FROM events WHERE event_id % 13 <> 0),
pairs AS (SELECT DISTINCT l_orderkey AS read_id, l_partkey AS isoform_id, l_orderkey % 8 AS sample FROM lineitem),
w AS (SELECT *, 1.0 / count(*) OVER (PARTITION BY read_id) AS w FROM pairs)
"""
