"""Modification calls per isoform and site: aggregation, coverage, summaries, contrasts, sampling; and tail lengths."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.statistics import odds_ratio, rank_score, wilson
from ..sources.tables import EXPLICIT, IMPLICIT, UNKNOWN

SITE = ["chrom", "pos", "strand", "mod_code"]


def assign_observations(obs: DataFrame, mapping: DataFrame) -> DataFrame:
    """Observations with the isoform of their read; NULL isoform_id marks an unknown read."""
    return obs.join(mapping, ["sample", "read_id"], "left")


def join_quality(joined: DataFrame) -> DataFrame:
    """Per sample: rows, joined rows, distinct joined reads, unknown rows and the joined share."""
    known = F.col("isoform_id").isNotNull()
    q = joined.groupBy("sample").agg(F.count("*").alias("input_rows"), F.count_if(known).alias("joined_rows"), F.count_distinct(F.when(known, F.col("read_id"))).alias("joined_reads"))
    return q.withColumn("unknown_rows", F.col("input_rows") - F.col("joined_rows")).withColumn("join_rate", F.col("joined_rows") / F.col("input_rows"))


def aggregate(joined: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Counts of calls per sample, isoform and site, with the modified fraction and its interval."""
    p = F.col("probability")
    explicit = F.col("observation_state") == EXPLICIT
    g = joined.where("isoform_id IS NOT NULL").groupBy("sample", "gene", "isoform_id", *SITE).agg(
        F.count_if(explicit).alias("n_explicit"), F.count_if(explicit & (p >= threshold)).alias("n_modified"), F.sum(F.when(explicit, p)).alias("sum_probability"),
        F.count_if(F.col("observation_state") == IMPLICIT).alias("n_implicit"), F.count_if(F.col("observation_state") == UNKNOWN).alias("n_unknown"),
    )
    callable_ = F.col("n_explicit") + F.col("n_implicit")
    fraction, low, high = wilson(F.col("n_modified"), F.col("n_callable"))
    return g.withColumn("n_callable", callable_).withColumn("fraction", fraction).withColumn("ci_low", low).withColumn("ci_high", high)


def complete(counts: DataFrame, samples: DataFrame, isoforms: DataFrame, least: int = 10) -> DataFrame:
    """A row for every site, sample and isoform of the site's gene; absent ones count zero.

    The universe is made of equality joins by gene, never of a free product.
    """
    sites = counts.select("gene", *SITE).distinct()
    genes = samples.join(sites.select("gene").distinct().join(counts.select("gene", "sample").distinct(), "gene"), "sample").select("gene", "sample").distinct()
    grid = sites.join(genes, "gene").join(isoforms.select("gene", "isoform_id"), "gene")
    full = grid.join(counts, ["gene", "sample", "isoform_id", *SITE], "left")
    for c in ("n_explicit", "n_modified", "n_implicit", "n_unknown", "n_callable"):
        full = full.withColumn(c, F.coalesce(c, F.lit(0)))
    reason = F.when(F.col("n_callable") == 0, "no_callable_reads").when(F.col("n_callable") < least, "low_callable").otherwise("ok")
    return full.withColumn("reason", reason)


def site_summary(full: DataFrame) -> DataFrame:
    """Per site: isoforms and rows by reason, calls, least callable count."""
    return full.groupBy("gene", *SITE).agg(
        F.count_distinct("isoform_id").alias("n_isoforms"), F.count("*").alias("n_rows"), F.count_if(F.col("reason") == "ok").alias("n_ok"), F.count_if(F.col("reason") == "low_callable").alias("n_low"),
        F.sum("n_callable").alias("n_callable"), F.sum("n_modified").alias("n_modified"), F.min(F.when(F.col("reason") == "ok", F.col("n_callable"))).alias("least_callable"),
    )


def isoform_contrasts(full: DataFrame, groups: DataFrame) -> DataFrame:
    """Isoform pairs of a gene and site: mean paired difference of fractions per group, pooled odds ratio."""
    ok = full.where("reason = 'ok'").join(groups, "sample")
    key = ["gene", *SITE, "sample", "group"]
    side = lambda n: ok.select(*key, F.col("isoform_id").alias(f"isoform_{n}"), F.col("fraction").alias(f"f_{n}"), F.col("n_modified").alias(f"m_{n}"), (F.col("n_callable") - F.col("n_modified")).alias(f"u_{n}"))
    pairs = side("a").join(side("b"), key).where("isoform_a < isoform_b")
    g = pairs.groupBy("gene", *SITE, "group", "isoform_a", "isoform_b").agg(F.count("*").alias("n_samples"), F.avg(F.col("f_a") - F.col("f_b")).alias("mean_difference"), *[F.sum(c).alias(c) for c in ("m_a", "u_a", "m_b", "u_b")])
    return g.withColumn("odds_ratio", odds_ratio(*[F.col(c) for c in ("m_a", "u_a", "m_b", "u_b")]))


def condition_contrasts(full: DataFrame, groups: DataFrame, left: str, right: str) -> DataFrame:
    """Difference of the two groups' mean fractions per isoform and site; NULL where one has none."""
    ok = full.where("reason = 'ok'").join(groups, "sample")
    mean = lambda g: F.avg(F.when(F.col("group") == g, F.col("fraction")))
    return ok.groupBy("gene", "isoform_id", *SITE).agg(F.count("*").alias("n_samples"), (mean(left) - mean(right)).alias("difference"))


def subsample(ids: DataFrame, seed: int, size: int, replicates: int, independent: bool = False, salts: int = 32) -> DataFrame:
    """stratum, read_id, rank (from 1), replicate (from 0): seeded samples of each stratum's distinct reads.

    Reads are ranked by a digest, so samples do not depend on the order of rows.  Disjoint replicates follow one another
    in one ranking; independent ones have rankings of their own and may share reads.  A stratum may hold most of all
    reads, so it is ranked in two steps: its salts first, of which only the rows that can still win go on.
    """
    key = ["stratum", "ranking"]
    score = lambda r: rank_score(seed, F.col("read_id"), r)
    draws = [(r, score(r)) for r in range(replicates)] if independent else [(0, score(None))]
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("ranking"), s.alias("score")) for r, s in draws])).alias("d")
    most = size if independent else size * replicates
    rows = ids.select("stratum", "read_id").distinct().select("stratum", "read_id", each).select("stratum", "read_id", "d.ranking", "d.score")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("read_id"), F.lit(salts)))
    for by in ([*key, "salt"], key):
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy("score", "read_id"))).where(F.col("rank") <= most)
    replicate = F.col("ranking") if independent else F.floor((F.col("rank") - 1) / size)
    return rows.select("stratum", "read_id", "rank", replicate.cast("long").alias("replicate"))


def tail_summary(calls: DataFrame, mapping: DataFrame, universe: DataFrame) -> DataFrame:
    """Tail lengths per sample and isoform of ``universe``; reads without a call count as missing."""
    joined = mapping.join(calls, ["sample", "read_id"], "left")
    status = F.coalesce("status", F.lit("missing"))
    length = F.when(F.col("status") == "estimated", F.col("length"))
    n = lambda s: F.count_if(status == s).alias(f"n_{s}")
    q = F.percentile(length, [0.25, 0.5, 0.75])
    stats = joined.groupBy("sample", "isoform_id").agg(
        F.count("*").alias("n_assigned"), n("estimated"), n("estimation_failed"), n("anchor_not_found"), n("qc_failed"), n("missing"),
        F.avg(length).alias("mean"), q[1].alias("median"), q[0].alias("q25"), q[2].alias("q75"), F.min(length).alias("shortest"), F.max(length).alias("longest"), F.stddev_samp(length).alias("sd"),
    )
    out = universe.join(stats, ["sample", "isoform_id"], "left")
    for c in ("n_assigned", "n_estimated", "n_estimation_failed", "n_anchor_not_found", "n_qc_failed", "n_missing"):
        out = out.withColumn(c, F.coalesce(c, F.lit(0)))
    return out


# Fixed order of reasons: the first that holds is given.
def eligibility(strict: bool, min_covering: int = 20, min_callable: int | None = None, min_candidate_rate: float = 0.8, min_callable_rate: float = 0.8):
    """The first reason why a row can't be compared, or ``ok``; ``min_callable`` is 10 when strict, else 1.

    Columns: site_state, complete, join_low, n_unknown_source, n_implicit, implicit_callable, has_coverage,
    reference_checked, verified, n_covering, n_candidate, n_callable.
    """
    c = F.col
    min_callable = (10 if strict else 1) if min_callable is None else min_callable
    rules = [
        (c("site_state") == "structurally_absent", "site_absent"), (c("site_state") == "context_dependent", "context_dependent"), (c("site_state") == "reference_base_mismatch", "reference_base_mismatch"),
        (c("site_state") == "unprojectable", "unprojectable"), (~c("complete"), "incomplete_candidate_universe"), (c("join_low"), "join_rate_low"),
        ((c("n_unknown_source") > 0) | ((c("n_implicit") > 0) & ~c("implicit_callable")), "unknown_denominator"),
    ]
    if strict:
        rules += [(~c("has_coverage"), "coverage_unavailable"), (~c("reference_checked"), "reference_unvalidated"), (~c("verified"), "provenance_unverified"), (c("n_covering") < min_covering, "low_covering")]
    rules += [(c("n_callable") < min_callable, "low_callable")]
    if strict:
        rules += [(c("n_candidate") < min_candidate_rate * c("n_covering"), "low_candidate_rate"), (c("n_callable") < min_callable_rate * c("n_covering"), "low_callable_rate")]
    return F.coalesce(*[F.when(rule, F.lit(name)) for rule, name in rules], F.lit("ok"))
