"""Modification calls of several samples and assays to site tables: join audit, sites of isoforms, design, contrasts.

All is joins and groupings by keys; the only small side, one row a sample and assay, is never hinted,
so its measured size decides how it is joined.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sequence as Q
from ..functions.statistics import odds_ratio, wilson
from ..sources import tables
from ..sources.tables import EXPLICIT, IMPLICIT, UNKNOWN
from .clustering import cut
from .interval import point_join
from .modification import eligibility

PLACE = ["chrom", "pos0", "strand", "mod_code"]
INPUT = ["assay_id", "sample"]
ROW = [*INPUT, "gene", "isoform_id", *PLACE]
# Fixed column order of the tables.
JOIN_QC = (
    "assay_id analysis_threshold sample input_rows valid_rows projected_rows joined_rows joined_reads assigned_reads read_join_rate observation_join_rate "
    "unknown_read unknown_sample unknown_isoform duplicate_exact duplicate_conflict unprojectable invalid_probability candidate_observations_complete"
).split()
SITE_QC = "assay_id sample site_id chrom pos0 strand mod_code input_rows joined_rows observation_join_rate passes_min_join_rate".split()
SITES = (
    "assay_id analysis_threshold sample group gene isoform_id site_id chrom pos0 strand mod_code context site_state coverage_basis eligibility_profile n_assigned n_covering n_not_candidate "
    "n_candidate candidate_rate n_callable callable_rate n_modified n_unmodified n_unknown mod_fraction mean_probability ci_low ci_high eligibility eligibility_reason"
).split()
DESIGN = "assay_id analysis_threshold sample group gene site_id mod_code isoform_id n_modified n_unmodified mod_fraction eligibility eligibility_reason".split()
SPEC = "contrast_type assay_id gene site_id mod_code isoform_a isoform_b group_a group_b".split()
CONTRAST = (
    "contrast_type assay_id analysis_threshold gene site_id mod_code isoform_a isoform_b group_a group_b n_eligible_samples delta_fraction odds_ratio interaction_delta p_value q_value method eligibility_reason"
).split()
REASONS = (
    "ok site_absent context_dependent reference_base_mismatch unprojectable incomplete_candidate_universe join_rate_low unknown_denominator coverage_unavailable reference_unvalidated provenance_unverified "
    "low_covering low_callable low_candidate_rate low_callable_rate"
).split()


@dataclass(frozen=True)
class Gates:
    """What a site row needs to be compared; ``min_callable`` is 10 when strict, else 1, unless given."""

    strict: bool = False
    min_covering: int = 20
    min_callable: int | None = None
    min_candidate_rate: float = 0.8
    min_callable_rate: float = 0.8
    min_read_join_rate: float = 0.9
    allow_low_join: bool = False

    def __post_init__(self) -> None:
        if not all(0 <= x <= 1 for x in (self.min_candidate_rate, self.min_callable_rate, self.min_read_join_rate)):
            raise ValueError("rates lie in 0..1")


def unique_mapping(mapping: DataFrame, isoforms: DataFrame) -> DataFrame:
    """sample, read_id, isoform_id, gene: a read of two isoforms or of an unknown one is an error."""
    one = mapping.groupBy("sample", "read_id").agg(F.min("isoform_id").alias("isoform_id"), F.max("isoform_id").alias("other"))
    one = tables._must(one, F.col("isoform_id") != F.col("other"), "a read maps to several isoforms").drop("other")
    named = one.join(isoforms.select("isoform_id", "gene"), "isoform_id", "left")
    return tables._must(named, F.col("gene").isNull(), "a mapping names an unknown isoform")


def _rate(n: str, d: str):
    return F.when(F.col(d) > 0, F.col(n) / F.col(d)).otherwise(F.lit(0.0))


def _site_id():
    return F.concat_ws(":", "chrom", "pos0", "strand")


def covering(coverage: DataFrame, assigned: DataFrame, universe: DataFrame, inputs: DataFrame, isoforms: DataFrame) -> DataFrame:
    """n_covering per row of the site table, from the match blocks (sample, read_id, chrom, strand, blocks) of reads.

    Blocks of one read do not overlap, so a read counts once a site.  A mapped read without an alignment,
    one with two, or one whose alignment lies on another chromosome or strand than its isoform is an error.
    """
    once = coverage.groupBy("sample", "read_id").agg(F.count("*").alias("n"), F.first(F.struct("chrom", "strand", "blocks")).alias("at"))
    samples = inputs.where("has_coverage").select("sample").distinct()
    place = isoforms.select("isoform_id", F.col("chrom").alias("iso_chrom"), F.col("strand").alias("iso_strand"))
    j = assigned.join(samples, "sample", "left_semi").join(once, ["sample", "read_id"], "left").join(place, "isoform_id")
    j = tables._must(j, F.col("n").isNull(), "a mapped read has no alignment in the coverage")
    j = tables._must(j, F.col("n") > 1, "a read has two alignments in the coverage")
    j = tables._must(j, (F.col("at.chrom") != F.col("iso_chrom")) | (F.col("at.strand") != F.col("iso_strand")), "a read's alignment is not where its isoform is")
    spans = j.select("sample", "isoform_id", "gene", "at.chrom", "at.strand", F.explode("at.blocks").alias("b"))
    spans = spans.select("sample", "isoform_id", "gene", "chrom", "strand", F.col("b.start").alias("b_start"), F.col("b.end").alias("b_end"))
    points = universe.select("assay_id", "gene", "chrom", "strand", "mod_code", F.col("pos0").alias("pos"))
    hits = point_join(points, spans, ["gene", "chrom", "strand"]).withColumnRenamed("pos", "pos0")
    return hits.groupBy(*ROW).agg(F.count("*").alias("n_covered")).join(inputs.where("has_coverage").select(*INPUT), INPUT, "left_semi")


def aggregate(raw: DataFrame, inputs: DataFrame, mapping: DataFrame, isoforms: DataFrame, coverage: DataFrame | None = None, chunks: DataFrame | None = None, gates: Gates = Gates()) -> dict[str, DataFrame]:
    """join_qc, site_join_qc, sites, design.

    raw: calls (``tables.OBSERVATION``), repeated ones included; inputs: one row a sample and assay with its
    group, analysis_threshold, has_coverage and assay metadata; mapping: sample, read_id, isoform_id; isoforms:
    isoform_id, gene, chrom, strand, exons; coverage: match blocks of reads; chunks: reference bases.

    Every site with an assigned call has a row for each sample of its assay and each isoform of its gene.
    Calls of a sample and assay that ``inputs`` lacks, two contexts of a site, more candidates than covering reads
    and (unless allowed) a low share of joined reads are errors.
    """
    c = F.col
    threshold = inputs.select(*INPUT, "analysis_threshold")
    obs = tables.observations(raw).join(threshold, INPUT, "left")
    obs = tables._must(obs, c("analysis_threshold").isNull(), "a call is of a sample and assay that the manifest lacks")
    assigned = cut(unique_mapping(mapping, isoforms))
    joined = cut(obs.join(assigned, ["sample", "read_id"], "left").select(*INPUT, "read_id", *PLACE, "context", "probability", "observation_state", "analysis_threshold", "isoform_id", "gene"))
    known = c("isoform_id").isNotNull()

    per = joined.groupBy(*INPUT).agg(F.count("*").alias("valid_rows"), F.count_if(known).alias("joined_rows"), F.count_distinct(F.when(known, c("read_id"))).alias("joined_reads"))
    qc = inputs.join(raw.groupBy(*INPUT).agg(F.count("*").alias("input_rows")), INPUT, "left").join(per, INPUT, "left")
    qc = qc.join(assigned.groupBy("sample").agg(F.count("*").alias("assigned_reads")), "sample", "left").fillna(0, ["input_rows", "valid_rows", "joined_rows", "joined_reads", "assigned_reads"])
    qc = qc.withColumns({
        "projected_rows": c("valid_rows"), "unknown_read": c("valid_rows") - c("joined_rows"), "duplicate_exact": c("input_rows") - c("valid_rows"),
        "read_join_rate": _rate("joined_reads", "assigned_reads"), "observation_join_rate": _rate("joined_rows", "valid_rows"),
        # Rows with these faults end the job, so what is left has none.
        **{k: F.lit(0) for k in ("unknown_sample", "unknown_isoform", "duplicate_conflict", "unprojectable", "invalid_probability")},
    }).withColumn("join_low", c("read_join_rate") < gates.min_read_join_rate)
    if not gates.allow_low_join:
        qc = tables._must(qc, c("join_low"), "the share of joined reads is below the minimum")
    qc = cut(qc)

    by_site = joined.groupBy(*INPUT, *PLACE).agg(F.count("*").alias("input_rows"), F.count_if(known).alias("joined_rows"))
    by_site = by_site.withColumn("site_id", _site_id()).withColumn("observation_join_rate", _rate("joined_rows", "input_rows"))
    by_site = by_site.withColumn("passes_min_join_rate", c("observation_join_rate") >= gates.min_read_join_rate)

    explicit = c("observation_state") == EXPLICIT
    counts = joined.where(known).groupBy(*ROW).agg(
        F.count_if(explicit).alias("explicit"), F.count_if(explicit & (c("probability") >= c("analysis_threshold"))).alias("over"), F.sum(F.when(explicit, c("probability"))).alias("sum_p"),
        F.count_if(c("observation_state") == IMPLICIT).alias("implicit"), F.count_if(c("observation_state") == UNKNOWN).alias("n_unknown_source"),
        F.min("context").alias("low"), F.max("context").alias("high"), F.count_if(c("context").isNull()).alias("bare"), F.count("*").alias("rows"),
    )
    counts = cut(counts)
    universe = counts.groupBy("assay_id", "gene", *PLACE).agg(F.min("low").alias("context"), F.max("high").alias("high"), F.sum("bare").alias("bare"), F.sum("rows").alias("rows"))
    two = (c("context") != c("high")) | ((c("bare") > 0) & (c("bare") < c("rows")))
    universe = tables._must(universe, F.coalesce(two, F.lit(False)), "a site has two contexts").drop("high", "bare", "rows")
    if chunks is not None:
        based = tables.bases_at(universe.select("chrom", c("pos0").alias("pos"), "strand").distinct(), chunks)
        universe = universe.join(based.withColumnRenamed("pos", "pos0"), ["chrom", "pos0", "strand"])
    else:
        universe = universe.withColumn("base", F.lit(None).cast("string"))
    universe = cut(universe)

    shapes = isoforms.select("isoform_id", "gene", c("chrom").alias("iso_chrom"), c("strand").alias("iso_strand"), "exons")
    full = universe.join(qc, "assay_id").join(shapes, "gene").join(counts.drop("low", "high", "bare", "rows"), ROW, "left")
    full = full.join(assigned.groupBy("sample", "isoform_id").agg(F.count("*").alias("n_assigned")), ["sample", "isoform_id"], "left")
    if coverage is not None:
        full = full.join(covering(coverage, assigned, universe, inputs, isoforms), ROW, "left")
    else:
        full = full.withColumn("n_covered", F.lit(None).cast("long"))
    full = full.fillna(0, ["explicit", "over", "implicit", "n_unknown_source", "n_assigned"])

    flank = Q.context_flank(F.coalesce("context", "candidate_rule"))
    same = (c("iso_chrom") == c("chrom")) & (c("iso_strand") == c("strand"))
    shape = Q.site_state("exons", c("pos0"), flank, same, c("iso_strand"))
    callable_state = shape.isin("present", "context_dependent")
    mismatch = callable_state & (~F.coalesce(Q.base_fits_code(c("base"), c("mod_code")), F.lit(False)) if chunks is not None else F.lit(False))
    full = full.withColumn("site_state", F.when(mismatch, "reference_base_mismatch").otherwise(shape))
    can = c("site_state").isin("present", "context_dependent")
    implicit_callable = can & F.coalesce((c("implicit_skip_policy") == "low_probability") & (c("analysis_threshold") >= c("source_emission_threshold")), F.lit(False))
    full = full.withColumns({
        "site_id": _site_id(), "complete": c("candidate_observations_complete"), "n_implicit": c("implicit"), "implicit_callable": implicit_callable, "reference_checked": F.lit(chunks is not None),
        "verified": (F.lower("caller") != "dorado") | (c("provenance_status") == "verified_from_pg"), "n_candidate": c("explicit") + c("implicit") + c("n_unknown_source"),
        "n_covering": F.when(c("has_coverage"), F.coalesce("n_covered", F.lit(0))), "n_modified": F.when(can, c("over")).otherwise(0),
    })
    full = tables._must(full, F.coalesce(c("n_candidate") > c("n_covering"), F.lit(False)), "a site has more candidates than covering reads")
    full = full.withColumn("n_unmodified", F.when(can, c("explicit") - c("over")).otherwise(0) + F.when(c("implicit_callable"), c("implicit")).otherwise(0))
    full = full.withColumn("n_callable", c("n_modified") + c("n_unmodified"))
    denominator = (c("n_unknown_source") == 0) & ((c("implicit") == 0) | c("implicit_callable"))
    defined = (c("n_callable") > 0) & c("complete") & denominator & can
    fraction, low, high = wilson(c("n_modified"), c("n_callable"))
    reason = eligibility(gates.strict, gates.min_covering, gates.min_callable, gates.min_candidate_rate, gates.min_callable_rate)
    full = full.withColumns({
        "n_unknown": c("n_candidate") - c("n_callable"), "n_not_candidate": c("n_covering") - c("n_candidate"), "coverage_basis": F.when(c("has_coverage"), "bam_exact").otherwise("unavailable"),
        "candidate_rate": F.when(c("n_covering") > 0, c("n_candidate") / c("n_covering")), "callable_rate": F.when(c("n_covering") > 0, c("n_callable") / c("n_covering")),
        "mod_fraction": F.when(defined, fraction), "ci_low": F.when(defined, low), "ci_high": F.when(defined, high), "mean_probability": F.when(can & (c("explicit") > 0), c("sum_p") / c("explicit")),
        "eligibility_profile": F.lit("strict" if gates.strict else "exploratory"), "eligibility_reason": reason,
    }).withColumn("eligibility", F.when(c("eligibility_reason") == "ok", "eligible").otherwise("ineligible"))
    sites = cut(full.select(*SITES))
    design = sites.withColumn("mod_fraction", F.when(c("eligibility") == "eligible", c("mod_fraction"))).select(*DESIGN)
    return {"join_qc": qc.select(*JOIN_QC), "site_join_qc": by_site.select(*SITE_QC), "sites": sites, "design": design}


def summarize(sites: DataFrame) -> DataFrame:
    """Per assay, gene and site: isoforms, samples, rows by reason, summed counts and the least eligible ones.

    A row that occurs twice for one sample and isoform, as when tables of several runs are joined, is an error.
    """
    key = ["assay_id", "analysis_threshold", "gene", "site_id", *PLACE]
    # Rows of a sample and isoform meet first, so a site of many samples is summed in parts.
    once = sites.groupBy(*key, "sample", "isoform_id").agg(F.count("*").alias("n"), *[F.first(x).alias(x) for x in ("eligibility_reason", "n_covering", "n_candidate", "n_callable", "n_modified", "n_unmodified", "n_unknown", "mod_fraction")])
    once = tables._must(once, F.col("n") > 1, "a site row occurs twice")
    ok = F.col("eligibility_reason") == "ok"
    out = once.groupBy(*key).agg(
        F.count_distinct("isoform_id").alias("n_isoforms"), F.count_distinct("sample").alias("n_samples"), F.count("*").alias("n_rows"),
        *[F.count_if(F.col("eligibility_reason") == r).alias(f"rows_{r}") for r in REASONS],
        *[F.sum(x).alias(x) for x in ("n_covering", "n_candidate", "n_callable", "n_modified", "n_unmodified", "n_unknown")],
        F.count_distinct(F.when(ok, F.col("isoform_id"))).alias("eligible_isoforms"), F.count_distinct(F.when(ok, F.col("sample"))).alias("eligible_samples"),
        F.min(F.when(ok, F.col("n_callable"))).alias("least_callable"), F.min(F.when(ok, F.col("n_covering"))).alias("least_covering"),
        F.min(F.when(ok, F.col("mod_fraction"))).alias("least_fraction"), F.max(F.when(ok, F.col("mod_fraction"))).alias("most_fraction"),
    )
    # Every row has one reason and every candidate is callable or unknown; else a table was cut.
    whole = reduce(lambda a, b: a + b, [F.col(f"rows_{r}") for r in REASONS]) == F.col("n_rows")
    return tables._must(out, ~whole | (F.col("n_candidate") != F.col("n_callable") + F.col("n_unknown")), "the counts of a site do not add up")


def checked_specs(specs: DataFrame) -> DataFrame:
    """Contrast requests; one that its type does not allow is an error."""
    kind, a, b, ga, gb = (F.col(x) for x in ("contrast_type", "isoform_a", "isoform_b", "group_a", "group_b"))
    iso, cond, inter = kind == "isoform_effect", kind == "condition_effect", kind == "isoform_condition_interaction"
    needed = reduce(lambda x, y: x | y, [F.coalesce(F.col(x), F.lit("")) == "" for x in SPEC[:6]])
    groups = ga.isNull() | gb.isNull() | (ga == gb)
    bad = ~(iso | cond | inter) | needed | (iso & (b.isNull() | gb.isNotNull())) | (cond & (b.isNotNull() | groups)) | (inter & (b.isNull() | groups)) | ((iso | inter) & (a == b))
    return tables._must(specs.select(*SPEC).distinct(), F.coalesce(bad, F.lit(False)), "a contrast is not valid")


def contrasts(design: DataFrame, specs: DataFrame) -> DataFrame:
    """One row a request, with NULL effects and a reason where the eligible rows do not suffice.

    isoform_effect: mean over samples of a - b, in one group or all.  condition_effect: mean of group_b less
    mean of group_a.  isoform_condition_interaction: mean a - b of group_b less that of group_a.  The odds ratio
    is of summed counts.  Equal requests give one row; an assay of two thresholds or of none is an error.
    """
    c = F.col
    assay = design.groupBy("assay_id").agg(F.min("analysis_threshold").alias("analysis_threshold"), F.max("analysis_threshold").alias("top"))
    spec = checked_specs(specs).join(assay, "assay_id", "left")
    spec = tables._must(spec, c("top").isNull(), "a contrast names an unknown assay")
    spec = tables._must(spec, c("top") != c("analysis_threshold"), "an assay has two thresholds").drop("top")
    key = ["assay_id", "gene", "site_id", "mod_code"]
    ok = design.where("eligibility = 'eligible'")
    side = lambda s: ok.select(*key, c("isoform_id").alias(f"isoform_{s}"), *([c("sample")] if s == "a" else [c("sample").alias("sample_b")]), c("group").alias(f"own_{s}"), c("mod_fraction").alias(f"f_{s}"), c("n_modified").alias(f"m_{s}"), c("n_unmodified").alias(f"u_{s}"))
    x, y = side("a"), side("b").withColumnsRenamed({k: f"{k}_b" for k in key} | {"isoform_b": "name_b"})
    j = spec.join(x, [*key, "isoform_a"], "left")
    j = j.join(y, [*[c(k) == c(f"{k}_b") for k in key], c("isoform_b") == c("name_b"), c("sample") == c("sample_b"), c("own_a").eqNullSafe(c("own_b"))], "left")
    iso, cond = c("contrast_type") == "isoform_effect", c("contrast_type") == "condition_effect"
    paired, no = c("f_b").isNotNull(), F.lit(False)
    first = F.coalesce(F.when(iso, paired & (c("group_a").isNull() | (c("own_a") == c("group_a")))).otherwise(c("f_a").isNotNull() & (cond | paired) & (c("own_a") == c("group_a"))), no)
    second = F.coalesce(~iso & c("f_a").isNotNull() & (cond | paired) & (c("own_a") == c("group_b")), no)
    value = F.when(cond, c("f_a")).otherwise(c("f_a") - c("f_b"))
    g = j.groupBy(*SPEC, "analysis_threshold").agg(
        F.count_if(first).alias("n1"), F.count_if(second).alias("n2"), F.avg(F.when(first, value)).alias("mean1"), F.avg(F.when(second, value)).alias("mean2"),
        *[F.sum(F.when(first, c(k))).alias(f"{k}1") for k in ("m_a", "u_a", "m_b", "u_b")], *[F.sum(F.when(second, c(k))).alias(f"{k}2") for k in ("m_a", "u_a")],
    )
    enough = F.when(iso, c("n1") > 0).otherwise((c("n1") > 0) & (c("n2") > 0))
    lacking = F.when(iso, "no_shared_eligible_samples").when(cond, "missing_eligible_group").otherwise("missing_paired_group")
    none = F.lit(None).cast("double")
    return g.withColumns({
        "n_eligible_samples": c("n1") + c("n2"), "delta_fraction": F.when(enough & iso, c("mean1")).when(enough & cond, c("mean2") - c("mean1")),
        "odds_ratio": F.when(enough & iso, odds_ratio(c("m_a1"), c("u_a1"), c("m_b1"), c("u_b1"))).when(enough & cond, odds_ratio(c("m_a2"), c("u_a2"), c("m_a1"), c("u_a1"))),
        "interaction_delta": F.when(enough & ~iso & ~cond, c("mean2") - c("mean1")), "p_value": none, "q_value": none, "method": F.lit("effect_only"),
        "eligibility_reason": F.when(enough, "ok").otherwise(lacking),
    }).select(*CONTRAST)
