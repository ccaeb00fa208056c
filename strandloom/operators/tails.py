"""Tail lengths of assigned reads: a table of reads, one of samples and one of isoforms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.statistics import quantiles
from ..sources import tables
from .clustering import cut
from .site_tables import unique_mapping

# Fixed column order of the tables.
READS = "sample group gene isoform_id read_id dorado_pt polya_length_nt status caller nanopolish_polya_length_nt nanopolish_qc_tag".split()
COUNTS = "assigned_reads observed_reads polya_reads missing_bam_reads missing_pt_reads anchor_not_found_reads estimation_failed_reads polya_fraction".split()
LENGTHS = "polya_mean_nt polya_median_nt polya_q25_nt polya_q75_nt polya_min_nt polya_max_nt polya_stddev_nt".split()
QC = ["sample", "group", *COUNTS, "read_join_rate", "caller", "input", "missing_nanopolish_reads", "qc_failed_reads", "unassigned_reads"]
ISOFORMS = ["sample", "group", "gene", "isoform_id", *COUNTS, *LENGTHS, "caller", "missing_nanopolish_reads", "qc_failed_reads"]


def _counts() -> list:
    n = lambda s: F.count_if(F.col("status") == s)
    lost = n("missing_bam_read") + n("missing_nanopolish_read")
    return [
        F.count("status").alias("assigned_reads"), (F.count("status") - lost).alias("observed_reads"), n("estimated").alias("polya_reads"), n("missing_bam_read").alias("missing_bam_reads"),
        n("missing_pt_tag").alias("missing_pt_reads"), n("anchor_not_found").alias("anchor_not_found_reads"), n("estimation_failed").alias("estimation_failed_reads"),
        F.when(F.count("status") > 0, n("estimated") / F.count("status")).alias("polya_fraction"), n("missing_nanopolish_read").alias("missing_nanopolish_reads"), n("qc_failed").alias("qc_failed_reads"),
    ]


def aggregate(calls: DataFrame, inputs: DataFrame, mapping: DataFrame, isoforms: DataFrame) -> dict[str, DataFrame]:
    """reads, qc, isoforms.

    calls: one row a read (``manifests.read_tails``); inputs: sample, group, caller, input, one row a sample; mapping:
    sample, read_id, isoform_id; isoforms: isoform_id, gene.  Every sample has a row for each isoform.  Quantiles
    interpolate linearly; the deviation of fewer than two lengths is NULL.  A read of two isoforms, or a mapping that
    names an unknown sample or isoform, is an error.
    """
    c = F.col
    assigned = unique_mapping(mapping, isoforms).join(inputs, "sample", "left")
    assigned = tables._must(assigned, c("caller").isNull(), "a mapping names an unknown sample")
    missing = F.when(c("caller") == "dorado", "missing_bam_read").otherwise("missing_nanopolish_read")
    joined = assigned.join(calls, ["sample", "read_id"], "left")
    if "conflict" in calls.columns:
        joined = tables._must(joined, F.coalesce("conflict", F.lit(False)), "conflicting tail tags in primary records of an assigned read")
    reads = cut(joined.select(
        "sample", "group", "gene", "isoform_id", "read_id", c("raw").alias("dorado_pt"), c("length").alias("polya_length_nt"), F.coalesce("status", missing).alias("status"), "caller",
        c("raw_length").alias("nanopolish_polya_length_nt"), c("qc_tag").alias("nanopolish_qc_tag"),
    ))
    length = c("polya_length_nt")
    stats = {"polya_mean_nt": F.avg(length), "polya_min_nt": F.min(length), "polya_max_nt": F.max(length), "polya_stddev_nt": F.stddev_samp(length)}
    per = reads.groupBy("sample", "isoform_id").agg(*_counts(), *[s.alias(k) for k, s in stats.items()])
    ranks = quantiles(reads, ["sample", "isoform_id"], "polya_length_nt", {"polya_median_nt": 0.5, "polya_q25_nt": 0.25, "polya_q75_nt": 0.75})
    per = per.join(ranks, ["sample", "isoform_id"], "left")
    zero = [x for x in COUNTS if x != "polya_fraction"] + ["missing_nanopolish_reads", "qc_failed_reads"]
    # One row a sample beside all isoforms: the list of samples rides in each row, so no product is planned.
    listed = inputs.agg(F.collect_list(F.struct("sample", "group", "caller")).alias("s")).first()["s"]
    every = F.array(*[F.struct(F.lit(r["sample"]).alias("sample"), F.lit(r["group"]).cast("string").alias("group"), F.lit(r["caller"]).alias("caller")) for r in listed])
    grid = isoforms.select("gene", "isoform_id", F.explode(every).alias("s")).select("gene", "isoform_id", "s.*")
    full = grid.join(per, ["sample", "isoform_id"], "left").fillna(0, zero)
    found = calls.join(reads.select("sample", "read_id"), ["sample", "read_id"], "left_anti").groupBy("sample").agg(F.count("*").alias("unassigned_reads"))
    qc = inputs.join(reads.groupBy("sample").agg(*_counts()), "sample", "left").join(found, "sample", "left").fillna(0, [*zero, "unassigned_reads"])
    qc = qc.withColumn("read_join_rate", F.when(c("assigned_reads") > 0, c("observed_reads") / c("assigned_reads")))
    return {"reads": reads.select(*READS), "qc": qc.select(*QC), "isoforms": full.select(*ISOFORMS)}
