"""Manifests that name the files of modification calls and of tail lengths. They are short lists, so the driver reads them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.sequence import cigar_blocks, primary
from ..operators.clustering import cut
from . import bam, tables

MODIFICATION = ["sample", "assay_id", "observations", "assay_metadata", "coverage_bam"]
# What two samples of one assay must share.
SHARED = (
    "caller", "caller_version", "model_id", "chemistry", "candidate_rule", "source_emission_threshold", "source_site_filter", "implicit_skip_policy", "coordinate_source", "read_id_mapping",
)


def _place(folder: str, name: str) -> str:
    return name if name.startswith("/") or ":" in name.split("/")[0] else f"{folder}/{name}"


def _rows(spark: SparkSession, path: str) -> tuple[list[dict], str]:
    raw = spark.read.csv(path, sep="\t", header=True, comment="#", quote="")
    rows = [{k.strip().lower(): (v or "").strip() for k, v in r.asDict().items()} for r in raw.collect()]
    if not rows:
        raise ValueError("a manifest has no rows")
    return rows, path.rsplit("/", 1)[0] if "/" in path else "."


def _name(kind: str, value: str) -> str:
    if not value or value == "NA" or "::" in value or any(ord(x) < 32 for x in value):
        raise ValueError(f"bad {kind} in a manifest: {value!r}")
    return value


def modification_manifest(spark: SparkSession, path: str) -> list[Row]:
    """Rows of a sample and assay with their files; exactly the five columns, each pair once, NA for no coverage."""
    rows, folder = _rows(spark, path)
    if list(rows[0]) != MODIFICATION:
        raise ValueError(f"a modification manifest has the columns {', '.join(MODIFICATION)}")
    out, seen = [], set()
    for r in rows:
        pair = _name("sample", r["sample"]), _name("assay", r["assay_id"])
        if pair in seen:
            raise ValueError(f"a sample and assay are listed twice: {pair}")
        seen.add(pair)
        if "" in (r["observations"], r["assay_metadata"], r["coverage_bam"]) or "NA" in (r["observations"], r["assay_metadata"]):
            raise ValueError(f"a file is missing for {pair}")
        cover = None if r["coverage_bam"] == "NA" else _place(folder, r["coverage_bam"])
        out.append(Row(sample=pair[0], assay_id=pair[1], observations=_place(folder, r["observations"]), assay_metadata=_place(folder, r["assay_metadata"]), coverage_bam=cover))
    return out


def read_modifications(spark: SparkSession, rows: list[Row], thresholds: dict[str, float], groups: dict[str, str | None]) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(calls, inputs, coverage) of a modification manifest, for ``site_tables.aggregate``.

    Calls of another sample or assay than their row names, metadata of another assay, and samples of one
    assay whose metadata differ are errors, as is an assay without a threshold in 0..1.
    """
    lost = {r.assay_id for r in rows} - {a for a, t in thresholds.items() if 0 <= t <= 1}
    if lost:
        raise ValueError(f"assays without a threshold in 0..1: {sorted(lost)}")
    calls, metadata, covers = [], [], []
    for r in rows:
        c = spark.read.csv(r.observations, sep="\t", header=True, schema=tables.OBSERVATION, enforceSchema=False, nullValue="NA", quote="", mode="FAILFAST")
        calls.append(tables._must(c, (F.col("sample") != r.sample) | (F.col("assay_id") != r.assay_id), "a call is of another sample or assay than its file"))
        m = tables.assay_metadata(spark.read.text(r.assay_metadata, wholetext=True))
        m = tables._must(m, F.col("assay_id") != r.assay_id, "metadata are of another assay than the manifest says")
        metadata.append(m.withColumn("sample", F.lit(r.sample)).withColumn("group", F.lit(groups.get(r.sample)).cast("string")).withColumn("analysis_threshold", F.lit(float(thresholds[r.assay_id]))).withColumn("has_coverage", F.lit(r.coverage_bam is not None)))
    for path, sample in {(r.coverage_bam, r.sample) for r in rows if r.coverage_bam}:
        covers.append(read_blocks(spark, path).withColumn("sample", F.lit(sample)).withColumn("read_id", tagged(sample, F.col("read_id"))))
    inputs = reduce(DataFrame.unionByName, metadata)
    shared = inputs.groupBy("assay_id").agg(F.count_distinct(F.struct(*[F.coalesce(F.col(k).cast("string"), F.lit("\0")).alias(k) for k in SHARED])).alias("kinds"))
    inputs = tables._must(inputs.join(shared, "assay_id"), F.col("kinds") > 1, "samples of one assay have different metadata").drop("kinds")
    return reduce(DataFrame.unionByName, calls), inputs, reduce(DataFrame.unionByName, covers) if covers else None


def tagged(sample: str, name: Column) -> Column:
    """``sample::read``; names that are tagged already stay."""
    return F.when(name.contains("::"), name).otherwise(F.concat(F.lit(f"{sample}::"), name))


def mapping_of_samples(pairs: DataFrame) -> DataFrame:
    """sample, read_id, isoform_id of tagged pairs; the read keeps its tag, and one without is an error."""
    sample, _ = tables.split_tag(F.col("read_id"))
    return tables._must(pairs.select(sample.alias("sample"), "read_id", "isoform_id"), F.col("sample").isNull(), "a mapped read is not named sample::read")


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """read_id, chrom, strand, blocks of the mapped primary alignments of a file."""
    rows = bam.read(spark, path).where(primary(F.col("flag"), F.col("mapq"), 0) & F.col("chrom").isNotNull())
    strand = F.when(F.col("flag").bitwiseAND(F.lit(0x10)) != 0, "-").otherwise("+")
    return rows.select(F.col("name").alias("read_id"), "chrom", strand.alias("strand"), cigar_blocks(F.col("start"), F.col("cigar")).alias("blocks"))


def tail_manifest(spark: SparkSession, path: str) -> list[Row]:
    """sample, group, caller (dorado or nanopolish) and input; exactly one of bam and nanopolish a sample."""
    rows, folder = _rows(spark, path)
    if "sample" not in rows[0] or not {"bam", "nanopolish"} & set(rows[0]):
        raise ValueError("a tail manifest needs the columns sample and bam or nanopolish")
    out, seen = [], set()
    for r in rows:
        sample = _name("sample", r["sample"])
        files = [(k, r[c]) for k, c in (("dorado", "bam"), ("nanopolish", "nanopolish")) if r.get(c, "") not in ("", "NA")]
        if len(files) != 1:
            raise ValueError(f"sample {sample!r} needs exactly one of bam and nanopolish")
        if sample in seen:
            raise ValueError(f"a sample is listed twice: {sample!r}")
        seen.add(sample)
        out.append(Row(sample=sample, group=r.get("group") or None, caller=files[0][0], input=_place(folder, files[0][1])))
    return out


def match_samples(tails: list[Row], samples: list[Row]) -> list[Row]:
    """Tail rows with the groups of the reads' manifest; other samples or another group are errors."""
    groups = {r.sample: r.group for r in samples}
    if {r.sample for r in tails} != set(groups) or len(tails) != len(groups):
        raise ValueError("the tail manifest and the reads' manifest name different samples")
    for r in tails:
        if r.group is not None and r.group != groups[r.sample]:
            raise ValueError(f"sample {r.sample!r} has another group in the tail manifest")
    return [Row(sample=r.sample, group=groups[r.sample], caller=r.caller, input=r.input) for r in tails]


def _caller_table(spark: SparkSession, path: str) -> DataFrame:
    """readname, polya_length, qc_tag, by the names of a header in any case or by the standard ten columns."""
    first = (spark.read.text(path).head() or [""])[0].split("\t")
    names, wanted = [x.strip().lower() for x in first], ("readname", "polya_length", "qc_tag")
    headed = set(wanted) <= set(names)
    if headed and len(set(names)) < len(names):
        raise ValueError(f"{path} names a column twice")
    if not headed and (set(wanted) & set(names) or len(first) != 10):
        raise ValueError(f"{path} has neither the columns {', '.join(wanted)} nor the standard ten columns")
    at = [names.index(w) for w in wanted] if headed else [0, 8, 9]
    t = spark.read.csv(path, sep="\t", header=headed, quote="", schema=", ".join(f"c{k} string" for k in range(len(first))))
    return t.select(F.col(f"c{at[0]}").alias("readname"), F.trim(f"c{at[1]}").try_cast("double").alias("polya_length"), F.trim(f"c{at[2]}").alias("qc_tag"))


def read_tails(spark: SparkSession, rows: list[Row]) -> DataFrame:
    """sample, read_id, status, length, raw (a tag), raw_length and qc_tag (a caller's row), one row a read.

    ``conflict``: primary alignments of one name have different tags, an error where the read is assigned.  A BAM file
    without any tag is an error.  A caller's table may lack its header if it has the standard ten columns.
    """
    parts = []
    for r in rows:
        if r.caller == "dorado":
            a = bam.read(spark, r.input)
            same = F.coalesce(F.min("pt") != F.max("pt"), F.lit(False)) | ((F.count("pt") > 0) & (F.count("pt") < F.count("*")))
            main = cut(a.where(F.col("flag").bitwiseAND(F.lit(0x900)) == 0).groupBy(F.col("name").alias("read_id")).agg(F.min("pt").alias("pt"), same.alias("conflict")))
            if main.limit(1).count() and not main.where("pt IS NOT NULL").limit(1).count():
                raise ValueError(f"{r.input} has no pt tags on primary reads")
            status, length = tables.dorado_tails(F.col("pt"))
            got = main.select("read_id", F.coalesce(status, F.lit("missing_pt_tag")).alias("status"), length.alias("length"), F.col("pt").alias("raw"), F.lit(None).cast("double").alias("raw_length"), F.lit(None).cast("string").alias("qc_tag"), "conflict")
        else:
            t = _caller_table(spark, r.input)
            best = t.groupBy(F.col("readname").alias("read_id")).agg(F.min(F.struct((F.col("qc_tag") != "PASS").alias("no"), "polya_length", "qc_tag")).alias("b"))
            passed = ~F.col("b.no")
            got = best.select("read_id", F.when(passed, "estimated").otherwise("qc_failed").alias("status"), F.when(passed, F.col("b.polya_length")).alias("length"), F.lit(None).cast("long").alias("raw"), F.col("b.polya_length").alias("raw_length"), F.col("b.qc_tag").alias("qc_tag"), F.lit(False).alias("conflict"))
        parts.append(got.withColumn("sample", F.lit(r.sample)).withColumn("read_id", tagged(r.sample, F.col("read_id"))))
    return reduce(DataFrame.unionByName, parts)
