"""Small typed text tables: manifests, mappings, calls, tails. Explicit columns, never inferred."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

OBSERVATION = (
    "assay_id string, sample string, read_id string, chrom string, pos0 long, strand string, mod_code string, probability double, observation_state string, context string, source_transcript_id string, source_pos0 long"
)
OBSERVATION_COLUMNS = [c.split()[0] for c in OBSERVATION.split(", ")]
# Fixed tokens of the states of a call.
EXPLICIT, IMPLICIT, UNKNOWN = "explicit_probability", "implicit_below_emission_threshold", "unknown"
SITE_PROBABILITY = "transcript_id string, transcript_position long, read_index long, probability_modified double"


def _must(df: DataFrame, bad: Column, message: str) -> DataFrame:
    """``df``, ending the job at the first row for which ``bad`` holds."""
    return df.where(F.when(F.coalesce(bad, F.lit(True)), F.raise_error(F.lit(message)).cast("boolean")).otherwise(True))


def unique(df: DataFrame, keys: list[str], message: str) -> DataFrame:
    """Keys that occur more than once; non-empty means an error, which the caller's sink raises."""
    again = df.groupBy(*keys).count().where("count > 1")
    return _must(again, F.lit(True), message)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """sample, reads, group: any column order, names in any case; sample names are unique and have no ``::``."""
    raw = spark.read.csv(path, sep="\t", header=True, comment="#")
    names = {c.lower().strip(): c for c in raw.columns}
    if not {"sample", "reads"} <= set(names):
        raise ValueError("a manifest needs the columns sample and reads")
    group = F.nullif(F.trim(F.col(names["group"])), F.lit("")) if "group" in names else F.lit(None).cast("string")
    folder = path.rsplit("/", 1)[0] if "/" in path else "."
    reads = F.trim(F.col(names["reads"]))
    rows = raw.select(F.trim(F.col(names["sample"])).alias("sample"), F.when(reads.rlike("^(/|[a-z0-9]+:)"), reads).otherwise(F.concat(F.lit(folder + "/"), reads)).alias("reads"), group.alias("group"))
    bad = (F.coalesce("sample", F.lit("")) == "") | F.col("sample").contains("::") | (F.coalesce("reads", F.lit("")) == "")
    # A manifest is a short list, so its rows can be counted by sample in one window.
    again = F.count("*").over(Window.partitionBy("sample"))
    return _must(_must(rows, bad, "bad sample or reads in manifest").withColumn("again", again), F.col("again") > 1, "a sample is listed twice").drop("again")


def union_samples(frames: dict[str, DataFrame]) -> DataFrame:
    """Reads of several samples with a ``sample`` column; empty names are errors."""
    tagged = [df.withColumn("sample", F.lit(s)) for s, df in frames.items()]
    return _must(reduce(DataFrame.unionByName, tagged), F.col("name") == "", "a read has no name")


def split_tag(tagged: Column) -> tuple[Column, Column]:
    """(sample, read) of ``sample::read``, cut at the first ``::``; NULL when a side is empty."""
    at = F.instr(tagged, "::")
    left, right = F.substring(tagged, F.lit(1), at - 1), F.substring(tagged, at + 2, F.length(tagged))
    ok = (at > 1) & (right != "")
    return F.when(ok, left), F.when(ok, right)


def read_isoform_pairs(lines: DataFrame) -> DataFrame:
    """read_id, isoform_id of two-field lines."""
    f = F.split("value", "\t", -1)
    rows = lines.where(F.trim("value") != "").select(f.alias("f"))
    bad = (F.size("f") != 2) | (F.get(F.col("f"), 0) == "") | (F.get(F.col("f"), 1) == "")
    return _must(rows, bad, "a mapping line needs two fields").select(F.get(F.col("f"), 0).alias("read_id"), F.get(F.col("f"), 1).alias("isoform_id"))


def observations(raw: DataFrame) -> DataFrame:
    """Checked calls: equal rows once, no two values for a key, probabilities in 0..1 where explicit."""
    key = ["assay_id", "sample", "read_id", "chrom", "pos0", "strand", "mod_code"]
    rows = raw.dropDuplicates()
    explicit = F.col("observation_state") == EXPLICIT
    bad = ~F.col("strand").isin("+", "-", ".") | ~F.col("observation_state").isin(EXPLICIT, IMPLICIT, UNKNOWN) | (explicit & ~F.coalesce(F.col("probability").between(0, 1), F.lit(False)))
    several = F.count("*").over(Window.partitionBy(*key)) > 1
    checked = _must(rows, bad, "a call is not valid").withColumn("several", several)
    return _must(checked, F.col("several"), "a call has two values").drop("several")


def dorado_tails(tag: Column) -> tuple[Column, Column]:
    """(status, length) of a ``pt`` tag: -1 no anchor, 0 no estimate, above the length; lower is an error."""
    bad = F.raise_error(F.lit("a tail tag is below -1")).cast("string")
    status = F.when(tag.isNull(), F.lit(None).cast("string")).when(tag < -1, bad).when(tag == -1, "anchor_not_found").when(tag == 0, "estimation_failed").otherwise("estimated")
    return status, F.when(tag >= 1, tag.cast("double"))


def nanopolish_tails(raw: DataFrame) -> DataFrame:
    """read_id, status, length of (readname, polya_length, qc_tag): only PASS has a length.

    Of repeated reads a passed row wins, then the lesser length and tag, whatever the order of rows.
    """
    passed = F.col("qc_tag") == "PASS"
    best = F.min(F.struct((~passed).alias("no"), F.when(passed, F.col("polya_length")).alias("length"), "qc_tag")).alias("b")
    rows = raw.groupBy(F.col("readname").alias("read_id")).agg(best)
    return rows.select("read_id", F.when(~F.col("b.no"), "estimated").otherwise("qc_failed").alias("status"), F.col("b.length").alias("length"))


def m6anet_calls(probabilities: DataFrame, reads: DataFrame, transcripts: DataFrame, sample: str) -> DataFrame:
    """Genomic calls from per-read site probabilities, a read index map and transcript tracks."""
    from ..functions import geometry as G

    j = probabilities.join(reads, "read_index").join(transcripts.select(F.col("name").alias("transcript_id"), "chrom", "strand", "exons"), "transcript_id")
    pos = G.spliced_to_genomic(F.col("transcript_position"), "exons", "strand")
    rows = j.select(F.lit(sample).alias("sample"), "read_id", "chrom", pos.alias("pos0"), "strand", F.lit("A+a").alias("mod_code"), F.col("probability_modified").alias("probability"), F.lit(EXPLICIT).alias("observation_state"), F.col("transcript_id").alias("source_transcript_id"), F.col("transcript_position").alias("source_pos0"))
    return _must(rows, F.col("pos0").isNull(), "a site lies outside its transcript")


def fasta_chunks(lines: DataFrame, width: int = 4096) -> DataFrame:
    """chrom, chunk, bases from short sequences given as (file, line_no, value); whole files go by :func:`lines.sequences`."""
    order = Window.partitionBy("file").orderBy("line_no")
    named = lines.withColumn("chrom", F.last(F.when(F.col("value").startswith(">"), F.regexp_extract("value", r"^>(\S+)", 1)), ignorenulls=True).over(order)).where(~F.col("value").startswith(">"))
    within = Window.partitionBy("file", "chrom").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    return cut_chunks(named.withColumn("at", F.coalesce(F.sum(F.length("value")).over(within), F.lit(0))), width)


def cut_chunks(placed: DataFrame, width: int = 4096) -> DataFrame:
    """chrom, chunk, bases: sequences cut into rows of ``width`` bases, from pieces (chrom, at, value)."""
    first, last = F.floor(F.col("at") / width), F.floor((F.col("at") + F.length("value") - 1) / width)
    cut = placed.where(F.length("value") > 0).select("chrom", "at", "value", F.explode(F.sequence(first, last)).alias("chunk"))
    low = F.greatest(F.col("chunk") * width - F.col("at"), F.lit(0))
    part = cut.select("chrom", "chunk", "at", F.substring("value", low + 1, F.least(F.length("value") - low, (F.col("chunk") + 1) * width - F.col("at") - low).cast("int")).alias("bases"))
    return part.groupBy("chrom", "chunk").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "bases"))), lambda x: x["bases"]), "").alias("bases"))


def bases_at(sites: DataFrame, chunks: DataFrame, width: int = 4096) -> DataFrame:
    """``sites`` (chrom, pos, strand) with the reference base as read on their strand; NULL beyond the end."""
    from ..functions.sequence import oriented

    j = sites.withColumn("chunk", F.floor(F.col("pos") / width)).join(chunks, ["chrom", "chunk"], "left")
    base = F.nullif(F.substring("bases", (F.col("pos") % width + 1).cast("int"), F.lit(1)), F.lit(""))
    return j.withColumn("base", oriented(base, F.col("strand"))).drop("chunk", "bases")


ASSAY = (
    "schema_version int, assay_id string, caller string, caller_version string, model_id string, chemistry string, candidate_rule string, source_emission_threshold double, source_site_filter string, "
    "candidate_observations_complete boolean, provenance_status string, implicit_skip_policy string, coordinate_source string, read_id_mapping string, source_files array<string>"
)


def assay_metadata(texts: DataFrame) -> DataFrame:
    """One row per JSON text (``value``): version 1 and known fields only."""
    known = [f.split()[0] for f in ASSAY.split(", ")]
    a = texts.select(F.from_json("value", ASSAY, {"mode": "FAILFAST"}).alias("a"), F.json_object_keys("value").alias("keys"))
    bad = (F.col("a.schema_version") != 1) | (F.size(F.array_except("keys", F.array(*[F.lit(k) for k in known]))) > 0) | F.col("a.assay_id").isNull()
    return _must(a, bad, "assay metadata of another version or with unknown fields").select("a.*")
