"""BED12 with bigGenePred columns, GTF and GFF3: text lines to tracks and back, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..schema import EXTRA, INTERVALS
from .lines import numbered


def _numbers(field: Column) -> Column:
    """A comma list, one trailing comma allowed; NULL items where a token is no number."""
    return F.transform(F.split(F.regexp_replace(field, ",$", ""), ","), lambda x: x.try_cast("long"))


def parse(lines: DataFrame, lenient: bool = False) -> DataFrame:
    """Tracks with ``error`` (NULL: good) from a frame of lines (``value``); blank and # lines are no records.

    Strict: any fault is an error.  Lenient: a score beyond 1000 is 1000, none is 0, empty list items
    are dropped, and a block's end is cut to the span; ``repairs`` counts the kinds that a line needed.
    ``path`` and ``line`` pass if the lines have them; otherwise ``line`` numbers them in order, with gaps.
    """
    v = F.rtrim(F.col("value"))
    rows = lines.where((F.trim("value") != "") & ~F.ltrim(F.col("value")).startswith("#")).withColumn("raw", v)
    tabs = F.split("raw", "\t", -1)
    rows = rows.withColumn("f", F.when(F.size(tabs) > 1, tabs).otherwise(F.split(F.trim("raw"), r"\s+")))
    at = lambda i: F.get(F.col("f"), i)
    num = lambda i: at(i).try_cast("long")
    items = lambda i: (F.concat_ws(",", F.filter(F.split(at(i), ","), lambda x: x != "")) if lenient else at(i))
    rows = rows.withColumn("sizes", _numbers(items(10))).withColumn("starts", _numbers(items(11)))
    start, end = num(1), num(2)
    blocks = F.arrays_zip("sizes", "starts")
    limit = (lambda e: F.least(e, end)) if lenient else (lambda e: e)
    exons = F.transform(blocks, lambda b: G.interval(start + b["starts"], limit(start + b["starts"] + b["sizes"])))
    score = num(4)
    fixed = F.when(score.isNull() | (score < 0), 0).when(score > 1000, 1000).otherwise(score)
    over = F.exists(blocks, lambda b: start + b["starts"] + b["sizes"] > end)
    # One trailing comma is part of the format and no repair; an empty item before it is one.
    dropped = lambda i: F.coalesce(items(i) != F.regexp_replace(at(i), ",$", ""), F.lit(False))
    repaired = (F.coalesce((score > 1000) | (score < 0), F.lit(True)), dropped(10), dropped(11), F.coalesce(over, F.lit(False)))
    repairs = sum(r.cast("int") for r in repaired)
    x = rows.withColumn("exons", exons)
    n = F.size("exons")
    # A one-item list has no neighbours, so its sequence would count down: it is settled first.
    rising = (n < 2) | F.forall(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.coalesce(F.get(F.col("exons"), i - 1)["end"] <= F.get(F.col("exons"), i)["start"], n < 2))
    sound = F.forall("exons", lambda e: F.coalesce((e["start"] < e["end"]) & (e["start"] >= start) & (e["end"] <= end), F.lit(False)))
    bad_score = (score.isNull() | (score < 0) | (score > 1000)) if not lenient else F.lit(False)
    thick = ((num(6) == 0) & (num(7) == 0)) | ((num(6) >= start) & (num(7) <= end) & (num(6) <= num(7)))
    checks = [
        (F.size("f") < 12, "columns"), (start.isNull() | end.isNull() | (start < 0) | (start > end), "span"), (bad_score, "score"),
        (~at(5).isin("+", "-", "."), "strand"), (~F.coalesce(thick, F.lit(False)), "thick"),
        ((F.size("sizes") != num(9)) | (F.size("starts") != num(9)) | num(9).isNull() | (num(9) < 1), "block_count"), (~sound | ~rising, "blocks"),
        ((F.get(F.col("exons"), 0)["start"] != start) | (F.element_at("exons", -1)["end"] != end), "bounds"), (F.trim(F.coalesce(at(3), F.lit(""))) == "", "name"),
    ]
    error = F.coalesce(*[F.when(F.coalesce(c, F.lit(True)), F.lit(k)) for c, k in checks])
    extra = [at(12 + i).alias(c) for i, c in enumerate(EXTRA)]
    tail = F.when(F.size("f") > 20, F.slice("f", 21, F.size("f"))).otherwise(F.array().cast("array<string>"))
    return x.select(
        at(0).alias("chrom"), at(5).alias("strand"), start.alias("tx_start"), end.alias("tx_end"), at(3).alias("name"), (fixed if lenient else score).cast("int").alias("score"),
        num(6).alias("thick_start"), num(7).alias("thick_end"), at(8).alias("item_rgb"), F.col("exons").cast(INTERVALS).alias("exons"), *extra, tail.alias("extra_tail"),
        F.greatest(F.size("f") - 12, F.lit(0)).alias("n_extra"), error.alias("error"), (repairs if lenient else F.lit(0)).alias("repairs"), F.col("raw"),
        *([F.col("path"), F.col("line")] if "path" in lines.columns else [F.monotonically_increasing_id().alias("line")]),
    )


def read(spark: SparkSession, path: str, lenient: bool = False) -> tuple[DataFrame, DataFrame]:
    """(tracks, rejected lines with path, line, name, error, raw); only the second counts the lines."""
    told = parse(numbered(spark, path), lenient).where("error IS NOT NULL AND line >= 0")
    return sound(parse(spark.read.text(path), lenient)).drop("error", "raw"), told.select("path", "line", "name", "error", "raw")


def rejects(bad: DataFrame) -> DataFrame:
    """The audit table of rejected reads: source_path, line, read_id, kind (parse or identity), reason."""
    from .sinks import escaped

    read_id = F.nullif(F.trim("name"), F.lit(""))
    kind = F.when(F.col("error") == "name", "identity").otherwise("parse")
    return bad.select(escaped("path").alias("source_path"), "line", F.when(read_id.isNotNull(), escaped("name")).alias("read_id"), kind.alias("kind"), F.col("error").alias("reason"))


def sound(parsed: DataFrame) -> DataFrame:
    """The rows of :func:`parse` without a fault.

    The line's number, which the filter names, keeps the optimizer from copying every check and field into it.
    """
    return parsed.where("error IS NULL AND line >= 0").drop("line")


def format_bed(tracks: DataFrame) -> DataFrame:
    """One BED12 line (``value``) a track, lists with a trailing comma, its extra columns behind."""
    size = F.concat(F.array_join(F.transform("exons", lambda e: (e["end"] - e["start"]).cast("string")), ","), F.lit(","))
    start = F.concat(F.array_join(F.transform("exons", lambda e: (e["start"] - F.col("tx_start")).cast("string")), ","), F.lit(","))
    have = [c for c in EXTRA if c in tracks.columns]
    base = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("chrom", "tx_start", "tx_end", "name", "score", "strand", "thick_start", "thick_end", "item_rgb")]
    fields = F.array(*base, F.size("exons").cast("string"), size, start)
    extra = F.array(*[F.coalesce(F.col(c), F.lit("")) for c in have]) if have else F.array().cast("array<string>")
    if "n_extra" in tracks.columns:
        extra = F.slice(extra, 1, F.least(F.col("n_extra"), F.size(extra)))
    rest = F.col("extra_tail") if "extra_tail" in tracks.columns else F.array().cast("array<string>")
    return tracks.select(F.array_join(F.concat(fields, extra, rest), "\t").alias("value"))


def format_gtf(tracks: DataFrame) -> DataFrame:
    """Transcript and exon lines, one-based and inclusive; exons are numbered in genomic order."""
    gene = F.coalesce("gene_id", F.lit("none"))
    attr = F.format_string('gene_id "%s"; transcript_id "%s";', gene, F.col("name"))
    line = lambda kind, s, e, a: F.concat_ws("\t", "chrom", F.lit("strandloom"), F.lit(kind), (s + 1).cast("string"), e.cast("string"), F.lit("."), "strand", F.lit("."), a)
    top = tracks.select("name", F.lit(0).alias("i"), line("transcript", F.col("tx_start"), F.col("tx_end"), attr).alias("value"))
    each = tracks.select("name", "chrom", "strand", "gene_id", F.posexplode("exons").alias("k", "e"))
    exon = each.select("name", (F.col("k") + 1).alias("i"), line("exon", F.col("e.start"), F.col("e.end"), F.concat(attr, F.format_string(' exon_number "%d";', F.col("k") + 1))).alias("value"))
    return top.unionByName(exon)


def parse_annotation(lines: DataFrame, gene_key: str = "gene_id") -> DataFrame:
    """Transcripts from the exon lines of GTF or GFF3 text: name, gene_id, chrom, strand, span, exons.

    Exons are sorted and made distinct; ``error`` names transcripts on several chromosomes or strands or
    with overlapping exons.
    """
    f = F.split("value", "\t")
    rows = lines.where(~F.col("value").startswith("#") & (F.size(f) >= 9)).select(f.alias("f")).where(F.get(F.col("f"), 2) == "exon")
    attr = F.get(F.col("f"), 8)
    of = lambda *k: F.coalesce(*[F.nullif(F.regexp_extract(attr, p, 1), F.lit("")) for x in k for p in (rf'(?:^|;\s*){x} "([^"]*)"', rf"(?:^|;\s*){x}=([^;]*)")])
    rows = rows.select(of("transcript_id", "Parent").alias("name"), of(gene_key, "gene_id", "gene").alias("gene"), F.get(F.col("f"), 0).alias("chrom"), F.get(F.col("f"), 6).alias("strand"), G.interval(F.get(F.col("f"), 3).try_cast("long") - 1, F.get(F.col("f"), 4).try_cast("long")).alias("e"))
    g = rows.groupBy("name").agg(F.array_sort(F.collect_set("e")).alias("exons"), F.min("gene").alias("gene_id"), F.min("chrom").alias("chrom"), F.min("strand").alias("strand"), F.count_distinct("chrom", "strand").alias("places"), F.count_if(F.col("e.start").isNull() | (F.col("e.start") >= F.col("e.end"))).alias("bad"))
    n = F.size("exons")
    crossed = (n > 1) & F.exists(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.get(F.col("exons"), i - 1)["end"] > F.get(F.col("exons"), i)["start"])
    error = F.when(F.col("name").isNull(), "no_transcript").when(F.col("bad") > 0, "span").when(F.col("places") > 1, "places").when(crossed, "overlap")
    return g.select("name", F.coalesce("gene_id", F.lit("none")).alias("gene_id"), "chrom", "strand", F.get(F.col("exons"), 0)["start"].alias("tx_start"), F.element_at("exons", -1)["end"].alias("tx_end"), "exons", error.alias("error"))


def name2_members(name2: Column) -> Column:
    """Read ids in an embedded membership field: percent-coded list, older comma list, or none."""
    body = F.regexp_replace(name2, r"^tc_name2_v1:|\|[^|]*$", "")
    parts = F.filter(F.split(body, ","), lambda x: x != "")
    decoded = F.transform(parts, lambda x: F.url_decode(F.regexp_replace(x, r"\+", "%2B")))
    return F.when(name2.isNull() | (name2 == "none"), F.array().cast("array<string>")).when(name2.startswith("tc_name2_v1:"), decoded).otherwise(parts)
