"""GTF and GFF3 annotation under a policy: faults of lines reach the transcripts that they belong to.

A faulty line whose owner is known takes that transcript or gene out, and everything that depends on it; a faulty
line of no model is noted and passed over; a faulty line that could belong to any model ends the job.  Faults are
flags that travel by aggregates and joins: lines to transcripts, genes to transcripts.  Rejects are a table beside
the result, with path, line, ids, kind and reason.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators.clustering import cut
from .lines import numbered

# Fixed names of features that are transcripts, besides those that end in "rna".
TRANSCRIPTS = ("transcript", "pseudogenic_transcript")
CONTROL = r"\p{Cntrl}"
GTF = r"""([^\s;]+)\s+("(?:[^"\\]|\\.)*"|[^;"\s][^;]*)\s*(?:;|$)"""
PAIRS = "array<struct<k:string,v:string>>"


def _decoded(text: Column) -> Column:
    return F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def _attributes(raw: Column, form: str) -> tuple[Column, Column, Column]:
    """(GFF3 rather than GTF, pairs, fault) of an attribute column."""
    first = F.get(F.split(raw, ";"), 0)
    gff = F.lit(form == "gff3") if form != "auto" else first.rlike(r"^[^\s=]*=")
    fields = F.filter(F.transform(F.split(raw, ";"), lambda x: F.trim(x)), lambda x: x != "")
    three = F.transform(fields, lambda x: F.struct(_decoded(F.trim(F.get(F.split(x, "=", 2), 0))).alias("k"), F.trim(F.get(F.split(x, "=", 2), 1)).alias("v")))
    words, values = (F.regexp_extract_all(raw, F.lit(GTF), F.lit(k)) for k in (1, 2))
    plain = lambda v: F.when(v.startswith('"'), F.regexp_replace(F.substring(v, F.lit(2), F.length(v) - 2), r'\\(["\\])', "$1")).otherwise(F.trim(v))
    two = F.zip_with(words, values, lambda k, v: F.struct(k.alias("k"), plain(v).alias("v")))
    none = F.array().cast(PAIRS)
    pairs = F.when(F.trim(raw) == ".", none).when(gff, three.cast(PAIRS)).otherwise(two.cast(PAIRS))
    twice = lambda a: F.size(F.array_distinct(a)) < F.size(a)
    keys = F.transform(three, lambda p: p["k"])
    ids = F.filter(words, lambda w: w.isin("gene_id", "transcript_id"))
    fault3 = F.when(F.exists(fields, lambda x: ~x.contains("=")), "expected key=value attributes").when(raw.rlike("%(?![0-9A-Fa-f]{2})"), "invalid percent encoding").when(twice(keys), "duplicate annotation attribute")
    fault3 = F.coalesce(fault3, F.when(F.exists(three, lambda p: (p["k"] == "Parent") & F.exists(F.split(p["v"], ","), lambda x: F.trim(x) == "")), "an empty Parent"))
    fault2 = F.when(~F.regexp_replace(raw, GTF, "").rlike(r"^[\s;]*$"), "malformed attributes").when(twice(ids), "duplicate annotation identity attribute")
    return gff, pairs, F.when(F.trim(raw) != ".", F.when(gff, fault3).otherwise(fault2))


def features(lines: DataFrame, form: str = "auto", gene_key: str = "gene_id") -> DataFrame:
    """One row for each record of (path, line, value), with what it names and its fault."""
    if not gene_key.strip():
        raise ValueError("the gene attribute has no name")
    text = lines.withColumn("value", F.trim("value"))
    ends = text.where("value = '##FASTA'").groupBy("path").agg(F.min("line").alias("stop"))  # at most a row a file
    text = text.join(F.broadcast(ends), "path", "left").where((F.col("value") != "") & ~F.col("value").startswith("#") & (F.col("stop").isNull() | (F.col("line") < F.col("stop"))))
    f = lambda i: F.get(F.col("f"), i)
    rows = text.withColumn("f", F.split("value", "\t", -1))
    gff, pairs, fault = _attributes(F.coalesce(f(8), F.lit(".")), form)
    rows = rows.select("path", "line", "f", gff.alias("gff"), pairs.alias("pairs"), fault.alias("attr_fault"))
    kind = F.lower(f(2))
    rows = rows.withColumn("feature", F.when(kind == "exon", "exon").when(kind.isin(*TRANSCRIPTS) | kind.endswith("rna"), "transcript").when(kind.endswith("gene"), "gene").otherwise("other"))
    has = lambda k: F.get(F.filter("pairs", lambda p: p["k"] == k), 0)["v"]
    of = lambda k: F.when(F.col("gff"), _decoded(has(k))).otherwise(has(k))
    parents = F.when(F.col("gff"), F.transform(F.filter(F.split(has("Parent"), ","), lambda x: F.trim(x) != ""), lambda x: _decoded(F.trim(x))))
    parents = F.coalesce(parents, F.array().cast("array<string>"))
    start, end = f(3).try_cast("long"), f(4).try_cast("long")
    faults = (
        (F.size("f") != 9, F.concat(F.lit("expected exactly 9 tab-separated columns, got "), F.size("f"))), (f(0).isin("", "."), F.lit("annotation seqid must not be empty or '.'")), (f(0).rlike(CONTROL), F.lit("annotation seqid contains a control character")),
        (f(2).isin("", "."), F.lit("annotation feature type must not be empty or '.'")), (start.isNull() | (start < 0), F.concat(F.lit("invalid integer for start: "), f(3))), (end.isNull() | (end < 0), F.concat(F.lit("invalid integer for end: "), f(4))),
        (start == 0, F.lit("annotation start must be at least 1")), (end < start, F.lit("annotation end is before its start")), (F.col("attr_fault").isNotNull(), F.col("attr_fault")), (~f(6).isin("+", "-", ".", "?"), F.concat(F.lit("invalid strand: "), f(6))),
    )
    own = F.when(F.col("feature") == "exon", F.when(F.col("gff"), F.array_distinct(parents)).otherwise(F.filter(F.array(of("transcript_id")), lambda x: x.isNotNull())))
    own = own.when(F.col("feature") == "transcript", F.filter(F.array(F.when(F.col("gff"), of("ID")).otherwise(of("transcript_id"))), lambda x: F.trim(x) != ""))
    gene = F.when(F.col("feature") == "gene", F.when(F.col("gff"), of("ID")).otherwise(of("gene_id")))
    hints = F.concat(F.when(F.col("feature") == "transcript", parents).otherwise(F.array().cast("array<string>")), F.array(of("gene_id")))
    hints = F.array_distinct(F.filter(F.transform(hints, lambda x: F.trim(x)), lambda x: x.isNotNull() & ~x.isin("", "none")))
    rows = rows.select(
        "path", "line", "feature", f(2).alias("type"), "gff", f(0).alias("chrom"), F.when(f(6) == "?", ".").otherwise(f(6)).alias("strand"), G.interval(start - 1, end).alias("span"), F.coalesce(own, F.array().cast("array<string>")).alias("ids"),
        gene.alias("gene"), F.coalesce(of(gene_key), of("ID"), of("gene_id"), gene).alias("label"), hints.alias("hints"), "attr_fault", (F.size("f") != 9).alias("broken"), F.coalesce(*[F.when(c, m) for c, m in faults]).alias("fault"),
    )
    # Why a fault cannot be kept to its model.
    unsafe = F.when(F.col("broken"), "its feature type and owner cannot be trusted").when(F.col("type").isin("", ".") | F.col("type").rlike(CONTROL), "invalid feature type").when(F.col("feature") == "other", None)
    unsafe = unsafe.when(F.col("attr_fault").isNotNull(), "its identity cannot be recovered").when((F.col("feature") == "gene") & F.coalesce(F.trim("gene").isin("", "."), F.lit(True)), "no recoverable gene identity")
    unsafe = unsafe.when((F.col("feature") != "gene") & (F.size(F.filter("ids", lambda x: ~F.trim(x).isin("", "."))) == 0), "no recoverable transcript identity")
    unowned = (F.col("feature") == "exon") & (F.size("ids") == 0)
    return rows.withColumn("unsafe", F.when(F.col("fault").isNotNull(), unsafe).when(unowned, "exon has no Parent or transcript_id, so the affected transcript is unknown"))


REJECT = ["path", "line", "transcript_ids", "kind", "reason"]


def _models(rows: DataFrame, keep: Callable[[Column], Column] | None) -> tuple[DataFrame, DataFrame]:
    """(models with ``reason`` where they are faulty, rejected genes and lines) of checked features."""
    each = rows.where("feature IN ('exon', 'transcript')").select("*", F.explode("ids").alias("id"))
    each = each if keep is None else each.where(keep(F.col("id")))
    known = F.col("strand") != "."
    exon, head = F.col("feature") == "exon", F.col("feature") == "transcript"
    good = F.col("fault").isNull()
    when = lambda c, v: F.when(c & good, v)
    models = each.groupBy("path", "id").agg(
        F.count_if(exon & good).alias("n_exons"), F.count_if(head & good).alias("n_heads"), F.count_if(~good).alias("n_bad"), F.count_if(~good & exon).alias("n_bad_exons"), F.min(when(F.lit(True), F.col("line"))).alias("line"),
        F.array_sort(F.collect_set(when(exon, F.col("span")))).alias("exons"), F.min(when(exon, F.col("chrom"))).alias("chrom"), F.max(when(exon, F.col("chrom"))).alias("chrom_to"),
        F.min(when(exon & known, F.col("strand"))).alias("strand"), F.max(when(exon & known, F.col("strand"))).alias("strand_to"), F.max(when(exon, F.col("gff"))).alias("gff"),
        F.min(when(head, F.struct("line", "chrom", "strand", "span"))).alias("head"), F.array_distinct(F.flatten(F.collect_set(when(F.lit(True), F.col("hints"))))).alias("hints"),
    )
    models = models.where("n_exons > 0 OR n_bad_exons > 0")
    genes = rows.where("feature = 'gene' AND gene IS NOT NULL").groupBy("path", F.col("gene").alias("hint")).agg(F.min(when(F.lit(True), F.col("label"))).alias("label"), F.count_if(good).alias("n_gene"), F.max(F.when(~good, F.col("line"))).alias("bad_line"))
    asked = models.select("path", "id", F.explode("hints").alias("hint")).join(genes, ["path", "hint"], "left")
    named = asked.groupBy("path", "id").agg(
        F.array_join(F.array_sort(F.collect_set(F.coalesce("label", "hint"))), "||").alias("gene_id"), F.min(F.when(F.col("bad_line").isNotNull(), F.struct("hint", "bad_line"))).alias("bad_gene"), F.min(F.when(F.col("n_gene") > 1, F.col("hint"))).alias("twice"),
        F.max(F.coalesce("label", "hint").isin("", ".") | F.coalesce("label", "hint").rlike(CONTROL)).alias("unclean"),
    )
    m = models.join(named, ["path", "id"], "left")
    parent = genes.select("path", F.col("hint").alias("id"), F.lit(True).alias("is_gene"))
    m = m.join(parent, ["path", "id"], "left")
    n = F.size("exons")
    crossed = (n > 1) & F.exists(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.get(F.col("exons"), i - 1)["end"] > F.get(F.col("exons"), i)["start"])
    first, last = F.get(F.col("exons"), 0)["start"], F.element_at(F.when(n > 0, F.col("exons")), -1)["end"]
    strand = F.coalesce("strand", F.col("head.strand"), F.lit("."))
    said = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    faults = (
        (F.col("bad_gene").isNotNull(), said("transcript depends on malformed gene ", F.col("bad_gene.hint"), " from annotation line ", F.col("bad_gene.bad_line"))), (F.col("twice").isNotNull(), said("duplicate gene identity ", F.col("twice"))),
        (F.trim("id").isin("", ".") | F.col("id").rlike(CONTROL), said("the identity is empty or contains a control character")), (F.col("unclean"), said("a gene identity is empty or contains a control character")), (F.col("n_heads") > 1, said("duplicate transcript identity ", F.col("id"))),
        (F.col("gff") & (F.col("n_heads") == 0) & F.col("is_gene"), said("exon Parent ", F.col("id"), " refers to a gene, not a transcript")), (F.col("gff") & (F.col("n_heads") == 0), said("exon Parent ", F.col("id"), " has no declared transcript feature")),
        (F.col("chrom") != F.col("chrom_to"), said("exons on multiple sequences: ", F.col("chrom"), " and ", F.col("chrom_to"))), (F.col("strand") != F.col("strand_to"), said("conflicting exon strands")),
        (F.col("head.chrom") != F.col("chrom"), said("the feature is on ", F.col("head.chrom"), ", but its exons are on ", F.col("chrom"))), ((F.col("head.span.start") > first) | (F.col("head.span.end") < last), said("the feature's span does not contain the exons")),
        ((F.col("head.strand") != ".") & (F.col("head.strand") != F.col("strand")), said("the feature's strand conflicts with the exons'")), (crossed, said("exons overlap")),
    )
    reason = F.coalesce(*[F.when(F.coalesce(c, F.lit(False)), r) for c, r in faults])
    return m.select("path", "id", F.when(F.col("bad_gene").isNotNull(), F.col("bad_gene.bad_line")).otherwise(F.col("line")).alias("line"), "chrom", strand.alias("strand"), first.alias("tx_start"), last.alias("tx_end"), "exons", F.coalesce(F.nullif("gene_id", F.lit("")), F.lit("none")).alias("gene_id"), "n_bad", reason.alias("reason")), genes


def read(spark: SparkSession, path: str, form: str = "auto", gene_key: str = "gene_id", skip: bool = True, keep: Callable[[Column], Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """(transcripts, rejects) of annotation files.

    ``skip``: faulty transcripts are left out and told; otherwise the first fault ends the job.  ``keep`` is a
    predicate on transcript ids that runs before transcripts are put together; a fault of other ones then does not count.
    Transcripts: name, gene_id, chrom, strand, tx_start, tx_end, exons.  No exon at all, or no sound transcript, is an error.
    """
    return build(features(numbered(spark, path), form, gene_key), skip, keep)


def build(rows: DataFrame, skip: bool = True, keep: Callable[[Column], Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """:func:`read` over the rows of :func:`features`."""
    rows = cut(rows)
    if first := rows.where("unsafe IS NOT NULL").select("path", "line", "fault", "unsafe").orderBy("path", "line").head():
        raise ValueError(f"parse annotation {first.path}:{first.line}: {first.fault or 'unowned exon'}; refusing unsafe recovery: {first.unsafe}")
    models, genes = _models(rows, keep)
    models = cut(models)
    none = F.array().cast("array<string>")
    what = F.when(F.col("feature") == "other", "ignored_feature").when(F.col("feature") == "gene", "gene").otherwise("parse")
    owned = F.lit(True) if keep is None else (F.col("feature").isin("other", "gene") | F.exists("ids", keep))
    parsed = rows.where(F.col("fault").isNotNull() & owned).select("path", "line", F.when(what == "parse", F.array_sort(F.array_distinct("ids"))).otherwise(none).alias("transcript_ids"), what.alias("kind"), F.col("fault").alias("reason"))
    bad = models.where("n_bad = 0 AND reason IS NOT NULL").select("path", "line", F.array("id").alias("transcript_ids"), F.lit("model").alias("kind"), "reason")
    rejects = parsed.unionByName(bad)
    if not skip and (first := rejects.orderBy("path", "line", "kind").head() or genes.where("n_gene > 1").select("path", F.lit(0).alias("line"), F.concat(F.lit("duplicate gene identity "), "hint").alias("reason")).head()):
        raise ValueError(f"annotation {first.path}:{first.line}: {first.reason}")
    good = models.where("n_bad = 0 AND reason IS NULL").select(F.col("id").alias("name"), "gene_id", "chrom", "strand", "tx_start", "tx_end", "exons")
    if keep is None and not good.limit(1).count():
        lost, records = models.count(), rejects.count()
        raise ValueError("annotation contains no exon features with transcript identities" if not lost else f"annotation contains no valid transcript models; rejected_records={records} rejected_transcripts={lost}")
    return good, rejects


def reject_lines(rejects: DataFrame) -> DataFrame:
    """The audit table of rejects, free text escaped: source_path, anchor_line, transcript_ids_json, kind, reason."""
    from .sinks import escaped

    return rejects.select(escaped("path").alias("source_path"), F.col("line").alias("anchor_line"), F.to_json("transcript_ids").alias("transcript_ids_json"), "kind", escaped("reason").alias("reason"))
