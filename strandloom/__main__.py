"""Command line: each subcommand is one function of the library over files that Spark reads and writes.

    python -m strandloom COMMAND [--reads P] [--refs P] [--mapping P] --out P
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import clustering, counting, description, interval, modification, site_tables, tails
from .plans import flow
from .sources import annotation, bam, bed, lines, m6anet, manifests, modbam, sinks, tables


def _tracks(spark: SparkSession, path: str) -> DataFrame:
    good, bad = bed.read(spark, path)
    first = bad.head()
    if first:
        raise SystemExit(f"{path}: {first.error}: {first.raw}")
    gene = F.coalesce(F.nullif(F.trim("gene_id"), F.lit("")), F.lit("none"))
    return good.withColumn("gene_id", gene).withColumn("instance_id", F.monotonically_increasing_id())


def _samples(spark: SparkSession, path: str) -> DataFrame:
    """Reads of all samples of a manifest, tagged; a manifest is a short list that the driver reads."""
    rows = tables.manifest(spark, path).collect()
    return tables.union_samples({r.sample: _tracks(spark, r.reads) for r in rows}).withColumn("name", F.concat_ws("::", "sample", "name"))


def _lines(df: DataFrame, path: str, *order: str) -> None:
    df.repartitionByRange(*order).sortWithinPartitions(*order).select("value").write.mode("overwrite").text(path)


def validate_bed(spark, a):
    good, bad = bed.read(spark, a.reads, a.lenient)
    print({"tracks": good.count(), "rejected": bad.count()})
    if a.out:
        sinks.tsv(bed.rejects(bad), a.out, ["source_path", "line"])


def gff2bigg(spark, a):
    t, rejected = annotation.read(spark, a.refs, "auto", a.gene_key, skip=a.lenient)
    if a.lenient:
        sinks.tsv(annotation.reject_lines(rejected), f"{a.out}.rejected", ["source_path", "anchor_line", "kind"])
    frames = F.concat(F.array_join(F.transform("exons", lambda e: F.lit("-1")), ","), F.lit(","))
    full = t.withColumns({"score": F.lit(100), "thick_start": F.lit(0), "thick_end": F.lit(0), "item_rgb": F.lit("0")})
    full = full.withColumns({c: F.lit("none") for c in bed.EXTRA if c != "gene_id"}).withColumns({"exon_frames": frames, "ttype": F.lit("isoform_anno"), "n_extra": F.lit(8)})
    bed.format_bed(full).write.mode("overwrite").text(a.out)


def bam2bigg(spark, a):
    t = bam.tracks(bam.read(spark, a.reads), a.mapq)
    full = t.withColumns({"thick_start": F.col("tx_start"), "thick_end": F.col("tx_end"), "item_rgb": F.lit("0"), "n_extra": F.lit(8)}).withColumns({c: F.lit("none") for c in bed.EXTRA if c not in ("gene_id", "ttype")})
    bed.format_bed(full).write.mode("overwrite").text(a.out)


def export(spark, a):
    t = _tracks(spark, a.reads)
    if a.format == "table":
        sinks.tsv(sinks.audit_table(t), a.out, ["isoform_id"])
    else:
        _lines(bed.format_gtf(t) if a.format == "gtf" else sinks.gff3_lines(t), a.out, "name", "i")


def addgene(spark, a):
    sinks.tsv(interval.assign_genes(_tracks(spark, a.reads), _tracks(spark, a.refs)), a.out, ["name"])


def clusterj(spark, a):
    found = clustering.discover(_tracks(spark, a.reads), _tracks(spark, a.refs), a.support, a.reach)
    isoforms, mapping = found["isoforms"], found["mapping"]
    t = isoforms.withColumnRenamed("isoform_id", "name").withColumns({"score": F.lit(0), "thick_start": F.col("tx_start"), "thick_end": F.col("tx_end"), "item_rgb": F.lit("0"), "n_extra": F.lit(8)})
    bed.format_bed(t.withColumns({c: F.lit("none") for c in bed.EXTRA if c != "gene_id"})).write.mode("overwrite").text(f"{a.out}/isoforms")
    sinks.tsv(mapping, f"{a.out}/read_to_isoform", ["read_id", "isoform_id"])
    sinks.tsv(found["unused"], f"{a.out}/unused", ["read_id"])
    _summary(spark, found["counts"], mapping, f"{a.out}/summary")


def _summary(spark, counts: dict[str, int], mapping: DataFrame, path: str) -> None:
    """What became of the reads; the counts add up, or discovery has ended with an error."""
    told = {"metric": "value", **counts, "mapping_rows": mapping.count()}
    print(" ".join(f"{k}={v}" for k, v in told.items() if k != "metric"))
    sinks.text(spark, "".join(f"{k}\t{v}\n" for k, v in told.items()), path)


def cluster(spark, a):
    mapping, unused = clustering.overlap_assign(_tracks(spark, a.reads), _tracks(spark, a.refs))
    sinks.tsv(mapping, f"{a.out}/read_to_isoform", ["read_id", "isoform_id"])
    sinks.tsv(unused, f"{a.out}/unused", ["read_id"])


def _catalog(t: DataFrame) -> DataFrame:
    return t.select(F.col("gene_id").alias("gene"), F.col("name").alias("isoform_id"))


def count(spark, a):
    refs = _tracks(spark, a.refs)
    if a.mapping:
        pairs = tables.read_isoform_pairs(spark.read.text(a.mapping))
        pairs = counting.unique_best(_tracks(spark, a.reads), refs, pairs, a.offset) if a.unique else pairs
    else:
        pairs = counting.assign_to_catalog(_tracks(spark, a.reads), refs, a.offset).where("isoform_id IS NOT NULL")
    sinks.counts_csv(counting.isoform_counts(pairs, _catalog(refs)), a.out)


def count_multi(spark, a):
    refs, reads = _tracks(spark, a.refs), _samples(spark, a.reads)
    sample, _ = tables.split_tag(F.col("read_id"))
    pairs = counting.assign_to_catalog(reads, refs, a.offset).where("isoform_id IS NOT NULL").withColumn("sample", sample)
    sinks.tsv(counting.usage(pairs, _catalog(refs)), a.out, ["gene", "isoform_id", "sample"])


def desc(spark, a):
    t, refs = _tracks(spark, a.reads), _tracks(spark, a.refs)
    out = description.report(t, refs)
    for name, order in (("classes", ["isoform_id", "gene"]), ("classes12", ["isoform_id"]), ("fusions", ["isoform_id"])):
        sinks.tsv(out[name], f"{a.out}/{name}", order)


def full_flow(spark, a):
    out = flow.run(_samples(spark, a.reads), _tracks(spark, a.refs), flow.Options(site_support=a.support, site_reach=a.reach, junction_offset=a.offset))
    for name, order in (("unique", ["read_id"]), ("unused", ["read_id"]), ("counts", ["gene", "isoform_id"]), ("classes", ["isoform_id", "gene"]), ("classes12", ["isoform_id"]), ("fusions", ["isoform_id"]), ("usage", ["gene", "isoform_id", "sample"])):
        sinks.tsv(out[name], f"{a.out}/{name}", order)
    _summary(spark, out["read_counts"], out["mapping"], f"{a.out}/summary")


def _isoforms(spark: SparkSession, path: str) -> DataFrame:
    """isoform_id, gene, chrom, strand, exons; an isoform of no gene or of several is an error."""
    t = _tracks(spark, path)
    t = tables._must(t, (F.col("gene_id") == "none") | F.col("gene_id").contains("||"), "an isoform has no gene or several")
    return t.select(F.col("name").alias("isoform_id"), F.col("gene_id").alias("gene"), "chrom", "strand", "exons")


def _table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A headed table with NA for NULL; counts and rates are numbers."""
    t = spark.read.csv(path, sep="\t", header=True, nullValue="NA", quote="").select(*columns)
    real = {"analysis_threshold", "mod_fraction", "mean_probability", "ci_low", "ci_high", "candidate_rate", "callable_rate"}
    return t.withColumns({c: F.col(c).cast("double" if c in real else "long") for c in columns if c in real or c.startswith("n_") or c == "pos0"})


def mod_aggregate(spark, a):
    groups = {r.sample: r.group for r in tables.manifest(spark, a.reads).collect()} if a.reads else {}
    rows = manifests.modification_manifest(spark, a.manifest)
    if groups and (lost := {r.sample for r in rows} - set(groups)):
        raise SystemExit(f"samples that the reads' manifest lacks: {sorted(lost)}")
    given = dict(x.rsplit("=", 1) for x in a.threshold)
    calls, inputs, coverage = manifests.read_modifications(spark, rows, {k: float(v) for k, v in given.items()}, groups)
    mapping = manifests.mapping_of_samples(tables.read_isoform_pairs(spark.read.text(a.mapping)))
    chunks = None
    if a.fasta:
        chunks = tables.cut_chunks(lines.sequences(spark, a.fasta))
    gates = site_tables.Gates(strict=a.strict, min_callable=a.min_callable, allow_low_join=a.allow_low_join)
    out = site_tables.aggregate(calls, inputs, mapping, _isoforms(spark, a.refs), coverage, chunks, gates)
    order = {"join_qc": ["assay_id", "sample"], "site_join_qc": ["assay_id", "sample", "chrom", "pos0"], "sites": ["assay_id", "sample", "gene", "isoform_id", "chrom", "pos0"], "design": ["assay_id", "sample", "gene", "isoform_id", "site_id"]}
    for name, by in order.items():
        sinks.tsv(out[name], f"{a.out}/{name}", by)


def mod_contrast(spark, a):
    out = site_tables.contrasts(_table(spark, a.reads, site_tables.DESIGN), _table(spark, a.specs, site_tables.SPEC))
    sinks.tsv(out, a.out, site_tables.CONTRAST[:1] + ["assay_id", "gene", "site_id", "mod_code", "isoform_a", "isoform_b"])


def mod_site_summary(spark, a):
    out = site_tables.summarize(_table(spark, a.reads, site_tables.SITES))
    sinks.tsv(out, a.out, ["assay_id", "gene", "chrom", "pos0", "mod_code"])


def mod_subsample(spark, a):
    pairs = tables.read_isoform_pairs(spark.read.text(a.mapping))
    ids = pairs.join(_isoforms(spark, a.refs).select("isoform_id", "gene"), "isoform_id").select(F.col("gene").alias("stratum"), "read_id").distinct()
    sinks.tsv(modification.subsample(ids, a.seed, a.size, a.replicates, a.mode == "independent"), a.out, ["stratum", "replicate", "rank"])


def _imported(spark, a, observations, assay, audit) -> None:
    """Calls, metadata and audit of an import, as the aggregate reads them."""
    sinks.tsv(observations.select(*tables.OBSERVATION_COLUMNS), f"{a.out}.observations", ["chrom", "pos0", "strand", "read_id"])
    sinks.text(spark, assay, f"{a.out}.assay")
    sinks.text(spark, "".join(f"{k}\t{v}\n" for k, v in {"metric": "value", **audit}.items()), f"{a.out}.import_qc")


def mod_import_m6anet(spark, a):
    rule = "DRACH" if a.rule == modbam.ALL else a.rule
    _imported(spark, a, *m6anet.run(spark, a.indiv, a.read_map, a.refs, a.assay, a.sample, a.model, a.caller_version, rule, a.data_info, a.site_proba, a.min_reads, a.read_threshold))


def mod_import_dorado(spark, a):
    target = modbam.Target(a.code, a.rule, a.below_threshold)
    _imported(spark, a, *modbam.run(spark, a.reads, a.assay, a.sample, target, a.model, a.chemistry, a.caller_version, a.emission_threshold, a.min_mapq, a.lenient))


def polya_aggregate(spark, a):
    rows = manifests.tail_manifest(spark, a.manifest)
    if a.reads:
        rows = manifests.match_samples(rows, tables.manifest(spark, a.reads).collect())
    inputs = spark.createDataFrame([(r.sample, r.group, r.caller, r.input) for r in rows], "sample string, `group` string, caller string, input string")
    mapping = manifests.mapping_of_samples(tables.read_isoform_pairs(spark.read.text(a.mapping)))
    out = tails.aggregate(manifests.read_tails(spark, rows), inputs, mapping, _isoforms(spark, a.refs))
    for name, by in (("reads", ["sample", "read_id"]), ("qc", ["sample"]), ("isoforms", ["sample", "gene", "isoform_id"])):
        sinks.tsv(out[name], f"{a.out}/{name}", by, decimals=6)


COMMANDS = {"validate-bed": validate_bed, "gff2bigg": gff2bigg, "bam2bigg": bam2bigg, "export": export, "addgene": addgene, "clusterj": clusterj, "cluster": cluster, "count": count, "count-multi": count_multi, "desc": desc, "flow": full_flow}
COMMANDS |= {"mod-import-dorado": mod_import_dorado, "mod-import-m6anet": mod_import_m6anet, "mod-aggregate": mod_aggregate, "mod-contrast": mod_contrast, "mod-site-summary": mod_site_summary, "mod-subsample": mod_subsample, "polya-aggregate": polya_aggregate}


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="strandloom")
    p.add_argument("command", choices=COMMANDS)
    for name in ("reads", "refs", "mapping", "manifest", "specs", "fasta", "out", "indiv", "read-map", "data-info", "site-proba"):
        p.add_argument(f"--{name}")
    p.add_argument("--format", choices=("gtf", "gff3", "table"), default="gtf")
    p.add_argument("--gene-key", default="gene_id")
    p.add_argument("--lenient", action="store_true")
    p.add_argument("--unique", action="store_true")
    p.add_argument("--mapq", type=int, default=30)
    p.add_argument("--support", type=int, default=5)
    p.add_argument("--reach", type=int, default=10)
    p.add_argument("--offset", type=int, default=15)
    p.add_argument("--threshold", action="append", default=[], metavar="ASSAY=P")
    p.add_argument("--strict", action="store_true")
    p.add_argument("--allow-low-join", action="store_true")
    p.add_argument("--min-callable", type=int)
    p.add_argument("--seed", type=int, default=1)
    p.add_argument("--size", type=int, default=100)
    p.add_argument("--replicates", type=int, default=1)
    p.add_argument("--mode", choices=("disjoint", "independent"), default="disjoint")
    for name, value in (("assay", "dorado"), ("sample", "sample"), ("code", "A+a"), ("rule", modbam.ALL), ("model", "unknown"), ("chemistry", "unknown"), ("caller-version", "unknown")):
        p.add_argument(f"--{name}", default=value)
    p.add_argument("--emission-threshold", type=float)
    p.add_argument("--read-threshold", type=float)
    p.add_argument("--min-reads", type=int)
    p.add_argument("--below-threshold", action="store_true", help="candidates that a ? group omits are below the emission threshold")
    p.add_argument("--min-mapq", type=int, default=0)
    a = p.parse_args(argv)
    COMMANDS[a.command](SparkSession.builder.appName("strandloom").getOrCreate(), a)


if __name__ == "__main__":
    main()
