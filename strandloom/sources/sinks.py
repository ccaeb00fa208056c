"""Text forms of results. Spark's writers commit whole tasks, so a failed job leaves no half file behind."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import total
from ..functions.sequence import or_na, shortest_number


def tsv(df: DataFrame, path: str, order: list[str], decimals: int | None = None) -> None:
    """A headed table with NA for NULL, in the order of ``order``; doubles have ``decimals`` or the digits they need.

    The rows are range-partitioned by that order, so part files read one after another are sorted.
    """
    cols = [or_na(F.col(c) if t != "double" else shortest_number(F.col(c)) if decimals is None else F.when(F.col(c).isNotNull(), F.format_string(f"%.{decimals}f", F.col(c)))).alias(c) for c, t in df.dtypes]
    df.repartitionByRange(*order).sortWithinPartitions(*order).select(*cols).write.csv(path, sep="\t", header=True, quote="", mode="overwrite")


def counts_csv(df: DataFrame, path: str) -> None:
    rows = df.repartitionByRange("gene", "isoform_id").sortWithinPartitions("gene", "isoform_id")
    rows.select("gene", "isoform_id", shortest_number(F.col("count")).alias("count")).write.csv(path, header=True, mode="overwrite")


def audit_table(tracks: DataFrame) -> DataFrame:
    """isoform_id, gene_id, chrom, strand, length, exon_count."""
    return tracks.select(F.col("name").alias("isoform_id"), F.coalesce("gene_id", F.lit("none")).alias("gene_id"), "chrom", "strand", total("exons").alias("length"), F.size("exons").alias("exon_count"))


def gff3_lines(tracks: DataFrame) -> DataFrame:
    """mRNA and exon lines, names percent-coded."""
    from ..functions.sequence import percent_encoded as enc

    def line(kind, s, e, a):
        return F.concat_ws("\t", enc(F.col("chrom")), F.lit("strandloom"), F.lit(kind), (s + 1).cast("string"), e.cast("string"), F.lit("."), "strand", F.lit("."), a)

    name, gene = enc(F.col("name")), enc(F.coalesce("gene_id", F.lit("none")))
    top = tracks.select("name", F.lit(0).alias("i"), line("mRNA", F.col("tx_start"), F.col("tx_end"), F.concat(F.lit("ID="), name, F.lit(";gene_id="), gene)).alias("value"))
    each = tracks.select("name", "chrom", "strand", "gene_id", F.posexplode("exons").alias("k", "e"))
    return top.unionByName(each.select("name", (F.col("k") + 1).alias("i"), line("exon", F.col("e.start"), F.col("e.end"), F.concat(F.lit("Parent="), name)).alias("value")))


def escaped(column: str):
    """A field for reports: tabs, line ends and backslashes written out."""
    c = F.coalesce(F.col(column), F.lit(""))
    for raw, out in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        c = F.replace(c, F.lit(raw), F.lit(out))
    return c


def text(spark: SparkSession, value: str, path: str) -> None:
    """One short text as a folder with one file."""
    spark.createDataFrame([(value.removesuffix("\n"),)], "value string").coalesce(1).write.mode("overwrite").text(path)
