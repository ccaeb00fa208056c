"""Row types of the data model: half-open zero-based coordinates, unsigned values widened to long."""

from __future__ import annotations

from pyspark.sql import types as T

INTERVAL = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
INTERVALS = T.ArrayType(INTERVAL)

#: Reads, isoforms and references are rows of one type.
TRACK = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("chrom", "strand")]
    + [T.StructField(c, T.LongType()) for c in ("tx_start", "tx_end")]
    + [T.StructField("name", T.StringType()), T.StructField("score", T.IntegerType())]
    + [T.StructField(c, T.LongType()) for c in ("thick_start", "thick_end")]
    + [T.StructField("item_rgb", T.StringType()), T.StructField("exons", INTERVALS)]
    + [T.StructField(c, T.StringType()) for c in ("name2", "cds_start_stat", "cds_end_stat", "exon_frames", "ttype", "gene_id", "sample_group", "reserved")]
    + [T.StructField("extra_tail", T.ArrayType(T.StringType())), T.StructField("n_extra", T.IntegerType())]
)
EXTRA = ("name2", "cds_start_stat", "cds_end_stat", "exon_frames", "ttype", "gene_id", "sample_group", "reserved")
STRANDS = ("+", "-", ".")
