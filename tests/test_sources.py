"""Sources, sinks and sequence functions on worked cases."""

import struct
import zlib

import pytest
from pyspark.sql import functions as F

from strandloom.functions import sequence as Q
from strandloom.plans.flow import Options, run
from strandloom.sources import bam, sinks
from strandloom.sources import tables as T


def _one(spark, column, **values):
    d = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return d.select(column.alias("x")).first().x


def test_cigar(spark):
    x = _one(spark, Q.cigar_exons(F.lit(100), F.col("c")), c="5S10M2I3D5M100N20M4H")
    assert [tuple(e) for e in x] == [(100, 118), (218, 238)]
    b = _one(spark, Q.cigar_blocks(F.lit(100), F.col("c")), c="5S10M2I3=3D5M100N20M4H")
    assert [tuple(e) for e in b] == [(100, 113), (116, 121), (221, 241)]
    assert _one(spark, bam.query_positions(F.lit(7), F.col("c")), c="1S2M1I1D1M") == [None, 7, 8, None, 10]


def test_ids_and_motifs(spark):
    assert _one(spark, Q.unversioned(F.col("t")), t="ENST1.12") == "ENST1" and _one(spark, Q.unversioned(F.col("t")), t=".5") == ".5"
    assert _one(spark, Q.percent_encoded(F.col("t")), t="a b*~:é-") == "a%20b%2A~:%C3%A9-"
    assert _one(spark, F.regexp_count(F.col("s"), F.lit(Q.motif_pattern("AA"))), s="AAAA") == 3
    with pytest.raises(ValueError):
        Q.motif_pattern("AXZ1")
    assert [_one(spark, Q.context_flank(F.col("c")), c=c) for c in ("DRACH", "NNA", "A", "xyz1")] == [2, 1, 0, 0]
    assert [_one(spark, Q.shortest_number(F.lit(v))) for v in (1.0, 0.5)] == ["1", "0.5"]


def test_site_states(spark):
    d = spark.createDataFrame([([(100, 120)], p, k, s) for p, k, s in ((110, True, "+"), (101, True, "+"), (130, True, "+"), (110, False, "+"), (110, True, "."))], "e array<struct<start:long,end:long>>, p long, k boolean, s string")
    got = [r.x for r in d.select(Q.site_state(F.col("e"), F.col("p"), F.lit(2), F.col("k"), F.col("s")).alias("x")).collect()]
    assert got == ["present", "context_dependent", "structurally_absent", "structurally_absent", "unprojectable"]


def test_manifest_and_mapping(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("Group\tReads\tsample\ncase\ta.bed\tS1\n\t/x/b.bed\tS2\n")
    rows = T.manifest(spark, f"{tmp_path}/m.tsv").collect()
    assert [tuple(r) for r in rows] == [("S1", f"{tmp_path}/a.bed", "case"), ("S2", "/x/b.bed", None)]
    lines = spark.createDataFrame([("r1\tt1",), ("",)], "value string")
    assert [tuple(r) for r in T.read_isoform_pairs(lines).collect()] == [("r1", "t1")]
    with pytest.raises(Exception, match="two fields"):
        T.read_isoform_pairs(spark.createDataFrame([("r1",)], "value string")).collect()
    a, b = T.split_tag(F.col("t"))
    assert [_one(spark, c, t="S1::r::2") for c in (a, b)] == ["S1", "r::2"] and _one(spark, a, t="::r") is None


def test_observations(spark):
    row = ("a", "S", "r", "c", 1, "+", "A+a", 0.5, "explicit_probability", None, None, None)
    assert T.observations(spark.createDataFrame([row, row], T.OBSERVATION)).count() == 1
    with pytest.raises(Exception, match="two values"):
        T.observations(spark.createDataFrame([row, row[:7] + (0.6,) + row[8:]], T.OBSERVATION)).collect()
    with pytest.raises(Exception, match="not valid"):
        T.observations(spark.createDataFrame([row[:7] + (1.5,) + row[8:]], T.OBSERVATION)).collect()


def test_tails_do_not_depend_on_row_order(spark):
    rows = [("a", 5.0, "SUFFCLIP"), ("a", 9.0, "PASS"), ("a", 7.0, "PASS"), ("b", 3.0, "ADAPTER")]
    for r in (rows, rows[::-1]):
        got = T.nanopolish_tails(spark.createDataFrame(r, "readname string, polya_length double, qc_tag string")).collect()
        assert {tuple(x) for x in got} == {("a", "estimated", 7.0), ("b", "qc_failed", None)}


def test_m6anet(spark, tracks):
    p = spark.createDataFrame([("t", 12, 7, 0.9)], T.SITE_PROBABILITY)
    reads = spark.createDataFrame([(7, "r7")], "read_index long, read_id string")
    t = tracks(("t", "c", "-", [(100, 110), (200, 210)], "g", 0))
    r = T.m6anet_calls(p, reads, t, "S").first()
    assert (r.read_id, r.chrom, r.pos0, r.probability) == ("r7", "c", 107, 0.9)


def test_fasta(spark):
    lines = [("f", 0, ">c1 x"), ("f", 1, "ACGTA"), ("f", 2, "CCGG"), ("f", 3, ">c2"), ("f", 4, "TTT")]
    chunks = T.fasta_chunks(spark.createDataFrame(lines, "file string, line_no int, value string"), 4)
    assert {(r.chrom, r.chunk): r.bases for r in chunks.collect()} == {("c1", 0): "ACGT", ("c1", 1): "ACCG", ("c1", 2): "G", ("c2", 0): "TTT"}
    sites = spark.createDataFrame([("c1", 5, "+"), ("c1", 8, "-"), ("c2", 3, "+")], "chrom string, pos long, strand string")
    assert sorted((r.chrom, r.pos, r.base) for r in T.bases_at(sites, chunks, 4).collect()) == [("c1", 5, "C"), ("c1", 8, "C"), ("c2", 3, None)]


def _bam(records):
    body = b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", 1) + struct.pack("<i", 5) + b"chr1\0" + struct.pack("<i", 1000)
    for name, flag, pos, mapq, cigar, seq, tags in records:
        ops = b"".join(struct.pack("<I", n << 4 | bam.OPS.index(o)) for n, o in cigar)
        codes = [bam.LETTERS.index(c) for c in seq] + [0] * (len(seq) % 2)
        packed = bytes(codes[i] << 4 | codes[i + 1] for i in range(0, len(codes), 2))
        rec = struct.pack("<iiBBHHHiiii", 0, pos, len(name) + 1, mapq, 0, len(cigar), flag, len(seq), -1, -1, 0) + name.encode() + b"\0" + ops + packed + b"\xff" * len(seq) + tags
        body += struct.pack("<i", len(rec)) + rec
    out = b""
    for part in (body[:60], body[60:], b""):  # records cross blocks
        z = zlib.compressobj(6, zlib.DEFLATED, -15)
        data = z.compress(part) + z.flush()
        out += b"\x1f\x8b\x08\x04" + b"\0" * 6 + struct.pack("<H", 6) + b"BC" + struct.pack("<HH", 2, len(data) + 25) + data + struct.pack("<II", zlib.crc32(part), len(part))
    return out


def test_bam(spark, tmp_path):
    tags = b"ptC\x21" + b"MMZC+m,0;A+a.,0,1;\0" + b"MLBC" + struct.pack("<I", 3) + bytes([9, 255, 128]) + b"MNC\x08"
    rows = [("r1", 0, 100, 60, [(4, "M"), (50, "N"), (4, "M")], "AACAAGGC", tags), ("low", 0, 100, 5, [(4, "M")], "AAAA", b""), ("sec", 0x100, 100, 60, [(4, "M")], "AAAA", b""), ("rev", 0x10, 200, 60, [(8, "M")], "TTTTCCCC", tags)]
    (tmp_path / "x.bam").write_bytes(_bam(rows))
    got = bam.read(spark, str(tmp_path / "x.bam"))
    assert {r.name: r.pt for r in got.collect()} == {"r1": 33, "low": None, "sec": None, "rev": 33}
    assert {(r.name, r.strand, tuple(map(tuple, r.exons))) for r in bam.tracks(got).collect()} == {("r1", "+", ((100, 104), (154, 158))), ("rev", "-", ((200, 208),))}
    calls = {(r.read_id, r.strand, r.pos0, r.probability) for r in bam.modification_calls(got).collect()}
    assert calls == {("r1", "+", 100, 255.5 / 256), ("r1", "+", 103, 128.5 / 256), ("rev", "-", 203, 255.5 / 256), ("rev", "-", 201, 128.5 / 256)}
    assert {r.name: [tuple(b) for b in r.blocks] for r in bam.coverage(got).collect()}["r1"] == [(100, 104), (154, 158)]


def test_sinks(spark, tracks, tmp_path):
    d = spark.createDataFrame([("g", "b", 1.0), ("g", "a", 0.5), ("f", "c", None)], "gene string, isoform_id string, count double")
    sinks.tsv(d, f"{tmp_path}/t", ["gene", "isoform_id"])
    lines = [x for p in sorted((tmp_path / "t").glob("part-*")) for x in p.read_text().splitlines() if not x.startswith("gene\t")]
    assert lines == ["f\tc\tNA", "g\ta\t0.5", "g\tb\t1"]
    t = tracks(("t 1", "c", "+", [(0, 10), (20, 30)], "g;1", 0))
    assert [r.value.split("\t")[8] for r in sinks.gff3_lines(t).orderBy("i").collect()] == ["ID=t%201;gene_id=g%3B1", "Parent=t%201", "Parent=t%201"]
    assert tuple(sinks.audit_table(t).first()) == ("t 1", "g;1", "c", "+", 20, 2)
    assert _one(spark, sinks.escaped("s"), s="a\tb\\n") == "a\\tb\\\\n"


def test_flow_and_options(tracks):
    ref = [(100, 200), (300, 400)]
    refs = tracks(("ref", "chr1", "+", ref, "G1", 0))
    reads = tracks(*[(f"r{i}", "chr1", "+", ref, "none", 0) for i in range(4)], ("alone", "chr5", "+", [(0, 50)], "none", 0)).withColumn("sample", F.lit("S"))
    out = run(reads, refs)
    assert {tuple(r) for r in out["counts"].collect()} == {("G1", "ref", 4.0)} and [r.read_id for r in out["unused"].collect()] == ["alone"]
    assert [(r.sample, r.proportion) for r in out["usage"].collect()] == [("S", 1.0)]
    with pytest.raises(ValueError):
        Options(read_fraction=2)
