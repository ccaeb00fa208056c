"""Annotation under its policies, true line numbers, and places of FASTA lines over splits."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from strandloom.sources import annotation, bed, lines, tables


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def read(spark, tmp_path, text, name="a.gff3", **kw):
    (tmp_path / name).write_text(text)
    good, bad = annotation.read(spark, str(tmp_path / name), **kw)
    return {r.name: r for r in good.collect()}, sorted((r.line, r.kind, list(r.transcript_ids), r.reason) for r in bad.collect())


def row(kind, start, end, attr, chrom="chr1", strand="+"):
    return f"{chrom}\ttest\t{kind}\t{start}\t{end}\t.\t{strand}\t.\t{attr}\n"


def test_bad_rows_of_no_model_are_passed_over(spark, tmp_path):
    text = row("mRNA", 1, 100, "ID=tx1") + row("CDS", "not-a-coordinate", 90, "Parent=tx1") + row("exon", 1, 100, "Parent=tx1")
    good, bad = read(spark, tmp_path, text)
    assert list(good) == ["tx1"] and [b[:3] for b in bad] == [(2, "ignored_feature", [])]
    with pytest.raises(ValueError, match="not-a-coordinate"):
        read(spark, tmp_path, text, skip=False)


def test_a_bad_exon_takes_its_transcript(spark, tmp_path):
    tx = lambda t, g: f'gene_id "{g}"; transcript_id "{t}";'
    text = row("transcript", 1, 100, tx("bad", "G1")) + row("exon", "x", 100, tx("bad", "G1")) + row("transcript", 201, 250, tx("good", "G2")) + row("exon", 201, 250, tx("good", "G2"))
    good, bad = read(spark, tmp_path, text, "a.gtf", form="gtf", gene_key="ID")
    assert {n: r.gene_id for n, r in good.items()} == {"good": "G2"} and [b[:3] for b in bad] == [(2, "parse", ["bad"])]


@pytest.mark.parametrize(("text", "message"), [
    (row("exon", "x", 20, 'gene_id "G1";') + row("exon", 101, 120, 'transcript_id "t";'), "refusing unsafe recovery.*no recoverable transcript identity"),
    (row(".", "x", 20, "Parent=t") + row("mRNA", 101, 120, "ID=t") + row("exon", 101, 120, "Parent=t"), "refusing unsafe recovery.*invalid feature type"),
    (row("exon", 1, 20, 'gene_id "G1";'), "refusing unsafe recovery.*unknown"), ("chr1\ttest\texon\t1\t20\n", "refusing unsafe recovery"), (row("exon", 1, 20, 'transcript_id "t'), "refusing unsafe recovery"),
    (row("mRNA", 1, 20, "ID=t"), "no exon features"), (row("exon", "x", 20, 'transcript_id "t";'), "no valid transcript models.*rejected_transcripts=1"), ("##FASTA\n" + row("exon", 1, 20, 'transcript_id "t";'), "no exon features"),
])
def test_what_cannot_be_kept_apart_ends_the_job(spark, tmp_path, text, message):
    with pytest.raises(ValueError, match=message):
        read(spark, tmp_path, text)


GOOD = row("mRNA", 101, 120, "ID=ok") + row("exon", 101, 120, "Parent=ok")


@pytest.mark.parametrize(("text", "line", "reason"), [
    (row("exon", 1, 20, "Parent=orphan"), 1, "no declared transcript feature"), (row("gene", 1, 20, "ID=g") + row("exon", 1, 20, "Parent=g"), 2, "refers to a gene"), (row("mRNA", 1, 50, "ID=t") * 2 + row("exon", 1, 20, "Parent=t"), 1, "duplicate transcript identity"),
    (row("mRNA", 1, 50, "ID=t") + row("exon", 1, 20, "Parent=t") + row("exon", 30, 40, "Parent=t", "chr2"), 1, "multiple sequences"), (row("mRNA", 1, 50, "ID=t", strand=".") + row("exon", 1, 20, "Parent=t") + row("exon", 30, 40, "Parent=t", strand="-"), 1, "conflicting exon strands"),
    (row("mRNA", 1, 50, "ID=t", "chr2") + row("exon", 1, 20, "Parent=t"), 1, "but its exons are on"), (row("mRNA", 5, 50, "ID=t") + row("exon", 1, 20, "Parent=t"), 1, "does not contain"), (row("mRNA", 1, 50, "ID=t", strand="-") + row("exon", 1, 20, "Parent=t"), 1, "strand conflicts"),
    (row("mRNA", 1, 50, "ID=t") + row("exon", 1, 20, "Parent=t") + row("exon", 15, 40, "Parent=t"), 1, "overlap"), (row("gene", 1, 50, "ID=g") * 2 + row("mRNA", 1, 50, "ID=t;Parent=g") + row("exon", 1, 20, "Parent=t"), 3, "duplicate gene identity"),
    (row("gene", "x", 50, "ID=g") + row("mRNA", 1, 50, "ID=t;Parent=g") + row("exon", 1, 20, "Parent=t"), 1, "malformed gene"),
])
def test_faulty_models_leave_others(spark, tmp_path, text, line, reason):
    good, bad = read(spark, tmp_path, text + GOOD)
    assert list(good) == ["ok"]
    found = [b for b in bad if b[1] == "model"]
    assert len(found) == 1 and found[0][0] == line and reason in found[0][3]
    with pytest.raises(ValueError):
        read(spark, tmp_path, text + GOOD, skip=False)


def test_genes_labels_and_decoding(spark, tmp_path):
    text = row("gene", 1, 300, "ID=g%201;Name=Label%3B1") + row("mRNA", 1, 300, "ID=t%2C1;Parent=g%201", strand="?") + row("exon", 201, 250, "Parent=t%2C1,t2") + row("exon", 1, 100, "Parent=t%2C1") + row("lnc_RNA", 1, 300, "ID=t2;gene_id=h") + "#x\n\n"
    good, bad = read(spark, tmp_path, text, gene_key="Name")
    assert not bad and {n: (r.gene_id, r.strand, [tuple(e) for e in r.exons]) for n, r in good.items()} == {"t,1": ("Label;1", "+", [(0, 100), (200, 250)]), "t2": ("h", "+", [(200, 250)])}
    quoted = row("exon", 1, 20, 'gene_id "a \\"b\\""; transcript_id "t;1"; tag basic; tag x')
    good, _ = read(spark, tmp_path, quoted, "q.gtf")
    assert {n: r.gene_id for n, r in good.items()} == {"t;1": 'a "b"'}


def test_only_wanted_transcripts_are_put_together(spark, tmp_path):
    text = row("gene", 1, 100, "ID=g") + row("mRNA", 1, 100, "ID=t1;Parent=g") + row("mRNA", 1, 100, "ID=t2;Parent=g") + row("exon", 1, 10, "Parent=t1,t2") + row("exon", 5, 20, "Parent=t1")
    good, bad = read(spark, tmp_path, text, gene_key="ID", keep=lambda t: t == "t2")
    assert {n: r.gene_id for n, r in good.items()} == {"t2": "g"} and not bad
    assert read(spark, tmp_path, text, keep=lambda t: F.lit(False)) == ({}, [])


def test_gzip_and_reject_table(spark, tmp_path):
    (tmp_path / "a.gtf.gz").write_bytes(gzip.compress((row("exon", "x", 3, 'transcript_id "a"; gene_id "g\tq"') + row("exon", 1, 3, 'transcript_id "b"')).encode()))
    with pytest.raises(ValueError, match="refusing"):
        annotation.read(spark, str(tmp_path / "a.gtf.gz"))
    (tmp_path / "a.gtf.gz").write_bytes(gzip.compress((row("exon", "x", 3, 'transcript_id "a,1"') + row("exon", 1, 3, 'transcript_id "b"')).encode()))
    good, bad = annotation.read(spark, str(tmp_path / "a.gtf.gz"))
    r = annotation.reject_lines(bad).first()
    assert [x.name for x in good.collect()] == ["b"] and (r.anchor_line, r.transcript_ids_json, r.kind) == (1, '["a,1"]', "parse") and r.source_path.endswith("a.gtf.gz")


def test_line_numbers_over_splits(spark, tmp_path, small_splits):
    r = random.Random(2)
    for name in ("x.txt", "y.txt"):
        (tmp_path / name).write_text("\n".join(f"{name} {k} " + "z" * r.choice([0, 3, 90, 900]) for k in range(1, 400)) + "\n")
    got = lines.numbered(spark, f"{tmp_path}/*.txt")
    rows = got.collect()
    assert got.rdd.getNumPartitions() > 20 and len(rows) == 798
    assert all(r.value.split(" ")[:2] == [r.path.rsplit("/", 1)[1], str(r.line)] for r in rows)


def test_rejected_reads_have_their_lines(spark, tmp_path, small_splits):
    good = "chr1\t100\t250\tr{}\t10\t+\t0\t0\t0\t2\t50,50,\t0,100,\n"
    text = "".join("# note\n" if k % 50 == 0 else good.format(k).replace("\t+\t", "\tx\t") if k % 33 == 0 else good.format("" if k % 47 == 0 else k).replace("\tr\t", "\t\t") for k in range(1, 200))
    (tmp_path / "r.bed").write_text(text)
    tracks, bad = bed.read(spark, str(tmp_path / "r.bed"))
    found = {(x.line, x.read_id, x.kind, x.reason) for x in bed.rejects(bad).collect()}
    want = {(k, f"r{k}", "parse", "strand") for k in range(33, 200, 33)} | {(k, None, "identity", "name") for k in range(47, 200, 47)}
    assert found == want and tracks.count() == 199 - 3 - len(want)


def test_fasta_over_splits(spark, tmp_path, small_splits):
    r, want, text = random.Random(3), {}, ""
    for k in range(12):
        bases = "".join(r.choice("ACGT") for _ in range(r.choice([0, 5, 700, 3000])))
        want[f"c{k}"] = bases
        width = r.randint(20, 70)
        text += f">c{k} note\n" + "".join(bases[i : i + width] + "\n" for i in range(0, len(bases), width)) + "\n" * r.randint(0, 2)
    (tmp_path / "x.fa").write_text(text)
    placed = lines.sequences(spark, str(tmp_path / "x.fa"))
    got = {}
    for chrom, at, value in sorted((x.chrom, x.at, x.value) for x in placed.collect()):
        assert at == len(got.get(chrom, ""))
        got[chrom] = got.get(chrom, "") + value
    assert got == {k: v for k, v in want.items() if v}
    chunks = tables.cut_chunks(placed, 128)
    assert {(x.chrom, x.chunk): x.bases for x in chunks.collect()} == {(c, i // 128): v[i : i + 128] for c, v in want.items() for i in range(0, len(v), 128)}
