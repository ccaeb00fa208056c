"""Range joins, loci and geometry against plain loops."""

import random

from pyspark.sql import functions as F

from strandloom.functions import geometry as G
from strandloom.operators import interval as I


def _spans(r, n):
    out = []
    for k in range(n):
        s = r.randint(0, 400)
        out.append((k, r.choice("ab"), s, s + r.choice([0, 1, 5, 30, 200])))
    return out


def test_overlap_join_is_complete_and_without_doubles(spark):
    r = random.Random(1)
    a, b = _spans(r, 120), _spans(r, 120)
    x = spark.createDataFrame(a, "i long, c string, a_start long, a_end long")
    y = spark.createDataFrame(b, "j long, c string, b_start long, b_end long")
    for least in (1, 10):
        want = sorted((i, j) for i, c, s, e in a for j, d, t, f in b if c == d and s < e and t < f and min(e, f) - max(s, t) >= least)
        for size in (7, 64, 16384):
            assert sorted((p.i, p.j) for p in I.overlap_join(x, y, ["c"], size, least).collect()) == want


def test_points(spark):
    r = random.Random(3)
    b = _spans(r, 80)
    p = [(k, r.choice("ab"), r.randint(0, 600)) for k in range(100)]
    got = I.point_join(spark.createDataFrame(p, "k long, c string, pos long"), spark.createDataFrame(b, "j long, c string, b_start long, b_end long"), ["c"], 16)
    assert sorted((q.k, q.j) for q in got.collect()) == sorted((k, j) for k, c, x in p for j, d, s, e in b if c == d and s <= x < e)


def test_loci_part_where_spans_touch(spark):
    rows = [("c", 0, 10), ("c", 5, 20), ("c", 20, 30), ("c", 22, 25), ("c", 40, 41), ("d", 0, 5)]
    got = I.loci(spark.createDataFrame(rows, "chrom string, tx_start long, tx_end long"), ["chrom"]).collect()
    assert sorted((r.chrom, r.tx_start, r.locus_start) for r in got) == [("c", 0, 0), ("c", 5, 0), ("c", 20, 20), ("c", 22, 20), ("c", 40, 40), ("d", 0, 0)]


def test_genes_are_joined_by_name(tracks):
    refs = tracks(("a", "chr1", "+", [(0, 100)], "GB", 0), ("b", "chr1", "+", [(50, 150)], "GA", 0), ("c", "chr1", "-", [(0, 100)], "GC", 0))
    reads = tracks(("r", "chr1", "+", [(60, 90)], "none", 0), ("s", "chr2", "+", [(60, 90)], "none", 0))
    assert {tuple(x) for x in I.assign_genes(reads, refs).collect()} == {("r", "GA||GB"), ("s", "none")}


def test_geometry(tracks):
    t = tracks(("p", "c", "+", [(100, 110), (120, 130), (130, 140)], "g", 0), ("m", "c", "-", [(100, 110), (120, 130), (130, 140)], "g", 0), ("one", "c", ".", [(5, 9)], "g", 0))
    rows = {r.name: r for r in t.select("name", G.introns("exons").alias("i"), G.junction_positions("exons", "strand").alias("j"), G.genomic_to_spliced(F.lit(121), "exons", "strand").alias("s"), G.spliced_to_genomic(F.lit(11), "exons", "strand").alias("g"), G.total("exons").alias("n"), G.three_prime("strand", "tx_start", "tx_end").alias("e")).collect()}
    assert [tuple(x) for x in rows["p"].i] == [(110, 120)] and rows["one"].i == []
    assert rows["p"].j == [110, 120, 130, 130] and rows["m"].j == [130, 130, 120, 110] and rows["one"].j == []
    assert (rows["p"].s, rows["m"].s, rows["one"].s) == (11, 18, None) and (rows["p"].g, rows["m"].g, rows["one"].g) == (121, 128, None)
    assert rows["p"].n == 30 and (rows["p"].e, rows["m"].e, rows["one"].e) == (140, 100, None)


def test_rebuilt_exons(spark):
    def exons(start, end, j):
        d = spark.createDataFrame([(start, end, j)], "s long, e long, j array<long>")
        x = d.select(G.rebuild_exons(F.col("s"), F.col("e"), F.col("j")).alias("x")).first().x
        return None if x is None else [tuple(i) for i in x]

    assert exons(0, 100, [40, 20]) == [(0, 20), (40, 100)]
    assert exons(0, 100, [60, 40, 30, 10]) == [(0, 10), (30, 40), (60, 100)]
    assert exons(0, 100, []) is exons(0, 100, [5]) is exons(0, 100, [20, 20]) is exons(0, 100, [20, 100]) is None


def test_gene_fields(spark):
    d = spark.createDataFrame([("a0||b0", "b0"), ("a0", "a"), ("none", "x"), ("", "x"), (None, None)], "a string, b string")
    assert [r.ok for r in d.select(G.genes_compatible("a", "b").alias("ok")).collect()] == [True, False, True, True, True]


def test_loci_over_many_bins(spark):
    r = random.Random(8)
    rows = [(r.choice("ab"), s, s + r.choice([1, 9, 40, 300])) for s in (r.randint(0, 3000) for _ in range(60))]
    d = spark.createDataFrame(rows * 2, "chrom string, tx_start long, tx_end long")
    want = set()
    for c in "ab":
        far = name = None
        for s, e in sorted((s, e) for k, s, e in rows if k == c):
            if far is None or s >= far:
                name, far = s, e
            far = max(far, e)
            want.add((c, s, e, name))
    for size in (16, 500, 1 << 17):
        got = I.loci(d, ["chrom"], size)
        assert {tuple(x) for x in got.select("chrom", "tx_start", "tx_end", "locus_start").collect()} == want and got.count() == len(rows) * 2


def test_bins_follow_the_spans_and_a_left_join_keeps_every_row(spark):
    a = spark.createDataFrame([(0, "c", 5, 905), (1, "c", 9000, 9100), (2, "d", 5, 9), (3, "c", 7, 7)], "i int, c string, a_start long, a_end long")
    b = spark.createDataFrame([(k, "c", 100 * k, 100 * k + 100) for k in range(9)], "j int, c string, b_start long, b_end long")
    assert I.bin_size(b) == 512
    out = {(r.i, r.j) for r in I.overlap_join(a, b, ["c"], 128, how="left").collect()}
    assert out - {(0, None)} == {(0, k) for k in range(9)} | {(1, None), (2, None), (3, None)}
