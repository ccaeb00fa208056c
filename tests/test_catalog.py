"""Discovery, description, calls and formats on worked cases."""

import pytest
from pyspark.sql import functions as F

from strandloom.functions import geometry as G
from strandloom.functions.statistics import odds_ratio, wilson
from strandloom.operators import clustering as K
from strandloom.operators import description as D
from strandloom.operators import modification as M
from strandloom.sources import bed


def test_truncated_read_keeps_both_references(tracks):
    refs = tracks(("ref_a", "chr1", "+", [(100, 110), (120, 130), (140, 150)], "GENEA", 0), ("ref_b", "chr1", "+", [(80, 90), (100, 110), (120, 130), (140, 150)], "GENEA", 0))
    reads = tracks(("read_trunc", "chr1", "+", [(120, 130), (140, 150)], "GENEA", 0))
    isoforms, mapping, unused = K.junction_catalog(reads, refs)
    assert sorted(r.isoform_id for r in isoforms.collect()) == ["ref_a", "ref_b"] and unused.count() == 0
    assert {tuple(r) for r in mapping.collect()} == {("read_trunc", "ref_a"), ("read_trunc", "ref_b")}


def test_known_and_novel_structures(tracks):
    known, novel = [(100, 130), (160, 190), (220, 250)], [(100, 130), (170, 190), (220, 250)]
    low, low_novel = [(500, 530), (560, 590), (620, 650)], [(500, 530), (570, 590), (620, 650)]
    refs = tracks(("high", "chr1", "+", known, "G1", 0), ("low", "chr1", "+", low, "G2", 0))
    rows = [(f"k{i}", "chr1", "+", known, "G1", 0) for i in range(8)] + [(f"n{i}", "chr1", "+", novel, "G1", 0) for i in range(6)]
    rows += [(f"l{i}", "chr1", "+", low, "G2", 0) for i in range(2)] + [(f"m{i}", "chr1", "+", low_novel, "G2", 0) for i in range(2)]
    isoforms, mapping, unused = K.junction_catalog(tracks(*rows), refs, 1, 0)
    found = {tuple((e.start, e.end) for e in r.exons): r.isoform_id for r in isoforms.collect()}
    assert set(found) == {tuple(x) for x in (known, novel, low, low_novel)} and unused.count() == 0
    n = {r.isoform_id: r.n for r in mapping.groupBy("isoform_id").agg(F.count("*").alias("n")).collect()}
    assert [n[found[tuple(x)]] for x in (known, novel, low, low_novel)] == [8, 6, 2, 2]


def test_weak_site_snaps_and_far_one_is_rare(tracks):
    good = [(100, 200), (300, 400)]
    refs = tracks(("ref", "chr1", "+", good, "G", 0))
    reads = tracks(*[(f"r{i}", "chr1", "+", good, "G", 0) for i in range(5)], ("near", "chr1", "+", [(100, 203), (300, 400)], "G", 0), ("far", "chr1", "+", [(100, 250), (300, 400)], "G", 0), ("lost", "chr7", "+", good, "G", 0))
    isoforms, mapping, unused = K.junction_catalog(reads, refs)
    assert [r.isoform_id for r in isoforms.collect()] == ["ref"]
    assert sorted(r.read_id for r in mapping.collect()) == ["near", "r0", "r1", "r2", "r3", "r4"] and sorted(r.read_id for r in unused.collect()) == ["far", "lost"]


@pytest.mark.parametrize("strand", ["+", "-"])
def test_two_supported_ends_are_two_isoforms(tracks, strand):
    flip = (lambda x: x) if strand == "+" else (lambda x: [(2000 - e, 2000 - s) for s, e in reversed(x)])
    body = lambda end: flip([(100, 200), (300, 400), (500, end)])
    refs = tracks(("ref", "chr1", strand, body(1000), "G", 0))
    rows = [(f"a{i}", "chr1", strand, body(1000 - i % 4), "G", 0) for i in range(40)] + [(f"b{i}", "chr1", strand, body(840 - i % 4), "G", 0) for i in range(10)] + [("lone", "chr1", strand, body(700), "G", 0)]
    isoforms, mapping, unused = K.junction_catalog(tracks(*rows), refs)
    assert isoforms.count() == 2 and unused.count() == 0
    n = sorted(r["count"] for r in mapping.groupBy("isoform_id").count().collect())
    assert n == [11, 41]


def test_leader_reads_keep_their_start(tracks):
    refs = tracks(("ref", "chr1", "+", [(100, 200), (300, 400), (500, 600)], "G", 0))
    rows = [(f"s{i}", "chr1", "+", [(320, 400), (500, 600)], "G", 50) for i in range(3)] + [(f"p{i}", "chr1", "+", [(340, 400), (500, 600)], "G", 0) for i in range(3)]
    on, _, _ = K.junction_catalog(tracks(*rows), refs, ends=K.Ends(leader_score=11))
    off, _, _ = K.junction_catalog(tracks(*rows), refs)
    assert on.count() == 2 and off.count() == 1


def test_longest_by_name_keeps_the_first_of_equals(tracks):
    t = tracks(("x", "c", "+", [(0, 10)], "g", 0), ("x", "c", "+", [(5, 30)], "g", 0), ("x", "c", "+", [(50, 75)], "g", 0), ("y", "c", "+", [(1, 2)], "g", 0))
    assert {(r.name, r.tx_start) for r in K.dedup_longest(t).collect()} == {("x", 5), ("y", 1)}


def test_fusion_and_classes(tracks):
    refs = tracks(("ra", "chr1", "+", [(100, 200)], "GENE_A", 0), ("rb", "chr1", "+", [(210, 310)], "GENE_B", 0))
    assert [tuple(r) for r in D.fusions(tracks(("f", "chr1", "+", [(150, 260)], "x", 0)), refs).collect()] == [("f", "GENE_A;GENE_B")]
    ref = tracks(("r", "c", "+", [(0, 10), (20, 30), (40, 50)], "G10", 0))
    iso = tracks(("full", "c", "+", [(0, 10), (20, 30), (40, 50)], "G10", 0), ("cut", "c", "+", [(22, 30), (40, 50)], "G10", 0), ("kept", "c", "+", [(0, 30), (40, 50)], "G10", 0), ("new", "c", "+", [(0, 12), (20, 30), (40, 50)], "G10", 0))
    got = {r.isoform_id: r["class"] for r in D.classify(D.nearest_reference(iso, ref)).collect()}
    assert got == {"full": "all_matched", "cut": "five_prime_truncated", "kept": "retained_intron", "new": "novel_sites"}


def test_tail_summary(spark):
    lengths = {"a": 38.22, "b": 27.48, "c": 29.16, "d": 32.43, "e": 39.65}
    calls = [("S", r, "estimated", x) for r, x in lengths.items()] + [("S", "clip", "estimation_failed", None), ("S", "load", "estimation_failed", None), ("S", "unmapped", "estimated", 999.0)]
    mapping = spark.createDataFrame([("S", r, "long") for r in [*lengths, "clip", "load", "absent"]], "sample string, read_id string, isoform_id string")
    universe = spark.createDataFrame([("S", "long"), ("S", "none")], "sample string, isoform_id string")
    rows = {r.isoform_id: r for r in M.tail_summary(spark.createDataFrame(calls, "sample string, read_id string, status string, length double"), mapping, universe).collect()}
    r = rows["long"]
    assert (r.n_assigned, r.n_estimated, r.n_estimation_failed, r.n_missing) == (8, 5, 2, 1)
    assert [round(x, 6) for x in (r.mean, r.median, r.q25, r.q75, r.sd)] == [33.388, 32.43, 29.16, 38.22, 5.391175] and (r.shortest, r.longest) == (27.48, 39.65)
    assert rows["none"].n_assigned == 0 and rows["none"].mean is None


def test_known_effects(spark):
    counts = {"C1": (10, 8), "C2": (12, 8), "C3": (8, 8), "T1": (30, 16), "T2": (28, 18), "T3": (32, 14)}
    rows = [("G1", "chr1", 110, "+", "A+a", s, iso, k, 40, k / 40, "ok") for s, pair in counts.items() for iso, k in zip(("iso1", "iso2"), pair)]
    full = spark.createDataFrame(rows, "gene string, chrom string, pos long, strand string, mod_code string, sample string, isoform_id string, n_modified long, n_callable long, fraction double, reason string")
    groups = spark.createDataFrame([(s, "control" if s[0] == "C" else "treated") for s in counts], "sample string, `group` string")
    iso = {r["group"]: (round(r.mean_difference, 6), r.n_samples) for r in M.isoform_contrasts(full, groups).collect()}
    assert iso["control"] == (0.05, 3) and round(iso["treated"][0] - iso["control"][0], 6) == 0.3
    assert {r.isoform_id: (round(r.difference, 6), r.n_samples) for r in M.condition_contrasts(full, groups, "treated", "control").collect()}["iso1"] == (0.5, 6)


def test_statistics(spark):
    d = spark.createDataFrame([(0, 0), (0, 10), (5, 10), (10, 10)], "k long, n long")
    f, low, high = wilson(F.col("k"), F.col("n"))
    rows = d.select(f.alias("f"), low.alias("l"), high.alias("h")).collect()
    assert rows[0].f is rows[0].l is None and rows[1].l == 0 and rows[3].h == 1 and round(rows[2].l, 4) == 0.2366
    assert round(d.limit(1).select(odds_ratio(F.lit(10), F.lit(5), F.lit(3), F.lit(8)).alias("o")).first().o, 6) == round(10.5 * 8.5 / (5.5 * 3.5), 6)


def test_subsamples_are_disjoint(spark):
    ids = spark.createDataFrame([("s", f"r{i}") for i in range(50)], "stratum string, read_id string")
    rows = M.subsample(ids, 7, 10, 3).collect()
    assert len({r.read_id for r in rows}) == 30 and {r.replicate for r in rows} == {0, 1, 2}


GOOD = "chr1\t100\t250\tx\t10\t+\t100\t250\t0\t2\t50,50,\t0,100,\tn2\tnone\tnone\t-1\tT\tG1\tS\tR\tmore"


@pytest.mark.parametrize(("line", "error"), [
    (GOOD, None), ("# note", "skipped"), ("track name=x", "columns"), (GOOD.replace("\t10\t", "\t1200\t"), "score"), (GOOD.replace("50,50,", "50,,50,"), "block_count"),
    (GOOD.replace("\t+\t", "\tx\t"), "strand"), (GOOD.replace("0,100,", "0,40,"), "blocks"), (GOOD.replace("0,100,", "0,90,"), "bounds"), (GOOD.replace("\tx\t", "\t\t"), "name"), (GOOD.replace("chr1\t100", "chr1\tA"), "span"),
])
def test_bed_lines(spark, line, error):
    rows = bed.parse(spark.createDataFrame([(line,)], "value string")).collect()
    assert (rows[0].error if rows else "skipped") == error


def test_bed_round_trip_and_repair(spark):
    d = spark.createDataFrame([(GOOD,)], "value string")
    t = bed.parse(d)
    assert bed.format_bed(t).first().value == GOOD
    plain = GOOD.rsplit("\t", 9)[0]
    assert bed.format_bed(bed.parse(spark.createDataFrame([(plain,)], "value string"))).first().value == plain
    odd = GOOD.replace("\t10\t", "\t1200\t").replace("50,50,", "50,,60,")
    r = bed.parse(spark.createDataFrame([(odd,)], "value string"), lenient=True).first()
    assert r.error is None and r.score == 1000 and [tuple(e) for e in r.exons] == [(100, 150), (200, 250)] and r.repairs == 3  # score, empty size, size beyond the span


def test_annotation(spark):
    gff = ["##gff-version 3", "chr1\tx\tgene\t101\t250\t.\t+\t.\tID=gene1", "chr1\tx\texon\t201\t250\t.\t+\t.\tParent=tx1;gene_id=GENEA", "chr1\tx\texon\t101\t150\t.\t+\t.\tParent=tx1;gene_id=GENEA", "chr1\tx\texon\t101\t150\t.\t+\t.\tParent=tx1;gene_id=GENEA"]
    r = bed.parse_annotation(spark.createDataFrame([(x,) for x in gff], "value string")).first()
    assert (r.name, r.gene_id, r.tx_start, r.tx_end, [tuple(e) for e in r.exons], r.error) == ("tx1", "GENEA", 100, 250, [(100, 150), (200, 250)], None)
    gtf = ['c\tx\texon\t1\t50\t.\t-\t.\tgene_id "g"; transcript_id "t";', 'c\tx\texon\t40\t60\t.\t-\t.\tgene_id "g"; transcript_id "t";']
    assert bed.parse_annotation(spark.createDataFrame([(x,) for x in gtf], "value string")).first().error == "overlap"


def test_members(spark):
    d = spark.createDataFrame([("tc_name2_v1:a%20b,c+d|1.5",), ("r1,r2|0.5",), ("|0.5",), ("none",), (None,)], "n string")
    assert [r.m for r in d.select(bed.name2_members(F.col("n")).alias("m")).collect()] == [["a b", "c+d"], ["r1", "r2"], [], [], []]


def test_equal_chains_ask_once_for_a_container(spark, tracks):
    n = 300
    rows = [(f"r{i}", "chr1", "+", [(100 + i % 20, 200), (300, 500 + i)], "g", i) for i in range(n)]
    t = tracks(*rows)
    nodes = t.withColumns({
        "id": F.col("name"), "locus_start": F.lit(100).cast("long"), "junctions": G.junction_positions("exons", "strand"), "length": G.total("exons"), "is_ref": F.lit(False),
        "three": F.col("tx_end"), "five": F.col("tx_start"), "three_n": F.lit(0).cast("long"), "five_n": F.lit(0).cast("long"),
    })
    held = K.held_spliced(nodes, K.Ends())
    small, roots = nodes.join(held, "id", "left_semi"), nodes.join(held, "id", "left_anti")
    assert held.count() == n - 1 and K.spliced_containers(small, roots).count() == n - 1


def test_one_name_on_two_chromosomes_is_two_reads(spark, tracks):
    exons = [(100, 200), (300, 400)]
    refs = tracks(("a", "chr1", "+", exons, "g1", 0), ("b", "chr2", "+", exons, "g2", 0))
    reads = tracks(*[("x", c, "+", exons, g, 0) for c, g in (("chr1", "g1"), ("chr2", "g2"))])
    _, mapping, unused = K.junction_catalog(reads, refs, 1)
    assert sorted(r.isoform_id for r in mapping.collect()) == ["a", "b"] and unused.count() == 0


def test_required_abundance_output(spark, tracks):
    """20,000 reads of one gene in the shares 60:25:10:5 give four isoforms, and no read is left out."""
    four = [[(1000, 1100), (1200, 1300), (1400, 1500), (1600, 1700)], [(1000, 1100), (1200, 1300), (1450, 1500), (1600, 1700)], [(1000, 1100), (1400, 1500), (1600, 1700)], [(1000, 1100), (1200, 1350), (1400, 1500), (1600, 1700)]]
    refs = tracks(("ref", "chr1", "+", four[0], "g", 0))
    base = tracks(*[(f"k{k}", "chr1", "+", x, "g", 0) for k, x in enumerate(four)])
    share = spark.createDataFrame([("k0", 12_000), ("k1", 5000), ("k2", 2000), ("k3", 1000)], "name string, n int")
    reads = base.join(share, "name").withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n")))).withColumn("name", F.concat_ws("_", "name", "i"))
    isoforms, mapping, unused = K.junction_catalog(reads, refs)
    counts = sorted(r["count"] for r in mapping.groupBy("isoform_id").count().collect())
    assert isoforms.count() == 4 and counts == [1000, 2000, 5000, 12_000] and unused.count() == 0


def test_required_terminal_variation_output(spark, tracks):
    """3' ends 160 bases apart in the shares 80:20 stay two isoforms at 20,000 reads."""
    near, far = [(1000, 1100), (1200, 1340)], [(1000, 1100), (1200, 1500)]
    refs = tracks(("ref", "chr1", "+", far, "g", 0))
    base = tracks(("n", "chr1", "+", near, "g", 0), ("f", "chr1", "+", far, "g", 0))
    share = spark.createDataFrame([("f", 16_000), ("n", 4000)], "name string, n int")
    reads = base.join(share, "name").withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n")))).withColumn("name", F.concat_ws("_", "name", "i"))
    isoforms, mapping, unused = K.junction_catalog(reads, refs)
    assert isoforms.count() == 2 and sorted(r["count"] for r in mapping.groupBy("isoform_id").count().collect()) == [4000, 16_000] and unused.count() == 0
