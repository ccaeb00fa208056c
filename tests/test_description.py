"""Descriptions in words and the twelve classes on worked cases; eligibility and metadata."""

import pytest
from pyspark.sql import functions as F

from strandloom.operators import description as D
from strandloom.sources import tables as T

REF = [(0, 100), (200, 300), (400, 500), (600, 700)]
CASES = {
    "same": (REF, "No miss exon.", "No extra exon.", "all_matched>=_ref", None),
    "near": ([(0, 105), (195, 300), (400, 500), (600, 700)], "No miss exon.", "No extra exon.", "all_matched>=_ref", None),
    "tail": ([(400, 500), (600, 700)], "5 primer miss: exon 1 to 2", "No extra exon.", "new_combination", "5'missing"),
    "head": ([(0, 100), (200, 300)], "3 primer miss: exon 3 to 4", "No extra exon.", "new_combination", "3'missing"),
    "skip": ([(0, 100), (400, 500), (600, 700)], "Exon miss: exon 2 to 2", "No extra exon.", "new_combination", "inner_miss_exon"),
    "kept": ([(0, 100), (200, 500), (600, 700)], "Intron retention: intron 2 to 2", "No extra exon.", "new_combination", "intron_retention"),
    "more": ([(0, 100), (130, 160), (200, 300), (400, 500), (600, 700)], "No miss exon.", "Exon extra: exon 2 to 2", "new_junction", "inner_extra_exon"),
    "site": ([(0, 100), (200, 300), (430, 500), (600, 700)], "Exon miss: exon 3 to 3", "Exon extra: exon 3 to 3", "new_junction", "new_junction"),
    "long": ([(0, 100), (200, 300), (400, 500), (600, 900)], "No miss exon.", "No extra exon.", "all_matched>=_ref", "full_matched>="),
    "brief": ([(50, 100), (200, 300), (400, 500), (600, 650)], "No miss exon.", "No extra exon.", "all_matched_<_ref", "full_matched<"),
}


@pytest.mark.parametrize("strand", ["+", "-"])
def test_words_and_classes(tracks, strand):
    flip = (lambda x: x) if strand == "+" else (lambda x: [(1000 - e, 1000 - s) for s, e in reversed(x)])
    refs = tracks(("ref", "c", strand, flip(REF), "G", 0))
    iso = tracks(*[(n, "c", strand, flip(v[0]), "G", 0) for n, v in CASES.items()])
    rows = D.describe(iso, refs)
    got = {r.isoform_id: (r.miss, r.extra, r.class4) for r in rows.collect()}
    assert got == {n: v[1:4] for n, v in CASES.items()}
    none = rows.where("false").select("isoform_id")
    assert {r.isoform_id: r["class"] for r in D.class12(rows, none, none).collect()} == {n: v[4] for n, v in CASES.items() if v[4]}
    fused, known = rows.where("isoform_id = 'long'"), rows.where("isoform_id = 'skip'")
    top = {r.isoform_id: r["class"] for r in D.class12(rows, fused, known).collect()}
    assert (top["long"], top["skip"]) == ("fusion_gene", "reference")


def test_assay_metadata(spark):
    good = '{"schema_version": 1, "assay_id": "a", "caller": "x"}'
    rows = lambda t: spark.createDataFrame([(t,)], "value string")
    assert T.assay_metadata(rows(good)).first().caller == "x"
    for bad in (good.replace("1,", "2,"), good.replace('"caller"', '"colour"')):
        with pytest.raises(Exception, match="another version"):
            T.assay_metadata(rows(bad)).collect()


def test_crowded_lists_give_the_nearest_reference_without_a_product(spark):
    import random

    from strandloom.operators.description import FEW, _by_ends

    r = random.Random(3)
    span = lambda: (lambda s: (s, s + r.choice((40, 100, 900))))(r.choice((r.randint(0, 4000), 700)))
    refs = [(f"r{k}", b, *span()) for b, n in (("x", 10 * FEW), ("y", 3)) for k in range(n)]
    reads = [(f"q{k}", "g", a, *span()) for k in range(60) for a in ("A", "B")]
    lists = [("A", "x"), ("A", "y"), ("B", "y")]
    own = spark.createDataFrame(reads, "isoform_id string, gene string, a_id string, a_start long, a_end long")
    known = spark.createDataFrame(refs, "ref_id string, b_id string, b_start long, b_end long")
    best = spark.createDataFrame(lists, "a_id string, b_id string")
    got = {(x.isoform_id, x.a_id): (x.n.ends, x.n.ref_id, x.n.b_id) for x in _by_ends(own, known, best).collect()}
    want = {(q, a): min((abs(s - t) + abs(e - f), k, b) for k, b, t, f in refs if (a, b) in lists) for q, _, a, s, e in reads}
    assert got == want


def test_rows_pass_once_to_the_nearest_of_few_references(tracks):
    """Isoforms of a few references meet them in one join: no shuffle of rows behind it, and none by isoform."""
    refs = tracks(*[(f"ref{k}", "c", "+", [(k, 100), *REF[1:]], "G", 0) for k in range(3)], ("one", "c", "+", [(0, 90)], "G", 0), ("two", "c", "+", [(40, 95)], "G", 0))
    iso = tracks(("x", "c", "+", [(2, 100), *REF[1:]], "G", 0), ("y", "c", "+", [(30, 95)], "G", 0))
    rows = D.nearest_reference(iso, refs)
    assert {r.isoform_id: (r.ref_id, r.ends, r.whole.ref_id) for r in rows.collect()} == {"x": ("ref2", 0, "ref0"), "y": ("two", 10, "one")}
    near = D._beside(*(rows.sparkSession.createDataFrame(*x) for x in (
        ([("x", "G", "A", 2, 700)], "isoform_id string, gene string, a_id string, a_start long, a_end long"), ([("r", "B", 0, 700)], "ref_id string, b_id string, b_start long, b_end long"),
        ([("A", "B", [], [], [], [], [], False, None, [])], "a_id string, b_id string, missed array<int>, extra array<int>, miss_runs array<int>, extra_runs array<int>, b_sites array<long>, novel boolean, whole string, a_sites array<long>"), ([("A", "B")], "a_id string, b_id string"))))
    assert [(r.ref_id, r.ends) for r in near.collect()] == [("r", 2)]
