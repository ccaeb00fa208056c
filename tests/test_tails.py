"""Tail files with faults, tables without a header, and exact quantiles of crowded groups."""

import random

import numpy as np
import pytest
from pyspark.sql import Row
from test_modbam import bam_file

from strandloom.functions.statistics import quantiles
from strandloom.operators import tails
from strandloom.sources import manifests


def record(name, tag, flag=0):
    return (name, flag, 10, 60, [(4, "M")], "AACA", b"" if tag is None else b"pti" + int(tag).to_bytes(4, "little", signed=True))


def row(path, caller="dorado"):
    return [Row(sample="S", group="g", caller=caller, input=path)]


def test_a_file_without_tags_is_an_error(spark, tmp_path):
    path = bam_file(tmp_path / "x.bam", [record("a", None), record("b", None)])
    with pytest.raises(ValueError, match="no pt tags"):
        manifests.read_tails(spark, row(path))
    path = bam_file(tmp_path / "y.bam", [record("a", None), record("b", 7), record("c", -1), record("b", 9, 0x100)])
    assert {(r.read_id, r.status, r.length) for r in manifests.read_tails(spark, row(path)).collect()} == {("S::a", "missing_pt_tag", None), ("S::b", "estimated", 7.0), ("S::c", "anchor_not_found", None)}


@pytest.mark.parametrize("other", [9, None])
def test_conflicting_tags_stop_an_assigned_read_only(spark, tmp_path, other):
    calls = manifests.read_tails(spark, row(bam_file(tmp_path / "x.bam", [record("a", 7), record("a", other), record("b", 5), record("b", 5)])))
    inputs = spark.createDataFrame([("S", "g", "dorado", "x")], "sample string, `group` string, caller string, input string")
    isoforms = spark.createDataFrame([("i", "G")], "isoform_id string, gene string")
    pairs = lambda *n: spark.createDataFrame([("S", f"S::{x}", "i") for x in n], "sample string, read_id string, isoform_id string")
    assert tails.aggregate(calls, inputs, pairs("b"), isoforms)["isoforms"].first().polya_mean_nt == 5.0
    with pytest.raises(Exception, match="conflicting tail tags"):
        tails.aggregate(calls, inputs, pairs("a", "b"), isoforms)


def test_tables_without_a_header(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("r1\tc\t1\t2\t3\t4\t5\t0.1\t30.5\tPASS\nr2\tc\t1\t2\t3\t4\t5\t0.1\t-1\tNOREGION\n")
    (tmp_path / "h.tsv").write_text("QC_tag\tReadname\tx\tpolya_length\nPASS\tr1\t-\t30.5\nADAPTER\tr2\t-\t-1\n")
    for name in ("t.tsv", "h.tsv"):
        got = {(r.read_id, r.status, r.length) for r in manifests.read_tails(spark, row(str(tmp_path / name), "nanopolish")).collect()}
        assert got == {("S::r1", "estimated", 30.5), ("S::r2", "qc_failed", None)}
    (tmp_path / "b.tsv").write_text("readname\tx\nr1\t3\n")
    with pytest.raises(ValueError, match="neither"):
        manifests.read_tails(spark, row(str(tmp_path / "b.tsv"), "nanopolish"))


def test_quantiles_follow_the_linear_rule(spark):
    r = random.Random(1)
    rows = [("hot", float(r.randint(1, 40))) for _ in range(5000)] + [("one", 3.0), ("two", 1.0), ("two", 2.0), ("none", None)] + [("some", r.random()) for _ in range(101)]
    got = {x.k: x for x in quantiles(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", {"a": 0.25, "b": 0.5, "c": 0.75, "d": 1.0}).collect()}
    assert set(got) == {"hot", "one", "two", "some"}
    for k, x in got.items():
        assert np.allclose([x.a, x.b, x.c, x.d], np.quantile([v for n, v in rows if n == k], [0.25, 0.5, 0.75, 1.0]))
