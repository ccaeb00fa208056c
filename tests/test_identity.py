"""Rules of identity and fixed tokens of tables."""

import pytest
from pyspark.sql import functions as F

from strandloom.operators import counting, modification
from strandloom.sources import bam, bed, tables


def test_conflicting_alignments_of_a_name_are_an_error(spark, tracks):
    refs = tracks(("a", "chr1", "+", [(100, 200)], "g", 0), ("b", "chr1", "+", [(900, 990)], "g", 0))
    same = tracks(("x", "chr1", "+", [(100, 190)], "g", 0), ("x", "chr1", "+", [(100, 190)], "g", 5))
    assert [r.isoform_id for r in counting.assign_to_catalog(same, refs).collect()] == ["a"]
    other = tracks(("x", "chr1", "+", [(100, 190)], "g", 0), ("x", "chr1", "+", [(900, 980)], "g", 0))
    with pytest.raises(Exception, match="conflicting alignments: x"):
        counting.assign_to_catalog(other, refs).collect()


def test_a_sample_listed_twice_is_an_error(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("# reads\nsample\treads\ns1\ta.bed\ns1\tb.bed\n")
    with pytest.raises(Exception, match="listed twice"):
        tables.manifest(spark, str(tmp_path / "m.tsv")).collect()
    (tmp_path / "m.tsv").write_text("sample\treads\ns1\ta.bed\ns2\tb.bed\n")
    assert tables.manifest(spark, str(tmp_path / "m.tsv")).count() == 2


def test_states_of_calls_are_the_file_tokens(spark):
    row = lambda i, state, p: ("m", "s", f"r{i}", "chr1", 5, "+", "A+a", p, state, None, None, None)
    rows = [row(0, "explicit_probability", 0.9), row(1, "explicit_probability", 0.1), row(2, "implicit_below_emission_threshold", None), row(3, "unknown", None)]
    obs = tables.observations(spark.createDataFrame(rows, tables.OBSERVATION))
    mapped = obs.withColumnRenamed("pos0", "pos").withColumn("gene", F.lit("g")).withColumn("isoform_id", F.lit("i"))
    r = modification.aggregate(mapped).first()
    assert (r.n_explicit, r.n_modified, r.n_implicit, r.n_unknown, r.n_callable) == (2, 1, 1, 1, 3)
    with pytest.raises(Exception, match="not valid"):
        tables.observations(spark.createDataFrame([row(0, "explicit", 0.9)], tables.OBSERVATION)).collect()


def test_bytes_of_groups_with_several_codes(spark):
    schema = "name string, flag int, mapq int, chrom string, start long, cigar string, seq string, mm string, ml binary, mn int"
    row = ("r", 0, 60, "chr1", 100, "4M", "CACA", "C+mh,0;A+a,0", bytearray([10, 20, 200]), 4)
    r = bam.modification_calls(spark.createDataFrame([row], schema)).first()
    assert r.pos0 == 101 and r.probability == 200.5 / 256
    short = (*row[:8], bytearray([10, 20]), 4)
    with pytest.raises(Exception, match="another number of bytes"):
        bam.modification_calls(spark.createDataFrame([short], schema)).collect()


def test_tail_without_pass_failed_its_check(spark):
    raw = spark.createDataFrame([("a", 10.0, "PASS"), ("b", 9.0, "ADAPTER")], "readname string, polya_length double, qc_tag string")
    assert {r.read_id: (r.status, r.length) for r in tables.nanopolish_tails(raw).collect()} == {"a": ("estimated", 10.0), "b": ("qc_failed", None)}


def test_least_callable_reads_follow_the_profile(spark):
    cols = {"site_state": "present", "complete": True, "join_low": False, "n_unknown_source": 0, "n_implicit": 0, "implicit_callable": True, "has_coverage": True, "reference_checked": True, "verified": True, "n_covering": 20, "n_candidate": 18, "n_callable": 16}
    d = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()])
    reason = lambda strict, **kw: d.withColumns({k: F.lit(v) for k, v in kw.items()}).select(modification.eligibility(strict)).first()[0]
    assert reason(True) == "ok" and reason(False, n_callable=1) == "ok"
    assert reason(True, n_covering=19) == "low_covering" and reason(True, n_callable=9) == "low_callable" and reason(True, n_candidate=15) == "low_candidate_rate"


def test_repairs_count_dropped_items(spark):
    line = "chr1\t0\t100\tx\t0\t+\t0\t0\t0\t2\t10,,20,\t0,80,"
    r = bed.parse(spark.createDataFrame([(line,)], "value string"), lenient=True).first()
    assert (r.error, r.repairs) == (None, 1)
    good = bed.parse(spark.createDataFrame([(line.replace(",,", ","),)], "value string"), lenient=True).first()
    assert (good.error, good.repairs) == (None, 0)


def test_catalogs_collapse_equal_records_and_name_conflicts(spark, tracks):
    from strandloom.operators import identity

    a = tracks(("x", "c", "+", [(0, 10)], "g", 0), ("y", "c", "+", [(0, 10)], None, 0), ("z", "c", "+", [(0, 10)], "g", 0)).drop("instance_id")
    b = tracks(("x", "c", "+", [(0, 10)], "g", 0), ("y", "c", "+", [(0, 10)], None, 0), ("z", "c", "-", [(0, 12)], None, 0)).drop("instance_id")
    catalog, conflicts = identity.merge_catalogs(a.unionByName(b).unionByName(a))
    assert sorted(r.name for r in catalog.collect()) == ["x", "y"] and catalog.columns == a.columns
    assert [tuple(r) for r in conflicts.collect()] == [("z", 2, "strand,tx_end,exons,gene_id")]
    with pytest.raises(ValueError, match="'z' describes 2 conflicting records"):
        identity.merged(a.unionByName(b))
    assert identity.merged(a.unionByName(a)).count() == 3


def test_faults_of_ids(spark, tracks):
    from strandloom.functions import geometry as G
    from strandloom.operators import identity

    t = tracks(("", "c", "+", [(0, 10)], "g", 0), ("x", "c", "+", [(0, 10)], "g", 0), ("x", "c", "+", [(0, 11)], "g", 0), (G.NOVEL + "q", "c", "+", [(0, 10)], "g", 0), ("ok", "c", "+", [(0, 10)], "g", 0))
    assert {(r.name, r.fault, r.n) for r in identity.id_faults(t, True).collect()} == {("", "empty", 1), ("x", "duplicate", 2), (G.NOVEL + "q", "reserved", 1)}
    assert {r.fault for r in identity.id_faults(t).collect()} == {"empty", "duplicate"}
