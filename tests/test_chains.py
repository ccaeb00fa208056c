"""Modification and tail chains from files to tables, with known results."""

import json

import pytest

from strandloom.__main__ import main
from strandloom.operators import site_tables
from strandloom.sources import manifests, tables

from test_sources import _bam

BED = "chr1\t100\t{end}\t{name}\t0\t+\t100\t{end}\t0\t2\t20,20,\t0,{at},\tnone\tnone\tnone\tnone\tnone\tG1\tnone\tnone\n"
MODIFIED = {"C1": (10, 8), "C2": (12, 8), "C3": (8, 8), "T1": (30, 16), "T2": (28, 18), "T3": (32, 14)}
ASSAY = {
    "schema_version": 1, "assay_id": "m", "caller": "modkit", "caller_version": "1", "model_id": "x", "chemistry": "rna004", "candidate_rule": "DRACH", "source_emission_threshold": None, "source_site_filter": "none",
    "candidate_observations_complete": True, "provenance_status": "user_declared", "implicit_skip_policy": "unknown", "coordinate_source": "genome", "read_id_mapping": "exact", "source_files": [],
}
SPECS = [("isoform_effect", "iso1", "iso2", "control", "NA"), ("condition_effect", "iso1", "NA", "control", "treated"), ("isoform_condition_interaction", "iso1", "iso2", "control", "treated"), ("condition_effect", "iso1", "NA", "control", "absent")]


def _rows(folder):
    lines = [x.split("\t") for p in sorted(folder.glob("part-*")) for x in p.read_text().splitlines()]
    return [dict(zip(lines[0], x)) for x in lines if x != lines[0]]


@pytest.fixture
def study(tmp_path):
    (tmp_path / "iso.bed").write_text(BED.format(name="iso1", end=220, at=100) + BED.format(name="iso2", end=320, at=200))
    (tmp_path / "ref.fa").write_text(">chr1 x\n" + ("A" * 50 + "\n") * 10)
    (tmp_path / "assay.json").write_text(json.dumps(ASSAY))
    head = [c.split()[0] for c in tables.OBSERVATION.split(", ")]
    mapping, listed, samples = [], ["sample\tassay_id\tobservations\tassay_metadata\tcoverage_bam"], ["sample\treads\tgroup"]
    for s, modified in MODIFIED.items():
        calls, reads = [], []
        for iso, k, gap in zip(("iso1", "iso2"), modified, (80, 180)):
            for i in range(40):
                calls.append((f"{iso}_{i}", 0.9 if i < k else 0.1))
                reads.append((f"{iso}_{i}", 0, 100, 60, [(20, "M"), (gap, "N"), (20, "M")], "A" * 40, b""))
                mapping.append(f"{s}::{iso}_{i}\t{iso}")
        calls += [("lost_0", 0.9), ("lost_1", 0.1)]
        text = ["\t".join(head)] + [f"m\t{s}\t{s}::{r}\tchr1\t110\t+\tA+a\t{p}\texplicit_probability\tDRACH\tNA\tNA" for r, p in calls]
        (tmp_path / f"{s}.tsv").write_text("\n".join(text + text[1:2]) + "\n")
        (tmp_path / f"{s}.bam").write_bytes(_bam(reads))
        listed.append(f"{s}\tm\t{s}.tsv\tassay.json\t{s}.bam")
        samples.append(f"{s}\t{s}.bed\t{'control' if s[0] == 'C' else 'treated'}")
    for name, lines in (("pairs.tsv", mapping), ("mods.tsv", listed), ("samples.tsv", samples)):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    spec = ["\t".join(site_tables.SPEC)] + [f"{k}\tm\tG1\tchr1:110:+\tA+a\t{a}\t{b}\t{x}\t{y}" for k, a, b, x, y in SPECS]
    (tmp_path / "specs.tsv").write_text("\n".join(spec) + "\n")
    return tmp_path


def test_modification_chain(spark, study):
    main(["mod-aggregate", "--manifest", f"{study}/mods.tsv", "--reads", f"{study}/samples.tsv", "--refs", f"{study}/iso.bed", "--mapping", f"{study}/pairs.tsv", "--fasta", f"{study}/ref.fa", "--threshold", "m=0.5", "--strict", "--out", f"{study}/out"])
    qc = _rows(study / "out/join_qc")
    assert [tuple(r[k] for k in ("sample", "input_rows", "valid_rows", "joined_rows", "assigned_reads", "unknown_read", "duplicate_exact", "read_join_rate")) for r in qc] == [(s, "83", "82", "80", "80", "2", "1", "1") for s in MODIFIED]
    sites = {(r["sample"], r["isoform_id"]): r for r in _rows(study / "out/sites")}
    assert len(sites) == 12
    for s, pair in MODIFIED.items():
        for iso, k in zip(("iso1", "iso2"), pair):
            r = sites[s, iso]
            assert (r["site_state"], r["coverage_basis"], r["n_assigned"], r["n_covering"], r["n_candidate"], r["n_callable"], r["n_modified"], r["eligibility_reason"]) == ("present", "bam_exact", "40", "40", "40", "40", str(k), "ok")
    main(["mod-contrast", "--reads", f"{study}/out/design", "--specs", f"{study}/specs.tsv", "--out", f"{study}/effects"])
    got = {(r["contrast_type"], r["group_b"]): r for r in _rows(study / "effects")}
    number = lambda r, k: round(float(r[k]), 9)
    a, b, c, d = got["isoform_effect", "NA"], got["condition_effect", "treated"], got["isoform_condition_interaction", "treated"], got["condition_effect", "absent"]
    assert (a["n_eligible_samples"], number(a, "delta_fraction")) == ("3", 0.05) and (b["n_eligible_samples"], number(b, "delta_fraction")) == ("6", 0.5)
    assert (c["n_eligible_samples"], number(c, "interaction_delta"), c["odds_ratio"]) == ("6", 0.3, "NA") and {r["p_value"] for r in got.values()} == {"NA"}
    assert number(a, "odds_ratio") == round((30.5 * 96.5) / (90.5 * 24.5), 9) and number(b, "odds_ratio") == round((90.5 * 90.5) / (30.5 * 30.5), 9)
    assert (d["n_eligible_samples"], d["delta_fraction"], d["eligibility_reason"]) == ("3", "NA", "missing_eligible_group")
    main(["mod-site-summary", "--reads", f"{study}/out/sites", "--out", f"{study}/summary"])
    (r,) = _rows(study / "summary")
    assert (r["n_rows"], r["rows_ok"], r["n_isoforms"], r["n_samples"], r["n_modified"], r["n_callable"], r["least_callable"]) == ("12", "12", "2", "6", str(sum(map(sum, MODIFIED.values()))), "480", "40")
    main(["mod-subsample", "--mapping", f"{study}/pairs.tsv", "--refs", f"{study}/iso.bed", "--size", "5", "--replicates", "3", "--out", f"{study}/sub"])
    picked = _rows(study / "sub")
    assert len(picked) == len({r["read_id"] for r in picked}) == 15 and {r["replicate"] for r in picked} == {"0", "1", "2"}


def test_modification_rules(spark, study):
    rows = manifests.modification_manifest(spark, f"{study}/mods.tsv")
    mapping = manifests.mapping_of_samples(tables.read_isoform_pairs(spark.read.text(f"{study}/pairs.tsv")))
    iso = spark.createDataFrame([("iso1", "G1", "chr1", "+", [(100, 120), (200, 220)]), ("iso2", "G1", "chr1", "+", [(150, 160)])], "isoform_id string, gene string, chrom string, strand string, exons array<struct<start:long,end:long>>")
    calls, inputs, _ = manifests.read_modifications(spark, rows[:1], {"m": 0.5}, {})
    inputs = inputs.selectExpr("* EXCEPT (has_coverage)", "false AS has_coverage")
    out = {r.isoform_id: r for r in site_tables.aggregate(calls, inputs, mapping, iso, gates=site_tables.Gates()).get("sites").where("sample = 'C1'").collect()}
    assert (out["iso1"].n_covering, out["iso1"].coverage_basis, out["iso1"].eligibility_reason) == (None, "unavailable", "ok")
    # Calls of reads of an isoform without the site stay candidates, but none can be called.
    assert (out["iso2"].site_state, out["iso2"].n_candidate, out["iso2"].n_callable, out["iso2"].n_unknown, out["iso2"].mod_fraction) == ("structurally_absent", 40, 0, 40, None)
    strict = site_tables.aggregate(calls, inputs, mapping, iso, gates=site_tables.Gates(strict=True))["sites"]
    assert {r.eligibility_reason for r in strict.collect()} == {"coverage_unavailable", "site_absent"}
    twice = mapping.union(spark.createDataFrame([("C1", "C1::iso1_0", "iso2")], mapping.schema))
    with pytest.raises(Exception, match="several isoforms"):
        site_tables.aggregate(calls, inputs, twice, iso)
    with pytest.raises(Exception, match="below the minimum"):
        site_tables.aggregate(calls.where("read_id < 'C1::iso2'"), inputs, mapping, iso)
    with pytest.raises(ValueError, match="without a threshold"):
        manifests.read_modifications(spark, rows, {}, {})
    bad = spark.createDataFrame([("isoform_effect", "m", "G1", "chr1:110:+", "A+a", "iso1", "iso1", None, None)], ", ".join(f"{c} string" for c in site_tables.SPEC))
    with pytest.raises(Exception, match="a contrast is not valid"):
        site_tables.checked_specs(bad).collect()


def test_tail_chain(spark, tmp_path):
    (tmp_path / "iso.bed").write_text(BED.format(name="long", end=220, at=100) + BED.format(name="short", end=320, at=200))
    lengths = {"a": 38.22, "b": 27.48, "c": 29.16, "d": 32.43, "e": 39.65}
    rows = [(r, x, "PASS") for r, x in lengths.items()] + [("a", 1.0, "ADAPTER"), ("clip", 9.0, "SUFFCLIP"), ("load", 8.0, "READ_FAILED_LOAD"), ("unmapped", 999.0, "PASS")]
    (tmp_path / "tails.tsv").write_text("readname\tpolya_length\tqc_tag\n" + "".join(f"{r}\t{x}\t{q}\n" for r, x, q in rows))
    tag = lambda n: b"pti" + n.to_bytes(4, "little", signed=True)
    (tmp_path / "d.bam").write_bytes(_bam([(n, 0, 100, 60, [(4, "M")], "AAAA", t) for n, t in (("x", tag(30)), ("y", tag(0)), ("z", tag(-1)), ("w", b""))]))
    (tmp_path / "m.tsv").write_text("sample\tgroup\tbam\tnanopolish\nD\tg\td.bam\tNA\nS\t\tNA\ttails.tsv\n")
    pairs = [f"S::{r}\tlong" for r in [*lengths, "clip", "load", "absent"]] + [f"D::{r}\tshort" for r in ("x", "y", "z", "w", "v")]
    (tmp_path / "pairs.tsv").write_text("\n".join(pairs) + "\n")
    main(["polya-aggregate", "--manifest", f"{tmp_path}/m.tsv", "--refs", f"{tmp_path}/iso.bed", "--mapping", f"{tmp_path}/pairs.tsv", "--out", f"{tmp_path}/out"])
    iso = {(r["sample"], r["isoform_id"]): r for r in _rows(tmp_path / "out/isoforms")}
    assert len(iso) == 4 and iso["S", "short"]["assigned_reads"] == "0" and iso["S", "short"]["polya_mean_nt"] == "NA"
    r = iso["S", "long"]
    assert [r[k] for k in ("assigned_reads", "observed_reads", "polya_reads", "qc_failed_reads", "missing_nanopolish_reads", "polya_fraction")] == ["8", "7", "5", "2", "1", "0.625000"]
    assert [round(float(r[f"polya_{k}_nt"]), 6) for k in ("mean", "median", "q25", "q75", "min", "max", "stddev")] == [33.388, 32.43, 29.16, 38.22, 27.48, 39.65, 5.391175]
    r = iso["D", "short"]
    assert [r[k] for k in ("assigned_reads", "polya_reads", "missing_bam_reads", "missing_pt_reads", "anchor_not_found_reads", "estimation_failed_reads", "polya_stddev_nt")] == ["5", "1", "1", "1", "1", "1", "NA"]
    qc = {r["sample"]: r for r in _rows(tmp_path / "out/qc")}
    assert (qc["S"]["unassigned_reads"], qc["S"]["read_join_rate"], qc["D"]["group"], qc["S"]["group"]) == ("1", "0.875000", "g", "NA")
    (tmp_path / "m.tsv").write_text("sample\tbam\tnanopolish\nD\td.bam\ttails.tsv\n")
    with pytest.raises(ValueError, match="exactly one"):
        manifests.tail_manifest(spark, f"{tmp_path}/m.tsv")
