"""Subcommands end to end on files."""

from strandloom.__main__ import main

REF = "chr1\t100\t400\tref\t0\t+\t100\t400\t0\t2\t100,100,\t0,200,\tnone\tnone\tnone\tnone\tnone\tG1\tnone\tnone"


def _text(folder):
    return [x for p in sorted(folder.glob("part-*")) for x in p.read_text().splitlines()]


def test_commands(spark, tmp_path):
    (tmp_path / "ref.bed").write_text(REF + "\n")
    reads = "".join(REF.replace("\tref\t", f"\tr{i}\t").replace("\tG1\t", "\tnone\t") + "\n" for i in range(3))
    (tmp_path / "reads.bed").write_text(reads)
    (tmp_path / "m.tsv").write_text("sample\treads\nS1\treads.bed\n")
    r, f, o = str(tmp_path / "reads.bed"), str(tmp_path / "ref.bed"), tmp_path / "out"
    main(["count", "--reads", r, "--refs", f, "--out", f"{o}/count"])
    assert _text(o / "count") == ["gene,isoform_id,count", "G1,ref,3"]
    main(["clusterj", "--reads", r, "--refs", f, "--support", "1", "--out", f"{o}/c"])
    assert [x for x in _text(o / "c/read_to_isoform") if "::" not in x and x != "read_id\tisoform_id"] == [f"r{i}\tref" for i in range(3)]
    main(["export", "--reads", f, "--out", f"{o}/gtf"])
    main(["gff2bigg", "--refs", f"{o}/gtf", "--out", f"{o}/bed"])
    back = _text(o / "bed")[0].split("\t")
    assert back[:4] + back[5:6] == REF.split("\t")[:4] + ["+"] and back[4] == "100" and back[15:18] == ["-1,-1,", "isoform_anno", "G1"]
    main(["addgene", "--reads", r, "--refs", f, "--out", f"{o}/g"])
    assert sorted(set(_text(o / "g")) - {"name\tgenes"}) == [f"r{i}\tG1" for i in range(3)]
    main(["flow", "--reads", str(tmp_path / "m.tsv"), "--refs", f, "--out", f"{o}/flow"])
    assert "G1\tref\t3" in _text(o / "flow/counts")
    main(["count-multi", "--reads", str(tmp_path / "m.tsv"), "--refs", f, "--out", f"{o}/cm"])
    assert any("S1" in x for x in _text(o / "cm"))
    main(["desc", "--reads", f, "--refs", f, "--out", f"{o}/d"])
    assert any("all_matched" in x for x in _text(o / "d/classes"))
    main(["validate-bed", "--reads", r, "--out", f"{o}/v"])
    main(["cluster", "--reads", r, "--refs", f, "--out", f"{o}/ov"])
    assert sorted(set(_text(o / "ov/read_to_isoform")) - {"read_id\tisoform_id"}) == [f"r{i}\tref" for i in range(3)]
