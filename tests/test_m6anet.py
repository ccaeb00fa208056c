"""Audited import of m6Anet calls: projection, duplicates, and tables that must agree."""

import json
import re

import pytest

from strandloom.__main__ import main
from strandloom.sources import m6anet, tables

GTF = "".join(f'{c}\tt\texon\t{s}\t{e}\t.\t{k}\t.\tgene_id "{g}"; transcript_id "{t}";\n' for c, s, e, k, g, t in (("chr1", 101, 103, "+", "G1", "P.1"), ("chr1", 201, 203, "+", "G1", "P.1"), ("chr2", 1001, 1003, "-", "G2", "M.2"), ("chr2", 2001, 2003, "-", "G2", "M.2"), ("chr3", 1, 9, "+", "G3", "other")))
INDIV = "transcript_id,transcript_position,read_index,probability_modified\n"
ROWS = "P.1,4,0,0.9\nP.1,4,1_r2,0.01\nM.2,1,0,0.5\nP.1,4,0,0.9\n"
MAP = "read_index\tread_id\n0\tr0\n1_r2\tS1::r1\n7\tr7\n"
INFO = "transcript_id,transcript_position,start,end,n_reads\nP.1,4,0,50,2\nM.2,1,50,90,1\nP.1,2,90,95,1\n"
SITES = "transcript_id,transcript_position,n_reads,probability_modified,kmer,mod_ratio\nP.1,4,2,0.95,GGACT,0.5\nM.2,1,1,0.2,AAACA,1.0\n"


def run(spark, tmp_path, rows=ROWS, ids=MAP, gtf=GTF, info=None, sites=None, **kw):
    for name, text in (("i.csv", INDIV + rows), ("m.tsv", ids), ("a.gtf", gtf), ("d.csv", info), ("s.csv", sites)):
        if text is not None:
            (tmp_path / name).write_text(text)
    p = lambda n: str(tmp_path / n)
    return m6anet.run(spark, p("i.csv"), p("m.tsv"), p("a.gtf"), "m", "S1", "HCT116_RNA002", data_info=p("d.csv") if info else None, site_proba=p("s.csv") if sites else None, **kw)


def test_projection_and_audit(spark, tmp_path):
    observations, assay, audit = run(spark, tmp_path, info=INFO, sites=SITES)
    got = {(r.read_id, r.chrom, r.pos0, r.strand, r.probability, r.source_transcript_id, r.source_pos0) for r in observations.collect()}
    assert got == {("S1::r0", "chr1", 201, "+", 0.9, "P.1", 4), ("S1::r1", "chr1", 201, "+", 0.01, "P.1", 4), ("S1::r0", "chr2", 2001, "-", 0.5, "M.2", 1)}
    assert audit == {
        "input_rows": 4, "unique_observations": 3, "duplicate_exact": 1, "read_map_entries": 3, "read_map_entries_used": 2, "source_transcripts": 2, "projection_transcripts_loaded": 2, "source_sites": 2,
        "data_info_sites": 3, "data_info_retained_sites": 2, "data_info_filtered_sites": 1, "data_info_total_reads": 4, "data_info_retained_reads": 3, "data_info_minimum_reads": "NA",
        "site_probability_sites": 2, "site_probability_total_reads": 3, "site_probability_sites_at_or_above_threshold": 1, "site_probability_threshold": 0.9, "read_probability_threshold": 0.033379376,
    }
    a = json.loads(assay)
    assert (a["candidate_observations_complete"], a["source_site_filter"], a["candidate_rule"]) == (True, "m6anet_data_info_retained_sites", "DRACH")
    assert run(spark, tmp_path)[2]["data_info_sites"] == "NA"


@pytest.mark.parametrize(("kw", "message"), [
    ({"ids": "index\tread\n0\tx\n"}, "header mismatch"), ({"ids": "read_index\tread_id\n0\tr0\n"}, "read_index 1_r2 is missing"), ({"ids": MAP + "0\tr9\n"}, "duplicate read_index"), ({"ids": MAP + "8\tr7\n"}, "duplicate read_id"), ({"ids": MAP + "8\tT::r8\n"}, "another sample prefix"),
    ({"gtf": GTF.replace("P.1", "P.2")}, "version mismatch: m6Anet has P.1, the annotation P.2"), ({"gtf": GTF.replace("P.1", "Q.1")}, "absent from the annotation"), ({"gtf": GTF.replace("\t+\t", "\t.\t")}, "unknown strand"), ({"rows": ROWS + "P.1,6,0,0.1\n"}, "out of bounds"),
    ({"rows": ROWS + "P.1,4,0,0.8\n"}, "conflicting duplicate"), ({"rows": ROWS + "P.1,4,7,1.5\n"}, "not in 0..1"), ({"rows": ROWS + "P.1,-4,7,0.5\n"}, "whole number"), ({"rows": ""}, "no observations"),
    ({"info": INFO.replace("P.1,4,0,50,2", "P.1,4,0,50,3")}, "n_reads=3, but data.indiv_proba contains 2"), ({"info": INFO.replace("M.2,1,50,90,1\n", "")}, "M.2:1 is retained, but missing"), ({"info": INFO, "least_reads": 1}, "retained-site mismatch"), ({"info": INFO + "P.1,4,1,2,2\n"}, "duplicate site"),
    ({"sites": SITES.replace("GGACT,0.5", "GGACT,0.6")}, "mod_ratio=0.6, expected 0.5"), ({"sites": SITES.replace("AAACA", "AAAGA")}, "does not match"), ({"sites": SITES + "P.1,2,1,0.2,AAACA,1.0\n"}, "absent from data.indiv_proba"), ({"rule": "DRAC"}, "candidate rule"),
])
def test_disagreements_end_the_import(spark, tmp_path, kw, message):
    with pytest.raises(Exception, match=re.escape(message)):
        run(spark, tmp_path, **kw)[0].collect()


def test_command(spark, tmp_path):
    run(spark, tmp_path, info=INFO)
    p = lambda n: str(tmp_path / n)
    main(["mod-import-m6anet", "--indiv", p("i.csv"), "--read-map", p("m.tsv"), "--refs", p("a.gtf"), "--data-info", p("d.csv"), "--sample", "S1", "--assay", "m", "--model", "HCT116_RNA002", "--out", p("o")])
    obs = spark.read.csv(p("o.observations"), sep="\t", header=True, schema=tables.OBSERVATION, enforceSchema=False, nullValue="NA", quote="", mode="FAILFAST")
    assert tables.observations(obs).count() == 3 and tables.assay_metadata(spark.read.text(p("o.assay"), wholetext=True)).first().chemistry == "RNA002"
    assert dict(r.value.split("\t") for r in spark.read.text(p("o.import_qc")).collect())["data_info_filtered_sites"] == "1"
