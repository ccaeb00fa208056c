"""BAM files by ranges, and calls of modified bases of all states, against plain readings."""

import json
import random
import struct
import zlib

import pytest

from strandloom.__main__ import main
from strandloom.sources import bam, manifests, modbam, tables
from strandloom.sources.modbam import Target, import_calls

COMPLEMENT = dict(zip("ACGTN", "TGCAN"))


def block(part):
    z = zlib.compressobj(6, zlib.DEFLATED, -15)
    data = z.compress(part) + z.flush()
    return b"\x1f\x8b\x08\x04" + b"\0" * 6 + struct.pack("<H", 6) + b"BC" + struct.pack("<HH", 2, len(data) + 25) + data + struct.pack("<II", zlib.crc32(part), len(part))


def bam_file(path, records, text="", chrom_length=1_000_000, size=700, qual=b"\xff"):
    body = b"BAM\1" + struct.pack("<i", len(text)) + text.encode() + struct.pack("<i", 1) + struct.pack("<i", 5) + b"chr1\0" + struct.pack("<i", chrom_length)
    for name, flag, pos, mapq, cigar, seq, tags in records:
        steps = [(int(n), o) for n, o in cigar]
        ops = b"".join(struct.pack("<I", n << 4 | bam.OPS.index(o)) for n, o in steps)
        codes = [bam.LETTERS.index(c) for c in seq] + [0] * (len(seq) % 2)
        packed = bytes(codes[i] << 4 | codes[i + 1] for i in range(0, len(codes), 2))
        rec = struct.pack("<iiBBHHHiiii", 0, pos, len(name) + 1, mapq, 0, len(steps), flag, len(seq), -1, -1, 0) + name.encode() + b"\0" + ops + packed + qual * len(seq) + tags
        body += struct.pack("<i", len(rec)) + rec
    path.write_bytes(b"".join(block(body[i : i + size]) for i in range(0, len(body), size)) + block(b""))
    return str(path)


def tags(mm, ml, mn):
    return b"MMZ" + mm.encode() + b"\0MLBC" + struct.pack("<I", len(ml)) + bytes(ml) + b"MNI" + struct.pack("<I", mn)


def random_records(r, n):
    out = []
    for k in range(n):
        cigar, q = [], 0
        for op in ["S"] * r.randint(0, 1) + r.choices("MMMIDN=X", k=r.randint(2, 7)) + ["M"] + ["S"] * r.randint(0, 1):
            m = r.randint(1, 30)
            cigar.append((m, op))
            q += m * (op in "MIS=X")
        seq, reverse = "".join(r.choice("ACGTN" if r.random() < 0.05 else "ACGT") for _ in range(q)), r.random() < 0.5
        own = "".join(COMPLEMENT[c] for c in reversed(seq)) if reverse else seq
        mm, ml = "", []
        for head, codes in r.sample([("C+", "mh"), ("A+", "a"), ("T-", "17596"), ("N+", "n")], r.randint(1, 4)):
            places = [i for i, c in enumerate(own) if head[0] in ("N", c)]
            gaps, at = [], 0
            while at < len(places) and r.random() < 0.8:
                g = r.randint(0, min(3, len(places) - 1 - at))
                gaps.append(g)
                at += g + 1
            mm += head + codes + r.choice(["", ".", "?"]) + "".join(f",{g}" for g in gaps) + ";"
            ml += [r.randint(0, 255) for _ in range(len(gaps) * (1 if codes.isdigit() else len(codes)))]
        out.append((f"r{k}", 16 if reverse else 0, r.randint(0, 5000), 60, cigar, seq, tags(mm, ml, q), mm, ml))
    return out


def plain_calls(records, code):
    """(read, pos, strand, probability, state), letter by letter."""
    out = set()
    for name, flag, pos, _, cigar, seq, _, mm, ml in records:
        ref, at = [], pos
        for n, op in cigar:
            for _ in range(n):
                if op in "MIS=X":
                    ref.append(at if op in "M=X" else None)
                at += op in "M=XDN"
        order = list(range(len(seq)))[::-1] if flag & 16 else list(range(len(seq)))
        used = 0
        for group in mm.split(";")[:-1]:
            head, *gaps = group.split(",")
            state = head[-1] if head[-1] in ".?" else ""
            codes = head[2:].rstrip(".?")
            codes = [codes] if codes.isdigit() else list(codes)
            base = COMPLEMENT[head[0]] if flag & 16 else head[0]
            places = [i for i in order if head[0] == "N" or seq[i] == base]
            listed, k = {}, -1
            for g in gaps:
                k += int(g) + 1
                listed[places[k]] = dict(zip(codes, ml[used : used + len(codes)]))
                used += len(codes)
            if code[:2] != head[:2] or code[2:] not in codes:
                continue
            strand = "+" if bool(flag & 16) == (head[1] == "-") else "-"
            for i in places:
                if ref[i] is not None:
                    p = (listed[i][code[2:]] + 0.5) / 256 if i in listed else None
                    out.add((f"S::{name}", ref[i], strand, p, "explicit_probability" if i in listed else "unknown" if state == "?" else "implicit_below_emission_threshold"))
    return out


def got_calls(done):
    rows = done.observations.collect()
    found = {(r.read_id, r.pos0, r.strand, r.probability, r.observation_state) for r in rows}
    assert len(found) == len(rows) == done.counts["emitted_observations"]
    return found


@pytest.mark.parametrize("code", ["A+a", "C+m", "C+h", "T-17596", "N+n"])
def test_all_states_equal_a_plain_reading(spark, tmp_path, code):
    records = random_records(random.Random(code), 120)
    path = bam_file(tmp_path / "x.bam", [x[:7] for x in records])
    done = import_calls(bam.read(spark, path), "m", "S", Target(code))
    want = plain_calls(records, code)
    assert got_calls(done) == want and {s for *_, s in want} == set(modbam.STATES)
    with_group = sum(any(g[:2] == code[:2] and code[2:] in g[2:].split(",")[0] for g in x[7].split(";") if g) for x in records)
    assert done.counts["retained_records"] == 120 == with_group + done.counts["records_without_target_group"]
    assert done.counts["ml_values_consumed"] == sum(len(x[8]) for x in records)


@pytest.mark.parametrize("size", [257, 1000, 5000, 1 << 16])
def test_ranges_give_the_rows_of_one_task(spark, tmp_path, size):
    records = random_records(random.Random(size), 300)
    path = bam_file(tmp_path / "x.bam", [x[:7] for x in records], text="@HD\tVN:1.6\n" * 40, size=900)
    one = [tuple(r) for r in bam.read(spark, path).collect()]
    assert len(one) == 300 and [r[1] for r in one] == [x[0] for x in records]
    many = bam.read(spark, path, size)
    assert size >= 1 << 16 or many.rdd.getNumPartitions() > 3
    assert sorted(map(repr, map(tuple, many.collect()))) == sorted(map(repr, one))


def test_ranges_within_one_long_record_and_wrong_guesses(spark, tmp_path, monkeypatch):
    # Qualities that look like the heads of records, and a record longer than several ranges.
    fake = struct.pack("<iiiBBHHHiiii", 40, 0, 5, 1, 60, 0, 0, 0, 0, -1, -1, 0) + b"\0" * 8
    r = random.Random(4)
    rows = [("long", 0, 5, 60, [(3000, "M")], "".join(r.choice("ACGT") for _ in range(3000)), b"")] + [x[:7] for x in random_records(r, 40)]
    path = bam_file(tmp_path / "x.bam", rows, size=300, qual=fake[:1])
    body = bam_file(tmp_path / "y.bam", [(*x[:6], b"XXBC" + struct.pack("<I", len(fake) * 9) + fake * 9) for x in rows], size=300)
    monkeypatch.setattr(bam, "CHAIN", 1)
    for p in (path, body):
        want = [tuple(x) for x in bam.read(spark, p).collect()]
        assert sorted(map(repr, map(tuple, bam.read(spark, p, 400).collect()))) == sorted(map(repr, want)) and len(want) == 41


def one(spark, tmp_path, *records, code="A+a", skip=False, rule=modbam.ALL, **kw):
    path = bam_file(tmp_path / f"{random.random()}.bam", records, **kw)
    return import_calls(bam.read(spark, path), "m", "S", Target(code, rule), skip=skip)


def test_motif_rule(spark, tmp_path):
    done = one(spark, tmp_path, ("r", 0, 10, 60, [(9, "M")], "GGACTGAAC", tags("A+a?,0;", [9], 9)), ("back", 16, 10, 60, [(9, "M")], "AGTCCAAAA", tags("A+a?;", [], 9)), rule="rrAcn")
    assert {(r.read_id, r.pos0, r.strand, r.observation_state, r.context) for r in done.observations.collect()} == {("S::r", 12, "+", "explicit_probability", "RRACN"), ("S::back", 12, "-", "unknown", "RRACN")}
    with pytest.raises(ValueError, match="CandidateRuleMismatch"):
        one(spark, tmp_path, ("r", 0, 10, 60, [(9, "M")], "GGACTGAAC", tags("A+a,1;", [9], 9)), rule="RRACN")
    for bad in ("RRA", "RRACNN", "RXACN"):
        with pytest.raises(ValueError, match="candidate rule"):
            Target("A+a", bad)


GOOD = ("ok", 0, 10, 60, [(4, "M")], "AACA", tags("A+a.,0,1;", [9, 250], 4))


@pytest.mark.parametrize(("record", "reason"), [
    (("r", 0, 10, 60, [(4, "M")], "AACA", tags("A+a,0;", [9], 5)), "MnMismatch"), (("r", 0, 10, 60, [(4, "M")], "AACA", tags("A+a,3;", [9], 4)), "InvalidMm"), (("r", 0, 10, 60, [(4, "M")], "AACA", tags("A*a,0;", [9], 4)), "InvalidMm"),
    (("r", 0, 10, 60, [(4, "M")], "AACA", tags("A+a,0;", [9, 9], 4)), "MlLengthMismatch"), (("r", 0, 10, 60, [(4, "M")], "AACA", tags("A+a,0;A+a,1;", [9, 9], 4)), "DuplicateTargetGroup"),
    (("r", 0, 10, 60, [(3, "M")], "AACA", tags("A+a,0;", [9], 4)), "InvalidProjection"), (("r", 0, 999_998, 60, [(4, "M")], "AACA", tags("A+a,0;", [9], 4)), "ReferenceOutOfBounds"), (("r", 0, 10, 60, [(4, "I")], "AACA", tags("A+a,0;", [9], 4)), "InvalidProjection"),
    (("r", 0, 10, 60, [(4, "M")], "AACA", b""), "MissingMm"), (("r", 0, 10, 60, [(4, "M")], "AACA", b"MMZA+a;\0"), "MissingMl"), (("r", 0, 10, 60, [(4, "M")], "AACA", b"MMZ\0MMZ\0"), "DuplicateMm"), (("r", 0, 10, 60, [(4, "M")], "AACA", b"MNZx\0"), "InvalidMn"),
    (("r", 0, 10, 60, [(4, "M")], "AACA", b"MLBc\x01\0\0\0\x01"), "InvalidMlType"), (("T::r", 0, 10, 60, [(4, "M")], "AACA", tags("A+a,0;", [9], 4)), "InvalidReadName"), (("ok", 0, 10, 60, [(4, "M")], "AACA", tags("A+a,0;", [9], 4)), "DuplicatePrimary"),
])
def test_faults_end_or_are_counted(spark, tmp_path, record, reason):
    with pytest.raises(ValueError, match=reason):
        one(spark, tmp_path, GOOD, record)
    done = one(spark, tmp_path, GOOD, record, skip=True)
    assert done.counts[f"invalid_record_{reason}"] == (2 if reason == "DuplicatePrimary" else 1) and not done.semantics["candidate_observations_complete"]
    assert {r.pos0 for r in done.observations.collect()} == (set() if reason == "DuplicatePrimary" else {10, 11, 13})


def test_counts_of_places_off_the_reference(spark, tmp_path):
    rows = [("r", 0, 10, 60, [(1, "S"), (1, "M"), (1, "I"), (2, "D"), (1, "M"), (1, "S")], "AAAAA", tags("A+a,0,1;", [9, 250], 5)), ("u", 4, -1, 0, [], "A", b""), ("s", 256, 1, 60, [(1, "M")], "A", b""), ("p", 2048, 1, 60, [(1, "M")], "A", b"")]
    c = one(spark, tmp_path, *rows).counts
    assert (c["total_records"], c["skipped_unmapped"], c["skipped_secondary"], c["skipped_supplementary"], c["retained_records"]) == (4, 1, 1, 1, 1)
    assert (c["target_calls_in_soft_clips"], c["target_calls_in_insertions"], c["implicit_calls_in_soft_clips"], c["implicit_calls_in_insertions"], c["emitted_implicit_observations"]) == (1, 1, 1, 0, 2)


def test_provenance():
    text = "@HD\tVN:1.6\n@PG\tID:basecaller\tPN:dorado\tVN:0.9\tCL:dorado basecaller x --modified-bases-models /m/v1_m6A,/m/v1_5mC --modified-bases-threshold=0.05\n@PG\tID:samtools\tVN:1.2\tCL:samtools sort\n"
    found = modbam.programs(text)
    assert [(p["version"], p["models"], p["thresholds"]) for p in found] == [("0.9", ["/m/v1_5mC", "/m/v1_m6A"], [0.05])]
    assert modbam.provenance(found, "v1_m6A") == {"caller_version": "0.9", "source_emission_threshold": 0.05, "provenance_status": "verified_from_pg"}
    assert modbam.provenance([], "v1", "1.0", 0.1)["provenance_status"] == "user_declared" and modbam.provenance([], "v1")["provenance_status"] == "unavailable"
    for kw in ({"model": "v2"}, {"model": "v1_m6A", "version": "1.0"}, {"model": "v1_m6A", "threshold": 0.1}):
        with pytest.raises(ValueError):
            modbam.provenance(found, **kw)


def test_command_writes_what_the_aggregate_reads(spark, tmp_path):
    records = random_records(random.Random(9), 60)
    text = "@PG\tID:dorado\tVN:0.9\tCL:dorado basecaller --modified-bases-models m6a --modified-bases-threshold 0.05\n"
    path = bam_file(tmp_path / "x.bam", [x[:7] for x in records], text)
    main(["mod-import-dorado", "--reads", path, "--out", f"{tmp_path}/s", "--sample", "S", "--assay", "m", "--model", "m6a", "--chemistry", "rna004"])
    obs = spark.read.csv(f"{tmp_path}/s.observations", sep="\t", header=True, schema=tables.OBSERVATION, enforceSchema=False, nullValue="NA", quote="", mode="FAILFAST")
    assert {(r.read_id, r.pos0, r.strand, r.probability, r.observation_state) for r in tables.observations(obs).collect()} == plain_calls(records, "A+a")
    assay = tables.assay_metadata(spark.read.text(f"{tmp_path}/s.assay", wholetext=True)).first()
    assert (assay.caller_version, assay.source_emission_threshold, assay.provenance_status, assay.candidate_rule) == ("0.9", 0.05, "verified_from_pg", modbam.ALL)
    qc = dict(r.value.split("\t") for r in spark.read.text(f"{tmp_path}/s.import_qc").collect())
    assert qc["retained_records"] == "60" and qc["dorado_pg_model_ids"] == "m6a"
    manifest = f"sample\tassay_id\tobservations\tassay_metadata\tcoverage_bam\nS\tm\t{tmp_path}/s.observations\t{tmp_path}/s.assay\tNA\n"
    (tmp_path / "m.tsv").write_text(manifest)
    calls, inputs, _ = manifests.read_modifications(spark, manifests.modification_manifest(spark, str(tmp_path / "m.tsv")), {"m": 0.5}, {})
    assert calls.count() == obs.count() and json.loads(modbam.assay_json(assay.asDict()))["assay_id"] == "m" and inputs.first().implicit_skip_policy in ("unknown", "low_probability")


def test_rows_go_out_by_their_calls(spark, monkeypatch):
    """Calls of a batch are bounded: before, one frame held those of all its records."""
    import pyarrow as pa

    from strandloom.sources import modbam

    seen = {}

    class Rows:
        def select(self, *cols):
            return self

        def mapInArrow(self, run, schema):
            seen["run"] = run
            return self

    n, k = 40, 50
    monkeypatch.setattr(modbam, "CALLS", 500)
    monkeypatch.setattr(modbam, "RECORDS", 7)
    modbam.reads(Rows(), "S", Target("A+a"))
    row = {"path": "x", "flag": 0, "mapq": 60, "chrom": "c", "chrom_length": 1000, "start": 5, "cigar": f"{k}M", "seq": "A" * k, "mm": "A+a,0;", "ml": b"\x07", "mn": k, "tag_fault": None}
    batch = pa.RecordBatch.from_pylist([row | {"name": f"r{i}"} for i in range(n)], schema=pa.schema([*[(c, pa.string()) for c in ("path", "name", "chrom", "cigar", "seq", "mm", "tag_fault")], ("ml", pa.binary()), *[(c, pa.int64()) for c in ("flag", "mapq", "chrom_length", "start", "mn")]]))
    out = list(seen["run"](iter([batch])))
    assert [b.num_rows for b in out] == [10, 10, 10, 10]
    rows = [r for b in out for r in b.to_pylist()]
    assert [r["name"] for r in rows] == [f"r{i}" for i in range(n)]
    want = [{"pos0": 5, "state": 0, "ml": 7}] + [{"pos0": 5 + i, "state": 1, "ml": 0} for i in range(1, k)]
    assert all(r["calls"] == want and r["reason"] is None for r in rows)
