"""Modification calls of aligned BAM files: every candidate base of a read with what the caller says about it.

Each read's MM groups are turned into arrays in its task: the candidate places are a set, the listed ones get
their probability from ML, and the rest is implicit or unknown as the group's skip flag says.  Places meet the
reference by a binary search among the starts of CIGAR runs.  What follows (duplicate names, counts, tables) are
DataFrame operations on one row a read.
"""

from __future__ import annotations

import json
import math
import re
import shlex
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sequence import BASES
from ..operators.clustering import cut
from . import bam
from .tables import ASSAY, EXPLICIT, IMPLICIT, OBSERVATION, UNKNOWN

ALL = "all-target-canonical-bases"
GROUP = re.compile(r"([ACGTUN])([+-])([a-z]+|[0-9]+)([.?]?)((?:,[0-9]+)*)")
OTHER = dict(zip("ACGTUN", "TGCAAN"))
TURN = str.maketrans("ACGTURYSWKMBDHV", "TGCAAYRSWMKVHDB")
STATES = (EXPLICIT, IMPLICIT, UNKNOWN)
# Fixed names of the counts, in the order of the audit table.
COUNTS = (
    "target_canonical_bases", "target_candidate_bases", "records_without_target_group", "target_groups_skip_flag_omitted", "target_groups_low_probability", "target_groups_unknown",
    "implicit_low_probability_candidates", "unknown_candidates", "ml_values_consumed", "explicit_target_calls", "target_calls_in_insertions", "target_calls_in_soft_clips",
    "implicit_calls_in_insertions", "implicit_calls_in_soft_clips",
)


class Fault(ValueError):
    """Why a record cannot be used; the first argument is the fixed name of the reason."""


@dataclass(frozen=True)
class Target:
    """One modification of one canonical base (``A+a``, ``A+17596``) and the places where it could be."""

    code: str
    rule: str = ALL
    below_threshold: bool = False  # omitted candidates of a ``?`` group are known to be below the emission threshold

    def __post_init__(self) -> None:
        if not re.fullmatch(r"[ACGTUN][+-]([a-z]|[0-9]+)", self.code):
            raise ValueError(f"not a single modification code: {self.code!r}")
        rule = self.rule.upper().replace("U", "T")
        if self.rule.lower() == ALL:
            object.__setattr__(self, "rule", ALL)
        elif not 3 <= len(rule) <= 31 or len(rule) % 2 == 0 or set(rule) - set(BASES):
            raise ValueError(f"candidate rule {self.rule!r} is neither {ALL} nor an odd motif of 3 to 31 bases")
        elif rule[len(rule) // 2] != self.code[0].replace("U", "T"):
            raise ValueError(f"candidate rule {self.rule!r} has another base than {self.code[0]} in its middle")
        else:
            object.__setattr__(self, "rule", rule)

    def candidates(self, seq: str, reverse: bool) -> np.ndarray:
        """Places in the stored sequence, ascending."""
        if self.rule == ALL:
            return _places(seq, self.code[0], reverse)
        read = (seq.translate(TURN)[::-1] if reverse else seq).replace("U", "T")
        pattern = "(?=" + "".join(f"[{BASES[c]}]" for c in self.rule) + ")"
        at = np.array([m.start() for m in re.finditer(pattern, read)], np.int64) + len(self.rule) // 2
        return np.sort(len(seq) - 1 - at) if reverse else at


def _places(seq: str, base: str, reverse: bool) -> np.ndarray:
    """Where a canonical base of the read stands in the stored sequence, ascending; N is any base."""
    if base == "N":
        return np.arange(len(seq))
    return np.flatnonzero(np.frombuffer(seq.encode(), np.uint8) == ord(OTHER[base] if reverse else base))


def calls(seq: str, mm: str, ml: bytes, mn: int, reverse: bool, target: Target) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[str, int]]:
    """(places in the stored sequence, states, ML bytes, counts) of the target's candidates in one read."""
    if mn != len(seq):
        raise Fault("MnMismatch")
    groups = []
    for text in (g for g in mm.split(";") if g):
        m = GROUP.fullmatch(text)
        if not m:
            raise Fault("InvalidMm")
        base, strand, codes, flag, gaps = m.groups()
        places = _places(seq, base, reverse)
        nth = np.cumsum([int(x) + 1 for x in gaps.split(",")[1:]] or [0]) - 1 if gaps else np.array([], np.int64)
        if len(nth) and nth[-1] >= len(places):
            raise Fault("InvalidMm")
        # Gaps count along the read, so from the end of a reversed sequence.
        listed = (places[::-1] if reverse else places)[nth]
        groups.append((base, strand, [codes] if codes.isdigit() else list(codes), flag, listed))
    if len(ml) != sum(len(g[4]) * len(g[2]) for g in groups):
        raise Fault("MlLengthMismatch")
    candidates = target.candidates(seq, reverse)
    n = dict.fromkeys(COUNTS, 0)
    n |= {"target_canonical_bases": len(_places(seq, target.code[0], reverse)), "target_candidate_bases": len(candidates), "ml_values_consumed": len(ml)}
    at, found = 0, None
    for base, strand, codes, flag, listed in groups:
        size = len(listed) * len(codes)
        if target.code[:2] == base + strand and target.code[2:] in codes:
            if found:
                raise Fault("DuplicateTargetGroup")
            if not np.isin(listed, candidates).all():
                raise Fault("CandidateRuleMismatch")
            if codes.count(target.code[2:]) > 1 and len(listed):
                raise Fault("DuplicateTargetObservation")
            # ML goes by group, then by place, then by code.
            values = np.frombuffer(ml[at : at + size], np.uint8).reshape(-1, len(codes))[:, codes.index(target.code[2:])]
            found = flag, listed, values
        at += size
    if not found:
        n["records_without_target_group"] = 1
        return np.array([], np.int64), np.array([], np.int64), np.array([], np.uint8), n
    flag, listed, values = found
    rest = np.setdiff1d(candidates, listed)
    unknown = flag == "?" and not target.below_threshold
    n[{"": "target_groups_skip_flag_omitted", ".": "target_groups_low_probability", "?": "target_groups_unknown"}[flag]] = 1
    n["unknown_candidates" if unknown else "implicit_low_probability_candidates"] = len(rest)
    n["explicit_target_calls"] = len(listed)
    places = np.concatenate([listed, rest])
    states = np.repeat([0, 2 if unknown else 1], [len(listed), len(rest)])
    return places, states, np.concatenate([values, np.zeros(len(rest), np.uint8)]), n


def project(start: int, cigar: str, size: int, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(reference places, operations, end of the alignment): each place looked up among the runs of the CIGAR."""
    steps = re.findall(r"([0-9]+)([MIDNSHP=X])", cigar)
    length, op = np.array([int(x) for x, _ in steps], np.int64), np.array([x for _, x in steps], "U1")
    if (length == 0).any():
        raise Fault("InvalidProjection")
    query, ref = np.isin(op, list("M=XIS")), np.isin(op, list("M=XDN"))
    q_end, r_end = np.cumsum(length * query), np.cumsum(length * ref)
    if (q_end[-1] if len(steps) else 0) != size or not (query & ref).any():
        raise Fault("InvalidProjection")
    run = np.flatnonzero(query)[np.searchsorted(q_end[query], places, side="right")]
    r_start, q_start = start + (r_end - length * ref)[run], (q_end - length)[run]
    return r_start + places - q_start, np.where(ref[run], "M", op[run]), start + int(r_end[-1])


READ = "path string, name string, kind string, reason string, chrom string, reverse boolean, " + ", ".join(f"{c} long" for c in COUNTS) + ", calls array<struct<pos0:long,state:int,ml:int>>"


# A batch of rows is parsed so many records at a time, and rows go out once they hold so many calls.
RECORDS, CALLS = 256, 1 << 18


def _read(r, sample: str, target: Target) -> tuple[dict[str, int], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    if r.chrom is None or not r.chrom.strip() or r.chrom == "*":
        raise Fault("InvalidReference")
    if r.start < 0:
        raise Fault("InvalidAlignmentStart")
    if r.tag_fault is not None:
        raise Fault(r.tag_fault)
    for tag, value in (("Mm", r.mm), ("Ml", r.ml), ("Mn", None if pd.isna(r.mn) else r.mn)):
        if value is None:
            raise Fault(f"Missing{tag}")
    reverse = bool(r.flag & 0x10)
    places, states, values, n = calls(r.seq, r.mm, bytes(r.ml), int(r.mn), reverse, target)
    pos, op, end = project(int(r.start), r.cigar, len(r.seq), places)
    if end > r.chrom_length:
        raise Fault("ReferenceOutOfBounds")
    if "::" in r.name and (r.name.split("::", 1)[0] != sample or not r.name.split("::", 1)[1]):
        raise Fault("InvalidReadName")
    explicit = states == 0
    for what, of in (("target", explicit), ("implicit", ~explicit)):
        n[f"{what}_calls_in_insertions"], n[f"{what}_calls_in_soft_clips"] = int((of & (op == "I")).sum()), int((of & (op == "S")).sum())
    on = op == "M"
    return n, (pos[on], states[on].astype(np.int32), values[on].astype(np.int32))


NONE = (np.array([], np.int64), np.array([], np.int32), np.array([], np.int32))


def _packed(rows: list[tuple], found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Rows of ``READ``; calls stay numbers of 16 bytes and never become Python objects."""
    names = [c.split()[0] for c in READ.split(", ")][:-1]
    columns = [pa.array(c, pa.int64() if k in COUNTS else pa.bool_() if k == "reverse" else pa.string()) for k, c in zip(names, zip(*rows))]
    pos, state, ml = (np.concatenate(x) for x in zip(*found))
    each = pa.StructArray.from_arrays([pa.array(pos, pa.int64()), pa.array(state, pa.int32()), pa.array(ml, pa.int32())], names=["pos0", "state", "ml"])
    ends = np.cumsum([0, *[len(f[0]) for f in found]])
    return pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), each)], names=[*names, "calls"])


def reads(rows: DataFrame, sample: str, target: Target, least_mapq: int = 0) -> DataFrame:
    """One row of ``READ`` for each record of :func:`bam.read`; ``reason`` says why a primary one cannot be used.

    What a task holds is bounded by ``RECORDS`` and ``CALLS``, beside the batch that Spark hands it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, found, held = [], [], 0
            for low in range(0, batch.num_rows, RECORDS):
                for r in batch.slice(low, RECORDS).to_pandas().itertuples():
                    row, of = parsed(r)
                    out.append(row)
                    found.append(of)
                    held += len(of[0])
                    if held >= CALLS:
                        yield _packed(out, found)
                        out, found, held = [], [], 0
            if out:
                yield _packed(out, found)

    def parsed(r) -> tuple[tuple, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        kind = next((k for bit, k in ((0x4, "unmapped"), (0x100, "secondary"), (0x800, "supplementary")) if r.flag & bit), "primary")
        reason, n, found = None, dict.fromkeys(COUNTS, 0), NONE
        if kind == "primary":
            if not r.name.strip() or r.name == "*":
                kind, reason = "unnamed", "MissingReadName"
            elif any(ord(c) < 32 or 127 <= ord(c) < 160 for c in r.name):
                kind, reason = "unnamed", "InvalidReadName"
            elif (0 if r.mapq == 255 else r.mapq) < least_mapq:
                kind = "below_mapq"
            else:
                try:
                    n, found = _read(r, sample, target)
                except Fault as f:
                    reason, n, found = f.args[0], dict.fromkeys(COUNTS, 0), NONE
        return (r.path, r.name, kind, reason, r.chrom, bool(r.flag & 0x10), *n.values()), found

    cols = ["path", "name", "flag", "mapq", "chrom", "chrom_length", "start", "cigar", "seq", "mm", "ml", "mn", "tag_fault"]
    return rows.select(*cols).mapInArrow(run, READ)


@dataclass(frozen=True)
class Imported:
    observations: DataFrame
    counts: dict[str, int]
    semantics: dict[str, object]


def import_calls(rows: DataFrame, assay: str, sample: str, target: Target, least_mapq: int = 0, skip: bool = False) -> Imported:
    """Observations of all candidates of the records of one sample, with counts and what they mean.

    Unmapped, secondary and supplementary records are left out.  A record that cannot be used, or a second primary
    one of a name, ends the job; with ``skip`` it is left out and counted by reason, as are all records of such a name.
    """
    parsed = cut(reads(rows, sample, target, least_mapq))
    named = F.col("kind").isin("primary", "below_mapq")
    again = parsed.where(named).groupBy("name").agg(F.count("*").alias("times")).where("times > 1")
    told = parsed.join(again, "name", "left").withColumn("double", named & F.col("times").isNotNull())
    told = told.withColumn("reason", F.when(F.col("double"), "DuplicatePrimary").otherwise(F.col("reason")))
    used = told.where("kind = 'primary' AND reason IS NULL")
    if not skip and (first := told.where("reason IS NOT NULL").select("name", "reason").head()):
        raise ValueError(f"{first.name}: {first.reason}")
    whole = {r["what"]: r["n"] for r in told.groupBy(F.when(F.col("double"), "double").when(F.col("reason").isNotNull(), "invalid").otherwise(F.col("kind")).alias("what")).agg(F.count("*").alias("n")).collect()}
    reasons = {r.reason: r.n for r in told.where("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n")).collect()}
    state = lambda k: F.sum(F.size(F.filter("calls", lambda c: c["state"] == k)))
    sums = used.agg(F.count("*").alias("retained_records"), *[F.sum(c).alias(c) for c in COUNTS], *[state(k).alias(f"emitted_{n}_observations") for k, n in enumerate(("explicit", "implicit", "unknown"))]).first().asDict()
    sums = {k: v or 0 for k, v in sums.items()}
    counts = {"total_records": sum(whole.values())} | {f"skipped_{k}": whole.get(k, 0) for k in ("unmapped", "secondary", "supplementary", "below_mapq")}
    counts |= {"duplicate_primary_reads": again.count(), "skipped_duplicate_primary_records": whole.get("double", 0), **sums}
    counts["emitted_observations"] = sum(counts[f"emitted_{n}_observations"] for n in ("explicit", "implicit", "unknown"))
    counts |= {f"invalid_record_{k}": v for k, v in sorted(reasons.items())}
    policy = "unknown" if sums["unknown_candidates"] else "low_probability" if sums["implicit_low_probability_candidates"] or target.below_threshold else "not_applicable"
    complete = sums["retained_records"] > 0 and not sums["records_without_target_group"] and not reasons
    text = lambda v: F.lit(v).cast("string")
    tagged = F.when(F.col("name").contains("::"), F.col("name")).otherwise(F.concat(F.lit(f"{sample}::"), "name"))
    forward = F.col("reverse") == F.lit(target.code[1] == "-")
    state = F.element_at(F.array(*[F.lit(x) for x in STATES]), F.col("c.state") + 1)
    observations = used.select("name", "chrom", "reverse", F.explode("calls").alias("c")).select(
        text(assay).alias("assay_id"), text(sample).alias("sample"), tagged.alias("read_id"), "chrom", F.col("c.pos0").alias("pos0"), F.when(forward, "+").otherwise("-").alias("strand"),
        text(target.code).alias("mod_code"), F.when(F.col("c.state") == 0, (F.col("c.ml") + 0.5) / 256).alias("probability"), state.alias("observation_state"),
        text(None if target.rule == ALL else target.rule).alias("context"), text(None).alias("source_transcript_id"), F.lit(None).cast("long").alias("source_pos0"),
    )
    return Imported(observations, counts, {"implicit_skip_policy": policy, "candidate_observations_complete": complete})


def programs(text: str) -> list[dict]:
    """Caller records (@PG) of a header: version, models, thresholds and command of each program named dorado."""
    dorado, out = re.compile(r"dorado(?![a-z0-9])", re.I), []
    base = lambda v: re.split(r"[/\\]", v or "")[-1]
    for line in text.splitlines():
        if not line.startswith("@PG\t"):
            continue
        f = dict(x.split(":", 1) for x in line.split("\t")[1:] if ":" in x)
        try:
            words = shlex.split(f.get("CL", ""))
        except ValueError:
            words = f.get("CL", "").split()
        if not any(dorado.match(base(v)) for v in (f.get("ID"), f.get("PN"), words[0] if words else "")):
            continue
        given = [(w.split("=", 1) if "=" in w else (w, words[k + 1] if k + 1 < len(words) else "")) for k, w in enumerate(words) if w.startswith("--")]
        models = {m for name, v in given if name in ("--modified-bases-models", "--modified-bases-model") for m in v.split(",") if m}
        limits = set()
        for name, v in given:
            try:
                if name == "--modified-bases-threshold" and math.isfinite(float(v)) and 0 <= float(v) <= 1:
                    limits.add(float(v))
            except ValueError:
                continue
        out.append({"version": f.get("VN"), "models": sorted(models), "thresholds": sorted(limits), "command": f.get("CL")})
    return out


def provenance(found: list[dict], model: str, version: str = "unknown", threshold: float | None = None) -> dict:
    """caller_version, source_emission_threshold and provenance_status from what headers say and what the user says.

    Records of the named model count before others, and complete ones before those; a contradiction is an error.
    """
    base = lambda v: v.rsplit("/", 1)[-1]
    named = [r for r in found if r["models"]]
    fitting = [r for r in named if any(m == model or base(m) == base(model) for m in r["models"])]
    if named and not fitting:
        raise ValueError(f"model {model!r} is none of the header's: {sorted({m for r in named for m in r['models']})}")
    whole = [r for r in fitting if r["version"] is not None and len(r["thresholds"]) == 1]
    used = whole or (fitting if named else found)
    versions, limits = {r["version"] for r in used} - {None}, {t for r in used for t in r["thresholds"]}
    if len(versions) > 1 or len(limits) > 1:
        raise ValueError(f"the headers disagree: versions {sorted(versions)}, thresholds {sorted(limits)}")
    told_version, told_limit = next(iter(versions), None), next(iter(limits), None)
    if told_version is not None and version not in ("unknown", told_version):
        raise ValueError(f"caller version {version!r} contradicts the header's {told_version!r}")
    if told_limit is not None and threshold not in (None, told_limit):
        raise ValueError(f"emission threshold {threshold} contradicts the header's {told_limit}")
    caller, limit = told_version if told_version is not None else version, told_limit if told_limit is not None else threshold
    declared = (version != "unknown" or threshold is not None) and caller != "unknown" and limit is not None
    return {"caller_version": caller, "source_emission_threshold": limit, "provenance_status": "verified_from_pg" if whole else "user_declared" if declared else "unavailable"}


def assay_json(values: dict) -> str:
    """The text of assay metadata: the fixed fields in order, then a line end."""
    return json.dumps({f.split()[0]: values[f.split()[0]] for f in ASSAY.split(", ")}, indent=2, ensure_ascii=False) + "\n"


def run(
    spark: SparkSession, path: str, assay: str, sample: str, target: Target, model: str, chemistry: str, version: str = "unknown", threshold: float | None = None, least_mapq: int = 0, skip: bool = False,
) -> tuple[DataFrame, str, dict[str, object]]:
    """(observations, assay metadata as JSON, audit) of the BAM files at ``path``."""
    found = [p for r in bam.headers(spark, path).collect() for p in programs(r.text)]  # a row a file
    origin = provenance(found, model, version, threshold)
    if target.below_threshold and not origin["source_emission_threshold"]:
        raise ValueError("candidates below a threshold need one above 0")
    done = import_calls(bam.read(spark, path), assay, sample, target, least_mapq, skip)
    policy = "below_emission_threshold" if target.below_threshold else "unknown"
    several = lambda k: "|".join(str(v) for v in sorted({v for p in found for v in (p[k] if isinstance(p[k], list) else [p[k]]) if v is not None})) or "NA"
    metadata = {
        "schema_version": 1, "assay_id": assay, "caller": "dorado", "model_id": model, "chemistry": chemistry, "candidate_rule": target.rule, **origin, **done.semantics,
        "source_site_filter": f"primary_genome_aligned_projectable_query_bases;min_mapq={least_mapq};target={target.code};mm_question_mark_policy={policy}",
        "coordinate_source": "genome_aligned_bam_cigar_sam_ml_interval_midpoint_v1", "read_id_mapping": "sample_prefixed_bam_query_name", "source_files": [path],
    }
    audit = done.counts | {
        "candidate_observations_complete": str(done.semantics["candidate_observations_complete"]).lower(), "implicit_skip_policy": done.semantics["implicit_skip_policy"],
        "source_emission_threshold": "NA" if origin["source_emission_threshold"] is None else origin["source_emission_threshold"], "mm_question_mark_policy": policy,
        "ml_probability_semantics": "sam_ml_interval_midpoint_v1", "provenance_status": origin["provenance_status"], "dorado_pg_records": len(found), "dorado_pg_caller_versions": several("version"),
        "dorado_pg_model_ids": several("models"), "dorado_pg_source_emission_thresholds": several("thresholds"), "dorado_pg_command_lines": several("command"),
    }
    return done.observations, assay_json(metadata), audit
