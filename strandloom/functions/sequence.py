"""Column functions over CIGAR strings, bases, motifs and ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import geometry as G

# Fixed table: the bases that each letter of the nucleotide code stands for.
BASES = {"A": "A", "C": "C", "G": "G", "T": "T", "R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC", "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT"}
COMPLEMENT = ("ACGTRYSWKMBDHVN", "TGCAYRSWMKVHDBN")


def cigar_steps(cigar: Column) -> Column:
    """array<struct<n, op>> of a CIGAR string."""
    tokens = F.regexp_extract_all(cigar, F.lit(r"[0-9]+[MIDNSHP=X]"), 0)
    return F.transform(tokens, lambda t: F.struct(F.substring(t, 1, F.length(t) - 1).cast("long").alias("n"), F.right(t, F.lit(1)).alias("op")))


def cigar_exons(start: Column, cigar: Column) -> Column:
    """Exons of an alignment: only N parts them, deletions stay inside, insertions and clips take no reference."""
    empty = F.struct(start.cast("long").alias("at"), start.cast("long").alias("open"), G.none().alias("out"))

    def step(acc: Column, x: Column) -> Column:
        skip, on = x["op"] == "N", x["op"].isin("M", "D", "=", "X", "N")
        end = acc["at"] + F.when(on, x["n"]).otherwise(0)
        out = F.when(skip & (acc["at"] > acc["open"]), F.concat(acc["out"], F.array(G.interval(acc["open"], acc["at"])))).otherwise(acc["out"])
        return F.struct(end.alias("at"), F.when(skip, end).otherwise(acc["open"]).alias("open"), out.alias("out"))

    close = lambda acc: F.when(acc["at"] > acc["open"], F.concat(acc["out"], F.array(G.interval(acc["open"], acc["at"])))).otherwise(acc["out"])
    return F.aggregate(cigar_steps(cigar), empty, step, close)


def cigar_blocks(start: Column, cigar: Column) -> Column:
    """Covered blocks: M, = and X only, neighbours joined."""
    empty = F.struct(start.cast("long").alias("at"), G.none().alias("out"))

    def step(acc: Column, x: Column) -> Column:
        on, used = x["op"].isin("M", "=", "X"), x["op"].isin("M", "D", "=", "X", "N")
        end = acc["at"] + F.when(used, x["n"]).otherwise(0)
        last = F.element_at(acc["out"], -1)
        touches = (F.size(acc["out"]) > 0) & (F.get(acc["out"], F.size(acc["out"]) - 1)["end"] == acc["at"])
        joined = F.concat(F.slice(acc["out"], 1, F.greatest(F.size(acc["out"]) - 1, F.lit(0))), F.array(G.interval(last["start"], end)))
        return F.struct(end.alias("at"), F.when(~on, acc["out"]).when(touches, joined).otherwise(F.concat(acc["out"], F.array(G.interval(acc["at"], end)))).alias("out"))

    return F.aggregate(cigar_steps(cigar), empty, step, lambda acc: acc["out"])


def primary(flag: Column, mapq: Column, least: int = 30) -> Column:
    """Mapped, neither secondary nor supplementary, and of enough quality."""
    return (flag.bitwiseAND(F.lit(0x4 | 0x100 | 0x800)) == 0) & (mapq >= least)


def oriented(base: Column, strand: Column) -> Column:
    return F.when(strand == "-", F.translate(F.upper(base), *COMPLEMENT)).otherwise(F.upper(base))


def motif_pattern(motif: str) -> str:
    """A nucleotide-code motif as a regular expression that finds overlapping hits."""
    word = motif.upper().replace("U", "T")
    if not word or any(c not in BASES for c in word):
        raise ValueError(f"not a motif: {motif!r}")
    return "(?=" + "".join(f"[{BASES[c]}]" for c in word) + ")"


def context_flank(context: Column) -> Column:
    """Bases beside a site that its context needs: 2 for DRACH, half of another odd motif word, else 0."""
    letters = "".join(BASES)
    word = F.upper(context).rlike(f"^[{letters}U]+$") & (F.length(context) % 2 == 1) & (F.length(context) > 1)
    return F.when(F.upper(context) == "DRACH", 2).when(word, F.floor(F.length(context) / 2).cast("int")).otherwise(0)


def site_state(exons: Column, pos: Column, flank: Column, same_place: Column, site_strand: Column) -> Column:
    """Whether an isoform can show a site: unprojectable, structurally_absent, context_dependent or present."""
    inside = lambda e: (e["start"] <= pos) & (pos < e["end"])
    room = F.exists(exons, lambda e: (e["start"] <= pos - flank) & (pos + flank < e["end"]))
    return F.when(site_strand == ".", "unprojectable").when(~same_place | ~F.exists(exons, inside), "structurally_absent").when(~room, "context_dependent").otherwise("present")


def base_fits_code(base: Column, code: Column) -> Column:
    """Whether a reference base is the canonical base of a modification code such as A+a; N fits all."""
    want = F.translate(F.upper(F.substring(code, 1, 1)), "U", "T")
    return (want == "N") | (F.translate(F.upper(base), "U", "T") == want)


def unversioned(transcript: Column) -> Column:
    return F.regexp_replace(transcript, r"(?<=.)\.[0-9]+$", "")


def percent_encoded(text: Column) -> Column:
    """Percent code that leaves letters, digits and ``-._~:`` as they are."""
    plain = F.regexp_replace(F.regexp_replace(F.url_encode(text), r"\+", "%20"), r"\*", "%2A")
    return F.regexp_replace(F.regexp_replace(plain, "%7E", "~"), "%3A", ":")


def shortest_number(x: Column) -> Column:
    """Text of a double, whole numbers without a fraction."""
    return F.when(x == F.floor(x), F.floor(x).cast("string")).otherwise(x.cast("string"))


def or_na(x: Column) -> Column:
    return F.coalesce(x.cast("string"), F.lit("NA"))
