"""Column functions over exon arrays: lengths, introns, ends, projections, overlaps. No user functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import INTERVALS


def zero() -> Column:
    return F.lit(0).cast("long")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def none() -> Column:
    """An empty array of intervals."""
    return F.array().cast(INTERVALS)


def interval(start: Column, end: Column) -> Column:
    return F.struct(start.cast("long").alias("start"), end.cast("long").alias("end"))


def overlap(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Shared bases of two half-open spans; touching ones share none."""
    return F.greatest(zero(), F.least(e1, e2) - F.greatest(s1, s2))


def total(intervals: Column | str) -> Column:
    return F.aggregate(_col(intervals), zero(), lambda acc, x: acc + x["end"] - x["start"])


def introns(exons: Column | str) -> Column:
    """Gaps between neighbouring exons; abutting exons have none."""
    x = _col(exons)
    gaps = F.transform(F.sequence(F.lit(1), F.size(x) - 1), lambda i: interval(F.get(x, i - 1)["end"], F.get(x, i)["start"]))
    return F.when(F.size(x) > 1, F.filter(gaps, lambda g: g["start"] < g["end"])).otherwise(none())


def junction_positions(exons: Column | str, strand: Column | str) -> Column:
    """All inner exon borders in transcript order: reversed on the minus strand."""
    x = _col(exons)
    flat = F.flatten(F.transform(x, lambda e: F.array(e["start"], e["end"])))
    inner = F.slice(flat, 2, 2 * F.size(x) - 2)
    return F.when(F.size(x) < 2, F.array().cast("array<long>")).when(_col(strand) == "-", F.reverse(inner)).otherwise(inner)


def five_prime(strand: Column | str, start: Column | str, end: Column | str) -> Column:
    return F.when(_col(strand) == "+", _col(start)).when(_col(strand) == "-", _col(end))


def three_prime(strand: Column | str, start: Column | str, end: Column | str) -> Column:
    return F.when(_col(strand) == "+", _col(end)).when(_col(strand) == "-", _col(start))


def length_within(exons: Column | str, start: Column, end: Column) -> Column:
    return F.aggregate(_col(exons), zero(), lambda acc, x: acc + overlap(x["start"], x["end"], start, end))


def count_within(exons: Column | str, start: Column, end: Column) -> Column:
    return F.size(F.filter(_col(exons), lambda x: overlap(x["start"], x["end"], start, end) > 0))


def exonic_overlap(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(_col(a), zero(), lambda acc, x: acc + length_within(b, x["start"], x["end"]))


def genomic_to_spliced(position: Column, exons: Column | str, strand: Column | str) -> Column:
    """Offset in the spliced transcript from its 5' end; NULL outside exons or without a strand."""
    x = _col(exons)
    inside = F.exists(x, lambda e: (e["start"] <= position) & (position < e["end"]))
    before = F.aggregate(x, zero(), lambda acc, e: acc + F.greatest(zero(), F.least(e["end"], position) - e["start"]))
    plus, minus = F.when(inside, before), F.when(inside, total(x) - before - 1)
    return F.when(_col(strand) == "+", plus).when(_col(strand) == "-", minus)


def spliced_to_genomic(offset: Column, exons: Column | str, strand: Column | str) -> Column:
    """The genomic position of a spliced offset; NULL beyond the transcript or without a strand."""
    x = _col(exons)
    from_left = F.when(_col(strand) == "+", offset).when(_col(strand) == "-", total(x) - 1 - offset)
    start = F.struct(zero().alias("done"), F.lit(None).cast("long").alias("at"))

    def step(acc: Column, e: Column) -> Column:
        hit = (from_left >= acc["done"]) & (from_left < acc["done"] + e["end"] - e["start"])
        return F.struct((acc["done"] + e["end"] - e["start"]).alias("done"), F.when(hit, e["start"] + from_left - acc["done"]).otherwise(acc["at"]).alias("at"))

    return F.when(offset >= 0, F.aggregate(x, start, step, lambda acc: acc["at"]))


def rebuild_exons(start: Column, end: Column, junctions: Column) -> Column:
    """Exons from a span and its (corrected) inner borders; NULL where they cannot be exons."""
    j = F.array_sort(junctions)
    n = F.size(j)
    rising = F.forall(F.sequence(F.lit(1), n - 1), lambda i: F.get(j, i - 1) < F.get(j, i))
    inside = F.forall(j, lambda p: (p > start) & (p < end))
    bounds = F.concat(F.array(start), j, F.array(end))
    exons = F.transform(F.sequence(F.lit(0), (n / 2).cast("int")), lambda i: interval(F.get(bounds, 2 * i), F.get(bounds, 2 * i + 1)))
    return F.when((start < end) & (n > 0) & (n % 2 == 0) & inside & rising, exons)


NOVEL = "tc_novel_v1:"  # fixed beginning of ids that are made, not given


def structural_id(gene: Column, chrom: Column, strand: Column, exons: Column) -> Column:
    """An id that tells structures apart: hex gene, hex chromosome, strand letter, exons."""
    letter = F.when(strand == "+", "p").when(strand == "-", "m").otherwise("u")
    parts = F.array_join(F.transform(exons, lambda e: F.concat_ws("-", e["start"].cast("string"), e["end"].cast("string"))), ";")
    return F.concat(F.lit(NOVEL), F.concat_ws(":", F.lower(F.hex(F.encode(gene, "utf-8"))), F.lower(F.hex(F.encode(chrom, "utf-8"))), letter, parts))


def gene_tokens(field: Column | str) -> Column:
    """The ids in a ``||`` list; empty, NULL and ``none`` are no gene."""
    parts = F.transform(F.split(F.coalesce(_col(field), F.lit("")), r"\|\|"), lambda g: F.trim(g))
    return F.filter(parts, lambda g: (g != "") & (g != "none"))


def genes_compatible(a: Column | str, b: Column | str) -> Column:
    """True unless both sides name genes and share none."""
    x, y = gene_tokens(a), gene_tokens(b)
    return (F.size(x) == 0) | (F.size(y) == 0) | F.arrays_overlap(x, y)


def overlap_distance(exon: Column, exon_a: Column, exon_b: Column, intron: Column, intron_a: Column, intron_b: Column, weight: float, short: bool) -> Column:
    """One minus shared over joint length (``short``: over the lesser), exons and weighted introns combined."""

    def part(both: Column, a: Column, b: Column) -> Column:
        of = F.least(a, b) if short else a + b - both
        return 1 - both / F.greatest(of, F.lit(1))

    introns_part = F.when((intron_a == 0) | (intron_b == 0), F.lit(0.0)).otherwise(part(intron, intron_a, intron_b))
    return (part(exon, exon_a, exon_b) + F.lit(weight) * introns_part) / F.lit(1 + weight)
