"""Secret scan with multipart credential linking, in DataFrame operations only.

Base spans come from three patterns.  Weak parts (a bare user or key name, a long random-looking
string, an endpoint) say little alone.  A weak part is reported only if its complements lie in
the same scope: the same paragraph or one next to it, with at most ``REACH`` code points between the two intervals.
An identifier needs a secret, a secret needs an identifier, an endpoint needs both; base spans
count as complements (access: identifier; assign and hex: secret) and are always reported.

The interval join is a sweep within the row: the parts of a text are sorted by start, and running
extrema carry the nearest end before and the nearest start behind each part.  So no pair of parts is
made, no text or part is shuffled, and a text with n matches costs n log n steps (:func:`scan`).

Defined results: null texts count as empty, empty ones have no spans and the digest of the empty
string.  Every row is judged by itself, so repeated ids or rows give a result each.  Other
columns are ignored, whatever their names.  Ties of start are ordered by kind.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns of the base kinds.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# Weak parts.  A run may follow a '=' (KEY=VALUE); as part of a run it is padding at the end only.
IDENTIFIER = r"(?i:user(?:_?(?:name|id))?|login|account(?:_?(?:name|id))?|client_?id|key_?id)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9._@-]{3,64}"
RANDOM = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[a-z0-9+/_-]*[A-Z])(?=[A-Z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{32,}={0,2}"
ENDPOINT = r"(?:https?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s\"'<>]{4,}"
BREAK = r"\n[\x20\t\r]*\n"
KINDS = ("assign", "access", "hex", "identifier", "random", "endpoint")
SCOPE = 9  # kind of a paragraph break among the parts
REACH = 300


CHUNK = 2048  # code points that a cut of a long text reads at once
SPANS = "array<struct<start:int,kind:int,end:int>>"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is computed once however often and deep the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def scan(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Running ``combine`` (associative; earlier value first) of an array, by doubling.

    Each of the log n steps makes the array anew, so nothing is appended element by element.
    """

    def step(acc: Column, k: Column) -> Column:
        hop = F.call_function("shiftleft", F.lit(1), k)
        return F.transform(acc, lambda x, i: F.when(i >= hop, combine(F.get(acc, i - hop), x)).otherwise(x))

    hops = lambda a: F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(a), F.lit(2)))).cast("int") - 1)
    return bind(values, lambda a: F.aggregate(hops(a), a, step))


def spans(text: Column, pattern: str, kind: int, group: int | None = None, least: int = 0) -> Column:
    """Leftmost non-overlapping matches as array<struct<start,kind,end>> in code points.

    What lies between matches (split) and the matches themselves give the places by running sums.
    """
    all_of = lambda g: F.regexp_extract_all(text, F.lit(pattern), F.lit(g))
    sizes = lambda a: F.transform(a, F.length)
    # The last gap follows no match and is left out.
    parts = F.zip_with(sizes(F.slice(F.split(text, pattern, -1), 1, F.size(all_of(0)))), sizes(all_of(0)), lambda gap, hit: F.struct((gap + hit).alias("to"), hit.alias("len")))
    ends = scan(parts, lambda a, b: F.struct((a["to"] + b["to"]).alias("to"), b["len"].alias("len")))
    found = F.transform(ends, lambda x: F.struct((x["to"] - x["len"]).alias("start"), F.lit(kind).alias("kind"), x["to"].alias("end")))
    if group is not None:
        found = bind(sizes(all_of(group)), lambda n: F.filter(found, lambda x, i: F.get(n, i) >= least))
    return F.when(text.rlike(pattern), found.cast(SPANS)).otherwise(F.array().cast(SPANS))


def _listed(a: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(a, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def linked(events: Column) -> Column:
    """Of sorted ``events`` (parts, and breaks of kind ``SCOPE``) the weak parts with complements.

    A part's place is its paragraph times 2**32 plus an offset: the greatest end of a complement so far is
    then in this paragraph or an earlier one, and likewise the least start to come.  No part crosses a break, so
    these are also the nearest ones.
    """
    none, wide = F.lit(-1).cast("long"), F.lit(1 << 32)
    far = F.lit((1 << 62))
    scoped = scan(
        F.transform(events, lambda x: F.struct((x["kind"] == SCOPE).cast("long").alias("scope"), x.alias("part"))),
        lambda a, b: F.struct((a["scope"] + b["scope"]).alias("scope"), b["part"].alias("part")),
    )
    place = lambda x, side: x["scope"] * wide + x["part"][side]
    is_id, is_secret = (lambda x: x["part"]["kind"].isin(1, 3)), (lambda x: x["part"]["kind"].isin(0, 2, 4))

    def extrema(order: Column, side: str, other: Column, pick: Callable) -> Column:
        """For each part: the extreme place of identifiers and of secrets among it and those before."""
        own = F.transform(order, lambda x: F.struct(F.when(is_id(x), place(x, side)).otherwise(other).alias("id"), F.when(is_secret(x), place(x, side)).otherwise(other).alias("secret")))
        return scan(own, lambda a, b: F.struct(pick(a["id"], b["id"]).alias("id"), pick(a["secret"], b["secret"]).alias("secret")))

    def judge(parts: Column, before: Column, behind: Column) -> Column:
        def near(x: Column, i: Column, kind: str) -> Column:
            # Neighbours only: the part itself is never its own complement, as its kind differs.
            last, first = F.get(before, i)[kind], F.get(behind, F.size(parts) - 1 - i)[kind]
            ahead = (last >= F.greatest(x["scope"] - 1, F.lit(0)) * wide) & (last % wide >= x["part"]["start"] - REACH)
            later = (first < (x["scope"] + 2) * wide) & (first % wide <= x["part"]["end"] + REACH)
            return ahead | later

        def keep(x: Column, i: Column) -> Column:
            kind = x["part"]["kind"]
            return F.when(kind == 3, near(x, i, "secret")).when(kind == 4, near(x, i, "id")).when(kind == 5, near(x, i, "id") & near(x, i, "secret")).otherwise(F.lit(False))

        return F.transform(F.filter(parts, keep), lambda x: x["part"])

    return bind(scoped, lambda parts: bind(
        extrema(parts, "end", none, F.greatest),
        lambda before: bind(extrema(F.reverse(parts), "start", far, F.least), lambda behind: judge(parts, before, behind)),
    ))


def _scanned(docs: DataFrame, keep: list[Column]) -> DataFrame:
    """``keep`` (one struct), t, base, weak (reported ones) and counts; a narrow stage."""
    t = F.col("t")
    d = docs.select(*keep, F.coalesce(F.col("text"), F.lit("")).alias("t"))
    d = d.select("keep", "t", spans(t, ASSIGN, 0, 1, 6).alias("assign"), spans(t, ACCESS, 1).alias("access"), spans(t, HEX, 2).alias("hex"))
    any_of = lambda *p: t.rlike("|".join(f"(?:{x})" for x in p))
    has_id = (F.size("access") > 0) | any_of(IDENTIFIER)
    has_secret = (F.size("assign") + F.size("hex") > 0) | any_of(RANDOM)
    weak = F.concat(spans(t, IDENTIFIER, 3), spans(t, RANDOM, 4), spans(t, ENDPOINT, 5))
    sort_in = lambda w: F.when(F.size(w) > 0, linked(F.array_sort(F.concat("assign", "access", "hex", w, spans(t, BREAK, SCOPE)))))
    found = F.when(has_id & has_secret, bind(weak, sort_in))
    count = lambda c: F.size(c).cast("long").alias(f"n_{c}")
    base = F.array_sort(F.concat("assign", "access", "hex"))
    return d.select("keep", "t", base.alias("base"), F.coalesce(found, F.array()).cast(SPANS).alias("weak"), count("assign"), count("access"), count("hex"))


def secret_scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_weak, parts for every row.

    ``parts`` is the sorted array of reported spans.
    """
    d = _scanned(docs, [F.col("doc_id").alias("keep")])
    parts = F.array_sort(F.concat("base", "weak"))
    return d.select(
        F.col("keep").alias("doc_id"), "n_assign", "n_access", "n_hex", F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        bind(parts, _listed).alias("spans"), F.size("weak").cast("long").alias("n_weak"), parts.alias("parts"),
    )


def _without(text: Column, parts: Column, mark: str) -> Column:
    """``text`` with the sorted ``parts`` replaced; parts that touch or overlap become one mark."""

    def cut(chunks: Column, start: Column, stop: Column) -> Column:
        first = F.floor(start / CHUNK).cast("int")
        some = F.array_join(F.slice(chunks, first + 1, F.floor(stop / CHUNK).cast("int") - first + 1), "")
        return F.substring(some, start - first * CHUNK + 1, stop - start)

    def build(p: Column, reach: Column, chunks: Column) -> Column:
        before = lambda i: F.coalesce(F.get(reach, i - 1), F.lit(0))
        gaps = F.transform(p, lambda x, i: F.when((i == 0) | (x["start"] > before(i)), cut(chunks, before(i), x["start"])))
        tail = cut(chunks, F.element_at(reach, -1), F.length(text))
        return F.array_join(F.concat(F.filter(gaps, lambda g: g.isNotNull()), F.array(tail)), mark)

    chunks = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % CHUNK), F.lit(0))
    return bind(parts, lambda p: bind(scan(F.transform(p, lambda x: x["end"]), F.greatest), lambda reach: bind(chunks, lambda c: build(p, reach, c))))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every reported span replaced by ``mark``; n_chars follows the new text.

    Rows without spans stay as they are.  Narrow: texts are cut where they stand.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("keep")
    d = _scanned(docs, [whole]).select("keep", F.array_sort(F.concat("base", "weak")).alias("parts"))
    old = F.col("keep")
    # Both columns are named twice below, which keeps the optimizer from computing them once for each use.
    d = d.select("keep", "parts", F.when(F.size("parts") > 0, _without(old["text"], F.col("parts"), mark)).alias("built"))
    made = {c: old[c] for c in docs.columns} | {"text": F.coalesce(F.col("built"), old["text"])}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.coalesce(F.length("built").cast(docs.schema["n_chars"].dataType), old["n_chars"])
    return d.select(*[made[c].alias(c) for c in docs.columns])
