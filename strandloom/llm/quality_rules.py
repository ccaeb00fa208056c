"""Quality rules: a table of thresholds compiled into one projection, without user functions.

Every measure is a Column over the text alone, so the whole verdict is one narrow stage: no
shuffle, no join, nothing broadcast.  Words are runs of characters other than space and
U+0009..U+000D; lines are split at a line feed.

Defined results: a null text counts as empty; texts without words have zero counts and ratios of
zero, and fail the base rule.  Ties and repeated rows are judged one by one, very long texts in
time n log n.  Input columns other than doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
# Frequent function words of the corpus languages.
STOP_WORDS = (
    "the of and to in a is that with by on for as at was be this or are an it from "
    "de la le les et du des un une en que qui pour par sur dans pas est "
    "el los las y del se por con una para su al lo como "
    "der die und den von zu das mit sich auf für ist im dem nicht ein eine als auch"
).split()
# Bit split of a sort key: hash above, word position below.  No array is longer than 2**31.
POSITION_BITS = 31


@dataclass(frozen=True)
class Rule:
    """``measure`` must lie within [low, high]; None leaves a side open."""

    measure: str
    low: float | None = None
    high: float | None = None


THRESHOLDS = (
    Rule("n_words", 50, 1_000_000),
    Rule("mean_word_chars", 3, 10),
    Rule("symbols_per_word", None, 0.1),
    Rule("stop_word_ratio", 0.02, None),
    Rule("letter_word_ratio", 0.8, None),
    Rule("repeated_line_ratio", None, 0.5),
    Rule("bullet_line_ratio", None, 0.9),
    Rule("ellipsis_line_ratio", None, 0.3),
)
# What a corpus keeps: length alone rejects no text, the ratios judge long ones too.
CORPUS = tuple(Rule(r.measure, r.low) if r.measure == "n_words" else r for r in THRESHOLDS)


def compile_rules(rules: tuple[Rule, ...]) -> Column:
    """The conjunction of all thresholds as one boolean Column over the measures."""
    ok = F.lit(True)
    for r in rules:
        if r.low is not None:
            ok = ok & (F.col(r.measure) >= F.lit(r.low))
        if r.high is not None:
            ok = ok & (F.col(r.measure) <= F.lit(r.high))
    return ok


def repeated_words(words: Column, keys: Column, bits: int = POSITION_BITS) -> Column:
    """How many words lie in a three-word window that the text holds twice or more.

    ``keys``: from :func:`shared_keys`.  If neighbours of one hash always hold the same words, all
    are repeats.  Else different windows share a hash: these texts' keys are sorted by the words.
    """
    at = lambda key: key.bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
    window = lambda p: F.struct(*[F.get(words, p + d).alias(f"w{d}") for d in range(3)])

    def differ(j: Column) -> Column:
        a, b = F.get(keys, j - 1), F.get(keys, j)
        return _same_hash(a, b, bits) & (window(at(a)) != window(at(b)))

    def repeats(sorted_: Column) -> Column:
        same = lambda j, k: F.coalesce(F.get(sorted_, j)["w"] == F.get(sorted_, k)["w"], F.lit(False))
        twice = F.filter(F.sequence(F.lit(0), F.size(sorted_) - 1), lambda j: same(j, j - 1) | same(j, j + 1))
        return F.transform(twice, lambda j: F.get(sorted_, j)["at"])

    by_words = F.sort_array(F.transform(keys, lambda x: F.struct(window(at(x)).alias("w"), at(x).alias("at"))))
    # An array of one binds the sorted windows, which are else sorted again for each element.
    exact = F.get(F.transform(F.array(by_words), repeats), 0)
    clash = F.exists(F.sequence(F.lit(1), F.size(keys) - 1), differ)
    starts = F.sort_array(F.when(clash, exact).otherwise(F.transform(keys, at)))
    add = lambda acc, p: F.struct((p + 3).alias("end"), (acc["n"] + p + 3 - F.greatest(p, acc["end"])).alias("n"))
    n = F.aggregate(starts, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), add, lambda acc: acc["n"])
    return F.when(F.size(keys) > 1, n)


def _same_hash(a: Column, b: Column, bits: int) -> Column:
    return F.shiftrightunsigned(a.bitwiseXOR(b), bits) == 0


def shared_keys(keys: Column, bits: int = POSITION_BITS) -> Column:
    """Of sorted ``keys`` those whose hash another one has: all repeated windows, and a few more."""
    same = lambda x, j: F.coalesce(_same_hash(x, F.get(keys, j), bits), F.lit(False))
    return F.filter(keys, lambda x, i: same(x, i - 1) | same(x, i + 1))


def window_keys(words: Column, bits: int = POSITION_BITS) -> Column:
    """Sorted keys of all three-word windows: the hash's high bits, then the window's position."""
    top = F.lit(-(1 << bits))
    key = lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).bitwiseAND(top).bitwiseOR(i.cast("long"))
    return F.when(F.size(words) >= 3, F.sort_array(F.transform(F.sequence(F.lit(0), F.size(words) - 3), key)))


def measures(docs: DataFrame) -> DataFrame:
    """doc_id and all measures that a rule can name."""
    text = F.coalesce(F.col("text"), F.lit(""))
    with_word = F.filter(F.split(F.col("t"), "\n", -1), lambda x: x.rlike(WORD))
    d = docs.select("doc_id", text.alias("t"))
    d = d.select("doc_id", "t", F.regexp_extract_all("t", F.lit(WORD), 0).alias("w"), with_word.alias("lines"))
    d = d.select("*", window_keys(F.col("w")).alias("all_keys"))
    d = d.select("*", shared_keys(F.col("all_keys")).alias("keys")).drop("all_keys")
    n = F.size("w")
    ratio = lambda x, of: F.when(of > 0, x / of).otherwise(F.lit(0.0))
    count = lambda a, f: F.size(F.filter(a, f))
    n_dup = (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")
    word_chars = F.length(F.translate("t", SPACES, "")).cast("long")
    n_symbols = (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long")
    return d.select(
        "doc_id", n.cast("long").alias("n_words"), word_chars.alias("word_chars"), n_symbols.alias("n_symbols"),
        n_dup.alias("n_dup_lines"), F.coalesce(repeated_words(F.col("w"), F.col("keys")), F.lit(0)).cast("long").alias("n_repeat_words"),
        ratio(word_chars, n).alias("mean_word_chars"), ratio(n_symbols, n).alias("symbols_per_word"),
        ratio(count("w", lambda x: F.lower(x).isin(STOP_WORDS)), n).alias("stop_word_ratio"),
        ratio(count("w", lambda x: x.rlike(r"\p{L}")), n).alias("letter_word_ratio"),
        ratio(n_dup, F.size("lines")).alias("repeated_line_ratio"),
        ratio(count("lines", lambda x: x.rlike(r"^\s*[-*•]")), F.size("lines")).alias("bullet_line_ratio"),
        ratio(count("lines", lambda x: x.rlike(r"(\.\.\.|…)\s*$")), F.size("lines")).alias("ellipsis_line_ratio"),
    )


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = THRESHOLDS) -> DataFrame:
    """The measures of every document with base_failed and kept."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measures(docs).withColumn("base_failed", failed).withColumn("kept", ~failed & compile_rules(rules))


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = CORPUS) -> DataFrame:
    """``docs`` without the rows that fail; all columns kept.  Narrow: rows are judged in place."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc_id"), F.col("text"))
    # The row's number keeps the optimizer from copying the whole projection into the filter.
    judged = quality_rules(whole, rules).select("doc_id", "kept", F.monotonically_increasing_id().alias("at")).where("kept AND at >= 0")
    return judged.select(*[F.col("doc_id").getField(c).alias(c) for c in docs.columns])


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
tri AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM tri) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM dup, range(0, 3) AS r(k) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(w) AS n_words, length(translate(t, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS word_chars,
             length(t) - length(translate(t, '{SYMBOLS}', '')) AS n_symbols,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
             len(list_filter(w, lambda x: lower(x) IN ({_STOP}))) AS stops, len(list_filter(w, lambda x: regexp_matches(x, '\\p{{L}}'))) AS letters,
             len(lines) AS n_lines, len(list_filter(lines, lambda x: regexp_matches(x, '^\\s*[-*•]'))) AS bullets,
             len(list_filter(lines, lambda x: regexp_matches(x, '(\\.\\.\\.|…)\\s*$'))) AS dots
      FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id),
r AS (SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
             CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars,
             CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbols_per_word,
             CASE WHEN n_words > 0 THEN stops / n_words ELSE 0 END AS stop_word_ratio,
             CASE WHEN n_words > 0 THEN letters / n_words ELSE 0 END AS letter_word_ratio,
             CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS repeated_line_ratio,
             CASE WHEN n_lines > 0 THEN bullets / n_lines ELSE 0 END AS bullet_line_ratio,
             CASE WHEN n_lines > 0 THEN dots / n_lines ELSE 0 END AS ellipsis_line_ratio,
             (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND n_words BETWEEN 50 AND 1000000 AND mean_word_chars BETWEEN 3 AND 10 AND symbols_per_word <= 0.1
           AND stop_word_ratio >= 0.02 AND letter_word_ratio >= 0.8 AND repeated_line_ratio <= 0.5
           AND bullet_line_ratio <= 0.9 AND ellipsis_line_ratio <= 0.3 AS kept
FROM r
"""
