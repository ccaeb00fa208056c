"""The operators of difference covers, max-sketches and letter counts against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from strandloom.llm import cover_dedup, lexical_search, spelling_groups

SF = "/root/testdata/sf0.001"


def plain_cover(rows, window):
    cut = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    least = {}
    for i, w in cut:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            least[key] = min(least.get(key, math.inf), math.inf if i is None else i)
    out = []
    for i, w in cut:
        gone = set()
        for k in range(len(w) - window + 1):
            if least[tuple(w[k : k + window])] < (math.inf if i is None else i):
                gone |= set(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def as_rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)


COVER = ("doc_id", "n_words", "n_removed", "kept_sha256")


@pytest.mark.parametrize("window", [1, 3, 5, 13, 30])
def test_cover_holds_every_difference(window):
    period, cover = cover_dedup.difference_cover(window)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period)) and 2 * period - 1 <= window


@pytest.mark.parametrize("window", [1, 4, 13])
def test_cover_dedup_on_random_words(spark, window):
    r = random.Random(window)
    rows = [(r.choice([None, *range(40)]), " ".join(r.choice("abc") if window > 1 else str(r.randint(0, 99)) for _ in range(r.randint(0, 60)))) for _ in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = cover_dedup.cover_dedup(docs, window, chunk=200, bucket=100)
    assert as_rows(got, *COVER) == sorted(plain_cover(rows, window), key=repr)


def test_cover_dedup_on_documents_and_edges(spark, edges, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert as_rows(cover_dedup.cover_dedup(docs), *COVER) == sorted(plain_cover(rows, 13), key=repr)
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    assert as_rows(cover_dedup.cover_dedup(edges), *COVER) == sorted(plain_cover(rows, 13), key=repr)
    assert cover_dedup.cover_dedup(empty).count() == 0


def test_cover_dedup_of_a_passage_in_many_surroundings(spark):
    r = random.Random(5)
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(k, " ".join(f"w{r.random()}" for _ in range(30)) + f" {passage} " + " ".join(f"w{r.random()}" for _ in range(20))) for k in range(3000)]
    got = cover_dedup.cover_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), chunk=20_000)
    assert {(x.n_removed, x["count"]) for x in got.groupBy("n_removed").count().collect()} == {(0, 1), (60, 2999)}


def test_long_text_is_cut_in_blocks(monkeypatch):
    text = " ".join(str(k) for k in range(50_000)).encode()
    one = cover_dedup.word_hashes(text)
    spans = np.array([[0, 5], [17, 30_000], [49_990, 50_000]], np.int64).tobytes()
    want = cover_dedup._without(text, spans)
    monkeypatch.setattr(cover_dedup, "blocks", lambda d, f=cover_dedup.blocks: f(d, 997))
    assert (cover_dedup.word_hashes(text) == one).all() and cover_dedup._without(text, spans) == want
    assert want[:2] == (50_000, 5 + 29_983 + 10) and want[2].split()[0] == b"5"


def plain_search(rows, items, k):
    find = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(i, c) for i, t in rows if (c := Counter(find.findall((t or "").translate(low))))]
    n, total = len(docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in docs:
            m = 100 - 50 + (50 * c.total() * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(find.findall((text or "").translate(low))) if t in c)
            if s > 0:
                found.append((-s, math.inf if i is None else i))
        out += [(item, r, None if i == math.inf else i, -s) for r, (s, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


RANKED = ("item_id", "rank", "doc_id", "score")


@pytest.mark.parametrize("width", [8, 1 << 14])
def test_search_on_documents(spark, width):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    want = plain_search([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], 7)
    got = lexical_search.search(docs.repartition(5), items, 7, width, terms=300, batch=16)
    assert as_rows(got, *RANKED) == want


def test_search_edges(spark, edges, empty):
    items = spark.createDataFrame([(1, "the River, stone! é漢字"), (1, "a"), (2, None), (3, "..."), (None, "one TWO one")], "item_id long, text string")
    want = plain_search([(r.doc_id, r.text) for r in edges.collect()], [(r.item_id, r.text) for r in items.collect()], 50)
    assert as_rows(lexical_search.search(edges, items), *RANKED) == want
    assert lexical_search.search(empty, items).count() == 0
    assert lexical_search.search(edges, items.where("false")).count() == 0


def test_bounds_spare_most_of_the_scoring(spark):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    rows, known, lists = [(r.doc_id, r.text) for r in docs.collect()], {}, []
    for r in items.collect():
        lists.append(np.array([known.setdefault(t, len(known)) for t in lexical_search.term_counts(r.text)]))
    counts = [lexical_search.term_counts(t) for _, t in rows]
    df = np.array([sum(t in c for c in counts) for t in known])
    s = lexical_search.Searcher(known, lists, sum(map(bool, counts)), sum(c.total() for c in counts), df, 5, 1 << 14)
    s.add([t for _, t in rows], [i for i, _ in rows])
    assert s.scored < len(rows) * len(lists) / 5


def plain_spelling(rows, least_length=5, least=3):
    count = Counter()
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, text in rows:
        for w in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(low)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            count[w] += 1
    n = {w: c for w, c in count.items() if len(w) >= least_length and c >= least}
    holes = defaultdict(set)
    for w in n:
        for k in range(len(w)):
            holes[w[:k], w[k + 1 :]].add(w)
    near = defaultdict(set)
    for w in n:
        for k in range(len(w)):
            near[w] |= holes[w[:k], w[k + 1 :]] - {w}
            if (short := w[:k] + w[k + 1 :]) in n:
                near[w].add(short), near[short].add(w)
    form = {w: best if (best := min(near[w], key=lambda x: (-n[x], x))) and n[best] >= 2 * n[w] else None for w in n if near[w]}
    out = []
    for w in n:
        root = w
        while form.get(root):
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if form.get(w) else None))
    return sorted(out, key=repr)


SPELLED = ("word", "form", "root", "n", "n_near", "form_n")


def test_spelling_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = plain_spelling([(r.doc_id, r.text) for r in docs.collect()])
    assert len(want) > 1000 and sum(x[1] is not None for x in want) > 50
    assert as_rows(spelling_groups.spelling_groups(docs), *SPELLED) == want


@pytest.mark.parametrize(("tile", "bucket"), [(8192, 50), (6, 100)])
def test_spelling_of_random_words(spark, tile, bucket):
    r = random.Random(tile)
    some = ["".join(r.choice("aabé") for _ in range(r.randint(4, 9))) for _ in range(250)]
    rows = [(k % 50 if k % 7 else None, " ".join(r.choice(some) for _ in range(40))) for k in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert as_rows(spelling_groups.spelling_groups(docs, tile, bucket), *SPELLED) == plain_spelling(rows)


def test_spelling_edges(spark, edges, empty):
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    assert as_rows(spelling_groups.spelling_groups(edges), *SPELLED) == plain_spelling(rows)
    assert spelling_groups.spelling_groups(empty).count() == 0
    long = [(k, "x" * 3000 + " " + "x" * 3001 + " " + "x" * 1500 + "y" + "x" * 1499 + " " + "z" * 5) for k in range(4)]
    docs = spark.createDataFrame(long, "doc_id long, text string")
    assert as_rows(spelling_groups.spelling_groups(docs), *SPELLED) == plain_spelling(long)
