"""Every operator and pipeline stage on awkward rows and on no rows at all."""

import hashlib
import zlib

import public_tokenizers
import pytest

from strandloom.llm import best_fit, exact_dedup, hilbert_shards, jaccard_join, mil_quality, prefix_bpe, quality_rules, secret_scan, suffix_dedup, token_scan

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
LABELS = "doc_id long, quality int, toxic int, text string"


def labels(spark, docs):
    return spark.createDataFrame([(1, 0, 0, "x"), (4, 1, 0, "x"), (8, 1, None, None), (12, 0, 0, None), (13, None, 0, ""), (99, 1, 0, ""), (None, 1, 1, "")], LABELS)


OPERATORS = {
    "hilbert": lambda s, d: hilbert_shards.hilbert_shards(d),
    "secret": lambda s, d: secret_scan.secret_scan(d),
    "mil": lambda s, d: mil_quality.classify(d, labels(s, d)),
    "suffix": lambda s, d: suffix_dedup.suffix_dedup(d),
    "exact": lambda s, d: exact_dedup.exact_dedup(d),
    "rules": lambda s, d: quality_rules.quality_rules(d),
    "jaccard": lambda s, d: jaccard_join.jaccard_join(d),
    "count": lambda s, d: token_scan.token_counts(d, RANKS, PATTERN, 50256),
    "bpe": lambda s, d: prefix_bpe.tokenize(d, RANKS, PATTERN),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_no_rows(spark, empty, name):
    assert OPERATORS[name](spark, empty).count() == 0


def test_no_rows_packed(empty):
    assert best_fit.pack(empty, RANKS, PATTERN).count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_one_result_for_each_row(spark, edges, name):
    key = lambda x: (x is None, x or 0)
    assert sorted((r.doc_id for r in OPERATORS[name](spark, edges).collect()), key=key) == sorted((r.doc_id for r in edges.collect()), key=key)


def test_stages_keep_columns_and_take_no_rows(spark, edges, empty):
    for stage in (quality_rules.keep_good, exact_dedup.keep_one, jaccard_join.keep_one, secret_scan.redact):
        out = stage(edges)
        assert out.columns == edges.columns and out.count() > 0
        assert stage(empty).count() == 0


def test_long_clean_text_stays(spark):
    name = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(5))
    text = " ".join("the" if i % 20 == 0 else name(i) for i in range(1_000_001))
    docs = spark.createDataFrame([(1, text), (2, "one two")], "doc_id long, text string")
    assert [r.doc_id for r in quality_rules.keep_good(docs).select("doc_id").collect()] == [1]


def test_exact_dedup(edges):
    rows = exact_dedup.exact_dedup(edges).collect()
    by = {}
    for r in edges.collect():
        by.setdefault(r.text or "", []).append(r.doc_id)
    for r in rows:
        own = next(ids for t, ids in by.items() if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        assert r.group_size == len(own) and r.keep_id == max((i for i in own if i is not None), default=None)
    assert sum(r.kept for r in rows) == len(by)
    assert exact_dedup.keep_one(edges).count() == len(by)


def test_exact_dedup_stops_at_a_shared_digest(edges):
    from pyspark.sql import functions as F

    with pytest.raises(Exception, match="share a digest"):
        exact_dedup.exact_dedup(edges, digest=lambda t: F.lit(bytearray(b"same"))).collect()


def test_hilbert_law(edges):
    rows = hilbert_shards.hilbert_shards(edges, shards=4).collect()
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    sizes = [len(v) for v in by.values()]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in by.values())
    text = {r.tag: r.text or "" for r in edges.collect()}
    assert sorted((r.size, r.text_crc32) for r in rows) == sorted((len(t.encode()) + 1, zlib.crc32(t.encode())) for t in text.values())


def test_packing(edges):
    rows = best_fit.pack(edges, RANKS, PATTERN, capacity=256, group=7).collect()
    bpe, compiled = prefix_bpe.loaded(open(RANKS, "rb").read(), PATTERN)
    want = sum(len(bpe.encode_text(r.text or "", compiled)) // 4 + 1 for r in edges.collect())
    assert sum(r.length for r in rows) == want
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for v in by.values():
        at = 0
        for offset, length in sorted(v):
            assert offset == at
            at += length
        assert at <= 256


def test_jaccard_edges(edges):
    rows = jaccard_join.jaccard_join(edges).collect()
    of = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert of[5].component_id == 4 and of[9].component_id == 8 and of[11].component_id == 10
    assert of[1].n_shingles == of[2].n_shingles == of[3].n_shingles == 0 and of[3].component_id == 3
    assert of[10].n_shingles == 1


def test_redacted_text_has_no_base_span(edges):
    again = secret_scan.secret_scan(secret_scan.redact(edges)).collect()
    assert all(r.n_assign == r.n_access == r.n_hex == 0 for r in again)
