"""The library's queries over the driver's tables, each with the same result in SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.statistics import rank_score
from ..operators import clustering, counting, description, identity, interval, modification, site_tables
from ..sources import bed
from . import simulate as S
from .simulate import SQL

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    """Register a query under its name, with its oracle."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = SQL + sql
        return f

    return add


def _long(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in cols})


def _round(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


USAGE = """, u AS (SELECT sample, p_brand AS gene, isoform_id, sum(w) AS count FROM w JOIN part ON p_partkey = isoform_id GROUP BY ALL)
"""


@query(USAGE + """SELECT gene, isoform_id, sample, round(count, 6) AS count, round(count / sum(count) OVER (PARTITION BY sample, gene), 6) AS proportion,
round(sum(count) OVER (PARTITION BY sample, gene), 6) AS gene_total FROM u WHERE count > 1e-12""")
def usage_by_sample(spark: SparkSession, d: str) -> DataFrame:
    out = counting.usage(S.pairs(spark, d), S.genes(spark, d))
    return _round(out.select("gene", "isoform_id", "sample", "count", "proportion", "gene_total"), "count", "proportion", "gene_total")


@query(USAGE + """, g AS (SELECT gene, isoform_id, CASE WHEN sample % 2 = 0 THEN 'even' ELSE 'odd' END AS "group", sum(count) AS count FROM u WHERE sample < 7 GROUP BY ALL)
SELECT gene, isoform_id, "group", round(count, 6) AS count, round(count / sum(count) OVER (PARTITION BY "group", gene), 6) AS proportion,
round(sum(count) OVER (PARTITION BY "group", gene), 6) AS gene_total FROM g""")
def usage_by_group(spark: SparkSession, d: str) -> DataFrame:
    per = counting.usage(S.pairs(spark, d), S.genes(spark, d)).select("gene", "isoform_id", "sample", "count")
    samples = S.pairs(spark, d).select("sample").distinct()
    group = F.when(F.col("sample") < 7, F.when(F.col("sample") % 2 == 0, "even").otherwise("odd"))
    return _round(counting.group_usage(per, samples.withColumn("group", group)), "count", "proportion", "gene_total").select("gene", "isoform_id", "group", "count", "proportion", "gene_total")


@query("""SELECT p_brand AS gene, p_partkey AS isoform_id, round(coalesce(sum(w), 0), 6) AS count FROM part LEFT JOIN w ON isoform_id = p_partkey GROUP BY ALL""")
def fractional_counts(spark: SparkSession, d: str) -> DataFrame:
    return _round(counting.isoform_counts(S.pairs(spark, d), S.genes(spark, d)), "count")


@query("SELECT p_brand AS gene, p_partkey AS isoform_id, " + ", ".join(f"round(coalesce(sum(w) FILTER (WHERE sample = {s}), 0), 6) AS s{s}" for s in range(8)) + " FROM part LEFT JOIN w ON isoform_id = p_partkey GROUP BY ALL")
def count_matrix(spark: SparkSession, d: str) -> DataFrame:
    return _round(counting.matrix(S.pairs(spark, d), S.genes(spark, d), list(range(8))), *[f"s{s}" for s in range(8)])


@query("SELECT p_brand AS gene, round(sum(w), 6) AS total, count(DISTINCT isoform_id) AS isoforms FROM w JOIN part ON p_partkey = isoform_id GROUP BY 1")
def gene_totals(spark: SparkSession, d: str) -> DataFrame:
    j = counting.weights(S.pairs(spark, d)).join(S.genes(spark, d), "isoform_id")
    return _round(j.groupBy("gene").agg(F.sum("w").alias("total"), F.count_distinct("isoform_id").alias("isoforms")), "total")


@query("""SELECT p_brand AS gene, p_partkey AS isoform_id, round(coalesce(sum(w), 0) * CASE WHEN p_brand LIKE '%1' THEN 2.5 ELSE 1 END, 6) AS count
FROM part LEFT JOIN w ON isoform_id = p_partkey GROUP BY p_brand, p_partkey""")
def rescaled_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts of downsampled genes raised by original over sampled reads."""
    genes = S.genes(spark, d)
    scale = genes.select("gene").distinct().where("gene LIKE '%1'").withColumn("scale", F.lit(2.5))
    out = counting.isoform_counts(S.pairs(spark, d), genes).join(scale, "gene", "left")
    return _round(out.select("gene", "isoform_id", (F.col("count") * F.coalesce("scale", F.lit(1.0))).alias("count")), "count")


@query("""SELECT a.name AS isoform, count(*) AS n_reads, sum(least(a.tx_end, r.tx_end) - greatest(a.tx_start, r.tx_start))::BIGINT AS bases
FROM cat a JOIN rd r ON a.chrom = r.chrom AND a.strand = r.strand AND a.tx_start < r.tx_end AND r.tx_start < a.tx_end GROUP BY 1""")
def span_overlap(spark: SparkSession, d: str) -> DataFrame:
    a = S.reads(spark, d).select("chrom", "strand", F.col("tx_start").alias("a_start"), F.col("tx_end").alias("a_end"))
    b = S.catalog(spark, d).select("chrom", "strand", F.col("name").alias("isoform"), F.col("tx_start").alias("b_start"), F.col("tx_end").alias("b_end"))
    bases = F.least("a_end", "b_end") - F.greatest("a_start", "b_start")
    return interval.overlap_join(a, b, ["chrom", "strand"]).groupBy("isoform").agg(F.count("*").alias("n_reads"), F.sum(bases).alias("bases"))


@query("""SELECT a.name AS isoform, count(*) AS n_near FROM cat a JOIN cat b ON a.chrom = b.chrom AND least(a.tx_end, b.tx_end) - greatest(a.tx_start, b.tx_start) >= 50 GROUP BY 1""")
def span_overlap_any_strand(spark: SparkSession, d: str) -> DataFrame:
    """Strand ignored, fifty shared bases at least, small bins."""
    c = S.catalog(spark, d)
    a = c.select("chrom", F.col("name").alias("isoform"), F.col("tx_start").alias("a_start"), F.col("tx_end").alias("a_end"))
    b = c.select("chrom", F.col("tx_start").alias("b_start"), F.col("tx_end").alias("b_end"))
    return interval.overlap_join(a, b, ["chrom"], 512, 50).groupBy("isoform").agg(F.count("*").alias("n_near"))


@query("""SELECT r.name, coalesce(string_agg(DISTINCT c.gene, '||' ORDER BY c.gene), 'none') AS genes FROM rd r LEFT JOIN cat c
ON r.chrom = c.chrom AND r.strand = c.strand AND least(r.tx_end, c.tx_end) - greatest(r.tx_start, c.tx_start) > 0
AND least(r.tx_end, c.tx_end) - greatest(r.tx_start, c.tx_start) >= 0.01 * (r.tx_end - r.tx_start) AND least(r.tx_end, c.tx_end) - greatest(r.tx_start, c.tx_start) >= 0.05 * (c.tx_end - c.tx_start) GROUP BY 1""")
def gene_assignment(spark: SparkSession, d: str) -> DataFrame:
    return interval.assign_genes(S.reads(spark, d), S.catalog(spark, d))


LOCI = """, m AS (SELECT *, max(tx_end) OVER (PARTITION BY chrom, strand ORDER BY tx_start, tx_end ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM cat),
k AS (SELECT *, sum(CASE WHEN reach IS NULL OR tx_start >= reach THEN 1 ELSE 0 END) OVER (PARTITION BY chrom, strand ORDER BY tx_start, tx_end ROWS UNBOUNDED PRECEDING) AS no FROM m)
"""


@query(LOCI + "SELECT chrom, strand, min(tx_start) AS locus_start, max(tx_end) AS locus_end, count(*) AS tracks FROM k GROUP BY chrom, strand, no")
def loci(spark: SparkSession, d: str) -> DataFrame:
    return interval.loci(S.catalog(spark, d), ["chrom", "strand"]).groupBy("chrom", "strand", "locus_start").agg(F.max("tx_end").alias("locus_end"), F.count("*").alias("tracks"))


@query("""SELECT c.name AS isoform_id, CAST(sum(e - s) AS BIGINT) AS exon_bases, CAST(max(n) - 1 AS BIGINT) AS introns, max(CASE WHEN strand = '+' THEN tx_start WHEN strand = '-' THEN tx_end END) AS five,
max(CASE WHEN strand = '+' THEN tx_end WHEN strand = '-' THEN tx_start END) AS three, CAST(sum(greatest(0, least(e, tx_start + 350) - greatest(s, tx_start + 50))) AS BIGINT) AS within,
CAST(sum(CASE WHEN least(e, tx_start + 350) > greatest(s, tx_start + 50) THEN 1 ELSE 0 END) AS BIGINT) AS n_within,
max(CASE WHEN strand = '+' THEN 50 WHEN strand = '-' THEN n * 100 - 51 END) AS spliced,
'tc_novel_v1:' || lower(hex(max(gene))) || ':' || lower(hex(max(chrom))) || ':' || max(CASE strand WHEN '+' THEN 'p' WHEN '-' THEN 'm' ELSE 'u' END) || ':' || string_agg(s || '-' || e, ';' ORDER BY i) AS structure
FROM cat c JOIN cat_x x ON c.name = x.name GROUP BY c.name""")
def track_geometry(spark: SparkSession, d: str) -> DataFrame:
    c = S.catalog(spark, d)
    low, high = F.col("tx_start") + 50, F.col("tx_start") + 350
    out = c.select(
        F.col("name").alias("isoform_id"), G.total("exons").alias("exon_bases"), F.size(G.introns("exons")).alias("introns"), G.five_prime("strand", "tx_start", "tx_end").alias("five"), G.three_prime("strand", "tx_start", "tx_end").alias("three"),
        G.length_within("exons", low, high).alias("within"), G.count_within("exons", low, high).alias("n_within"), G.genomic_to_spliced(low, "exons", "strand").alias("spliced"), G.structural_id(F.col("gene_id"), F.col("chrom"), F.col("strand"), F.col("exons")).alias("structure"),
    )
    return _long(out, "introns", "n_within")


@query("""SELECT c.name AS isoform_id, string_agg(v, ',' ORDER BY CASE WHEN strand = '-' THEN -v ELSE v END) AS junctions FROM
(SELECT name, s AS v FROM cat_x WHERE i > 0 UNION ALL SELECT x.name, e FROM cat_x x JOIN cat c ON c.name = x.name WHERE i < n - 1) b JOIN cat c ON c.name = b.name GROUP BY 1""")
def junction_chains(spark: SparkSession, d: str) -> DataFrame:
    chain = F.array_join(G.junction_positions("exons", "strand"), ",")
    return S.catalog(spark, d).select(F.col("name").alias("isoform_id"), chain.alias("junctions")).where("junctions <> ''")


SITES = """, all_t AS (SELECT chrom, strand, tx_start, tx_end, name, 5 AS wt FROM cat UNION ALL SELECT chrom, strand, tx_start, tx_end, name, 1 FROM rd),
m AS (SELECT *, max(tx_end) OVER (PARTITION BY chrom, strand ORDER BY tx_start, tx_end ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM all_t),
k AS (SELECT *, max(CASE WHEN reach IS NULL OR tx_start >= reach THEN tx_start END) OVER (PARTITION BY chrom, strand ORDER BY tx_start, tx_end ROWS UNBOUNDED PRECEDING) AS locus_start FROM m),
x AS (SELECT * FROM cat_x UNION ALL SELECT * FROM rd_x),
b AS (SELECT name, i, s, e, min(i) OVER (PARTITION BY name) AS lo, max(i) OVER (PARTITION BY name) AS hi FROM x),
p AS (SELECT name, s AS pos FROM b WHERE i > lo UNION ALL SELECT name, e FROM b WHERE i < hi),
sites AS (SELECT chrom, strand, locus_start, pos, CAST(sum(wt) AS BIGINT) AS support FROM k JOIN p ON p.name = k.name GROUP BY ALL)
"""


def _all_tracks(spark: SparkSession, d: str) -> DataFrame:
    cols = ["name", "chrom", "strand", "tx_start", "tx_end", "exons", "gene_id", "score"]
    return S.reads(spark, d).select(*cols, F.lit("read").alias("source")).unionByName(S.catalog(spark, d).select(*cols, F.lit("reference").alias("source")))


@query(SITES + "SELECT * FROM sites")
def splice_site_support(spark: SparkSession, d: str) -> DataFrame:
    return clustering.site_support(_all_tracks(spark, d))


@query(SITES + """, v AS (SELECT *, first_value(CASE WHEN support >= 20 THEN pos END IGNORE NULLS) OVER (PARTITION BY chrom, strand, locus_start ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt,
last_value(CASE WHEN support >= 20 THEN pos END IGNORE NULLS) OVER (PARTITION BY chrom, strand, locus_start ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prv FROM sites)
SELECT chrom, strand, locus_start, pos, support, CASE WHEN support >= 20 THEN pos WHEN nxt - pos <= 120 THEN nxt WHEN pos - prv <= 120 THEN prv END AS corrected FROM v""")
def snapped_sites(spark: SparkSession, d: str) -> DataFrame:
    return clustering.snap_sites(clustering.site_support(_all_tracks(spark, d)), 20, 120)


ENDS = """, c AS (SELECT rd.*, (SELECT 1) AS one, tx_end AS endp, f || ':' || part AS chain FROM rd WHERE n - f > 1 AND strand = '+')
"""


@query("""SELECT a.name, CAST(count(*) AS BIGINT) AS support FROM rd a JOIN rd b ON a.part = b.part AND a.f = b.f
AND abs(CASE WHEN a.strand = '+' THEN a.tx_end ELSE a.tx_start END - CASE WHEN b.strand = '+' THEN b.tx_end ELSE b.tx_start END) <= 5
WHERE a.n - a.f > 1 AND a.strand <> '.' GROUP BY 1""")
def three_prime_support(spark: SparkSession, d: str) -> DataFrame:
    t = S.reads(spark, d).withColumn("source", F.lit("read"))
    return clustering.end_support(t, G.three_prime("strand", "tx_start", "tx_end"), 5).where("support > 0").select("name", F.col("support").cast("long").alias("support"))


@query("""SELECT a.name, CAST(count(*) AS BIGINT) AS support FROM rd a JOIN rd b ON a.part = b.part AND a.f = b.f AND b.score > 500
AND abs(CASE WHEN a.strand = '+' THEN a.tx_start ELSE a.tx_end END - CASE WHEN b.strand = '+' THEN b.tx_start ELSE b.tx_end END) <= 15
WHERE a.n - a.f > 1 AND a.strand <> '.' GROUP BY 1""")
def five_prime_leader_support(spark: SparkSession, d: str) -> DataFrame:
    """Only reads whose leader score exceeds the cutoff support an end."""
    t = S.reads(spark, d).withColumn("source", F.lit("read"))
    return clustering.end_support(t, G.five_prime("strand", "tx_start", "tx_end"), 15, F.col("score") > 500).where("support > 0").select("name", F.col("support").cast("long").alias("support"))


@query("""SELECT molecule, name FROM (SELECT CAST(molecule AS VARCHAR) AS molecule, rd.name, row_number() OVER (PARTITION BY molecule ORDER BY len DESC, rd.name) AS r
FROM rd JOIN (SELECT name, sum(e - s) AS len FROM rd_x GROUP BY 1) l ON l.name = rd.name) WHERE r = 1""")
def longest_read(spark: SparkSession, d: str) -> DataFrame:
    r = S.reads(spark, d).select(F.col("molecule").cast("string").alias("name"), "exons", F.col("name").alias("instance_id"))
    return clustering.dedup_longest(r).select(F.col("name").alias("molecule"), F.col("instance_id").alias("name"))


@query("SELECT part, tx_start, tx_end, count(*) AS members FROM rd GROUP BY part, f, tx_start, tx_end")
def equal_structures(spark: SparkSession, d: str) -> DataFrame:
    r = S.reads(spark, d).withColumn("gene_id", F.col("part"))
    return clustering.structures(r).select(F.col("gene_id").alias("part"), "tx_start", "tx_end", "members")


ASSIGN = """, ri AS (SELECT name, e AS s, lead(s) OVER (PARTITION BY name ORDER BY i) AS e FROM rd_x), ci AS (SELECT name, e AS s, lead(s) OVER (PARTITION BY name ORDER BY i) AS e FROM cat_x),
pr AS (SELECT r.name AS read_id, c.name AS isoform_id, r.tx_start AS rs, r.tx_end AS re, c.tx_start AS cs, c.tx_end AS ce, r.n - r.f AS rn, r.strand = c.strand AS ok FROM rd r JOIN cat c ON r.chrom = c.chrom AND r.tx_start < c.tx_end AND c.tx_start < r.tx_end),
xo AS (SELECT read_id, isoform_id, sum(least(a.e, b.e) - greatest(a.s, b.s)) AS ov FROM pr JOIN rd_x a ON a.name = read_id JOIN cat_x b ON b.name = isoform_id AND a.s < b.e AND b.s < a.e GROUP BY ALL),
mt AS (SELECT read_id, isoform_id, count(*) AS m FROM pr JOIN ri a ON a.name = read_id JOIN ci b ON b.name = isoform_id AND a.s = b.s AND a.e = b.e WHERE a.e IS NOT NULL GROUP BY ALL),
ex AS (SELECT read_id, isoform_id, count(*) AS extra FROM pr JOIN ci b ON b.name = isoform_id WHERE b.e IS NOT NULL AND NOT EXISTS (SELECT 1 FROM ri a WHERE a.name = read_id AND a.s = b.s AND a.e = b.e)
  AND ((b.s >= rs AND b.e <= re) OR EXISTS (SELECT 1 FROM rd_x q WHERE q.name = read_id AND q.s < b.e AND b.s < q.e)) GROUP BY ALL),
ln AS (SELECT name, sum(e - s) AS len FROM rd_x GROUP BY 1),
wi AS (SELECT read_id, isoform_id, sum(greatest(0, least(b.e, re) - greatest(b.s, rs))) AS wl, sum(CASE WHEN least(b.e, re) > greatest(b.s, rs) THEN 1 ELSE 0 END) AS wn FROM pr JOIN cat_x b ON b.name = isoform_id GROUP BY ALL),
sc AS (SELECT pr.read_id, pr.isoform_id, rn - 1 - coalesce(m, 0) AS k1, coalesce(extra, 0) AS k2, abs(rs - cs) + abs(re - ce) AS k3, len + wl - 2 * ov AS k4, abs(rn - wn) AS k5
  FROM pr JOIN xo USING (read_id, isoform_id) LEFT JOIN mt USING (read_id, isoform_id) LEFT JOIN ex USING (read_id, isoform_id) JOIN ln ON ln.name = pr.read_id JOIN wi USING (read_id, isoform_id) WHERE ok),
best AS (SELECT read_id, isoform_id FROM (SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY k1, k2, k3, k4, k5, isoform_id) AS r FROM sc) WHERE r = 1)
"""


@query(ASSIGN + """SELECT rd.name AS read_id, best.isoform_id, CASE WHEN best.isoform_id IS NULL THEN CASE WHEN NOT EXISTS (SELECT 1 FROM pr WHERE pr.read_id = rd.name) THEN 'no_candidate_locus'
WHEN NOT EXISTS (SELECT 1 FROM pr WHERE pr.read_id = rd.name AND ok) THEN 'strand_mismatch' ELSE 'no_exon_overlap' END END AS reason FROM rd LEFT JOIN best ON best.read_id = rd.name""")
def catalog_assignment(spark: SparkSession, d: str) -> DataFrame:
    """The nearest isoform of every read, introns compared exactly."""
    return counting.assign_to_catalog(S.reads(spark, d), S.catalog(spark, d), 0)


@query(ASSIGN + "SELECT count(*) AS total_reads, count(best.isoform_id) AS assigned_reads, count(*) - count(best.isoform_id) AS unassigned_reads FROM rd LEFT JOIN best ON best.read_id = rd.name")
def assignment_statistics(spark: SparkSession, d: str) -> DataFrame:
    a = counting.assign_to_catalog(S.reads(spark, d), S.catalog(spark, d), 0)
    return a.agg(F.count("*").alias("total_reads"), F.count("isoform_id").alias("assigned_reads"), F.count_if(F.col("isoform_id").isNull()).alias("unassigned_reads"))


@query(ASSIGN + """SELECT rd.name AS read_id, best.isoform_id, CASE WHEN best.isoform_id IS NULL THEN CASE WHEN NOT EXISTS (SELECT 1 FROM pr WHERE pr.read_id = rd.name) THEN 'no_candidate_locus'
WHEN NOT EXISTS (SELECT 1 FROM pr WHERE pr.read_id = rd.name AND ok) THEN 'strand_mismatch' ELSE 'no_exon_overlap' END END AS reason FROM rd LEFT JOIN best ON best.read_id = rd.name""")
def catalog_assignment_tolerant(spark: SparkSession, d: str) -> DataFrame:
    """The same with introns matched within 15 bases; sites of these tables are equal or at least 100 apart, so the rows are the same."""
    return counting.assign_to_catalog(S.reads(spark, d), S.catalog(spark, d), 15)


UNIQUE = ASSIGN + """, cr AS (SELECT DISTINCT read_id, isoform_id FROM pr JOIN ci b ON b.name = isoform_id JOIN rd_x q ON q.name = read_id AND q.s < b.e AND b.s < q.e
  WHERE b.e IS NOT NULL AND NOT EXISTS (SELECT 1 FROM ri a WHERE a.name = read_id AND a.s = b.s AND a.e = b.e)),
rt AS (SELECT DISTINCT c.name AS isoform_id, b.s, b.e FROM cat c JOIN cat_x x ON x.name = c.name JOIN cat k ON k.gene = c.gene AND k.chrom = c.chrom AND k.strand = c.strand JOIN ci b ON b.name = k.name AND x.s <= b.s AND b.e <= x.e),
rx AS (SELECT sc.read_id, rt.isoform_id, rt.s, rt.e, rt.s < rd.tx_end AND rd.tx_start < rt.e AS reached FROM sc JOIN rt ON rt.isoform_id = sc.isoform_id JOIN rd ON rd.name = sc.read_id),
sh AS (SELECT DISTINCT rx.read_id, rx.isoform_id, rx.s, rx.e FROM rx JOIN rd_x q ON q.name = rx.read_id AND ((q.s < rx.s AND rx.s < q.e) OR (q.s < rx.e AND rx.e < q.e))),
ng AS (SELECT rx.read_id, rx.isoform_id FROM rx LEFT JOIN sh ON sh.read_id = rx.read_id AND sh.isoform_id = rx.isoform_id AND sh.s = rx.s AND sh.e = rx.e
  GROUP BY 1, 2 HAVING count(*) FILTER (WHERE reached) = 0 OR count(*) FILTER (WHERE reached AND sh.s IS NULL) > 0),
un AS (SELECT sc.*, rd.part FROM sc JOIN rd ON rd.name = sc.read_id JOIN cat c ON c.name = sc.isoform_id JOIN (SELECT 't' || id AS part, gene FROM cat UNION ALL SELECT 't' || (id - 1), gene FROM cat) o ON o.part = rd.part AND o.gene = c.gene
  LEFT JOIN cr ON cr.read_id = sc.read_id AND cr.isoform_id = sc.isoform_id LEFT JOIN ng ON ng.read_id = sc.read_id AND ng.isoform_id = sc.isoform_id
  LEFT JOIN cat_x l ON l.name = c.name AND l.i = CASE WHEN c.strand = '-' THEN 0 ELSE c.n - 1 END
  WHERE k1 = 0 AND cr.read_id IS NULL AND ng.read_id IS NULL AND CASE WHEN rd.n - rd.f > 1 THEN c.n > 1 ELSE c.n = 1 OR (l.s <= rd.tx_start AND rd.tx_end <= l.e) END)
SELECT read_id, isoform_id FROM (SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY k1, k2, k3, k4, k5, CASE WHEN isoform_id = part THEN 0 ELSE 1 END, isoform_id) AS r FROM un) WHERE r = 1"""


@query(UNIQUE)
def unique_assignment(spark: SparkSession, d: str) -> DataFrame:
    """One isoform for each read mapped to its part and to the next part."""
    r, c = S.reads(spark, d), S.catalog(spark, d)
    of = lambda key: c.select(F.concat(F.lit("t"), key).alias("part"), F.col("name").alias("isoform_id"))
    mapping = r.select(F.col("name").alias("read_id"), "part").join(of(F.col("id")).unionByName(of(F.col("id") - 1)), "part")
    return counting.unique_best(r, c, mapping, 15)


@query("""SELECT a.name AS a, b.name AS b FROM cat a JOIN cat b ON a.id <> b.id AND a.chrom = b.chrom AND (string_split(a.gene, '||')[1] = b.gene) AND a.tx_start < b.tx_end AND b.tx_start < a.tx_end""")
def compatible_genes(spark: SparkSession, d: str) -> DataFrame:
    c = S.catalog(spark, d)
    a = c.select("chrom", F.col("name").alias("a"), G.gene_tokens("gene_id").alias("ga"), F.col("tx_start").alias("a_start"), F.col("tx_end").alias("a_end"))
    b = c.select("chrom", F.col("name").alias("b"), G.gene_tokens("gene_id").alias("gb"), F.col("tx_start").alias("b_start"), F.col("tx_end").alias("b_end"))
    return interval.overlap_join(a, b, ["chrom"]).where((F.col("a") != F.col("b")) & ((F.size("ga") == 0) | (F.size("gb") == 0) | F.arrays_overlap("ga", "gb"))).select("a", "b")


@query("""SELECT c.name AS isoform_id, g.s AS start, g.e AS "end" FROM cat c JOIN cat_x x ON x.name = c.name JOIN (SELECT DISTINCT gene, chrom, strand, q.s, q.e FROM cat
JOIN (SELECT name, e AS s, lead(s) OVER (PARTITION BY name ORDER BY i) AS e FROM cat_x) q ON q.name = cat.name WHERE q.e IS NOT NULL) g ON g.gene = c.gene AND g.chrom = c.chrom AND g.strand = c.strand AND x.s <= g.s AND g.e <= x.e""")
def retained_introns(spark: SparkSession, d: str) -> DataFrame:
    kept = counting.retained_regions(S.catalog(spark, d))
    return kept.select("isoform_id", F.explode("retained").alias("r")).select("isoform_id", "r.start", "r.end")


@query("""SELECT a.name AS a, b.name AS b, round(1 - ov * 1.0 / (a.n * 100 + b.n * 100 - ov), 6) AS exon_distance FROM (SELECT x.name AS a, y.name AS b, sum(least(x.e, y.e) - greatest(x.s, y.s)) AS ov
FROM cat_x x JOIN cat cx ON cx.name = x.name JOIN cat cy ON cy.chrom = cx.chrom AND cy.strand = cx.strand AND cx.name < cy.name JOIN cat_x y ON y.name = cy.name AND x.s < y.e AND y.s < x.e GROUP BY ALL) o
JOIN cat a ON a.name = o.a JOIN cat b ON b.name = o.b""")
def overlap_distance(spark: SparkSession, d: str) -> DataFrame:
    out = clustering.overlap_distances(S.catalog(spark, d))
    exon = 1 - F.col("exon_shared") / (F.col("exon_a") + F.col("exon_b") - F.col("exon_shared"))
    return _round(out.select("a", "b", exon.alias("exon_distance")), "exon_distance")


@query()
def isoform_catalog(spark: SparkSession, d: str) -> DataFrame:
    """Discovery: read support of every isoform after correction and merging."""
    isoforms, mapping, _ = clustering.junction_catalog(S.reads(spark, d), S.catalog(spark, d))
    n = mapping.groupBy("isoform_id").agg(F.count("*").alias("reads"))
    return isoforms.select("isoform_id", "chrom", "strand", "tx_start", "tx_end", "is_ref").join(n, "isoform_id", "left").withColumn("reads", F.coalesce("reads", F.lit(0)))


@query("""SELECT rd.name AS isoform_id, part AS ref_id, CASE WHEN n - f = 1 AND n > 1 THEN 1 ELSE 0 END AS single, CAST(2 * f AS BIGINT) AS missed FROM rd""")
def nearest_reference(spark: SparkSession, d: str) -> DataFrame:
    """Reads described against references of their own name: sites missed at one end."""
    r = S.reads(spark, d).withColumn("gene_id", F.col("part"))
    near = description.classify(description.nearest_reference(r, S.catalog(spark, d).withColumn("gene_id", F.col("name"))))
    size = r.select(F.col("name").alias("isoform_id"), F.size("exons").alias("k"))
    return near.join(size, "isoform_id").select("isoform_id", "ref_id", ((F.col("k") == 1) & (F.col("missed") > 0)).cast("int").alias("single"), "missed")


@query()
def structure_classes(spark: SparkSession, d: str) -> DataFrame:
    """Reads by gene and what their sites say of them."""
    four = F.regexp_extract("class4", "^(new_junction|new_combination|all_matched)", 1)
    return description.describe(_named(spark, d), S.catalog(spark, d)).groupBy("gene", four.alias("class")).agg(F.count("*").alias("reads"))


@query("""SELECT name AS isoform_id, string_agg(DISTINCT gene, ';' ORDER BY gene) AS genes FROM (SELECT r.name, c.gene FROM cat r JOIN cat c ON r.chrom = c.chrom AND r.strand = c.strand
AND least(r.tx_end, c.tx_end) - greatest(r.tx_start, c.tx_start) > 0 AND least(r.tx_end, c.tx_end) - greatest(r.tx_start, c.tx_start) >= 0.1 * (r.tx_end - r.tx_start)
AND least(r.tx_end, c.tx_end) - greatest(r.tx_start, c.tx_start) >= 0.1 * (c.tx_end - c.tx_start)) GROUP BY name HAVING count(DISTINCT gene) > 1""")
def fusion_genes(spark: SparkSession, d: str) -> DataFrame:
    c = S.catalog(spark, d)
    return description.fusions(c, c)


@query("""SELECT obs.sample, count(*) AS input_rows, count(iso.isoform_id) AS joined_rows, count(DISTINCT iso.read_id) AS joined_reads, count(*) - count(iso.isoform_id) AS unknown_rows,
round(count(iso.isoform_id) / count(*), 6) AS join_rate FROM obs LEFT JOIN iso ON iso.sample = obs.sample AND iso.read_id = obs.read_id GROUP BY 1""")
def observation_join_quality(spark: SparkSession, d: str) -> DataFrame:
    return _round(modification.join_quality(modification.assign_observations(S.observations(spark, d), S.read_isoforms(spark, d))), "join_rate")


AGG = """, jn AS (SELECT obs.*, gene, isoform_id FROM obs JOIN iso ON iso.sample = obs.sample AND iso.read_id = obs.read_id),
ag AS (SELECT sample, gene, isoform_id, chrom, pos, strand, mod_code, count(*) FILTER (WHERE state = 'explicit') AS n_explicit, count(*) FILTER (WHERE state = 'explicit' AND probability >= 0.5) AS n_modified,
sum(probability) FILTER (WHERE state = 'explicit') AS sum_probability, count(*) FILTER (WHERE state = 'implicit') AS n_implicit, count(*) FILTER (WHERE state = 'unknown') AS n_unknown FROM jn GROUP BY ALL),
wl AS (SELECT *, n_explicit + n_implicit AS n_callable, CASE WHEN n_explicit + n_implicit > 0 THEN n_modified / (n_explicit + n_implicit) END AS fraction FROM ag)
"""


@query(AGG + """SELECT sample, gene, isoform_id, chrom, pos, strand, mod_code, n_explicit, n_modified, round(sum_probability, 6) AS sum_probability, n_implicit, n_unknown, n_callable, round(fraction, 6) AS fraction,
round(CASE WHEN n_callable > 0 THEN greatest(0, least(fraction, ((fraction + z2 / (2 * n_callable)) - z * sqrt(fraction * (1 - fraction) / n_callable + z2 / (4 * n_callable * n_callable))) / (1 + z2 / n_callable))) END, 6) AS ci_low,
round(CASE WHEN n_callable > 0 THEN least(1, greatest(fraction, ((fraction + z2 / (2 * n_callable)) + z * sqrt(fraction * (1 - fraction) / n_callable + z2 / (4 * n_callable * n_callable))) / (1 + z2 / n_callable))) END, 6) AS ci_high
FROM wl, (SELECT 1.959963984540054::DOUBLE AS z, 1.959963984540054::DOUBLE * 1.959963984540054::DOUBLE AS z2)""")
def modification_counts(spark: SparkSession, d: str) -> DataFrame:
    out = modification.aggregate(modification.assign_observations(S.observations(spark, d), S.read_isoforms(spark, d)))
    return _round(out, "sum_probability", "fraction", "ci_low", "ci_high")


FULL = AGG + """, sm AS (SELECT DISTINCT sample, gene FROM wl), gi AS (SELECT DISTINCT gene, isoform_id FROM iso), st AS (SELECT DISTINCT gene, chrom, pos, strand, mod_code FROM wl),
fu AS (SELECT st.*, sm.sample, gi.isoform_id, coalesce(n_callable, 0) AS n_callable, coalesce(wl.n_modified, 0) AS n_modified, fraction,
CASE WHEN coalesce(n_callable, 0) = 0 THEN 'no_callable_reads' WHEN n_callable < 10 THEN 'low_callable' ELSE 'ok' END AS reason
FROM st JOIN sm ON sm.gene = st.gene JOIN gi ON gi.gene = st.gene LEFT JOIN wl ON wl.gene = st.gene AND wl.chrom = st.chrom AND wl.pos = st.pos AND wl.strand = st.strand AND wl.mod_code = st.mod_code AND wl.sample = sm.sample AND wl.isoform_id = gi.isoform_id)
"""


def _full(spark: SparkSession, d: str) -> DataFrame:
    counts = modification.aggregate(modification.assign_observations(S.observations(spark, d), S.read_isoforms(spark, d)))
    iso = S.read_isoforms(spark, d)
    return modification.complete(counts, iso.select("sample").distinct(), iso.select("gene", "isoform_id").distinct())


@query(FULL + """SELECT gene, chrom, pos, strand, mod_code, count(DISTINCT isoform_id) AS n_isoforms, count(*) AS n_rows, count(*) FILTER (WHERE reason = 'ok') AS n_ok, count(*) FILTER (WHERE reason = 'low_callable') AS n_low,
CAST(sum(n_callable) AS BIGINT) AS n_callable, CAST(sum(n_modified) AS BIGINT) AS n_modified, min(n_callable) FILTER (WHERE reason = 'ok') AS least_callable FROM fu GROUP BY ALL""")
def modification_site_summary(spark: SparkSession, d: str) -> DataFrame:
    return modification.site_summary(_full(spark, d))


@query(FULL + """SELECT a.gene, a.chrom, a.pos, a.strand, a.mod_code, CASE WHEN a.sample % 2 = 0 THEN 'control' ELSE 'treated' END AS "group", a.isoform_id AS isoform_a, b.isoform_id AS isoform_b, count(*) AS n_samples,
round(avg(a.fraction - b.fraction), 6) AS mean_difference, CAST(sum(a.n_modified) AS BIGINT) AS m_a, CAST(sum(a.n_callable - a.n_modified) AS BIGINT) AS u_a, CAST(sum(b.n_modified) AS BIGINT) AS m_b, CAST(sum(b.n_callable - b.n_modified) AS BIGINT) AS u_b,
round(((sum(a.n_modified) + 0.5) * (sum(b.n_callable - b.n_modified) + 0.5)) / ((sum(a.n_callable - a.n_modified) + 0.5) * (sum(b.n_modified) + 0.5)), 6) AS odds_ratio
FROM fu a JOIN fu b ON a.gene = b.gene AND a.chrom = b.chrom AND a.pos = b.pos AND a.sample = b.sample AND a.isoform_id < b.isoform_id WHERE a.reason = 'ok' AND b.reason = 'ok' GROUP BY ALL""")
def isoform_contrasts(spark: SparkSession, d: str) -> DataFrame:
    return _round(modification.isoform_contrasts(_full(spark, d), _groups(spark, d)), "mean_difference", "odds_ratio")


def _groups(spark: SparkSession, d: str) -> DataFrame:
    return S.read_isoforms(spark, d).select("sample").distinct().withColumn("group", F.when(F.col("sample") % 2 == 0, "control").otherwise("treated"))


@query(FULL + """SELECT gene, isoform_id, chrom, pos, strand, mod_code, count(*) AS n_samples, round(avg(fraction) FILTER (WHERE sample % 2 = 1) - avg(fraction) FILTER (WHERE sample % 2 = 0), 6) AS difference FROM fu WHERE reason = 'ok' GROUP BY ALL""")
def condition_contrasts(spark: SparkSession, d: str) -> DataFrame:
    return _round(modification.condition_contrasts(_full(spark, d), _groups(spark, d), "treated", "control"), "difference")


@query("""SELECT c.name AS isoform_id, count(*) AS covered_sites FROM cat_x x JOIN cat c ON c.name = x.name JOIN (SELECT 'chr' || (event_id % 5) AS chrom, event_id * 4 AS pos FROM events) p ON p.chrom = c.chrom AND x.s <= p.pos AND p.pos < x.e GROUP BY 1""")
def site_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Sites that lie in an exon."""
    e = S.table(spark, d, "events").select(F.concat(F.lit("chr"), F.col("event_id") % 5).alias("chrom"), (F.col("event_id") * 4).alias("pos"))
    blocks = S.catalog(spark, d).select("chrom", F.col("name").alias("isoform_id"), F.explode("exons").alias("x")).select("chrom", "isoform_id", F.col("x.start").alias("b_start"), F.col("x.end").alias("b_end"))
    return interval.point_join(e, blocks, ["chrom"]).groupBy("isoform_id").agg(F.count("*").alias("covered_sites"))


TAILS = """, tl AS (SELECT sample, read_id, CASE event_type WHEN (SELECT min(event_type) FROM events) THEN 'estimation_failed' WHEN (SELECT max(event_type) FROM events) THEN 'anchor_not_found' ELSE 'estimated' END AS status, value AS length FROM obs WHERE read_id % 5 <> 0),
tj AS (SELECT iso.sample, iso.isoform_id, coalesce(status, 'missing') AS status, CASE WHEN status = 'estimated' THEN length END AS length FROM iso LEFT JOIN tl ON tl.sample = iso.sample AND tl.read_id = iso.read_id)
"""


@query(TAILS + """SELECT sample, isoform_id, count(*) AS n_assigned, count(*) FILTER (WHERE status = 'estimated') AS n_estimated, count(*) FILTER (WHERE status = 'estimation_failed') AS n_estimation_failed, count(*) FILTER (WHERE status = 'anchor_not_found') AS n_anchor_not_found,
count(*) FILTER (WHERE status = 'missing') AS n_missing, round(avg(length), 6) AS mean, round(quantile_cont(length, 0.5), 6) AS median, round(quantile_cont(length, 0.25), 6) AS q25, round(quantile_cont(length, 0.75), 6) AS q75,
min(length) AS shortest, max(length) AS longest, round(stddev_samp(length), 6) AS sd FROM tj GROUP BY ALL""")
def tail_lengths(spark: SparkSession, d: str) -> DataFrame:
    obs, iso = S.observations(spark, d), S.read_isoforms(spark, d)
    ends = obs.agg(F.min("event_type").alias("low"), F.max("event_type").alias("high"))
    status = F.when(F.col("event_type") == F.col("low"), "estimation_failed").when(F.col("event_type") == F.col("high"), "anchor_not_found").otherwise("estimated")
    calls = obs.where("read_id % 5 <> 0").crossJoin(ends).select("sample", "read_id", status.alias("status"), F.col("value").alias("length"))  # one row beside all
    universe = iso.select("sample", "isoform_id").distinct()
    return _round(modification.tail_summary(calls, iso.select("sample", "read_id", "isoform_id"), universe).drop("n_qc_failed"), "mean", "median", "q25", "q75", "sd")


@query(""", sc AS (SELECT o_custkey % 10 AS stratum, CAST(o_orderkey AS VARCHAR) AS read_id, sha256('strand:7:' || o_orderkey) AS h FROM orders)
SELECT stratum, read_id, r AS rank, (r - 1) // 20 AS replicate FROM (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY h, read_id) AS r FROM sc) WHERE r <= 60""")
def seeded_ranks(spark: SparkSession, d: str) -> DataFrame:
    """Disjoint samples of 20 reads, three for each stratum, ranked by a text digest."""
    o = S.table(spark, d, "orders").select((F.col("o_custkey") % 10).alias("stratum"), F.col("o_orderkey").cast("string").alias("read_id"))
    rank = F.row_number().over(Window.partitionBy("stratum").orderBy(F.sha2(F.concat(F.lit("strand:7:"), "read_id"), 256), "read_id"))
    return _long(o.withColumn("rank", rank).where("rank <= 60").withColumn("replicate", F.floor((F.col("rank") - 1) / 20)), "rank", "replicate")


DRAW = r""", sb AS (SELECT o_custkey % 10 AS stratum, CAST(o_orderkey AS VARCHAR) AS read_id FROM orders)
"""


@query(DRAW + r"""SELECT stratum, read_id, r::INTEGER AS rank, (r - 1) // 20 AS replicate FROM (SELECT stratum, read_id, row_number() OVER (PARTITION BY stratum
ORDER BY sha256('subsample-v1\x00\x07\x00\x00\x00\x00\x00\x00\x00\x00'::BLOB || encode(read_id)), read_id) AS r FROM sb) WHERE r <= 60""")
def seeded_subsample(spark: SparkSession, d: str) -> DataFrame:
    o = S.table(spark, d, "orders").select((F.col("o_custkey") % 10).alias("stratum"), F.col("o_orderkey").cast("string").alias("read_id"))
    return modification.subsample(o, 7, 20, 3)


@query(DRAW + r"""SELECT stratum, read_id, r::INTEGER AS rank, k::BIGINT AS replicate FROM (SELECT stratum, read_id, k, row_number() OVER (PARTITION BY stratum, k ORDER BY sha256('subsample-v1\x00\x07\x00\x00\x00\x00\x00\x00\x00'::BLOB
|| CASE k WHEN 0 THEN '\x00'::BLOB WHEN 1 THEN '\x01'::BLOB ELSE '\x02'::BLOB END || '\x00\x00\x00\x00\x00\x00\x00\x00'::BLOB || encode(read_id)), read_id) AS r FROM sb, (SELECT unnest(range(3)) AS k)) WHERE r <= 50""")
def independent_subsamples(spark: SparkSession, d: str) -> DataFrame:
    """Three samples of 50 reads of each stratum, drawn apart from each other."""
    o = S.table(spark, d, "orders").select((F.col("o_custkey") % 10).alias("stratum"), F.col("o_orderkey").cast("string").alias("read_id"))
    return modification.subsample(o, 7, 50, 3, independent=True)


@query("SELECT name FROM rd WHERE NOT EXISTS (SELECT 1 FROM cat c WHERE c.name = rd.part AND c.n = 3)")
def unrepresented_reads(spark: SparkSession, d: str) -> DataFrame:
    return S.reads(spark, d).join(S.catalog(spark, d).where("n = 3").select(F.col("name").alias("part")), "part", "left_anti").select("name")


@query("""SELECT l_partkey AS isoform_id, round(sum(1.0 / k), 6) AS coverage FROM (SELECT DISTINCT l_orderkey, l_partkey, count(*) OVER (PARTITION BY l_orderkey) AS k FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)) GROUP BY 1""")
def membership_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Coverage of isoforms from their embedded member lists, written and read back."""
    p = S.pairs(spark, d).select("read_id", "isoform_id").distinct()
    listed = p.groupBy("isoform_id").agg(F.concat(F.lit("tc_name2_v1:"), F.array_join(F.collect_set(F.col("read_id").cast("string")), ",")).alias("name2"))
    back = listed.select("isoform_id", F.explode(bed.name2_members(F.col("name2"))).alias("read_id"))
    return _round(counting.weights(back).groupBy("isoform_id").agg(F.sum("w").alias("coverage")), "coverage")


@query("SELECT c.name, gene AS gene_id, chrom, strand, tx_start, tx_end, CAST(n AS BIGINT) AS exons FROM cat c")
def bed_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Tracks written as BED lines and parsed back."""
    c = S.catalog(spark, d).select("chrom", "strand", "tx_start", "tx_end", "name", F.lit(0).alias("score"), F.col("tx_start").alias("thick_start"), F.col("tx_end").alias("thick_end"), F.lit("0").alias("item_rgb"), "exons", *[F.lit("").alias(x) if x != "gene_id" else F.col("gene_id") for x in bed.EXTRA], F.lit(8).alias("n_extra"))
    back = bed.sound(bed.parse(bed.format_bed(c)))
    return back.select("name", "gene_id", "chrom", "strand", "tx_start", "tx_end", F.size("exons").cast("long").alias("exons"))


@query("SELECT c.name, gene AS gene_id, chrom, strand, tx_start, tx_end, CAST(n AS BIGINT) AS exons FROM cat c")
def gtf_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Tracks written as GTF lines and assembled again from the exon lines."""
    back = bed.parse_annotation(bed.format_gtf(S.catalog(spark, d)).select("value")).where("error IS NULL")
    return back.select("name", "gene_id", "chrom", "strand", "tx_start", "tx_end", F.size("exons").cast("long").alias("exons"))


@query("SELECT rd.name, CAST(sum(x.e - x.s) AS BIGINT) AS exon_bases, CAST(count(*) AS BIGINT) AS exons, CAST(min(x.s) AS BIGINT) AS first, CAST(max(x.e) AS BIGINT) AS last FROM rd JOIN rd_x x ON x.name = rd.name GROUP BY 1")
def alignment_exons(spark: SparkSession, d: str) -> DataFrame:
    """Reads written as alignments (start, CIGAR with clips and insertions) and turned into exons again."""
    from ..functions.sequence import cigar_exons

    body = F.array_join(F.transform(F.sequence(F.lit(0), F.size("exons") - 1), lambda i: F.concat((F.get(F.col("exons"), i)["end"] - F.get(F.col("exons"), i)["start"] - 1).cast("string"), F.lit("M2I1D"), F.when(i < F.size("exons") - 1, F.concat((F.get(F.col("exons"), i + 1)["start"] - F.get(F.col("exons"), i)["end"]).cast("string"), F.lit("N"))).otherwise(F.lit("5S")))), "")
    x = S.reads(spark, d).select("name", cigar_exons(F.col("tx_start"), F.concat(F.lit("3S"), body)).alias("x"))
    return _long(x.select("name", G.total("x").alias("exon_bases"), F.size("x").alias("exons"), F.get(F.col("x"), 0)["start"].alias("first"), F.element_at("x", -1)["end"].alias("last")), "exons")


@query(""", q AS (SELECT doc_id, translate(regexp_replace(upper(text), '[^ACGT]', '', 'g'), 'x', '') AS s FROM documents)
SELECT doc_id, CAST(len(list_filter(range(1, length(s) - 3), lambda i: regexp_matches(substr(s, i, 5), '^[AGT][AG]AC[ACT]$'))) AS BIGINT) AS sites FROM q WHERE length(s) >= 5""")
def motif_sites(spark: SparkSession, d: str) -> DataFrame:
    """Overlapping motif hits in the letters of texts that are bases."""
    from ..functions.sequence import motif_pattern

    s = F.regexp_replace(F.upper("text"), "[^ACGT]", "")
    q = S.table(spark, d, "documents").select("doc_id", s.alias("s")).where(F.length("s") >= 5)
    return q.select("doc_id", F.regexp_count("s", F.lit(motif_pattern("DRACH"))).cast("long").alias("sites"))


@query(""", q AS (SELECT doc_id, regexp_replace(upper(text), '[^ACGT]', '', 'g') AS s FROM documents),
p AS (SELECT 'd' || doc_id AS chrom, (doc_id * 37) % 500 AS pos, CASE WHEN doc_id % 2 = 0 THEN '+' ELSE '-' END AS strand, s FROM q)
SELECT chrom, pos, strand, CASE WHEN pos < length(s) THEN CASE strand WHEN '+' THEN substr(s, pos + 1, 1) ELSE translate(substr(s, pos + 1, 1), 'ACGT', 'TGCA') END END AS base FROM p""")
def oriented_bases(spark: SparkSession, d: str) -> DataFrame:
    """Reference bases at sites, from sequence text cut into chunk rows."""
    from ..sources.tables import bases_at, fasta_chunks

    q = S.table(spark, d, "documents").select("doc_id", F.regexp_replace(F.upper("text"), "[^ACGT]", "").alias("s"))
    head = q.select(F.col("doc_id").cast("string").alias("file"), F.lit(0).alias("line_no"), F.concat(F.lit(">d"), "doc_id", F.lit(" text")).alias("value"))
    body = q.select(F.col("doc_id").cast("string").alias("file"), F.posexplode(F.regexp_extract_all("s", F.lit(".{1,60}"), 0)).alias("k", "value")).select("file", (F.col("k") + 1).alias("line_no"), "value")
    sites = q.select(F.concat(F.lit("d"), "doc_id").alias("chrom"), ((F.col("doc_id") * 37) % 500).alias("pos"), F.when(F.col("doc_id") % 2 == 0, "+").otherwise("-").alias("strand"))
    return bases_at(sites, fasta_chunks(head.unionByName(body), 100), 100)


BASES = """, q AS (SELECT doc_id, doc_id % 2 = 1 AS rev, regexp_replace(upper(text), '[^ACGT]', '', 'g') AS s FROM documents WHERE text IS NOT NULL),
b AS (SELECT doc_id, rev, s, unnest(range(1, length(s) + 1)) AS i FROM q),
c AS (SELECT doc_id, rev, i, row_number() OVER (PARTITION BY doc_id ORDER BY CASE WHEN rev THEN -i ELSE i END) - 1 AS k FROM b WHERE substr(s, i, 1) = CASE WHEN rev THEN 'T' ELSE 'A' END),
o AS (SELECT doc_id, rev, i + doc_id % 1000 - 1 + CASE WHEN i > 20 THEN 7 ELSE 0 END AS pos0, CASE WHEN k % 2 = 1 THEN 'explicit_probability' WHEN doc_id % 3 = 2 THEN 'unknown' ELSE 'implicit_below_emission_threshold' END AS state,
CASE WHEN k % 2 = 1 THEN ((k // 2 * 37 + doc_id) % 256 + 0.5) / 256 END AS p FROM c WHERE i <= 20 OR i > 25)
"""


@query(BASES + """SELECT 'S::d' || doc_id AS read_id, CASE WHEN rev THEN '-' ELSE '+' END AS strand, state AS observation_state, count(*) AS calls, sum(pos0)::BIGINT AS places, round(sum(p), 6) AS probability FROM o GROUP BY ALL""")
def modification_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Letters of texts as aligned reads with MM, ML and MN tags: every second A of a read is listed, the rest is told by the flag."""
    from ..sources.modbam import Target, import_calls

    q = S.table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.regexp_replace(F.upper("text"), "[^ACGT]", "").alias("s")).where("s <> ''")
    reverse = F.col("doc_id") % 2 == 1
    listed = F.floor(F.regexp_count("s", F.when(reverse, "T").otherwise("A")) / 2).cast("int")
    n, flag = F.length("s"), F.element_at(F.array(F.lit(""), F.lit("."), F.lit("?")), (F.col("doc_id") % 3 + 1).cast("int"))
    byte = lambda k: F.lpad(F.hex((k * 37 + F.col("doc_id")) % 256), 2, "0")
    ml = F.unhex(F.array_join(F.transform(F.when(listed > 0, F.sequence(F.lit(0), listed - 1)).otherwise(F.array().cast("array<int>")), byte), ""))
    # 20 aligned letters, 5 inserted ones, 12 skipped places, the rest aligned.
    cigar = F.when(n <= 20, F.concat(n, F.lit("M"))).when(n <= 25, F.concat(F.lit("20M"), n - 20, F.lit("I"))).otherwise(F.concat(F.lit("20M5I12N"), n - 25, F.lit("M")))
    rows = q.select(
        F.lit("x").alias("path"), F.concat(F.lit("d"), "doc_id").alias("name"), F.when(reverse, 16).otherwise(0).alias("flag"), F.lit("chr1").alias("chrom"), (F.col("doc_id") % 1000).alias("start"), F.lit(60).alias("mapq"), cigar.alias("cigar"), F.col("s").alias("seq"),
        F.concat(F.lit("A+a"), flag, F.repeat(F.lit(",1"), listed), F.lit(";")).alias("mm"), ml.alias("ml"), n.cast("long").alias("mn"), F.lit(None).cast("string").alias("tag_fault"), F.lit(1 << 40).alias("chrom_length"),
    )
    calls = import_calls(rows, "m", "S", Target("A+a")).observations
    return _round(calls.groupBy("read_id", "strand", "observation_state").agg(F.count("*").alias("calls"), F.sum("pos0").alias("places"), F.sum("probability").alias("probability")), "probability")


@query("""SELECT event_id AS read_id, CASE CAST(floor(value) AS BIGINT) % 4 WHEN 0 THEN 'anchor_not_found' WHEN 1 THEN 'estimation_failed' ELSE 'estimated' END AS status,
CASE WHEN CAST(floor(value) AS BIGINT) % 4 > 1 THEN (CAST(floor(value) AS BIGINT) % 4 - 1)::DOUBLE END AS length FROM events""")
def tail_tags(spark: SparkSession, d: str) -> DataFrame:
    from ..sources.tables import dorado_tails

    tag = F.floor("value") % 4 - 1
    status, length = dorado_tails(tag)
    return S.table(spark, d, "events").select(F.col("event_id").alias("read_id"), status.alias("status"), length.alias("length"))


@query("""SELECT rd.name AS read_id, split_part(rd.sample || '::' || rd.name, '::', 1) AS sample, count(*) OVER (PARTITION BY rd.sample) AS reads FROM rd""")
def tagged_reads(spark: SparkSession, d: str) -> DataFrame:
    """Reads of all samples pooled under sample::read names and split again."""
    from ..sources.tables import split_tag, union_samples

    r = S.reads(spark, d)
    pooled = union_samples({str(s): r.where(F.col("sample") == s).drop("sample") for s in range(8)})
    sample, read = split_tag(F.concat_ws("::", "sample", "name"))
    return pooled.select(read.alias("read_id"), sample.alias("sample")).withColumn("reads", F.count("*").over(Window.partitionBy("sample")))


NEAR = """, ri AS (SELECT name, e AS s, lead(s) OVER (PARTITION BY name ORDER BY i) AS e FROM rd_x), ci AS (SELECT name, e AS s, lead(s) OVER (PARTITION BY name ORDER BY i) AS e FROM cat_x),
pr AS (SELECT r.name AS a, c.name AS b FROM rd r JOIN cat c ON r.chrom = c.chrom AND r.strand = c.strand AND r.tx_start < c.tx_end AND c.tx_start < r.tx_end),
xo AS (SELECT pr.a, pr.b, sum(least(x.e, y.e) - greatest(x.s, y.s)) AS ex FROM pr JOIN rd_x x ON x.name = pr.a JOIN cat_x y ON y.name = pr.b AND x.s < y.e AND y.s < x.e GROUP BY ALL),
io AS (SELECT pr.a, pr.b, sum(least(x.e, y.e) - greatest(x.s, y.s)) AS it FROM pr JOIN ri x ON x.name = pr.a JOIN ci y ON y.name = pr.b AND x.s < y.e AND y.s < x.e GROUP BY ALL),
ra AS (SELECT name, sum(e - s) AS x FROM rd_x GROUP BY 1), rb AS (SELECT name, sum(e - s) AS x FROM cat_x GROUP BY 1), ia AS (SELECT name, coalesce(sum(e - s), 0) AS x FROM ri GROUP BY 1), ib AS (SELECT name, coalesce(sum(e - s), 0) AS x FROM ci GROUP BY 1),
ds AS (SELECT xo.a, xo.b, ex, coalesce(it, 0) AS it, ra.x AS xa, rb.x AS xb, ia.x AS na, ib.x AS nb FROM xo LEFT JOIN io ON io.a = xo.a AND io.b = xo.b JOIN ra ON ra.name = xo.a JOIN rb ON rb.name = xo.b JOIN ia ON ia.name = xo.a JOIN ib ON ib.name = xo.b)
SELECT b AS isoform_id, count(*) AS reads FROM ds WHERE (1 - ex / (xa + xb - ex) + 0.5 * CASE WHEN na = 0 OR nb = 0 THEN 0 ELSE 1 - it / greatest(na + nb - it, 1) END) / 1.5 <= 0.05
OR (1 - ex / least(xa, xb) + 0.5 * CASE WHEN na = 0 OR nb = 0 THEN 0 ELSE 1 - it / greatest(least(na, nb), 1) END) / 1.5 <= 0.01 GROUP BY 1"""


@query(NEAR)
def overlap_assignment(spark: SparkSession, d: str) -> DataFrame:
    mapping, _ = clustering.overlap_assign(S.reads(spark, d), S.catalog(spark, d))
    return mapping.groupBy("isoform_id").agg(F.count("*").alias("reads"))


@query()
def flow_usage(spark: SparkSession, d: str) -> DataFrame:
    """The whole path from raw reads to usage per sample."""
    from .flow import run

    return _round(run(S.reads(spark, d), S.catalog(spark, d), results=("usage",))["usage"], "count", "proportion", "gene_total")


@query()
def flow_classes(spark: SparkSession, d: str) -> DataFrame:
    from .flow import run

    return run(S.reads(spark, d), S.catalog(spark, d), results=("classes12",))["classes12"].groupBy("class").agg(F.count("*").alias("isoforms"))


@query(""", el AS (SELECT event_id, CASE event_id % 9 WHEN 0 THEN 'structurally_absent' WHEN 1 THEN 'context_dependent' WHEN 2 THEN 'reference_base_mismatch' WHEN 3 THEN 'unprojectable' ELSE 'present' END AS st,
event_id % 10 <> 0 AS complete, event_id % 11 = 0 AS join_low, user_id % 5 AS unk, event_id % 4 AS imp, user_id % 2 = 0 AS ic, event_id % 13 <> 0 AS cov, event_id % 17 <> 0 AS refc, event_id % 19 <> 0 AS ver, user_id % 60 AS nc, user_id % 60 // 2 AS ncall, user_id % 60 // 2 + 5 AS ncand FROM events)
SELECT event_id, CASE WHEN st = 'structurally_absent' THEN 'site_absent' WHEN st <> 'present' THEN st WHEN NOT complete THEN 'incomplete_candidate_universe' WHEN join_low THEN 'join_rate_low' WHEN unk > 3 OR (imp > 2 AND NOT ic) THEN 'unknown_denominator'
WHEN NOT cov THEN 'coverage_unavailable' WHEN NOT refc THEN 'reference_unvalidated' WHEN NOT ver THEN 'provenance_unverified' WHEN nc < 10 THEN 'low_covering' WHEN ncall < 10 THEN 'low_callable' WHEN ncand < 0.6 * nc THEN 'low_candidate_rate' WHEN ncall < 0.495 * nc THEN 'low_callable_rate' ELSE 'ok' END AS reason FROM el""")
def eligibility_reasons(spark: SparkSession, d: str) -> DataFrame:
    e = S.table(spark, d, "events")
    k, half = F.col("event_id"), F.floor(F.col("user_id") % 60 / 2)
    state = F.when(k % 9 == 0, "structurally_absent").when(k % 9 == 1, "context_dependent").when(k % 9 == 2, "reference_base_mismatch").when(k % 9 == 3, "unprojectable").otherwise("present")
    rows = e.select(
        k, state.alias("site_state"), (k % 10 != 0).alias("complete"), (k % 11 == 0).alias("join_low"), F.greatest(F.col("user_id") % 5 - 3, F.lit(0)).alias("n_unknown_source"), F.greatest(k % 4 - 2, F.lit(0)).alias("n_implicit"),
        (F.col("user_id") % 2 == 0).alias("implicit_callable"), (k % 13 != 0).alias("has_coverage"), (k % 17 != 0).alias("reference_checked"), (k % 19 != 0).alias("verified"), (F.col("user_id") % 60).alias("n_covering"), (half + 5).alias("n_candidate"), half.alias("n_callable"),
    )
    return rows.select("event_id", modification.eligibility(True, 10, 10, 0.6, 0.495).alias("reason"))


@query()
def structural_description(spark: SparkSession, d: str) -> DataFrame:
    """Reads described in words against the nearest reference of the genes they overlap."""
    return description.describe(_named(spark, d), S.catalog(spark, d)).select("isoform_id", "gene", "ref_id", "miss", "extra", "class4")


def _named(spark: SparkSession, d: str) -> DataFrame:
    r = S.reads(spark, d)
    genes = interval.assign_genes(r, S.catalog(spark, d)).withColumnRenamed("genes", "gene_id")
    return r.drop("gene_id", "sample", "part", "score", "instance_id", "molecule").join(genes, "name")


@query()
def twelve_classes(spark: SparkSession, d: str) -> DataFrame:
    named, refs = clustering.cut(_named(spark, d)), S.catalog(spark, d)  # described, and asked for fusions
    none = refs.where("false").select(F.col("name").alias("isoform_id"))
    return description.class12(description.describe(named, refs), description.fusions(named, refs), none)


STUDY = """, ev AS (SELECT event_id, user_id AS u, 's' || (event_id % 4) AS sample, CASE WHEN event_id % 13 <> 0 THEN CASE WHEN event_id // 4 % 2 = 0 THEN 'a' ELSE 'b' END END AS k, least(value / 200, 1.0) AS p,
CASE WHEN event_id % 7 = 0 THEN 'i' WHEN event_id % 501 = 0 THEN 'n' ELSE 'e' END AS state FROM events),
ct AS (SELECT u, sample, k, count(*) AS cand, count(*) FILTER (WHERE state = 'e' AND p >= 0.5) AS up, count(*) FILTER (WHERE state = 'e' AND p < 0.5) + count(*) FILTER (WHERE state = 'i') AS down,
count(*) FILTER (WHERE state = 'n') AS unk FROM ev WHERE k IS NOT NULL GROUP BY ALL),
gr AS (SELECT u, sample, k FROM (SELECT DISTINCT u FROM ct), (SELECT DISTINCT sample FROM ev), (SELECT unnest(['a', 'b']) AS k)),
st AS (SELECT gr.u, gr.sample, gr.k, CASE WHEN gr.sample IN ('s0', 's1') THEN 'control' ELSE 'treated' END AS grp, gr.k = 'b' AND gr.u % 3 = 0 AS absent, coalesce(cand, 0) AS cand, coalesce(unk, 0) AS unk,
CASE WHEN gr.k = 'b' AND gr.u % 3 = 0 THEN 0 ELSE coalesce(up, 0) END AS m, CASE WHEN gr.k = 'b' AND gr.u % 3 = 0 THEN 0 ELSE coalesce(down, 0) END AS n FROM gr LEFT JOIN ct ON ct.u = gr.u AND ct.sample = gr.sample AND ct.k = gr.k),
ok AS (SELECT *, CASE WHEN absent THEN 'site_absent' WHEN unk > 0 THEN 'unknown_denominator' WHEN m + n < 1 THEN 'low_callable' ELSE 'ok' END AS reason, CASE WHEN NOT absent AND unk = 0 AND m + n > 0 THEN m / (m + n) END AS f FROM st)
"""


def _study(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return site_tables.aggregate(*S.study(spark, d))


@query(STUDY + """SELECT sample, grp AS "group", 'g' || u AS gene, u || k AS isoform_id, 'chr1:' || (u * 1000 + 110) || ':+' AS site_id, CASE WHEN absent THEN 'structurally_absent' ELSE 'present' END AS site_state,
cand AS n_assigned, cand AS n_candidate, m + n AS n_callable, m AS n_modified, n AS n_unmodified, cand - m - n AS n_unknown, round(f, 6) AS mod_fraction, reason AS eligibility_reason FROM ok""")
def site_table(spark: SparkSession, d: str) -> DataFrame:
    out = _study(spark, d)["sites"].select("sample", "group", "gene", "isoform_id", "site_id", "site_state", "n_assigned", "n_candidate", "n_callable", "n_modified", "n_unmodified", "n_unknown", "mod_fraction", "eligibility_reason")
    return _round(_long(out, "n_modified", "n_unmodified", "n_callable", "n_unknown"), "mod_fraction")


@query(STUDY + """, el AS (SELECT * FROM ok WHERE reason = 'ok'), pr AS (SELECT a.u, a.sample, a.grp, a.f - b.f AS d, a.m AS ma, a.n AS na, b.m AS mb, b.n AS nb FROM el a JOIN el b ON a.u = b.u AND a.sample = b.sample AND a.k = 'a' AND b.k = 'b'),
us AS (SELECT DISTINCT user_id AS u FROM events),
i1 AS (SELECT us.u, 'isoform_effect' AS t, count(d) AS n, avg(d) AS delta, CASE WHEN count(d) > 0 THEN (sum(ma) + 0.5) * (sum(nb) + 0.5) / ((sum(na) + 0.5) * (sum(mb) + 0.5)) END AS odds, NULL::DOUBLE AS inter, CASE WHEN count(d) > 0 THEN 'ok' ELSE 'no_shared_eligible_samples' END AS reason
FROM us LEFT JOIN pr ON pr.u = us.u GROUP BY us.u),
c0 AS (SELECT us.u, count(f) AS n, avg(f) FILTER (WHERE grp = 'treated') - avg(f) FILTER (WHERE grp = 'control') AS delta,
(sum(m) FILTER (WHERE grp = 'treated') + 0.5) * (sum(el.n) FILTER (WHERE grp = 'control') + 0.5) / ((sum(el.n) FILTER (WHERE grp = 'treated') + 0.5) * (sum(m) FILTER (WHERE grp = 'control') + 0.5)) AS odds FROM us LEFT JOIN el ON el.u = us.u AND k = 'a' GROUP BY us.u),
x0 AS (SELECT us.u, count(d) AS n, avg(d) FILTER (WHERE grp = 'treated') - avg(d) FILTER (WHERE grp = 'control') AS inter FROM us LEFT JOIN pr ON pr.u = us.u GROUP BY us.u),
al AS (SELECT * FROM i1 UNION ALL SELECT u, 'condition_effect', n, delta, odds, NULL, CASE WHEN delta IS NULL THEN 'missing_eligible_group' ELSE 'ok' END FROM c0
UNION ALL SELECT u, 'isoform_condition_interaction', n, NULL, NULL, inter, CASE WHEN inter IS NULL THEN 'missing_paired_group' ELSE 'ok' END FROM x0)
SELECT t AS contrast_type, 'g' || u AS gene, n AS n_eligible_samples, round(delta, 6) AS delta_fraction, round(odds, 6) AS odds_ratio, round(inter, 6) AS interaction_delta, reason AS eligibility_reason FROM al""")
def site_contrasts(spark: SparkSession, d: str) -> DataFrame:
    """Three requests for each gene: isoform a against b, the groups of a, and their interaction."""
    u = S.table(spark, d, "events").select("user_id").distinct()
    text = lambda c: F.col(c).cast("string") if c else F.lit(None).cast("string")
    a, b = F.concat(text("user_id"), F.lit("a")), F.concat(text("user_id"), F.lit("b"))
    low, high, no = F.lit("control"), F.lit("treated"), text(None)
    ask = [("isoform_effect", b, no, no), ("condition_effect", no, low, high), ("isoform_condition_interaction", b, low, high)]
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("contrast_type"), x.alias("isoform_b"), g.alias("group_a"), h.alias("group_b")) for k, x, g, h in ask])).alias("x")
    specs = u.select(F.lit("m").alias("assay_id"), F.concat(F.lit("g"), "user_id").alias("gene"), F.concat(F.lit("chr1:"), F.col("user_id") * 1000 + 110, F.lit(":+")).alias("site_id"), F.lit("A+a").alias("mod_code"), a.alias("isoform_a"), each)
    out = site_tables.contrasts(_study(spark, d)["design"], specs.select("assay_id", "gene", "site_id", "mod_code", "isoform_a", "x.*"))
    return _round(out.select("contrast_type", "gene", "n_eligible_samples", "delta_fraction", "odds_ratio", "interaction_delta", "eligibility_reason"), "delta_fraction", "odds_ratio", "interaction_delta")


@query("""SELECT name, CASE WHEN id % 50 = 0 THEN 2 ELSE 1 END AS records, CASE WHEN id % 50 = 0 THEN CASE WHEN id % 100 = 0 THEN 'tx_end' ELSE 'gene_id,tx_end' END ELSE '' END AS columns FROM cat""")
def catalog_merge(spark: SparkSession, d: str) -> DataFrame:
    """Catalogs of parts put together: a third of all isoforms is in two of them, and every fiftieth differs there."""
    c = S.catalog(spark, d).drop("n", "score")
    other = F.col("id") % 50 == 0
    again = c.where((F.col("id") % 3 == 0) | other).withColumn("tx_end", F.col("tx_end") + F.when(other, 1).otherwise(0)).withColumn("gene_id", F.when(other & (F.col("id") % 100 != 0), F.lit(None)).otherwise(F.col("gene_id")))
    catalog, conflicts = identity.merge_catalogs(c.unionByName(again).drop("id"))
    return catalog.select("name", F.lit(1).alias("records"), F.lit("").alias("columns")).unionByName(conflicts)
