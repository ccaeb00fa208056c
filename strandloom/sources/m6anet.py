"""m6Anet calls: reads' site probabilities on transcripts, reconciled with the read map, annotation and site tables.

Every table meets the calls in an outer join by its key, so each row is told as matched, lacking on one side or of
another value; anything but a match is an error that names the first such row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.sequence import BASES, unversioned
from ..operators.clustering import cut
from . import annotation
from .lines import numbered
from .modbam import assay_json
from .tables import EXPLICIT, OBSERVATION_COLUMNS, _must

INDIVIDUAL = "transcript_id string, transcript_position string, read_index string, probability_modified string"
READ_MAP = "read_index string, read_id string"
DATA_INFO = "transcript_id string, transcript_position string, start string, end string, n_reads string"
SITE_PROBABILITY = "transcript_id string, transcript_position string, n_reads string, probability_modified string, kmer string, mod_ratio string"
# The published read thresholds of the two models, and the site threshold.
READ_THRESHOLDS = {"hct116_rna002": 0.033379376, "arabidopsis": 0.0032978046219796, "arabidopsis_rna002": 0.0032978046219796}
SITE_THRESHOLD = 0.9
SITE = ["transcript_id", "pos"]


def _csv(spark: SparkSession, path: str, schema: str, sep: str, what: str) -> DataFrame:
    """The rows as text; another header or number of fields ends the job, and so does an empty field."""
    names = [c.split()[0] for c in schema.split(", ")]
    found = (spark.read.text(path).head() or [""])[0].rstrip("\r").split(sep)
    if found != names:
        raise ValueError(f"{what} {path} header mismatch: expected {names}, found {found}")
    rows = spark.read.csv(path, schema=schema, sep=sep, header=True, enforceSchema=True, mode="FAILFAST", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    token = lambda c: F.col(c).isNull() | F.col(c).isin("", "NA") | (F.trim(c) != F.col(c)) | F.col(c).rlike(r"\p{Cntrl}")
    return _must(rows, F.greatest(*[token(c) for c in names], F.lit(False)), f"{what}: a field is empty, NA or not trimmed")


def _whole(rows: DataFrame, name: str, to: str, what: str, least: int = 0) -> DataFrame:
    return _must(rows.withColumn(to, F.col(name).try_cast("long")), F.col(to).isNull() | (F.col(to) < least), f"{what}: {name} is not a whole number of {least} or more")


def _unit(rows: DataFrame, name: str, to: str, what: str) -> DataFrame:
    return _must(rows.withColumn(to, F.col(name).try_cast("double")), ~F.coalesce(F.col(to).between(0, 1), F.lit(False)), f"{what}: {name} is not in 0..1")


def motif(rule: str) -> str:
    word = rule.upper().replace("U", "T")
    if not 3 <= len(word) <= 31 or len(word) % 2 == 0 or set(word) - set(BASES) or word[len(word) // 2] != "A":
        raise ValueError(f"candidate rule {rule!r} is no odd motif of 3 to 31 bases with A in its middle")
    return word


def _first(bad: DataFrame, say: Column) -> None:
    """End with the first row of ``bad``."""
    if row := bad.orderBy(*SITE).select(say.alias("said")).head():
        raise ValueError(row.said)


def transcripts(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """Transcripts of an annotation with the ids of ``wanted`` (transcript_id), or those ids in another version."""
    rows = annotation.features(numbered(spark, path))
    if first := rows.where("fault IS NOT NULL").select("path", "line", "fault").orderBy("path", "line").head():
        raise ValueError(f"annotation {first.path}:{first.line}: {first.fault}")
    base = wanted.select(unversioned(F.col("transcript_id")).alias("base")).distinct()
    own = rows.where("feature IN ('exon', 'transcript')").withColumn("id", F.explode("ids")).withColumn("base", unversioned(F.col("id"))).join(base, "base", "left_semi")
    own = own.withColumn("ids", F.array("id")).drop("id", "base")
    if not own.where("feature = 'exon'").limit(1).count():
        return spark.createDataFrame([], "name string, gene_id string, chrom string, strand string, tx_start long, tx_end long, exons array<struct<start:long,end:long>>")
    return annotation.build(own, skip=False)[0]


def run(
    spark: SparkSession, indiv: str, read_map: str, reference: str, assay: str, sample: str, model: str, version: str = "unknown", rule: str = "DRACH",
    data_info: str | None = None, site_proba: str | None = None, least_reads: int | None = None, read_threshold: float | None = None,
) -> tuple[DataFrame, str, dict[str, object]]:
    """(observations, assay metadata as JSON, audit) of one sample's m6Anet output."""
    word = motif(rule)
    limit = READ_THRESHOLDS.get(model.lower()) if read_threshold is None else read_threshold
    if limit is not None and not 0 <= limit <= 1:
        raise ValueError("the read threshold is not in 0..1")
    what = "m6Anet data.indiv_proba"
    raw = _unit(_whole(_csv(spark, indiv, INDIVIDUAL, ",", what), "transcript_position", "pos", what), "probability_modified", "p", what)
    raw = cut(raw.select("transcript_id", "pos", "read_index", "p"))
    total = raw.count()
    if not total:
        raise ValueError(f"{what} {indiv} contains no observations")
    # The read map: one index and one read each.
    ids = _csv(spark, read_map, READ_MAP, "\t", "m6Anet read map")
    side = F.substring_index("read_id", "::", 1)
    tagged = F.when(F.col("read_id").contains("::"), F.col("read_id")).otherwise(F.concat(F.lit(f"{sample}::"), "read_id"))
    ids = _must(ids, F.col("read_id").contains("::") & ((side != sample) | F.col("read_id").endswith("::")), "a mapped read has another sample prefix")
    ids = cut(ids.select("read_index", tagged.alias("read_id")))
    entries = ids.count()
    if not entries:
        raise ValueError(f"m6Anet read map {read_map} contains no mappings")
    for key in ("read_index", "read_id"):
        if again := ids.groupBy(key).count().where("count > 1").orderBy(key).head():
            raise ValueError(f"m6Anet read map {read_map}: duplicate {key} {again[0]}")
    known = cut(transcripts(spark, reference, raw))
    found = raw.join(ids, "read_index", "left").join(known.select(F.col("name").alias("transcript_id"), "chrom", "strand", "exons"), "transcript_id", "left")
    _first(found.where("read_id IS NULL"), F.concat(F.lit("read_index "), "read_index", F.lit(f" is missing from the read map {read_map}")))
    other = known.select(unversioned(F.col("name")).alias("base"), F.col("name").alias("has")).groupBy("base").agg(F.min("has").alias("has"))
    lost = found.where("exons IS NULL").withColumn("base", unversioned(F.col("transcript_id"))).join(other, "base", "left")
    _first(lost, F.when(F.col("has").isNotNull(), F.concat(F.lit("transcript version mismatch: m6Anet has "), "transcript_id", F.lit(", the annotation "), "has")).otherwise(F.concat(F.lit("m6Anet transcript "), "transcript_id", F.lit(" is absent from the annotation"))))
    placed = cut(found.withColumn("pos0", F.when(F.col("strand") != ".", G.spliced_to_genomic(F.col("pos"), "exons", "strand"))).drop("exons"))
    _first(placed.where("strand = '.'"), F.concat(F.lit("m6Anet transcript "), "transcript_id", F.lit(" has unknown strand")))
    _first(placed.where("pos0 IS NULL"), F.concat(F.lit("m6Anet transcript_position "), "pos", F.lit(" is out of bounds for transcript "), "transcript_id"))
    same = F.struct("p", "transcript_id", "pos")
    calls = placed.groupBy("read_id", "chrom", "pos0", "strand").agg(F.min(same).alias("low"), F.max(same).alias("high"))
    calls = cut(calls.select("read_id", "chrom", "pos0", "strand", "low.*", (F.col("low") != F.col("high")).alias("conflict")))
    _first(calls.where("conflict"), F.concat(F.lit("conflicting duplicate of read "), "read_id", F.lit(" at "), "chrom", F.lit(":"), "pos0"))
    sites = cut(calls.groupBy(*SITE).agg(F.count("*").alias("observed"), F.count_if(F.col("p") >= (2.0 if limit is None else limit)).alias("over")))
    n = calls.count()
    audit = {"input_rows": total, "unique_observations": n, "duplicate_exact": total - n, "read_map_entries": entries, "read_map_entries_used": raw.select("read_index").distinct().count(), "source_transcripts": raw.select("transcript_id").distinct().count(), "projection_transcripts_loaded": known.count(), "source_sites": sites.count()}
    audit |= _data_info(spark, data_info, sites, known, least_reads) | _site_probability(spark, site_proba, sites, limit, word)
    text = lambda v: F.lit(v).cast("string")
    observations = calls.select(
        text(assay).alias("assay_id"), text(sample).alias("sample"), "read_id", "chrom", "pos0", "strand", text("A+a").alias("mod_code"), F.col("p").alias("probability"), text(EXPLICIT).alias("observation_state"), text(None).alias("context"),
        F.col("transcript_id").alias("source_transcript_id"), F.col("pos").alias("source_pos0"),
    ).select(*OBSERVATION_COLUMNS)
    filtered = {(True, True): f"m6anet_data_info_n_reads>={least_reads}", (True, False): "m6anet_data_info_retained_sites", (False, True): f"m6anet_min_reads={least_reads}_unverified_without_data_info", (False, False): "m6anet_retained_sites_unverified"}
    metadata = {
        "schema_version": 1, "assay_id": assay, "caller": "m6anet", "caller_version": version, "model_id": model, "chemistry": "RNA002", "candidate_rule": word, "source_emission_threshold": None, "source_site_filter": filtered[data_info is not None, least_reads is not None],
        "candidate_observations_complete": data_info is not None, "provenance_status": "user_declared", "implicit_skip_policy": "not_applicable", "coordinate_source": "m6anet_transcript_position_0_based_target_base_projected_via_annotation",
        "read_id_mapping": "explicit_read_index_read_id_map", "source_files": [p for p in (indiv, read_map, reference, data_info, site_proba) if p],
    }
    return observations, assay_json(metadata), audit


def _told(rows: DataFrame, sites: DataFrame, what: str) -> DataFrame:
    """Sites of a table beside the observed ones, in an outer join; a site listed twice is an error."""
    if again := rows.groupBy(*SITE).count().where("count > 1").orderBy(*SITE).head():
        raise ValueError(f"{what}: duplicate site {again.transcript_id}:{again.pos}")
    if not rows.limit(1).count():
        raise ValueError(f"{what} contains no sites")
    return cut(rows.withColumn("listed", F.lit(True)).join(sites, SITE, "full"))


def _at(what: str, *parts: object) -> Column:
    return F.concat(F.lit(f"{what}: site "), "transcript_id", F.lit(":"), "pos", *[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _data_info(spark: SparkSession, path: str | None, sites: DataFrame, known: DataFrame, least: int | None) -> dict[str, object]:
    names = ("sites", "retained_sites", "filtered_sites", "total_reads", "retained_reads", "minimum_reads")
    if path is None:
        return {f"data_info_{k}": "NA" for k in names}
    what = f"m6Anet data.info {path}"
    rows = _csv(spark, path, DATA_INFO, ",", what)
    for name, to, low in (("transcript_position", "pos", 0), ("start", "from", 0), ("end", "to", 0), ("n_reads", "n", 1)):
        rows = _whole(rows, name, to, what, low)
    rows = cut(_must(rows, F.col("to") <= F.col("from"), f"{what}: an end is not behind its start").select("transcript_id", "pos", "n"))
    both = rows.join(known.select(F.col("name").alias("transcript_id"), "strand", "exons"), "transcript_id", "left")
    _first(both.where(G.spliced_to_genomic(F.col("pos"), "exons", "strand").isNull()), _at(what, " is of no transcript of the annotation, or out of its bounds"))
    told = _told(rows, sites, what)
    _first(told.where("listed IS NULL"), _at(what, " is retained, but missing here"))
    _first(told.where("observed <> n"), _at(what, " has n_reads=", F.col("n"), ", but data.indiv_proba contains ", F.col("observed"), " rows"))
    if least is not None:
        _first(told.where((F.col("n") >= least) != F.col("observed").isNotNull()), _at(what, ": retained-site mismatch for n_reads=", F.col("n"), f" with minimum_reads={least}"))
    t = told.agg(F.count("*").alias("n"), F.count("observed").alias("kept"), F.sum("n").alias("reads"), F.coalesce(F.sum(F.when(F.col("observed").isNotNull(), F.col("n"))), F.lit(0)).alias("kept_reads")).first()
    return dict(zip((f"data_info_{k}" for k in names), (t.n, t.kept, t.n - t.kept, t.reads, t.kept_reads, "NA" if least is None else least)))


def _site_probability(spark: SparkSession, path: str | None, sites: DataFrame, limit: float | None, word: str) -> dict[str, object]:
    names = ("site_probability_sites", "site_probability_total_reads", "site_probability_sites_at_or_above_threshold", "site_probability_threshold", "read_probability_threshold")
    if path is None:
        return dict.fromkeys(names, "NA")
    what = f"m6Anet data.site_proba {path}"
    rows = _whole(_whole(_csv(spark, path, SITE_PROBABILITY, ",", what), "transcript_position", "pos", what), "n_reads", "n", what)
    rows = _unit(_unit(rows, "probability_modified", "p", what), "mod_ratio", "ratio", what)
    pattern = "^" + "".join(f"[{BASES[c]}]" for c in word) + "$"
    fits = F.replace(F.upper("kmer"), F.lit("U"), F.lit("T")).rlike(pattern)
    told = _told(rows.select("transcript_id", "pos", "n", "p", "ratio", "kmer", fits.alias("fits")), sites, what)
    _first(told.where("NOT fits"), _at(what, ": kmer ", F.col("kmer"), f" does not match candidate_rule {word}"))
    _first(told.where("observed IS NULL"), _at(what, " is absent from data.indiv_proba"))
    _first(told.where("observed <> n"), _at(what, " has n_reads=", F.col("n"), ", but data.indiv_proba contains ", F.col("observed"), " rows"))
    if limit is not None:
        _first(told.where(F.abs(F.col("over") / F.col("observed") - F.col("ratio")) > 1e-12), _at(what, " has mod_ratio=", F.col("ratio"), ", expected ", F.col("over") / F.col("observed")))
    _first(told.where("listed IS NULL"), _at(what, " is retained, but missing here"))
    t = told.agg(F.count("*").alias("n"), F.sum("n").alias("reads"), F.count_if(F.col("p") >= SITE_THRESHOLD).alias("high")).first()
    return dict(zip(names, (t.n, t.reads, t.high, SITE_THRESHOLD, "NA" if limit is None else limit)))
