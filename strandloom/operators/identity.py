"""Rules of ids, and catalogs put together from parts that may repeat records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G


def id_faults(tracks: DataFrame, reference: bool = False) -> DataFrame:
    """name, fault, n of ids that a catalog cannot have: empty ones, repeated ones and, for references, the form of made ids."""
    name = F.coalesce("name", F.lit(""))
    counted = tracks.groupBy(name.alias("name")).agg(F.count("*").alias("n"))
    made = F.lit(reference) & F.col("name").startswith(G.NOVEL)
    fault = F.when(F.trim("name") == "", "empty").when(F.col("n") > 1, "duplicate").when(made, "reserved")
    return counted.withColumn("fault", fault).where("fault IS NOT NULL").select("name", "fault", "n")


def merge_catalogs(parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(catalog, conflicts) of records with ``name``, such as the catalogs of all genes together.

    Equal records of a name are one (a reference of two genes is in both of their parts); NULLs are equal.  A name with
    different records is a conflict: name, records (how many), columns (those that differ, joined by ``,``).  One
    aggregate tells both, and each side of it combines before the shuffle, so a record in every part costs a row a task.
    """
    rest = [c for c in parts.columns if c != "name"]
    field = {c: F.to_json(F.struct(F.col(f"`{c}`").alias("v"))) for c in rest}
    record = F.struct(*[F.col(f"`{c}`") for c in rest])
    text = F.to_json(record)
    differs = [F.when(F.min(f) != F.max(f), F.lit(c)) for c, f in field.items()]
    g = parts.groupBy("name").agg(F.min_by(record, text).alias("record"), F.size(F.collect_set(F.xxhash64(text))).alias("records"), F.concat_ws(",", *differs).alias("columns"))
    catalog = g.where("columns = ''").select(*[F.col("name") if c == "name" else F.col("record").getField(c).alias(c) for c in parts.columns])
    return catalog, g.where("columns <> ''").select("name", "records", "columns")


def merged(parts: DataFrame) -> DataFrame:
    """The catalog of :func:`merge_catalogs`; a conflict or a fault of an id ends the job."""
    catalog, conflicts = merge_catalogs(parts)
    if first := conflicts.orderBy("name").head():
        raise ValueError(f"duplicate isoform id {first.name!r} describes {first.records} conflicting records that differ in {first['columns']}")
    if fault := id_faults(catalog).orderBy("name").head():
        raise ValueError(f"isoform id {fault.name!r}: {fault.fault}")
    return catalog
