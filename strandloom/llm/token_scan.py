"""Token counts by a separator scan over flat, unindexed token files.

A flat file is a run of fixed-width ids with an end-of-document id after each document, and has
no index.  Files are cut into blocks of equal size; each block is searched for the separator
with one vectorised comparison.  A document may span any number of blocks: per file, a prefix scan over
the blocks' summaries (separators so far, place of the last one) tells where a block's first document
began and which number it has.

Counting reads every block twice, in bounded memory: once for its summary (how many documents end in
it, where the last one does) and, when the scan has told what lies before, for its documents.  Only summaries
are shuffled: one row a block, whatever the number of documents.

Defined results: an empty document counts 0 tokens; what stands after the last separator is one more
document, with ``terminated`` false; an empty file has no documents; a size that is no multiple of the id
width is an error, as is an id or separator that the width cannot hold.  Files are written below the shared folder under names of one attempt each, and
only those of finished tasks are listed, so a lost executor leaves no half file in the result.
Null texts count as empty; repeated ids and rows are counted one by one; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .best_fit import _encoder
from .common import materialize, shared_dir, with_id

BLOCK = 1 << 20  # ids in a block


def write_files(docs: DataFrame, vocabulary: str, pattern: str, end_id: int, dtype: str = "<u2") -> DataFrame:
    """Tokenise into flat files in the shared folder, one a task: path, ordinal, doc_id of each document."""
    spark = docs.sparkSession
    where = shared_dir(spark, "tokens")
    with open(vocabulary, "rb") as f:
        raw = f.read()
    greatest = max(end_id, *(int(line.split()[1]) for line in raw.splitlines() if line))
    if greatest > np.iinfo(dtype).max:
        raise ValueError(f"id {greatest} does not fit into {dtype}")
    if any(int(line.split()[1]) == end_id for line in raw.splitlines() if line):
        raise ValueError(f"{end_id} is the id of a token and cannot end documents")
    table = spark.sparkContext.broadcast(raw)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        enc = _encoder(table.value, pattern, {})
        store, folder = fs.FileSystem.from_uri(where)
        store.create_dir(folder)
        name, n = f"{uuid.uuid4().hex}.ids", 0
        with store.open_output_stream(f"{folder}/{name}") as out:
            for b in batches:
                for text in b["t"]:
                    out.write(np.append(enc.encode_to_numpy(text), end_id).astype(dtype).tobytes())
                yield pd.DataFrame({"path": f"{where}/{name}", "ordinal": range(n, n + len(b)), "doc_id": b["doc_id"]})
                n += len(b)

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("t"))
    return materialize(with_id(rows.mapInPandas(run, "path string, ordinal long, doc_id string"), kind), "token-files")


def count_tokens(files: DataFrame, end_id: int, dtype: str = "<u2", block: int = BLOCK) -> DataFrame:
    """path, ordinal, start, n_tokens, terminated of every document in ``files`` (path)."""
    width = np.dtype(dtype).itemsize

    def sizes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for b in batches:
            rows = []
            for path in b["path"]:
                store, name = fs.FileSystem.from_uri(path)
                size = store.get_file_info(name).size
                if size % width:
                    raise ValueError(f"{path}: its size is no multiple of {width}")
                rows += [(path, k, k * block, size // width) for k in range(-(-size // (block * width)))]
            yield pd.DataFrame(rows, columns=["path", "block", "first", "total"])

    def searched(path: str, first: int, total: int) -> tuple[np.ndarray, bool]:
        """The ends of the documents that end in a block, and whether the file's last one lacks its separator."""
        from pyarrow import fs

        store, name = fs.FileSystem.from_uri(path)
        n = min(block, total - first)
        with store.open_input_file(name) as f:
            ids = np.frombuffer(f.read_at(n * width, first * width), dtype)
        ends = np.flatnonzero(ids == end_id) + first
        open_end = first + n == total and (not len(ends) or ends[-1] != total - 1)
        return (np.append(ends, total) if open_end else ends), open_end

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, k, first, total in b.itertuples(index=False):
                ends, _ = searched(path, first, total)
                rows.append((path, k, first, total, len(ends), int(ends[-1]) if len(ends) else -1))
            yield pd.DataFrame(rows, columns=["path", "block", "first", "total", "n", "last"])

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, first, total, seen, carry in b.itertuples(index=False):
                ends, open_end = searched(path, first, total)
                start = np.append(carry, ends[:-1]) + 1 if len(ends) else ends
                done = np.ones(len(ends), bool)
                done[len(ends) - 1 :] = not open_end
                yield pd.DataFrame({"path": path, "ordinal": seen + np.arange(len(ends)), "start": start, "n_tokens": ends - start, "terminated": done})

    blocks = files.select("path").distinct().mapInPandas(sizes, "path string, block long, first long, total long")
    found = blocks.repartition("path", "block").mapInPandas(summarise, "path string, block long, first long, total long, n long, last long")
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # Ends grow along a file, so the greatest so far is the last one.
    carried = found.select("path", "first", "total", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("seen"), F.coalesce(F.max("last").over(before), F.lit(-1)).alias("carry"), "n")
    dealt = materialize(carried.where("n > 0").drop("n"), "block-carries").repartition("path", "first")
    return dealt.mapInPandas(documents, "path string, ordinal long, start long, n_tokens long, terminated boolean")


def token_counts(docs: DataFrame, vocabulary: str, pattern: str, end_id: int, dtype: str = "<u2", block: int = BLOCK) -> DataFrame:
    """doc_id, n_tokens, path, ordinal, start of every document, counted in its flat file."""
    listed = write_files(docs, vocabulary, pattern, end_id, dtype)
    counted = count_tokens(listed, end_id, dtype, block)
    # Both sides grow with the data and have one row a document, so neither is broadcast.
    return counted.join(listed.hint("merge"), ["path", "ordinal"]).select("doc_id", "n_tokens", "path", "ordinal", "start")
