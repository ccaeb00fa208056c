"""BAM files by byte ranges: records by a small block decoder in each task, everything after it as Columns.

A file is cut into ranges of ``RANGE`` bytes, which are rows; a task inflates one compressed block at a time, so
memory is bounded by a record, not by the file.  A range owns the records that start in its blocks and reads on to the
end of the last one.  Where the first of them starts is guessed from the bytes, and checked: the range before must
end its last record just there.  Ranges whose guess fails are followed again from the place that the check gives,
until all agree, so a wrong guess costs time and never changes records.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.sequence import cigar_blocks, cigar_exons, primary

RECORD = (
    "path string, name string, flag int, chrom string, start long, mapq int, cigar string, seq string, pt long, mm string, ml binary, mn long, "
    "tag_fault string, chrom_length long"
)
COLUMNS = [c.split()[0] for c in RECORD.split(", ")]
OPS, LETTERS = "MIDNSHP=X", "=ACMGRSVTWYHKDBN"
WIDTH = {"c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4, "A": 1}
KIND = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}
RANGE = 64 << 20
BLOCK = 1 << 16  # most bytes of a compressed block
HEAD = b"\x1f\x8b\x08\x04"
CHAIN = 5  # records that must look right one after the other for a guess
PART = 5000  # records, or
PART_BYTES = 16 << 20  # bytes of them, that go on together


def _block_size(head: bytes) -> int | None:
    """The size of the block that begins with ``head``, or None if none does."""
    if len(head) < 18 or head[:4] != HEAD:
        return None
    stop, at = 12 + struct.unpack_from("<H", head, 10)[0], 12
    while at + 6 <= min(stop, len(head)):
        n = struct.unpack_from("<H", head, at + 2)[0]
        if head[at : at + 2] == b"BC" and n == 2:
            return struct.unpack_from("<H", head, at + 4)[0] + 1
        at += 4 + n
    return None


def first_block(f, low: int, length: int) -> int:
    """Where the first block at or behind ``low`` starts; ``length`` of the file if there is none."""
    if low == 0:
        return 0
    f.seek(low)
    near, at = f.read(4 * BLOCK), -1
    while (at := near.find(HEAD, at + 1)) >= 0:
        size = _block_size(near[at : at + 64])
        if size is not None and (low + at + size == length or _block_size(near[at + size : at + size + 64]) is not None):
            return low + at
    return length


def _inflated(f, at: int, length: int) -> Iterator[tuple[int, bytes]]:
    """(place, content) of each block from ``at`` on."""
    while at < length:
        f.seek(at)
        head = f.read(64)
        size = _block_size(head)
        if size is None:
            raise ValueError("not a BAM block")
        body = head[:size] + f.read(max(0, size - len(head)))
        if len(body) < size:
            raise ValueError("the file ends within a block")
        first = 12 + struct.unpack_from("<H", body, 10)[0]
        yield at, zlib.decompress(body[first:-8], -15)
        at += size


class _Stream:
    """The inflated bytes from a range's first block on, of which ``limit`` are its own."""

    def __init__(self, f, low: int, high: int, length: int) -> None:
        self.blocks, self.high, self.buffer, self.at, self.limit = _inflated(f, first_block(f, low, length), length), high, bytearray(), 0, None

    def more(self) -> bool:
        at, block = next(self.blocks, (None, b""))
        if self.limit is None and (at is None or at >= self.high):
            self.limit = self.at + len(self.buffer)
        self.buffer += block
        return at is not None

    def own(self) -> bool:
        """Whether the next byte is the range's own."""
        while not self.buffer and self.limit is None:
            self.more()
        return self.limit is None or self.at < self.limit

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n:
            if not self.more():
                raise ValueError("the file ends within a record")
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        self.at += n
        return out

    def skip(self, n: int) -> None:
        while n > 0:
            if not self.buffer and not self.more():
                raise ValueError("the file ends within a record")
            part = min(n, len(self.buffer))
            del self.buffer[:part]
            self.at, n = self.at + part, n - part


def header(f, path: str, length: int) -> tuple[str, list[str], list[int], int]:
    """(text, reference names, their lengths, bytes of the whole header)."""
    s = _Stream(f, 0, length, length)
    if s.take(4) != b"BAM\1":
        raise ValueError(f"{path} is no BAM file")
    number = lambda: struct.unpack("<i", s.take(4))[0]
    text, names, sizes = s.take(number()).rstrip(b"\0").decode(errors="replace"), [], []
    for _ in range(number()):
        names.append(s.take(number())[:-1].decode())
        sizes.append(number())
    return text, names, sizes, s.at


def _plausible(data: bytearray, at: int, sizes: list[int]) -> int | None:
    """The place behind a record at ``at`` if one may start there; None if none can."""
    size, ref, pos, n_name, _, _, n_cigar, _, n_seq, next_ref, next_pos = struct.unpack_from("<iiiBBHHHiii", data, at)
    fixed = 32 + n_name + 4 * n_cigar + (n_seq + 1) // 2 + n_seq
    if size < fixed or n_seq < 0 or n_name < 1 or not -1 <= ref < len(sizes) or not -1 <= next_ref < len(sizes) or pos < -1 or next_pos < -1:
        return None
    if (ref >= 0 and pos > sizes[ref]) or (at + 36 + n_name <= len(data) and (data[at + 35 + n_name] != 0 or 0 in data[at + 36 : at + 35 + n_name])):
        return None
    return at + 4 + size


def _guess(s: _Stream, sizes: list[int]) -> int | None:
    """Where a record may first start among the range's own bytes."""
    p = 0
    while True:
        while len(s.buffer) < p + 36 and s.limit is None:
            s.more()
        if p + 36 > len(s.buffer) or (s.limit is not None and p >= s.limit):
            return None
        at, left = p, CHAIN
        while left and at is not None and at + 36 <= len(s.buffer):
            at = _plausible(s.buffer, at, sizes)
            left -= 1
            while at is not None and left and len(s.buffer) < at + 36 and s.limit is None:
                s.more()
        if at is not None:
            return p
        p += 1


def follow(f, low: int, high: int, length: int, sizes: list[int], start: int | None) -> tuple[int, int | None, int]:
    """(own bytes, first record, bytes behind the own ones that the last record takes) of a range."""
    s = _Stream(f, low, high, length)
    start = _guess(s, sizes) if start is None else start
    if start is None:
        while s.limit is None:
            s.more()
        return s.limit, None, 0
    try:
        s.skip(start)
        while s.own():
            s.skip(struct.unpack("<i", s.take(4))[0])
    except (ValueError, struct.error):  # a wrong guess, or a cut file, which the reading of records tells
        while s.limit is None:
            s.more()
    return s.limit, start, s.at - s.limit


def _tags(data: bytes) -> Iterator[tuple[str, str, object]]:
    """(tag, kind, value); an array has the kind ``B`` and its item's."""
    at = 0
    while at < len(data):
        tag, kind = data[at : at + 2].decode(), chr(data[at + 2])
        at += 3
        if kind in "ZH":
            end = data.index(0, at)
            yield tag, kind, data[at:end].decode()
            at = end + 1
        elif kind == "B":
            item, n = chr(data[at]), struct.unpack_from("<I", data, at + 1)[0]
            end = at + 5 + n * WIDTH[item]
            yield tag, kind + item, data[at + 5 : end]
            at = end
        else:
            yield tag, kind, struct.unpack_from("<" + KIND[kind], data, at)[0] if kind in KIND else chr(data[at])
            at += WIDTH[kind]


def _read_tags(data: bytes) -> tuple[dict[str, object], str | None]:
    """(values, the first fault of the modification tags)."""
    out, fault = {}, None
    try:
        for tag, kind, value in _tags(data):
            found = None
            if tag in ("MM", "ML", "MN"):
                title = tag.title()
                if tag in out:
                    found = f"Duplicate{title}"
                elif (tag == "MM" and kind != "Z") or (tag == "ML" and kind != "BC"):
                    found = f"Invalid{title}Type"
                elif tag == "MN" and not (kind in "cCsSiI" and value >= 0):
                    found = "InvalidMn"
            fault = fault or found
            if not found:
                out[tag] = value
    except (ValueError, IndexError, KeyError, struct.error):
        fault = fault or "InvalidAuxData"
    return out, fault


def _row(body: bytes, path: str, names: list[str], sizes: list[int]) -> tuple:
    ref, pos, n_name, mapq, _, n_cigar, flag, n_seq = struct.unpack_from("<iiBBHHHi", body)
    at = 32 + n_name
    name = body[32 : at - 1].decode()
    cigar = "".join(f"{x >> 4}{OPS[x & 15]}" for x in struct.unpack_from(f"<{n_cigar}I", body, at))
    at += 4 * n_cigar
    packed = body[at : at + (n_seq + 1) // 2]
    seq = "".join(LETTERS[b >> 4] + LETTERS[b & 15] for b in packed)[:n_seq]
    tags, fault = _read_tags(body[at + (n_seq + 1) // 2 + n_seq :])
    chrom = (names[ref], sizes[ref]) if 0 <= ref < len(names) else (None, None)
    return path, name, flag, chrom[0], pos, mapq, cigar, seq, tags.get("pt"), tags.get("MM"), tags.get("ML"), tags.get("MN"), fault, chrom[1]


def records(f, path: str, low: int = 0, high: int | None = None, length: int | None = None, start: int | None = None) -> Iterator[tuple]:
    """Rows of ``RECORD`` of the range, whose first record starts at ``start`` of its inflated bytes."""
    if length is None:
        f.seek(0, 2)
        length = f.tell()
    _, names, sizes, head = header(f, path, length)
    s = _Stream(f, low, length if high is None else high, length)
    s.skip(head if start is None else start)
    while s.own():
        yield _row(s.take(struct.unpack("<i", s.take(4))[0]), path, names, sizes)


def _open(path: str):
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_file(name)


def _ranges(spark: SparkSession, path: str, size: int) -> DataFrame:
    """path, idx, low, high, length: byte ranges of the files, dealt evenly."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    cut = files.select("path", "length", F.posexplode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(size).cast("long"))).alias("idx", "low"))
    cut = cut.withColumn("high", F.least(F.col("low") + size, "length"))
    return cut.repartition(max(1, min(10_000, cut.count())))


def _starts(ranges: DataFrame) -> DataFrame:
    """``ranges`` with ``start``: where the first record of each starts (NULL: none does)."""
    spark = ranges.sparkSession
    shape = "path string, idx int, low long, high long, length long, own long, start long, over long, head long"

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples():
                with _open(r.path) as f:
                    _, _, sizes, head = header(f, r.path, r.length)
                    known = None if pd.isna(r.start) else int(r.start)
                    out.append((r.path, r.idx, r.low, r.high, r.length, *follow(f, r.low, r.high, r.length, sizes, head if r.idx == 0 and known is None else known), head))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in shape.split(", ")]).astype({"start": "Int64"})

    def scan(b: pd.DataFrame) -> pd.DataFrame:
        """One file's summaries in order: each range must start where the one before ends."""
        b = b.sort_values("idx").reset_index(drop=True)
        want, out = int(b["head"].iloc[0]), []
        for r in b.itertuples():
            if want >= r.own:  # a record covers the whole range
                out.append((None, False))
                want -= r.own
                continue
            wrong = pd.isna(r.start) or int(r.start) != want
            out.append((want, wrong))
            want = int(r.over) if not pd.isna(r.start) else 0
        b["start"] = pd.array([x[0] for x in out], dtype="Int64")
        b["wrong"] = [x[1] for x in out]
        return b

    summary = ranges.withColumn("start", F.lit(None).cast("long")).mapInPandas(look, shape)
    while True:
        rows = summary.groupBy("path").applyInPandas(scan, shape + ", wrong boolean").collect()  # a short row for each range
        told = spark.createDataFrame(rows, shape + ", wrong boolean")
        wrong = sum(r.wrong for r in rows)
        if not wrong:
            return told.select("path", "idx", "low", "high", "length", "start").repartition(max(1, min(10_000, len(rows))))
        again = told.where("wrong").drop("own", "over", "head", "wrong").repartition(wrong).mapInPandas(look, shape)
        summary = told.where("NOT wrong").drop("wrong").unionByName(again)


def read(spark: SparkSession, path: str, size: int = RANGE) -> DataFrame:
    """All records of the files at ``path``, a row each; files of more than ``size`` bytes are read by several tasks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                if r.idx and pd.isna(r.start):
                    continue
                rows, held = [], 0
                with _open(r.path) as f:
                    for x in records(f, r.path, r.low, r.high, r.length, None if pd.isna(r.start) else int(r.start)):
                        rows.append(x)
                        held += 4 * len(x[7]) + 500
                        if len(rows) == PART or held > PART_BYTES:
                            yield pd.DataFrame(rows, columns=COLUMNS)
                            rows, held = [], 0
                yield pd.DataFrame(rows, columns=COLUMNS)

    ranges = _ranges(spark, path, size)
    many = ranges.where("idx > 0").limit(1).count()
    placed = _starts(ranges) if many else ranges.withColumn("start", F.lit(None).cast("long"))
    return placed.mapInPandas(run, RECORD)


def headers(spark: SparkSession, path: str) -> DataFrame:
    """path and text of the header of each file."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for p, n in zip(b["path"], b["length"]):
                with _open(p) as f:
                    yield pd.DataFrame([(p, header(f, p, n)[0])], columns=["path", "text"])

    return spark.read.format("binaryFile").load(path).select("path", "length").mapInPandas(run, "path string, text string")


def tracks(rows: DataFrame, least_mapq: int = 30) -> DataFrame:
    """Tracks of mapped primary alignments; the strand follows the flag."""
    good = rows.where(primary(F.col("flag"), F.col("mapq"), least_mapq) & F.col("chrom").isNotNull())
    t = good.withColumn("exons", cigar_exons(F.col("start"), F.col("cigar"))).where(F.size("exons") > 0)
    strand = F.when(F.col("flag").bitwiseAND(F.lit(0x10)) != 0, "-").otherwise("+")
    return t.select("chrom", strand.alias("strand"), F.get(F.col("exons"), 0)["start"].alias("tx_start"), F.element_at("exons", -1)["end"].alias("tx_end"), "name", F.lit(0).alias("score"), "exons", F.lit("nanopore_read").alias("ttype"), F.lit("none").alias("gene_id"))


def coverage(rows: DataFrame) -> DataFrame:
    """name, chrom, blocks of primary alignments."""
    good = rows.where(primary(F.col("flag"), F.col("mapq"), 0) & F.col("chrom").isNotNull())
    return good.select("name", "chrom", cigar_blocks(F.col("start"), F.col("cigar")).alias("blocks"))


def query_positions(start: Column, cigar: Column) -> Column:
    """Reference position of each query base, in order; NULL within insertions and clips."""
    from ..functions.sequence import cigar_steps

    empty = F.struct(start.cast("long").alias("at"), F.array().cast("array<long>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        both, query = x["op"].isin("M", "=", "X"), x["op"].isin("I", "S")
        ref = x["op"].isin("M", "=", "X", "D", "N")
        n = x["n"].cast("int")
        here = F.when(both, F.sequence(acc["at"], acc["at"] + x["n"] - 1)).when(query, F.array_repeat(F.lit(None).cast("long"), n)).otherwise(F.array().cast("array<long>"))
        return F.struct((acc["at"] + F.when(ref, x["n"]).otherwise(0)).alias("at"), F.concat(acc["out"], here).alias("out"))

    return F.aggregate(cigar_steps(cigar), empty, step, lambda acc: acc["out"])


def modification_calls(rows: DataFrame, base: str = "A", code: str = "a") -> DataFrame:
    """read_id, chrom, strand, pos0, probability of explicit calls of one modification on the read's own strand.

    MM lists how many bases to skip before each called one; ML has a byte for each, read as the middle
    of its interval; MN must equal the length of the sequence.
    """
    reverse = F.col("flag").bitwiseAND(F.lit(0x10)) != 0
    group = F.regexp_extract("mm", rf"(?:^|;){base}\+{code}[.?]?((?:,[0-9]+)*)", 1)
    # A group lists its positions once and has an ML byte for each position and code, position by position.
    groups = F.filter(F.split("mm", ";"), lambda g: g != "")
    head = lambda g: F.regexp_extract(g, r"^([A-Za-z])[+-]([a-z]+|[0-9]+)[.?]?", 2)
    codes = lambda g: F.when(head(g).rlike("^[0-9]"), 1).otherwise(F.length(head(g)))
    bytes_of = lambda g: (F.length(g) - F.length(F.replace(g, F.lit(","), F.lit("")))) * codes(g)
    total = lambda a: F.aggregate(a, F.lit(0), lambda n, g: n + bytes_of(g))
    at = F.coalesce(F.get(F.filter(F.transform(groups, lambda g, i: F.when(g.rlike(rf"^{base}\+{code}[.?]?(,|$)"), i)), lambda i: i.isNotNull()), 0), F.lit(0))
    skipped = total(F.slice(groups, 1, at))
    bad = F.col("mn").isNull() | (F.col("mn") != F.length("seq"))
    stop = F.raise_error(F.lit("MN differs from the length of the sequence")).cast("boolean")
    short = F.raise_error(F.lit("ML has another number of bytes than MM has calls")).cast("boolean")
    wrong = F.coalesce(F.octet_length("ml"), F.lit(0)) != total(groups)
    good = rows.where(primary(F.col("flag"), F.col("mapq"), 0) & F.col("mm").isNotNull()).where(F.when(bad, stop).when(wrong, short).otherwise(True))
    own = F.when(reverse, F.reverse(F.translate("seq", "ACGT", "TGCA"))).otherwise(F.col("seq"))
    letters = F.filter(F.transform(F.split(own, ""), lambda c, i: F.when(c == base, i)), lambda i: i.isNotNull())
    gaps = F.transform(F.filter(F.split(group, ","), lambda x: x != ""), lambda x: x.cast("int"))
    nth = F.aggregate(gaps, F.struct(F.lit(-1).alias("at"), F.array().cast("array<int>").alias("out")), lambda acc, g: F.struct((acc["at"] + g + 1).alias("at"), F.concat(acc["out"], F.array(acc["at"] + g + 1)).alias("out")), lambda acc: acc["out"])
    t = good.select("name", "chrom", "seq", "ml", reverse.alias("reverse"), letters.alias("letters"), nth.alias("nth"), skipped.alias("skipped"), query_positions(F.col("start"), F.col("cigar")).alias("ref"))
    call = t.select("*", F.posexplode("nth").alias("k", "n")).withColumn("q", F.get(F.col("letters"), F.col("n")))
    q = F.when(F.col("reverse"), F.length("seq") - 1 - F.col("q")).otherwise(F.col("q"))
    byte = F.conv(F.hex(F.substring("ml", F.col("skipped") + F.col("k") + 1, F.lit(1))), 16, 10).cast("double")
    return call.select(F.col("name").alias("read_id"), "chrom", F.when(F.col("reverse"), "-").otherwise("+").alias("strand"), F.get(F.col("ref"), q).alias("pos0"), ((byte + 0.5) / 256).alias("probability")).where("pos0 IS NOT NULL")
