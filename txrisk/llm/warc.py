"""WARC archives (operator 9).

Writing: one record per page. Pages with equal payloads share one response, that
of the largest page id; the others are revisits without a block that refer to
it. Records are rows of Spark's text writer, whose separator is the blank line
that ends a record, so the files are plain archives.

Reading verifies the boundary chain. Files are read in splits, cut at each
occurrence of the magic line. A task parses each piece as a candidate record and
emits its successor, the offset its header promises. Inside a split successors
are followed at once, to the first offset outside; between splits pointers are
doubled from the start of the file. Candidates that the chain does not reach,
such as a magic line inside a payload, are no records; their bytes belong to the
record around them.

Written payloads are not moved where few of them occur more than once: the keys
of those are broadcast behind a check of their number, and beyond it joined by
shuffle. A task holds one split's offsets. Payload digests are computed where the piece
is read, and only records that contain a magic line are put together by offset.
Equal payloads are counted before the shuffle, and the joins are plain
equalities that adaptive execution can split.

Defined results: a NULL page is empty; NULL ids sort below all others; repeated
rows of one page are each a record, responses all if their page is the largest;
an empty table gives an empty archive and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txrisk.llm.common import discard, stored

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
_MAGIC_SIZE, _END_SIZE = len(MAGIC), len(END)
# Repeated payloads whose keys are broadcast at most, some 100 bytes each.
FEW_REPEATED = 200_000


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page: int | None, key: str) -> str:
    return f"urn:page:{'' if page is None else page}:{key}"


def record_text(
    page: int | None, url: str | None, payload: str, key: str, first: int | None, revisit: bool
) -> str:
    """One record without the blank line that ends it."""
    raw = payload.encode()
    head = [
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{_record_id(page, key)}>",
        f"WARC-Payload-Digest: sha1:{payload_digest(raw)}",
        "Content-Type: text/html; charset=utf-8",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <{_record_id(first, key)}>")
    block = "" if revisit else payload
    return MAGIC + "\r\n".join([*head, f"Content-Length: {0 if revisit else len(raw)}"]) + END + block


def write_archive(
    pages: DataFrame, path: str, min_bytes: int = 0, few: int = FEW_REPEATED
) -> None:
    """Write the pages as archive files into the folder ``path``. Payloads of
    fewer than ``min_bytes`` bytes are all responses."""
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        "url",
        F.coalesce("html", F.lit("")).alias("payload"),
    ).withColumn("key", F.sha2(F.col("payload").cast("binary"), 256))
    repeated = (
        rows.groupBy("key")
        .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .drop("n")
        .withColumn("repeated", F.lit(True))
    )
    repeated = stored(repeated, "warc-repeated")
    if repeated.count() <= few:
        repeated = F.broadcast(repeated)
    is_first = F.col("repeated").isNull() | F.col("page_id").eqNullSafe(F.col("first"))
    revisit = ~is_first & (F.octet_length("payload") >= min_bytes)
    typed = rows.join(repeated, "key", "left").select(
        "page_id", "url", "payload", "key", "first", revisit.alias("revisit")
    )

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = (record_text(*(v.as_py() for v in row)) for row in zip(*batch.columns))
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.string())], names=["value"])

    typed.mapInArrow(render, "value string").write.option("lineSep", END).text(path)


def _header(piece: bytes) -> tuple[dict[str, str], int] | None:
    """Fields of a record header and where its block begins, None if the piece
    does not begin with one."""
    end = piece.find(END.encode())
    if end < 0:
        return None
    fields: dict[str, str] = {}
    for line in piece[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.decode("latin-1").lower()] = value.strip().decode("latin-1")
    length = fields.get("content-length", "")
    if not (length.isascii() and length.isdigit() and len(length) < 19 and "warc-type" in fields):
        return None
    return fields, end + _END_SIZE


CANDIDATES = (
    "file string, block bigint, at bigint, size bigint, next bigint, leaves bigint,"
    " page_id bigint, record_id string, record_type string, refers_to string,"
    " payload_bytes bigint, payload_digest string"
)
_KINDS = [pa.string(), *[pa.int64()] * 6, *[pa.string()] * 3, pa.int64(), pa.string()]
_NAMES = [c.split()[0] for c in CANDIDATES.split(", ")]


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Text between magic lines, in file order within a split."""
    return (
        spark.read.option("lineSep", MAGIC)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("value").cast("binary").alias("value"),
        )
    )


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes, int]]:
    """File, split, piece and the offset of the piece's magic line from the
    first piece of its split."""
    last, at = None, 0
    for batch in batches:
        for file, block, value in zip(*(c.to_pylist() for c in batch.columns)):
            if (file, block) != last:
                last, at = (file, block), 0
            yield file, block, value, at
            at += len(value) + _MAGIC_SIZE


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every piece as a candidate record. ``at`` and ``next`` are offsets of the
    record and its successor from the split's first piece, and ``leaves`` the
    first offset outside the split that its chain reaches."""

    def flush(rows: list[list], end: int) -> Iterator[pa.RecordBatch]:
        leaves: dict[int, int] = {}
        for row in reversed(rows):
            if row[4] is not None:
                row[5] = row[4] if row[4] >= end else leaves.get(row[4])
                if row[5] is not None:
                    leaves[row[2]] = row[5]
        if rows:
            columns = [pa.array(v, k) for v, k in zip(zip(*rows), _KINDS)]
            yield pa.RecordBatch.from_arrays(columns, names=_NAMES)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[list] = []
        split, end = None, 0
        for file, block, value, at in _by_split(batches):
            if (file, block) != split:
                yield from flush(rows, end)
                rows, split = [], (file, block)
            end = at + len(value) + _MAGIC_SIZE
            row = [file, block, at, len(value) + _MAGIC_SIZE, *[None] * 8]
            if parsed := _header(value):
                fields, begin = parsed
                length = int(fields["content-length"])
                row[4] = at + _MAGIC_SIZE + begin + length + _END_SIZE
                name = fields.get("warc-record-id", "")[1:-1]
                page = name.split(":")[2] if name.count(":") >= 3 else ""
                row[6] = int(page) if page.removeprefix("-").isdigit() else None
                row[7], row[8] = name, fields["warc-type"]
                row[9] = fields.get("warc-refers-to", "")[1:-1] or None
                if begin + length <= len(value):
                    row[10] = length
                    row[11] = payload_digest(value[begin : begin + length])
            rows.append(row)
        yield from flush(rows, end)

    return _pieces(spark, path).mapInArrow(parse, CANDIDATES)


def located(found: DataFrame) -> DataFrame:
    """Candidates with offsets in the file. A file begins with a magic line, so
    its first piece is empty and the record after it has offset 0."""
    earlier = Window.partitionBy("file").orderBy("block")
    begins = (
        found.groupBy("file", "block")
        .agg(F.sum("size").alias("_size"))
        .withColumn("_begin", F.sum("_size").over(earlier) - F.col("_size") - _MAGIC_SIZE)
        .drop("_size")
    )
    moved = {c: F.col(c) + F.col("_begin") for c in ("at", "next", "leaves")}
    return found.join(begins, ["file", "block"]).withColumns(moved).filter("at >= 0")


def reached_entries(found: DataFrame) -> DataFrame:
    """First record of the chain in each split, by doubling pointers between
    splits from the start of each file."""
    starts = found.filter("at = 0").select("file", "at")
    entries = found.filter(F.col("leaves").isNotNull()).select("file", "leaves").distinct()
    targets = entries.select("file", F.col("leaves").alias("at"))
    jumps = (
        found.filter(F.col("leaves").isNotNull())
        .select("file", "at", "leaves")
        .join(targets.unionByName(starts).distinct(), ["file", "at"], "left_semi")
    )
    reached, jumps = stored(starts, "warc-reached"), stored(jumps, "warc-jumps")
    while not jumps.isEmpty():
        spent = reached, jumps
        onward = reached.join(jumps, ["file", "at"]).select("file", F.col("leaves").alias("at"))
        reached = stored(reached.unionByName(onward).distinct(), "warc-reached")
        ahead = jumps.select("file", F.col("at").alias("leaves"), F.col("leaves").alias("_far"))
        jumps = stored(
            jumps.join(ahead, ["file", "leaves"]).select("file", "at", F.col("_far").alias("leaves")),
            "warc-jumps",
        )
        discard(*spent)
    return reached


def reachable(found: DataFrame) -> DataFrame:
    """File and offset of the records on the chain of their file."""
    entries = reached_entries(found).withColumn("entry", F.lit(True))
    rows = found.join(entries, ["file", "at"], "left").select("file", "block", "at", "next", "entry")

    def follow(rows: pd.DataFrame) -> pd.DataFrame:
        successor = dict(zip(rows["at"].tolist(), rows["next"].astype(object).tolist()))
        on_chain: list[int] = []
        seen: set[int] = set()
        for at in rows.loc[rows["entry"].notna(), "at"].tolist():
            while at in successor and at not in seen and not pd.isna(successor[at]):
                seen.add(at)
                on_chain.append(at)
                at = int(successor[at])
        return pd.DataFrame({"file": rows["file"].iloc[0], "at": on_chain})

    return rows.groupBy("file", "block").applyInPandas(follow, "file string, at bigint")


def _whole_payloads(
    spark: SparkSession, path: str, found: DataFrame, records: DataFrame
) -> DataFrame:
    """Length and digest of payloads that hold magic lines, from all their
    pieces in order."""
    upto = Window.partitionBy("file").orderBy("at")
    split_of = found.select("file", "block", "at", F.col("at").alias("piece"), "_begin")
    spans = (
        split_of.join(records.select("file", "at", "next").withColumn("_own", F.col("at")), ["file", "at"], "left")
        .withColumn("own", F.last("_own", ignorenulls=True).over(upto))
        .withColumn("until", F.last("next", ignorenulls=True).over(upto))
        .join(
            records.filter(F.col("payload_digest").isNull()).select("file", F.col("at").alias("own")),
            ["file", "own"],
            "left_semi",
        )
        .select("file", "block", (F.col("piece") - F.col("_begin")).alias("at"), "own", "until")
    )

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, block, value, at in _by_split(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([file]), pa.array([block]), pa.array([at]), pa.array([value])],
                names=["file", "block", "at", "value"],
            )

    texts = _pieces(spark, path).mapInArrow(
        raw, "file string, block bigint, at bigint, value binary"
    )

    def put_together(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["block", "at"])
        whole = MAGIC.encode().join(rows["value"].tolist())
        fields, begin = _header(whole)
        payload = whole[begin : begin + int(fields["content-length"])]
        return pd.DataFrame(
            [(*key, len(payload), payload_digest(payload))], columns=["file", "at", "_bytes", "_digest"]
        )

    return (
        texts.join(spans, ["file", "block", "at"])
        .groupBy("file", "own")
        .applyInPandas(put_together, "file string, at bigint, _bytes bigint, _digest string")
    )


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records on the boundary chains of the files in ``path``: page_id,
    payload_bytes, payload_digest, record_type, refers_to (a page id). A revisit
    has the payload of the response it refers to."""
    found = stored(located(candidates(spark, path)), "warc-candidates")
    records = found.join(reachable(found), ["file", "at"])
    records = stored(records, "warc-records")
    if not records.filter(F.col("payload_digest").isNull()).isEmpty():
        whole = _whole_payloads(spark, path, found, records)
        records = records.join(whole, ["file", "at"], "left").withColumns(
            {
                "payload_bytes": F.coalesce("payload_bytes", "_bytes"),
                "payload_digest": F.coalesce("payload_digest", "_digest"),
            }
        )
    own = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    revisit = F.col("record_type") == "revisit"
    responses = (
        records.filter(~revisit)
        .select(F.col("record_id").alias("refers_to"), *[F.col(c).alias(f"_{c}") for c in own])
        .dropDuplicates(["refers_to"])
    )
    return records.filter(~revisit).select(
        *own, F.lit(None).cast("bigint").alias("refers_to")
    ).unionByName(
        records.filter(revisit)
        .join(responses, "refers_to")
        .select(
            "page_id",
            F.col("_payload_bytes").alias("payload_bytes"),
            F.col("_payload_digest").alias("payload_digest"),
            "record_type",
            F.col("_page_id").alias("refers_to"),
        )
    )
