"""WARC archives through a chunked record table (operator 10).

A page becomes rows (record id, chunk number, chunk bytes). Each row is one WARC
record of at most `chunk_bytes` of payload: the first a `response` or `revisit`,
the others `continuation` records of the standard's segmentation, so no task
holds more of an archive than a chunk. The rows go through Spark's text writer
with the record end (two line ends) as separator, hence to any file system Spark
reaches, and come back through its text reader. There the separators split
headers from payloads (and payloads at blank lines), and a generator per file
puts the pieces together by Content-Length, one chunk at a time, with a digest
that is carried from chunk to chunk. Files are compressed as a whole, which keeps
them unsplit and their rows in order.

Records carry what WARC 1.1 asks for: type, date, an id of their own, length, and for
revisits the profile and the record they refer to. A response is an HTTP message, whose
head stands in front of the payload. The date is a parameter, so that reruns agree.

Of records with equal payloads of at least `revisit_from` bytes the one with the
largest id is the response and the others revisit it; smaller ones are all
responses. Groups are found from 20-byte digests with map-side aggregation.

Defined results: a null payload is an empty one; a null id is written as an empty
one and comes back null; pages repeated with one id are separate records with ids of their own, which are
all responses if theirs is the largest id; an empty table gives an empty archive and an empty
result. Columns other than those named are not archived; a url's line ends are
dropped.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.llm.common import written
from tillmart.session import scratch_dir

CHUNK_BYTES = 64 << 10
REVISIT_FROM = 0
END = "\r\n\r\n"
CAPTURED = "2024-01-01T00:00:00Z"
# Fixed: the name the standard gives to revisits of an identical payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Fixed: SHA-1 digests in WARC headers use the base32 alphabet.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_FIELDS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
CHUNK_SCHEMA = (
    "page_id long, url string, record_type string, refers_to long, payload_digest string,"
    " payload_bytes long, chunk_no int, chunk binary, running_sha1 string, last boolean"
)


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary column: 20 bits are five hex or four base32 digits."""
    digest = F.sha1(payload)
    groups = [
        F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*groups), _DIGITS, BASE32)


def with_roles(
    pages: DataFrame,
    id_col: str = "page_id",
    payload_col: str = "html",
    url_col: str = "url",
    revisit_from: int = REVISIT_FROM,
) -> DataFrame:
    """page_id, number, url, payload, payload_bytes, payload_digest, record_type, refers_to, refers_to_number.

    Rows are numbered by their place in the input, which tells records of one page id apart.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.monotonically_increasing_id().alias("number"),
        F.translate(F.coalesce(F.col(url_col), F.lit("")), "\r\n", "").alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.unhex(F.sha1("payload")))
    groups = (
        rows.filter(F.octet_length("payload") >= revisit_from)
        .groupBy("digest")
        .agg(F.max(F.struct("page_id", "number")).alias("response"))
        .select("digest", F.col("response.page_id").alias("response_id"), F.col("response.number").alias("response_number"))
    )
    # As a table of its own, the join can split the partition of a payload with many copies.
    groups = written(groups, "payload-groups")
    return rows.join(groups, "digest", "left").select(
        "page_id",
        "url",
        "payload",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
        F.when(F.col("page_id") < F.col("response_id"), "revisit")
        .when(F.col("page_id").isNull() & F.col("response_id").isNotNull(), "revisit")
        .otherwise("response")
        .alias("record_type"),
        F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("response_id")), F.col("response_id"))
        .alias("refers_to"),
        "number",
        F.col("response_number").alias("refers_to_number"),
    )


def chunk_rows(roles: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(page, chunk number) rows with a chunk each; a revisit and an empty payload have one empty chunk."""
    stored = F.when(F.col("record_type") == "response", F.col("payload_bytes")).otherwise(F.lit(0))
    return (
        roles.withColumn("chunks", F.greatest(F.ceil(stored / chunk_bytes), F.lit(1)).cast("int"))
        .withColumn("chunk_no", F.explode(F.sequence(F.lit(1), F.col("chunks"))))
        .withColumn(
            "chunk",
            F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(
                F.substring(
                    F.col("payload"), (F.col("chunk_no") - 1) * chunk_bytes + 1, F.lit(chunk_bytes)
                )
            ),
        )
        .drop("payload")
    )


def record_text(captured: str = CAPTURED) -> Column:
    """A chunk row as one WARC record without the final separator."""
    first, revisit = F.col("chunk_no") == 1, F.col("record_type") == "revisit"
    several = F.col("chunks") > 1
    none = F.lit("")
    line = lambda key, value: F.concat(F.lit(f"\r\n{key}: "), value.cast("string"))

    def urn(page: str, number: str, chunk: Column) -> Column:
        name = F.coalesce(F.col(page).cast("string"), F.lit(""))
        parts = (F.lit("<urn:page:"), name, F.lit(":"), F.col(number), F.lit(":"), chunk, F.lit(">"))
        return F.concat(*(p.cast("string") for p in parts))

    head = F.when(
        first & ~revisit,
        F.concat(
            F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
            F.col("payload_bytes").cast("string"),
            F.lit(END),
        ),
    ).otherwise(none)
    whole = F.octet_length(head) + F.octet_length("chunk")
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(first, F.col("record_type")).otherwise("continuation"),
        line("WARC-Record-ID", urn("page_id", "number", F.col("chunk_no"))),
        F.lit(f"\r\nWARC-Date: {captured}"),
        F.when(F.col("url") != "", line("WARC-Target-URI", F.col("url"))).otherwise(none),
        F.when(first, F.lit("\r\nContent-Type: application/http; msgtype=response")).otherwise(none),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("X-Payload-Length", F.col("payload_bytes")),
        F.when(
            revisit,
            F.concat(
                F.lit(f"\r\nWARC-Profile: {PROFILE}"),
                line("WARC-Refers-To", urn("refers_to", "refers_to_number", F.lit(1))),
            ),
        ).otherwise(none),
        F.when(
            several,
            F.concat(
                line("WARC-Segment-Number", F.col("chunk_no")),
                F.when(
                    ~first, line("WARC-Segment-Origin-ID", urn("page_id", "number", F.lit(1)))
                ).otherwise(none),
                F.when(
                    F.col("chunk_no") == F.col("chunks"),
                    # Of all segments' blocks, so with the HTTP head of the first.
                    line("WARC-Segment-Total-Length", F.col("payload_bytes") + _head_length()),
                ).otherwise(none),
            ),
        ).otherwise(none),
        line("Content-Length", whole),
        F.lit(END),
        head,
        F.col("chunk").cast("string"),
    )


def _head_length() -> Column:
    """Bytes of a response's HTTP head."""
    fixed = len("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: " + END)
    return F.length(F.col("payload_bytes").cast("string")) + fixed


def write_archives(
    pages: DataFrame,
    path: str,
    chunk_bytes: int = CHUNK_BYTES,
    revisit_from: int = REVISIT_FROM,
    captured: str = CAPTURED,
    **columns: str,
) -> None:
    """Write one gzip WARC file per task; `columns` name id_col, payload_col and url_col.

    A file has no largest number of records, which could part the segments of a page.
    """
    chunks = chunk_rows(with_roles(pages, revisit_from=revisit_from, **columns), chunk_bytes)
    (
        chunks.select(record_text(captured).alias("value"))
        .write.option("lineSep", END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", 0)  # also where the session sets one
        .text(path)
    )


def read_chunks(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Chunk table of the archives in a folder, see `CHUNK_SCHEMA`.

    `running_sha1` is the digest (base32) of the payload up to and with the chunk.
    Segments of a record follow each other in one file, as the writer leaves them.
    """
    pieces = spark.read.option("lineSep", END).text(path)
    empty = spark.createDataFrame([], CHUNK_SCHEMA).schema

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(_records(_pieces(batches)), chunk_bytes)

    return pieces.select(F.col("value").cast("binary")).mapInArrow(parse, empty)


def read_pages(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per archived page, from the last chunk of each: what was read, not what was written.

    The digest and length of a response are those of the bytes read; of a revisit, which
    has none, those its record gives.
    """
    chunks = read_chunks(spark, path, chunk_bytes).filter("last")
    return chunks.select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        F.coalesce("record_type", F.lit("response")).alias("record_type"),
        "refers_to",
        "url",
    )


def archive_round_trip(
    pages: DataFrame, chunk_bytes: int = CHUNK_BYTES, revisit_from: int = REVISIT_FROM, **columns: str
) -> DataFrame:
    """Write the pages to archives in the shared folder and read the records back."""
    spark = pages.sparkSession
    path = scratch_dir(spark, "warc")
    write_archives(pages, path, chunk_bytes, revisit_from, **columns)
    return read_pages(spark, path, chunk_bytes).select(*_FIELDS[:5])


# --- parsing, one file after the other ------------------------------------------------


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[bytes]:
    for batch in batches:
        for value in batch.column(0):
            yield value.as_py()


def _records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record.

    A block may hold separators or end with a part of one, so pieces are joined again and
    cut by Content-Length; no more than a record and a piece is held.
    """
    gap, held = END.encode(), b""

    def more() -> bytes:
        piece = next(pieces, None)
        if piece is None:
            raise ValueError(f"an archive ends within a record: {held[:40]!r}")
        return piece + gap

    while True:
        # A file's last separator may have been read as a piece of its own.
        held = held.lstrip(b"\r\n")
        if not held:
            piece = next(pieces, None)
            if piece is None:
                return
            held = piece + gap
            continue
        while gap not in held:
            held += more()
        head, held = held.split(gap, 1)
        if not head.startswith(b"WARC/"):
            raise ValueError(f"no WARC record starts with {head[:40]!r}")
        headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        length = int(headers["Content-Length"])
        parts = [held]
        have = len(held)
        while have < length + len(gap):
            parts.append(more())
            have += len(parts[-1])
        held = b"".join(parts)
        block, end, held = held[:length], held[length : length + len(gap)], held[length + len(gap) :]
        if end != gap:
            raise ValueError(f"record {headers.get('WARC-Record-ID')} is not {length} bytes long")
        yield headers, block


def _number(urn: str | None) -> int | None:
    text = (urn or "").split(":")[2:3]
    return int(text[0]) if text and text[0] else None


def _rows(records: Iterator[tuple[dict[str, str], bytes]], chunk_bytes: int) -> Iterator[tuple]:
    digest, length, origin = hashlib.sha1(), 0, {}
    for headers, block in records:
        if headers["WARC-Type"] != "continuation":
            digest, length, origin = hashlib.sha1(), 0, headers
            if headers.get("Content-Type", "").startswith("application/http"):
                block = block.partition(END.encode())[2]
        page = _number(headers["WARC-Record-ID"])
        segment = int(headers.get("WARC-Segment-Number", 1))
        revisit = origin["WARC-Type"] == "revisit"
        last = "WARC-Segment-Number" not in headers or "WARC-Segment-Total-Length" in headers
        # A record written elsewhere may be longer than a chunk.
        for at in range(0, max(len(block), 1), chunk_bytes):
            part = block[at : at + chunk_bytes]
            digest.update(part)
            length += len(part)
            running = base64.b32encode(digest.digest()).decode()
            ends = last and at + chunk_bytes >= len(block)
            named = headers["WARC-Payload-Digest"].removeprefix("sha1:")
            if ends and not revisit and named != running:
                raise ValueError(f"page {page}: payload digest {running}, header {named}")
            yield (
                page,
                headers.get("WARC-Target-URI", ""),
                origin["WARC-Type"],
                _number(headers.get("WARC-Refers-To")),
                named if revisit else running,
                int(headers["X-Payload-Length"]) if revisit else length,
                segment,
                part,
                running,
                ends,
            )


def _batches(records, chunk_bytes: int, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in CHUNK_SCHEMA.split(", ")]
    types = [
        pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(),
        pa.int64(), pa.int32(), pa.binary(), pa.string(), pa.bool_(),
    ]
    schema = pa.schema(list(zip(names, types, strict=True)))
    rows, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], schema=schema
        )

    for row in _rows(records, chunk_bytes):
        rows.append(row)
        size += len(row[7]) + 200
        if size >= most_bytes:
            yield batch()
            rows, size = [], 0
    if rows:
        yield batch()
