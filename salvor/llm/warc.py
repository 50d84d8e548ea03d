"""WARC archives: writing, and a reader that salvages what damage leaves."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salvor.llm.common import arrow, setting, split_by_slots, staged, table
from salvor.session import scratch

# Fixed values of the format.
LINE_END = "\r\n"
RECORD_END = "\r\n\r\n"
VERSION = "WARC/1.1"
VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
HTTP_HEADERS_END = re.compile(rb"\r?\n\r?\n")
GZIP_START = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEX32, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

RECORDS_A_FILE = 2000
BYTES_A_FILE = 64 << 20
# More than the fixed headers of a record take.
HEADER_BYTES = 1024
OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
RECORD = "archive string, start long, size long, record_id string, record_type string, uri string, page_id long, refers_to long, payload_bytes long, payload_digest string, payload binary, http_headers binary"
GAP = "archive string, start long, size long, reason string"


def base32(hexadecimal: Column) -> Column:
    """Base32 of a digest given in hexadecimal, by groups of 20 bits."""
    parts = [
        F.lpad(F.conv(F.substring(hexadecimal, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.upper(F.concat(*parts)), HEX32, BASE32)


def page_records(pages: DataFrame, *, least_bytes: int = 0) -> DataFrame:
    """page_id, url, html with digest, record type and the page that a revisit refers to.

    Payloads are equal when SHA-256 and length are. Groups are added up map-side to one row, so a
    hot payload is one row in the lookup of repeated payloads, which is made first, from digests alone. The pages whose
    digest falls in a hash slot that no repeated payload uses are written where they are read; only the others
    meet the lookup, in a join that AQE splits where a digest is skewed.
    """
    # Encoded and decoded once, so that the bytes hashed are those written.
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    body = F.encode("html", "UTF-8")
    rows = rows.withColumn("payload_bytes", F.octet_length("html").cast("bigint")).withColumn("same", F.sha2(body, 256))
    first = rows.filter(F.col("payload_bytes") >= least_bytes).groupBy("same", "payload_bytes").agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
    first = staged(first.filter("copies > 1").drop("copies"), "warc-repeated")
    alone, shared = split_by_slots(rows, F.col("same"), first.select("same"))
    alone = alone.withColumn("first_id", F.lit(None).cast(pages.schema["page_id"].dataType))
    shared = shared.join(first, ["same", "payload_bytes"], "left")
    joined = alone.unionByName(shared).withColumn("payload_digest", base32(F.sha1(body)))
    # A missing id cannot be referred to by a record of its own; it revisits where another id exists.
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        "page_id", "url", "html", "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def record_text(records: DataFrame) -> Column:
    """A record without its closing line ends. A revisit has no block; its digest and length stay in headers."""

    def header(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(LINE_END))).otherwise("")

    revisit = F.col("record_type") == "revisit"
    name = lambda page: F.concat(F.lit("<urn:page:"), page.cast("string"), F.lit(">"))
    return F.concat(
        F.lit(VERSION + LINE_END),
        header("WARC-Type", F.col("record_type")),
        header("WARC-Record-ID", F.coalesce(name(F.col("page_id")), F.lit("<urn:page:>"))),
        header("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", "")),
        header("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        header("WARC-Refers-To", name(F.col("refers_to"))),
        header("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        header("WARC-Payload-Length", F.col("payload_bytes").cast("string")),
        header("Content-Type", F.lit("text/html; charset=UTF-8")),
        header("Content-Length", F.when(revisit, "0").otherwise(F.col("payload_bytes").cast("string"))),
        F.lit(LINE_END),
        F.when(revisit, "").otherwise(F.col("html")),
    )


def _numbers(records_a_file: int, bytes_a_file: int):
    """File numbers of a task's records, from their sizes in the order they come."""

    @F.pandas_udf("long")
    def number(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        file, rows, filled = 0, 0, 0
        for sizes in batches:
            numbers = []
            for size in sizes.tolist():
                if rows == records_a_file or rows and filled + size > bytes_a_file:
                    file, rows, filled = file + 1, 0, 0
                rows, filled = rows + 1, filled + size
                numbers.append(file)
            yield pd.Series(numbers, dtype="int64")

    return number.asNondeterministic()


def write_archives(records: DataFrame, path: str, *, records_a_file: int = RECORDS_A_FILE, bytes_a_file: int = BYTES_A_FILE) -> None:
    """Plain archives of at most ``records_a_file`` records and about ``bytes_a_file`` bytes each (a larger record is an
    archive of its own), by Spark's text writer: its line end is the end of a record.

    Each task numbers its own records by running sums; only the sizes go through Python. The writer holds
    some files open at once and so needs no sort by number.
    """
    spark = records.sparkSession
    block = F.when(F.col("record_type") == "revisit", 0).otherwise(F.col("payload_bytes"))
    size = (block + F.coalesce(F.octet_length("url"), F.lit(0)) + HEADER_BYTES).cast("bigint")
    text = records.select(record_text(records).alias("value"), _numbers(records_a_file, bytes_a_file)(size).alias("file"))
    # Whole rows wait while their sizes are away.
    with setting(spark, BATCH, "128"), setting(spark, OPEN_WRITERS, "64"):
        text.write.partitionBy("file").option("lineSep", RECORD_END).text(path)


class Damaged(ValueError):
    pass


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """The record at ``at``: headers (lower-case names), block, end. Damaged if any check fails:
    version line, header form, lengths, closing line ends, digest of a block."""
    line = VERSION_LINE.match(data, at)
    if not line:
        raise Damaged("no version line")
    end = data.find(b"\r\n\r\n", line.end() - 2)
    if end < 0:
        raise Damaged("headers do not end")
    headers = {}
    for part in data[line.end() : end].split(b"\r\n"):
        name, colon, value = part.partition(b":")
        if not colon or not name.strip():
            raise Damaged("header without a colon")
        headers[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    if not re.fullmatch("[0-9]{1,18}", length) or "warc-type" not in headers or "warc-record-id" not in headers:
        raise Damaged("a needed header is missing or malformed")
    start = end + 4
    stop = start + int(length)
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise Damaged("record does not end at its length")
    block = data[start:stop]
    digest = headers.get("warc-payload-digest", "")
    if headers["warc-type"] == "response" and digest.startswith("sha1:") and digest[5:] != sha1_base32(payload(headers, block)):
        raise Damaged("payload digest differs")
    return headers, block, stop + 4


def payload(headers: dict[str, str], block: bytes) -> bytes:
    """The part of a block that the payload digest covers: of an HTTP message the body after its headers,
    with transfer coding as stored; of anything else the block. A message whose headers do not end has no body."""
    if headers.get("content-type", "").partition(";")[0].strip().lower() != "application/http":
        return block
    end = HTTP_HEADERS_END.search(block)
    return block[end.end() :] if end else b""


def sha1_base32(block: bytes) -> str:
    return base64.b32encode(hashlib.sha1(block).digest()).decode()


def gzip_member(data: bytes, at: int) -> tuple[bytes, int, str]:
    """Content, end and failure ('' if none) of the member at ``at``. A damaged member gives what unpacks before the
    failure, and its end is not known. Read in steps, so the bytes after it are not copied, and the steps of a
    damaged member are unpacked again in small ones, as a failing step gives nothing."""
    unpack, view, parts, step = zlib.decompressobj(31), memoryview(data), [], 1 << 16
    while not unpack.eof:
        if at >= len(data):
            return b"".join([*parts, unpack.flush()]), at, "gzip member does not end"
        before = unpack.copy()
        try:
            parts.append(unpack.decompress(view[at : at + step]))
        except zlib.error as error:
            return b"".join([*parts, *_until_failure(before, view[at : at + step])]), at, f"gzip: {error}"
        at += step
    return b"".join(parts), min(at, len(data)) - len(unpack.unused_data), ""


def _until_failure(unpack, view: memoryview) -> Iterator[bytes]:
    try:
        for i in range(len(view)):
            yield unpack.decompress(view[i : i + 1])
    except zlib.error:
        return


def unpacked_by(data: bytes, at: int, length: int) -> int:
    """Where in ``data`` the member at ``at`` has given ``length`` bytes."""
    unpack, view, step = zlib.decompressobj(31), memoryview(data), 1 << 16
    while True:
        before = unpack.copy()
        try:
            size = len(unpack.decompress(view[at : at + step]))
        except zlib.error:
            size = length
        if size >= length:
            break
        length, at = length - size, at + step
    for i, part in enumerate(_until_failure(before, view[at : at + step]), 1):
        length -= len(part)
        if length <= 0:
            return at + i
    raise AssertionError("the member gives fewer bytes")


def records_of(content: bytes) -> tuple[list[tuple[dict, bytes]], int, str]:
    """The (headers, block) of every record in ``content`` that passes the checks, the end of the last one, and the
    first failure or ''."""
    found, last, reason, at = [], 0, "", 0
    while at < len(content):
        try:
            headers, block, at = parse_record(content, at)
            found.append((headers, block))
            last = at
        except Damaged as error:
            reason = reason or str(error)
            line = VERSION_LINE.search(content, at + 1)
            at = line.start() if line else len(content)
    return found, last, reason


def salvage(data: bytes) -> Iterator[tuple[str, int, int, dict | str, bytes]]:
    """('record', start, size, headers, block) and ('gap', start, size, reason, b'') that cover ``data``.

    Where a check fails, the search goes on one byte later for the next version line or gzip member that
    passes every check; the bytes between are one quarantined gap with the first failure as reason.

    Inside a gzip member the search goes on in the unpacked bytes. The records of a member all have its range. A
    member that holds a bad record, or does not unpack to its end, is a gap as a whole, and the records saved from
    it come out before the gap; the search then goes on after the bytes that gave them.
    """
    at, bad_from, reason = 0, None, ""
    while at < len(data):
        found, end, failure = [], at + 1, ""
        if data.startswith(GZIP_START, at):
            content, stop, broken = gzip_member(data, at)
            found, last, failure = records_of(content)
            failure = broken or failure or ("" if found else "empty gzip member")
            if found:
                end = unpacked_by(data, at, last) if broken else stop
        else:
            try:
                headers, block, end = parse_record(data, at)
                found.append((headers, block))
            except Damaged as error:
                failure = str(error)
        if bad_from is not None and not failure:
            yield "gap", bad_from, at - bad_from, reason, b""
            bad_from = None
        for headers, block in found:
            yield "record", at, end - at, headers, block
        if failure:
            if bad_from is None:
                bad_from, reason = at, failure
            line = VERSION_LINE.search(data, end)
            member = data.find(GZIP_START, end)
            places = [p for p in (line.start() if line else -1, member) if p >= 0]
            end = min(places, default=len(data))
        at = end
    if bad_from is not None:
        yield "gap", bad_from, len(data) - bad_from, reason, b""


def _page(value: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?[0-9]{1,19})>", value or "")
    return int(found[1]) if found else None


def read_archives(spark: SparkSession, path: str, *, with_payload: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records, gaps) of every archive below ``path``. An archive is read whole by one task, so
    writers bound its records and bytes; archives are independent and spread over the tasks.

    Payload length and digest are computed from the payload of a response and come from the headers
    of a revisit; ``http_headers`` is what an HTTP message has before its payload. Empty archives give nothing.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    schema = pa.schema(
        [("archive", pa.string()), ("start", pa.int64()), ("size", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()), ("uri", pa.string()),
         ("page_id", pa.int64()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("http_headers", pa.binary()), ("reason", pa.string())]
    )

    def read(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for archive, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                rows = []
                for kind, start, size, found, block in salvage(content):
                    if kind == "gap":
                        rows.append((archive, start, size, *[None] * 9, found))
                        continue
                    revisit = found["warc-type"] == "revisit"
                    body = payload(found, block)
                    length = found.get("warc-payload-length", "") if revisit else str(len(body))
                    digest = found.get("warc-payload-digest", "").removeprefix("sha1:") if revisit else sha1_base32(body)
                    head = block[: len(block) - len(body)]
                    rows.append(
                        (archive, start, size, found["warc-record-id"], found["warc-type"], found.get("warc-target-uri"), _page(found["warc-record-id"]),
                         _page(found.get("warc-refers-to")), int(length) if length.isdigit() else None, digest, body if with_payload else None,
                         head if with_payload and head else None, None)
                    )
                if rows:
                    yield arrow(schema, list(zip(*rows)))

    everything = files.mapInArrow(read, RECORD + ", reason string")
    with setting(spark, BATCH, "1"):  # archives
        everything = staged(everything, "warc-read")
    return everything.filter("reason is null").drop("reason"), everything.filter("reason is not null").select("archive", "start", "size", "reason")


def round_trip(pages: DataFrame, *, least_bytes: int = 0) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each page, as read back from
    archives written below the shared folder.

    Null html is the empty payload. Repeated rows are records of their own; those with the
    smallest id are all responses. A missing page_id is read back as missing. An empty table gives no rows.
    """
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    write_archives(page_records(pages, least_bytes=least_bytes), path)
    records, _ = read_archives(spark, path)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def query(spark, folder: str) -> DataFrame:
    return round_trip(table(spark, folder, "pages"))


SQL = r"""
with p as (
  select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages
), d as (
  select page_id, html, octet_length(encode(html)) as payload_bytes,
         array_to_string(list_transform(range(32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  (((('0x' || substr(hex, 1 + 5 * (i // 4)::int, 5))::bigint) >> (15 - 5 * (i % 4))::int) & 31)::int + 1, 1)), '') as payload_digest,
         min(page_id) over (partition by html) as first_id
  from p
)
select page_id, payload_bytes, payload_digest,
       case when page_id = first_id then 'response' else 'revisit' end as record_type,
       case when page_id <> first_id then first_id end as refers_to
from d
"""
