"""Salvage inside gzip members, HTTP messages, and the size of archives."""

import gzip
import random

import pytest

from salvor.llm import warc


def record(name, body, content_type="text/html", digest=None):
    digest = digest or warc.sha1_base32(body)
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{name}>\r\nWARC-Payload-Digest: sha1:{digest}\r\nContent-Type: {content_type}\r\nContent-Length: {len(body)}\r\n\r\n"
    return head.encode() + body + b"\r\n\r\n"


def names(found):
    return [warc._page(f[3]["warc-record-id"]) for f in found if f[0] == "record"]


def bodies(n, size=300):
    pick = random.Random(7)
    return [bytes(pick.randrange(32, 127) for _ in range(size)) for _ in range(n)]


@pytest.mark.parametrize("level", [0, 6])
def test_one_bad_record_in_a_member_loses_no_other(level):
    parts = [record(i, b) for i, b in enumerate(bodies(12))]
    parts[4] = parts[4].replace(b"sha1:", b"sha1:x")
    after = gzip.compress(record(99, b"next"))
    member = gzip.compress(b"".join(parts), level)
    found = list(warc.salvage(member + after))
    assert names(found) == [i for i in range(12) if i != 4] + [99]
    assert [f[1:4] for f in found if f[0] == "gap"] == [(0, len(member), "payload digest differs")]


@pytest.mark.parametrize("level", [0, 6])
@pytest.mark.parametrize("size", [300, 30_000])
def test_records_before_the_damage_of_a_member_stay(level, size):
    member = gzip.compress(b"".join(record(i, b) for i, b in enumerate(bodies(12, size))), level)
    after = gzip.compress(record(99, b"next"))
    half = list(warc.salvage(member[: len(member) // 2]))
    assert names(half) == [0, 1, 2, 3, 4, 5][: len(names(half))] and len(names(half)) >= 5
    assert half[-1][0] == "gap" and sum(f[0] == "gap" for f in half) == 1
    assert half[-1][1:3] == (0, len(member) // 2)
    both = list(warc.salvage(member[: len(member) // 2] + after))
    assert names(both) == names(half) + [99]
    # A wrong check sum at the end of the member: every record holds its own checks, and none comes twice.
    wrong = member[:-8] + bytes([member[-8] ^ 255]) + member[-7:]
    assert names(warc.salvage(wrong + after)) == [*range(12), 99]


def test_http_message_digests_its_body():
    body = b"<p>text</p>\r\n\r\nmore"
    message = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + body
    kind = "application/http; msgtype=response"
    good = record(1, message, kind, warc.sha1_base32(body))
    found = list(warc.salvage(good + record(2, message, kind, warc.sha1_base32(b"other"))))
    assert names(found) == [1] and found[-1][3] == "payload digest differs"
    assert warc.payload(found[0][3], found[0][4]) == body


def test_http_message_as_rows(spark, tmp_path):
    body, head = b"<p>text</p>", b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n"
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(record(1, head + body, "application/http", warc.sha1_base32(body))))
    records, gaps = warc.read_archives(spark, str(tmp_path), with_payload=True)
    row = records.first()
    assert (row["payload_bytes"], row["payload_digest"]) == (len(body), warc.sha1_base32(body))
    assert (bytes(row["payload"]), bytes(row["http_headers"])) == (body, head)
    assert gaps.count() == 0


def test_archives_are_bounded_by_bytes(spark, tmp_path):
    from pyspark.sql import functions as F

    html = F.when(F.col("id") == 7, F.repeat(F.lit("z"), 50_000)).otherwise(F.concat(F.repeat(F.lit("y"), 4000), F.col("id").cast("string")))
    pages = spark.range(0, 300, 1, 2).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), html.alias("html"))
    records = warc.page_records(pages)
    warc.write_archives(records, f"{tmp_path}/bytes", bytes_a_file=20_000)
    sizes = [f.stat().st_size for f in (tmp_path / "bytes").rglob("*.txt")]
    assert len(sizes) > 60 and sorted(sizes)[-2] <= 20_000 < sorted(sizes)[-1] < 52_000
    assert sorted(r["page_id"] for r in warc.read_archives(spark, f"{tmp_path}/bytes")[0].collect()) == list(range(300))
    warc.write_archives(records, f"{tmp_path}/rows", records_a_file=10)
    found = [f.read_bytes().count(b"WARC/1.1\r\n") for f in (tmp_path / "rows").rglob("*.txt")]
    assert sum(found) == 300 and max(found) == 10
