import hashlib
import io
import zlib

import pytest

from opsgauge.llm import warc

BIG = "ü" * 60


def packed(data: bytes) -> bytes:
    pack = zlib.compressobj(3, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def record(payload: bytes, name="1", kind="response", refers=None) -> bytes:
    return warc.record_bytes(name, "http://a/\nx", kind, refers, payload, hashlib.sha256(payload).hexdigest())


def read(data: bytes):
    return list(warc.parse_stream(io.BytesIO(data).read))


def test_members_one_after_the_other_and_payload_with_line_ends():
    bodies = [b"", b"\r\n\r\n", b"WARC/1.1\r\n\r\n" * 9, bytes(range(256)) * 5000]
    out = read(b"".join(packed(record(b, str(i))) for i, b in enumerate(bodies)))
    assert [r["payload"] for r in out] == bodies
    assert [r["record_id"] for r in out] == ["0", "1", "2", "3"]
    assert {r["problem"] for r in out} == {None} and out[0]["uri"] == "http://a/%0Ax"


def test_revisit_keeps_length_and_digest():
    one = read(packed(record(b"abc", "2", "revisit", "1")))[0]
    assert (one["payload"], one["payload_bytes"], one["refers_to"]) == (None, 3, "1")
    assert one["payload_digest"] == hashlib.sha256(b"abc").hexdigest() and one["problem"] is None


@pytest.mark.parametrize(
    "data",
    [
        packed(record(b"abc"))[:-9],
        packed(record(b"abc") + b"more"),
        packed(record(b"abc").replace(b"msgtype=response\r\nContent-Length: ", b"msgtype=response\r\nContent-Length: 9")),
        packed(b"HTTP/1.1 200 OK\r\n\r\n"),
        b"not gzip",
    ],
)
def test_damage_is_told(data):
    with pytest.raises(warc.Damaged):
        read(data)


def test_digests_are_verified():
    assert read(packed(record(b"abc").replace(b"abc", b"abd")))[0]["problem"] == "block digest"


def test_round_trip_of_odd_rows(spark):
    rows = [
        (3, "u", BIG), (1, "u", BIG), (1, "u", BIG), (2, None, BIG), (4, "u", None), (5, "u", ""), (6, "u", "short"), (7, "u", "short"),
        (None, "u", BIG), (8, "\r\n", "x" * 300_000),
    ]
    pages = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, payload string, path int")
    got = sorted(
        (r.page_id is None, r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in warc.archive_round_trip(spark, pages).collect()
    )
    assert got == [
        (False, 1, 120, "response", None), (False, 1, 120, "response", None), (False, 2, 120, "revisit", 1), (False, 3, 120, "revisit", 1),
        (False, 4, 0, "response", None), (False, 5, 0, "response", None), (False, 6, 5, "response", None), (False, 7, 5, "response", None),
        (False, 8, 300_000, "response", None), (True, 0, 120, "revisit", 1),
    ]
    assert warc.archive_round_trip(spark, pages.limit(0)).count() == 0


def test_archives_close_at_their_size(spark):
    rows = [(str(i), "u", "response", None, hashlib.sha256(b"x" * i).hexdigest(), b"x" * i) for i in range(50)]
    df = spark.createDataFrame(rows, "record_id string, uri string, record_type string, refers_to string, payload_digest string, payload binary")
    work = warc.Workspace(spark, "test")
    manifest = work.table(warc.write_archives(df.coalesce(1), f"{work.path}/archives", archive_bytes=2000), "manifest")
    assert manifest.count() > 3
    back = warc.read_records(manifest).collect()
    assert sorted((r.record_id, bytes(r.payload)) for r in back) == sorted((r[0], r[5]) for r in rows)


def test_damaged_archives_are_told(spark):
    """Through Spark: an error by default, else rows that name what is wrong."""
    rows = [(str(i), "u", "response", None, hashlib.sha256(b"x" * i).hexdigest(), b"x" * i) for i in range(40)]
    df = spark.createDataFrame(rows, "record_id string, uri string, record_type string, refers_to string, payload_digest string, payload binary")
    work = warc.Workspace(spark, "test")
    manifest = work.table(warc.write_archives(df.repartition(3), f"{work.path}/archives"), "manifest")
    listed = {r.path: r.records for r in manifest.collect()}
    cut, lost, *_ = sorted(listed)
    data = open(cut.removeprefix("file://"), "rb").read()
    with open(cut.removeprefix("file://"), "wb") as out:
        out.write(data[:-5])
    members = [m for m in open(lost.removeprefix("file://"), "rb").read().split(b"\x1f\x8b\x08") if m]
    with open(lost.removeprefix("file://"), "wb") as out:
        out.write(b"".join(b"\x1f\x8b\x08" + m for m in members[:-1]))
    with pytest.raises(Exception, match="Damaged"):
        warc.read_records(manifest).count()
    got = warc.read_records(manifest, strict=False).collect()
    assert sum(r.record_id is not None for r in got) == 40 - 2
    problems = [r.problem for r in got if r.problem]
    assert len(problems) == 2 and f"{listed[lost] - 1} records of {listed[lost]}" in problems
    swapped = work.table(df.withColumn("payload_digest", df["record_id"]), "swapped")
    bad = work.table(warc.write_archives(swapped, f"{work.path}/swapped"), "bad")
    assert {r.problem for r in warc.read_records(bad, strict=False).collect()} == {"payload digest"}
    with pytest.raises(Exception, match="payload digest"):
        warc.read_records(bad).count()
