"""WARC archives: one gzip member per record, written and read in a stream.

``write_archives`` writes the rows of a table as records into a shared folder, ``read_records``
reads them back: each archive is read in pieces, every gzip member is decompressed as its bytes
come in, the record's content-length says where its block ends, and the block's and the payload's
SHA-256 are compared with the header.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsgauge.llm.workspace import Workspace, filesystem

PIECE = 1 << 18
ARCHIVE_BYTES = 1 << 26
RESPONSE, REVISIT = "response", "revisit"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, records long, archive_bytes long"
RECORD = (
    "record_id string, uri string, record_type string, refers_to string, payload_bytes long,"
    " payload_digest string, payload binary, problem string"
)


# ---------------------------------------------------------------- one record


def one_line(text: str | None) -> str:
    """Header values hold no line ends."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: "%%%02X" % ord(m[0]), text or "")


def record_bytes(
    record_id: str, uri: str, record_type: str, refers_to: str | None, payload: bytes, digest: str
) -> bytes:
    """One record, uncompressed. A revisit has the HTTP header only; its digest and payload length
    are those of the payload it stands for."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if record_type == RESPONSE else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {record_type}",
        f"WARC-Record-ID: <urn:page:{record_id}>",
        f"WARC-Target-URI: {one_line(uri)}",
        "WARC-Date: 2000-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if record_type == REVISIT:
        head[3:3] = [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Damaged(ValueError):
    """An archive or record that breaks the format."""


class MemberReader:
    """The bytes of one gzip member after the other, decompressed as they are asked for."""

    def __init__(self, read):
        self.read, self.raw = read, b""
        self.begin()

    def begin(self) -> None:
        self.inflate, self.ready = zlib.decompressobj(31), bytearray()

    def more(self) -> bool:
        """Decompress a further piece; False at the end of the member or of the archive."""
        if self.inflate.eof:
            return False
        self.raw = self.raw or self.read(PIECE)
        if not self.raw:
            return False
        try:
            self.ready += self.inflate.decompress(self.raw, PIECE)
        except zlib.error as error:
            raise Damaged(f"gzip: {error}") from error
        self.raw = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes:
        while (at := self.ready.find(mark)) < 0:
            if not self.more():
                raise Damaged("the header has no end")
        out = bytes(self.ready[:at])
        del self.ready[: at + len(mark)]
        return out

    def take(self, length: int) -> bytes:
        while len(self.ready) < length:
            if not self.more():
                raise Damaged("the block is shorter than its content-length")
        out = bytes(self.ready[:length])
        del self.ready[:length]
        return out

    def close(self) -> None:
        """Read up to the end of the member; what follows begins the next one."""
        while self.more():
            pass
        if not self.inflate.eof:
            raise Damaged("the gzip member has no end")
        if self.ready:
            raise Damaged("bytes after the record")

    def at_end(self) -> bool:
        self.raw = self.raw or self.read(PIECE)
        return not self.raw


def fields_of(head: bytes) -> dict[str, str]:
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not first.startswith("WARC/"):
        raise Damaged(f"not a WARC header: {first[:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def parse_stream(read) -> Iterator[dict]:
    """The records of one archive. ``read(n)`` gives its next bytes."""
    source = MemberReader(read)
    while not source.at_end():
        source.begin()
        fields = fields_of(source.until(b"\r\n\r\n"))
        try:
            length = int(fields["content-length"])
        except (KeyError, ValueError) as error:
            raise Damaged("no content-length") from error
        block = source.take(length)
        if source.take(4) != b"\r\n\r\n":
            raise Damaged("the block is longer than its content-length")
        source.close()
        http, mark, payload = block.partition(b"\r\n\r\n")
        kind = fields.get("warc-type")
        sized = re.search(rb"(?im)^content-length:\s*(\d+)", http)
        stated = fields.get("warc-payload-digest", "").removeprefix("sha256:")
        # a revisit has no payload of its own: the digest it states is that of the response
        digest = hashlib.sha256(payload).hexdigest() if kind == RESPONSE else stated
        problem = None
        if fields.get("warc-block-digest", "").removeprefix("sha256:") != hashlib.sha256(block).hexdigest():
            problem = "block digest"
        elif not mark or not sized:
            problem = "http header"
        elif kind == RESPONSE and (int(sized[1]) != len(payload) or digest != stated):
            problem = "payload digest"
        plain = lambda name: re.sub(r"^<urn:page:(.*)>$", r"\1", fields[name]) if name in fields else None
        yield {
            "record_id": plain("warc-record-id"),
            "uri": fields.get("warc-target-uri"),
            "record_type": kind,
            "refers_to": plain("warc-refers-to"),
            "payload_bytes": int(sized[1]) if sized else None,
            "payload_digest": digest,
            "payload": payload if kind == RESPONSE else None,
            "problem": problem,
        }


# ---------------------------------------------------------------- tables


def write_archives(df: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, level: int = 3) -> DataFrame:
    """Write rows (record_id, uri, record_type, refers_to, payload_digest: string, payload: binary)
    as archives into a folder that all executors share; returns the manifest, one row per archive.

    Lazy: the archives are written when the manifest is computed. A task that runs again writes
    under new names, and the manifest lists only the archives of the attempt that counted; so write
    the manifest to a table before reading. Archives close at ``archive_bytes``, between records.
    """

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        out, done, path, count, size = None, [], "", 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path, count, size = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(path, compression=None)
                pack = zlib.compressobj(level, zlib.DEFLATED, 31)
                data = pack.compress(
                    record_bytes(
                        row["record_id"],
                        row["uri"],
                        row["record_type"],
                        row["refers_to"],
                        row["payload"] or b"",
                        row["payload_digest"],
                    )
                )
                data += pack.flush()
                out.write(data)
                count, size = count + 1, size + len(data)
                if size >= archive_bytes:
                    out.close()
                    out = None
                    done.append((path, count, size))
        if out is not None:
            out.close()
            done.append((path, count, size))
        if done:
            yield pa.RecordBatch.from_pydict(
                {
                    "path": [f"{folder}/{os.path.basename(x[0])}" for x in done],
                    "records": [x[1] for x in done],
                    "archive_bytes": [x[2] for x in done],
                }
            )

    columns = ("record_id", "uri", "record_type", "refers_to", "payload_digest", "payload")
    return df.select(*columns).mapInArrow(write, MANIFEST)


def read_records(manifest: DataFrame, with_payload: bool = True, strict: bool = True) -> DataFrame:
    """Read the archives that a manifest (path, records) lists, one after the other in each task.

    Returns one row per record; digests are those of the bytes read. What does not fit is an error that
    names the archive: a broken format, a record whose digest or length is not the one stated, more or
    fewer records than the manifest has. Without ``strict`` it is told in ``problem``: beside the record,
    or, for the archive, in a last row without record_id; the records before it are returned.
    """

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [(n, {"long": pa.int64(), "binary": pa.binary()}.get(t, pa.string())) for n, t in (c.split() for c in RECORD.split(", "))]
        )
        for batch in batches:
            for path, promised in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist(), strict=True):
                fs, inner = filesystem(path)
                rows, size, count = [], 0, 0
                with fs.open_input_stream(inner, compression=None) as source:
                    try:
                        for record in parse_stream(source.read):
                            size, count = size + len(record["payload"] or b""), count + 1
                            if strict and record["problem"]:
                                raise Damaged(f"record {count}: {record['problem']}")
                            if not with_payload:
                                record["payload"] = None
                            rows.append(record)
                            if len(rows) >= 1000 or size > 1 << 24:
                                yield pa.RecordBatch.from_pylist(rows, schema)
                                rows, size = [], 0
                        if promised is not None and count != promised:
                            raise Damaged(f"{count} records of {promised}")
                    except Damaged as error:
                        if strict:
                            raise Damaged(f"{path}: {error}") from error
                        rows.append({"problem": str(error)})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return manifest.select("path", "records").mapInArrow(read, RECORD)


def archive_plan(pages: DataFrame, work: Workspace, least_bytes: int = 100) -> DataFrame:
    """What each page's record will be: (page_id, uri, payload, payload_digest, record_type,
    refers_to).

    Of pages with equal payloads of ``least_bytes`` or more, the smallest page_id is the response
    and the others revisit it; smaller payloads are all responses. A null html is an empty payload.
    Rows that repeat the smallest page_id are all responses; a null page_id is never referred to
    unless all of the equal pages have none (then all are responses).
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(
        F.col("page_id").alias("page_id"), F.col("url").alias("uri"), payload.alias("payload"),
        F.sha2(payload, 256).alias("payload_digest"),
    )
    large = rows.where(F.length("payload") >= least_bytes)
    # only payloads that occur more than once are looked up
    repeated = (
        large.groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("payload_digest", "first_id")
    )
    repeated = work.table(repeated, "repeated")
    revisit = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("page_id"))
    return rows.join(repeated, "payload_digest", "left").select(
        "page_id", "uri", "payload", "payload_digest",
        F.when(revisit, REVISIT).otherwise(RESPONSE).alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def archive_round_trip(spark: SparkSession, pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """Write every page as a WARC record and read the archives back: (page_id, payload_bytes,
    payload_digest, record_type, refers_to, uri, problem), all from the archives, which are verified.

    ``pages`` has page_id: long, url, html: string; further columns are ignored. An empty table
    gives no rows. Line ends and control characters in a url are stored percent-encoded.
    """
    work = Workspace(spark, "warc")
    plan = archive_plan(pages, work, least_bytes)
    rows = plan.select(
        F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("record_id"),
        "uri", "record_type", F.col("refers_to").cast("string").alias("refers_to"), "payload_digest", "payload",
    )
    manifest = work.table(write_archives(rows, f"{work.path}/archives"), "manifest")
    # the manifest is small enough for one task, the archives are not
    spread = manifest.repartition(4 * spark.sparkContext.defaultParallelism, "path")
    records = read_records(spread, with_payload=False)
    return records.select(
        F.expr("nullif(record_id, '')").cast("long").alias("page_id"),
        "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"), "uri", "problem",
    )
