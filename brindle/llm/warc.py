"""WARC archives: written by Spark tasks into the shared folder, read back record by record."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import column, shared_dir, written

CRLF = b"\r\n"
URN = "urn:page:"
#: An archive is closed once it is so large.
ARCHIVE_BYTES = 256 << 20
READ_BYTES = 1 << 16
#: At most so many tasks read archives.
READ_TASKS = 10_000
#: Copies of one payload are dealt to so many tasks in the join with the payload's response.
SALTS = 32

RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
_RECORD_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def headers(first: str, pairs: dict[str, str]) -> bytes:
    return "".join(f"{x}\r\n" for x in (first, *(f"{k}: {v}" for k, v in pairs.items()), "")).encode()


def uri(url: str | None) -> str:
    """The URL with blanks and control characters escaped, so that it stays on its header line."""
    return re.sub(r"[\x00-\x20\x7f-\xa0  ]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record. A revisit keeps the HTTP head alone, which still tells the payload's length."""
    block = headers("HTTP/1.1 200 OK", {"Content-Type": "text/html; charset=utf-8", "Content-Length": str(len(payload))})
    kind = "response" if refers_to is None else "revisit"
    more = {} if refers_to is None else {"WARC-Refers-To": f"<{URN}{refers_to}>", "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
    block += payload if refers_to is None else b""
    head = {
        "WARC-Type": kind, "WARC-Record-ID": f"<{URN}{'' if page_id is None else page_id}>", "WARC-Date": "1970-01-01T00:00:00Z", "WARC-Target-URI": uri(url),
        "WARC-Payload-Digest": f"sha1:{digest(payload)}", "WARC-Block-Digest": f"sha1:{digest(block)}", **more,
        "Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block)),
    }
    return headers("WARC/1.1", head) + block + CRLF + CRLF


def member(data: bytes) -> bytes:
    """A gzip member of its own."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class Stream:
    """Bytes of consecutive gzip members, decompressed as they are asked for."""

    def __init__(self, source) -> None:
        self.source, self.raw, self.out, self.z = source, b"", bytearray(), None

    def more(self) -> bool:
        """Decompress some more of the current member; False at its end."""
        while True:
            if not self.raw:
                self.raw = self.source.read(READ_BYTES)
            if self.z is None:
                if not self.raw:
                    return False
                self.z = zlib.decompressobj(31)
            elif not self.raw and not self.z.eof:
                raise ValueError("archive ends within a record")
            got = self.z.decompress(self.raw, READ_BYTES)
            self.raw = self.z.unused_data if self.z.eof else self.z.unconsumed_tail
            self.out += got
            if self.z.eof:
                self.z = None
                return bool(got)
            if got:
                return True

    def line(self) -> bytes:
        while (end := self.out.find(CRLF)) < 0:
            if not self.more():
                raise ValueError("archive ends within a header")
        got = bytes(self.out[:end])
        del self.out[: end + 2]
        return got

    def exactly(self, n: int) -> bytes:
        while len(self.out) < n:
            if not self.more() and len(self.out) < n:
                raise ValueError("archive ends within a block")
        got = bytes(self.out[:n])
        del self.out[:n]
        return got

    def at_end(self) -> bool:
        return not self.out and not self.more() and not self.out and not self.raw


def fields(stream: Stream) -> tuple[str, dict[str, str]]:
    first, out = stream.line().decode(), {}
    while line := stream.line().decode():
        k, _, v = line.partition(":")
        out[k.lower()] = v.strip()
    return first, out


def records(source) -> Iterator[dict]:
    """The records of an archive in order. A wrong version, length or digest raises ValueError."""
    stream = Stream(source)
    while not stream.at_end():
        version, head = fields(stream)
        if not version.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        block = stream.exactly(int(head["content-length"]))
        if stream.exactly(4) != CRLF + CRLF:
            raise ValueError("content-length doesn't match the block")
        if head["warc-block-digest"] != f"sha1:{digest(block)}":
            raise ValueError(f"block digest differs in {head['warc-record-id']}")
        http, _, payload = block.partition(CRLF + CRLF)
        length = int(re.search(rb"(?im)^content-length: *(\d+)", http)[1])
        kind, payload_digest = head["warc-type"], head["warc-payload-digest"].removeprefix("sha1:")
        if kind == "response" and (len(payload) != length or digest(payload) != payload_digest):
            raise ValueError(f"payload digest differs in {head['warc-record-id']}")
        number = lambda k: int(x) if (x := head.get(k, "").strip("<>").removeprefix(URN)) else None
        yield {"page_id": number("warc-record-id"), "url": head["warc-target-uri"], "record_type": kind, "refers_to": number("warc-refers-to"), "payload_bytes": length, "payload_digest": payload_digest, "payload": payload if kind == "response" else None}


def with_responses(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html and refers_to of each page: of equal payloads of at least min_bytes, the largest
    page_id is the response (null is smaller than any; rows that share it are all responses), others refer to it.
    """
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    p = p.withColumn("key", F.sha2("html", 256)).withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)))
    first = (
        p.filter(F.octet_length("html") >= min_bytes)
        .groupBy("key").agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1").select("key", "response", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    )
    refers = F.when((F.col("page_id") < F.col("response")) | F.col("page_id").isNull(), F.col("response"))
    return p.join(first, ["key", "salt"], "left").select("page_id", "url", "html", refers.alias("refers_to"))


def write(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write each page as a record; returns the archives' paths.

    A task's files have names of their own, and only those of tasks that ended well are listed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base)
        out, size = None, 0
        for batch in batches:
            for page_id, url, html, refers in zip(*(column(batch, c) for c in ("page_id", "url", "html", "refers_to")), strict=True):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, size = store.open_output_stream(f"{base}/{name}", compression=None), 0
                data = member(record(page_id.as_py(), url.as_py(), html.as_py().encode(), refers.as_py()))
                out.write(data)
                size += len(data)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"]})
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"]})

    return written(with_responses(pages, min_bytes).mapInArrow(run, "path string"), "warc-archives")


def read(archives: DataFrame) -> DataFrame:
    """The records of the archives in column path, one archive a task at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in column(batch, "path").to_pylist():
                store, name = fs.FileSystem.from_uri(path)
                rows, size = [], 0
                with store.open_input_stream(name, compression=None) as source:
                    for row in records(source):
                        rows.append(row)
                        size += len(row["payload"] or b"") + 200
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, _RECORD_ARROW)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _RECORD_ARROW)

    # a number of our own: Spark would merge the few rows that name many archives into one task
    return archives.repartition(max(1, min(archives.count(), READ_TASKS)), "path").mapInArrow(run, RECORD)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the pages to archives in the shared folder and read their records back.

    Columns beyond page_id, url and html are passed over; null html is an empty payload; a null page_id stays
    null; repeated rows give a record each; no pages give no archives and no records.
    """
    folder = shared_dir(pages.sparkSession)
    folder = folder if re.match(r"\w+:/", folder) else f"file://{folder}"
    return read(write(pages, f"{folder}/warc-{uuid.uuid4().hex}", min_bytes))


def op9_warc(spark, sf_dir: str) -> DataFrame:
    out = round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"), min_bytes=0)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
