"""WARC archives: written and read in pieces that stay small however large a record is.

Writing. One record per page, payload the page's bytes behind an HTTP header. Of equal payloads of at least
`least_revisit` bytes, that with the smallest id is a `response`; the others are `revisit` records that name it and carry no payload. A
payload longer than `segment` bytes goes out as a segmented record: its first part, then `continuation` records with
their number and the id of the first. Spark's text writer writes the records, one row each, with the empty line that ends a record
as its separator, so archives can lie in any store, and a lost task is written anew.

Reading. A gzip file is read by one task from front to back, cut at empty lines into rows; a parser keeps its place by
Content-Length over these rows and gives out the table of chunks: record id, chunk number, at most `chunk` bytes of payload,
and the SHA-1 of the payload so far, carried from chunk to chunk and over continuation records. `last` marks a record's last chunk, where digest and length are
those of the whole payload; a record without payload has one chunk. No record is ever whole in memory.

Null html: an empty payload. Null url: no target. Null ids: a record of id `null`; it revisits a page with an id if there is one. Rows with equal
id and payload are all `response` if theirs is the smallest id. Columns not named are not read. An empty table gives no record.
"""

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

END = "\r\n\r\n"
SEGMENT, CHUNK = 1 << 20, 1 << 20
#: Bytes of chunks given out at once.
BATCH = 1 << 23
CHUNKS = (
    "record_id string, chunk_no int, type string, target string, refers_to string, payload binary, "
    "declared_digest string, declared_bytes long, digest string, bytes long, last boolean"
)
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def base32(sha1: str) -> str:
    """Hexadecimal digest in upper-case base32."""
    return base64.b32encode(bytes.fromhex(sha1)).decode()


def page_uri(page_id) -> str:
    return f"urn:page:{'null' if page_id is None else page_id}"


def _head(fields: dict[str, object], n: int) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields.items() if v is not None), f"Content-Length: {n}"]
    return ("\r\n".join(lines) + END).encode()


def records(page_id, url: str | None, payload: bytes | None, sha1: str, n: int, refers_to, segment: int = SEGMENT) -> Iterator[bytes]:
    """The records of one page without the empty line behind each. payload: None for a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}{END}".encode()
    own = f"<{page_uri(page_id)}>"
    fields = {
        "WARC-Type": "response" if payload is not None else "revisit",
        "WARC-Record-ID": own,
        "WARC-Date": "2000-01-01T00:00:00Z",
        "WARC-Target-URI": url and _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url),
        "WARC-Payload-Digest": f"sha1:{base32(sha1)}",
        "Content-Type": "application/http;msgtype=response",
    }
    if payload is None:
        fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        fields["WARC-Refers-To"] = f"<{page_uri(refers_to)}>"
        yield _head(fields, len(http)) + http
        return
    if len(payload) > segment:
        fields["WARC-Segment-Number"] = 1
    first = payload[:segment]
    yield _head(fields, len(http) + len(first)) + http + first
    for number, start in enumerate(range(segment, len(payload), segment), 2):
        part = payload[start : start + segment]
        more = {
            "WARC-Type": "continuation",
            "WARC-Record-ID": f"<{page_uri(page_id)}:{number}>",
            "WARC-Date": fields["WARC-Date"],
            "WARC-Segment-Origin-ID": own,
            "WARC-Segment-Number": number,
            "WARC-Segment-Total-Length": len(http) + len(payload) if start + segment >= len(payload) else None,
        }
        yield _head(more, len(part)) + part


def write_archives(pages: DataFrame, path: str, least_revisit: int = 0, segment: int = SEGMENT) -> None:
    """Write (page_id, url, html) as gzip archives below `path`."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    given = pages.select("page_id", F.col("url").cast("string"), payload.alias("payload"))
    given = given.withColumns({"sha1": F.sha1("payload"), "n": F.octet_length("payload").cast("long")})
    firsts = given.filter(F.col("n") >= least_revisit).groupBy("sha1", "n").agg(F.min("page_id").alias("first"))
    typed = given.join(firsts, ["sha1", "n"], "left").withColumn(
        "revisit", (F.col("n") >= least_revisit) & ~F.col("first").eqNullSafe(F.col("page_id"))
    )
    typed = typed.select("page_id", "url", F.when(~F.col("revisit"), F.col("payload")).alias("payload"), "sha1", "n", "first")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for row in zip(*batch.columns, strict=True):
                for record in records(*(x.as_py() for x in row), segment):
                    held.append(record)
                    size += len(record)
                    if size >= BATCH:
                        yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["record"])
                        held, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["record"])

    lines = typed.mapInArrow(build, "record binary").select(F.col("record").cast("string"))
    lines.write.option("compression", "gzip").option("lineSep", END).text(path)


class Parser:
    """Takes the rows of one archive in order and gives out chunks."""

    def __init__(self, chunk: int):
        self.chunk, self.open = chunk, None
        self.rest, self.need, self.gap, self.http = b"", 0, 0, False
        self.fields: dict[str, str] = {}

    def feed(self, data: bytes) -> Iterator[tuple]:
        while data:
            if self.need:
                if self.http:  # up to the empty line, which ends this row
                    self.rest += data[: self.need]
                    data = self._after(data)
                    if self.rest.endswith(b"\r\n\r\n") or not self.need:
                        found = re.search(rb"(?i)\r\ncontent-length: *(\d+)", self.rest)
                        self.open["declared"] = int(found[1]) if found else None
                        self.rest, self.http = b"", False
                else:
                    self.open["sha1"].update(part := data[: self.need])
                    self.open["bytes"] += len(part)
                    self.open["held"] += part
                    data = self._after(data)
                    while len(self.open["held"]) > self.chunk:
                        yield self._chunk(bytes(self.open["held"][: self.chunk]), False)
                        del self.open["held"][: self.chunk]
                if not self.need:
                    yield from self._record_ends()
            elif self.gap:
                data, self.gap = data[self.gap :], max(0, self.gap - len(data))
            else:
                self.rest += data
                data = b""
                if not self.rest.strip():
                    self.rest = b""
                elif self.rest.endswith(b"\r\n\r\n"):
                    self._record_begins()
                    if not self.need:
                        yield from self._record_ends()

    def _after(self, data: bytes) -> bytes:
        left = data[self.need :]
        self.need -= len(data) - len(left)
        return left

    def _record_begins(self) -> None:
        lines = self.rest.decode("utf-8", "replace").split("\r\n")[1:]
        self.fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if v}
        self.rest, self.gap, self.need = b"", len(END), int(self.fields.get("content-length", 0))
        if self.fields.get("warc-type") != "continuation":
            self.http = self.need > 0 and self.fields.get("content-type", "").startswith("application/http")
            self.open = {"fields": self.fields, "sha1": hashlib.sha1(), "bytes": 0, "held": bytearray(), "no": 0, "declared": None}

    def _record_ends(self) -> Iterator[tuple]:
        if "warc-segment-number" not in self.fields or "warc-segment-total-length" in self.fields:
            yield self._chunk(bytes(self.open["held"]), True)

    def _chunk(self, part: bytes, last: bool) -> tuple:
        own, fields = self.open, self.open["fields"]
        own["no"] += 1
        bare = lambda name: (fields.get(name) or "").strip("<>") or None
        digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
        return (
            bare("warc-record-id"), own["no"], fields.get("warc-type"), fields.get("warc-target-uri"), bare("warc-refers-to"),
            part, digest, own["declared"], base32(own["sha1"].hexdigest()), own["bytes"], last,
        )


def read_chunks(spark: SparkSession, path: str, chunk: int = CHUNK) -> DataFrame:
    """The table CHUNKS of all archives below `path`."""
    rows = spark.read.option("lineSep", END).text(path)
    rows = rows.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"))
    names = [x.split()[0] for x in CHUNKS.split(", ")]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            *((x, pa.string()) for x in names[:1]), ("chunk_no", pa.int32()), *((x, pa.string()) for x in names[2:5]), ("payload", pa.binary()),
            ("declared_digest", pa.string()), ("declared_bytes", pa.int64()), ("digest", pa.string()), ("bytes", pa.int64()), ("last", pa.bool_()),
        ])
        parser, file, held, size = Parser(chunk), None, [], 0

        def packed() -> pa.RecordBatch:
            columns = zip(*held, strict=True) if held else [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, schema.types, strict=True)], schema=schema)

        for batch in batches:
            for value, at in zip(*batch.columns, strict=True):
                if (at := at.as_py()) != file:
                    parser, file = Parser(chunk), at
                for row in parser.feed(value.as_py() + END.encode()):
                    held.append(row)
                    size += len(row[5]) + 500
                    if size >= BATCH:
                        yield packed()
                        held, size = [], 0
        yield packed()

    return rows.mapInArrow(parse, CHUNKS)
