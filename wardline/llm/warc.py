"""WARC archives: a writer, and a sequential reader that checks what it reads.

Each record is one gzip member. The reader inflates members step by step, frames the block by Content-Length and
verifies block and payload digests. Files go through pyarrow's file systems, so any address that
``spark.checkpoint.dir`` may hold and pyarrow knows works on every executor.
"""

from __future__ import annotations

import base64
import hashlib
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import map_texts, new_folder, settle, steps

ARCHIVE_BYTES = 64 << 20
CHUNK = 1 << 18
DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class BrokenArchive(ValueError):
    """The archive does not hold what its framing or digests say."""


def sha1_text(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                 revisit: bool) -> bytes:
    """One record, uncompressed. A revisit has no payload of its own; its length is carried in a field."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id)),
              ("WARC-Date", DATE), ("Content-Type", "application/http;msgtype=response"),
              ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{sha1_text(block)}"),
              ("X-Page-ID", "" if page_id is None else str(page_id)), ("X-Payload-Length", str(len(payload)))]
    if url is not None:
        fields.append(("WARC-Target-URI", urllib.parse.quote(url, safe=":/?#[]@!$&'()*+,;=%-._~")))
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to)),
                   ("X-Refers-To-Page-ID", str(refers_to))]
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Member:
    """The inflated bytes of one gzip member, read on demand from ``stream``; ``rest`` is what follows it."""

    def __init__(self, stream, start: bytes):
        self.stream, self.rest = stream, start
        self.inflater = zlib.decompressobj(31)

    def read(self) -> bytes:
        """Up to ``CHUNK`` inflated bytes; empty at the end of the member."""
        while not self.inflater.eof:
            raw = self.rest or self.stream.read(CHUNK)
            if not raw:
                raise BrokenArchive("the archive ends inside a record")
            try:
                out = self.inflater.decompress(raw, CHUNK)
            except zlib.error as e:
                raise BrokenArchive(f"bad gzip data: {e}") from e
            self.rest = self.inflater.unused_data if self.inflater.eof else self.inflater.unconsumed_tail
            if out:
                return out
        return b""


def read_records(stream) -> Iterator[tuple[dict[str, str], int, str, bytes]]:
    """(fields, payload length, payload digest, payload) of every record of an archive, in order.

    Raises BrokenArchive on bad framing, a truncated file or a digest that does not hold. A payload is gathered for
    the caller; everything else is held a chunk at a time.
    """
    rest = stream.read(CHUNK)
    while rest:
        member = _Member(stream, rest)
        data = b""
        while b"\r\n\r\n" not in data:
            more = member.read()
            if not more:
                raise BrokenArchive("a record has no header")
            data += more
        head, _, data = data.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise BrokenArchive("a record does not start with WARC/")
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        left = int(fields["Content-Length"])
        block, payload, http = hashlib.sha1(), hashlib.sha1(), b""
        body: list[bytes] | None = None
        tail = b""
        while True:
            part, data = data[:left], data[left:]
            left -= len(part)
            block.update(part)
            if body is None:
                http += part
                cut = http.find(b"\r\n\r\n")
                if cut >= 0:
                    body = [http[cut + 4:]]
                    payload.update(body[0])
            else:
                body.append(part)
                payload.update(part)
            tail += data
            data = member.read()
            if not data:
                break
        if left or tail != b"\r\n\r\n":
            raise BrokenArchive("a record's length differs from its Content-Length")
        if fields["WARC-Block-Digest"] != "sha1:" + base64.b32encode(block.digest()).decode():
            raise BrokenArchive(f"block digest of {fields['WARC-Record-ID']} does not hold")
        stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        content = b"".join(body or [])
        if fields["WARC-Type"] == "revisit":
            yield fields, int(fields["X-Payload-Length"]), stated, b""
        else:
            digest = base64.b32encode(payload.digest()).decode()
            if digest != stated:
                raise BrokenArchive(f"payload digest of {fields['WARC-Record-ID']} does not hold")
            yield fields, len(content), digest, content
        rest = member.rest or stream.read(CHUNK)


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html") -> DataFrame:
    """Write a record per row into archives under ``folder``; returns the settled list (path, records).

    Of rows with equal payloads of at least ``least_bytes`` bytes (null html: empty), those with the smallest id are
    responses and the others revisit it; smaller payloads, and payloads without any id, are all responses. Payloads
    are compared by length and SHA-1, and only ids and digests are shuffled for that. A task that is run again
    writes files of another name; only those of the run that counted are listed.
    """
    payload = F.coalesce(F.col(html_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    keys = ["sha1", "size"]
    rows = rows.withColumn("sha1", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    known = rows.where(F.col("size") >= least_bytes).select("page_id", *keys)
    first = known.groupBy(*keys).agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = (known.join(first, keys).where("first is not null and not page_id <=> first")
             .select(F.col("page_id").alias("_id"), F.col("sha1").alias("_sha1"), "first").distinct())
    again = settle(again, "revisits")           # read back with a known size: broadcast only where it is small
    marked = rows.join(again, F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("sha1") == F.col("_sha1")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        out, name, count, size = None, "", 0, 0
        for part in steps(batches, 2):
            for page_id, url, body, sha1, refers_to in zip(*(c.to_pylist() for c in part.columns)):
                if out is None:
                    name, count, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = files.open_output_stream(f"{root}/{name}", compression=None)
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                member = gzip_member(record_bytes(page_id, url, body, digest, refers_to, refers_to is not None))
                out.write(member)
                count, size = count + 1, size + len(member)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [count]})
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [count]})

    listed = map_texts(marked.select("page_id", "url", "payload", "sha1", "first"), run, "path string, records bigint")
    return settle(listed, "archives")


def read_archives(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of the archives listed in ``path``, each file read once from start to end.

    (page_id, url, record_type, refers_to, payload_bytes, payload_digest) and, if asked for, the payload.
    """
    schema = ("page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
              "payload_digest string") + (", payload binary" if with_payload else "")
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def number(text: str | None) -> int | None:
        return int(text) if text else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()][:len(names)]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, at = pafs.FileSystem.from_uri(path)
                rows: list[tuple] = []
                held = 0
                with files.open_input_stream(at, compression=None) as stream:
                    for fields, size, digest, payload in read_records(stream):
                        row = (number(fields["X-Page-ID"]), fields.get("WARC-Target-URI"), fields["WARC-Type"],
                               number(fields.get("X-Refers-To-Page-ID")), size, digest, payload)
                        rows.append(row[:len(names)])
                        held += len(payload) if with_payload else 64
                        if held > 4 << 20:
                            yield _batch(rows, names, types)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows, names, types)

    files = max(1, archives.count())
    return archives.select("path").repartition(files).mapInArrow(run, schema)


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def archive_folder(spark) -> str:
    return new_folder(spark, "warc")
