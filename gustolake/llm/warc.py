"""WARC archives written and read as a stream of chunk rows.

A record travels as rows of (record identifier, chunk number, bytes), so that
no record need be held whole: the writer compresses chunk after chunk into one
gzip member a record, carrying its SHA-1 along and comparing it with the
announced one; the reader decompresses and parses piece by piece and returns
chunk rows that carry the count and digest of the payload so far.

Records with equal payloads are written once: that of the largest page_id is
the response, the others are revisit records that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustolake.llm import _shared as S

CHUNK = 1 << 20
ARCHIVE_BYTES = 256 << 20
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_DATE = "2000-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CHUNKS = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, sha1 string, "
          "chunk_no int, last boolean, data binary")
MANIFEST = "path string, records long, bytes long"
READ = ("archive string, at long, page_id long, url string, record_type string, refers_to long, chunk_no int, last boolean, "
        "bytes_so_far long, digest_so_far string, data binary")


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's URI; a path without scheme is local (as Spark has it in tests)."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    path = re.sub(r"^file:/+", "file:///", path).replace("s3a://", "s3://", 1)
    return fs.FileSystem.from_uri(path)


def base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


# --- writing -----------------------------------------------------------------------------
def decided(pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_revisit_bytes: int) -> DataFrame:
    """Pages with payload (UTF-8), its length and SHA-1, record_type and refers_to."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"),
    ).withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("same", F.sha2("payload", 256))
    first = (
        rows.where(F.col("payload_bytes") >= min_revisit_bytes).groupBy("same")
        .agg(F.max("page_id").alias("latest"), F.count(F.lit(1)).alias("n")).where("n > 1 and latest is not null").select("same", "latest")
    )
    revisit = F.col("latest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("latest"))
    return rows.join(first, "same", "left").select(
        "page_id", "url", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("latest")).alias("refers_to"), "payload_bytes", F.sha1("payload").alias("sha1"), "payload",
    )


def to_chunks(rows: DataFrame, chunk_bytes: int = CHUNK) -> DataFrame:
    """Chunk rows of ``decided`` rows; a record's rows follow each other in one partition. Revisits carry no data."""
    S.ship_code(rows.sparkSession)
    schema = S.arrow_schema(CHUNKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        for b in batches:
            for row in zip(*[c for c in b.columns], strict=True):
                *head, payload = row
                head = [v.as_py() for v in head]
                view = memoryview(payload.as_buffer()) if head[2] == "response" else memoryview(b"")
                n = max(1, -(-len(view) // chunk_bytes))
                for k in range(n):
                    data = view[k * chunk_bytes : (k + 1) * chunk_bytes].tobytes()
                    out.append((*head, k, k == n - 1, data))
                    size += len(data) + 200
                    if size >= 4 * chunk_bytes:
                        yield S.batch_of(out, schema)
                        out, size = [], 0
        if out:
            yield S.batch_of(out, schema)

    return rows.mapInArrow(run, CHUNKS)


def _urn(page_id: int | None) -> str:
    return f"urn:page:{'null' if page_id is None else page_id}"


def _header(page_id, url, record_type, refers_to, payload_bytes, sha1) -> bytes:
    block = len(_HTTP) + (payload_bytes if record_type == "response" else 0)
    lines = [
        "WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: <{_urn(page_id)}>", f"WARC-Date: {_DATE}",
        "Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha1:{base32(sha1)}",
        f"X-Payload-Length: {payload_bytes}", f"Content-Length: {block}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", url))
    if record_type == "revisit":
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <{_urn(refers_to)}>"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + _HTTP


def write_archives(chunks: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, level: int = 1) -> DataFrame:
    """Write chunk rows as ``.warc.gz`` files into ``folder`` (shared by all executors); returns the manifest.

    A file is written under a name of the task's attempt and moved to its final
    name once closed, so a repeated or lost task leaves no half-written archive.
    """
    schema = S.arrow_schema(MANIFEST)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        where, root = _filesystem(folder)
        state: dict = {"no": 0, "file": None}

        def open_() -> None:
            state.update(temp=f"{root}/_attempt-{task.taskAttemptId()}-{uuid.uuid4().hex}", records=0, bytes=0)
            state["file"] = where.open_output_stream(state["temp"], compression=None)

        def put(data: bytes) -> None:
            state["file"].write(data)
            state["bytes"] += len(data)

        def close() -> tuple:
            state["file"].close()
            name = f"part-{task.partitionId():06d}-{state['no']:04d}.warc.gz"
            where.move(state["temp"], f"{root}/{name}")
            state.update(no=state["no"] + 1, file=None)
            return (f"{folder}/{name}", state["records"], state["bytes"])

        done = []
        for b in batches:
            for row in zip(*[c for c in b.columns], strict=True):
                *head, sha1, chunk_no, last, data = (v if k == 8 else v.as_py() for k, v in enumerate(row))
                if chunk_no == 0:
                    if state["file"] is None:
                        open_()
                    gz, digest = zlib.compressobj(level, zlib.DEFLATED, 31), hashlib.sha1(usedforsecurity=False)
                    put(gz.compress(_header(*head, sha1)))
                view = memoryview(data.as_buffer())
                digest.update(view)
                put(gz.compress(view))
                if last:
                    if head[2] == "response" and digest.hexdigest() != sha1:
                        raise ValueError(f"payload of {_urn(head[0])} is not what was announced")
                    put(gz.compress(b"\r\n\r\n") + gz.flush())
                    state["records"] += 1
                    if state["bytes"] >= archive_bytes:
                        done.append(close())
        if state["file"] is not None:
            done.append(close())
        yield S.batch_of(done, schema)

    return chunks.mapInArrow(run, MANIFEST)


# --- reading -----------------------------------------------------------------------------
class _Members:
    """The decompressed stream of a file of gzip members, read in bounded pieces."""

    def __init__(self, file, piece: int) -> None:
        self.file, self.piece = file, piece
        self.inflate, self.raw, self.buffer = None, b"", bytearray()
        self.at = 0  # of the compressed stream
        self.member_at = 0

    def more(self) -> bool:
        """Add a piece to the buffer; False at the end of the file."""
        while True:
            if not self.raw:
                self.raw = self.file.read(self.piece)
                if not self.raw:
                    return False
            if self.inflate is None:
                self.inflate, self.member_at = zlib.decompressobj(31), self.at
            n = len(self.raw)
            out = self.inflate.decompress(self.raw, self.piece)
            rest = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            self.at += n - len(rest)
            self.raw = rest
            if self.inflate.eof:
                self.inflate = None
            if out:
                self.buffer += out
                return True

    def until(self, mark: bytes) -> bytes | None:
        """What comes before ``mark``; None at the end of the file."""
        seen = 0
        while (k := self.buffer.find(mark, seen)) < 0:
            seen = max(0, len(self.buffer) - len(mark) + 1)
            if not self.more():
                if self.buffer:
                    raise ValueError("the archive is cut off in a header")
                return None
        out = bytes(self.buffer[:k])
        del self.buffer[: k + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        """Up to ``n`` bytes, at least one."""
        if not self.buffer and not self.more():
            raise ValueError("the archive is cut off in a record")
        out = bytes(self.buffer[:n])
        del self.buffer[: len(out)]
        return out


def _page(urn: str) -> int | None:
    v = urn.strip("<>").removeprefix("urn:page:")
    return None if v == "null" else int(v)


def _records(stream: _Members, archive: str, chunk_bytes: int, with_data: bool) -> Iterator[tuple]:
    while True:
        at = stream.member_at if stream.buffer else stream.at
        head = stream.until(b"\r\n\r\n")
        if head is None:
            return
        version, *lines = head.decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at {at} of {archive}")
        fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        left = int(fields["content-length"])
        http = stream.until(b"\r\n\r\n")
        left -= len(http) + 4
        page, kind = _page(fields["warc-record-id"]), fields["warc-type"]
        refers = _page(fields["warc-refers-to"]) if "warc-refers-to" in fields else None
        uri = fields.get("warc-target-uri")
        url = None if uri is None else re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), uri)
        announced = fields["warc-payload-digest"].removeprefix("sha1:")
        digest, n, k = hashlib.sha1(usedforsecurity=False), 0, 0
        while True:
            piece = bytearray()
            while left and len(piece) < chunk_bytes:
                got = stream.take(min(left, chunk_bytes - len(piece)))
                piece += got
                left -= len(got)
            digest.update(piece)
            n += len(piece)
            last = not left
            so_far = base64.b32encode(digest.digest()).decode()
            if last and kind == "revisit":
                n, so_far = int(fields["x-payload-length"]), announced
            elif last and so_far != announced:
                raise ValueError(f"payload of {_urn(page)} in {archive} does not match its digest")
            yield (archive, at, page, url, kind, refers, k, last, n, so_far, bytes(piece) if with_data else None)
            k += 1
            if last:
                break
        if stream.until(b"\r\n\r\n") != b"":
            raise ValueError(f"record at {at} of {archive} is longer than announced")


def read_archives(manifest: DataFrame, chunk_bytes: int = CHUNK, with_data: bool = True, archives: int | None = None) -> DataFrame:
    """Chunk rows of all records of the archives in ``manifest.path``, a task per archive.

    ``with_data=False`` leaves the bytes out; they are read and digested all the same.
    """
    S.ship_code(manifest.sparkSession)
    schema = S.arrow_schema(READ)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        for b in batches:
            for path in b.column(0).to_pylist():
                where, at = _filesystem(path)
                with where.open_input_stream(at, compression=None) as f:
                    for row in _records(_Members(f, 1 << 16), path, chunk_bytes, with_data):
                        out.append(row)
                        size += 300 + len(row[-1] or b"")
                        if size >= 4 * chunk_bytes:
                            yield S.batch_of(out, schema)
                            out, size = [], 0
        if out:
            yield S.batch_of(out, schema)

    paths = manifest.select("path")
    n = archives if archives is not None else paths.count()
    return paths.repartition(max(1, n)).mapInArrow(run, READ)


def round_trip(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit_bytes: int = 0,
    chunk_bytes: int = CHUNK,
) -> DataFrame:
    """Write a record per page to archives in the shared folder, read them back, and return what they say.

    Columns: page_id, payload_bytes, payload_digest (base32 SHA-1), record_type,
    refers_to. Null html is empty. Of equal payloads the rows of the largest
    page_id are responses, repeated rows included; null ids revisit it, and
    groups of null ids only are all responses. An empty table gives an empty
    result.
    """
    folder = S.shared_path(pages.sparkSession, "warc")
    chunks = to_chunks(decided(pages, id_col, url_col, payload_col, min_revisit_bytes), chunk_bytes)
    manifest = S.staged(write_archives(chunks, folder), "manifest")
    return read_archives(manifest, chunk_bytes, with_data=False).where("last").select(
        "page_id", F.col("bytes_so_far").alias("payload_bytes"), F.col("digest_so_far").alias("payload_digest"), "record_type", "refers_to"
    )


def op4_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(S.read_table(spark, sf_dir, "pages"))
