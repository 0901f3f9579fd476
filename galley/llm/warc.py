"""Web archives in Zstandard: written with a shared dictionary, read frame by frame.

An archive begins with a skippable frame that holds the dictionary; after it every record
is a frame of its own. The reader loads the dictionary from the leading frame, decodes one
frame per record and checks the version line, the needed headers, the block's length, the
payload's digest and the blank lines at the end; a broken record raises with its archive
and place.

Of records with equal payloads of at least ``least_bytes`` that with the largest id is the
response and the others revisit it. Payloads are compared by their digests, which
are counted before they meet.

Archives carry the attempt of their task in their names and are read only if their task
was committed, so retries leave nothing behind that counts.

Defined cases: a null payload is empty; every row is a record, also with a null or repeated
id; among equal payloads the largest non-null id is the response (rows that repeat it with
the same payload are responses too), and without any id all are; an empty table makes no
archive and gives no rows; a null address becomes ``urn:none``.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galley.llm.common import shared_path, slices, stored

# fixed values of the formats: frame magics, version line and header names
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEEDED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


class BrokenArchive(ValueError):
    """A record or frame that does not keep to the format."""


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the rows the dictionary is made from."""

    least_bytes: int = 1000
    archive_bytes: int = 8 << 20
    dictionary_bytes: int = 64 << 10
    sample_rows: int = 400
    level: int = 3
    date: str = "2024-01-01T00:00:00Z"


def safe(value: str | None) -> str:
    """A header value without line ends."""
    return re.sub(r"[\r\n]+", " ", value) if value else "urn:none"


def record(kind: str, name: str, page_id: int | None, uri: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record; a revisit has the HTTP head only, its length and digest are of the full payload."""
    block = HTTP_HEAD + (payload if kind == "response" else b"")
    headers = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:record:{name}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", safe(uri)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if page_id is not None:
        headers.append(("X-Page-ID", str(page_id)))
    if kind == "revisit":
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    lines = [VERSION, *(f"{name}: {value}".encode() for name, value in headers), b"", b""]
    return b"\r\n".join(lines) + block + b"\r\n\r\n"


def opening_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary


def frames(archive: bytes, where: str) -> Iterator[bytes]:
    """The records of an archive, one for each frame after the dictionary's."""
    if len(archive) < 8 or struct.unpack_from("<I", archive)[0] != DICTIONARY_MAGIC:
        raise BrokenArchive(f"{where}: no dictionary frame at the beginning")
    size = struct.unpack_from("<I", archive, 4)[0]
    at = 8 + size
    if at > len(archive):
        raise BrokenArchive(f"{where}: dictionary frame ends after the archive")
    dictionary = archive[8:at]
    if dictionary[:4] == FRAME_MAGIC:
        dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdDecompressor()
    view = memoryview(archive)
    while at < len(archive):
        if archive[at : at + 4] != FRAME_MAGIC:
            raise BrokenArchive(f"{where}: no frame at byte {at}")
        one = decoder.decompressobj()
        parts, step = [], at
        while not one.eof and step < len(archive):
            parts.append(one.decompress(view[step : step + 65536]))
            step += 65536
        if not one.eof:
            raise BrokenArchive(f"{where}: frame at byte {at} is cut off")
        at = min(step, len(archive)) - len(one.unused_data)
        yield b"".join(parts)


def parsed(data: bytes, where: str) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record that keeps to the format."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not mark or lines[0] != VERSION:
        raise BrokenArchive(f"{where}: no version line or no end of headers")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.decode().partition(": ")
        if not colon or name in headers:
            raise BrokenArchive(f"{where}: header {line!r}")
        headers[name] = value
    missing = [n for n in NEEDED if n not in headers]
    if missing:
        raise BrokenArchive(f"{where}: headers {missing} are missing")
    if not re.fullmatch(r"[0-9]+", headers["Content-Length"]):
        raise BrokenArchive(f"{where}: length {headers['Content-Length']!r}")
    length = int(headers["Content-Length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise BrokenArchive(f"{where}: block of {len(rest) - 4} bytes, {length} were announced")
    return headers, rest[:length]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            rows: dict[str, list] = {k: [] for k in ("page_id", "bytes", "digest", "kind", "refers_to", "uri", "payload")}
            held = 0
            for k, data in enumerate(frames(content.as_py(), path)):
                where = f"{path}, record {k}"
                headers, block = parsed(data, where)
                http, mark, payload = block.partition(b"\r\n\r\n")
                kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
                announced = int(headers["WARC-Payload-Length"])
                if not mark or kind not in ("response", "revisit"):
                    raise BrokenArchive(f"{where}: type {kind} or no HTTP head")
                if kind == "response" and (len(payload) != announced or hashlib.sha1(payload).hexdigest() != digest):
                    raise BrokenArchive(f"{where}: payload does not match its digest or length")
                if kind == "revisit" and payload:
                    raise BrokenArchive(f"{where}: revisit with a payload")
                target = headers.get("WARC-Refers-To")
                rows["page_id"].append(int(headers["X-Page-ID"]) if "X-Page-ID" in headers else None)
                rows["bytes"].append(announced)
                rows["digest"].append(digest)
                rows["kind"].append(kind)
                rows["refers_to"].append(int(target.removeprefix("<urn:page:").removesuffix(">")) if target else None)
                rows["uri"].append(headers.get("WARC-Target-URI"))
                rows["payload"].append(payload if kind == "response" else None)
                held += len(payload)
                if held > 4 << 20:
                    yield pa.RecordBatch.from_pydict(rows, READ_SCHEMA)
                    rows, held = {k: [] for k in rows}, 0
            if rows["bytes"]:
                yield pa.RecordBatch.from_pydict(rows, READ_SCHEMA)


READ_SCHEMA = pa.schema(
    [
        ("page_id", pa.int64()),
        ("bytes", pa.int64()),
        ("digest", pa.string()),
        ("kind", pa.string()),
        ("refers_to", pa.int64()),
        ("uri", pa.string()),
        ("payload", pa.binary()),
    ]
)


RECORDS = "page_id long, bytes long, digest string, kind string, refers_to long, uri string, payload binary"


def read(spark: SparkSession, folder: str, archives: DataFrame | None = None) -> DataFrame:
    """Records of the archives in a folder, or of those whose file names ``archives`` has."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    files = files.withColumn("archive", F.element_at(F.split("path", "/"), -1))
    if archives is not None:
        files = files.join(archives, "archive", "left_semi")
    return files.select("path", "content").mapInArrow(_read, RECORDS)


def _written(folder: str, dictionary: bytes, settings: Settings):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        context = TaskContext.get()
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        encoder = zstandard.ZstdCompressor(level=settings.level, dict_data=shared)
        parts: list[bytes] = []
        size = count = 0
        task = f"{context.partitionId()}-{context.taskAttemptId()}"

        def flush() -> pa.RecordBatch:
            name = f"part-{task}-{count}.warc.zst"
            with system.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(opening_frame(dictionary))
                for part in parts:
                    out.write(part)
            return pa.RecordBatch.from_pydict({"archive": [name], "records": [len(parts)]})

        for batch in slices(batches, "html"):
            for row in batch.to_pylist():
                payload = (row["html"] or "").encode("utf-8", "surrogatepass")
                name = f"{task}-{count}-{len(parts)}"
                data = record(
                    row["kind"], name, row["page_id"], row["url"], payload, row["digest"], row["refers_to"], settings.date
                )
                parts.append(encoder.compress(data))
                size += len(parts[-1])
                if size >= settings.archive_bytes:
                    yield flush()
                    parts, size, count = [], 0, count + 1
        if parts:
            yield flush()

    return write


def dictionary_of(pages: DataFrame, settings: Settings) -> bytes:
    """A dictionary from the pages with the smallest hashes, of those up to 64 kB."""
    some = pages.select("html", F.xxhash64("html").alias("h")).filter(F.length("html").between(64, 1 << 16))
    rows = some.orderBy("h", "html").limit(settings.sample_rows).collect()
    samples = [r["html"].encode("utf-8", "surrogatepass") for r in rows]
    if len(samples) < 20:
        return b""
    try:
        return zstandard.train_dictionary(settings.dictionary_bytes, samples).as_bytes()
    except zstandard.ZstdError:  # too little or too uniform a sample
        return b""


def decided(pages: DataFrame, settings: Settings) -> DataFrame:
    """``pages`` with digest, kind and refers_to."""
    content = F.coalesce("html", F.lit("")).cast("binary")
    digested = pages.withColumns({"digest": F.sha1(content), "bytes": F.octet_length(content).cast("long")})
    large = digested.filter(F.col("bytes") >= settings.least_bytes).select("digest", "page_id")
    groups = large.groupBy("digest").agg(F.max("page_id").alias("best"), F.count("*").alias("n")).filter("n > 1").drop("n")
    revisit = (F.col("bytes") >= settings.least_bytes) & F.col("best").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("best"))
    return digested.join(groups, "digest", "left").select(
        "page_id",
        "url",
        "html",
        "digest",
        F.when(revisit, "revisit").otherwise("response").alias("kind"),
        F.when(revisit, F.col("best")).alias("refers_to"),
    )


def write(pages: DataFrame, folder: str, settings: Settings = Settings()) -> DataFrame:
    """Write pages (page_id, url, html) to archives; a row for each archive that counts.

    ``folder`` has to be a URI that all executors reach.
    """
    dictionary = dictionary_of(pages, settings)
    written = decided(pages, settings).mapInArrow(_written(folder, dictionary, settings), "archive string, records long")
    return stored(written, "warc-archives")


def archived(pages: DataFrame, settings: Settings = Settings(), folder: str | None = None) -> DataFrame:
    """Write every page to archives, read them back and return their records."""
    spark = pages.sparkSession
    folder = folder or shared_path(spark, "warc")
    if "://" not in folder:
        folder = f"file://{folder.removeprefix('file:')}"
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    archives = write(rows, folder, settings)
    if archives.isEmpty():
        return spark.createDataFrame([], RECORDS)
    return read(spark, folder, archives)
