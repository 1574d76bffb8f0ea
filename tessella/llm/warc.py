"""WARC archives in Zstandard: writer and reader.

An archive is a leading skippable frame that holds a dictionary, then one
frame per record. The reader loads the dictionary from that first frame,
decodes frame by frame and checks each record's version line, header lines,
declared length, block and payload digests. A page is a ``response`` record
with its HTTP header; one whose payload is in another record is a ``revisit``.

Payload digests are computed in the scan. Which record of equal payloads is
the response is a ``max`` per digest (combined before the shuffle) joined back
to the pages; a digest with very many pages is an ordinary skewed equi-join
that adaptive execution splits. Writers roll to a new archive after
``archive_bytes``, so memory and the loss of a task are bounded. Archives lie
in the shared folder; their list is written by Spark, so only the files of
committed tasks are read.

Defined cases: null html counts as an empty payload and null url as
``about:blank``; a null page_id stays null and never gives the response of
other pages; rows that repeat the largest page_id of a payload are all
responses; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import clean_text, cut, fresh_path, read_table

DICT_FRAME = 0x184D2A5D
ZSTD_FRAME = 0xFD2FB528
REVISIT_LEAST = 1000
ARCHIVE_BYTES = 32 << 20
DICT_SAMPLE_BYTES = 256 << 10
DICT_BYTES = 16 << 10
READ_BYTES = 1 << 20
CAPTURE_DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_SPACE = uuid.UUID("6b1f7c1e-3f55-5c07-9a53-0d2d0f6f7a11")


class WarcError(ValueError):
    """An archive or a record that breaks the format."""


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes

    def get(self, name: str) -> str | None:
        return self.headers.get(name.lower())


def record_id(key: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(RECORD_SPACE, str(key))}>"


def digest32(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def safe_uri(url: str | None) -> str:
    """The url without characters that would end its header line."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "") or "about:blank"


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {CAPTURE_DATE}",
        f"WARC-Target-URI: {safe_uri(url)}",
        f"WARC-Payload-Digest: {digest32(payload)}",
        f"WARC-Block-Digest: {digest32(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-Id: {refers_to}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> Record:
    """The one record of a decoded frame, checked."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    if not gap:
        raise WarcError("the header block does not end")
    version, *lines = head.decode("utf-8").split("\r\n")
    if version not in ("WARC/1.0", "WARC/1.1"):
        raise WarcError(f"not a WARC version: {version[:40]!r}")
    headers: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise WarcError(f"not a header line: {line[:60]!r}")
        headers[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise WarcError(f"{name} is missing")
    if not headers["content-length"].isdigit():
        raise WarcError("Content-Length is not a number")
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise WarcError(f"Content-Length is {length}, the frame holds {len(rest) - 4}")
    block = rest[:length]
    declared = headers.get("warc-block-digest")
    if declared is not None and declared != digest32(block):
        raise WarcError("the block does not match its digest")
    return Record(headers, block)


def http_parts(record: Record) -> tuple[int, bytes]:
    """The declared length of the full payload, and the payload that is there."""
    head, gap, payload = record.block.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"HTTP/"):
        raise WarcError("the block holds no HTTP header")
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.lower() == b"content-length":
            return int(value), payload
    raise WarcError("the HTTP header has no Content-Length")


def train_dictionary(samples: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A Zstandard dictionary of the samples; empty if they are too few to train on."""
    import zstandard

    if len(samples) < 16 or sum(map(len, samples)) < 8 * size:
        return b""
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


class ArchiveWriter:
    """Builds one archive: dictionary frame first, then a frame per record."""

    def __init__(self, sink, dictionary: bytes, level: int = 3):
        import zstandard

        self.sink = sink
        packed = zstandard.ZstdCompressor(level=9).compress(dictionary) if dictionary else b""
        sink.write(struct.pack("<II", DICT_FRAME, len(packed)) + packed)
        self.made = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None, write_content_size=True)

    def add(self, record: bytes) -> None:
        self.sink.write(self.made.compress(record))


def read_archive(source) -> Iterator[Record]:
    """The records of an archive, frame by frame, holding one record and one read buffer."""
    import zstandard

    head = source.read(8)
    if len(head) < 8:
        raise WarcError("the archive ends before its dictionary frame")
    magic, size = struct.unpack("<II", head)
    if magic != DICT_FRAME:
        raise WarcError(f"the archive starts with {magic:#x}, not with a dictionary frame")
    data = source.read(size)
    if len(data) != size:
        raise WarcError("the dictionary frame is cut short")
    if data[:4] == struct.pack("<I", ZSTD_FRAME):
        data = zstandard.ZstdDecompressor().decompress(data)
    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data) if data else None)
    left = b""
    while left or (left := source.read(READ_BYTES)):
        frame, parts = decoder.decompressobj(), []
        while not frame.eof:
            if not left and not (left := source.read(READ_BYTES)):
                raise WarcError("a record's frame is cut short")
            try:
                parts.append(frame.decompress(left))
            except zstandard.ZstdError as e:
                raise WarcError(f"not a record frame: {e}") from e
            left = frame.unused_data if frame.eof else b""
        yield parse_record(b"".join(parts))


def mark_revisits(pages: DataFrame, least: int = REVISIT_LEAST) -> DataFrame:
    """page_id, url, html, refers_to: the page that holds the payload, for revisits."""
    html = clean_text(F.col("html"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    keyed = rows.withColumn("_key", F.when(F.octet_length("html") >= least, F.sha2(F.col("html"), 256)))
    # Only payloads of two or more pages go into the join; the rest has no partner there.
    groups = (
        keyed.where("_key is not null and page_id is not null")
        .groupBy("_key").agg(F.max("page_id").alias("_last"), F.min("page_id").alias("_first"))
        .where("_first < _last").select("_key", "_last")
    )
    # Rows without a key get one of their own, so that they do not meet in one task.
    alone = F.concat(F.lit("~"), F.monotonically_increasing_id().cast("string"))
    joined = keyed.withColumn("_key", F.coalesce("_key", alone)).join(groups, "_key", "left")
    return joined.select("page_id", "url", "html", F.when(F.col("page_id") < F.col("_last"), F.col("_last")).alias("refers_to"))


def write_archives(marked: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write rows of :func:`mark_revisits` as archives; returns path and n_records of each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        waiting: list[bytes] = []
        size = n = 0
        path = sink = archive = None
        done: list[tuple[str, int]] = []

        def start() -> None:
            nonlocal path, sink, archive, n
            path, n = f"{root}/{uuid.uuid4().hex}.warc.zst", len(waiting)
            sink = store.open_output_stream(path)
            archive = ArchiveWriter(sink, train_dictionary(waiting))
            for record in waiting:
                archive.add(record)
            waiting.clear()

        def close() -> None:
            nonlocal archive, size
            sink.close()
            done.append((path, n))
            archive, size = None, 0

        for batch in batches:
            for page_id, url, html, refers_to in zip(batch["page_id"], batch["url"], batch["html"], batch["refers_to"], strict=True):
                record = build_record(None if pd.isna(page_id) else int(page_id), url, html.encode(), None if pd.isna(refers_to) else int(refers_to))
                size += len(record)
                if archive is None:
                    waiting.append(record)
                    if size >= DICT_SAMPLE_BYTES:
                        start()
                else:
                    archive.add(record)
                    n += 1
                if archive is not None and size >= archive_bytes:
                    close()
            yield pd.DataFrame(done, columns=["path", "n_records"])
            done.clear()
        if waiting:
            start()
        if archive is not None:
            close()
        yield pd.DataFrame(done, columns=["path", "n_records"])

    ids = marked.select(F.col("page_id").cast("string"), "url", "html", F.col("refers_to").cast("string"))
    return cut(ids.mapInPandas(run, "path string, n_records long"), "archives")


def read_archives(archives: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """A row per record of the listed archives; a wrong record or count raises."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(folder)
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * with_payload
        for batch in batches:
            for path, n_records in zip(batch["path"], batch["n_records"], strict=True):
                rows, seen = [], 0
                with store.open_input_stream(path) as source:
                    for record in read_archive(source):
                        seen += 1
                        n, payload = http_parts(record)
                        declared = record.get("WARC-Payload-Digest") or ""
                        kind = record.get("WARC-Type")
                        if kind == "response" and (len(payload) != n or digest32(payload) != declared):
                            raise WarcError(f"{path}: payload and headers differ in {record.get('WARC-Record-ID')}")
                        page, other = record.get("X-Page-Id"), record.get("X-Refers-To-Page-Id")
                        digest = base64.b32decode(declared.removeprefix("sha1:")).hex()
                        rows.append((page and int(page), record.get("WARC-Target-URI"), n, digest, kind, other and int(other), *([payload] if with_payload else [])))
                        if len(rows) == 1000:
                            yield frame(rows, names)
                            rows = []
                if seen != n_records:
                    raise WarcError(f"{path}: {seen} records, {n_records} were written")
                yield frame(rows, names)

    def frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=names)
        return out.astype({"page_id": "Int64", "refers_to": "Int64"})

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    schema += ", payload binary" if with_payload else ""
    return archives.repartition(max(1, archives.sparkSession.sparkContext.defaultParallelism)).mapInPandas(run, schema)


def archive_pages(pages: DataFrame, folder: str, **options) -> DataFrame:
    """Write all pages below ``folder``, then read them back."""
    return read_archives(write_archives(mark_revisits(pages), folder, **options), folder)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = archive_pages(read_table(spark, sf_dir, "pages"), fresh_path(spark, "warc"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_OP5 = """
with p as (
  select cast(page_id as bigint) as page_id, coalesce(html, '') as html from pages
), d as (
  select page_id, html, cast(octet_length(encode(html)) as bigint) as payload_bytes, sha1(html) as payload_digest from p
), g as (
  select html, max(page_id) as last_id from d where payload_bytes >= 1000 group by html
)
select d.page_id, d.payload_bytes, d.payload_digest,
  case when g.last_id > d.page_id then 'revisit' else 'response' end as record_type,
  case when g.last_id > d.page_id then g.last_id end as refers_to
from d left join g on d.html = g.html
"""
