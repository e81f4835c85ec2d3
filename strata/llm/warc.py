"""WARC archives with a Zstandard dictionary.

A dictionary is trained on a bounded sample of the records to archive, every
archive begins with it in a skippable frame, and each record is a frame of its
own, compressed with it. Of records with equal payloads of at least
``min_bytes`` bytes the one with the smallest page id is a response, the others
revisit it and hold no payload.

Archives are written by Spark's own file writer, a file for each row, so the
commit protocol and any file system that Spark reaches apply; the writer ends a
row with a separator, which here is an empty skippable frame. An archive is
closed at ``ARCHIVE_BYTES``, so a reader holds one at a time.

Defined cases: a null payload is empty; null urls give no target header and
control characters in one are percent-encoded; null page ids are responses and
come back as null; rows that repeat the smallest id are responses each; an
empty table gives no archive and an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import arrow_schema, first_by_hash, to_batch
from strata.session import scratch_path

ARCHIVE_BYTES = 8_000_000
#: Of the sample a dictionary is trained on: pages, characters of a page.
SAMPLE_PAGES, SAMPLE_CHARS, DICTIONARY_BYTES = 1000, 16_384, 65_536
LEVEL = 3
MIN_BYTES = 0
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"

#: Fixed values of the formats.
DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
EMPTY_FRAME = "P*M\x18\0\0\0\0"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:page:"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record(
    page_id: int | None, url: str | None, payload: bytes, first: int | None, date: str, digest: str | None = None
) -> bytes:
    """One WARC record; ``first``: the page it revisits, or null."""
    digest = digest or base32(hashlib.sha1(payload).digest())
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: <{URN}{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.insert(4, "WARC-Target-URI: " + re.sub("[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if first is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{URN}{first}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], int, bytes]:
    """Headers, length of the full payload and what the record holds of it."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    headers = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines)}
    block = rest[: int(headers["content-length"])]
    if not first.startswith("WARC/") or len(block) != int(headers["content-length"]):
        raise ValueError("not a whole WARC record")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)\r\ncontent-length: (\d+)", http)[1])
    return headers, size, payload


def frames(data: bytes) -> Iterator[tuple[int, int]]:
    """(start, end) of every frame, skippable ones included, by their headers."""
    at = 0
    while at < len(data):
        if data[at + 1 : at + 4] == DICTIONARY_MAGIC[1:] and data[at] & 0xF0 == 0x50:
            end = at + 8 + int.from_bytes(data[at + 4 : at + 8], "little")
        else:
            head = data[at : at + 18]
            end = at + zstandard.frame_header_size(head)
            last = False
            while not last:
                block = int.from_bytes(data[end : end + 3], "little")
                last = bool(block & 1)
                end += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
            end += 4 * zstandard.get_frame_parameters(head).has_checksum
        if end > len(data):
            raise ValueError("an archive is cut off")
        yield at, end
        at = end


def read_archive(data: bytes) -> Iterator[bytes]:
    """The records of one archive."""
    reader = zstandard.ZstdDecompressor()
    for start, end in frames(data):
        frame = data[start:end]
        if frame[:4] == DICTIONARY_MAGIC:
            reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(frame[8:]))
        elif frame[1:4] != DICTIONARY_MAGIC[1:]:
            yield reader.decompress(frame)


def train(pages: DataFrame, *, date: str, sample_pages: int = SAMPLE_PAGES) -> bytes:
    """Dictionary of the first pages by a hash; empty if they are too few."""
    some = pages.select("page_id", "url", F.left("html", F.lit(SAMPLE_CHARS)).alias("html"))
    some = first_by_hash(some, sample_pages, "page_id", total=pages.count())
    samples = [record(r.page_id, r.url, (r.html or "").encode(), None, date) for r in some.toLocalIterator()]
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 10)
    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if len(samples) >= 8 and size >= 256 else b""
    except zstandard.ZstdError:
        return b""


def marked(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``pages`` with ``first``: the page that each revisits, or null. The hash
    of a payload meets one row for each payload that repeats; a join that is
    hot in one of them can be split, as that side is a single row."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    hashed = pages.select(F.col("page_id").cast("long"), "url", "html", F.sha1(payload).alias("sha"))
    repeated = (
        hashed.where(F.octet_length(F.coalesce("html", F.lit(""))) >= min_bytes)
        .groupBy("sha")
        .agg(F.min("page_id").alias("least"), F.max("page_id").alias("most"))
        .where("least < most")
        .select("sha", "least")
    )
    return hashed.join(repeated, "sha", "left").select(
        "page_id", "url", "html", "sha", F.when(F.col("page_id") != F.col("least"), F.col("least")).alias("first")
    )


def write(
    spark: SparkSession,
    pages: DataFrame,
    path: str,
    *,
    min_bytes: int = MIN_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
    date: str = "2024-01-01T00:00:00Z",
) -> None:
    """Write ``pages`` (page_id, url, html) as archives under ``path``."""
    dictionary = train(pages, date=date)
    schema = arrow_schema(spark, "archive binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained)
        head = DICTIONARY_MAGIC + len(dictionary).to_bytes(4, "little") + dictionary if dictionary else b""
        parts, size = [head], len(head)
        for batch in batches:
            for page_id, url, html, sha, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                digest = base32(bytes.fromhex(sha))
                parts.append(packer.compress(record(page_id, url, (html or "").encode(), first, date, digest)))
                size += len(parts[-1])
                if size >= archive_bytes:
                    yield to_batch({"archive": [b"".join(parts)]}, schema)
                    parts, size = [head], len(head)
        if len(parts) > 1:
            yield to_batch({"archive": [b"".join(parts)]}, schema)

    archives = marked(pages, min_bytes).mapInArrow(run, "archive binary")
    archives.select(F.col("archive").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).option(
        "lineSep", EMPTY_FRAME
    ).text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of all archives under ``path``; the payload of every
    response is held against its digest."""
    schema = arrow_schema(spark, RECORDS)

    def rows(data: bytes) -> dict:
        out: dict = {name: [] for name in schema.names}
        for raw in read_archive(data):
            headers, size, payload = parse(raw)
            digest = headers["warc-payload-digest"].removeprefix("sha1:")
            kind = headers["warc-type"]
            if kind == "response" and (len(payload) != size or base32(hashlib.sha1(payload).digest()) != digest):
                raise ValueError(f"payload of {headers['warc-record-id']} does not match its digest")
            page, first = (
                headers.get(k, "").removeprefix(f"<{URN}").rstrip(">") for k in ("warc-record-id", "warc-refers-to")
            )
            out["page_id"].append(int(page) if page else None)
            out["payload_bytes"].append(size)
            out["payload_digest"].append(digest)
            out["record_type"].append(kind)
            out["refers_to"].append(int(first) if first else None)
            out["url"].append(headers.get("warc-target-uri"))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                yield to_batch(rows(data.as_py()), schema)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, RECORDS)


def archived(spark: SparkSession, pages: DataFrame, **how) -> DataFrame:
    """Write ``pages`` to the shared scratch folder and read the archives back."""
    path = scratch_path(spark, "warc")
    write(spark, pages, path, **how)
    return read(spark, path)
