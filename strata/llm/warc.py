"""Zstandard WARC archives: a writer with revisit records and a validating reader.

An archive is a skippable frame with the dictionary, then one zstd frame per WARC/1.1 record.  The
reader loads the dictionary, decodes frame by frame, and checks version line, required headers, all
lengths and payload digests.  Archives lie in the shared folder and are reached by its URI, from
executors too; each write attempt has its own file name and only files of finished tasks are listed,
so a repeated task leaves at most an unread file behind.

Of pages with equal payloads of at least ``REVISIT_BYTES`` bytes (equal SHA-256 and length) the one
with the largest id is written as response, the others as revisits that refer to it.

Defined cases: a null payload is empty; null ids write a record with an empty id and come back null
(a group of null ids only has no one to refer to, so all are responses); rows that repeat the
response's id are responses too; a null url gives no target header, and
characters that a URI cannot hold come back percent-encoded; extra columns are ignored; an
empty table writes no archive and reads back nothing.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import Scratch

REVISIT_BYTES = 1000
#: Bytes of records before a task starts its next archive; records sampled for its dictionary; their bytes; its size.
ARCHIVE_BYTES = 256 << 20
SAMPLES, SAMPLE_BYTES, DICTIONARY_BYTES = 256, 1 << 20, 1 << 15
#: The magic numbers of the dictionary's skippable frame and of a zstd frame; WARC header texts.
SKIPPABLE, FRAME = 0x184D2A5D, b"\x28\xb5\x2f\xfd"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "urn:page:"
#: Date of every record, unless the caller states one: reruns then write the same bytes.
DATE = "2024-01-01T00:00:00Z"
READ, STEP = 1 << 20, 1 << 12
#: Hadoop's names of stores that Arrow knows by another.
HADOOP_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "wasbs": "abfs", "wasb": "abfs", "webhdfs": "hdfs"}


def _plan(pages: DataFrame, scratch: Scratch, least: int) -> DataFrame:
    """``pages`` (id, url, payload) with record_type and refers_to."""
    keyed = pages.withColumns({"size": F.octet_length("payload").cast("long"), "key": F.unhex(F.sha2("payload", 256))})
    small = keyed.where(F.col("size") >= least).groupBy("key", "size").agg(F.max("id").alias("response"), F.count("*").alias("n")).where("n > 1 AND response IS NOT NULL")
    groups = scratch.save(small.select(F.col("key").alias("k"), F.col("size").alias("s"), "response"), "groups")
    joined = keyed.join(groups, (F.col("key") == F.col("k")) & (F.col("size") == F.col("s")), "left")
    again = F.col("response").isNotNull() & ~F.col("id").eqNullSafe(F.col("response"))
    return joined.select("id", "url", "payload", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("response")).alias("refers_to"))


def record_bytes(page_id: int | None, url: str | None, payload: bytes, kind: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC record.  A revisit keeps the HTTP header, whose Content-Length is the full payload's."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if kind == "revisit" else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{RECORD}{'' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe="%:/?#[]@!$&'()*+,;=-._~")}")
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{RECORD}{refers_to}>"]
    lines.append(f"Content-Length: {len(block)}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on the archive's first records; their plain bytes where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[:DICTIONARY_BYTES].ljust(8, b" "), dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def _filesystem(uri: str):
    """File system and path of an URI.  Schemes that only Hadoop knows go through its own client, or their plain name."""
    from pyarrow.fs import FileSystem

    uri = uri if "://" in uri or uri.startswith("file:") else f"file://{uri}"
    try:
        return FileSystem.from_uri(uri)
    except pa.ArrowInvalid:
        scheme, _, rest = uri.partition("://")
        return FileSystem.from_uri(f"{HADOOP_SCHEMES.get(scheme, 'hdfs')}://{rest}")


def write_archives(pages: DataFrame, scratch: Scratch, *, archive_bytes: int = ARCHIVE_BYTES, date: str = DATE) -> DataFrame:
    """Write planned pages as archives under the scratch folder; (archive, records) per finished archive."""
    folder = f"{scratch.path}/archives"

    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        files, base = _filesystem(folder)
        files.create_dir(base, recursive=True)
        name = f"{task.partitionId():06d}-{uuid.uuid4().hex}"
        records = (
            record_bytes(i, url, payload.encode("utf-8", "surrogatepass"), kind, to, date)
            for batch in batches for lo in range(0, batch.num_rows, 64)
            for i, url, payload, kind, to in zip(*(c.to_pylist() for c in batch.slice(lo, 64).columns), strict=True)
        )
        held: list[bytes] = []
        done, number, ended = [], 0, False
        while not ended:
            held, size = [], 0
            for record in records:
                held.append(record)
                size += len(record)
                if len(held) >= SAMPLES or size >= SAMPLE_BYTES:
                    break
            else:
                ended = True
            if not held:
                break
            dictionary = _dictionary(held)
            raw = dictionary.as_bytes()
            compressor = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_content_size=True)
            path, count = f"{base}/{name}-{number}.warc.zst", 0
            with files.open_output_stream(path) as out:
                out.write(struct.pack("<II", SKIPPABLE, len(raw)) + raw)
                for record in held:
                    out.write(compressor.compress(record))
                count = len(held)
                while not ended and size < archive_bytes:
                    record = next(records, None)
                    if record is None:
                        ended = True
                        break
                    out.write(compressor.compress(record))
                    size, count = size + len(record), count + 1
            done.append((f"{folder}/{name}-{number}.warc.zst", count))
            number += 1
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done]), pa.array([d[1] for d in done], pa.int64())], ["archive", "records"])

    return scratch.save(pages.select("id", "url", "payload", "record_type", "refers_to").mapInArrow(run, "archive string, records long"), "manifest")


def frames(stream):
    """Decoded frames of an archive, one at a time; ``stream`` has read(n)."""
    held, at = b"", 0

    def fill(n: int) -> bool:
        """At least ``n`` bytes from ``at`` on, unless the stream ends; what lies before is let go."""
        nonlocal held, at
        parts = [held[at:]]
        size = len(held) - at
        if size >= n:
            return True
        while size < n:
            more = stream.read(max(READ, n - size))
            if not more:
                break
            parts.append(more)
            size += len(more)
        held, at = b"".join(parts), 0
        return size >= n

    dictionary = None
    if fill(8) and struct.unpack("<I", held[at : at + 4])[0] == SKIPPABLE:
        size = struct.unpack("<I", held[at + 4 : at + 8])[0]
        if not fill(8 + size):
            raise ValueError("the dictionary frame is cut off")
        raw = held[at + 8 : at + 8 + size]
        at += 8 + size
        if raw[:4] == FRAME:
            raw = zstandard.ZstdDecompressor().decompress(raw)
        dictionary = zstandard.ZstdCompressionDict(raw)
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while fill(1):
        if not fill(4) or held[at : at + 4] != FRAME:
            raise ValueError("a record does not start with a zstd frame")
        frame, parts, step = decompressor.decompressobj(), [], STEP
        while not frame.eof:
            # Small steps first: what lies beyond the frame comes back as a copy.
            if not fill(1):
                raise ValueError("the last frame is cut off")
            piece = memoryview(held)[at : at + step]
            parts.append(frame.decompress(piece))
            at += len(piece)
            step = min(2 * step, READ)
        at -= len(frame.unused_data)
        yield b"".join(parts)


REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")


def parse_record(raw: bytes) -> tuple:
    """(id, url, record_type, payload or None, payload_bytes, digest hex, refers_to) of one validated record."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not found or not lines[0].startswith("WARC/1."):
        raise ValueError("not a WARC record")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or name.lower() in headers:
            raise ValueError(f"bad header line {line!r}")
        headers[name.lower()] = value.strip()
    if missing := [h for h in REQUIRED if h not in headers]:
        raise ValueError(f"without {missing}")
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length {length}, but {len(rest) - 4} bytes follow")
    http, found, payload = rest[:length].partition(b"\r\n\r\n")
    if not found:
        raise ValueError("without an HTTP header")
    size = next((int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), None)
    name = lambda h: (lambda v: int(v) if v else None)(headers[h].strip("<>").removeprefix(RECORD))
    algorithm, _, text = headers.get("warc-payload-digest", "").partition(":")
    if algorithm != "sha1":
        raise ValueError("without a sha1 payload digest")
    digest = base64.b32decode(text)
    kind = headers["warc-type"]
    refers = None
    if kind == "revisit":
        if headers.get("warc-profile") != PROFILE or "warc-refers-to" not in headers or payload:
            raise ValueError("bad revisit record")
        refers, payload = name("warc-refers-to"), None
    elif kind != "response":
        raise ValueError(f"unknown record type {kind}")
    elif size != len(payload) or hashlib.sha1(payload).digest() != digest:
        raise ValueError("the payload differs from its length or digest")
    url = headers.get("warc-target-uri")
    return name("warc-record-id"), url, kind, payload, size, digest.hex(), refers


RECORDS = "id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long"
KINDS = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64()]


def read_archives(archives: DataFrame, *, payloads: bool = True) -> DataFrame:
    """Records of the archives whose URIs ``archive`` holds; streamed, one frame in memory at a time."""

    def run(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                files, path = _filesystem(uri)
                with files.open_input_stream(path) as stream:
                    held, size = [], 0
                    for raw in frames(stream):
                        record = parse_record(raw)
                        held.append(record if payloads else (*record[:3], None, *record[4:]))
                        size += len(raw) if payloads else 200
                        if size >= 8 << 20:
                            yield _batch(held)
                            held, size = [], 0
                    yield _batch(held)

    n = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return archives.select("archive").repartition(n, "archive").mapInArrow(run, RECORDS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(KINDS)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, KINDS, strict=True)], [x.split()[0] for x in RECORDS.split(", ")])


def archive_pages(spark: SparkSession, pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES, date: str = DATE) -> DataFrame:
    """Write every page into archives; (archive, records) for ``read_archives``."""
    scratch = Scratch(spark, "warc")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    return write_archives(_plan(rows, scratch, least), scratch, archive_bytes=archive_bytes, date=date)
