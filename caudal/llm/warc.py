"""Zstandard web archives: one record a frame, the dictionary in front.

An archive begins with a skippable frame that holds a dictionary, then has one frame for each record.
Tasks write archives of about ``ARCHIVE_BYTES`` to a folder that all executors and the driver see,
under names that follow from the task's part of the data: a task that runs again replaces its file
whole. The reader streams an archive frame by frame and checks headers, lengths and digests.

Payloads met before are revisit records that refer to the first page with them; the length of the
full payload stays in the record's HTTP header.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.llm.text import in_small_batches
from caudal.operators.skew import lookup_side
from caudal.session import materialise, work_dir

# Fixed values of the formats.
MAGIC_DICTIONARY = 0x184D2A5D
MAGIC_FRAME = b"\x28\xb5\x2f\xfd"
VERSION = "WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

SMALLEST_SHARED = 100
ARCHIVE_BYTES = 32 << 20
# The dictionary is trained on so many payloads at most, chosen by hash.
TRAIN_PAYLOADS, DICTIONARY_BYTES = 400, 64 << 10
_CHUNK = 16 << 10


@dataclass
class Record:
    """One page as it goes into an archive. ``refers_to`` makes it a revisit."""

    page_id: int | None
    url: str | None
    payload: bytes
    refers_to: int | None = None


def _urn(page_id: int | None, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{payload_digest}')}>"


def encode_record(record: Record) -> bytes:
    digest = hashlib.sha256(record.payload).hexdigest()
    revisit = record.refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(record.payload)}\r\n\r\n".encode()
    block = http if revisit else http + record.payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _urn(record.page_id, digest)),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
    ]
    if record.url is not None:
        fields.append(("WARC-Target-URI", quote(record.url, safe="%/:?#[]@!$&'()*+,;=-._~")))
    if record.page_id is not None:
        fields.append(("X-Page-Id", str(record.page_id)))
    if revisit:
        fields += [("WARC-Profile", REVISIT), ("WARC-Refers-To", _urn(record.refers_to, digest)), ("X-Refers-To-Page-Id", str(record.refers_to))]
    fields.append(("Content-Length", str(len(block))))
    head = VERSION + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _fields(lines: bytes, what: str) -> dict[str, str]:
    out = {}
    for line in lines.decode("utf-8").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"bad {what} header line {line[:80]!r}")
        if name.lower() in out:
            raise ValueError(f"repeated {what} header {name}")
        out[name.lower()] = value.strip()
    return out


def decode_record(raw: bytes) -> dict:
    """Fields of a record; ``ValueError`` where a header, a length or a digest doesn't hold."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not gap or version.decode("latin-1") != VERSION:
        raise ValueError(f"not a record: {version[:40]!r}")
    fields = _fields(lines, "record")
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest", "warc-block-digest"):
        if name not in fields:
            raise ValueError(f"record without {name}")
    if not fields["content-length"].isdigit() or len(rest) != int(fields["content-length"]) + 4 or not rest.endswith(b"\r\n\r\n"):
        raise ValueError("content length and frame don't agree")
    block = rest[:-4]
    if fields["warc-block-digest"] != "sha256:" + hashlib.sha256(block).hexdigest():
        raise ValueError("block digest doesn't match")
    http, gap, payload = block.partition(b"\r\n\r\n")
    status, _, lines = http.partition(b"\r\n")
    inner = _fields(lines, "HTTP")
    if not gap or not status.startswith(b"HTTP/") or not inner.get("content-length", "").isdigit():
        raise ValueError("block is no HTTP response with a length")
    size, kind = int(inner["content-length"]), fields["warc-type"]
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    if kind == "response":
        if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError("payload doesn't match its length or digest")
    elif kind != "revisit" or payload or fields.get("warc-profile") != REVISIT or "warc-refers-to" not in fields:
        raise ValueError(f"bad {kind} record")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("x-page-id"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number("x-refers-to-page-id"),
        "target_uri": fields.get("warc-target-uri"),
        "payload": payload if kind == "response" else None,
    }


def dictionary_frame(dictionary: bytes) -> bytes:
    packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", MAGIC_DICTIONARY, len(packed)) + packed


def train_dictionary(payloads: list[bytes]) -> bytes:
    """A dictionary for records like these; where training finds too little, their heads end to end."""
    samples = [encode_record(Record(i, None, p)) for i, p in enumerate(payloads)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        heads = b"".join(s[:4096] for s in samples)[-DICTIONARY_BYTES:]
        return heads or encode_record(Record(None, None, b""))


def frames(source) -> Iterator[bytes]:
    """Decompressed frames of an open archive, after its dictionary; reads in small pieces."""
    start = source.read(8)
    if len(start) < 8 or struct.unpack("<I", start[:4])[0] != MAGIC_DICTIONARY:
        raise ValueError("archive doesn't begin with a dictionary frame")
    size = struct.unpack("<I", start[4:])[0]
    raw = source.read(size)
    if len(raw) != size:
        raise ValueError("dictionary frame is cut short")
    if raw.startswith(MAGIC_FRAME):
        raw = zstandard.ZstdDecompressor().decompress(raw, max_output_size=1 << 27)
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
    pending = source.read(_CHUNK)
    while pending:
        frame, out = unpack.decompressobj(), []
        while True:
            out.append(frame.decompress(pending))
            if frame.eof:
                pending = frame.unused_data or source.read(_CHUNK)
                break
            pending = source.read(_CHUNK)
            if not pending:
                raise ValueError("last frame is cut short")
        yield b"".join(out)


def _filesystem(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else uri.replace("file:", "", 1))


def _write_task(root: str, dictionary: bytes):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, folder = _filesystem(root)
        task = TaskContext.get()
        pack = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary))
        front = dictionary_frame(dictionary)
        sink, name, part, n, size = None, "", 0, 0, 0

        def close() -> pd.DataFrame:
            nonlocal sink
            sink.close()
            files.move(f"{folder}/{name}.{task.taskAttemptId()}.tmp", f"{folder}/{name}")
            sink = None
            return pd.DataFrame([{"archive": f"{root}/{name}", "records": n, "bytes": size}])

        for batch in batches:
            for page_id, url, html, refers in zip(batch["page_id"], batch["url"], batch["html"], batch["refers_to"]):
                if sink is None:
                    name, n, size = f"part-{task.partitionId():06d}-{part:04d}.warc.zst", 0, len(front)
                    part += 1
                    sink = files.open_output_stream(f"{folder}/{name}.{task.taskAttemptId()}.tmp", compression=None)
                    sink.write(front)
                whole = lambda x: None if pd.isna(x) else int(x)
                record = encode_record(Record(whole(page_id), url, (html or "").encode("utf-8"), whole(refers)))
                raw = pack.compress(record)
                sink.write(raw)
                n, size = n + 1, size + len(raw)
                if size >= ARCHIVE_BYTES:
                    yield close()
        if sink is not None:
            yield close()

    return run


def write_archives(pages: DataFrame, root: str) -> DataFrame:
    """Writes ``pages`` to archives under ``root`` and returns ``(archive, records, bytes)``, a row for each.

    ``pages`` has ``page_id``, ``url`` and ``html``, nulls allowed; a null html is an empty payload. Of pages
    with equal payloads of ``SMALLEST_SHARED`` bytes or more, those with the smallest id are responses
    and the others revisit it; a page without an id is always a response.
    """
    rows = in_small_batches(pages).select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    files, folder = _filesystem(root)
    files.create_dir(folder)
    sample = rows.where("html != ''").orderBy(F.xxhash64("html")).select(F.substring("html", 1, 1 << 16)).limit(TRAIN_PAYLOADS)
    dictionary = train_dictionary([r[0].encode("utf-8") for r in sample.collect()])
    digest = F.when(F.octet_length("html") >= SMALLEST_SHARED, F.sha2(F.col("html").cast("binary"), 256))
    hashed = rows.withColumn("digest", digest)
    shared = (
        hashed.where("digest IS NOT NULL AND page_id IS NOT NULL").groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first")
    )
    told = hashed.join(lookup_side(shared), "digest", "left").withColumn("refers_to", F.when(F.col("page_id") != F.col("first"), F.col("first")))
    return materialise(
        told.select("page_id", "url", "html", "refers_to").mapInPandas(_write_task(root, dictionary), "archive string, records long, bytes long")
    )


READ_FIELDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string"


def read_archives(spark: SparkSession, archives: DataFrame, payload: bool = False) -> DataFrame:
    """Every record of the archives named in the column ``archive``; ``payload`` adds it as bytes.

    A record, header, length or digest that doesn't hold fails the read with the archive's name.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in READ_FIELDS.split(", ")] + ["payload"] * payload

        def frame(rows: list) -> pd.DataFrame:
            return pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})

        for batch in batches:
            for archive in batch["archive"]:
                files, path = _filesystem(archive)
                rows, size = [], 0
                with files.open_input_stream(path, compression=None) as source:
                    try:
                        for raw in frames(source):
                            rows.append(decode_record(raw))
                            size += len(raw) if payload else 500
                            if size > 8 << 20:
                                yield frame(rows)
                                rows, size = [], 0
                    except (ValueError, zstandard.ZstdError) as e:
                        raise ValueError(f"{archive}, after {len(rows)} records: {e}") from e
                if rows:
                    yield frame(rows)

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return archives.select("archive").repartition(tasks).mapInPandas(run, READ_FIELDS + ", payload binary" * payload)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` to archives in the cluster's shared folder and reads every record back."""
    spark = pages.sparkSession
    archives = write_archives(pages, work_dir(spark))
    return read_archives(spark, archives).drop("target_uri")
