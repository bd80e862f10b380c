from __future__ import annotations

import hashlib
import io
import struct

import pytest
import zstandard
from llm_fixtures import MIDDLE, entry  # noqa: F401

from caudal.llm import warc
from caudal.session import work_dir

PAGE = "page_id long, url string, html string"


def plain(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        revisit = i is not None and len(raw) >= 100 and first[h] != i
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", first[h] if revisit else None))
    return sorted(out, key=str)


def test_query_is_a_round_trip(entry, spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{MIDDLE}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted(map(tuple, entry["op7_warc_zstd"](spark, MIDDLE).collect()), key=str) == plain(rows)


def test_edges(spark):
    big = "<p>" + "long page é " * 20_000
    rows = [(1, None, None), (2, "http://a/\r\nX: y", ""), (3, "u", "x" * 99), (4, "u", "x" * 99), (9, "u", "y" * 100), (5, "u", "y" * 100), (5, "u", "y" * 100), (6, None, "y" * 100),
            (7, "http://é.example/ü", big), (8, "u", big), (None, "u", big), (10, "u", "\u0000\r\n\r\nWARC/1.1"), (11, "u", "é" * 50), (12, "u", "é" * 50)]
    df = spark.createDataFrame(rows, PAGE).selectExpr("*", "'x' AS digest", "'y' AS first", "1 AS archive")
    assert sorted(map(tuple, warc.round_trip(df).collect()), key=str) == plain(rows)
    assert warc.round_trip(df.limit(0)).collect() == []


def test_archives_hold_payloads_and_roll(spark, monkeypatch):
    pages = spark.read.parquet(f"{MIDDLE}/pages.parquet")
    root = work_dir(spark)
    archives = warc.write_archives(pages, root)
    got = {r.page_id: r.payload for r in warc.read_archives(spark, archives, payload=True).where("record_type = 'response'").collect()}
    want = {r.page_id: r.html.encode() for r in pages.collect()}
    assert {k: bytes(v) for k, v in got.items()} == {k: want[k] for k in got} and len(got) > 200
    assert sum(r.records for r in archives.collect()) == len(want)


def archive(records, dictionary=b"some dictionary text " * 20):
    pack = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    return warc.dictionary_frame(dictionary) + b"".join(pack.compress(r) for r in records)


def test_frames_and_damage():
    records = [warc.encode_record(warc.Record(i, "u", bytes([i]) * 5000)) for i in range(40)]
    raw = archive(records)
    assert list(warc.frames(io.BytesIO(raw))) == records
    plain_front = struct.pack("<II", warc.MAGIC_DICTIONARY, 420) + b"some dictionary text " * 20
    assert list(warc.frames(io.BytesIO(plain_front + raw[len(warc.dictionary_frame(b"some dictionary text " * 20)) :]))) == records
    for bad in (raw[:-3], raw[8:], b"", raw[:6]):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(warc.frames(io.BytesIO(bad)))
    good = warc.encode_record(warc.Record(1, "u", b"payload"))
    assert warc.decode_record(good)["payload"] == b"payload"
    for old, new in ((b"payload", b"pAyload"), (b"Content-Length: ", b"Content-Length: 1"), (b"WARC/1.1", b"WARC/9"), (b"WARC-Date", b"X-Date"), (b"WARC-Date:", b"WARC-Type:"), (b"response\r\n", b"other\r\n")):
        with pytest.raises(ValueError):
            warc.decode_record(good.replace(old, new, 1))


def test_a_cut_archive_names_itself(spark, tmp_path):
    path = tmp_path / "cut.warc.zst"
    path.write_bytes(archive([warc.encode_record(warc.Record(1, None, b"x"))])[:-2])
    df = spark.createDataFrame([(f"file://{path}",)], "archive string")
    with pytest.raises(Exception, match="cut.warc.zst"):
        warc.read_archives(spark, df).collect()
