from __future__ import annotations

import base64
import hashlib

import pytest

from ledgerloom.llm import warc
from ledgerloom.llm.common import load

PAGES = "page_id long, url string, html string, digest string"


def archive(spark, rows, folder):
    return warc.write_archives(spark.createDataFrame(rows, PAGES), str(folder), archive_bytes=5000)


def test_against_brute_force(spark, tmp_path):
    rows = [(i, f"http://h/{i}\r\nX: y", ["", "<p>é</p>" * (i % 5 + 1), f"<html>{i}</html>", None][i % 4], "d") for i in range(80)]
    first, expected = {}, []
    for key, _, html, _ in rows:
        data = (html or "").encode()
        seen = first.setdefault(data, key)
        expected.append((key, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                         "response" if seen == key else "revisit", None if seen == key else seen))
    manifest = archive(spark, rows, tmp_path)
    got = warc.read_archives(manifest)
    assert sorted(map(tuple, got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())) == expected
    payloads = {r.page_id: r.payload for r in got.where("record_type = 'response'").collect()}
    assert all(payloads[k] == (h or "") for k, _, h, _ in rows if k in payloads)
    assert manifest.agg({"records": "sum"}).first()[0] == 80


def test_every_record_is_a_frame_of_its_own(spark, tmp_path):
    import zstandard

    rows = [(i, "http://a/", f"<html><body>page number {i} of many alike pages</body></html>", "") for i in range(60)]
    path = archive(spark, rows, tmp_path).first().path
    data = load(path)
    assert data[:4] == (0x184D2A5D).to_bytes(4, "little")
    size = int.from_bytes(data[4:8], "little")
    coder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size])).decompressobj()
    fields, block = warc.parse_record(coder.decompress(data[8 + size:]))
    assert fields["warc-type"] == "response" and block.startswith(b"HTTP/1.1 200 OK")
    broken = bytearray(data)
    broken[-6] ^= 255
    with pytest.raises(Exception):
        list(warc.unpack_archive(bytes(broken)))


def test_null_ids_repeated_rows_long_and_empty(spark, tmp_path):
    rows = [(None, None, "same", "1"), (5, "u", "same", "2"), (5, "u", "same", "2"), (7, "u", "x" * 200_000, "3"), (None, None, "lone", "4")]
    got = sorted(((r.page_id or -1, r.record_type, r.refers_to) for r in warc.read_archives(archive(spark, rows, tmp_path)).collect()), key=str)
    assert got == sorted([(-1, "revisit", 5), (5, "response", None), (5, "response", None), (7, "response", None),
                          (-1, "response", None)], key=str)
    assert warc.read_archives(archive(spark, rows[:0], tmp_path)).count() == 0


def test_record_ids_are_unique_and_archives_read_side_by_side(spark, tmp_path):
    rows = [(i % 30, "u", f"{'x' * 900}{i % 45}", "d") for i in range(120)] + [(None, "u", "n", "d")] * 3
    manifest = archive(spark, rows, tmp_path)
    heads = [warc.parse_record(x)[0] for r in manifest.collect() for x in warc.unpack_archive(load(r.path))]
    ids = [h["warc-record-id"] for h in heads]
    assert len(ids) == 123 == len(set(ids))
    assert all(h["warc-refers-to"] in ids for h in heads if "warc-refers-to" in h)
    assert warc.read_archives(manifest).rdd.getNumPartitions() > manifest.count() // 2


def test_clashing_columns(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "p", "a", 5, True)], "page_id long, url string, html string, digest string, first long, many boolean")
    assert warc.read_archives(warc.write_archives(df, str(tmp_path))).first().payload == "p"
