"""Dictionary-compressed web archives.

Every task writes archives of its own: a leading skippable frame with a Zstandard dictionary
built from the archive's records, then each record as a frame of its own, so a record can be
read alone with the dictionary. Of pages with equal payloads the one with the smallest id is
archived whole, the others as revisits that carry its digest and length.

Equal payloads are found by their SHA-256 over all pages: the smallest id per digest is combined
before the shuffle and joined back. Archives are written under names of their own and named in
the manifest only when their task has succeeded; they are read back from the manifest.

A null html is an empty payload, a null url leaves the target out. Rows that share the smallest
id and the payload are all responses, so are rows without an id whose payload no row with an
id has; rows of one id get record ids of their own. Very long payloads are archived whole. An empty table gives
no archives. Other columns are not archived, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import lean, load, save, shared_dir, staged, table

ARCHIVE_BYTES = 16 << 20
SAMPLE_BYTES = 2 << 20
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
#: Fixed values of the formats.
FRAME_DICTIONARY = 0x184D2A5D
FRAME_DATA = 0xFD2FB528
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{name}')}>"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def build_record(page_id: int | None, url: str | None, payload: bytes, first: int | None, revisit: bool,
                 name: str | None = None, named_first: bool = True) -> bytes:
    """One record: a response with its payload, or a revisit of the page `first`.

    `name` is what makes the record's id where the page's id does not; a page whose id has
    several records (not `named_first`) is referred to by its id only.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(str(page_id) if name is None else name)}",
            f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~-._"))
    head += [f"WARC-Payload-Digest: sha1:{payload_digest(payload)}", f"X-Payload-Length: {len(payload)}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT}", f"X-Refers-To-Page-ID: {first}"]
        head += [f"WARC-Refers-To: {_record_id(str(first))}"] if named_first else []
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields by lower-case name, and the block."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a record")
    fields = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines[1:])}
    size = int(fields["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record of wrong length")
    return fields, rest[:size]


def build_dictionary(records: list[bytes]) -> bytes:
    """A dictionary from an even choice of the archive's records, of bounded size in all."""
    import zstandard

    step = max(1, sum(map(len, records)) // SAMPLE_BYTES)
    sample = [r[:SAMPLE_BYTES] for r in records[::step]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too few records to train on: their own bytes serve
        return b"".join(sample)[-DICTIONARY_BYTES:]


def pack_archive(records: list[bytes]) -> bytes:
    import zstandard

    words = build_dictionary(records)
    coder = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(words), write_checksum=True)
    return b"".join([struct.pack("<II", FRAME_DICTIONARY, len(words)), words, *map(coder.compress, records)])


def unpack_archive(data: bytes) -> Iterator[bytes]:
    import zstandard

    kind, size = struct.unpack_from("<II", data)
    if kind != FRAME_DICTIONARY:
        raise ValueError("no dictionary frame")
    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size]))
    at, view = 8 + size, memoryview(data)
    while at < len(data):
        frame, parts, step = decoder.decompressobj(), [], 1 << 14
        while not frame.eof:
            if at >= len(data):
                raise ValueError("a frame is cut off")
            parts.append(frame.decompress(view[at:at + step]))
            at += min(step, len(data) - at)
        at -= len(frame.unused_data)
        yield b"".join(parts)


def mark_revisits(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html") -> DataFrame:
    """(id, digest, first, many, first_many): one row per distinct id and payload, with the smallest id of that
    payload, and whether either id has several rows."""
    keyed = pages.select(F.col(id_col).cast("long").alias("id"), F.sha2(F.coalesce(
        F.col(payload_col).cast("string"), F.lit("")), 256).alias("digest")).groupBy("id", "digest").agg(F.count("*").alias("n"))
    marks = keyed.drop("n").join(keyed.groupBy("digest").agg(F.min("id").alias("first")), "digest")
    again = staged(keyed.where("id IS NOT NULL").groupBy("id").agg(F.sum("n").alias("n")).where("n > 1").select("id"), "repeated")
    for column, own in (("id", "many"), ("first", "first_many")):
        marks = marks.join(again.select(F.col("id").alias(column), F.lit(True).alias(own)), column, "left")
    return marks.select("id", "digest", "first", (F.coalesce("many", F.lit(False)) | F.col("id").isNull()).alias("many"),
                        F.coalesce("first_many", F.lit(False)).alias("first_many"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the archives; the manifest (path, records, raw_bytes, bytes)."""

    def write(batches):
        held, size, own, count = [], 0, uuid.uuid4().hex, 0

        def flush():
            data = pack_archive(held)
            path = save(folder, f"pages-{uuid.uuid4().hex}.warc.zst", data)
            return pa.RecordBatch.from_pydict({"path": [path], "records": [len(held)], "raw_bytes": [size], "bytes": [len(data)]})

        for batch in batches:
            for i in range(batch.num_rows):
                page, url, payload, first, many, first_many = (c[i].as_py() for c in batch.columns)
                count += 1
                held.append(build_record(page, url, (payload or "").encode(), first, first is not None and first != page,
                                         f"{page}:{own}:{count}" if many else None, not first_many))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    own = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                       F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    own = own.withColumn("digest", F.sha2("payload", 256)).alias("o")
    marks = staged(mark_revisits(pages, id_col, payload_col), "marks").alias("m")
    joined = own.join(marks, (F.col("o.digest") == F.col("m.digest")) & F.col("o.id").eqNullSafe(F.col("m.id")))
    joined = joined.select("o.id", "o.url", "o.payload", "m.first", "m.many", "m.first_many")
    return staged(joined.mapInArrow(lean(write), "path string, records long, raw_bytes long, bytes long"), "manifest")


def read_archives(manifest: DataFrame) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to) of every record."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def read(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                for data in unpack_archive(load(path)):
                    rows.append(_row(data))
                    size += len(data)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    ddl = ("page_id long, url string, payload string, payload_bytes long, payload_digest string, record_type string, "
           "refers_to long")
    files = max(1, manifest.count())
    return manifest.select("path").repartitionByRange(files, "path").mapInArrow(lean(read), ddl)  # an archive a task


def _row(data: bytes) -> dict:
    fields, block = parse_record(data)
    payload = block.partition(b"\r\n\r\n")[2]
    digest, length = fields["warc-payload-digest"].removeprefix("sha1:"), int(fields["x-payload-length"])
    response = fields["warc-type"] == "response"
    if response and (len(payload) != length or payload_digest(payload) != digest):
        raise ValueError("a damaged payload")
    return {
        "page_id": int(fields["x-page-id"]) if "x-page-id" in fields else None, "url": fields.get("warc-target-uri"),
        "payload": payload.decode() if response else None, "payload_bytes": length, "payload_digest": digest,
        "record_type": fields["warc-type"],
        "refers_to": None if response else int(fields["x-refers-to-page-id"]),
    }


def op5_warc(spark, folder: str) -> DataFrame:
    manifest = write_archives(table(spark, folder, "pages"), shared_dir(spark, "warc"))
    return read_archives(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
