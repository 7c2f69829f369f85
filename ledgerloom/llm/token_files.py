"""Token-id files: whole texts as ids of a given tokenizer, coded by `idcoder`, in ascending id order.

Documents are range-partitioned and sorted by their id; every partition becomes one file in the
shared folder, written under a name of its own and named in the manifest only when its task has
succeeded, so retried tasks leave nothing that is read. Files are read back from the manifest.

Encoding goes by distinct pieces: the tokenizer ignores letter case, drops white space and cuts
words where letters, digits and signs meet before its merges, and no merge reaches over a cut,
so a text's ids are those of its pieces in order. A task encodes every distinct piece once, by
the tokenizer itself, and remembers a bounded number of them.

A null text is empty and holds only the end id. Rows of one document id stand together in an
undefined order; rows without an id come first and keep none. An empty table gives no files and
no rows. Other columns are not stored, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
import os
import struct
import unicodedata
import uuid
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import lean, load, save, scan_words, shared_dir, slices, staged, table, text_buffer, word_table
from ledgerloom.llm.idcoder import read_ids, write_ids

TOKENIZER = "word_bpe_49k.json"
END = 2
GROUP_BYTES = 4 << 20
CALL_PIECES = 1 << 14
CACHE_PIECES = 1 << 20
SPACE = b" \t\n\x0b\x0c\r"
VALUES = word_table(SPACE)
#: 0 other ASCII, 1 letters, 2 digits, 3 bytes beyond ASCII.
KIND = np.zeros(256, np.int8)
KIND[0x41:0x5B] = KIND[0x61:0x7B] = 1
KIND[0x30:0x3A] = 2
KIND[0x80:] = 3


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _cuts(data: np.ndarray, starts: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Cut words where letters, digits and signs meet, as the tokenizer itself does before its merges.

    A cut is only made before an ASCII character, which nothing composes with, and after an ASCII
    character or one of the Latin `letters`. Words with an apostrophe or `<` stay whole, as these start
    endings and markers that the tokenizer knows.
    """
    if len(data) < 3:
        return starts
    kind = KIND[data]
    before, after = kind[:-1], kind[1:]
    latin = np.zeros(len(data) - 1, bool)
    beyond = np.flatnonzero(before[1:] == 3) + 1
    latin[beyond] = letters[data[beyond - 1].astype(np.uint16) << 8 | data[beyond]]
    cut = (after < 3) & (VALUES[data[1:]] != 0) & (VALUES[data[:-1]] != 0)
    cut &= ((before < 3) & (before != after)) | ((before == 3) & latin & (after != 1))
    places = np.flatnonzero(cut) + 1
    special = np.flatnonzero((data == 0x27) | (data == 0x3C))
    if len(special):
        whole = np.unique(np.searchsorted(starts, special, "right") - 1)
        places = places[~np.isin(np.searchsorted(starts, places, "right") - 1, whole)]
    begins = np.zeros(len(data), bool)
    begins[starts] = begins[places] = True
    return np.flatnonzero(begins)


@functools.cache
def _tokenizer(path: str):
    """Loaded once per Python worker, as it is large."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.cache
def _latin_letters(path: str) -> np.ndarray:
    """By the two bytes of a character from U+00C0 to U+024F: whether the tokenizer's normal form of it is letters only.

    A capital whose lower case ends in a combining mark is not: the mark goes with signs that follow.
    """
    out = np.zeros(1 << 16, bool)
    normal = _tokenizer(path).normalizer
    for c in map(chr, range(0xC0, 0x250)):
        a, b = c.encode()
        out[a << 8 | b] = all(unicodedata.category(x).startswith("L") for x in (normal.normalize_str(c) if normal else c))
    return out


class Encoder:
    """Ids of texts; every distinct piece goes to the tokenizer once, as long as it is remembered."""

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.cuts = functools.partial(_cuts, letters=_latin_letters(path))
        self._forget()

    def _forget(self) -> None:
        self.keys, self.first, self.lengths = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def _learn(self, keys: np.ndarray, raw: bytes, begins: list[int], ends: list[int]) -> None:
        """Encode new pieces; a call at a time, as the tokenizer's answers are large."""
        lengths, flat = [], [self.flat]
        for k in range(0, len(keys), CALL_PIECES):
            span = slice(k, k + CALL_PIECES)
            pieces = [raw[a:b].rstrip(SPACE).decode("utf-8", "replace") for a, b in zip(begins[span], ends[span])]
            coded = [x.ids for x in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
            lengths.append(np.fromiter(map(len, coded), np.int64, len(coded)))
            flat.append(np.fromiter(chain.from_iterable(coded), np.int32, int(lengths[-1].sum())))
        lengths = np.concatenate(lengths)
        first = np.r_[self.first, len(self.flat) + np.cumsum(lengths) - lengths]
        keys = np.r_[self.keys, keys]
        order = np.argsort(keys)
        self.keys, self.first, self.lengths = keys[order], first[order], np.r_[self.lengths, lengths][order]
        self.flat = np.concatenate(flat)

    def encode(self, data: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per row), each row closed by the end id."""
        starts, hashes, counts = scan_words(data, offsets, VALUES, self.cuts)
        bounds = np.r_[starts, len(data)]
        # markers are told apart by letter case, other pieces are not
        for place in np.unique(np.searchsorted(starts, np.flatnonzero(data == 0x3C), "right") - 1).tolist():
            own = data[bounds[place]:bounds[place + 1]].tobytes().rstrip(SPACE)
            hashes[place] = int.from_bytes(hashlib.blake2b(own, digest_size=8).digest(), "little")
        own, where, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) > CACHE_PIECES:
            self._forget()
        at = np.minimum(np.searchsorted(self.keys, own), max(0, len(self.keys) - 1))
        fresh = np.flatnonzero(self.keys[at] != own) if len(self.keys) else np.arange(len(own))
        if len(fresh):
            self._learn(own[fresh], data.tobytes(), bounds[where[fresh]].tolist(), bounds[where[fresh] + 1].tolist())
        at = np.searchsorted(self.keys, own)
        first, lengths = self.first[at], self.lengths[at]
        length = lengths[back]
        before = np.r_[0, np.cumsum(length)]
        ends = np.cumsum(counts)
        per_row = before[ends] - before[ends - counts] + 1
        inner = np.ones(int(per_row.sum()), bool)
        inner[np.cumsum(per_row) - 1] = False
        out = np.full(len(inner), end, np.int32)
        out[inner] = self.flat[np.arange(before[-1]) + np.repeat(first[back] - before[:-1], length)]
        return out, per_row


MANIFEST = "file int, path string, docs long, ids long, bytes long"


def write_token_files(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
                      tokenizer: str = TOKENIZER, end: int = END) -> DataFrame:
    """Write the files; the manifest (file, path, docs, ids, bytes), files numbered in ascending id order."""

    def write(batches):
        from pyspark import TaskContext

        coder, keys, ids, counts = Encoder(tokenizer_path(tokenizer)), [], [], []
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            keys.append(batch.column(0))
            for a, b in slices(offsets, GROUP_BYTES):
                own, n = coder.encode(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], end)
                ids.append(own)
                counts.append(n)
        if not keys:
            return
        keys, ids, counts = pa.concat_arrays(keys), np.concatenate(ids), np.concatenate(counts)
        del coder
        rows = struct.pack("<Q", len(counts)) + np.asarray(keys.is_valid()).astype(np.uint8).tobytes()
        rows += keys.fill_null(0).to_numpy().astype("<i8").tobytes() + counts.astype("<i8").tobytes()
        data = write_ids(ids, rows)
        number = TaskContext.get().partitionId()
        path = save(folder, f"ids-{number:06d}-{uuid.uuid4().hex}.bin", data)
        yield pa.RecordBatch.from_pydict({"file": pa.array([number], pa.int32()), "path": [path], "docs": [len(counts)],
                                          "ids": [len(ids)], "bytes": [len(data)]})

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    ordered = source.repartitionByRange("id").sortWithinPartitions("id")
    return staged(ordered.mapInArrow(lean(write), MANIFEST), "manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    line = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    placed = manifest.withColumn("before", F.coalesce(F.sum("ids").over(line), F.lit(0)))

    def read(batches):
        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
                ids, rows = read_ids(load(path))
                n = struct.unpack_from("<Q", rows)[0]
                valid = np.frombuffer(rows, np.uint8, n, 8).astype(bool)
                keys, counts = np.frombuffer(rows, "<i8", n, 8 + n), np.frombuffer(rows, "<i8", n, 8 + 9 * n)
                ends = np.cumsum(counts)
                ids = memoryview(ids.astype("<u4")).cast("B")
                crc = [zlib.crc32(ids[4 * (e - c):4 * e]) for e, c in zip(ends.tolist(), counts.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64(), mask=~valid), pa.array(before + ends - counts, pa.int64()),
                     pa.array(counts, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = manifest.count()
    spread = placed.select("file", "path", "before").repartitionByRange(max(1, files), "file")  # a file a task
    return spread.mapInArrow(lean(read), "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_and_read(docs: DataFrame) -> DataFrame:
    folder = shared_dir(docs.sparkSession, "ids")
    return read_token_files(write_token_files(docs, folder))


def op2_token_files(spark, folder: str) -> DataFrame:
    return encode_and_read(table(spark, folder, "documents"))
