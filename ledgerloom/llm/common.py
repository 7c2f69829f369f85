"""Word scanning and small helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import posixpath
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from ledgerloom.session import shared_dir, staged

__all__ = ["staged", "shared_dir", "ship", "lean", "table", "save", "load", "mix64", "word_table", "scan_words", "text_buffer", "slices"]

PIECE = 1 << 20


_SHIPPED: set[str] = set()
BATCH_LIMIT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, whatever their import path is.

    Batches of long texts are kept small, unless the session has a limit of its own.
    """
    if spark.conf.get(BATCH_LIMIT, None) in (None, "67108864b"):  # Spark's default
        spark.conf.set(BATCH_LIMIT, BATCH_BYTES)
    if spark.sparkContext.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="ship-"), "ledgerloom.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in sorted(os.walk(package)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(spark.sparkContext.applicationId)


def lean(run):
    """A batch function that gives its memory back when it ends: Python workers are used again by later tasks."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_table(separators: bytes) -> np.ndarray:
    """A random value per byte, 0 for separators; A-Z get the values of a-z."""
    values = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    for upper in range(0x41, 0x5B):
        values[upper] = values[upper + 32]
    values[list(separators)] = 0
    return values


_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        inverse = np.uint64(pow(_BASE, -1, 1 << 64))
        up, down = np.full(n, _BASE, np.uint64), np.full(n, inverse, np.uint64)
        up[0] = down[0] = 1
        _POWERS[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _POWERS[0], _POWERS[1]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `size` bytes each; a longer row stands alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, last
        first = last


def scan_words(data: np.ndarray, offsets: np.ndarray, values: np.ndarray,
               cuts: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start byte and 64-bit hash of every word, and the number of words per row.

    `values` is a `word_table`. The hash is a polynomial over the bytes, scrambled at the end;
    words never reach over a row's end. `cuts` gets the bytes and the words' starts and returns
    all places to start at, if words are to be cut further.
    """
    used = (values != 0)[data]
    begins = used.copy()
    begins[1:] &= ~used[:-1]
    inner = offsets[:-1][offsets[:-1] < len(data)]
    begins[inner] = used[inner]
    starts = np.flatnonzero(begins)
    if cuts is not None:
        starts = cuts(data, starts)
    counts = np.diff(np.searchsorted(starts, offsets))
    hashes = np.empty(len(starts), np.uint64)
    done = 0
    while done < len(starts):
        last = max(done + 1, int(np.searchsorted(starts, starts[done] + PIECE)))
        end = int(starts[last]) if last < len(starts) else len(data)
        low = int(starts[done])
        up, down = _powers(max(PIECE, end - low + 1))
        own = starts[done:last] - low
        hashes[done:last] = np.add.reduceat(values[data[low:end]] * up[:end - low], own) * down[own]
        done = last
    return starts, mix64(hashes), counts


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def save(folder: str, name: str, data: bytes) -> str:
    """Write a whole file below a shared folder; a path or a URI."""
    system, base = _open(folder)
    system.create_dir(base, recursive=True)
    with system.open_output_stream(posixpath.join(base, name)) as out:
        out.write(data)
    return posixpath.join(folder, name)


def load(path: str) -> bytes:
    system, base = _open(path)
    with system.open_input_stream(base) as source:
        return source.read()
