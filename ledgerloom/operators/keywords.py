"""Tagging by keyword dictionaries of any size: a text gets the tag of the last rule whose keyword it contains.

`functions.text.keyword_tag` is one CASE per keyword, for a handful of rules. Here the dictionary is compared with
all texts at once: positions where a keyword can begin are found by its first bytes, and at these places the text's
windows of each keyword length are looked up by their hash and compared byte by byte. Texts are gone through in
pieces of `PIECE` bytes, wherever they begin or end, so memory does not grow with batches or single texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYWORDS = 200_000  # of a pass; more rules take more passes
PIECE = 1 << 18  # bytes at whose places keywords are looked for at once
START = 3  # bytes by which a beginning is known
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _sums(data: np.ndarray, powers: np.ndarray) -> np.ndarray:
    """Running polynomial of the bytes, so that any window's hash is one difference."""
    return np.concatenate(([np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:len(data)], dtype=np.uint64)))


def _starts(data: np.ndarray) -> np.ndarray:
    """The first bytes at every place as a number; places near the end are filled up with zeros."""
    wide = np.concatenate((data, np.zeros(START, np.uint8))).astype(np.uint32)
    return wide[:len(data)] | wide[1:len(data) + 1] << np.uint32(8) | wide[2:len(data) + 2] << np.uint32(16)


class Dictionary:
    """Keywords by length: sorted hashes, the last rule of each, and their bytes."""

    def __init__(self, words: list[bytes], rules: list[int]):
        last: dict[bytes, int] = {}
        for word, rule in zip(words, rules):
            if word:
                last[word] = max(rule, last.get(word, rule))
        self.begins = [np.zeros(1 << (8 * k), bool) for k in range(1, START + 1)]
        by_length: dict[int, list[bytes]] = {}
        for word in last:
            by_length.setdefault(len(word), []).append(word)
            size = min(START, len(word))
            self.begins[size - 1][int.from_bytes(word[:size], "little")] = True
        self.lengths = {}
        for size, own in sorted(by_length.items()):
            powers = _powers(size)
            hashes = np.array([_sums(np.frombuffer(w, np.uint8), powers)[-1] for w in own], np.uint64)
            order = np.argsort(hashes, kind="stable")
            self.lengths[size] = (hashes[order], np.array([last[own[i]] for i in order], np.int64),
                                  np.array([np.frombuffer(own[i], np.uint8) for i in order]))

    def last_rules(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Of each text the last rule whose keyword it contains, -1 if none."""
        best = np.full(len(offsets) - 1, -1, np.int64)
        if not len(data) or not self.lengths:
            return best
        longest = max(START, *self.lengths)
        powers, inverse = _powers(PIECE + longest), _powers(PIECE + longest, _INVERSE)
        for first in range(0, len(data), PIECE):
            self._piece(data[first:first + PIECE + longest], min(PIECE, len(data) - first), first, offsets, powers, inverse, best)
        return best

    def _piece(self, data: np.ndarray, places: int, first: int, offsets: np.ndarray, powers: np.ndarray, inverse: np.ndarray, best: np.ndarray) -> None:
        """Raise `best` by the keywords that begin at the first `places` bytes of a piece, which stands at `first`."""
        start = _starts(data)[:places]
        can = self.begins[0][start & np.uint32(0xFF)] | self.begins[1][start & np.uint32(0xFFFF)] | self.begins[2][start]
        at = np.flatnonzero(can)
        text = np.searchsorted(offsets, at + first, "right") - 1
        room = offsets[text + 1] - first - at
        sums = _sums(data, powers)
        for size, (hashes, rules, words) in self.lengths.items():
            own = room >= size
            place, owner = at[own], text[own]
            flat = (sums[place + size] - sums[place]) * inverse[place]  # the window's hash as if it stood at place 0
            wanted = self._known(hashes, flat)
            hit = np.flatnonzero(wanted >= 0)
            found = wanted[hit]
            # every keyword of that hash; two unlike ones of one hash stand side by side
            while len(hit):
                spot = place[hit]
                same = (data[spot[:, None] + np.arange(size)] == words[found]).all(axis=1)
                np.maximum.at(best, owner[hit[same]], rules[found[same]])
                again = found + 1
                more = (again < len(hashes)) & (hashes[np.minimum(again, len(hashes) - 1)] == hashes[found])
                hit, found = hit[more], again[more]

    @staticmethod
    def _known(hashes: np.ndarray, flat: np.ndarray) -> np.ndarray:
        """The first keyword of a hash, -1 if none."""
        spot = np.searchsorted(hashes, flat)
        return np.where((spot < len(hashes)) & (hashes[np.minimum(spot, len(hashes) - 1)] == flat), spot, -1)


def last_rule(df: DataFrame, column: str, keywords: DataFrame, keyword: str = "keyword", rule: str = "rule_no", name: str = "rule_no") -> DataFrame:
    """The rows with `name`, the largest rule number whose keyword the text contains, in any case; null if none.

    keywords(keyword, rule_no); null and empty keywords match nothing. Texts are scanned once per `KEYWORDS` keywords.
    """
    words = keywords.select(F.lower(F.col(keyword).cast("string")).alias("w"), F.col(rule).cast("long").alias("r")).where("w <> ''")
    words = words.groupBy("w").agg(F.max("r").alias("r"))
    count = words.count()
    passes = max(1, -(-count // KEYWORDS))
    rows = df.select("*", F.lit(None).cast("long").alias("__rule"))
    for turn in range(passes):
        own = words if passes == 1 else words.where(F.pmod(F.xxhash64("w"), F.lit(passes)) == turn)
        held = own.toArrow()  # about KEYWORDS rows
        shared = df.sparkSession.sparkContext.broadcast(
            ([w.encode() for w in held.column("w").to_pylist()], held.column("r").to_pylist()))
        rows = _scan(rows, column, shared)
    kept = [c for c in df.columns if c != name]
    return rows.select(*kept, F.col("__rule").alias(name))


def _scan(rows: DataFrame, column: str, shared) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary = None
        for batch in batches:
            if not batch.num_rows:
                continue
            dictionary = dictionary or Dictionary(*shared.value)
            text = batch.column("__text").fill_null("").cast(pa.large_string())
            offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
            buffer = text.buffers()[2]
            data = np.frombuffer(buffer, np.uint8)[offsets[0]:offsets[-1]] if buffer is not None and buffer.size else np.zeros(0, np.uint8)
            best = dictionary.last_rules(data, offsets - offsets[0])
            before = batch.column("__rule").fill_null(-1).to_numpy()
            best = np.maximum(best, before)
            columns = [batch.column(c) for c in names] + [pa.array(best, mask=best < 0)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "__rule"])

    names = [c for c in rows.columns if c != "__rule"]
    text = F.lower(F.col(column).cast("string"))
    schema = rows.select(*names, "__rule").schema
    return rows.select(*names, "__rule", text.alias("__text")).mapInArrow(run, schema)
