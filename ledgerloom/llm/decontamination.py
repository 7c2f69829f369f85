"""Benchmark decontamination on a distributed positional inverted index.

The index is split by document: a segment is one row that holds the sorted term hashes of some
megabytes of whole documents and, per term, the positions it stands at. Segments are built
where the documents are read, so the corpus is never shuffled, and are written once to the
shared folder. A search visits every segment with a block of test items: each window of words
starts from the postings of its globally rarest term, and the candidates are intersected with
the offset-adjusted postings of its next rarest terms until all terms have been met. Nearby
matches use the same lists with a slack around each term's place.

Words are compared by 64-bit hashes. Test items are read in blocks of bounded size, each of
which is broadcast; the blocks' matches are merged per document.

Null, empty and wordless texts have no words and no hits. Repeated rows are judged one by one.
Null item ids are reported as the text `null`. An empty test table leaves all documents clean;
columns of the documents other than the id and the text play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import lean, scan_words, slices, staged, table, text_buffer, word_table

WINDOW = 10
SEGMENT_BYTES = 2 << 20
BLOCK_WORDS = 1 << 20
CANDIDATES = 1 << 21

#: Words are runs of digits, letters and all characters beyond ASCII.
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
VALUES = word_table(SEPARATORS)

SEGMENT = pa.schema([
    ("segment", pa.string()), ("ids", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int32())),
    ("terms", pa.binary()), ("counts", pa.binary()), ("gaps", pa.binary()),
])
SEGMENT_DDL = "segment string, ids array<long>, n_words array<int>, terms binary, counts binary, gaps binary"


def _segment(name: str, ids: list, hashes: np.ndarray, counts: np.ndarray) -> dict:
    """One index row. Documents are set apart by one free position, so no phrase crosses them."""
    row = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(hashes), dtype=np.int64) + row
    order = np.argsort(hashes, kind="stable")
    ordered, place = hashes[order], place[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, np.int64)
    gaps = np.diff(place, prepend=0)
    gaps[first] = place[first]
    return {
        "segment": name, "ids": ids, "n_words": counts.astype(np.int32),
        "terms": ordered[first].tobytes(), "counts": np.diff(np.r_[first, len(ordered)]).astype(np.int32).tobytes(),
        "gaps": gaps.astype(np.int32).tobytes(),
    }


class Postings:
    """A segment ready for search."""

    def __init__(self, row: dict):
        self.ids, self.n_words = row["ids"], np.asarray(row["n_words"], np.int64)
        self.starts = np.r_[0, np.cumsum(self.n_words + 1)]
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.counts = np.frombuffer(row["counts"], np.int32).astype(np.int64)
        gaps = np.frombuffer(row["gaps"], np.int32).astype(np.int64)
        self.firsts = np.r_[0, np.cumsum(self.counts)]
        total = np.cumsum(gaps)
        base = total[self.firsts[:-1]] - gaps[self.firsts[:-1]] if len(gaps) else np.zeros(0, np.int64)
        self.places = total - np.repeat(base, self.counts)
        # one sorted key per posting: term number, then place
        self.span = int(self.starts[-1]) + 1
        self.keys = np.repeat(np.arange(len(self.terms), dtype=np.int64), self.counts) * self.span + self.places

    def numbers(self, terms: np.ndarray) -> np.ndarray:
        """The segment's number of each term, -1 where it does not occur."""
        if not len(self.terms):
            return np.full(len(terms), -1, np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def meets(self, number: np.ndarray, place: np.ndarray, slack: int = 0) -> np.ndarray:
        """Whether the term stands within `slack` of the place, by binary search in its list."""
        low, high = np.maximum(place - slack, 0), place + slack
        at = np.searchsorted(self.keys, number * self.span + low)
        found = self.keys[np.minimum(at, len(self.keys) - 1)]
        return (at < len(self.keys)) & (high >= 0) & (found <= number * self.span + np.minimum(high, self.span - 1))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Segments of the positional index over whole texts; lazy, one pass, no shuffle."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        ids, words, counts, size = [], [], [], 0

        def flush():
            hashes = np.concatenate(words) if words else np.zeros(0, np.uint64)
            row = _segment(uuid.uuid4().hex, list(ids), hashes, np.concatenate(counts))
            return pa.RecordBatch.from_pylist([row], schema=SEGMENT)

        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            keys = batch.column(0).to_pylist()
            for a, b in slices(offsets):
                _, hashes, n = scan_words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], VALUES)
                ids += keys[a:b]
                words.append(hashes)
                counts.append(n)
                size += int(offsets[b] - offsets[a])
                if size >= segment_bytes:
                    yield flush()
                    ids, words, counts, size = [], [], [], 0
        if ids:
            yield flush()

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(lean(build), SEGMENT_DDL)


class Windows:
    """A block of test items as windows of term numbers, rarest term first once counts are known."""

    def __init__(self, items: list[tuple[str, np.ndarray]], width: int):
        self.items = [name for name, _ in items]
        parts: dict[int, list] = {}
        for i, (_, words) in enumerate(items):
            size = min(width, len(words))
            view = np.lib.stride_tricks.sliding_window_view(words, size)
            parts.setdefault(size, []).append((np.full(len(view), i), view))
        self.groups = [(size, np.concatenate([a for a, _ in p]), np.concatenate([b for _, b in p]))
                       for size, p in sorted(parts.items())]
        self.vocabulary = np.unique(np.concatenate([g[2].ravel() for g in self.groups])) if self.groups else np.zeros(0, np.uint64)

    def rank(self, totals: np.ndarray) -> Windows:
        """Order the terms of each window by their count in the whole index; drop impossible windows."""
        ranked = []
        for size, item, terms in self.groups:
            number = np.searchsorted(self.vocabulary, terms)
            seen = totals[number]
            keep = (seen > 0).all(axis=1)
            order = np.argsort(seen[keep], axis=1, kind="stable")
            ranked.append((size, item[keep], np.take_along_axis(number[keep], order, 1), order))
        self.groups = ranked
        return self


def _read_items(items: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list]:
    """Items with their word hashes, in blocks of about so many words."""

    def hashed(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            _, words, counts = scan_words(data, offsets, VALUES)
            ends = np.cumsum(counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([words[e - n:e].tobytes() for n, e in zip(counts, ends)], pa.binary())],
                names=["id", "words"])

    source = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("id"),
                          F.col(text_col).cast("string").alias("text"))
    block, size = [], 0
    for row in source.mapInArrow(lean(hashed), "id string, words binary").toLocalIterator():
        if row.words:
            block.append((row.id, np.frombuffer(bytes(row.words), np.uint64)))
            size += len(block[-1][1])
        if size >= block_words:
            yield block
            block, size = [], 0
    if block:
        yield block


def _totals(index: DataFrame, vocabulary) -> np.ndarray:
    """Postings of each vocabulary term in the whole index."""

    def count(batches):
        terms, total = vocabulary.value, None
        for batch in batches:
            for term, n in zip(batch.column(0), batch.column(1)):
                own, n = np.frombuffer(term.as_py(), np.uint64), np.frombuffer(n.as_py(), np.int32)
                if len(own):
                    at = np.minimum(np.searchsorted(own, terms), len(own) - 1)
                    found = np.where(own[at] == terms, n[at], 0).astype(np.int64)
                    total = found if total is None else total + found
        if total is not None:
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], names=["term", "n"])

    totals = np.zeros(len(vocabulary.value), np.int64)
    for row in index.select("terms", "counts").mapInArrow(lean(count), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        totals[row.term] = row.n
    return totals


def _find(postings: Postings, windows: Windows, slack: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(start place, item number, width) of every occurrence of a window in a segment."""
    number = postings.numbers(windows.vocabulary)
    for size, item, terms, offsets in windows.groups:
        own = number[terms]
        here = np.flatnonzero((own >= 0).all(axis=1))
        if not len(here):
            continue
        seeds = postings.counts[own[here, 0]]
        cuts = np.searchsorted(np.cumsum(seeds), np.arange(0, seeds.sum() + CANDIDATES, CANDIDATES), "right")
        for a, b in zip(cuts[:-1], np.maximum(cuts[1:], cuts[:-1])):
            part = here[a:b] if b < len(here) else here[a:]
            if not len(part):
                continue
            length = postings.counts[own[part, 0]]
            window = np.repeat(part, length)
            shift = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
            place = postings.places[postings.firsts[own[window, 0]] + shift] - offsets[window, 0]
            window, place = window[place >= 0], place[place >= 0]
            for k in range(1, size):
                if not len(place):
                    break
                kept = postings.meets(own[window, k], place + offsets[window, k], slack)
                window, place = window[kept], place[kept]
            if len(place):
                yield place, item[window], size


def match(index: DataFrame, items: DataFrame, item_id: str = "item_id", item_text: str = "text", width: int = WINDOW,
          slack: int = 0, block_words: int = BLOCK_WORDS, digest: bool = False) -> DataFrame:
    """Per document: its words, the word ranges hit by a window of an item, and these items.

    A window is `width` consecutive words of an item, or the whole of a shorter one. With
    `slack` 0 matches are exact phrases; else each further term of a window may stand up to
    `slack` words from its place beside the rarest term, in the same document.
    `index` must be written (`staged`), as its segments are named at random. With `digest` the
    result is counted and digested per document, in the same tasks if one block holds all items.
    """
    spark = index.sparkSession
    blocks = []
    for block in _read_items(items, item_id, item_text, block_words):
        windows = Windows(block, width)
        vocabulary = spark.sparkContext.broadcast(windows.vocabulary)
        blocks.append(spark.sparkContext.broadcast(windows.rank(_totals(index, vocabulary))))
    if not blocks:
        blocks.append(spark.sparkContext.broadcast(Windows([], width).rank(np.zeros(0))))
    if len(blocks) == 1:
        found = _search(index, blocks[0], slack, digest)
        return found if digest else found.drop("segment", "row")
    found = [_search(index, block, slack) for block in blocks]
    merged = reduce(DataFrame.unionByName, found).groupBy("segment", "row").agg(
        F.first("id").alias("id"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("begins")).alias("begins"), F.flatten(F.collect_list("ends")).alias("ends"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    merged = merged.drop("segment", "row")
    return merged.mapInArrow(lean(_digest), DIGEST) if digest else merged


FOUND = pa.schema([
    ("segment", pa.string()), ("row", pa.int32()), ("id", pa.int64()), ("n_words", pa.int64()),
    ("begins", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("items", pa.list_(pa.string())),
])


DIGEST = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def _search(index: DataFrame, windows, slack: int, digest: bool = False) -> DataFrame:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                segment = batch.slice(i, 1).to_pylist()[0]
                postings, block = Postings(segment), windows.value
                change = np.zeros(postings.span + 1, np.int64)
                pairs = [np.zeros(0, np.int64)]
                for place, item, size in _find(postings, block, slack):
                    doc = np.searchsorted(postings.starts, place, "right") - 1
                    if slack:  # a window with slack may reach over the end of a text
                        inside = place + size <= postings.starts[doc] + postings.n_words[doc] + slack
                        doc, place, item = doc[inside], place[inside], item[inside]
                    end = np.minimum(place + size, postings.starts[doc] + postings.n_words[doc])
                    np.add.at(change, place, 1)
                    np.add.at(change, end, -1)
                    pairs.append(np.unique(doc * len(block.items) + item))
                hit = np.cumsum(change) > 0
                edges = np.diff(np.r_[0, hit.astype(np.int8)])
                begins, ends = np.flatnonzero(edges > 0), np.flatnonzero(edges < 0)
                owner = np.searchsorted(postings.starts, begins, "right") - 1
                cuts = np.searchsorted(owner, np.arange(len(postings.ids) + 1))
                found = np.unique(np.concatenate(pairs))
                names = np.searchsorted(found // max(1, len(block.items)), np.arange(len(postings.ids) + 1))
                rows = []
                for k, key in enumerate(postings.ids):
                    a, b = cuts[k], cuts[k + 1]
                    rows.append({
                        "segment": segment["segment"], "row": k, "id": key, "n_words": int(postings.n_words[k]),
                        "begins": begins[a:b] - postings.starts[k], "ends": ends[a:b] - postings.starts[k],
                        "items": [block.items[x % len(block.items)] for x in found[names[k]:names[k + 1]]],
                    })
                for a in range(0, len(rows), 2000):
                    yield pa.RecordBatch.from_pylist(rows[a:a + 2000], schema=FOUND)

    ddl = "segment string, row int, id long, n_words long, begins array<int>, ends array<int>, items array<string>"
    if digest:
        return index.mapInArrow(lean(lambda batches: _digest(search(batches))), DIGEST)
    return index.mapInArrow(lean(search), ddl)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_hit, n_items, digest = [], [], []
        for begins, ends, items in zip(*(batch.column(k).to_pylist() for k in ("begins", "ends", "items"))):
            total, last = 0, 0
            for a, b in sorted(zip(begins, ends)):
                total += max(0, b - max(a, last))
                last = max(last, b)
            names = sorted(set(items))
            n_hit.append(total)
            n_items.append(len(names))
            digest.append(hashlib.sha256(",".join(names).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("n_words"), pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()),
             pa.array(digest, pa.string()), pa.array([h > 0 for h in n_hit], pa.bool_())],
            names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])


def contamination(docs: DataFrame, items: DataFrame, width: int = WINDOW, segment_bytes: int = SEGMENT_BYTES,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: words, words hit, test items found and their digest, whether any was hit."""
    index = staged(build_index(docs, segment_bytes=segment_bytes), "positions")
    return match(index, items, width=width, block_words=block_words, digest=True)


def op7_decontamination(spark, folder: str) -> DataFrame:
    return contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(10, len(w)) AS size, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS phrase
  FROM b, unnest(range(1, greatest(0, len(w) - least(10, len(w)) + 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM win),
grams AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM d, sizes, unnest(range(1, greatest(0, len(w) - size + 1) + 1)) AS t(i)),
occ AS (SELECT doc_id, i, g.size, item FROM grams g JOIN win USING (phrase, size)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
  SELECT DISTINCT doc_id, i, size FROM occ), unnest(range(i, i + size)) AS t(p) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (
  SELECT DISTINCT doc_id, item FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""
