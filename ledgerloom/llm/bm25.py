"""Exact top-k search by BM25 over an inverted index in shards, with block-max WAND.

A shard is a file in the shared folder that holds the postings of some megabytes of whole
documents: per term its documents and counts. Document frequencies, the number of documents and
their mean length are taken over all shards, so every shard scores alike and the merged result
is exact. A query is a whole text; all its distinct terms count, weighed by their inverse
document frequency over all documents.

Queries are written in batches of up to `QUERIES` to the shared folder, those with common terms side by
side; a task takes one batch through `SHARDS` shards, small ones put together, and keeps the k best of
each query on the way, so later shards start from the limits of earlier ones. What a term adds to a
document's score does not depend on the query and is computed once per shard and batch. Each term's list
is cut into blocks at every `BLOCK` documents, the same places for all terms, with the most a document of
the block can get from the term. For a query,

- a shard is skipped if the largest parts of its terms together stay below the k-th best score;
- else the block maxima of its terms are summed block by block, and only documents in blocks
  whose sum reaches the k-th best score are scored. Without a k-th best score the most promising
  blocks are scored first to get one.

Blocks are aligned so that the pivots of all blocks of a list are found at once instead of moving
cursors one by one; what is skipped is what cannot reach the limit, as in the sequential form.

Queries of more than `FEW` terms in a shard go through it up to `TOGETHER` at a time, as their lists are mostly the
same ones. Terms that many of them share and many documents have are left to a matrix product; the other lists are
summed query by query. A block's bound is the product of the block maxima and the most of the query's other lists;
only blocks in which one of the queries can reach its limit enter the product. Without a k-th best score, the k-th
largest of the blocks' best sums stands for it. The product is taken in single precision: it chooses documents with a
margin above its error, and their scores are summed from whole numbers.

A score is the sum of the terms' parts, each rounded to a millionth, so sums do not depend on
their order. Ties are ranked by id, null ids last.

Null and empty texts are documents of length 0: they are never found and find nothing. Repeated
rows are documents of their own and count in all statistics; queries of one id are one query with the
terms of all of them, and rows without an id are no queries. Very long texts have many terms, all of
which count. Columns other than id and text are ignored, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import lean, load, save, scan_words, shared_dir, slices, staged, table, text_buffer, word_table

K1, B = 1.2, 0.75
TOP = 10
QUERY_STEP = 100
SHARD_BYTES = 32 << 20
BLOCK = 64
QUERIES, SHARDS = 8000, 8  # of a task at most
DOCS = 20_000  # of shards that are put together
FIRST_BLOCKS = 4
FEW, TOGETHER = 8, 512
CELLS = 1 << 24  # of a matrix at most
DENSE, HEAVY = 0.004, 4096  # share of pairs of a query and a document that have a term of the product; such terms at most
POSTING = np.dtype([("part", "<i4"), ("doc", "<i4")])
UNIT = 1_000_000
LAST = (1 << 63) - 1

SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
VALUES = word_table(SEPARATORS)


def _pack(arrays: dict[str, np.ndarray]) -> bytes:
    import io

    import zstandard

    out = io.BytesIO()
    np.savez(out, **arrays)
    return zstandard.compress(out.getvalue(), 1)


def _unpack(data: bytes) -> dict[str, np.ndarray]:
    import io

    import zstandard

    with np.load(io.BytesIO(zstandard.decompress(data))) as held:
        return {k: held[k] for k in held.files}


def _stable_order(hashes: np.ndarray) -> np.ndarray:
    """Upper bits and places are sorted as one number, which is faster; hashes that differ in lower bits only are rare."""
    bits = np.uint64(len(hashes).bit_length())
    order = hashes >> bits
    order <<= bits
    order |= np.arange(len(hashes), dtype=np.uint64)
    order.sort()
    order &= (np.uint64(1) << bits) - np.uint64(1)
    order = order.view(np.int64)
    found = hashes[order]
    return order if (found[1:] >= found[:-1]).all() else np.argsort(hashes, kind="stable")


def build_shard(ids: np.ndarray, hashes: np.ndarray, lengths: np.ndarray) -> dict[str, np.ndarray]:
    """Postings by term, then document."""
    row = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    order = _stable_order(hashes)
    term, doc = hashes[order], row[order]
    first = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])]) if len(term) else np.zeros(0, np.int64)
    count = np.diff(np.r_[first, len(term)]).astype(np.int32)
    term, doc = term[first], doc[first]
    begin = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.zeros(0, np.int64)
    frequency = np.diff(np.r_[begin, len(term)]).astype(np.int32)
    return {"ids": ids, "lengths": lengths.astype(np.int32), "terms": term[begin], "frequency": frequency, "docs": doc, "counts": count}


def build_index(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
                shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write the shards; one manifest row each: path, docs, words, and its terms with their frequencies."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, words, lengths, size = [], [], [], 0

        def flush():
            hashes = np.concatenate(words)
            words.clear()
            shard = build_shard(np.concatenate(ids), hashes, np.concatenate(lengths))
            path = save(folder, f"shard-{uuid.uuid4().hex}.bin", _pack(shard))
            return pa.RecordBatch.from_pydict({
                "path": [path], "docs": [len(shard["ids"])], "words": [int(shard["lengths"].sum())],
                "terms": pa.array([shard["terms"].view(np.int64)], pa.list_(pa.int64())),
                "frequency": pa.array([shard["frequency"]], pa.list_(pa.int32()))})

        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            keys = batch.column(0).fill_null(LAST).to_numpy()
            for a, b in slices(offsets):
                _, hashes, n = scan_words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], VALUES)
                ids.append(keys[a:b])
                words.append(hashes)
                lengths.append(n)
                size += int(offsets[b] - offsets[a])
                if size >= shard_bytes:
                    yield flush()
                    ids, words, lengths, size = [], [], [], 0
        if ids:
            yield flush()

    return staged(_source(docs, id_col, text_col).mapInArrow(
        lean(build), "path string, docs long, words long, terms array<long>, frequency array<int>"), "shards")


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))


def query_words(queries: DataFrame) -> DataFrame:
    """(query, term): the distinct words of (id, text) rows."""

    def run(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            _, hashes, counts = scan_words(data, offsets, VALUES)
            ends = np.cumsum(counts)
            for key, n, end in zip(batch.column(0).to_pylist(), counts.tolist(), ends.tolist()):
                own = np.unique(hashes[end - n:end])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), key, np.int64)), pa.array(own.view(np.int64))], names=["query", "term"])

    return queries.mapInArrow(lean(run), "query long, term long").distinct()


def inverse_frequency(docs: Column | float, frequency: Column) -> Column:
    return F.log(1 + (F.lit(docs) - frequency + 0.5) / (frequency + 0.5))


def norm(length, mean: float):
    return K1 * (1 - B + B * length / mean)


def part(weight, count, norms):
    """A term's part of a score, in millionths."""
    return np.floor(UNIT * (weight * (count * (K1 + 1) / (count + norms))) + 0.5)


def _ranges(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers of the ranges begin to end, one range after the other."""
    sizes = end - begin
    return np.arange(sizes.sum()) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    change = np.ones(len(columns[0]), bool)
    change[1:] = False
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(change)


class Lists:
    """The lists of some terms in a shard, or in some as if they were one: parts by document, and the most of each
    block and of each list.

    A posting is one number of 64 bits, the document above the part, so that lists are put together in one go.
    """

    def __init__(self, shards: dict[str, np.ndarray] | list[dict[str, np.ndarray]], terms: np.ndarray, weights: np.ndarray, mean: float):
        shards = [shards] if isinstance(shards, dict) else shards
        sizes = np.zeros((len(shards), len(terms)), np.int64)
        begins = np.zeros_like(sizes)
        for shard, size, begin in zip(shards, sizes, begins):
            held = shard["terms"]
            if len(held):
                at = np.minimum(np.searchsorted(held, terms), len(held) - 1)
                own = held[at] == terms
                size[own] = shard["frequency"][at[own]]
                begin[:] = np.r_[0, np.cumsum(shard["frequency"].astype(np.int64))][at]
        total = sizes.sum(0)
        self.known = total > 0  # by position in `terms`
        self.number = np.cumsum(self.known) - 1
        self.sizes = total[self.known]
        self.at = np.r_[0, np.cumsum(self.sizes)]  # of each list, its first posting
        self.ids = np.concatenate([s["ids"] for s in shards])
        self.packed = np.empty(self.at[-1], "<i8")
        to, offset = np.cumsum(total) - total, 0
        for shard, size, begin in zip(shards, sizes, begins):
            own = _ranges(begin, begin + size)
            docs = shard["docs"][own]
            parts = part(np.repeat(weights, size), shard["counts"][own].astype(np.float64), norm(shard["lengths"].astype(np.float64), mean)[docs])
            postings = np.empty(len(own), POSTING)
            postings["part"], postings["doc"] = parts, docs + offset
            if len(shards) == 1:
                self.packed = postings.view("<i8")
            else:
                self.packed[_ranges(to, to + size)] = postings.view("<i8")
            to, offset = to + size, offset + len(shard["ids"])
        self.docs, self.parts = self.packed.view(POSTING)["doc"], self.packed.view(POSTING)["part"]
        block = self.docs // BLOCK
        change = np.ones(len(block), bool)
        change[1:] = block[1:] != block[:-1]
        change[self.at[:-1]] = True
        begin = np.flatnonzero(change)
        self.blocks = int(block.max()) + 1 if len(block) else 0
        self.block = block[begin]
        self.posting = np.r_[begin, len(block)]  # of each block, its first posting
        self.block_most = np.maximum.reduceat(self.parts, begin) if len(begin) else np.zeros(0)
        self.first = np.searchsorted(begin, self.at)  # of each list, its first block
        self.most = np.maximum.reduceat(self.block_most, self.first[:-1]) if len(begin) else np.zeros(0)


def search(lists: Lists, own: np.ndarray, best: list[tuple[int, int]], k: int) -> list[tuple[int, int]]:
    """The k best (-score, id) of `best` and the shard for a query whose terms are `own` of the lists; exact to the tie."""
    limit = -best[-1][0] if len(best) == k else 1
    if not len(own) or lists.most[own].sum() < limit:
        return best
    held = _ranges(lists.first[own], lists.first[own + 1])
    block = lists.block[held]
    bounds = np.bincount(block, weights=lists.block_most[held], minlength=lists.blocks)

    def scored(wanted: np.ndarray) -> list[tuple[int, int]]:
        blocks = held[wanted[block]]
        postings = _ranges(lists.posting[blocks], lists.posting[blocks + 1])
        scores = np.bincount(lists.docs[postings], weights=lists.parts[postings])
        found = np.flatnonzero(scores >= limit)
        if len(found) > 4 * k:  # no more than the k best can stay, ties included
            found = found[scores[found] >= np.partition(scores[found], len(found) - k)[len(found) - k]]
        return sorted(best + [(-int(scores[d]), int(lists.ids[d])) for d in found])[:k]

    if len(best) < k and lists.blocks > FIRST_BLOCKS:
        promising = np.zeros(lists.blocks, bool)
        promising[np.argpartition(-bounds, FIRST_BLOCKS)[:FIRST_BLOCKS]] = True
        best = scored(promising)
        limit = -best[-1][0] if len(best) == k else 1
        bounds[promising] = 0
    wanted = bounds >= limit
    return scored(wanted) if wanted.any() else best


def _limit(best: list[tuple[int, int]], k: int) -> int:
    return -best[-1][0] if len(best) == k else 1


def search_all(lists: Lists, own: list[np.ndarray], best: list[list[tuple[int, int]]], k: int) -> list[list[tuple[int, int]]]:
    """What `search` gives for each of the queries, those of many terms together."""
    out, left = list(best), []
    for q, terms in enumerate(own):
        if len(terms) <= FEW:
            out[q] = search(lists, terms, best[q], k)
        elif lists.most[terms].sum() >= _limit(best[q], k):
            left.append(q)
    step = max(1, min(TOGETHER, CELLS // max(1, 2 * len(lists.ids))))
    for i in range(0, len(left), step):
        some = left[i:i + step]
        for q, found in zip(some, _search_together(lists, [own[q] for q in some], [best[q] for q in some], k)):
            out[q] = found
    return out


def _search_together(lists: Lists, own: list[np.ndarray], best: list[list[tuple[int, int]]], k: int) -> list[list[tuple[int, int]]]:
    n, wide = len(own), -(-len(lists.ids) // BLOCK)
    width = wide * BLOCK
    term, row = np.concatenate(own), np.repeat(np.arange(n), [len(t) for t in own])
    pairs = np.bincount(term, minlength=len(lists.sizes)) * lists.sizes
    heavy = np.flatnonzero(pairs > DENSE * n * len(lists.ids))
    most = max(1, min(HEAVY, CELLS // width))
    if len(heavy) > most:
        heavy = heavy[np.argpartition(-pairs[heavy], most)[:most]]
    column = np.full(len(lists.sizes), -1)
    column[heavy] = np.arange(len(heavy))
    column = column[term]
    light = column < 0
    asks = np.zeros((n, len(heavy)), np.float32)
    asks[row[~light], column[~light]] = 1
    held = np.zeros((len(heavy), width), np.float32)
    large = len(heavy) and lists.most[heavy].max() >= 1 << 24  # beyond the whole numbers of single precision
    rest = np.zeros((len(heavy), width), np.int8) if large else None
    tops = np.zeros((len(heavy), wide), np.float32)
    for i, t in enumerate(heavy.tolist()):
        a, b = lists.at[t], lists.at[t + 1]
        docs, parts = lists.docs[a:b], lists.parts[a:b]
        held[i, docs] = parts
        if large:
            rest[i, docs] = parts - parts.astype(np.float32).astype(np.int64)
        a, b = lists.first[t], lists.first[t + 1]
        tops[i, lists.block[a:b]] = lists.block_most[a:b]
    slack = 1 - (len(heavy) + 8) * 2.0**-23  # a sum in single precision is off by half of this share at most
    limits = np.array([_limit(b, k) for b in best], np.float64)
    bounds = asks @ tops + np.bincount(row[light], weights=lists.most[term[light]], minlength=n)[:, None]
    wanted = (bounds >= (limits * slack)[:, None]).any(0)
    docs = np.flatnonzero(np.repeat(wanted, BLOCK))
    if len(docs) < width:
        held, rest = held[:, docs], rest[:, docs] if large else None
    rough = asks @ held

    out = list(best)
    for i, total in enumerate(_light_sums(lists, term[light], row[light], n, width)):
        if len(docs) < width:
            total = total[docs]
        total = total + rough[i]
        limit = limits[i]
        if len(best[i]) < k <= len(total) // BLOCK:  # as many documents are as good as the k-th of the blocks' best
            limit = max(limit, np.partition(total.reshape(-1, BLOCK).max(1), -k)[-k] * slack)
        found = np.flatnonzero(total >= limit * slack)
        if len(found) > 4 * k:  # no more than the k best can stay, ties included
            found = found[total[found] >= np.partition(total[found], len(found) - k)[len(found) - k] * slack * slack]
        if len(found):
            at = np.ix_(np.flatnonzero(asks[i]), found)
            exact = held[at].sum(0, dtype=np.float64) + (rest[at].sum(0, dtype=np.int64) if large else 0)
            scores = (total[found] - rough[i, found] + exact).astype(np.int64)
            ids = lists.ids[docs[found]]
            first = np.lexsort((ids, -scores))[:k]
            out[i] = sorted(best[i] + list(zip((-scores[first]).tolist(), ids[first].tolist())))[:k]
    return out


def _light_sums(lists: Lists, term: np.ndarray, row: np.ndarray, n: int, width: int) -> Iterator[np.ndarray]:
    """Of each of n queries the sums by document of its lists: `term` of query `row`, in ascending order of rows."""
    sizes = lists.sizes[term]
    most = int(np.bincount(row, weights=sizes, minlength=n).max())
    places, docs = np.empty((2, most), np.intp)  # all used again, as memory is dear to get
    postings, parts, numbers = np.empty(most, "<i8"), np.empty(most), np.arange(most)
    begin, a = lists.at[term], 0
    for b in np.cumsum(np.bincount(row, minlength=n)).tolist():
        own = sizes[a:b]
        after = np.cumsum(own)
        m = int(after[-1]) if b > a else 0
        np.add(np.repeat(begin[a:b] - after + own, own), numbers[:m], out=places[:m])
        np.take(lists.packed, places[:m], out=postings[:m], mode="clip")  # with other modes a copy is made first
        pairs = postings[:m].view(POSTING)
        docs[:m], parts[:m] = pairs["doc"], pairs["part"]
        yield np.bincount(docs[:m], weights=parts[:m], minlength=width)
        a = b


def likeness(sizes: np.ndarray, terms: np.ndarray, kinds: int = 16, top: int = 256, rounds: int = 8) -> np.ndarray:
    """An order in which queries with common terms are near each other. `terms` are numbers from 0, query by query.

    Queries are put to the nearest of some centres by their commonest terms, the rarer of these weighing more. It
    only decides which queries share a matrix product.
    """
    n, row = len(sizes), np.repeat(np.arange(len(sizes)), sizes)
    asked = np.bincount(terms)
    common = np.argsort(-asked, kind="stable")[:top]
    column = np.full(len(asked), -1)
    column[common] = np.arange(len(common))
    column = column[terms]
    rows = np.zeros((n, len(common)), np.float32)
    rows[row[column >= 0], column[column >= 0]] = np.log((n + 1) / asked[common])[column[column >= 0]]
    rows /= np.maximum(1e-9, np.linalg.norm(rows, axis=1))[:, None]
    centres = rows[np.linspace(0, n - 1, kinds).astype(int)]
    for _ in range(rounds):
        kind = (rows @ centres.T).argmax(1)
        centres = np.array([rows[kind == j].sum(0) if (kind == j).any() else centres[j] for j in range(kinds)])
        centres /= np.maximum(1e-9, np.linalg.norm(centres, axis=1))[:, None]
    return np.lexsort((sizes, (rows @ centres.T).argmax(1)))


def _write_batches(asked: DataFrame, folder: str, batches: int) -> DataFrame:
    """(batch, path) of written query batches: ids, their numbers of terms, and the terms with weights."""

    def run(rows):
        kept: dict[int, list] = {}
        for batch in rows:
            lists = {c: batch.column(c) for c in ("terms", "weights")}
            ends = lists["terms"].offsets.to_numpy()
            terms, weights = (lists[c].values.to_numpy() for c in ("terms", "weights"))
            for number, query, a, b in zip(batch.column("batch").to_pylist(), batch.column("query").to_pylist(), ends.tolist(), ends[1:].tolist()):
                kept.setdefault(number, []).append((query, terms[a:b].copy(), weights[a:b].copy()))
        for number in list(kept):
            queries, terms, weights = zip(*kept.pop(number))
            sizes = np.array([len(t) for t in terms], np.int64)
            each, back = np.unique(np.concatenate(terms).view(np.uint64), return_inverse=True)
            order = likeness(sizes, back)
            weight = np.zeros(len(each))
            weight[back] = np.concatenate(weights)
            begin = np.cumsum(sizes) - sizes
            packed = _pack({"queries": np.array(queries, np.int64)[order], "sizes": sizes[order], "terms": each, "weights": weight,
                            "own": back[_ranges(begin[order], (begin + sizes)[order])].astype(np.int32)})
            yield pa.RecordBatch.from_pydict({"batch": pa.array([number], pa.int32()), "path": [save(folder, f"queries-{uuid.uuid4().hex}.bin", packed)]})

    lists = asked.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("t"))
    lists = lists.select(F.pmod(F.xxhash64("query"), F.lit(batches)).cast("int").alias("batch"), "query",
                         F.col("t.term").alias("terms"), F.col("t.weight").alias("weights"))
    return staged(lists.repartition(batches, "batch").mapInArrow(lean(run), "batch int, path string"), "batches")


def _opened(paths: list[str], terms: np.ndarray, weights: np.ndarray, mean: float) -> Iterator[Lists]:
    """The lists of the shards, those of small ones put together."""
    held, docs = [], 0
    for path in paths:
        shard = _unpack(load(path))
        if held and docs + len(shard["ids"]) > DOCS:
            lists = Lists(held, terms, weights, mean)
            held, docs = [], 0
            yield lists
            del lists
        held.append(shard)
        docs += len(shard["ids"])
    if held:
        lists = Lists(held, terms, weights, mean)
        del held, shard
        yield lists


def top_k(docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = TOP) -> DataFrame:
    """(query, rank, id, score) of the k best documents of every query; queries are (id, text) rows."""
    folder = shared_dir(docs.sparkSession, "index")
    shards = build_index(docs, folder, id_col, text_col)
    whole = shards.agg(F.sum("docs").alias("n"), F.sum("words").alias("w"), F.count("*").alias("shards")).first()
    n, mean = float(whole.n or 0), float(whole.w or 0) / max(1, whole.n or 0) or 1.0
    words = staged(query_words(_source(queries, id_col, text_col).where("id IS NOT NULL")), "words")
    held = shards.select(F.explode(F.arrays_zip("terms", "frequency")).alias("t")).select(F.col("t.terms").alias("term"), F.col("t.frequency").alias("f"))
    frequency = held.groupBy("term").agg(F.sum("f").alias("df"))
    weighed = words.join(frequency, "term").select("query", "term", inverse_frequency(n, F.col("df")).alias("weight"))
    asked = words.select("query").distinct().count()
    groups = max(1, -(-whole.shards // SHARDS))
    tasks = 2 * docs.sparkSession.sparkContext.defaultParallelism
    batches = max(1, -(-asked // QUERIES), min(-(-tasks // groups), -(-asked // TOGETHER)))
    written = _write_batches(weighed, folder, batches)
    line = Window.orderBy("path")  # one row per shard
    grouped = shards.select("path", F.floor((F.row_number().over(line) - 1) / SHARDS).cast("int").alias("grp"))
    grouped = grouped.groupBy("grp").agg(F.sort_array(F.collect_list("path")).alias("shards"))  # SHARDS paths
    visits = written.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).join(grouped, "grp")
    visits = visits.select((F.col("batch").cast("long") * groups + F.col("grp")).alias("visit"), "path", "shards")

    def run(rows):
        for batch in rows:
            for path, shard_paths in zip(batch.column("path").to_pylist(), batch.column("shards").to_pylist()):
                asked = _unpack(load(path))
                terms, weights = asked["terms"], asked["weights"]
                own = np.split(asked["own"], np.cumsum(asked["sizes"])[:-1])
                best: list[list[tuple[int, int]]] = [[] for _ in own]
                for lists in _opened(shard_paths, terms, weights, mean):
                    best = search_all(lists, [lists.number[o[lists.known[o]]] for o in own], best, k)
                out = [(q, None if key == LAST else key, -s) for q, found in zip(asked["queries"].tolist(), best) for s, key in found]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["query", "id", "score"])

    found = visits.repartitionByRange(batches * groups, "visit").mapInArrow(lean(run), "query long, id long, score long")
    rank = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("query", "rank", "id", "score")


def op3_topk_search(spark, folder: str) -> DataFrame:
    """Every document whose id is divisible by 100, by all terms of its text, against all documents."""
    docs = table(spark, folder, "documents")
    found = top_k(docs, docs.where(F.col("doc_id") % QUERY_STEP == 0))
    return found.select("query", "rank", F.col("id").alias("doc_id"), (F.col("score") / UNIT).alias("score"))


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
s AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(len(w)) AS mean FROM d),
p AS (
  SELECT doc_id, len(w) AS len, w[i] AS term, count(*) AS tf
  FROM d, unnest(range(1, len(w) + 1)) AS t(i) GROUP BY ALL),
f AS (SELECT term, ln(1 + (n - df + 0.5) / (df + 0.5)) AS idf FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s),
q AS (SELECT doc_id AS query, term, idf FROM p JOIN f USING (term) WHERE doc_id % 100 = 0),
r AS (
  SELECT query, doc_id, CAST(sum(floor(1000000 * (idf * (tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len / mean)))) + 0.5)) AS BIGINT) AS score
  FROM q JOIN p USING (term), s GROUP BY query, doc_id)
SELECT query, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id,
  score / 1000000.0::DOUBLE AS score
FROM r QUALIFY rank <= 10
"""
