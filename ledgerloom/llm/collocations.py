"""Phrase collocations by prefix-free parsing.

Texts are lower-cased (A-Z only), split at punctuation and line ends into pieces, and those into
words. Phrases of 2 to 5 words that occur at least `least` times in a language (overlapping
occurrences count, within pieces) are scored by their weakest cut: floor(1000 * a * n / (l * r))
for a occurrences of the phrase, l and r of the two parts, n words of the language.

1. Each piece is parsed: where the hash of four successive words is a multiple of `TRIGGER`, a
   chunk ends with these words and the next one begins with them. Cuts depend on the words only,
   so passages that documents share give the same chunks. Their overlap is one word less than
   the longest phrase; each phrase counts in the chunk it starts in before the overlap, so every
   occurrence counts once. A stretch of `LONGEST` words without a trigger is cut as well, so
   that a chunk has a bounded size; any cut gives the same counts.
2. The distinct chunks with their frequencies in the parse are the dictionary. Everything after
   reads the dictionary only, and weights what it counts by these frequencies.
3. Phrases are counted by number of words. A phrase can be frequent only if it is so without its
   last and without its first word; phrases that are not are left out by a bit filter over the
   frequent shorter ones. The filter's size grows with them up to `FILTER_BITS`; it only spares
   rows, as every count is compared with `least` afterwards. Spark groups the counts by the phrase itself;
   inside a batch phrases are told apart by 64-bit hashes.
4. A phrase is dropped if it lies in a longer candidate that occurs as often. It is enough to look
   at candidates of one word more: all between the two occur equally often.

A null text is empty; a null language is `und`. Repeated rows count each time; no id is needed. An
empty table, or one without frequent phrases, gives no rows. Very long texts are parsed in slices of rows,
one text at a time. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import lean, mix64, scan_words, slices, staged, table, text_buffer, word_table

WIDEST = 5
OVERLAP = WIDEST - 1
TRIGGER = 32
LONGEST = 1024
FILTER_BITS = 1 << 27
LEAST, BEST = 100, 2000
PIECE_ENDS, SPACES = b".,;:!?\x0a\x0b\x0c\x0d", b" \t"
STEP = np.uint64(0xD6E8FEB86659FD93)


def _pick(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """The strings at data[begin:end], which may overlap."""
    offsets = np.concatenate(([0], np.cumsum(end - begin)))
    at = np.arange(offsets[-1]) + np.repeat(begin - offsets[:-1], end - begin)
    picked = pa.Array.from_buffers(pa.large_string(), len(begin), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[at])])
    return picked.cast(pa.string())


def _chain(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each `width` successive words."""
    out = hashes[:max(0, len(hashes) - width + 1)]
    for i in range(1, width):
        out = mix64(out * STEP + hashes[i:i + len(out)])
    return out


def _chunks_of(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(chunks with single spaces, phrases that start in each, its row) of some texts."""
    values = word_table(PIECE_ENDS + SPACES)
    starts, hashes, counts = scan_words(data, offsets, values)
    n = len(starts)
    if not n:
        return pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, np.int64)
    used = np.append((values != 0)[data], False)
    last = used[:-1] & ~used[1:]
    inner = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    last[inner - 1] = used[inner - 1]
    ends = np.flatnonzero(last) + 1
    row = np.repeat(np.arange(len(counts)), counts)
    ending = np.zeros(256, bool)
    ending[list(PIECE_ENDS)] = True
    gap = np.searchsorted(np.flatnonzero(ending[data]), starts)
    first = np.ones(n, bool)
    first[1:] = (gap[1:] != gap[:-1]) | (row[1:] != row[:-1])
    pieces = np.flatnonzero(first)
    piece_end = np.append(pieces[1:], n)
    cut = first.copy()
    windows = _chain(hashes, OVERLAP)
    cut[:len(windows)] |= (windows % np.uint64(TRIGGER) == 0) & (
        np.repeat(piece_end, piece_end - pieces)[:len(windows)] >= np.arange(len(windows)) + OVERLAP)
    begin = np.flatnonzero(cut)
    sizes = np.diff(np.append(begin, n))
    if sizes.max() > LONGEST:
        parts = -(-sizes // LONGEST)
        begin = np.repeat(begin, parts) + LONGEST * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
        sizes = np.diff(np.append(begin, n))
    end = np.minimum(begin + sizes + OVERLAP, piece_end[np.searchsorted(pieces, begin, "right") - 1])
    # the words with a single space after each
    places = np.concatenate(([0], np.cumsum(ends - starts + 1)))
    at = np.arange(places[-1]) + np.repeat(starts - places[:-1], ends - starts + 1)
    words = np.append(data, np.uint8(32))[at]
    upper = (words >= 0x41) & (words <= 0x5A)
    words[upper] += 32
    words[places[1:] - 1] = 32
    return _pick(words, places[begin], places[end] - 1), sizes, row[begin]


@lean
def _parse(batches):
    for batch in batches:
        data, offsets = text_buffer(batch.column("text"))
        for low, high in slices(offsets):
            chunks, sizes, row = _chunks_of(data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low])
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").take(pa.array(row + low)), pa.array(sizes.astype(np.int32)), chunks], ["lang", "starts", "chunk"])


def dictionary(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, starts, chunk, times): the distinct chunks of the parse, the phrases that start in each, and how often it occurs."""
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                        F.col(f"`{text_col}`").cast("string").alias("text")).where("text IS NOT NULL")
    chunks = texts.mapInArrow(_parse, "lang string, starts int, chunk string")
    return chunks.groupBy("lang", "starts", "chunk").agg(F.count("*").alias("times"))


def _counter(width: int, filled: Broadcast | None):
    """Counts of the phrases of `width` words in batches of the dictionary."""
    def known(hashes: np.ndarray) -> np.ndarray:
        bits = filled.value
        cells = hashes & np.uint64(64 * len(bits) - 1)
        return (bits[(cells >> np.uint64(6)).astype(np.int64)] >> (cells & np.uint64(63))) & np.uint64(1) != 0

    @lean
    def run(batches):
        values = word_table(b" ")
        for batch in batches:
            data, offsets = text_buffer(batch.column("chunk"))
            own, times = batch.column("starts").to_numpy(), batch.column("times").to_numpy()
            tags = np.array([xxhash.xxh64_intdigest(x) for x in batch.column("lang").to_pylist()], np.uint64)
            starts, hashes, counts = scan_words(data, offsets, values)
            if len(starts) < width:
                continue
            row = np.repeat(np.arange(len(counts)), counts)
            ends = np.append(starts[1:], 0) - 1
            ends[np.cumsum(counts)[counts > 0] - 1] = offsets[1:][counts > 0]
            hashes = mix64(hashes + tags[row])
            m = len(starts) - width + 1
            wanted = (row[:m] == row[width - 1:]) & (np.arange(m) - (np.cumsum(counts) - counts)[row[:m]] < own[row[:m]])
            if filled is not None:
                shorter = known(_chain(hashes, width - 1))
                wanted &= shorter[:-1] & shorter[1:]
            at = np.flatnonzero(wanted)
            if not len(at):
                continue
            keys = _chain(hashes, width)[at]
            order = np.argsort(keys)
            keys, at = keys[order], at[order]
            head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            total = np.add.reduceat(times[row[at]], head)
            at = at[head]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").take(pa.array(row[at])), _pick(data, starts[at], ends[at + width - 1]),
                 pa.array(keys[head].view(np.int64)), pa.array(total)], ["lang", "phrase", "h", "f"])

    return run


def _filter(found: DataFrame, count: int) -> Broadcast:
    """The hashes of frequent phrases as a bit filter, of sixteen bits a phrase as far as `FILTER_BITS` goes."""
    size = min(FILTER_BITS, 1 << max(16, (16 * count).bit_length()))
    cell = F.col("h").bitwiseAND(F.lit(size - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), cell.bitwiseAND(F.lit(63)).cast("int"))
    words = found.select(F.shiftright(cell, 6).alias("w"), bit.alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    bits = np.zeros(size // 64, np.uint64)
    bits[words.column("w").to_numpy()] = words.column("b").to_numpy().view(np.uint64)
    return found.sparkSession.sparkContext.broadcast(bits)


def frequent(chunks: DataFrame, least: int = LEAST) -> list[DataFrame]:
    """(lang, phrase, f, h) of the phrases that occur at least `least` times, of 1, 2, ... words."""
    out, filled = [], None
    for width in range(1, WIDEST + 1):
        counted = chunks.mapInArrow(_counter(width, filled), "lang string, phrase string, h long, f long")
        counted = counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f"), F.min("h").alias("h")).where(F.col("f") >= least)
        out.append(staged(counted, f"phrases{width}"))
        if filled is not None:
            filled.destroy()
        count = out[-1].count()
        if not count:
            break
        filled = _filter(out[-1], count)
    return out


def _scored(phrases: list[DataFrame], sizes: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the candidates, by their lowest-scoring cut."""
    every = phrases[0].select("lang", "phrase", "f")
    candidates = None
    for width, found in enumerate(phrases[1:], 2):
        own = found.select("lang", "phrase", F.col("f").alias("a"), F.lit(width).alias("width"))
        every = every.unionByName(found.select("lang", "phrase", "f"))
        candidates = own if candidates is None else candidates.unionByName(own)
    longer = candidates.where("width > 2").select("lang", F.explode(F.array(
        F.expr("substring_index(phrase, ' ', width - 1)"), F.expr("substring_index(phrase, ' ', 1 - width)"))).alias("phrase"), "a")
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("within"))
    kept = candidates.join(longer, ["lang", "phrase"], "left").where("within IS NULL OR within < a")
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("width") - 1))).select(
        "lang", "phrase", "a", "k", F.expr("substring_index(phrase, ' ', k)").alias("first"),
        F.expr("substring_index(phrase, ' ', k - width)").alias("rest"))
    cuts = cuts.join(every.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(every.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    wide = {c: F.col(c).cast("decimal(19,0)") for c in "alrn"}
    exact = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * wide["a"] * wide["n"], wide["l"] * wide["r"])
    cuts = cuts.join(sizes, "lang").withColumn("score", exact.cast("long"))
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, best: int = BEST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `best` phrases by score, then count, then text."""
    chunks = staged(dictionary(docs, text_col, lang_col), "dictionary")
    sizes = chunks.groupBy("lang").agg(F.sum(F.col("starts") * F.col("times")).alias("n"))
    phrases = frequent(chunks, least)
    if len(phrases) < 2:
        phrases = [phrases[0], phrases[0].limit(0)]
    scored = _scored(phrases, staged(sizes, "sizes"))
    rank = F.expr("row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)").cast("long")
    return scored.withColumn("rank", rank).where(F.col("rank") <= best).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The 2,000 strongest phrases of each language."""
    return collocations(table(spark, folder, "documents"))


OP11_SQL = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS id,
    regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents WHERE text IS NOT NULL),
p AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT lang, unnest(pieces) AS piece FROM t)),
s AS (SELECT lang, sum(len(w)) AS n FROM p GROUP BY lang),
g AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM p, unnest(range(1, 6)) AS x(k), unnest(range(1, len(w) - k + 2)) AS y(i)
  GROUP BY lang, k, phrase HAVING count(*) >= 100),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM g WHERE k > 1),
d AS (SELECT DISTINCT x.lang, x.phrase FROM c x JOIN c y ON x.lang = y.lang AND y.k > x.k AND 100 * y.a >= 100 * x.a
  AND contains(' ' || y.phrase || ' ', ' ' || x.phrase || ' ')),
q AS (
  SELECT c.lang, c.phrase, c.a, j, l.f AS l, r.f AS r, s.n,
    (1000::HUGEINT * c.a * s.n) // (l.f::HUGEINT * r.f) AS score
  FROM c ANTI JOIN d ON c.lang = d.lang AND c.phrase = d.phrase JOIN s ON c.lang = s.lang, unnest(range(1, c.k)) AS z(j)
  JOIN g l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[:j], ' ')
  JOIN g r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[j + 1:], ' ')),
b AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a,
  l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM b QUALIFY rank <= 2000
"""
