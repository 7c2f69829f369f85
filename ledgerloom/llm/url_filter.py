"""URL verdicts: host and path rules first, then a ratio of character language models.

URLs that a rule decides teach two character models, one of accepted and one of rejected URLs:
Markov models of variable order, each order smoothed by the next shorter one. The score of a URL
is the difference of its log likelihoods per character. The threshold is calibrated on a fold of
the decided URLs that the models have not seen: the score that splits them with the best mean
of both classes' recall.

Counts are kept in a table keyed by the real characters of a context and the next one, packed
into a long, so the models grow with the input and no two contexts share a count. The orders are
rolled up from the longest one and joined from the shortest to the longest; no key of these joins
has more rows than there are characters. The characters of the URLs are joined to the result,
except those of the `COMMON` most frequent contexts at most, which every task holds.

A character's part of a score is rounded to a billionth, so sums do not depend on their order.

A null URL, or one without `://`, has an empty host and path and no rule; a URL without
characters scores 0. Rows are judged one by one, so repeated rows agree. If the rules decide no
URL of one of the classes, the other class's verdict is given; if none at all, all are allowed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import lean, slices, staged, table, text_buffer

ORDER = 5
SYMBOL_BITS = 9
COMMON = 4096
UNIT = 1_000_000_000
STRENGTH = 4.0
BINS = 4000
WIDEST = 10.0
FOLDS = 5
#: (verdict, host, path)
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, else nulls; of equally long ones the first."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, site, start in sorted(rules, key=lambda r: len(r[1] + r[2]), reverse=True)[::-1]:
        fits = ((host == site) | host.endswith("." + site)) & path.startswith(start)
        name, verdict = F.when(fits, site + start).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def _grams(column: pa.Array):
    """Per slice of URLs: its first row, each character with the `ORDER` before it in a long, and row lengths.

    The character takes the lowest bits, the one before it the next ones; 0 is before the start.
    """
    data, offsets = text_buffer(column)
    for a, b in slices(offsets):
        size = np.diff(offsets[a:b + 1])
        own = data[offsets[a]:offsets[b]]
        # place of each character in its URL; the end is a character too
        rows = np.repeat(np.arange(b - a), size + 1)
        begin = np.cumsum(size + 1) - (size + 1)
        place = np.arange(len(rows)) - begin[rows]
        text = np.full(len(rows), 256, np.int64)
        text[place < size[rows]] = own
        grams = text.copy()
        for k in range(1, ORDER + 1):
            back = np.zeros(len(rows), np.int64)
            back[k:] = text[:-k] + 1
            back[place < k] = 0
            grams |= back << (SYMBOL_BITS * k)
        yield a, grams, size


def count_grams(urls: DataFrame) -> DataFrame:
    """(gram, n, n0, n1) from (url, class) rows: all occurrences, and those in class 0 (rejected) and 1 (accepted)."""

    def count(batches):
        for batch in batches:
            kinds = batch.column(1).fill_null(-1).to_numpy()
            for first, grams, size in _grams(batch.column(0)):
                own, at = np.unique(grams, return_inverse=True)
                kind = np.repeat(kinds[first:first + len(size)], size + 1)
                counts = [np.bincount(at, kind == c if c is not None else None, len(own)).astype(np.int64) for c in (None, 0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (own, *counts)], names=["gram", "n", "n0", "n1"])

    counts = urls.mapInArrow(lean(count), "gram long, n long, n0 long, n1 long")
    return counts.groupBy("gram").agg(*(F.sum(c).alias(c) for c in ("n", "n0", "n1")))


def _last(gram: str, k: int) -> Column:
    """A gram without the characters beyond its order k."""
    return F.col(gram).bitwiseAND(F.lit((1 << SYMBOL_BITS * (k + 1)) - 1))


def model_table(grams: DataFrame) -> DataFrame:
    """(gram, n, part): log likelihood difference of each gram's character, from `count_grams`."""
    levels = {ORDER: grams}
    for k in range(ORDER - 1, -1, -1):
        levels[k] = staged(levels[k + 1].groupBy(_last("gram", k).alias("gram")).agg(
            F.sum("n").alias("n"), F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "grams")
    start = F.lit(1 / 257)
    shorter = None
    for k in range(ORDER + 1):
        rows = levels[k].withColumn("context", F.shiftright("gram", SYMBOL_BITS))
        contexts = rows.groupBy("context").agg(F.sum("n0").alias("c0"), F.sum("n1").alias("c1"))
        rows = rows.join(contexts, "context")
        if shorter is None:
            rows = rows.withColumns({"q0": start, "q1": start})
        else:
            rows = rows.withColumn("short", _last("gram", k - 1)).join(shorter, "short")
        p = {f"p{c}": (F.col(f"n{c}") + STRENGTH * F.col(f"q{c}")) / (F.col(f"c{c}") + STRENGTH) for c in (0, 1)}
        rows = rows.select("gram", "n", *(v.alias(name) for name, v in p.items()))
        shorter = rows.select(F.col("gram").alias("short"), F.col("p0").alias("q0"), F.col("p1").alias("q1"))
    return rows.select("gram", "n", F.round((F.log("p1") - F.log("p0")) * UNIT).cast("long").alias("part"))


def score(rows: DataFrame, model: DataFrame) -> DataFrame:
    """`rows` of distinct `row` numbers and their `url`, with `score`: log likelihood difference per character."""
    total = model.agg(F.sum("n").alias("n")).first().n or 0
    common = model.where(F.col("n") * COMMON >= total).select("gram", "part").toArrow().sort_by("gram")
    shared = rows.sparkSession.sparkContext.broadcast((common["gram"].to_numpy(), common["part"].to_numpy()))

    def found(grams):
        keys, parts = shared.value
        if not len(keys):
            return np.zeros(len(grams), bool), np.zeros(len(grams), np.int64)
        at = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
        known = keys[at] == grams
        return known, np.where(known, parts[at], 0)

    def rare(batches):
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            for first, grams, size in _grams(batch.column(1)):
                left = ~found(grams)[0]
                row = np.repeat(numbers[first:first + len(size)], size + 1)
                yield pa.RecordBatch.from_arrays([pa.array(row[left]), pa.array(grams[left])], names=["row", "gram"])

    def usual(batches):
        for batch in batches:
            sums = [np.add.reduceat(found(grams)[1], np.cumsum(size + 1) - (size + 1)) for _, grams, size in _grams(batch.column(1))]
            sums = np.concatenate(sums) if sums else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, pa.int64())], names=[*batch.schema.names, "usual"])

    url = rows.select("row", "url")
    parts = url.mapInArrow(lean(rare), "row long, gram long").join(model.select("gram", "part"), "gram")
    parts = parts.groupBy("row").agg(F.sum("part").alias("rare"))
    whole = url.mapInArrow(lean(usual), "row long, url string, usual long").select("row", "usual")
    size = F.coalesce(F.octet_length("url"), F.lit(0))
    value = (F.col("usual") + F.coalesce("rare", F.lit(0))) / F.lit(float(UNIT)) / (size + 1)
    scored = rows.join(whole, "row").join(parts, "row", "left")
    return scored.withColumn("score", F.when(size > 0, value).otherwise(0.0)).drop("usual", "rare")


def calibrate(decided: DataFrame) -> float:
    """Threshold from (class, fold, score) rows, by a histogram of fold 0 in bins of fixed width.

    Without rows of one class the other's verdict is always given; where only the fold misses a
    class, the plain ratio decides.
    """
    width = 2 * WIDEST / BINS
    spot = F.least(F.greatest(F.floor((F.col("score") + WIDEST) / width), F.lit(0)), F.lit(BINS - 1)).cast("int")
    spot = F.when(F.col("fold") == 0, spot)
    counts, rows = np.zeros((2, BINS)), np.zeros(2)
    for r in decided.groupBy("class", spot.alias("bin")).count().collect():
        rows[r["class"]] += r["count"]
        if r["bin"] is not None:
            counts[r["class"], r["bin"]] = r["count"]
    if not rows[0]:
        return -np.inf
    if not rows[1]:
        return np.inf
    rejected, accepted = counts.sum(axis=1)
    if not rejected or not accepted:
        return 0.0
    below = np.c_[np.zeros(2), counts.cumsum(axis=1)]
    gain = below[0] / rejected + (1 - below[1] / accepted)
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    return float((best[0] + best[-1]) / 2 * width - WIDEST)


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """(id, host, path, rule, verdict, score) of every row."""
    url = F.col(url_col).cast("string")
    name, verdict = judge(F.col("host"), F.col("path"), rules)
    rows = pages.select(url.alias("url"), F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.select("*", name.alias("rule"), verdict.alias("ruled"))
    fold = F.when(F.col("ruled").isNotNull(), F.pmod(F.xxhash64("url"), F.lit(FOLDS)))
    kind = (F.col("ruled") == "allow").cast("int")
    rows = rows.withColumns({"class": kind, "fold": fold, "row": F.monotonically_increasing_id()})
    rows = staged(rows, "urls")  # the row numbers hold once they are written
    grams = staged(count_grams(rows.select("url", F.when(F.col("fold") > 0, F.col("class")).alias("class"))), "grams")
    scored = staged(score(rows, staged(model_table(grams), "model")), "scored")
    threshold = calibrate(scored.where("ruled IS NOT NULL").select("class", "fold", "score"))
    return scored.select(
        "id", "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("score") >= F.lit(float(threshold)), "allow").otherwise("block")).alias("verdict"),
        F.round("score", 6).alias("score"))


def op8_url_filter(spark, folder: str) -> DataFrame:
    return filter_urls(table(spark, folder, "pages")).withColumnRenamed("id", "page_id")
