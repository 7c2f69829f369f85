"""Language identification by Bayesian fusion of evidence.

The posterior of a language is the product of
- the likelihood of the text under a model of letter trigrams per language, counted over all rows
  whose declared language is known, every trigram by itself. Each letter stands in three trigrams, so the log
  likelihood counts a third. A background model of independent letters stands for no language;
- the likelihood of the declared markup language and of the address suffix's country, given the
  language: confusion counts from one grouped aggregation each, smoothed;
- the prior of the host: expected counts per host, smoothed towards its domain, the domain
  towards its suffix, and that towards the whole table, all from grouped aggregations.

Texts are scored where they are read and only scores are joined, so texts never shuffle. There are
156^3 trigrams at most, whatever the input; those that occur make the model. Counts cover all rows.

A text without letters (null, empty, digits only) has no language and is rejected, whatever is
declared. A null or unknown declared language, suffix or host is no evidence. Repeated rows
count each. An empty table gives an empty result. Columns besides those named play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import lean, slices, staged, table, text_buffer

LANGUAGES = ("de", "en", "es", "fr")
NONE = "und"
#: Countries whose address suffix tells a language.
SUFFIX_LANGUAGE = {"de": "de", "at": "de", "uk": "en", "us": "en", "ie": "en", "au": "en", "es": "es", "mx": "es",
                   "ar": "es", "fr": "fr"}
LETTERS = 156
TRIGRAMS = LETTERS ** 3
SMOOTH = 0.05
HOST_WEIGHT = 20.0
PRIOR_NONE = 1e-3
LEAST_CONFIDENCE = 0.5

#: 0 for all that is no letter, a-z (also for A-Z), then the bytes of letters beyond ASCII.
_CLASS = np.zeros(256, np.int32)
_CLASS[0x61:0x7B] = _CLASS[0x41:0x5B] = np.arange(1, 27)
_CLASS[0x80:] = np.arange(27, 155)


def _trigrams(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per slice of rows: letter class of every byte, trigrams, and the trigrams' row offsets.

    Every row is padded by a non-letter at both ends; trigrams without a letter are -1.
    """
    data, offsets = text_buffer(column)
    for a, b in slices(offsets):
        size = np.diff(offsets[a:b + 1])
        begin = np.r_[0, np.cumsum(size + 2)]
        letters = np.zeros(begin[-1], np.int32)
        keep = np.ones(begin[-1], bool)
        keep[begin[:-1]] = keep[begin[1:] - 1] = False
        letters[keep] = _CLASS[data[offsets[a]:offsets[b]]]
        code = (letters[:-2] * LETTERS + letters[1:-1]) * LETTERS + letters[2:]
        cell = code
        cell[code == 0] = -1
        inside = np.ones(len(code), bool)  # no trigram over the border of two rows
        border = begin[1:-1]
        inside[border - 1] = inside[border - 2] = False
        cell[~inside] = -1
        yield letters, cell, begin


def fit_text_model(docs: DataFrame, text: str, declared: Column, languages=LANGUAGES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(trigrams, log probabilities, log letter frequencies), counted over all rows with a known language.

    Probabilities are languages x (trigrams + 1), the first of each language being that of a trigram that no language has;
    trigrams are those that some language has, in order.
    """
    width = len(languages)

    def count(batches):
        cells, single, size = np.zeros(width * TRIGRAMS, np.int32), np.zeros(LETTERS, np.int64), 0

        def counted():
            some = np.flatnonzero(cells)
            letters = np.flatnonzero(single)
            return pa.RecordBatch.from_arrays([pa.array(np.r_[some, width * TRIGRAMS + letters], pa.int64()),
                                               pa.array(np.r_[cells[some].astype(np.int64), single[letters]])], names=["cell", "n"])

        for batch in batches:
            number = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            first = 0
            for letters, cell, begin in _trigrams(batch.column(0)):
                own = number[first:first + len(begin) - 1]
                first += len(begin) - 1
                at = np.repeat(own, np.diff(begin))[:len(cell)]
                kept = cell >= 0
                np.add.at(cells, at[kept] * TRIGRAMS + cell[kept], np.int32(1))
                single += np.bincount(letters, minlength=LETTERS)
                size += len(letters)
                if size > 1 << 30:  # before a count could overflow
                    yield counted()
                    cells[:], single[:], size = 0, 0, 0
        yield counted()

    number = F.array_position(F.array(*map(F.lit, languages)), declared) - 1
    known = docs.select(F.col(text).cast("string").alias("text"), number.cast("long").alias("number")).where("number >= 0")
    counts = known.mapInArrow(lean(count), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    at, n = counts["cell"].to_numpy(), counts["n"].to_numpy()
    single = np.full(LETTERS, SMOOTH)
    single[at[at >= width * TRIGRAMS] - width * TRIGRAMS] += n[at >= width * TRIGRAMS]
    at, n = at[at < width * TRIGRAMS], n[at < width * TRIGRAMS]
    seen = np.unique(at % TRIGRAMS)
    cells = np.full((width, len(seen) + 1), SMOOTH)
    cells[at // TRIGRAMS, np.searchsorted(seen, at % TRIGRAMS) + 1] += n
    return seen.astype(np.int32), np.log(cells / cells.sum(axis=1, keepdims=True)).astype(np.float32), np.log(single / single.sum()).astype(np.float32)


def text_scores(docs: DataFrame, text: str, keep: list[Column], model: tuple[np.ndarray, np.ndarray, np.ndarray], languages=LANGUAGES) -> DataFrame:
    """The kept columns, `n_trigrams`, and a log likelihood `t_<language>` per language and for none."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    names = [f"t_{x}" for x in (*languages, NONE)]

    def score(batches):
        seen, table, frequency = shared.value
        width, place = len(names) - 1, np.zeros(TRIGRAMS, np.int32)
        place[seen] = np.arange(1, len(seen) + 1)
        for batch in batches:
            parts, totals = [], []
            for letters, cell, begin in _trigrams(batch.column(batch.num_columns - 1)):
                kept = cell >= 0
                total = np.r_[0, np.cumsum(kept)]
                ends = np.minimum(begin, len(cell))
                row = np.empty((width + 1, len(begin) - 1))
                found = place[np.where(kept, cell, 0)]
                for k in range(width):
                    run = np.r_[0.0, np.cumsum(np.where(kept, table[k][found], 0), dtype=np.float64)]
                    row[k] = np.diff(run[ends])
                lone = frequency[letters]
                run = np.r_[0.0, np.cumsum(np.where(kept, lone[:-2] + lone[1:-1] + lone[2:], 0), dtype=np.float64)]
                row[width] = np.diff(run[ends])
                parts.append(row / 3)
                totals.append(np.diff(total[ends]))
            values = np.concatenate(parts, axis=1) if parts else np.zeros((width + 1, 0))
            n = np.concatenate(totals) if totals else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(n, pa.int64()), *(pa.array(v, pa.float64()) for v in values)],
                names=[*batch.schema.names[:-1], "n_trigrams", *names])

    source = docs.select(*keep, F.col(text).cast("string").alias("text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    return source.mapInArrow(lean(score), f"{kept}, n_trigrams long, " + ", ".join(f"{x} double" for x in names))


def _posterior(rows: DataFrame, scores: list[Column]) -> DataFrame:
    """The rows with their log scores `s`, the best of them `top`, and the normaliser `z` of exp(s - top)."""
    rows = rows.withColumn("s", F.array(*scores)).withColumn("top", F.array_max("s"))
    return rows.withColumn("z", F.aggregate("s", F.lit(0.0), lambda z, s: z + F.exp(s - F.col("top"))))


def _likelihood(scored: DataFrame, seen: Column, values: list[str], classes: list[str]) -> dict[tuple[str, str], float]:
    """Log P(seen value | language) from expected counts; the values are a fixed list and `none`."""
    sums = scored.groupBy(seen.alias("value")).agg(*(F.sum(f"p_{x}").alias(x) for x in classes)).collect()
    counts = {(r["value"], x): (r[x] or 0.0) for r in sums for x in classes}
    out = {}
    for x in classes:
        known = [v for v in values if v != "none"]
        total = sum(counts.get((v, x), 0.0) for v in known) + len(known)
        for v in known:
            out[v, x] = float(np.log((counts.get((v, x), 0.0) + 1) / total))
        out["none", x] = 0.0
    return out


def _evidence(seen: Column, values: list[str], logs: dict[tuple[str, str], float], language: str) -> Column:
    return reduce(lambda c, v: c.when(seen == v, F.lit(logs[v, language])), values[1:],
                  F.when(seen == values[0], F.lit(logs[values[0], language]))).otherwise(F.lit(0.0))


def host_priors(scored: DataFrame, classes: list[str]) -> DataFrame:
    """(host, prior_<language>...): expected counts of the host, smoothed level by level."""
    start = {x: PRIOR_NONE if x == NONE else (1 - PRIOR_NONE) / (len(classes) - 1) for x in classes}
    labels = F.split("host", r"\.")
    hosts = staged(scored.where("host IS NOT NULL").groupBy("host").agg(
        F.count("*").alias("n"), *(F.sum(f"p_{x}").alias(f"n_{x}") for x in classes)).withColumns({
            "domain": F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2)),
            "suffix": F.when(F.size(labels) > 1, F.element_at(labels, -1)).otherwise("")}), "hosts")

    def rolled(key):
        return hosts.groupBy(key).agg(F.sum("n").alias("n"), *(F.sum(f"n_{x}").alias(f"n_{x}") for x in classes))

    def smoothed(x, parent):
        return ((F.col(f"n_{x}") + HOST_WEIGHT * parent) / (F.col("n") + HOST_WEIGHT))

    whole = hosts.agg(F.sum("n").alias("n"), *(F.sum(f"n_{x}").alias(f"n_{x}") for x in classes)).first()
    base = {x: ((whole[f"n_{x}"] or 0.0) + HOST_WEIGHT * start[x]) / ((whole["n"] or 0) + HOST_WEIGHT) for x in classes}
    suffixes = rolled("suffix").select("suffix", *(smoothed(x, F.lit(base[x])).alias(f"s_{x}") for x in classes))
    domains = rolled("domain").withColumn("suffix", F.when(F.contains("domain", F.lit(".")), F.substring_index("domain", ".", -1)).otherwise(""))
    domains = domains.join(suffixes, "suffix").select("domain", *(smoothed(x, F.col(f"s_{x}")).alias(f"d_{x}") for x in classes))
    return hosts.join(domains, "domain").select("host", *(smoothed(x, F.col(f"d_{x}")).alias(f"prior_{x}") for x in classes))


def identify(docs: DataFrame, text: str = "text", keys: list[str] = ("doc_id",), declared: str | None = "lang",
             host: str | None = "source", suffix: Column | None = None, languages=LANGUAGES,
             least: float = LEAST_CONFIDENCE) -> DataFrame:
    """The key columns, `declared`, `language` (null: none), `confidence` and `accepted` of every row.

    `host` may be a plain source name or a dotted host; `suffix` is the address suffix, if known.
    Accepted are rows that show a language with at least the least confidence.
    """
    classes = [*languages, NONE]
    said = F.lower(F.substring_index(F.col(declared), "-", 1)) if declared else F.lit(None).cast("string")
    said = F.when(said.isin(*languages), said).when(said.isNull() | (said == ""), "none").otherwise("other")
    lands = F.create_map(*(F.lit(x) for pair in SUFFIX_LANGUAGE.items() for x in pair))
    land = F.coalesce(F.element_at(lands, F.lower(suffix)), F.lit("generic")) if suffix is not None else F.lit("none")
    model = fit_text_model(docs.withColumn("_said", said), text, F.col("_said"), languages)
    own = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]
    scored = text_scores(docs, text, [*own, said.alias("said"), land.alias("land"),
                                      (F.col(host).cast("string") if host else F.lit(None).cast("string")).alias("host")],
                         model, languages)
    start = {x: float(np.log(PRIOR_NONE if x == NONE else (1 - PRIOR_NONE) / len(languages))) for x in classes}
    by_text = _posterior(scored, [F.col(f"t_{x}") + F.lit(start[x]) for x in classes])
    scored = staged(by_text.select(*scored.columns, *(
        F.when(F.col("n_trigrams") > 0, F.exp(F.get("s", F.lit(i)) - F.col("top")) / F.col("z")).alias(f"p_{x}")
        for i, x in enumerate(classes))), "scores")
    priors = staged(host_priors(scored.where("n_trigrams > 0"), classes), "priors")
    saids, land_values = [*languages, "other", "none"], [*sorted(set(SUFFIX_LANGUAGE.values())), "generic", "none"]
    by_said = _likelihood(scored, F.col("said"), saids, classes)
    by_land = _likelihood(scored, F.col("land"), land_values, classes)
    joined = scored.join(priors, "host", "left")
    fused = _posterior(joined, [
        F.col(f"t_{x}") + F.log(F.coalesce(F.col(f"prior_{x}"), F.lit(float(np.exp(start[x])))))
        + _evidence(F.col("said"), saids, by_said, x) + _evidence(F.col("land"), land_values, by_land, x)
        for x in classes])
    known = F.col("n_trigrams") > 0
    judged = fused.withColumn("best", F.when(known, F.get(F.array(*map(F.lit, classes)), F.array_position(
        "s", F.col("top")).cast("int") - 1))).withColumn("p", F.when(known, F.round(1 / F.col("z"), 4)))
    return judged.select(
        *(F.col(f"k{i}").alias(k) for i, k in enumerate(keys)),
        F.when(F.col("said") != "none", F.col("said")).alias("declared"),
        F.when(F.col("best") != NONE, F.col("best")).alias("language"), F.col("p").alias("confidence"),
        F.coalesce((F.col("best") != NONE) & (F.col("p") >= least), F.lit(False)).alias("accepted"))


def op4_language_id(spark, folder: str) -> DataFrame:
    """Every document: its text, declared language and source as host."""
    return identify(table(spark, folder, "documents"))


def language_id_pages(spark, folder: str) -> DataFrame:
    """Every page: visible text, markup language, address suffix and host."""
    pages = table(spark, folder, "pages")
    host = F.lower(F.regexp_extract("url", r"://([^/?#]*)", 1))
    shown = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>", " "), r"(?s)<[^>]*>", " ")
    return identify(pages.select("page_id", shown.alias("shown"), F.regexp_extract(
        "html", r"(?i)<html[^>]*\blang=[\"']?([A-Za-z-]+)", 1).alias("markup"), host.alias("host")),
        "shown", ["page_id"], "markup", "host", F.substring_index(F.col("host"), ".", -1))
