"""Line deduplication by a deletion-neighbourhood join, in built-in expressions only.

A line is dropped when an earlier line, by document id and line number, equals it or is within
its edit bound: one word inserted, deleted or replaced, for lines of at least `LEAST_WORDS`
words; shorter lines must be equal. Words are separated by single spaces. Lines without words
are always kept.

1. Equal lines are one, known by 128 bits and its earliest place.
2. Two lines within the bound share their first or their last half (of the shorter one's words).
   Lines that share neither with another line have no neighbour and go no further.
3. The others emit their deletion neighbourhood as hashed keys: the line itself, and the line
   without each of its words. Lines that differ in one replaced word share the variant without
   it, at the same place; a line with one word more has the other whole line as a variant.
   For each key the earliest line is found by a grouped minimum, so a variant that many lines
   share costs a row per line, never a pair per two lines.
4. Each line is compared with the earliest line of its keys, word by word; it is dropped if the
   edit distance is at most one.

A null text has no lines and stays null. Rows of one document id count as one document; a
repeated row keeps the same lines. A null id sorts first. An empty table gives an empty result.
Other columns of the input are kept by `dedup_lines`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import staged, table

LEAST_WORDS = 8
LINES = 1 << 32  # more than a text can have
NO_ID = -(10 ** 19)  # below all ids
FILTER_BITS = 1 << 23


def _hashes(line: Column) -> list[Column]:
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("second"), line).alias("h2")]


def _half_keys(words: Column, n: Column) -> Column:
    """Hashes of the first and last half, for pairs whose shorter line has n or n - 1 words."""
    sides = []
    for half in (F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")):
        sides += [F.xxhash64(F.lit("first"), F.slice(words, F.lit(1), half)),
                  F.xxhash64(F.lit("last"), F.slice(words, n - half + 1, half))]
    return F.array_distinct(F.array(*sides))


def _place(key: Column, no: Column) -> Column:
    """Document id and line number as one number that sorts like the pair, a null id first."""
    return F.coalesce(key.cast("decimal(20,0)"), F.lit(str(NO_ID)).cast("decimal(20,0)")) * F.lit(LINES).cast("decimal(11,0)") + no


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(place, line) of every line with words."""
    lines = docs.select(F.col(id_col).cast("long").alias("id"), F.posexplode(F.split(F.col(text_col).cast("string"), "\n")).alias("no", "line"))
    return lines.where(F.trim("line") != "").select(_place(F.col("id"), F.col("no")).alias("place"), "line")


def distinct_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(h1, h2, place, k1..k4): every distinct line, its earliest place, and its half keys (null if it has none)."""
    lines = _lines(docs, id_col, text_col).withColumn("words", F.split("line", " "))
    n = F.size("words")
    keyed = lines.withColumn("k", F.when(n >= LEAST_WORDS, _half_keys(F.col("words"), n)))
    keys = [F.get("k", F.lit(i)).alias(f"k{i + 1}") for i in range(4)]
    flat = keyed.select("place", *_hashes(F.col("line")), *keys)
    return flat.groupBy("h1", "h2").agg(F.min("place").alias("place"), *(F.min(f"k{i}").alias(f"k{i}") for i in range(1, 5)))


def _perhaps_in(value: Column, wanted: DataFrame, column: str) -> Column:
    """Whether a hash may be among the wanted ones: a filter of FILTER_BITS bits, whatever their number.

    It only spares rows from an exact join that follows; with very many wanted hashes it lets all pass.
    """
    def spot(c):
        return F.pmod(c, F.lit(FILTER_BITS))

    words = wanted.groupBy((spot(F.col(column)) / 64).cast("int").alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (spot(F.col(column)) % 64).cast("int"))).alias("b"))
    every = wanted.sparkSession.range(FILTER_BITS // 64).join(words, F.col("id") == F.col("w"), "left")
    bits = every.agg(F.transform(F.sort_array(F.collect_list(F.struct("id", F.coalesce("b", F.lit(0)).alias("b")))),
                                 lambda x: x["b"]).alias("bits")).scalar()
    word = F.get(bits, (spot(value) / 64).cast("int"))
    return F.call_function("shiftright", word, (spot(value) % 64).cast("int")).bitwiseAND(F.lit(1)) == 1


def _without_word(line: Column, n: Column, i: Column) -> Column:
    """A line of n words without its i-th, from 1; with i = 0 the whole line."""
    before, after = F.expr("substring_index(line, ' ', at - 1)"), F.expr("substring_index(line, ' ', at - n)")
    return F.when(i == 0, line).when(i == 1, after).when(i == n, before).otherwise(F.concat(before, F.lit(" "), after))


def _one_edit(a: Column, b: Column) -> Column:
    """Whether two arrays of words are at most one insertion, deletion or replacement apart."""
    def same(x, y):
        n = F.least(F.size(x), F.size(y))
        differs = F.array_position(F.zip_with(F.slice(x, F.lit(1), n), F.slice(y, F.lit(1), n), lambda p, q: p == q), F.lit(False))
        return F.when(differs > 0, differs - 1).otherwise(n)

    return same(a, b) + same(F.reverse(a), F.reverse(b)) >= F.greatest(F.size(a), F.size(b)) - 1


def near_duplicates(docs: DataFrame, lines: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(h1, h2) of the distinct lines that have an earlier line within their bound."""
    halves = lines.where("k1 IS NOT NULL").select("h1", "h2", F.explode(F.array_compact(
        F.array("k1", "k2", "k3", "k4"))).alias("k"))
    shared = halves.groupBy("k").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).where("low <> high").select("k")
    shared = staged(shared, "shared")
    wanted = halves.where(_perhaps_in(F.col("k"), shared, "k")).join(shared, "k", "left_semi").select("h1", "h2").distinct()
    wanted = staged(lines.where("k1 IS NOT NULL").join(wanted, ["h1", "h2"], "left_semi").select("h1", "h2", "place"), "wanted")
    texts = _lines(docs, id_col, text_col).select("place", *_hashes(F.col("line")), "line")
    texts = texts.where(_perhaps_in(F.col("h1"), wanted, "h1")).join(wanted, ["h1", "h2", "place"], "left_semi")
    texts = staged(texts.dropDuplicates(["h1", "h2"]).withColumn("n", F.size(F.split("line", " "))), "texts")
    keys = texts.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("n")))).select(
        "h1", "h2", "place", "at", F.xxhash64(_without_word(F.col("line"), F.col("n"), F.col("at"))).alias("v"))
    keys = staged(keys, "variants")
    # variants of a single line meet nothing
    common = staged(keys.groupBy("v").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).where("low <> high").select("v"), "common")
    keys = staged(keys.where(_perhaps_in(F.col("v"), common, "v")).join(common, "v", "left_semi"), "variants")
    earliest = F.min(F.struct("place", "h1", "h2"))
    # the same word is missing: one replaced by another
    replaced = keys.groupBy("v", "at").agg(earliest.alias("e"), F.count("*").alias("n")).where("n > 1 AND at > 0")
    pairs = keys.join(replaced, ["v", "at"]).select("h1", "h2", "place", "e")
    # a whole line against lines with one word more
    whole = keys.where("at = 0").select("v", F.struct("place", "h1", "h2").alias("e"))
    longer = keys.where("at > 0").groupBy("v").agg(earliest.alias("e"))
    pairs = pairs.union(keys.where("at > 0").join(whole, "v").select("h1", "h2", "place", "e"))
    pairs = pairs.union(keys.where("at = 0").join(longer, "v").select("h1", "h2", "place", "e"))
    pairs = pairs.where("e.place < place").select("h1", "h2", F.col("e.h1").alias("g1"), F.col("e.h2").alias("g2")).distinct()
    own = texts.select("h1", "h2", F.split("line", " ").alias("a"))
    other = texts.select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.split("line", " ").alias("b"))
    judged = pairs.join(own, ["h1", "h2"]).join(other, ["g1", "g2"]).where(_one_edit(F.col("a"), F.col("b")))
    return judged.select("h1", "h2").distinct()


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with `text_col` cut to the kept lines, and `n_lines` and `n_kept` (which replace columns so named)."""
    lines = staged(distinct_lines(docs, id_col, text_col), "lines")
    near = staged(near_duplicates(docs, lines, id_col, text_col), "near")
    no = F.pmod("place", F.lit(LINES).cast("decimal(11,0)"))
    key = ((F.col("place") - no) / F.lit(LINES)).cast("decimal(20,0)")
    kept = lines.join(near, ["h1", "h2"], "left_anti").select(
        F.when(key != F.lit(str(NO_ID)).cast("decimal(20,0)"), key).cast("long").alias("id"), F.struct(no.cast("int").alias("no"), "h1").alias("l"))
    kept = kept.groupBy("id").agg(F.sort_array(F.collect_list("l")).alias("l"))
    held = docs.select(F.col(id_col).cast("long").alias("key"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"),
                       F.split(F.col(text_col).cast("string"), "\n").alias("all"))
    joined = held.join(kept.select(F.col("id").alias("other"), "l"), F.col("key").eqNullSafe(F.col("other")), "left")
    # rows of one id may differ, so a line counts at its place only if it is the line kept there
    own = F.filter(F.coalesce("l", F.array().cast("array<struct<no: int, h1: bigint>>")),
                   lambda x: F.xxhash64(F.get("all", x["no"])) == x["h1"])
    blanks = F.filter(F.transform("all", lambda line, i: F.when(F.trim(line) == "", i)), lambda i: i.isNotNull())
    places = F.array_sort(F.array_union(F.transform(own, lambda x: x["no"]), blanks))
    done = joined.select("doc", F.col("all"), places.alias("p")).select(
        "doc", F.array_join(F.transform("p", lambda i: F.get("all", i)), "\n").alias("t"),
        F.coalesce(F.size("all"), F.lit(0)).cast("long").alias("n"), F.coalesce(F.size("p"), F.lit(0)).cast("long").alias("m"), "all")
    text = F.when(F.col("all").isNotNull(), F.col("t"))
    columns = [text.alias(c) if c == text_col else F.col("doc").getField(c).alias(c)
               for c in docs.columns if c not in ("n_lines", "n_kept")]
    return done.select(*columns, F.greatest("n", F.lit(0)).alias("n_lines"), F.greatest("m", F.lit(0)).alias("n_kept"))


def op1_line_dedup(spark, folder: str) -> DataFrame:
    """Every document cut to its kept lines."""
    return dedup_lines(table(spark, folder, "documents")).select("doc_id", "n_lines", "n_kept", F.col("text").alias("text"))


OP1_SQL = r"""
WITH l AS (
  SELECT doc_id, i AS no, parts[i] AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL),
    unnest(range(1, len(parts) + 1)) AS t(i)),
u AS MATERIALIZED (
  SELECT line, min({'d': doc_id, 'n': no}) AS place, string_split(line, ' ') AS w FROM l WHERE trim(line, ' ') <> '' GROUP BY line),
b AS MATERIALIZED (SELECT line, place, w, len(w) AS n FROM u WHERE len(w) >= 8),
c AS (
  SELECT x.line, x.w AS a, y.w AS b, x.n AS n, y.n AS m FROM b x JOIN b y ON x.w[1] = y.w[1] AND abs(x.n - y.n) <= 1 AND y.place < x.place
  UNION
  SELECT x.line, x.w, y.w, x.n, y.n FROM b x JOIN b y ON x.w[-1] = y.w[-1] AND abs(x.n - y.n) <= 1 AND y.place < x.place),
r AS (
  SELECT DISTINCT line FROM c WHERE
    CASE WHEN n = m THEN len(list_filter(range(1, n + 1), lambda i: a[i] <> b[i])) <= 1
    WHEN n > m THEN len(list_filter(range(1, n + 1), lambda i: list_concat(a[:i - 1], a[i + 1:]) = b)) > 0
    ELSE len(list_filter(range(1, m + 1), lambda i: list_concat(b[:i - 1], b[i + 1:]) = a)) > 0 END),
k AS (
  SELECT l.doc_id, l.no, l.line FROM l LEFT JOIN u ON u.line = l.line LEFT JOIN r ON r.line = l.line
  WHERE u.line IS NULL OR (r.line IS NULL AND u.place = {'d': l.doc_id, 'n': l.no})),
t AS (SELECT doc_id, count(*) AS n_kept, string_agg(line, chr(10) ORDER BY no) AS text FROM k GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END AS n_lines, coalesce(t.n_kept, 0) AS n_kept,
  CASE WHEN d.text IS NOT NULL THEN coalesce(t.text, '') END AS text
FROM documents d LEFT JOIN t USING (doc_id)
"""
