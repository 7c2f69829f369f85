"""Mixing sources to target weights by temperature, realised as block permutations.

The token share p of each source is raised to an exponent and normalised: 1 keeps the natural
shares, 0 makes all sources equal. The exponent is bisected to meet a target: a largest
repetition (of the most repeated source against the least repeated one) or an entropy of the
weights. Every step evaluates a row of exponents in one grouped query over the sources, so no
table of sources reaches the driver.

A token budget then gives every source a number of passes, budget x weight / tokens. A source
is dealt by hash into blocks; each pass goes through all blocks in an order of its own, which is
returned on demand as the block's rank in its pass and the document's place in the block. The
last, unfinished pass takes blocks until the budget of the source is met, cutting the last
block by document. Only block totals are ordered per source, and only the one cut block is
ordered by document, so no task ever orders a source.

Without a budget, the smallest one that uses every source once is taken: no document is lost,
and sources below their weight are repeated.

Tokens are runs of other than white space, or a given count; null texts have none and negative
or null counts are 0. A source without tokens keeps its rows, once each. A null source is a
source of its own. Repeated rows are separate documents. An empty table stays empty. The
exponent is 1 when there are fewer than two sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import staged, table

BLOCKS = 512
SECTIONS = 32
ROUNDS = 8
REPETITION = 1.25


def word_count(text: str) -> Column:
    """Runs of other than white space in a text."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _measure(shares: DataFrame, exponents: list[float], entropy: bool) -> dict[float, float]:
    """Entropy of the weights (nats), or largest repetition against the least, for each exponent."""
    spread = shares.where("tokens > 0").select("p", F.explode(F.array(*map(F.lit, exponents))).alias("e"))
    if entropy:  # H = log Z - sum(q log q) / Z with q = p ** e
        q = F.pow("p", "e")
        found = spread.groupBy("e").agg((F.log(F.sum(q)) - F.sum(q * F.log(q)) / F.sum(q)).alias("value"))
    else:
        q = F.pow(F.col("p"), F.col("e") - 1)
        found = spread.groupBy("e").agg((F.max(q) / F.min(q)).alias("value"))
    return {r.e: r.value for r in found.collect()}


def bisect_exponent(shares: DataFrame, repetition: float | None = REPETITION, entropy: float | None = None) -> float:
    """Exponent in [0, 1] of least flattening that meets the entropy, or of most flattening within the repetition.

    Both measures fall as the exponent grows. Every round divides the interval into sections.
    """
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        grid = [low + (high - low) * i / SECTIONS for i in range(SECTIONS + 1)]
        values = _measure(shares, grid, entropy is not None)
        if not values:
            return 1.0
        if entropy is not None:  # the largest exponent that still reaches the entropy
            met = [i for i, e in enumerate(grid) if values[e] >= entropy]
            at = max(met, default=0)
            low, high = grid[at], grid[min(at + 1, SECTIONS)]
        else:  # the smallest exponent within the repetition
            met = [i for i, e in enumerate(grid) if values[e] <= repetition]
            at = min(met, default=SECTIONS)
            low, high = grid[max(at - 1, 0)], grid[at]
    return low if entropy is not None else high


def source_weights(counts: DataFrame, repetition: float | None = REPETITION, entropy: float | None = None) -> DataFrame:
    """(source, tokens, p, weight) from (source, tokens), one row per source."""
    total = counts.agg(F.sum("tokens").alias("t")).first().t or 0
    shares = staged(counts.withColumn("p", F.col("tokens") / F.lit(float(total or 1))), "shares")
    exponent = bisect_exponent(shares, repetition, entropy)
    raised = F.when(F.col("tokens") > 0, F.pow("p", F.lit(exponent))).otherwise(0.0)
    norm = shares.agg(F.sum(raised).alias("z")).first().z or 1.0
    return shares.withColumn("weight", raised / F.lit(norm))


def mix(docs: DataFrame, source: str = "source", text: str | None = "text", tokens: Column | None = None,
        key: list[str] = ("doc_id",), budget: int | None = None, repetition: float | None = REPETITION,
        entropy: float | None = None, seed: int = 0, blocks: int = BLOCKS,
        number: str = "pass", position: tuple[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The mixed documents with the number of their pass, and the sources' weights.

    Each source's documents come as often as its passes say; a started pass stops before the
    document that would exceed the source's share of the budget. Rows with one key stay together.
    `position` names two more columns, the block's rank in the pass, from 1, and the document's
    place in the block: by source, pass, rank and place the documents are in mixed order.
    Input columns named like `number` or these are replaced.
    """
    # null sources are told from any text
    group = F.concat(F.when(F.col(source).isNull(), "0").otherwise("1"), F.coalesce(F.col(source).cast("string"), F.lit("")))
    count = F.greatest(F.coalesce((tokens if tokens is not None else word_count(text)).cast("long"), F.lit(0)), F.lit(0))
    identity = [F.col(k) for k in key]
    block = F.pmod(F.xxhash64(F.lit(seed), group, *identity), F.lit(blocks)).cast("int")
    place = F.xxhash64(F.lit(seed), F.lit("cut"), *identity)
    dealt = docs.select(group.alias("g"), block.alias("b"), place.alias("place"), F.struct(
        *(F.col(f"`{c}`") for c in docs.columns if c not in (number, *(position or ())))).alias("doc"), count.alias("t"))
    by_block = staged(dealt.groupBy("g", "b").agg(F.sum("t").alias("t")), "blocks")
    weights = staged(source_weights(by_block.groupBy("g").agg(F.sum("t").alias("tokens")), repetition, entropy), "weights")
    if budget is None:
        budget = weights.where("weight > 0").agg(F.max(F.col("tokens") / F.col("weight")).alias("b")).first().b or 0.0
    # a hair above, so that a source whose share equals its tokens makes its whole pass
    share = F.floor(F.lit(float(budget)) * F.col("weight") * (1 + 1e-12) + 1e-6).cast("long")
    full = F.when(F.col("tokens") > 0, F.floor(F.col("share") / F.col("tokens"))).otherwise(1).cast("int")
    plan = weights.withColumn("share", share).withColumn("full", full).withColumn(
        "rest", F.when(F.col("tokens") > 0, F.col("share") - F.col("full") * F.col("tokens")).otherwise(0))
    # the order of blocks in the unfinished pass; at most `blocks` rows per source
    line = Window.partitionBy("g").orderBy(F.xxhash64(F.lit(seed), "full", "g", "b"), "b").rowsBetween(
        Window.unboundedPreceding, -1)
    ordered = by_block.join(plan.select("g", "full", "rest"), "g").withColumn(
        "room", F.col("rest") - F.coalesce(F.sum("t").over(line), F.lit(0)))
    ordered = staged(ordered.select("g", "b", "full", "room", (
        (F.col("room") > 0) & (F.col("room") < F.col("t"))).alias("cut"), (
        (F.col("room") > 0) & (F.col("room") >= F.col("t"))).cast("int").alias("whole")), "order")
    # one block per source is cut: how far along its documents the budget reaches
    within = Window.partitionBy("g").orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    cut = dealt.join(ordered.where("cut"), ["g", "b"]).select("g", "room", "place", "t").withColumn(
        "upto", F.sum("t").over(within)).where("upto <= room").groupBy("g").agg(F.max("place").alias("reach"))
    order = staged(ordered.join(cut, "g", "left"), "order")
    passes = F.col("full") + F.col("whole") + (F.col("cut") & F.coalesce(F.col("place") <= F.col("reach"), F.lit(False))).cast("int")
    state = order.select("g", "b", "full", "whole", "cut", "reach")
    if position is not None:
        # pass n is ordered like the unfinished one above, which is number full + 1
        turn = order.withColumn("n", F.explode(F.sequence(F.lit(1), F.col("full") + 1))).select("g", "b", "n")
        rank = F.row_number().over(Window.partitionBy("g", "n").orderBy(F.xxhash64(F.lit(seed), F.col("n") - 1, "g", "b"), "b"))
        ranks = turn.withColumn("rank", rank).groupBy("g", "b").agg(F.array_sort(F.collect_list(F.struct("n", "rank"))).alias("ranks"))
        state = staged(state.join(ranks.select("g", "b", F.col("ranks.rank").alias("ranks")), ["g", "b"]), "order")
    placed = dealt.drop("t").join(state, ["g", "b"]).withColumn("passes", passes).where("passes > 0")
    mixed = placed.withColumn("n", F.explode(F.sequence(F.lit(1), F.col("passes"))))
    ordered_by = [F.element_at("ranks", F.col("n")).alias(position[0]), F.col("place").alias(position[1])] if position else []
    mixed = mixed.select("doc.*", F.col("n").alias(number), *ordered_by)
    name = F.when(F.substring("g", 1, 1) == "1", F.expr("substring(g, 2)"))
    return mixed, weights.select(name.alias(source), "tokens", "p", "weight")


def op10_mixing(spark, folder: str) -> DataFrame:
    """Documents mixed so that no source is repeated over 1.25 times as often as another."""
    mixed, _ = mix(table(spark, folder, "documents"), position=("block_rank", "place"))
    return mixed.select("doc_id", "source", "pass", "block_rank", "place")
