"""Monitoring of dated sheets and of archived outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import all_of
from ledgerloom.functions.measures import differs, mostly_equal
from ledgerloom.operators.joins import join_keys
from ledgerloom.operators.quality import compare_profiles, drop_empty_rows, profile
from ledgerloom.operators.reconcile import period_diff
from ledgerloom.operators.reshape import melt
from ledgerloom.operators.series import forward_fill, section_slice
from ledgerloom.sources.tables import literal_table


def sheet_section(sheets: DataFrame, start: Column, end: Column, values: list[str]) -> DataFrame:
    """The block of each sheet between two marker rows, without rows that hold nothing.

    sheets(file, row_no, name, value columns).
    """
    return drop_empty_rows(section_slice(sheets, ["file"], "row_no", start, end), ["name", *values])


def balance_items(sheets: DataFrame, start: Column, end: Column, classes: list[str], values: list[str]) -> DataFrame:
    """Balance items of a block in long form: file, class, name, currency type, value.

    A row whose name is one of `classes` opens that class and is itself no item.
    """
    block = sheet_section(sheets, start, end, values)
    key = F.lower(F.trim("name"))
    is_class = F.coalesce(key.isin(*[c.lower() for c in classes]), F.lit(False))
    block = block.withColumn("class_name", F.when(is_class, F.trim("name")))
    filled = forward_fill(block, ["file"], "row_no", ["class_name"])
    items = filled.where(F.col("name").isNotNull() & ~is_class)
    return melt(items.select("file", "class_name", "name", *values), ["file", "class_name", "name"], values, "currency_type", "value")


def balance_changes(items: DataFrame, pairs: DataFrame) -> DataFrame:
    """Change of every balance item between the old and the new file of each company.

    pairs(company, file_old, file_new).
    """
    def side(name: str) -> DataFrame:
        files = pairs.select("company", F.col(f"file_{name}").alias("file"))
        return join_keys(items, files, ["file"], "inner", null_safe=False).select(
            "company", "class_name", "name", "currency_type", F.col("value").cast("double").alias("value"))

    return period_diff(side("old"), side("new"), ["company", "class_name", "name", "currency_type"], "value")


def balance_blocks(
    sheets: DataFrame, pairs: DataFrame, marks: dict[str, tuple[Column, Column]], classes: list[str], values: list[str],
    own_items: tuple[str, ...] = ("equity",),
) -> DataFrame:
    """Changes between the old and the new sheet of each company, for all blocks of a balance at once.

    sheets(file, row_no, name, value columns); pairs(company, file_old, file_new). `marks` has the
    start and end conditions of the blocks `exposure`, `balance` and `off_balance`; the first start
    counts and the first end after it, both rows included. Lines come out under
    - net_exposure and exposure_split: exposure rows with and without "net" in their name,
    - items: balance rows by the class that opens above them; a class row is no item, unless it is
      one of `own_items`,
    - totals: rows named "total ..." of the balance, by side, and of the off-balance block,
    - off_balance: the other rows of that block.
    Sheets are tagged old or new once and compared by conditional sums in one grouping.
    """
    files = pairs.select("company", F.explode(F.array(
        F.struct(F.col("file_old").alias("file"), F.lit(False).alias("new")), F.struct(F.col("file_new").alias("file"), F.lit(True).alias("new")),
    )).alias("f")).select("company", "f.*")
    rows = join_keys(sheets, files, ["file"], "inner", null_safe=False)
    at = F.col("row_no")
    starts = rows.groupBy("file").agg(*[F.min(F.when(s, at)).alias(f"__s_{b}") for b, (s, _) in marks.items()])
    rows = join_keys(rows, starts, ["file"], "inner", null_safe=False)
    ends = rows.groupBy("file").agg(*[F.min(F.when(e & (at > F.col(f"__s_{b}")), at)).alias(f"__e_{b}") for b, (_, e) in marks.items()])
    rows = join_keys(rows, ends, ["file"], "inner", null_safe=False)
    inside = [F.when((at >= F.col(f"__s_{b}")) & (at <= F.coalesce(f"__e_{b}", at)), F.lit(b)) for b in marks]
    rows = drop_empty_rows(rows.withColumn("block", F.explode(F.array_compact(F.array(*inside)))), ["name", *values])
    name = F.lower(F.trim("name"))
    is_class = F.coalesce((F.col("block") == "balance") & name.isin(*[c.lower() for c in classes]), F.lit(False))
    rows = forward_fill(rows.withColumn("class_name", F.when(is_class, F.trim("name"))), ["file", "block"], "row_no", ["class_name"])
    total, off = name.startswith("total"), F.col("block") == "off_balance"
    side = F.when(name.contains("liabilities"), "Liabilities and equity").when(name.contains("assets"), "Assets")
    kind = F.when(F.col("block") == "exposure", F.when(name.contains("net"), "net_exposure").otherwise("exposure_split")).when(
        total, "totals").when(off, "off_balance").otherwise("items")
    keep = F.col("name").isNotNull() & (~is_class | name.isin(*own_items))
    lines = rows.where(keep).select(
        "company", "new", kind.alias("block"), F.when(kind == "totals", side).when(kind == "items", F.col("class_name")).alias("class_name"),
        F.when(total & off, "Off balance").otherwise(F.trim("name")).alias("name"), *values)
    long = melt(lines, ["company", "new", "block", "class_name", "name"], values, "currency_type", "value")
    sums = long.groupBy("company", "block", "class_name", "name", "currency_type").agg(
        F.coalesce(F.sum(F.when(~F.col("new"), F.col("value"))), F.lit(0.0)).alias("value_old"),
        F.coalesce(F.sum(F.when(F.col("new"), F.col("value"))), F.lit(0.0)).alias("value_new"))
    return sums.withColumn("value_diff", F.col("value_new") - F.col("value_old"))


def archive_compare(old: dict[str, DataFrame], new: dict[str, DataFrame], tolerance: float = 0.4) -> dict[str, DataFrame]:
    """Column profiles of two runs of the same outputs, the outputs with a difference, and the
    outputs that only one run has (`unpaired`: dataset, side)."""
    names = sorted(set(old) & set(new))
    spark = next(iter((old or new).values())).sparkSession
    lone = [(n, "only_old") for n in sorted(set(old) - set(new))] + [(n, "only_new") for n in sorted(set(new) - set(old))]
    unpaired = literal_table(spark, lone, "dataset string, side string")
    if not names:
        return {"unpaired": unpaired}
    compared = None
    for name in names:
        part = compare_profiles(profile(old[name]), profile(new[name]), tolerance).withColumn("dataset", F.lit(name))
        compared = part if compared is None else compared.unionByName(part)
    flags = ["nulls_equal", "sum_equal", "rows_equal", "zero_rows_equal", "type_equal", "n_columns_equal"]
    problems = compared.groupBy("dataset").agg(*[F.every(f).alias(f) for f in flags])
    problems = problems.where(~sum((F.col(f).cast("int") for f in flags), F.lit(0)).eqNullSafe(len(flags)))
    return {"columns": compared, "problems": problems, "unpaired": unpaired}


def compare_outputs(profiles: DataFrame, pairs: DataFrame, tolerance: float = 0.4) -> dict[str, DataFrame]:
    """Profiles of paired outputs side by side, and the names with a difference.

    profiles(output, column, type, n_columns, nulls, sum, rows, zero_rows); pairs(name, old_output,
    new_output). Both runs of all names are compared in one join, whatever their number.
    """
    figures = ["type", "n_columns", "nulls", "sum", "rows", "zero_rows"]

    def side(which: str) -> DataFrame:
        named = pairs.select("name", F.col(f"{which}_output").alias("output"))
        return join_keys(profiles, named, ["output"], "inner", null_safe=False).select(
            "name", "column", *[F.col(c).alias(f"{c}_{which}") for c in figures])

    both = join_keys(side("old"), side("new"), ["name", "column"], "full", null_safe=False)
    both = both.na.fill(0, subset=[f"{c}_{w}" for c in figures[2:] for w in ("old", "new")])
    flags = {f"{c}_equal": F.coalesce(mostly_equal(f"{c}_old", f"{c}_new", tolerance), F.lit(False)) for c in figures[2:]}
    flags |= {f"{c}_equal": F.coalesce(F.col(f"{c}_old") == F.col(f"{c}_new"), F.lit(False)) for c in figures[:2]}
    compared = both.withColumns(flags)
    problems = compared.groupBy("name").agg(*[F.every(f).alias(f) for f in flags])
    return {"columns": compared, "problems": problems.where(~all_of(F.col(f) for f in flags))}


def summary_compare(history: DataFrame, keys: list[str], values: list[str], tolerance: float = 0.4) -> DataFrame:
    """Last two runs of a summary history side by side, each figure flagged when it differs."""
    newest = history.agg(F.max("run_date")).scalar()
    previous = history.where(F.col("run_date") < newest).agg(F.max("run_date")).scalar()

    def run(day: Column, tail: str) -> DataFrame:
        return history.where(F.col("run_date") == day).select(*keys, *[F.col(v).alias(f"{v}_{tail}") for v in values])

    both = join_keys(run(previous, "old"), run(newest, "new"), keys, "full")
    both = both.na.fill(0, subset=[f"{v}_{x}" for v in values for x in ("old", "new")])
    return both.withColumns({f"{v}_differs": differs(f"{v}_old", f"{v}_new", tolerance) for v in values})
