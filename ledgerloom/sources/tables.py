"""Reading landed tables, databases, delimited files and dated snapshots."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerloom.functions.columns import as_col
from ledgerloom.session import staged


# Declared column types of the landed tables; other tables are read with their own schema.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


class Tables:
    """Attribute access to the parquet tables of one folder: `Tables(spark, dir).orders`."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._derived: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        table = read_table(self.spark, self.folder, name)
        setattr(self, name, table)
        return table

    def derived(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A derived table written once to the shared folder and read from there."""
        if name not in self._derived:
            self._derived[name] = staged(build(), name)
        return self._derived[name]


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table by name; with a declared schema no file is opened before the query runs."""
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of configured rows as a literal relation, whose size the optimizer knows."""
    names = [c.split()[0] for c in schema.split(", ")]
    types = ", ".join(f"{n}: {t}" for n, t in (c.split() for c in schema.split(", ")))
    if not rows:
        return spark.createDataFrame([], schema)

    def cell(value: object, kind: str) -> Column:
        return F.lit(value).cast(kind)

    kinds = [c.split()[1] for c in schema.split(", ")]
    structs = F.array(*[F.struct(*[cell(v, k).alias(n) for v, k, n in zip(row, kinds, names)]) for row in rows])
    return spark.range(1).select(F.inline(structs.cast(f"array<struct<{types}>>")))


def read_jdbc(
    spark: SparkSession,
    options: dict[str, str],
    query: str,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 64,
) -> DataFrame:
    """Read a query result from a database, in parallel when a partition column is given."""
    reader = spark.read.format("jdbc").options(**options)
    if partition_column is None:
        return reader.option("query", query).load()
    lower, upper = bounds
    return (
        reader.option("dbtable", f"({query}) q")
        .option("partitionColumn", partition_column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", str(partitions))
        .load()
    )


def read_delimited(
    spark: SparkSession, path: str, schema: StructType | str, columns: list[str] | None = None,
    sep: str = ",",
) -> DataFrame:
    """Delimited text with a header and a declared schema; only `columns` are kept."""
    df = spark.read.csv(path, sep=sep, header=True, schema=schema)
    return df.select(*columns) if columns else df


def read_checked(
    spark: SparkSession, path: str, schema: StructType | str, sep: str = ",", header: bool = True, options: dict[str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Delimited text as (good rows, rejected lines); together they are all lines with content.

    Rejected are lines with fewer or more fields than the schema and lines with a value that does not
    fit its type: source_file, record (the whole line), problem. Good rows keep `source_file`.
    """
    fields = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    wanted = StructType([*fields, StructField("__record", StringType())])
    # the lines are written once: parsed with all columns, whatever the caller selects later
    given = {"sep": sep, **(options or {})}
    lines = spark.read.options(**given).csv(path, header=header, schema=wanted, mode="PERMISSIVE", columnNameOfCorruptRecord="__record")
    lines = staged(lines.withColumn("source_file", F.col("_metadata.file_name")), "lines")
    good = lines.where("__record IS NULL").drop("__record")
    cells = F.from_csv("__record", ", ".join(f"`{f.name}` string" for f in fields), given)
    wrong = F.array_compact(F.array(*(F.when(cells[f.name].isNotNull() & cells[f.name].try_cast(f.dataType).isNull(), F.lit(f.name)) for f in fields)))
    problem = F.when(F.size(wrong) > 0, F.concat(F.lit("type of "), F.array_join(wrong, ", "))).otherwise("number of fields")
    bad = lines.where("__record IS NOT NULL").select("source_file", F.col("__record").alias("record"), problem.alias("problem"))
    return good, bad


def read_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Many parquet files or folders as one table with merged columns and `source_file`."""
    df = spark.read.option("mergeSchema", "true").parquet(*paths)
    return df.withColumn("source_file", F.col("_metadata.file_name"))


def dated_files(
    spark: SparkSession, folder: str, glob: str = "*", date_pattern: str = r"(\d{2}\.\d{2}\.\d{4})", date_format: str = "dd.MM.yyyy",
) -> DataFrame:
    """Files below a folder with the day and the rest of their name: path, file, day, name.

    Only the listing is read, no file content. Dates are compared as dates, not as text.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder)
    file = F.element_at(F.split("path", "/"), -1)
    day = F.nullif(F.regexp_extract("file", date_pattern, 1), F.lit(""))
    name = F.regexp_replace(F.regexp_replace("file", r"\.[A-Za-z0-9]+$", ""), date_pattern, "")
    return listing.select("path", file.alias("file")).select(
        "path", "file", F.try_to_timestamp(day, F.lit(date_format)).cast("date").alias("day"), F.trim(F.translate(name, "_", " ")).alias("name"))


def within_day(date: str | Column, day: datetime.date | None) -> Column:
    """Rows of one day, as constant bounds on a date or timestamp column, so the scan is pruned."""
    if day is None:
        return F.lit(False)
    c = as_col(date)
    return (c >= F.lit(day)) & (c < F.lit(day + datetime.timedelta(days=1)))


def newest_days(df: DataFrame, date: str | Column, n: int = 1, as_of: str | None = None) -> list[datetime.date]:
    """The newest days of a date or timestamp column, newest first, up to a day; one grouped pass, run right away."""
    c = as_col(date)
    seen = df if as_of is None else df.where(c < F.date_add(F.lit(as_of).cast("date"), 1))
    days = seen.select(c.cast("date").alias("day")).where("day IS NOT NULL").distinct()
    return [r.day for r in days.orderBy(F.desc("day")).limit(n).collect()]


def latest_snapshot(df: DataFrame, date: str | Column, as_of: str | None = None) -> DataFrame:
    """Rows of the newest day, or of the newest day not after `as_of`; `date` may be a timestamp.

    The day is read first, so the main scan filters on constants.
    """
    days = newest_days(df, date, 1, as_of)
    return df.where(within_day(date, days[0] if days else None))


def trailing_period(df: DataFrame, date: str | Column, as_of: str, months: int = 0, days: int = 0) -> DataFrame:
    """Rows in the months and days before a fixed reference day, that whole day included.

    Both bounds are constants, so they reach the scan as pushed filters, for dates and timestamps.
    """
    last = F.lit(as_of).cast("date")
    start = F.date_sub(F.add_months(last, -months), days)
    return df.where((as_col(date) >= start) & (as_col(date) < F.date_add(last, 1)))


def union_sources(sources: dict[str, DataFrame], label: str = "source") -> DataFrame:
    """One table from many, aligned by column name, missing columns null, with provenance."""
    tagged = [df.withColumn(label, F.lit(name)) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def snapshot_pairs(df: DataFrame, key: list[str], day: str) -> DataFrame:
    """First and last day per key with the number of days; keys seen once have no pair."""
    days = df.groupBy(*key).agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day"),
        F.count_distinct(day).alias("n_days"),
    )
    return days.withColumn("has_pair", F.col("n_days") > 1)
