"""Outputs of dated runs, found by their names in a folder listing and profiled together.

A run leaves its outputs as files or folders whose names carry the run's day and what they hold,
such as `2024-01-31_liquidity_daily`. Only listings are read to pair them. Their schemas come from
the files' footers, read by tasks, and their profiles from as few scans as schemas allow: outputs
whose columns do not contradict each other share a scan, whatever their number.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.session import staged
from ledgerloom.sources.tables import literal_table

DATE, DATE_FORMAT = r"(\d{4}-\d{2}-\d{2})", "yyyy-MM-dd"
SCAN_COLUMNS = 256


def list_outputs(spark: SparkSession, folder: str, pattern: str = DATE, date_format: str = DATE_FORMAT, glob: str = "*.parquet") -> DataFrame:
    """One row per data file below a folder: path, uri, size, output (first part of its path there), day, name.

    An output is a file or a folder of part files; `key=` in front of a folder's value and a
    file's extension are not part of its name. No content is read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder)
    files = files.select("path", F.col("_metadata.file_path").alias("uri"), F.col("length").alias("size"))
    base = re.sub(r"^[A-Za-z][\w+.-]*:/*", "", folder).strip("/") + "/"
    first = F.substring_index(F.expr(f"substring(path, instr(path, {_quoted(base)}) + {len(base)})"), "/", 1)
    found = files.withColumn("output", first).withColumn("__name", F.coalesce(F.try_url_decode(F.replace(first, F.lit("+"), F.lit("%2B"))), first))
    stem = F.regexp_replace(F.regexp_replace("__name", "^[^=/]*=", ""), r"\.(parquet|csv|txt|json|orc)$", "")
    day = F.nullif(F.regexp_extract(stem, pattern, 1), F.lit(""))
    name = F.trim(F.regexp_replace(F.regexp_replace(stem, pattern, ""), "_+", " "))
    return found.select("path", "uri", "size", "output", F.try_to_timestamp(day, F.lit(date_format)).cast("date").alias("day"), name.alias("name"))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def pair_outputs(files: DataFrame) -> DataFrame:
    """One row per name: its two newest days and their outputs, how many days it has, and `paired`.

    Of several outputs of one name and day the last by name counts. Outputs without a day are left out.
    """
    outputs = files.where(F.col("day").isNotNull()).groupBy("name", "day").agg(F.max("output").alias("output"))
    newest = F.reverse(F.array_sort(F.collect_list(F.struct("day", "output"))))  # the days of one name
    rows = outputs.groupBy("name").agg(newest.alias("runs"), F.count(F.lit(1)).alias("n_days"))
    last, before = F.get("runs", F.lit(0)), F.get("runs", F.lit(1))
    return rows.select("name", "n_days", before["day"].alias("old_day"), before["output"].alias("old_output"), last["day"].alias("new_day"),
                       last["output"].alias("new_output"), (F.col("n_days") > 1).alias("paired"))


def day_pairs(files: DataFrame, apart: int | None = None) -> DataFrame:
    """Every ordered pair of days of a name, old before new, at most `apart` days between them if given."""
    outputs = files.where(F.col("day").isNotNull()).groupBy("name", "day").agg(F.max("output").alias("output"))
    old, new = (outputs.select("name", F.col("day").alias(f"{s}_day"), F.col("output").alias(f"{s}_output")) for s in ("old", "new"))
    near = F.col("old_day") < F.col("new_day")
    if apart is not None:
        near &= F.date_diff("new_day", "old_day") <= apart
    return old.join(new, "name").where(near)


def file_schemas(files: DataFrame) -> DataFrame:
    """(uri, path, position, column, type) of every column of Parquet files, from their footers; Spark's type names.

    Footers are read by tasks through the file systems that Arrow knows.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        from pyarrow import fs
        from pyspark.sql.pandas.types import from_arrow_type

        unsigned = {pa.uint8(): "smallint", pa.uint16(): "int", pa.uint32(): "bigint", pa.uint64(): "decimal(20,0)"}

        def name(kind: pa.DataType) -> str:
            if pa.types.is_timestamp(kind) and kind.unit == "ns" and kind.tz is None:
                return "timestamp"  # how Arrow shows the old 96-bit timestamps
            return unsigned.get(kind) or from_arrow_type(kind, prefer_timestamp_ntz=True).simpleString()

        for batch in batches:
            rows = []
            for uri, path in zip(*(batch.column(c).to_pylist() for c in ("uri", "path"))):
                system, place = fs.FileSystem.from_uri(uri)
                with system.open_input_file(place) as source:
                    schema = pq.read_schema(source)
                rows += [(uri, path, i, f.name, name(f.type)) for i, f in enumerate(schema)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int32(), pa.string(), pa.string()))],
                                                 ["uri", "path", "position", "column", "type"])

    paths = files.select("uri", "path").distinct()
    return staged(paths.repartition("uri").mapInArrow(read, "uri string, path string, position int, column string, type string"), "schemas")


def _scans(schemas: DataFrame) -> list[tuple[list[tuple[str, str]], list[str]]]:
    """(columns with types, paths) of scans over files whose columns do not contradict each other.

    The driver sees one row per distinct schema, and the paths that the scans are given.
    """
    columns = F.array_sort(F.collect_list(F.struct("position", "column", "type")))
    per_file = schemas.groupBy("path").agg(columns.alias("columns"))
    distinct = per_file.select(F.transform("columns", lambda c: F.struct(c["column"].alias("column"), c["type"].alias("type"))).alias("columns"), "path")
    grouped = distinct.groupBy("columns").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    scans: list[tuple[dict[str, str], list[str]]] = []
    for row in sorted(grouped, key=lambda r: (-len(r.columns), r.paths[0])):
        own = {c.column: c.type for c in row.columns}
        for held, paths in scans:
            if all(held.get(c, t) == t for c, t in own.items()) and len(held | own) <= max(SCAN_COLUMNS, len(own)):
                held.update(own)
                paths += row.paths
                break
        else:
            scans.append((dict(own), list(row.paths)))
    return [(list(held.items()), paths) for held, paths in scans]


def _read(spark: SparkSession, columns: list[tuple[str, str]], paths: list[str]) -> DataFrame:
    schema = ", ".join(f"`{c.replace('`', '``')}` {t}" for c, t in columns)
    return spark.read.schema(T.StructType.fromDDL(schema)).parquet(*paths)


def _number(name: str, kind: str) -> Column:
    plain = kind.startswith(("tinyint", "smallint", "int", "bigint", "float", "double", "decimal", "string"))
    return F.col(f"`{name}`").try_cast("double") if plain else F.lit(None).cast("double")


def profile_outputs(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Column profile of all outputs: output, column, type, n_columns, nulls, sum, rows, zero_rows.

    Rows are grouped by file and by how many of their columns are zero, so an all-zero row is known
    although outputs of a scan differ in their columns. A column that the files of one output type
    differently has all its types, joined by `|`.
    """
    schemas = file_schemas(files)
    outputs = files.select("uri", "output").distinct()
    own = schemas.join(outputs, "uri").groupBy("output", "column").agg(F.array_join(F.array_sort(F.collect_set("type")), "|").alias("type"))
    widths = own.groupBy("output").agg(F.count(F.lit(1)).cast("int").alias("n_columns"))
    listed = own.join(widths, "output")
    parts = []
    for columns, paths in _scans(schemas):
        zeros = reduce(lambda a, b: a + b, [F.coalesce((_number(c, t) == 0).cast("int"), F.lit(0)) for c, t in columns])
        counted = _read(spark, columns, paths).groupBy(F.col("_metadata.file_path").alias("uri"), zeros.alias("zeros")).agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.count(F.col(f"`{c}`")).alias(f"__n{i}") for i, (c, _) in enumerate(columns)],
            *[F.sum(_number(c, t)).alias(f"__s{i}") for i, (c, t) in enumerate(columns)])
        lines = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"__n{i}").alias("filled"), F.col(f"__s{i}").alias("sum"))
                          for i, (c, _) in enumerate(columns)])
        parts.append(counted.select("uri", "zeros", "rows", F.explode(lines).alias("l")).select("uri", "zeros", "rows", "l.*"))
    none = F.lit(0).cast("long")
    if parts:
        long = reduce(DataFrame.unionByName, parts).join(schemas.select("uri", "column"), ["uri", "column"], "left_semi")  # what a file has
        long = long.join(outputs, "uri").join(widths, "output")
        figures = long.groupBy("output", "column").agg(
            F.sum(F.col("rows") - F.col("filled")).alias("nulls"), F.sum("sum").alias("sum"), F.sum("rows").alias("rows"),
            F.sum(F.when(F.col("zeros") == F.col("n_columns"), F.col("rows"))).alias("zero_rows"))
        listed = listed.join(figures, ["output", "column"], "left")  # files without rows have no figures
    else:
        listed = listed.withColumns({"nulls": none, "sum": F.lit(0.0), "rows": none, "zero_rows": none})
    return listed.select("output", "column", "type", "n_columns", F.coalesce("nulls", none).alias("nulls"), F.coalesce("sum", F.lit(0.0)).alias("sum"),
                         F.coalesce("rows", none).alias("rows"), F.coalesce("zero_rows", none).alias("zero_rows"))


def common_type(types: list[str]) -> str:
    """The narrowest of a few types that holds the values of all: whole numbers, doubles, decimals of one kind, else text."""
    kinds = sorted(set(types))
    whole = ["tinyint", "smallint", "int", "bigint"]
    if len(kinds) == 1:
        return kinds[0]
    if all(k in whole for k in kinds):
        return max(kinds, key=whole.index)
    if all(k in [*whole, "float", "double"] or k.startswith("decimal") for k in kinds):
        return "double"
    if set(kinds) <= {"date", "timestamp_ntz"}:
        return "timestamp_ntz"
    return "string"


def read_reconciled(spark: SparkSession, files: DataFrame, wanted: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Files of one table whose columns and types differ: (rows, conflicts, rejected).

    Every file is read with its own types; columns are widened to a common type, or cast to the
    `wanted` one; a column that a file lacks is null. `rows` have `source_file` and `source_row`, their
    file's name and place in it. `conflicts` lists columns with several types and the files of each:
    column, type, files, common. `rejected` lists values that do not cast: source_file, source_row,
    column, value; their cells in `rows` are null.
    """
    schemas = file_schemas(files)
    kinds = schemas.groupBy("column", "type").agg(F.count_distinct("path").alias("files"), F.min("position").alias("position"))
    seen: dict[str, list] = {}
    for r in sorted(kinds.collect(), key=lambda r: (r.position, r.column, r.type)):  # one row per column and type
        seen.setdefault(r.column, []).append(r)
    target = {c: (wanted or {}).get(c) or common_type([r.type for r in rs]) for c, rs in seen.items()}
    rows, rejected = [], []
    for columns, paths in _scans(schemas):
        held = dict(columns)
        place = [F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.row_index").alias("source_row")]
        read = _read(spark, columns, paths).select(*place, F.struct(*(F.col(f"`{c}`") for c in held)).alias("r"))
        cells = {c: F.col("r").getField(c) for c in held}
        rows.append(read.select("source_file", "source_row", *(
            (cells[c].try_cast(t) if c in held else F.lit(None).cast(t)).alias(c) for c, t in target.items())))
        risky = [c for c in held if held[c] != target[c]]
        if risky:
            bad = F.array_compact(F.array(*(F.when(cells[c].isNotNull() & cells[c].try_cast(target[c]).isNull(), F.struct(
                F.lit(c).alias("column"), cells[c].cast("string").alias("value"))) for c in risky)))
            rejected.append(read.select("source_file", "source_row", F.explode(bad).alias("b")).select("source_file", "source_row", "b.*"))
    lines = [(c, r.type, r.files, target[c]) for c, rs in seen.items() if len({x.type for x in rs} | {target[c]}) > 1 for r in rs]
    conflicts = literal_table(spark, lines, "column string, type string, files bigint, common string")
    none = spark.createDataFrame([], "source_file string, source_row long, column string, value string")
    whole = reduce(DataFrame.unionByName, rows) if rows else spark.createDataFrame([], "source_file string, source_row long")
    return whole, conflicts, reduce(DataFrame.unionByName, rejected, none)
