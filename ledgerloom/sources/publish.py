"""Publishing results so that a run may be repeated, may break, and may meet another writer.

A published folder has `data`, where every run writes below a name of its own, and `versions`, a
numbered file per publication that lists which data folder each result has. Readers go by the
newest complete version, so they see all results of a run or none, and what a broken run has left is
never read. A version file is created without overwriting: a writer that has read version n can
only create n + 1, so of two writers that read the same version one is refused.
"""

from __future__ import annotations

import datetime
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.dimensions import append_checked
from ledgerloom.session import staged


class Refused(RuntimeError):
    """Another writer has published since the version was read, or the data fail a check."""


@dataclass(frozen=True)
class Version:
    """What a folder holds: result name -> data folder. `number` 0 is nothing yet; `last` counts broken versions too."""

    number: int
    last: int
    results: dict[str, str]


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _content(spark: SparkSession, path: str) -> str:
    system, place = _file_system(spark, path)
    source = system.open(place)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def current(spark: SparkSession, path: str) -> Version:
    """The newest complete version; one whose writer broke off while it was written does not count."""
    system, place = _file_system(spark, f"{path}/versions")
    names = sorted((s.getPath().getName() for s in system.listStatus(place)), reverse=True) if system.exists(place) else []
    numbers = [int(n.split(".")[0]) for n in names if n.endswith(".json") and n.split(".")[0].isdigit()]
    for number in numbers:
        try:
            held = json.loads(_content(spark, f"{path}/versions/{number:012d}.json"))
        except ValueError:
            continue
        return Version(number, numbers[0], held["results"])
    return Version(0, numbers[0] if numbers else 0, {})


def _commit(spark: SparkSession, path: str, base: Version, results: dict[str, str]) -> Version:
    number = base.last + 1
    system, place = _file_system(spark, f"{path}/versions/{number:012d}.json")
    try:
        out = system.create(place, False)  # not over a file that is there
    except Exception as e:  # py4j wraps the file system's error
        if system.exists(place):
            raise Refused(f"{path} has been published since version {base.number} was read") from e
        raise
    try:
        out.write(bytearray(json.dumps({"results": results}, sort_keys=True).encode()))
    finally:
        out.close()
    return Version(number, number, results)


def publish(spark: SparkSession, path: str, results: dict[str, DataFrame], base: Version | None = None, keep: bool = True) -> Version:
    """Write named results and make them readable together; results of other names stay unless `keep` is false.

    `base` is the version that the results were made from; without it the one at hand counts.
    """
    base = current(spark, path) if base is None else base
    run, written = f"{path}/data/{uuid.uuid4().hex}", {}
    for i, (name, df) in enumerate(results.items()):
        written[name] = f"{run}/{i}"
        df.write.parquet(written[name])
    return _commit(spark, path, base, {**(base.results if keep else {}), **written})


def read_published(spark: SparkSession, path: str, name: str, version: Version | None = None) -> DataFrame:
    return spark.read.parquet((version or current(spark, path)).results[name])


def publish_history(df: DataFrame, path: str, run_date: str | datetime.date, base: Version | None = None) -> Version:
    """The rows of a run date in a history; a repeated run replaces them."""
    day = datetime.date.fromisoformat(str(run_date)).isoformat()
    return publish(df.sparkSession, path, {f"run_date={day}": df.withColumn("run_date", F.lit(day).cast("date"))}, base)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All runs of a history; columns that a run lacks are null."""
    folders = [folder for name, folder in sorted(current(spark, path).results.items()) if name.startswith("run_date=")]
    if not folders:
        return spark.createDataFrame([], "run_date date")
    return spark.read.option("mergeSchema", "true").parquet(*folders)


def publish_dimension(new: DataFrame, path: str, name: str, key: str) -> tuple[Version, DataFrame]:
    """Add the rows whose key a published dimension lacks; the version, and the rejected rows.

    Checked before: the keys of the dimension and those of the new rows that are to be added are given and unique. Checked
    after, on what was written: its rows are those of before and the added ones. Only then it is published, over the version
    that was read at the start.
    """
    spark = new.sparkSession
    base = current(spark, path)
    dim = read_published(spark, path, name, base) if name in base.results else new.limit(0)
    labelled = staged(append_checked(dim, new, key), "labelled")
    wanted = labelled.where("status <> 'conflict'").drop("status")
    facts = {r.status: r["count"] for r in labelled.groupBy("status").count().collect()}  # three labels
    repeated = wanted.groupBy(key).count().where(F.col(key).isNull() | (F.col("count") > 1)).limit(1).count()
    if repeated:
        raise Refused(f"{name} would have a missing or repeated {key}")
    place = f"{path}/data/{uuid.uuid4().hex}/0"
    wanted.write.parquet(place)
    expected = facts.get("existing", 0) + facts.get("added", 0)
    written = spark.read.schema(wanted.schema).parquet(place).count()
    if written != expected:
        raise Refused(f"{name} was written with {written} rows instead of {expected}")
    return _commit(spark, path, base, {**base.results, name: place}), labelled.where("status = 'conflict'").drop("status")
