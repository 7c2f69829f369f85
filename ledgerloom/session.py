"""Session helpers shared by tests, the benchmark and the sinks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str, cores: int | str = 8, partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .getOrCreate()
    )


def shared_base(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`, else the checkpoint folder of the context.

    Only a local master may do without; its context gets a temporary one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerloom-"))
    return spark.sparkContext.getCheckpointDir()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the session's own one in the shared folder."""
    return f"{shared_base(spark).rstrip('/')}/{_run_name(spark)}/{name}-{uuid.uuid4().hex}"


def _run_name(spark: SparkSession) -> str:
    return f"ledgerloom-{spark.sparkContext.applicationId}"


def clean_up(spark: SparkSession) -> None:
    """Delete all that this application has staged; tables read from there are gone with it."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_base(spark).rstrip('/')}/{_run_name(spark)}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """The table written once to the shared folder and read back; runs a job right away.

    For a result that several later steps read: they share the written copy instead of
    running its whole plan again, and a lost executor costs only the step at hand.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
