"""Session for local runs, and the shared place where intermediate tables are kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Scratch folder of each Spark application that this process has seen.
_ROOTS: dict[str, str] = {}


def local_session(cpus: int | str = "*", **settings: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    partitions = "8" if cpus == "*" else str(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("linkweave")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate data, as spark.checkpoint.dir names it.

    Where that is unset, a local session uses a folder of its warehouse; any other raises
    an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return configured.rstrip("/")


def _folder(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def scratch_root(spark: SparkSession) -> str:
    """The folder of this application below the shared one; it goes when the session ends."""
    application = spark.sparkContext.applicationId
    if application not in _ROOTS:
        root = f"{shared_dir(spark)}/linkweave-{uuid.uuid4().hex}"
        files, target = _folder(spark, root)
        files.mkdirs(target)
        files.deleteOnExit(target)
        _ROOTS[application] = root
    return _ROOTS[application]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library has written."""
    files, target = _folder(spark, path)
    files.delete(target, True)


def settled(df: DataFrame, name: str = "table") -> DataFrame:
    """Write `df` to the scratch folder once and read it back.

    Later jobs see the same rows and read only the columns they need, and a lost
    executor takes nothing with it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
