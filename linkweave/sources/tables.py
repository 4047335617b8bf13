"""Published tables: matrices, dictionaries, preferences and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# How a null is written in a CSV file, so that an empty field stays empty.
NULL = "\\N"


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Write Parquet over this one output and read it back, which also cuts the plan."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """A matrix table; one without any row is an error."""
    matrix = spark.read.parquet(path)
    if matrix.isEmpty():
        raise ValueError(f"no matrix rows at {path}")
    return matrix


def rename_parts(spark: SparkSession, folder: str, target: str, name: str) -> list[str]:
    """Move the part files of a folder to another one; `name` takes their numbers."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path(target))
    moved = []
    for number, status in enumerate(files.globStatus(path(f"{folder}/part-*"))):
        moved.append(f"{target}/{name.format(number)}")
        files.rename(status.getPath(), path(moved[-1]))
    return moved


def write_dictionary(dictionary: DataFrame, path: str) -> DataFrame:
    return write_table(dictionary.select("ext_id", "int_id"), path)


def write_dictionary_text(dictionary: DataFrame, path: str, delim: str = "\t") -> None:
    """`ext<delim>int` lines, quoted only where an id holds the delimiter."""
    dictionary.select("ext_id", "int_id").write.mode("overwrite").csv(path, sep=delim)


def read_dictionary_text(spark: SparkSession, path: str, delim: str = "\t") -> DataFrame:
    return spark.read.schema("ext_id string, int_id bigint").csv(path, sep=delim)


def write_prefs_text(prefs: DataFrame, path: str, delim: str = "\t") -> None:
    """`user<delim>item<delim>1.0` lines in one directory per value of `action_dir`."""
    line = F.concat_ws(delim, "user_int", "item_int", F.col("weight").cast("string"))
    prefs.select("action_dir", line.alias("value")).write.mode("overwrite").partitionBy(
        "action_dir"
    ).text(path)


def read_prefs_text(spark: SparkSession, path: str, delim: str = "\t") -> DataFrame:
    schema = "user_int bigint, item_int bigint, weight double, action_dir string"
    return spark.read.schema(schema).csv(path, sep=delim)


def write_documents(docs: DataFrame, path: str) -> None:
    """CSV with a header in every part file, one directory per document part.

    Documents of at most one part, which is nearly all, are in `part=0`.
    """
    docs.write.mode("overwrite").partitionBy("part").option("header", True).csv(
        path, nullValue=NULL
    )


def read_documents(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Documents as they were written; an empty field is empty, not null."""
    return spark.read.schema(schema).option("header", True).csv(path, nullValue=NULL)
