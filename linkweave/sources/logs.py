"""Action logs: delimited text, one action per line."""

from __future__ import annotations

import re
import uuid
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from linkweave.functions.text import field_at

# Columns that give the place of a line in its log.
LINE_ORDER = ("src_file", "src_block", "src_line")


def is_regex(spark: SparkSession, pattern: str) -> bool:
    """Whether the pattern is a regular expression as Spark understands them."""
    try:
        spark._jvm.java.util.regex.Pattern.compile(pattern)
    except (Py4JJavaError, PySparkException):
        return False
    return True


def name_matches(spark: SparkSession, name: Column, pattern: str) -> Column:
    """Whether a file name is wanted: the pattern matches the whole name as a regex, or
    is part of a name that does not start like a system file."""
    part_of_name = F.contains(name, F.lit(pattern)) & ~name.rlike("^[_.~]")
    if not is_regex(spark, pattern):
        return part_of_name
    return name.rlike(f"^(?:{pattern})$") | part_of_name


def _is_file(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.exists(target) and files.getFileStatus(target).isFile()


def _decoded(name: Column) -> Column:
    """A file name as it is on disk; Spark gives it as part of a URI, where + is itself."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def _wanted(spark: SparkSession, name: str, pattern: str, regex: bool) -> bool:
    """`name_matches` for one name."""
    if regex and spark._jvm.java.util.regex.Pattern.matches(pattern, name):
        return True
    return pattern in name and name[0] not in "_.~"


def hidden_files(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Wanted files that Spark's own listing passes over: those with a `_` or `.` at the
    start of their name or of a directory above it.

    The tree is walked level by level with patterns for such names, so that only they come
    back from the file system's listing.
    """
    root = re.sub(r"([\[\]{}*?,^\\])", r"\\\1", path.rstrip("/"))
    of_path = spark._jvm.org.apache.hadoop.fs.Path
    files = of_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def listed(names: list[str]) -> list:
        return files.globStatus(of_path("/".join([root, *names]))) or []

    regex, found, depth = is_regex(spark, pattern), {}, 1
    while len(listed(["*"] * depth)):
        for place in range(depth):
            names = ["*"] * depth
            names[place] = "{_,.}*"
            for status in listed(names):
                if status.isFile() and _wanted(spark, status.getPath().getName(), pattern, regex):
                    found[status.getPath().toString()] = None
        depth += 1
    return list(found)


def scan_logs(spark: SparkSession, path: str, pattern: str = ".*tsv") -> DataFrame:
    """Lines of all wanted files below a directory, or of one named file.

    Names that start with `_` or `.` are wanted if the whole name matches the pattern.
    """
    if _is_file(spark, path):
        return scan_files(spark, [path])
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    name = _decoded(F.col("_metadata.file_name"))
    visible = _placed(lines.where(name_matches(spark, name, pattern)))
    hidden = hidden_files(spark, path, pattern)
    return visible.unionByName(scan_files(spark, hidden)) if hidden else visible


def _is_hidden(file: str) -> bool:
    return file.rsplit("/", 1)[-1][:1] in ("_", ".")


def _aliases(spark: SparkSession, files: list[str]) -> dict[str, str]:
    """Other names for files whose own names Spark would pass over: alias to file.

    They are links of a mount table in the session's file system settings, which all tasks
    get. Nothing is copied or renamed.
    """
    mount = f"linkweave-{uuid.uuid4().hex}"
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    of_path = spark._jvm.org.apache.hadoop.fs.Path
    aliases = {}
    for number, file in enumerate(files):
        target = of_path(file)
        system = target.getFileSystem(settings)
        whole = system.makeQualified(target).toUri().toString()
        # The end of the name tells how a file is compressed.
        link = f"{number}-{target.getName().lstrip('_.')}"
        settings.set(f"fs.viewfs.mounttable.{mount}.link./{link}", whole)
        aliases[f"viewfs://{mount}/{link}"] = whole
    return aliases


def scan_files(spark: SparkSession, files: list[str]) -> DataFrame:
    """Lines of files given one by one, whatever their names."""
    plain = [file for file in files if not _is_hidden(file)]
    parts = [_placed(spark.read.text(plain))] if plain else []
    aliases = _aliases(spark, [file for file in files if _is_hidden(file)])
    if aliases:
        names = spark.createDataFrame(
            [(alias.rsplit("/", 1)[-1], file) for alias, file in aliases.items()],
            "file_name string, __file string",
        )
        lines = _placed(spark.read.text(list(aliases))).join(F.broadcast(names), "file_name")
        parts.append(
            lines.select(
                _decoded(F.substring_index("__file", "/", -1)).alias("file_name"),
                F.col("__file").alias("src_file"),
                "src_block",
                "src_line",
                "value",
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _placed(lines: DataFrame) -> DataFrame:
    """Lines with their file and an order key within the log."""
    return lines.select(
        _decoded(F.col("_metadata.file_name")).alias("file_name"),
        F.col("_metadata.file_path").alias("src_file"),
        F.col("_metadata.file_block_start").alias("src_block"),
        F.monotonically_increasing_id().alias("src_line"),
        "value",
    )


def _parsed(
    lines: DataFrame,
    delim: str,
    user_col: int,
    action_col: int,
    item_col: int,
    ts_col: int,
    keep_empty_ids: bool,
    ts_type: str,
    value_col: int,
) -> DataFrame:
    wanted = {"user_id": user_col, "action": action_col, "item_id": item_col}
    if ts_col >= 0:
        wanted["ts"] = ts_col
    if value_col >= 0:
        wanted["value"] = value_col
    order = [c for c in LINE_ORDER if c in lines.columns]
    # As a generated column the split is done once, not again in the filter for bad lines.
    split = lines.select(
        *order,
        F.col("value").alias("raw"),
        F.explode(F.array(F.split("value", delim))).alias("__fields"),
    )
    fields = F.col("__fields")
    rows = split.select(
        *[field_at(fields, k).alias(name) for name, k in wanted.items()], *order, "raw"
    )
    if ts_col >= 0:
        rows = rows.withColumn("ts", F.col("ts").try_cast(ts_type))
    if value_col >= 0:
        rows = rows.withColumn("value", F.col("value").try_cast("double"))
    bad = F.lit(False)
    for name in wanted:
        bad = bad | F.col(name).isNull()
    if not keep_empty_ids:
        bad = bad | (F.col("user_id") == "") | (F.col("item_id") == "")
    return rows.withColumn("__bad", F.coalesce(bad, F.lit(True)))


def parse_logs(
    lines: DataFrame,
    delim: str = "\t",
    user_col: int = 0,
    action_col: int = 1,
    item_col: int = 2,
    ts_col: int = -1,
    on_bad_line: str = "fail",
    keep_empty_ids: bool = False,
    ts_type: str = "bigint",
    value_col: int = -1,
    seen: Observation | None = None,
) -> DataFrame:
    """Actions (user_id, action, item_id[, ts][, value], place in the log, raw) from lines.

    The lines are in the column `value`. The delimiter is a regex, and fields are trimmed.
    A line that lacks a column, or has an empty id, a time that is no `ts_type` or a value
    that is no number, stops the job (`fail`) or is left out (`drop`, `quarantine`; see
    `bad_lines` for the lines set aside). `seen` observes n_lines and n_bad_lines.
    """
    if on_bad_line not in ("fail", "drop", "quarantine"):
        raise ValueError(f"unknown on_bad_line {on_bad_line!r}")
    rows = _parsed(
        lines, delim, user_col, action_col, item_col, ts_col, keep_empty_ids, ts_type, value_col
    )
    if seen is not None:
        rows = rows.observe(
            seen,
            F.count(F.lit(1)).alias("n_lines"),
            F.count_if(F.col("__bad")).alias("n_bad_lines"),
        )
    if on_bad_line == "fail":
        complaint = F.raise_error(F.concat(F.lit("bad log line: "), F.col("raw")))
        good = F.when(F.col("__bad"), complaint.cast("boolean")).otherwise(F.lit(True))
    else:
        good = ~F.col("__bad")
    return rows.where(good).drop("__bad")


def bad_lines(
    lines: DataFrame,
    delim: str = "\t",
    user_col: int = 0,
    action_col: int = 1,
    item_col: int = 2,
    ts_col: int = -1,
    keep_empty_ids: bool = False,
    ts_type: str = "bigint",
    value_col: int = -1,
) -> DataFrame:
    """The lines `parse_logs` leaves out."""
    rows = _parsed(
        lines, delim, user_col, action_col, item_col, ts_col, keep_empty_ids, ts_type, value_col
    )
    return rows.where("__bad").select(*[c for c in LINE_ORDER if c in rows.columns], "raw")


def line_order() -> Column:
    """Order key of the lines of a scanned log."""
    return F.struct(*LINE_ORDER)
