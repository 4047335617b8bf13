"""Publishing a model as a whole.

A run writes everything below a staging folder of the output. When all of it is there, a
mark names the staging folder, and the tables are moved into place one by one. A run that
fails before the mark leaves the former model as it is; one that is cut off after it is
finished by whoever comes next, since what still stands in the staging folder is what is
still to be moved. The list of tables in `_MODEL` tells which belong to the model.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from linkweave.session import delete_path
from linkweave.sources import tables

MARK, MODEL, STAGING = "_PUBLISHING", "_MODEL", "_staging"

# Where each table of a model is, below its output folder.
PATHS = {
    "log": "actions/log",
    "bad_lines": "actions/bad-lines",
    "users": "id-indexes/user-index",
    "items": "id-indexes/item-index",
    "dims": "id-indexes/dims",
    "counters": "id-indexes/counters",
    "active_users": "id-indexes/active-users",
    "prefs": "prefs/numbered",
    "prefs_text": "prefs/by-action",
    "prefs_other": "prefs/other",
    "p_history": "actions/p-action",
    "p_sims": "p-recs/sims",
    "p_recs": "p-recs/recs",
    "s_history": "actions/s-action",
    "s_sims": "s-recs/sims",
    "s_recs": "s-recs/recs",
    "item_links_docs": "item-links-docs",
    "user_history_docs": "user-history-docs",
}
DOCUMENTS = ("item_links_docs", "user_history_docs")


class _Folder:
    """The output folder and its file system."""

    def __init__(self, spark: SparkSession, out: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._jvm = spark._jvm
        self.out = out.rstrip("/")
        settings = spark.sparkContext._jsc.hadoopConfiguration()
        self.files = self._path(self.out).getFileSystem(settings)

    def at(self, name: str):
        return self._path(f"{self.out}/{name}")

    def has(self, name: str) -> bool:
        return self.files.exists(self.at(name))

    def write(self, name: str, value: dict) -> None:
        """A small file that is there as a whole or not at all."""
        fresh = f"{name}-{uuid.uuid4().hex}"
        stream = self.files.create(self.at(fresh))
        stream.write(bytearray(json.dumps(value).encode()))
        stream.close()
        self.files.delete(self.at(name), False)
        self.files.rename(self.at(fresh), self.at(name))

    def read(self, name: str) -> dict:
        stream = self.files.open(self.at(name))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def move(self, source: str, target: str) -> None:
        if not self.has(source):
            return
        self.files.delete(self.at(target), True)
        self.files.mkdirs(self.at(target).getParent())
        if not self.files.rename(self.at(source), self.at(target)):
            raise OSError(f"cannot move {self.out}/{source} to {target}")


def begin(spark: SparkSession, out: str) -> str:
    """A fresh staging folder; a publication that was cut off is finished first."""
    finish(spark, out)
    return f"{out.rstrip('/')}/{STAGING}-{uuid.uuid4().hex}"


def finish(spark: SparkSession, out: str) -> None:
    """Move what a marked staging folder still holds; nothing without a mark."""
    folder = _Folder(spark, out)
    if not folder.has(MARK):
        return
    mark = folder.read(MARK)
    for path in mark["tables"].values():
        folder.move(f"{mark['staging']}/{path}", path)
    # Tables of the former model that this one does not have.
    former = folder.read(MODEL)["tables"] if folder.has(MODEL) else {}
    for path in set(former.values()) - set(mark["tables"].values()):
        folder.files.delete(folder.at(path), True)
    folder.write(MODEL, {"tables": mark["tables"], "schemas": mark["schemas"]})
    folder.files.delete(folder.at(MARK), False)
    delete_path(spark, f"{folder.out}/{mark['staging']}")


def publish(
    spark: SparkSession, out: str, staging: str, result: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    """Put the staged tables in the place of the former model, and read them there."""
    folder = _Folder(spark, out)
    name = staging.rsplit("/", 1)[-1]
    staged = {t: path for t, path in PATHS.items() if folder.has(f"{name}/{path}")}
    schemas = {t: json.loads(df.schema.json()) for t, df in result.items() if t in staged}
    folder.write(MARK, {"staging": name, "tables": staged, "schemas": schemas})
    return read_model(spark, out)


def read_model(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The tables of the published model by name."""
    finish(spark, out)
    folder = _Folder(spark, out)
    if not folder.has(MODEL):
        raise ValueError(f"no model at {out}")
    model = folder.read(MODEL)
    found = {}
    for name, fields in model["schemas"].items():
        schema = StructType.fromJson(fields)
        path = f"{folder.out}/{model['tables'][name]}"
        if name in DOCUMENTS:
            found[name] = tables.read_documents(spark, path, schema)
        else:
            found[name] = spark.read.schema(schema).parquet(path)
    return found
