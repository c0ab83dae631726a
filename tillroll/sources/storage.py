"""Small files on the warehouse's file system, and logs made of them.

Data files are written by Spark jobs and say nothing by being there. What
counts is a log: a folder of numbered JSON entries, each of which appears
whole or not at all and never twice under one number. A writer puts its data
into a folder of its own, then appends the entry that names it; readers follow
the entries. A job killed at any point leaves a folder that no entry names.

Everything goes through Hadoop's file system of the path, on the driver.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LOG_FOLDER = "_log"
# stores without a rename of their own: a file appears there when it is closed,
# and a create that must not overwrite is checked by the store itself
OBJECT_STORES = ("s3", "s3a", "s3n", "gs", "oss", "cosn")


class CommitConflict(RuntimeError):
    """Another run committed first; what this run read is out of date."""


def _open(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    _, at, fs = _open(spark, path)
    return fs.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; nothing happens if there is none."""
    _, at, fs = _open(spark, path)
    fs.delete(at, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    _, at, fs = _open(spark, path)
    if not fs.exists(at):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(at))


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Put a whole file at ``path`` unless there is one. False if there was.

    Of any number of callers one gets True: on a local disk by a hard link, on
    HDFS-like systems by a rename that doesn't replace, on object stores by a
    conditional create.
    """
    jvm, at, fs = _open(spark, path)
    scheme = fs.getUri().getScheme()
    fs.mkdirs(at.getParent())
    if scheme == "file":
        return _link_new(at.toUri().getPath(), text)
    if fs.exists(at):
        return False
    if scheme in OBJECT_STORES:
        return not _already(lambda: _write(jvm, fs, at, text))
    return _rename_new(spark, path, text)


def _link_new(path: str, text: str) -> bool:
    draft = f"{os.path.dirname(path)}/.{uuid.uuid4().hex}"
    with open(draft, "w", encoding="utf-8") as f:
        f.write(text)
        f.flush()
        os.fsync(f.fileno())
    try:
        os.link(draft, path)
        return True
    except FileExistsError:
        return False
    finally:
        os.unlink(draft)


def _rename_new(spark: SparkSession, path: str, text: str) -> bool:
    jvm, at, fs = _open(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{uuid.uuid4().hex}")
    _write(jvm, fs, draft, text)
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    if _already(lambda: context.rename(draft, at, options)):
        fs.delete(draft, False)
        return False
    return True


def _write(jvm, fs, at, text: str) -> None:
    out = fs.create(at, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def _already(act) -> bool:
    """Whether ``act`` failed because the file is there; other failures are raised."""
    try:
        act()
        return False
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return True
        raise


@dataclass
class CommitLog:
    """Numbered entries in ``path/_log``, from 1 on without gaps."""

    spark: SparkSession
    path: str

    @property
    def folder(self) -> str:
        return f"{self.path.rstrip('/')}/{LOG_FOLDER}"

    def entries(self) -> list[dict]:
        """All entries in order, with their number as ``version``.

        An entry that can't be read is an error, never a missing one. One
        small row for each commit comes to the driver.
        """
        if not any(n.endswith(".json") for n in names(self.spark, self.folder)):
            return []
        files = (self.spark.read.text(f"{self.folder}/*.json", wholetext=True)
                 .select("value", F.col("_metadata.file_name").alias("name")).collect())
        out = [json.loads(r["value"]) | {"version": int(r["name"].split(".")[0])} for r in files]
        return sorted(out, key=lambda e: e["version"])

    def version(self) -> int:
        """Number of the last entry, 0 for an empty log."""
        return max((int(n.split(".")[0]) for n in names(self.spark, self.folder) if n.endswith(".json")), default=0)

    def commit(self, entry: dict, after: int) -> int:
        """Append ``entry`` if ``after`` is still the last number; its own number."""
        if self.version() != after or not create_new(self.spark, f"{self.folder}/{after + 1:020d}.json", json.dumps(entry)):
            raise CommitConflict(f"{self.path}: version {after + 1} was committed by another run")
        return after + 1


def read_folders(spark: SparkSession, root: str, folders: list[str], schema: StructType) -> DataFrame:
    """The Parquet files below ``root`` in ``folders``, their folder names read as columns where ``schema`` has them."""
    if not folders:
        return spark.createDataFrame([], schema)
    root = root.rstrip("/")
    return (spark.read.schema(schema).option("basePath", root)
            .parquet(*[f"{root}/{f}" for f in folders]).select(*schema.fieldNames()))
