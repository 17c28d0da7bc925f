"""Shared folders, and where catalog tables keep their files."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
# Marks a char(n) or varchar(n) column in the schema of a table.
LIMITED_TEXT = "__CHAR_VARCHAR_TYPE_STRING"


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the one the cluster names in ``spark.checkpoint.dir``.
    Only a local session that names none gets a folder of its own."""
    context = spark.sparkContext
    base = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="loomwright-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def delete_dir(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def child_folders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders in a folder; none if it is not there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    return [s.getPath().getName() for s in system.listStatus(path) if s.isDirectory()]


def write_marker(spark: SparkSession, path: str) -> None:
    """An empty file, with the folder it is in."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, False).close()


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder. False, and nothing done, if the new name is taken."""
    jvm = spark.sparkContext._jvm
    old, new = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(old.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    overwrite_nothing = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(old, new, overwrite_nothing)
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    return True


def list_files(spark: SparkSession, folder: str, suffixes: tuple[str, ...], below: bool = False) -> list[str]:
    """Files (and folders that are written as one file is) of a folder in any file system
    that Spark reads; ``below`` looks into its folders, too."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, folders = [], [path]
    while folders:
        for status in system.listStatus(folders.pop()):
            name = status.getPath().toString()
            if name.endswith(suffixes):
                found.append(name)
            elif below and status.isDirectory():
                folders.append(status.getPath())
    return sorted(found)


def read_texts(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """Small text files, whole."""
    texts = {path: spark.read.text(path, wholetext=True).first() for path in paths}
    return {path: row[0].removeprefix("\ufeff") if row else "" for path, row in texts.items()}


@dataclass(frozen=True)
class TableFiles:
    location: str | None
    provider: str
    managed: bool
    plain: bool  # not partitioned or bucketed, and no type that only an insert enforces
    versioned: bool  # appends are folders of their own
    properties: Mapping[str, str]


def table_files(spark: SparkSession, table: str) -> TableFiles:
    info = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {table} AS JSON").head()[0])
    limited = any(LIMITED_TEXT in field.metadata for field in spark.table(table).schema)
    managed = info.get("type") == "MANAGED"
    plain = not (info.get("partition_columns") or info.get("bucket_columns") or limited)
    below = {k.lower(): v for k, v in (info.get("storage_properties") or {}).items()}.get("recursivefilelookup")
    return TableFiles(
        location=info.get("location"),
        provider=str(info.get("provider", "")).lower(),
        managed=managed,
        plain=plain,
        versioned=managed and plain and str(below).lower() == "true",
        properties=info.get("table_properties") or {},
    )
