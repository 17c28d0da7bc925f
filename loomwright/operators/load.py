"""Writing to catalog tables.

A table that this library creates has its rows in one folder, and in that folder each append in
a folder of its own, ``v000001``, ``v000002`` and so on. An append is written aside and then
renamed to the next number. Only one writer can take a number, so whoever comes second sees
what the first one added and looks again, and readers see an append whole or not at all. A
replace takes the next number too, which closes the folder, and points the table to a new one.
Folders that were replaced are kept for a while, for readers that are not done with them.
"""

from __future__ import annotations

import json
import re
import threading
import time
import uuid
from collections.abc import Collection, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.identifiers import literal
from ..paths import child_folders, delete_dir, exists, rename_new, shared_dir, table_files, write_marker
from ..session import setting
from .constraints import Constraints, demand_absent, demand_unique, guarded, of_table, to_property
from .dedup import only_new

REPOINTABLE = ("parquet", "orc")
# How long replaced rows are kept for readers, unless a load says otherwise.
RETENTION = timedelta(days=1)
RETIRED = "loomwright.retired"
_CLOSED = "_closed"  # marks a version that closes its folder
_NUMBER = re.compile(r"v(\d{6,})")
# How often, and after how many seconds, to look again for the folder that a replace points to.
LOOKS, PAUSE = 50, 0.1

# A rename to a new name is one step in HDFS. Where it is two, as on a local disk, writers of this
# process at least take turns.
_renaming = threading.Lock()


class ConcurrentLoadError(RuntimeError):
    pass


def ensure_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")


def ensure_table(
    spark: SparkSession,
    table: str,
    columns: T.StructType,
    description: str | None = None,
    primary_key: Sequence[str] = (),
    required: Collection[str] = (),
) -> T.StructType:
    """Create the table unless it exists, and return its columns. Those of an existing table are
    never altered, nor what it demands of its rows."""
    if not spark.catalog.tableExists(table):
        # One statement, so that loads at once see the table with its constraints or not at all.
        fields = [
            f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}"
            + (f" COMMENT {literal(f.metadata['comment'])}" if f.metadata.get("comment") else "")
            for f in columns
        ]
        properties = [f"{literal(name)} = {literal(value)}" for name, value in to_property(primary_key, required).items()]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(fields)}) USING parquet OPTIONS (recursiveFileLookup = 'true') "
            f"COMMENT {literal(description or '')}" + (f" TBLPROPERTIES ({', '.join(properties)})" if properties else "")
        )
    return spark.table(table).schema


def _versions(spark: SparkSession, location: str) -> list[int]:
    found = [_NUMBER.fullmatch(name) for name in child_folders(spark, location)]
    return sorted(int(m[1]) for m in found if m)


def _version_dir(location: str, version: int) -> str:
    return f"{location}/v{version:06d}"


def _aside(location: str) -> str:
    """A folder beside that of the table, which no reader sees."""
    return f"{location}__aside_{uuid.uuid4().hex[:12]}"


def _take(spark: SparkSession, staged: str, location: str, version: int) -> bool:
    """Rename a folder to a version, unless there is one already."""
    with _renaming:
        return rename_new(spark, staged, _version_dir(location, version))


def _open_folder(spark: SparkSession, table: str) -> tuple[str, int]:
    """The folder of the table and its last version. While a replace has closed the folder and not
    yet pointed the table to the new one, this waits."""
    for _ in range(LOOKS):
        location = table_files(spark, table).location.rstrip("/")
        versions = _versions(spark, location)
        if not versions or not exists(spark, f"{_version_dir(location, versions[-1])}/{_CLOSED}"):
            return location, versions[-1] if versions else 0
        time.sleep(PAUSE)
    raise ConcurrentLoadError(f"a replace of {table} closed {location} and did not end; replace the table again")


def _as_table(df: DataFrame, columns: T.StructType) -> DataFrame:
    """The columns of ``df``, in order, by the names and types of the table, as an insert takes them."""
    named = df.toDF(*columns.names)
    return named.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in columns])


def _commit(df: DataFrame, table: str, keys: Sequence[str], limits: Constraints) -> None:
    """Append ``df`` in one step. Rows with ``keys`` that the table holds are left out; keys that the
    table demands to be unique, and are not, are an error."""
    spark = df.sparkSession
    schema, provider = spark.table(table).schema, table_files(spark, table).provider
    strict = limits.key if set(limits.key) != set(keys) else ()

    def read(*paths: str) -> DataFrame:
        return spark.read.schema(schema).format(provider).option("recursiveFileLookup", True).load(list(paths))

    while True:
        # The number is looked up before the rows are read, so rows that come in between are seen twice, not missed.
        location, last = _open_folder(spark, table)
        staged = _aside(location)
        paths = [staged]
        try:
            rows = only_new(df, read(location), keys) if keys else df
            rows.write.format(provider).save(staged)
            if strict:
                demand_unique(read(staged), strict, table)
                demand_absent(read(staged), read(location).select(*strict), strict, table)
            while not read(staged).isEmpty():
                if _take(spark, staged, location, last + 1):
                    break
                now, upto = _open_folder(spark, table)
                if now != location:
                    break
                # Only what others have added since has to be looked at.
                added = read(*[_version_dir(location, v) for v in range(last + 1, upto + 1)])
                if strict:
                    demand_absent(read(staged), added, strict, table)
                if keys:
                    paths.append(_aside(location))
                    only_new(read(staged), added, keys).write.format(provider).save(paths[-1])
                    staged = paths[-1]
                last = upto
            else:
                return
            if not exists(spark, staged):
                return
        finally:
            for path in paths:
                delete_dir(spark, path)
            spark.catalog.refreshTable(table)


def append(df: DataFrame, table: str) -> None:
    """Add rows; ``df`` has the columns of the table in order. Rows that the table does not take are an
    error, and none is added. Several writers may append at once to a table of this library."""
    append_absent(df, table, ())


def append_absent(df: DataFrame, table: str, keys: Sequence[str]) -> None:
    """Add the rows whose key the table does not hold; rows it holds are never changed.
    ``df`` has one row per key, and the columns of the table in order. Of several writers at once
    the first one to finish adds a key, and the others leave it out."""
    spark = df.sparkSession
    files = table_files(spark, table)
    limits = of_table(files)
    df = guarded(_as_table(df, spark.table(table).schema), limits)
    if files.versioned:
        _commit(df, table, keys, limits)
        return
    # In a table of another layout the check and the append are two steps.
    if keys:
        df = only_new(df, spark.table(table), keys)
    if limits.key and set(limits.key) != set(keys):
        demand_unique(df, limits.key, table)
        demand_absent(df, spark.table(table), limits.key, table)
    df.write.insertInto(table)


def _retired(spark: SparkSession, table: str) -> list[tuple[str, datetime]]:
    found = json.loads(table_files(spark, table).properties.get(RETIRED, "[]"))
    return [(path, datetime.fromisoformat(at)) for path, at in found]


def _set_retired(spark: SparkSession, table: str, folders: Sequence[tuple[str, datetime]]) -> None:
    value = json.dumps([[path, at.isoformat()] for path, at in folders])
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{RETIRED}' = {literal(value)})")


def expire_snapshots(spark: SparkSession, table: str, older_than: timedelta = timedelta(0)) -> int:
    """Delete what was replaced longer ago than ``older_than``; readers that still need it fail.
    Returns how many snapshots went."""
    current = (table_files(spark, table).location or "").rstrip("/")
    until = datetime.now(timezone.utc) - older_than
    folders = [(path, at) for path, at in _retired(spark, table) if path != current]
    old = [path for path, at in folders if at <= until]
    for path in old:
        delete_dir(spark, path)
    if old:
        _set_retired(spark, table, [(path, at) for path, at in folders if path not in old])
    return len(old)


def _close(spark: SparkSession, location: str) -> None:
    """Let nobody append to a folder any more; whoever is about to takes the new one."""
    marker = _aside(location)
    write_marker(spark, f"{marker}/{_CLOSED}")
    while not _take(spark, marker, location, max(_versions(spark, location), default=0) + 1):
        pass


def replace(df: DataFrame, table: str, unique_on: Sequence[str] = (), retention: timedelta = RETENTION) -> None:
    """Make ``df`` the content of the table.

    The rows are written once, to a new folder, and the table is pointed to it when
    all are there and fit what the table demands: a load that fails on its last row leaves the old
    content as it was, and a reader of the old content finishes on it. What was replaced longer ago
    than ``retention`` is deleted. ``unique_on`` names columns that are known to be a key of ``df``.

    Tables laid out by someone else (external, partitioned, bucketed, another
    format, columns of limited length) keep their folder; there the rows are written aside first, so that casts
    and guards are through before the overwrite begins."""
    spark = df.sparkSession
    files = table_files(spark, table)
    limits = of_table(files)
    df = guarded(df, limits)
    check = limits.key if limits.key and set(limits.key) != set(unique_on) else ()
    if files.managed and files.plain and files.provider in REPOINTABLE:
        home = re.sub(r"__load_[0-9a-f]{12}$", "", files.location.rstrip("/"))
        fresh = f"{home}__load_{uuid.uuid4().hex[:12]}"
        try:
            df.write.format(files.provider).save(fresh)
            if check:
                demand_unique(spark.read.schema(df.schema).format(files.provider).load(fresh), check, table)
        except Exception:
            delete_dir(spark, fresh)
            raise
        # Another load may have replaced the rows in the meantime.
        location = table_files(spark, table).location.rstrip("/")
        if files.versioned:
            _close(spark, location)
        _set_retired(spark, table, [*_retired(spark, table), (location, datetime.now(timezone.utc))])
        spark.sql(f"ALTER TABLE {table} SET LOCATION {literal(fresh)}")
        spark.catalog.refreshTable(table)
        expire_snapshots(spark, table, retention)
        return
    staged = shared_dir(spark, "staged")
    try:
        df.write.parquet(staged)
        rows = spark.read.schema(df.schema).parquet(staged)
        if check:
            demand_unique(rows, check, table)
        # All partitions go, also those that get no new row.
        with setting(spark, "spark.sql.sources.partitionOverwriteMode", "static"):
            rows.write.insertInto(table, overwrite=True)
    finally:
        delete_dir(spark, staged)
