"""The CSV scan.

Fields come out as text: an empty field is null, a quoted empty field is the
empty string, quotes are doubled, a backslash is just a character, and quoted
fields may hold line breaks. A record with too few or too many fields fails.

Spark's reader splits a file only at line breaks, so files without line breaks in
fields go to it as they are, and the others have their lines put together to
records first. A large file is read by many tasks; a compressed one, which cannot be
split, by one, but all work behind that reading is spread.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.identifiers import normalise_all
from ..paths import shared_dir
from ..session import fit_shuffle

# `nullValue` is a character no text file holds: only then does Spark keep an empty
# field (null) apart from a quoted empty one.
DIALECT = {"sep": ",", "quote": '"', "escape": '"', "nullValue": "\u0000", "mode": "FAILFAST"}

FILE, BLOCK, GROUP, LINE = "__file", "__block", "__group", "__line"
# The text of a record that is malformed, where that is asked for.
MALFORMED = "__malformed"
TOLERANT = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}

# Lines that are put together at once. A file that cannot be split is one block, but many groups.
GROUP_LINES = 100_000
# What a record, and a column name, may have at most unless a source says otherwise
# (``max_record_bytes``, ``max_name_chars``). Larger ones come from a missing quote.
MOST_RECORD_BYTES = 64 << 20
MOST_NAME_CHARS = 100_000
WHOLE = "starts AND NOT odd"


@dataclass(frozen=True)
class RawTable:
    """Text columns under their normalised names, followed by the columns that
    order the rows as they stand in the files, and folders to delete after use. ``parts`` says that
    the files of a folder are one, cut in the order of their names. ``tolerant``
    reads the same rows again for a diagnosis: a record with too few or too many fields does
    not fail, but stands in the column ``MALFORMED``."""

    rows: DataFrame
    columns: tuple[str, ...]
    order: tuple[str, ...]
    staged: tuple[str, ...] = ()
    path: str = ""
    tolerant: Callable[[], DataFrame] | None = None
    parts: bool = False


def source_path(conf: Mapping[str, Any], base_path: str | None = None) -> str:
    """``base_path/key``, or the key of the bucket in the object store."""
    if not conf.get("key") or not (base_path or conf.get("bucket")):
        raise ValueError("a source needs a key, and a bucket unless a base path stands in for it")
    base = base_path or f"s3a://{conf['bucket']}"
    return f"{base.rstrip('/')}/{conf['key']}"


def read_header(spark: SparkSession, path: str, most_chars: int = MOST_NAME_CHARS) -> list[str | None]:
    """The first record as it stands. ``multiLine`` reads on from the start of one file and stops
    there; a quote that is never closed makes a name longer than any, which is an error."""
    limits = {"maxCharsPerColumn": most_chars, "header": False, "multiLine": True}
    first = spark.read.options(**DIALECT, **limits).csv(path).head(1)
    if not first or not any(first[0]):
        raise ValueError(f"{path} has no header")
    return list(first[0])


def _odd_quotes(line: Column) -> Column:
    return F.octet_length(line).bitwiseAND(1) != F.octet_length(F.replace(line, F.lit('"'))).bitwiseAND(1)


def _needs_records(spark: SparkSession, path: str) -> bool:
    """Whether some line is not one record to Spark's reader: a quoted field runs on
    to the next line, or the line is blank (an error, or a null, that it would skip).
    A line that is no UTF-8 is an error."""
    line = F.col("value")
    special = _odd_quotes(line) | line.rlike(r"\A[\x00-\x20]*\z")
    found = spark.read.text(path).select(F.is_valid_utf8(line).alias("valid"), special.alias("special"))
    # A file without such lines is read to its end here; one with them is checked when it is staged.
    first = found.where(F.col("special") | ~F.col("valid")).head(1)
    if first and not first[0]["valid"]:
        raise ValueError(f"{path}: a line is not valid UTF-8")
    return bool(first)


def _positions(files: list[str]) -> list[Column]:
    """File order of the rows. The path counts only between several files; the block start
    is needed because Spark hands out the splits of several files by size."""
    file = F.col("_metadata.file_path") if len(files) > 1 else F.lit("")
    return [
        file.alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(LINE),
    ]


def _text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _read_lines(
    spark: SparkSession, path: str, header: list[str | None], columns: list[str], tolerant: bool = False
) -> DataFrame:
    """Every line is a record: Spark's reader, which splits the files, skips the header of
    each and, where there are several, compares it with ours."""
    more = [MALFORMED] if tolerant else []
    dialect = DIALECT | (TOLERANT if tolerant else {})
    reader = spark.read.schema(_text_schema([*header, *more])).options(**dialect, header=True, multiLine=False)
    files = reader.csv(path).inputFiles()
    rows = reader.option("enforceSchema", tolerant or len(files) == 1).csv(path)
    return rows.select("*", *_positions(files)).toDF(*columns, *more, FILE, BLOCK, LINE)


def _number_lines(group_lines: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Tell for each line how many quotes stand before it in its group, odd or even. Lines come
    in the order of their files; a group is a run of at most ``group_lines`` lines of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, lines, state = None, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            files, starts = batch.column(1), batch.column(2)
            odd = batch.column("odd").to_numpy(zero_copy_only=False)
            same = pc.and_(pc.equal(files[1:], files[:-1]), pc.equal(starts[1:], starts[:-1]))
            other = np.concatenate([np.flatnonzero(~same.to_numpy(zero_copy_only=False)) + 1, [batch.num_rows]])
            group, before = np.empty(batch.num_rows, np.int32), np.empty(batch.num_rows, bool)
            at = 0
            while at < batch.num_rows:
                here = files[at].as_py(), starts[at].as_py()
                if here != block:
                    block, lines = here, 0
                if lines % group_lines == 0:
                    state = 0
                # Up to the next block, or to the end of the group.
                end = min(int(other[other > at][0]), at + group_lines - lines % group_lines)
                counts = np.cumsum(odd[at:end]) + state
                group[at:end] = lines // group_lines
                before[at:end] = np.concatenate([[state], counts[:-1]]) % 2 == 1
                state, lines, at = int(counts[-1]), lines + end - at, end
            columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            yield pa.RecordBatch.from_pydict({**columns, GROUP: pa.array(group), "odd_before": pa.array(before)})

    return run


def _stage_lines(spark: SparkSession, path: str) -> str:
    """Write the lines with their positions. Line numbers depend on how the files were
    split, so the passes below must all see the ones given here, once."""
    staged = shared_dir(spark, "csv-lines")
    lines = spark.read.option("lineSep", "\n").text(path)
    valid = F.when(F.is_valid_utf8("value"), F.col("value")).otherwise(
        F.raise_error(F.lit(f"{path}: a line is not valid UTF-8")).cast("string")
    )
    read = lines.select(valid.alias("value"), *_positions(lines.inputFiles()), _odd_quotes(F.col("value")).alias("odd"))
    schema = f"value string, {FILE} string, {BLOCK} long, {LINE} long, odd boolean, {GROUP} int, odd_before boolean"
    read.mapInArrow(_number_lines(GROUP_LINES), schema).write.parquet(staged)
    return staged


def _splits(lines: DataFrame) -> DataFrame:
    """One row per group of lines: whether it begins inside quotes and, if so, the line (in some
    earlier group) that began the record. As many rows as the files have groups."""
    per_group = lines.groupBy(FILE, BLOCK, GROUP).agg(
        F.count_if("odd").alias("odd"),
        F.max(F.when(~F.col("odd_before"), F.col(LINE))).alias("last_if_outside"),
        F.max(F.when(F.col("odd_before"), F.col(LINE))).alias("last_if_inside"),
    )
    earlier = W.partitionBy(FILE).orderBy(BLOCK, GROUP).rowsBetween(W.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2 == 1
    last = F.when(~F.col("inside"), F.col("last_if_outside")).otherwise(F.col("last_if_inside"))
    opened = F.when(last.isNotNull(), F.struct(F.col(BLOCK).alias("block"), last.alias("line")))
    return per_group.withColumn("inside", inside).select(
        FILE, BLOCK, GROUP, "odd", "inside", F.last(opened, ignorenulls=True).over(earlier).alias("opened")
    )


def _parts(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """The lines of records that have several, each with the first line of its record."""
    by_line = W.partitionBy(FILE, BLOCK, GROUP).orderBy(LINE)
    upto = by_line.rowsBetween(W.unboundedPreceding, W.currentRow)
    # Filtered before the window: no whole line is the first line of another.
    parts = _placed(lines, splits).where(f"NOT ({WHOLE})")
    here = F.when(F.col("starts"), F.struct(F.col(BLOCK).alias("block"), F.col(LINE).alias("line")))
    return parts.withColumn("first_line", F.coalesce(F.last(here, ignorenulls=True).over(upto), "opened"))


def _placed(lines: DataFrame, splits: DataFrame) -> DataFrame:
    is_header = (F.col(BLOCK) == 0) & (F.col(GROUP) == 0) & (F.col(LINE) == F.col("first"))
    firsts = lines.where(f"{BLOCK} = 0 AND {GROUP} = 0").groupBy(FILE).agg(F.min(LINE).alias("first"))
    return (
        lines.join(splits.select(FILE, BLOCK, GROUP, "inside", "opened"), [FILE, BLOCK, GROUP])
        # A row for each file. Shuffled by file, the lines of few files would go to as many tasks.
        .join(F.broadcast(firsts), FILE)
        .withColumn("is_header", is_header)
        .withColumn("starts", F.col("inside") == F.col("odd_before"))
    )


def _records(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """Lines put together to records, each at the position of its first line. Only the
    lines of records that have several are shuffled and grouped."""
    in_order = F.array_sort(F.collect_list(F.struct(BLOCK, LINE, "value")))
    joined = (
        _parts(lines, splits)
        .groupBy(FILE, "first_line")
        .agg(F.array_join(in_order["value"], "\n").alias("text"), F.bool_or("is_header").alias("is_header"))
        .select("text", "is_header", FILE, F.col("first_line.block").alias(BLOCK), F.col("first_line.line").alias(LINE))
    )
    alone = _placed(lines, splits).where(WHOLE).select(F.col("value").alias("text"), "is_header", FILE, BLOCK, LINE)
    text = F.col("text")
    # The line ended in CR LF. A break within quotes is never the end of a record.
    bare = F.when(text.endswith("\r"), F.left(text, F.length(text) - 1)).otherwise(text)
    return alone.union(joined).withColumn("text", bare)


def _read_records(
    spark: SparkSession,
    staged: str,
    path: str,
    header: list[str | None],
    columns: list[str],
    most_bytes: int,
    tolerant: bool = False,
) -> DataFrame:
    lines = fit_shuffle(spark.read.parquet(staged))
    kept = f"{staged}-splits"
    if tolerant:
        return _parsed(lines, spark.read.parquet(kept), path, header, columns, tolerant=True)
    _splits(lines).write.parquet(kept)
    splits = spark.read.parquet(kept)
    # Checked before any record is built: an open quote takes in the rest of its file, and two
    # stray ones all that stands between them.
    open_ended = splits.groupBy(FILE).agg((F.sum("odd") % 2).alias("odd")).where("odd = 1")
    if not open_ended.isEmpty():
        raise ValueError(f"{path}: unterminated quoted field")
    sizes = _parts(lines, splits).groupBy(FILE, "first_line").agg(F.sum(F.octet_length("value") + 1).alias("bytes"))
    if not sizes.where(F.col("bytes") > most_bytes).isEmpty():
        raise ValueError(
            f"{path}: a record of more than {most_bytes} bytes; a quote may be missing or stray, else raise max_record_bytes"
        )

    return _parsed(lines, splits, path, header, columns)


def _parsed(
    lines: DataFrame, splits: DataFrame, path: str, header: list[str | None], columns: list[str], tolerant: bool = False
) -> DataFrame:
    more = [MALFORMED] if tolerant else []
    schema = ", ".join(f"`{c}` string" for c in [*columns, *more])
    fields = F.from_csv("text", schema, {**DIALECT, "multiLine": "true", **(TOLERANT if tolerant else {})})
    if len(columns) == 1:
        # A blank line is a null in a table of one column, a short record in any other.
        nulls = F.struct(*[F.lit(None).cast("string").alias(c) for c in [*columns, *more]])
        fields = F.when(F.col("text") == "", nulls).otherwise(fields)
    known = [F.lit(h).cast("string").alias(c) for h, c in zip(header, columns)]
    expected = F.struct(*known, *[F.lit(None).cast("string").alias(c) for c in more])
    wrong = F.raise_error(F.concat(F.lit(f"{path}: a file has another header: "), "text")).cast("boolean")
    is_data = F.when(~F.col("is_header"), True).when(fields.eqNullSafe(expected), False).otherwise(wrong)
    # `inline` rather than a struct column: as a generator the parser stays out of the generated
    # code for the casts, which is otherwise too long a method for the JVM to compile.
    return _records(lines, splits).where(is_data).select(F.inline(F.array(fields)), FILE, BLOCK, LINE)


def read_csv(
    spark: SparkSession, conf: Mapping[str, Any], base_path: str | None = None, multi_line: bool | None = None
) -> RawTable:
    """Scan the object (or the folder of equal objects) a source names.

    One pass over the lines finds out whether some record is more or less than a line.
    ``multi_line``, also a key of ``conf``, saves that pass if it is true; saying that there are
    no such records does not, as the lines may tell otherwise. No row depends on it.

    ``parts`` in ``conf`` says that a folder is one file that was written in parts, each with
    the header: an error names the folder, and numbers the records through its parts."""
    path = source_path(conf, base_path)
    header = read_header(spark, path)
    columns = normalise_all(name or "" for name in header)
    staged: tuple[str, ...] = ()
    # Spark's comparison of headers does not take a column without a name.
    multi_line = conf.get("multi_line") if multi_line is None else multi_line
    if multi_line is True or not all(header) or _needs_records(spark, path):
        folder = _stage_lines(spark, path)
        staged = (folder, f"{folder}-splits")
        most_bytes = int(conf.get("max_record_bytes") or MOST_RECORD_BYTES)
        read, source = _read_records, (spark, folder, path, header, columns, most_bytes)
    else:
        read, source = _read_lines, (spark, path, header, columns)
    parts = bool(conf.get("parts"))
    return RawTable(read(*source), tuple(columns), (FILE, BLOCK, LINE), staged, path, lambda: read(*source, tolerant=True), parts)
