"""The stages that turn raw documents into packed training sequences.

Each stage gets what the one before kept, as written to Parquet and read again, and returns
it with its decisions carried out. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.llm import contamination, language, linededup, neardup, packing
from loomwright.llm.common import keep_rows, read_table, staged

CAPACITY, END_ID = 2048, 0
# The stages before leave their executors little memory for the words and texts of the tokenizer.
REMEMBER, BATCH_BYTES = 200_000, 1 << 20


def identify_language(
    spark: SparkSession,
    docs: DataFrame,
    sf_dir: str,
    least_bytes: int = language.LEAST_BYTES,
    least_score: float = language.LEAST_SCORE,
) -> DataFrame:
    """Documents that are in no language go: those without text or without a letter, and those of
    ``least_bytes`` or more whose score is below ``least_score``, that is chance: of less text the
    score tells nothing. If nothing was learned, all with a letter stay."""
    model = language.train(docs.where(~language.held_out()))
    if not model.languages:
        return docs.where(language.has_letter()("text"))
    guessed = language.predict(docs.withColumn("__row", F.struct(*docs.columns)), model)
    return guessed.where((F.col("lang_pred") != language.UNKNOWN) & ~language.in_no_language("text", least_bytes, least_score)).select("__row.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand in an earlier document, or earlier in the same one, go."""
    cleaned = linededup.remove_repeated_chunks(docs).select(docs.columns)
    return cleaned.withColumn("n_chars", F.length("text").cast("long"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return keep_rows(docs, neardup.near_duplicates(docs).where("kept"), once=True)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    found = contamination.contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return keep_rows(docs, found.where(~F.col("contaminated")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in sequences: a row for each piece of a document, with a checksum of its ids."""
    pieces = packing.cut_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), CAPACITY, END_ID, REMEMBER, BATCH_BYTES)
    digests = pieces.select("doc_id", "piece", "start", "length", packing.ids_crc32().alias("ids_crc32"))
    return packing.pack(digests, CAPACITY)


STAGES = [
    ("language ID", identify_language),
    ("line dedup", dedup_lines),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("best-fit packing", pack),
]

# SQL has no tokenizer and no trained model; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next one."""
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = staged(docs, f"stage-{number}")
    return docs
