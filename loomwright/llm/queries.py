"""The queries of this package, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..paths import shared_dir
from . import alignment, contamination, extraction, importance, language, linededup, mixing, neardup, packing, repetition, tokenfile, toxicity, warc
from .common import read_table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.cut_pieces(read_table(spark, sf_dir, "documents"), path, capacity=2048, end_id=0)
    digests = pieces.select("doc_id", "piece", "start", "length", packing.ids_crc32().alias("ids_crc32"))
    return packing.pack(digests, capacity=2048)


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract_main_text(read_table(spark, sf_dir, "pages"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    # A document without an id has no remainder, and is neither learned from nor held out.
    model = language.train(documents.where(~language.held_out()))
    held_out = F.coalesce(language.held_out(), F.lit(False))
    return language.predict(documents, model).select(F.col("doc_id").cast("long"), held_out.alias("held_out"), "lang_pred", "score")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(read_table(spark, sf_dir, "documents"), words=2, similarity=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (read_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return contamination.contamination(documents, benchmark).select(
        *("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items")),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = linededup.remove_repeated_chunks(read_table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "text", "n_lines", "n_removed_lines", "n_removed_words")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = repetition.measure_repetition(read_table(spark, sf_dir, "documents"))
    return measured.select(
        *("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"),
        repetition.base_failed().alias("base_failed"),
        (~repetition.base_failed() & repetition.repetition_passed()).alias("kept"),
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (read_table(spark, sf_dir, name) for name in ("documents", "labels"))
    return toxicity.predict(documents, toxicity.train(toxicity.labelled_texts(documents, labels)))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read_archives(warc.archive(read_table(spark, sf_dir, "pages")))
    return records.where("last").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", warc.page_of("refers_to").alias("refers_to")
    )


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    documents, folder = read_table(spark, sf_dir, "documents"), shared_dir(spark, "tokens")
    files = tokenfile.write_token_files(documents, folder, path, end_id=1, vocabulary=49_408)
    return tokenfile.read_token_files(files).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").cast("long").alias("ids_crc32")
    )


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (read_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    drawn = importance.resample(documents, benchmark, sizes=(1, 1), buckets=10_000, seed=2024, percent=10, least_words=20)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan(read_table(spark, sf_dir, "documents"), weights=(1, 2, 3), percent=100, most_epochs=3)
    return planned.select("doc_id", "size", "source_size", "target", "taken")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(read_table(spark, sf_dir, "documents"), *paths).withColumnRenamed("groups", "groups_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [
        *(op1_best_fit_packing, op2_html_extraction, op3_language_id, op4_near_duplicates, op5_decontamination),
        *(op6_line_dedup, op7_quality_rules, op8_toxicity, op9_warc, op10_token_files),
        *(op11_importance_resampling, op12_source_mixing, op13_token_alignment),
    ]
    return {query.__name__: query for query in named}


_SMALL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DUPLICATES_SQL = rf"""
WITH RECURSIVE split AS (SELECT doc_id, regexp_extract_all({_SMALL}, '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM split WHERE len(w) > 0),
shingles AS (SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id
),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)
),
reached(a, b) AS (SELECT a, b FROM links UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
least_reached AS (SELECT a, min(b) AS b FROM reached GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id,
  doc_id <= coalesce(b, doc_id) AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least_reached ON a = doc_id
"""

_WORDS = rf"regexp_extract_all({_SMALL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION_SQL = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
starts AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS words FROM starts),
lengths AS (SELECT DISTINCT len(words) AS n FROM windows),
places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs),
found AS (
  SELECT doc_id, i, n, item_id FROM places JOIN lengths ON i + n - 1 <= len(w)
  JOIN windows ON words = list_slice(w, i, i + n - 1)
),
hit AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, hit.n IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

# Five hexadecimal digits are four of base 32.
_DIGIT = "(instr('0123456789abcdef', substr(h, CAST(5 * k + {0} AS BIGINT), 1)) - 1)"
_NUMBER = "(" + " * 16 + ".join(["(" * 4 + _DIGIT.format(1)] + [f"{_DIGIT.format(i)})" for i in range(2, 6)]) + ")"
_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
_BASE32 = " || ".join(f"substr({_LETTERS}, CAST(({_NUMBER} >> {shift}) & 31 AS BIGINT) + 1, 1)" for shift in (15, 10, 5, 0))

WARC_SQL = f"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS html, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS keeper FROM pages
),
digests AS (SELECT page_id, keeper, strlen(html) AS payload_bytes, sha1(html) AS h FROM payloads),
parts AS (SELECT page_id, h, unnest(range(0, 8)) AS k FROM digests),
digits AS (SELECT page_id, string_agg({_BASE32}, '' ORDER BY k) AS payload_digest FROM parts GROUP BY page_id)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM digests JOIN digits USING (page_id)
"""


# Hexadecimal digits as a number.
_HEX = "(instr('0123456789abcdef', substr({0}, CAST({1} AS BIGINT), 1)) - 1)"
_BYTES = f"list_transform(range(0, strlen(word)), lambda k: 16 * {_HEX.format('h', '2 * k + 1')} + {_HEX.format('h', '2 * k + 2')})"
_DRAW = "floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))"
_EIGHT = "(" + " * 16 + ".join(["(" * 7 + _HEX.format("d", 1)] + [f"{_HEX.format('d', i)})" for i in range(2, 9)]) + ")"

RESAMPLING_SQL = f"""
WITH crc AS (
  SELECT list(list_reduce(list_prepend(i, range(0, 8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
    ORDER BY i) AS t FROM range(0, 256) AS r(i)
),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT {_WORDS} AS w FROM benchmark),
found AS (SELECT doc_id, unnest(w) AS word FROM docs),
wanted AS (SELECT unnest(w) AS word FROM items),
known AS (SELECT word, lower(hex(word)) AS h FROM (SELECT word FROM found UNION SELECT word FROM wanted)),
placed AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, {_BYTES}),
    lambda c, b: xor(c >> 8, t[CAST(xor(c & 255, b) AS BIGINT) + 1])), 4294967295::BIGINT) % 10000 AS bucket
  FROM known, crc
),
have AS (SELECT bucket, count(*) AS s FROM found JOIN placed USING (word) GROUP BY bucket),
want AS (SELECT bucket, count(*) AS t FROM wanted JOIN placed USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * ((SELECT sum(s) FROM have) + 10000) AS DOUBLE)
    / CAST((coalesce(s, 0) + 1) * (coalesce((SELECT sum(t) FROM want), 0) + 10000) AS DOUBLE))) AS BIGINT) AS gain
  FROM have LEFT JOIN want USING (bucket)
),
weights AS (SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight FROM found JOIN placed USING (word) JOIN gains USING (bucket) GROUP BY doc_id),
noise AS (SELECT doc_id, {_EIGHT} AS h FROM (SELECT doc_id, sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents)),
scored AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST({_DRAW} AS BIGINT) AS score
  FROM docs LEFT JOIN weights USING (doc_id) JOIN noise USING (doc_id)
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
    count(*) FILTER (n_features >= 20) OVER () * 10 // 100 AS drawn FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= drawn THEN place END AS rank FROM ranked
"""

MIXING_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, text, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM docs GROUP BY source
),
ordered AS (
  SELECT *, 3 * source_size AS most,
    sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST) - 3 * source_size AS most_before,
    sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST) - weight AS weight_before,
    sum(source_size) OVER () AS budget, sum(weight) OVER () AS weights
  FROM sources
),
cut AS (SELECT *, most / weight < (budget - most_before) / (weights - weight_before) AS is_full FROM ordered),
targets AS (
  SELECT source, source_size, CASE WHEN is_full THEN CAST(most AS DOUBLE) ELSE
    CAST(budget - coalesce(sum(most) FILTER (is_full) OVER (), 0) AS DOUBLE) * weight
      / CAST(weights - coalesce(sum(weight) FILTER (is_full) OVER (), 0) AS DOUBLE) END AS target
  FROM cut
),
placed AS (
  SELECT doc_id, source, size, sum(size) OVER (
    PARTITION BY source ORDER BY md5('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), doc_id
  ) - size AS before FROM docs
),
epochs AS (
  SELECT doc_id, size, source_size, target, before, CAST(floor(target) AS BIGINT) AS words,
    CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs
  FROM placed JOIN targets ON placed.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target,
  CAST(epochs * size + greatest(0, least(size, words - epochs * source_size - before)) AS BIGINT) AS taken
FROM epochs
"""


def oracle_sql() -> dict[str, str]:
    """The others need a tokenizer, a trained model, or a hash that SQL has not."""
    return {
        "op4_near_duplicates": NEAR_DUPLICATES_SQL,
        "op5_decontamination": DECONTAMINATION_SQL,
        "op9_warc": WARC_SQL,
        "op11_importance_resampling": RESAMPLING_SQL,
        "op12_source_mixing": MIXING_SQL,
    }
