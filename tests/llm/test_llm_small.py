"""Every operator on awkward rows: nulls, empty and repeated ones, ties, clashing columns."""

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parents[2]
sys.path.insert(0, str(ROOT))

import corpus_pipeline  # noqa: E402
from loomwright.llm import queries  # noqa: E402

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, sequence_id string, lang_pred int, removed string"
LONG = " ".join(f"word{i % 977}" for i in range(30_000))
ROWS = [
    (1, "Hello world this is a text of some words", "en", "s", 1, "x", 1, "r"),
    (None, "Hello world this is a text of some words", "en", "s", 1, "x", 1, "r"),
    (1, "Hello world this is a text of some words", "en", "s", 1, "x", 1, "r"),
    (2, None, None, None, None, None, None, None),
    (3, "", "en", "s", 0, "x", 2, "r"),
    (4, "123 456", "en", "s", 0, "x", 2, "r"),
    (5, "a", "en", "s", 1, "x", 1, "r"),
    (5, "bb ccc dd", "fr", "s", 1, "x", 1, "r"),
    (6, " \n\n ", "fr", "s", 1, "x", 1, "r"),
    (7, LONG, "en", "s", 1, "x", 1, "r"),
]
PAGES = [(1, "http://a/x", "<p>x"), (None, None, None), (1, "http://a/x", "<p>x"), (2, "zz", ""), (3, None, "<p>x" + "y " * 300_000)]


def tables(spark, folder, documents, pages):
    frames = {
        "documents": spark.createDataFrame(documents, DOCUMENTS),
        "pages": spark.createDataFrame(pages, "page_id long, url string, html string"),
        "benchmark": spark.createDataFrame(
            [(1, "Hello world this is a text"), (None, "bb ccc"), (3, None), (4, ".."), (1, "zzz")], "item_id long, text string"
        ),
        "labels": spark.createDataFrame([(1, 1, 1), (5, 0, 0), (None, None, 1)], "doc_id long, quality int, toxic int"),
    }
    for name, frame in frames.items():
        frame.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    return tables(spark, tmp_path_factory.mktemp("awkward"), ROWS, PAGES)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return tables(spark, tmp_path_factory.mktemp("empty"), [], [])


@pytest.fixture(scope="module")
def nulls(spark, tmp_path_factory):
    return tables(spark, tmp_path_factory.mktemp("nulls"), [(None,) * 8] * 2, [(None,) * 3] * 2)


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_empty_tables_give_empty_results(spark, empty, name):
    assert queries.queries()[name](spark, empty).collect() == []


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_rows_of_nulls(spark, nulls, name):
    assert queries.queries()[name](spark, nulls).count() == 2


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - {"op1_best_fit_packing", "op2_html_extraction", "op9_warc"}))
def test_a_row_for_each_document(spark, awkward, name):
    ids = [r.doc_id for r in queries.queries()[name](spark, awkward).collect()]
    assert sorted(ids, key=str) == sorted([r[0] for r in ROWS], key=str)


def test_packing(spark, awkward):
    got = queries.op1_best_fit_packing(spark, awkward).collect()
    assert {r.doc_id for r in got} == {r[0] for r in ROWS}
    assert sorted(r.length for r in got if r.doc_id in (2, 3)) == [1, 1]
    # Repeated rows each have their own place.
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)


def test_language(spark, awkward):
    got = [(r.doc_id, r.lang_pred, r.score) for r in queries.op3_language_id(spark, awkward).collect()]
    assert {g[0] for g in got if g[1] == "und"} == {2, 3, 4, 6} and all(0 <= g[2] <= 1 for g in got)


def test_near_duplicates(spark, awkward):
    got = sorted(map(tuple, queries.op4_near_duplicates(spark, awkward).collect()), key=str)
    words = len(ROWS[0][1].split()) - 1
    assert got.count((1, words, 1, True)) == 2 and (None, words, 1, False) in got
    assert (2, 0, 2, True) in got and (6, 0, 6, True) in got and (5, 1, 5, True) in got and (5, 2, 5, True) in got


def test_decontamination(spark, awkward):
    got = {(r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in queries.op5_decontamination(spark, awkward).collect()}
    assert {(1, 9, 6, 1, True), (None, 9, 6, 1, True), (5, 3, 2, 0, True), (5, 1, 0, 0, False), (2, 0, 0, 0, False)} <= got


def test_archives(spark, awkward):
    got = sorted(map(tuple, queries.op9_warc(spark, awkward).collect()), key=str)
    assert [(g[0], g[1], g[3], g[4]) for g in got] == [
        (1, 4, "response", None),
        (1, 4, "revisit", 1),
        (2, 0, "response", None),
        (3, 600_004, "response", None),
        (None, 0, "revisit", 2),
    ]


def test_pages(spark, awkward):
    got = {(r.page_id, r.url, r.text, r.n_chars) for r in queries.op2_html_extraction(spark, awkward).collect()}
    assert {(1, "http://a/x", "x", 1), (None, None, "", 0), (2, "zz", "", 0)} <= got


def test_pipeline_keeps_the_columns(spark, awkward):
    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, awkward).columns == docs.columns


def test_language_stage(spark):
    latin = "The quick brown fox jumps over the lazy dog and runs away. " * 8
    greek = "Η γρήγορη καφέ αλεπού πηδάει πάνω από το σκυλί. " * 8
    rows = [(i, f"{latin} {i}", "en", "s", 1, "x", 1, "r") for i in range(20)] + [(20, greek, None, "s", 1, "x", 1, "r"), (21, "12", None, "s", 1, "x", 1, "r")]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    assert {r.doc_id for r in corpus_pipeline.identify_language(spark, docs, "").collect()} == set(range(20))
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.doc_id for r in corpus_pipeline.identify_language(spark, none, "").collect()} == set(range(21))


def test_pipeline(spark, awkward, empty, nulls):
    assert {r.doc_id for r in corpus_pipeline.run(spark, awkward).collect()} == {5, 7}
    assert corpus_pipeline.run(spark, empty).collect() == corpus_pipeline.run(spark, nulls).collect() == []
