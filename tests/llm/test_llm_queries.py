"""The registered queries over the small tables, against SQL or plain Python."""

import base64
import hashlib
import re
import string
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

ROOT = Path(__file__).resolve().parents[2]
sys.path.insert(0, str(ROOT))

import corpus_pipeline  # noqa: E402
from loomwright.llm import language, linededup, queries, toxicity  # noqa: E402

duckdb = pytest.importorskip("duckdb")
TABLES, MORE = Path("/root/testdata/sf0.001"), Path("/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not TABLES.is_dir(), reason="the tables are not here")
SMALL = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def texts(oracle, table="documents", column="text", key="doc_id"):
    return dict(oracle.execute(f"SELECT {key}, {column} FROM {table} ORDER BY 1").fetchall())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_and_sql(spark, oracle, name):
    df = queries.queries()[name](spark, str(TABLES))
    cursor = oracle.execute(queries.oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    assert sorted(df.columns) == sorted(names)
    expected = sorted(repr(row) for row in cursor.fetchall())
    assert sorted(repr(tuple(row)) for row in df.select(*names).collect()) == expected


def ids_of(name, end):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda text: np.asarray([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def pieces_of(docs):
    """What packing makes of documents, but for the places."""
    encode, out = ids_of("byte_bpe_50k.json", 0), []
    for doc, text in docs.items():
        ids = encode(text)
        starts = [0, *range(len(ids) % 2048 or 2048, len(ids), 2048)] if len(ids) > 2048 else [0]
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            out.append((doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    return sorted(out)


def check_places(rows):
    """Sequences hold at most their capacity and have no gaps; few are used."""
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for own in by_sequence.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(by_sequence) <= 1.03 * sum(r.length for r in rows) / 2048 + 1


def test_packing(spark, oracle):
    rows = queries.op1_best_fit_packing(spark, str(TABLES)).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == pieces_of(texts(oracle))
    check_places(rows)


def test_token_files(spark, oracle):
    encode, start, expected = ids_of("word_bpe_49k.json", 1), 0, []
    for doc, text in texts(oracle).items():
        ids = encode(text)
        expected.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, queries.op10_token_files(spark, str(TABLES)).collect())) == expected


def test_held_out_accuracy_of_languages(spark):
    rows = queries.op3_language_id(spark, str(MORE)).collect()
    truth = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{MORE}/documents.parquet'").fetchall())
    test = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows) and len(test) > 200
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in test]) > 0.98


def test_predictions_see_nothing_but_the_text(spark):
    docs = spark.read.parquet(f"{MORE}/documents.parquet")
    model = language.train(docs)
    other = docs.select((F.col("doc_id") + 1000).alias("doc_id"), "text", F.lit("xx").alias("lang"), F.lit(1).alias("score"))
    one, two = (language.predict(d, model).select("text", "lang_pred", "score") for d in (docs, other))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_copies_of_a_text_teach_once(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").select("text", "lang").dropna()
    hot = docs.where("length(text) > 500").orderBy("text").limit(1)
    copies = docs.unionAll(hot.crossJoin(spark.range(300)).select("text", "lang"))
    one, two = (language.train(d, train_docs=40) for d in (docs, copies))
    assert one.languages == two.languages and (one.slots == two.slots).all()


def test_pages(spark, oracle):
    def article(page):
        import html

        inside = page.split("<article>", 1)[1].split("</article>")[0]
        blocks = [re.sub(r"<br>", " ", re.sub(r"</?b>", "", b)) for b in re.split(r"</?(?:p|h1)>", inside)]
        blocks = [" ".join(html.unescape(b).split()) for b in blocks]
        return "\n".join(b for b in blocks if b)

    pages = texts(oracle, "pages", "html", "page_id")
    rows = queries.op2_html_extraction(spark, str(TABLES)).collect()
    assert {r.page_id: r.text for r in rows} == {i: article(p) for i, p in pages.items()}
    assert all(r.n_chars == len(r.text) for r in rows)


def test_template_tells_the_article_where_no_element_does(spark):
    """Pages of one host: the same frame and menu, and an article in a plain element."""
    from loomwright.llm import extraction

    def page(i):
        body = "".join(f"<p>Sentence {i} {k} about things</p>" for k in range(4))
        return f"<body><div><p>Home</p><p>About us</p></div><div><h1>Title {i}</h1>{body}</div><div><p>All rights reserved</p></div></body>"

    rows = [(i, f"http://host/{i}", page(i)) for i in range(6)]
    got = extraction.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    for r in got:
        lines = r.text.split("\n")
        assert f"Title {r.page_id}" in lines and f"Sentence {r.page_id} 3 about things" in lines
        assert "Home" not in lines and "All rights reserved" not in lines


def extracted(spark, pages):
    """Texts of pages of one host."""
    from loomwright.llm import extraction

    rows = [(i, f"http://host/{i}", page) for i, page in enumerate(pages)]
    got = extraction.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r.text for r in sorted(got, key=lambda r: r.page_id)]


def test_template_counts_inside_the_article(spark):
    cards = "".join(f"<article><p>Card {{0}} {k}</p></article>" for k in range(2))
    page = "<body><main><h1>Title {0}</h1><p>Story {0}</p><div><p>Tell your friends</p></div>" + cards + "</main></body>"
    got = extracted(spark, [page.format(i) for i in range(4)])
    assert got == [f"Title {i}\nStory {i}\nCard {i} 0\nCard {i} 1" for i in range(4)]


def test_copies_are_no_template(spark):
    page = "<body><div><p>Home</p></div><div><h1>Title {0}</h1><p>Sentence {0}</p></div></body>"
    got = extracted(spark, [page.format(i) for i in (7, 7, 7, 7, 1, 2)])
    assert got == [f"Title {i}\nSentence {i}" for i in (7, 7, 7, 7, 1, 2)]
    alone = extracted(spark, [page.format(7)] * 4)
    assert all("Sentence 7" in text for text in alone)


def test_templates_by_class_of_pages(spark):
    """Three templates on a host, each on a third of its pages."""
    pages = []
    for k in range(3):
        page = f"<body>{'<div>' * k}<div><p>Menu {k}</p></div><div><h1>Title {k} {{0}}</h1><p>Sentence {k} {{0}}</p></div>{'</div>' * k}</body>"
        pages += [page.format(i) for i in range(4)]
    assert extracted(spark, pages) == [f"Title {k} {i}\nSentence {k} {i}" for k in range(3) for i in range(4)]


def deduplicated(docs):
    """Texts without the chunks that stand in a smaller document, or earlier."""
    places = defaultdict(list)
    for doc, text in docs.items():
        lines = text.split("\n")
        for start, n in linededup.chunks(lines):
            places["\n".join(lines[start : start + n])].append((doc, start))
    out = {}
    for doc, text in docs.items():
        lines, gone = text.split("\n"), set()
        for start, n in linededup.chunks(lines):
            own = places["\n".join(lines[start : start + n])]
            if min(own) != (doc, start):
                gone.update(range(start, start + n))
        out[doc] = "\n".join(line for k, line in enumerate(lines) if k not in gone), len(gone)
    return out


def test_line_dedup(spark, oracle):
    expected = deduplicated(texts(oracle))
    rows = queries.op6_line_dedup(spark, str(TABLES)).collect()
    assert {r.doc_id: (r.text, r.n_removed_lines) for r in rows} == expected and any(n for _, n in expected.values())


def test_a_chunk_hash_that_stands_for_different_bytes(spark, monkeypatch):
    rows = [(1, "a b\nc d\n" + "x " * 60), (2, "e f\ng h\n" + "x " * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    real = linededup.repeated_chunks

    def collided(docs):
        """All chunks get one hash."""
        place = F.transform("marks", lambda m: F.struct(m["start"], m["lines"], F.lit(7).cast("long").alias("hash"), m["first"]))
        return real(docs).withColumn("marks", place)

    monkeypatch.setattr(linededup, "repeated_chunks", collided)
    same = linededup.remove_repeated_chunks(docs).orderBy("doc_id").collect()
    assert [r.n_removed_lines for r in same] == [0, 1]
    rows.append((3, "y " * 60 + "\n" + "z " * 60))
    rows.append((4, "y " * 60 + "\n" + "q"))
    left = linededup.remove_repeated_chunks(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.n_removed_lines == 0 for r in left)


def test_held_out_toxicity(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(toxicity.labelled_texts(docs.where(~language.held_out()), labels))
    test = docs.where(language.held_out()).join(labels.select("doc_id", F.col("toxic").alias("truth")), "doc_id")
    found = toxicity.predict(test, model).join(test.select("doc_id", "truth"), "doc_id").collect()
    counts = Counter((r.truth, r.toxic) for r in found)
    # Some labels of the tables are wrong on purpose.
    assert counts[1, True] > 0.85 * (counts[1, True] + counts[1, False])
    assert counts[0, True] < 0.01 * (counts[0, True] + counts[0, False])
    assert all((r.severity > 0.2) >= r.toxic for r in found) and {r.grade for r in found} >= {0, 1, 2}


def test_rare_features_count_among_many_common_ones(spark):
    """More features of toxic texts than 50,000, and the one that tells is the rarest."""
    common = " ".join(f"k{i:05d}" for i in range(26_000))  # and their beginnings
    rows = [(common + (" zap" if i % 3 else ""), 1) for i in range(9)]
    rows = [(f"{text} t{i}", grade) for i, (text, grade) in enumerate(rows)] + [(f"{common} c{i}", 0) for i in range(30)]
    model = toxicity.train(spark.createDataFrame(rows, "text string, grade int"))
    assert set(model.features) == {"zap"}


def test_archives_hold_the_pages(spark, oracle):
    from loomwright.llm import warc

    pages = spark.read.parquet(f"{TABLES}/pages.parquet")
    twice = pages.unionByName(pages.withColumn("page_id", F.col("page_id") + 100_000))
    chunks = warc.read_archives(warc.archive(twice), chunk_bytes=500).collect()
    payloads, kinds = defaultdict(bytes), {}
    for c in sorted(chunks, key=lambda c: c.chunk_no):
        payloads[c.page_id] += c.chunk
        kinds[c.page_id] = c.record_type
        if c.last and c.record_type == "response":
            assert c.payload_digest == base64.b32encode(hashlib.sha1(payloads[c.page_id]).digest()).decode()
    expected = texts(oracle, "pages", "html", "page_id")
    assert {i - 100_000: p.decode() for i, p in payloads.items() if i >= 100_000} == expected
    assert {k for i, k in kinds.items() if i < 100_000} == {"revisit"}


@pytest.mark.parametrize("shuffled", ["repartition", "groupBy", "union"])
def test_archives_of_pages_that_are_no_plain_scan(spark, shuffled):
    """Two passes over such a frame may see rows in another order and other tasks."""
    from loomwright.llm import warc

    pages = spark.read.parquet(f"{TABLES}/pages.parquet")
    pages = {
        "repartition": lambda: pages.repartition(5),
        "groupBy": lambda: pages.groupBy("page_id", "url").agg(F.first("html").alias("html")),
        "union": lambda: pages.unionByName(pages).repartition(3),
    }[shuffled]()
    rows = warc.read_archives(warc.archive(pages)).where("last").collect()
    assert len(rows) == pages.count() == len({r.record_id for r in rows})
    responses = {r.record_id for r in rows if r.record_type == "response"}
    assert {r.refers_to for r in rows if r.record_type == "revisit"} <= responses
    # Small payloads are all responses.
    small = warc.read_archives(warc.archive(pages, least_bytes=1 << 30)).where("last").collect()
    assert {r.record_type for r in small} == {"response"} and len(small) == len(rows)


def test_labels_in_any_order_teach_the_same(spark):
    docs = spark.createDataFrame([(i, f"{'bad' if i % 2 else 'good'} thing number {i} and more {i % 7}") for i in range(60)], "doc_id long, text string")
    labels = [(i, 0, k) for i in range(60) for k in ((0, 1) if i % 2 else (0, 0))]
    found = []
    for rows in (labels, labels[::-1]):
        model = toxicity.train(toxicity.labelled_texts(docs, spark.createDataFrame(rows, "doc_id long, quality int, toxic int").coalesce(1)))
        found.append(sorted((r.doc_id, r.toxic) for r in toxicity.predict(docs, model).collect()))
    assert found[0] == found[1] and {i for i, toxic in found[0] if toxic} == {i for i in range(60) if i % 2}


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("plain", [False, True])
def test_names_of_special_tokens(name, plain):
    import random

    from loomwright.llm.tokens import TextEncoder

    rng = random.Random(3)
    parts = [" ", "  ", "\n", "a", "The", "word", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "\u00e9", "'s", "12", " <|endoftext|> "]
    some = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(2000)]
    library = Tokenizer.from_file(public_tokenizers.path(name))
    library.encode_special_tokens = plain
    expected = [np.asarray(e.ids, "<u4").tobytes() for e in library.encode_batch(some, add_special_tokens=False)]
    assert TextEncoder(public_tokenizers.path(name), plain_names=plain).encode(some) == expected


def plain_quality(text):
    """The rules of the contract and the verdict on repeats, by looking at all places."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, text = len(words), text or ""
    windows = Counter(tuple(words[i : i + 5]) for i in range(n - 4))
    repeated = {i + k for i in range(n - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    by_window = defaultdict(list)
    for i in range(n - 4):
        by_window[tuple(words[i : i + 5])].append(i)
    longest, covered = 0, set()
    for places in by_window.values():
        for i in places:
            reach = 0
            for j in places:
                if i != j:
                    length = 5
                    while max(i, j) + length < n and words[i + length] == words[j + length]:
                        length += 1
                    reach = max(reach, length)
            longest = max(longest, reach)
            if reach >= 10:
                covered.update(range(i, i + reach))
    failed = n < 10 or 100 * len(repeated) > 20 * n
    kept = not failed and 100 * len(covered) <= 15 * n and longest <= 60
    symbols = sum(c in "#*$%&|<>" for c in text)
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), failed, kept


def test_quality_query(spark, oracle, tmp_path):
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    docs = texts(oracle)
    rows = queries.op7_quality_rules(spark, str(TABLES)).select(*columns).collect()
    assert {r[0]: tuple(r)[1:] for r in rows} == {d: plain_quality(t) for d, t in docs.items()}
    many = " ".join(f"u{i}" for i in range(300))
    odd = {
        1: None, 2: "", 3: "a b c d e f g h i", 4: "a b c d e f g h i j", 5: "a\nb\na\n \n \n", 6: "# $ \u00a0x\x1cy |<>",
        7: many + " " + " ".join(f"u{i}" for i in range(40)), 8: many + " x " + " ".join(f"u{i}" for i in range(61)), 9: "z " * 500,
        10: many + " x " + " ".join(f"u{i}" for i in range(9)), 11: many + " " + "p q r s t " * 6, 12: "\u3000a \x85b c d e f g h i j",
    }
    folder = str(tmp_path / "odd")
    spark.createDataFrame(list(odd.items()), "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    rows = queries.op7_quality_rules(spark, folder).select(*columns).collect()
    assert {r[0]: tuple(r)[1:] for r in rows} == {d: plain_quality(t) for d, t in odd.items()}


def test_scores_of_languages_are_those_of_exact_sets(spark):
    """The filter against sets of n-grams: a filter only adds what it claims by chance, which is taken off."""
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text", "lang")
    rows = {r.doc_id: r for r in docs.collect()}
    model = language.train(docs)
    counts = {}
    for text, lang in {(r.text, r.lang) for r in rows.values() if r.text and r.lang}:
        data = language.prepared(text)
        for size in language.SIZES:
            counts.setdefault((lang, size), Counter()).update(data[i : i + size] for i in range(len(data) - size + 1))
    rates = defaultdict(dict)
    for (lang, _), found in counts.items():
        total = sum(found.values())
        for gram, n in found.items():
            rates[gram][lang] = n / total
    sets = defaultdict(set)
    for gram, own in rates.items():
        if max(own.values()) >= language.LEAST_RATE:
            for lang, rate in own.items():
                if rate >= language.LEAST_SHARE * max(own.values()):
                    sets[lang].add(gram)
    for r in language.predict(docs, model).collect():
        data = language.prepared(rows[r.doc_id].text or "")
        grams = [data[i : i + size] for size in language.SIZES for i in range(len(data) - size + 1)]
        if r.lang_pred == language.UNKNOWN or len(grams) < 200:
            continue
        share = {lang: np.mean([g in own for g in grams]) for lang, own in sets.items()}
        assert share[r.lang_pred] >= max(share.values()) - 0.01 and abs(r.score - share[r.lang_pred]) < 0.02


def test_a_column_that_holds_no_languages_is_an_error(spark, monkeypatch):
    docs = spark.createDataFrame([(f"text number {i}", f"l{i}") for i in range(30)] + [("more", "l1")], "text string, lang string")
    monkeypatch.setattr(language, "MOST_LANGUAGES", 20)
    with pytest.raises(ValueError, match="lang has 30 values"):
        language.train(docs)
    assert language.train(docs, least_texts=2).languages == ["l1"]


def test_the_template_tells_the_article_without_its_elements(spark):
    """Pages of many hosts with plain elements in place of those that name the article and its parts."""
    from loomwright.llm import extraction

    pages = spark.read.parquet(f"{MORE}/pages.parquet")
    plain = pages.withColumn("html", F.regexp_replace("html", r"(</?)(article|main|section)\b", "$1div"))
    one, two = ({r.page_id: r.text for r in extraction.extract_main_text(p).collect()} for p in (pages, plain))
    assert one == two


def linked(docs, words):
    """The smallest document that links lead to, by comparing all pairs."""
    sets = {}
    for doc, text in docs.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", text.translate(SMALL))
        sets[doc] = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
    head = {doc: doc for doc in docs}

    def root(doc):
        while head[doc] != doc:
            doc = head[doc]
        return doc

    names = sorted(docs)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                head[y] = x
    return {doc: root(doc) for doc in docs}


@pytest.mark.parametrize(("size", "edits", "pool"), [(2, 12, 400), (5, 4, 400), (2, 12, 5)])
def test_near_duplicates_with_many_edited_copies(spark, size, edits, pool):
    """A group of copies that were edited to different degrees, so that some are linked to
    others only, and some to none; with few words to put in, many are edited alike."""
    import random

    from loomwright.llm import neardup

    rng = random.Random(5)
    base = [f"w{rng.randint(0, 400)}" for _ in range(120)]
    docs = {}
    for i in range(400):
        words = list(docs[rng.choice(list(docs))].split() if i % 5 == 4 else base)
        for _ in range(rng.randint(0, edits)):
            at = rng.randrange(len(words))
            words[at : at + 1] = rng.choice([[f"w{rng.randint(0, pool)}"], [], [words[at], f"w{rng.randint(0, 400)}"]])
        docs[i] = " ".join(words)
    rows = neardup.near_duplicates(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), words=size).collect()
    assert {r.doc_id: r.component_id for r in rows} == linked(docs, size)
    assert 1 < len({r.component_id for r in rows}) < 300


def test_pipeline_matches_plain_python(spark, oracle):
    docs = {d: t for d, t in texts(oracle).items() if any(c.isalpha() for c in t)}
    docs = {d: t for d, (t, _) in deduplicated(docs).items()}
    heads = linked(docs, 5)
    docs = {d: t for d, t in docs.items() if heads[d] == d}
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(SMALL))
    windows = set()
    for text in texts(oracle, "benchmark", "text", "item_id").values():
        w = words(text)
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(w) for w in windows}
    for doc, text in list(docs.items()):
        w = words(text)
        if any(tuple(w[i : i + n]) in windows for n in sizes for i in range(len(w) - n + 1)):
            del docs[doc]
    rows = corpus_pipeline.run(spark, str(TABLES)).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == pieces_of(docs)
    check_places(rows)


def test_registered():
    import __spark_entry__ as entry

    numbers = [re.match(r"op(\d+)_", name)[1] for name in queries.queries()]
    assert sorted(map(int, numbers)) == list(range(1, 14))
    assert set(queries.queries()) | {"pipeline"} <= set(entry.queries())


def test_pieces_do_not_depend_on_what_a_worker_remembers(spark):
    import public_tokenizers
    from loomwright.llm import packing

    rows = [(i, " ".join(f"word{i * j} is, {j}" for j in range(i % 40))) for i in range(300)] + [(None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    path = public_tokenizers.path("byte_bpe_50k.json")
    expected = sorted(map(str, packing.cut_pieces(docs, path, 64, 0).collect()))
    assert sorted(map(str, packing.cut_pieces(docs, path, 64, 0, remember=50, size=1000).collect())) == expected


def test_workers_get_little_text_at_once(spark):
    import pyarrow as pa

    from loomwright import session

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "bytes": [batch.nbytes]})

    text = F.concat_ws(" ", F.col("id"), F.expr("repeat(concat('word', id, ' and more\\n'), 200)"))
    docs = spark.range(3000).coalesce(1).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"))
    before = spark.conf.get(session.BATCH_BYTES)
    try:
        for operator in (lambda: linededup.remove_repeated_chunks(docs.limit(5)), lambda: language.predict(docs.limit(5), language.train(docs.limit(5)))):
            spark.conf.set(session.BATCH_BYTES, before)
            operator()
            got = docs.select("text").mapInArrow(sizes, "rows long, bytes long").collect()
            assert sum(r.rows for r in got) == 3000 and sum(r.bytes for r in got) > 3 * session.MOST_BATCH_BYTES
            assert max(r.bytes for r in got) < 1.5 * session.MOST_BATCH_BYTES
        spark.conf.set(session.BATCH_BYTES, "1000")  # stays, as it is lower
        session.limit_batches(docs)
        assert spark.conf.get(session.BATCH_BYTES) == "1000"
    finally:
        spark.conf.set(session.BATCH_BYTES, before)


def test_scoring_and_cutting_do_not_depend_on_the_batch(spark):
    from loomwright import session

    rows = [(i, "\n".join(f"line {i * j % 7} of words {j}, and a few more to make it long" for j in range(i % 40)), "en" if i % 2 else "de") for i in range(200)]
    docs = spark.createDataFrame([*rows, (None, None, None), (5, "", "en")], "doc_id long, text string, lang string").coalesce(1)
    before, found = spark.conf.get(session.BATCH_BYTES), []
    try:
        for most in ("64m", "100"):
            spark.conf.set(session.BATCH_BYTES, most)
            guessed = language.predict(docs, language.train(docs)).select("doc_id", "text", "lang_pred", "score")
            found.append([sorted(map(str, df.collect())) for df in (guessed, linededup.remove_repeated_chunks(docs))])
    finally:
        spark.conf.set(session.BATCH_BYTES, before)
    assert found[0] == found[1]
