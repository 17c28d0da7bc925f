"""The parts that need no Spark, against plain Python."""

import gzip
import io
import itertools
import random
import string
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers
from loomwright.llm import eliasfano, extraction, language, linededup, neardup, packing, repetition, toxicity, warc
from loomwright.llm.tokens import TextEncoder, encoder

ENCODERS = {name: TextEncoder(public_tokenizers.path(name), remember=50) for name in ("byte_bpe_50k.json", "word_bpe_49k.json")}


@pytest.mark.parametrize("name", sorted(ENCODERS))
@settings(deadline=None, max_examples=150)
@given(texts=st.lists(st.text(alphabet="ab Zé'.,\n\t\x01\x1ćİ <|endoftext|>9", max_size=14), max_size=6))
def test_ids_are_those_of_the_library(name, texts):
    own = ENCODERS[name]
    expected = [np.asarray(e.ids, "<u4").tobytes() for e in own.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert own.encode(texts) == expected


@pytest.mark.parametrize("name", sorted(ENCODERS))
@pytest.mark.parametrize("remember", [4, 100_000])
def test_letters_with_punctuation_and_line_breaks_go_to_the_model(name, remember):
    own, rng = TextEncoder(public_tokenizers.path(name), remember=remember), random.Random(5)
    signs = ["", ",", ".", "***", ",%%%", ").", "!?", "'s", "'.", ".'", "-", "-" * 40, *string.punctuation]
    words = ["".join(rng.choices("abcdeZ\u00e9\u00df\u00c9", k=rng.randint(1, 7))) for _ in range(300)]
    others = ["\u0130", "\u4e2d", "e\u0301", "1", "", "\t", "\u00a0"]
    texts = [
        "".join(rng.choice([" ", " ", "\n"]) + rng.choice(words if rng.random() < 0.97 else others) + rng.choice(signs) for _ in range(rng.randint(0, 20)))[k % 2 :]
        for k in range(600)
    ]
    expected = [np.asarray(e.ids, "<u4").tobytes() for e in own.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [ids for k in range(0, len(texts), 50) for ids in own.encode(texts[k : k + 50])] == expected
    given, library, pieces = [], own._library, own._pieces
    own._library = lambda texts: given.extend(texts) or library(texts)
    own._pieces = lambda words: given.extend(words) or pieces(words)
    new = ["quokka***", "quokka,", "quokka!?", "\nquokka", "\nquokka.", "\n\u00fcbung***", "\u00fcbung)."]
    texts = ["A " + " ".join(new).replace(" \n", "\n"), "B " + new[0]]
    assert own.encode(texts) == library(texts)
    assert given == ["A", "B"]


def test_many_kinds_of_punctuation_are_not_remembered():
    own = ENCODERS["byte_bpe_50k.json"]
    texts = [" ".join(f"a{''.join(p)}" for p in itertools.islice(itertools.product("!-.*#", repeat=6), 0, 15_625, 5))]
    assert own.encode(texts) == own._library(texts)
    assert len(own.tails) <= 1002


def test_a_worker_remembers_as_many_words_as_it_is_told():
    path = public_tokenizers.path("byte_bpe_50k.json")
    for remember, most in ((100, 200), (1000, 1200)):
        own = encoder(path, remember=remember)
        for k in range(100):
            own.encode([" ".join(f"w{remember}x{k}y{i}" for i in range(20))])
        assert len(own.known) + len(own.older) < most
    neardup.shingles([" ".join(f"word{i}" for i in range(neardup.MOST_WORDS + 1000))], 2)
    assert len(neardup._hashes) <= neardup.MOST_WORDS <= 100_000


@settings(deadline=None, max_examples=60)
@given(counts=st.dictionaries(st.integers(1, 200), st.integers(1, 40), max_size=40))
def test_plan_places_every_piece(counts):
    bins = packing.plan(counts, 200, groups=8)
    got = Counter()
    for b in bins:
        assert b.count > 0 and b.free >= 0
        end = 0
        for length, copies, offset in b.items:
            assert offset == end
            end += length * copies
            got[length] += copies * b.count
        assert end + b.free == 200
    assert got == Counter(counts)
    table = packing.places(bins)
    assert (table.groupby("length")["rank"].min() == 0).all()


def test_plan_is_near_the_bound():
    rng = random.Random(1)
    counts = Counter(min(2048, int(rng.lognormvariate(6.3, 1))) or 1 for _ in range(20_000))
    bound = -(-sum(n * c for n, c in counts.items()) // 2048)
    assert sum(b.count for b in packing.plan(counts, 2048)) <= 1.01 * bound


@settings(deadline=None, max_examples=80)
@given(values=st.lists(st.integers(0, 10**6), max_size=400).map(sorted))
def test_elias_fano_round_trip(values):
    coded = eliasfano.encode(np.asarray(values, np.uint64))
    own = eliasfano.EliasFano.decode(coded)
    assert own.n == len(values) and own.block(0, own.n).tolist() == values
    assert [own[i] for i in range(len(values))] == values
    if len(values) > 5:
        assert own.block(2, 3).tolist() == values[2:5]


def test_elias_fano_is_small():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 2000, 10_000))
    assert len(eliasfano.encode(ends)) < 2 * len(ends)


def repeats(text):
    """The measures of a text the slow way."""
    w = text.encode().split()
    n = len(w)
    windows = Counter(tuple(w[i : i + 5]) for i in range(n - 4))
    repeated = {k for i in range(n - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    best = [0] * n
    for i in range(n):
        for j in range(n):
            length = 0
            while i != j and max(i, j) + length < n and w[i + length] == w[j + length]:
                length += 1
            best[i] = max(best[i], length)
    long = {k for i in range(n) if best[i] >= repetition.LONG for k in range(i, i + best[i])}
    maximal = [(i, best[i]) for i in range(n) if best[i] >= 5 and not (i and best[i - 1] > best[i])]
    return n, len(repeated), len(long), max([b for b in best if b >= 5], default=0), maximal


def test_repetition_matches_brute_force():
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 50))) for _ in range(60)]
    texts += ["", " ", "a", "a b c d e f g h i j " * 8, "x " * 40, "é b c d e é b c d e"]
    got = repetition._measure(pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts}))
    for i, text in enumerate(texts):
        own = [got[c][i].as_py() for c in ("n_words", "n_repeat_words", "n_long_words", "longest_repeat")]
        spans = [(r["start"], r["length"]) for r in got["repeats"][i].as_py()]
        assert (*own, spans) == repeats(text), text


def test_base_measures():
    text = "# a b\nc\n\nc\n \nc | é"
    got = repetition._measure(pa.RecordBatch.from_pydict({"doc_id": [1], "text": [text]}))
    assert [got[c][0].as_py() for c in ("word_chars", "n_symbols", "n_dup_lines")] == [8, 2, 1]


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 2**63, 3000).astype(np.uint64))
    for share in (0.2, 0.5, 0.8):
        common = int(len(a) * 2 * share / (1 + share))
        b = np.concatenate([a[:common], rng.integers(0, 2**63, len(a) - common).astype(np.uint64)])
        table = neardup.sketches(np.concatenate([a, b]), np.array([len(a), len(b)]), 2000)
        assert abs((table[0] == table[1]).mean() - share) < 0.06
    few = neardup.sketches(np.array([5, 5, 7], np.uint64), np.array([1, 2, 0]), 50)
    assert (few[:2] != 0).all() and (few[2] == 0).all()


def test_shingles_of_short_texts():
    values, counts = neardup.shingles(["a", "A", "", " \n", "a b", "b a", "a b c", "a a a"], 2)
    assert counts.tolist() == [1, 1, 0, 0, 1, 1, 2, 1]
    ends = np.cumsum(counts)
    one = [set(values[e - n : e].tolist()) for e, n in zip(ends, counts, strict=True)]
    assert one[0] == one[1] and one[4] != one[5] and one[4] < one[6] and one[0] != one[7]


def test_chunks_are_shift_resistant():
    rng = random.Random(2)
    passage = [" ".join(rng.choice("abcdefgh") * 3 for _ in range(8)) for _ in range(40)]
    inside = {"\n".join(passage[s : s + n]) for s, n in linededup.chunks(passage)}
    other = ["x y z"] * 3 + passage + ["some end"]
    moved = {"\n".join(other[s : s + n]) for s, n in linededup.chunks(other)}
    assert len(inside & moved) > 0.8 * len(inside)
    long = " ".join(["w"] * 50)
    assert (1, 1) in linededup.chunks(["short", long, "short", "shorter"])


def repeated_lines(docs):
    """Lines of the maximal passages that stand in an earlier document too, words at both edges, with two
    lines and 20 words or with 50 words: by comparing all pairs of lines."""
    gone = [set() for _ in docs]
    for later in range(len(docs)):
        for earlier in range(later):
            a, b = docs[later], docs[earlier]
            for i, j in itertools.product(range(len(a)), range(len(b))):
                if a[i] != b[j] or (i and j and a[i - 1] == b[j - 1]):
                    continue
                n = next((n for n in range(min(len(a) - i, len(b) - j)) if a[i + n] != b[j + n]), min(len(a) - i, len(b) - j))
                said = [k for k in range(i, i + n) if a[k].split()]
                if sum(len(a[k].split()) for k in said) >= (20 if len(said) > 1 else 50):
                    gone[later].update(range(said[0], said[-1] + 1))
    return gone


def test_passages_of_short_lines_are_found_whole():
    rng = random.Random(5)
    numbers = itertools.count()

    def lines(n, least, most):
        return ["" if rng.random() < 0.15 else " ".join(f"w{next(numbers)}" for _ in range(rng.randint(least, most))) for _ in range(n)]

    for _ in range(60):
        passages = [lines(rng.randint(2, 9), 1, rng.choice([20, 45, 70])) for _ in range(3)]
        docs = [sum(([*lines(rng.randint(0, 3), 1, 20), *rng.choice(passages)] for _ in range(2)), []) + lines(2, 1, 20) for _ in range(3)]
        docs = [d for d in docs if len({x for x in d if x}) == len([x for x in d if x])]  # no repeats in a text
        places, found = {}, []
        for doc in docs:
            spans = [(tuple(doc[s : s + n]), s, n) for s, n in linededup.chunks(doc) if sum(len(x.split()) for x in doc[s : s + n]) >= 20]
            found.append({k for own, s, n in spans if own in places for k in range(s, s + n) if k < len(doc)})
            places.update((own, 1) for own, _, _ in spans)
        for doc, want, got in zip(docs, repeated_lines(docs), found, strict=True):
            # Blank lines at the edge of a run may go with it.
            assert {k for k in want ^ got if doc[k].split()} == set() and want <= got


def test_a_line_over_and_over_keeps_its_first_run():
    again = " ".join(["w"] * 20)  # a run is two lines
    for times in range(3, 12):
        lines = ["a b", *[again] * times, "c d"]
        spans = [s for s in linededup.chunks(lines) if all(lines[k] == again for k in range(s[0], sum(s)))]
        starts = [start for start, n in spans if n == 2]
        assert starts == [1, *range(3, times)]
        # A copy goes whole.
        assert {k for start, n in spans for k in range(start, start + n)} == set(range(1, times + 1))


def test_language_filter():
    codes = np.arange(1, 2000, dtype=np.uint64)
    members = np.zeros((len(codes), 70), bool)
    members[:1000, 3] = members[500:, 68] = True
    own = language.Filter.build([f"l{i:02d}" for i in range(70)], codes, members)
    masks = own.lookup(codes)
    found = np.stack([(masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1) for i in (3, 68)], axis=1).astype(bool)
    assert (found | ~members[:, [3, 68]]).all()  # never less than what was put in
    assert (found & ~members[:, [3, 68]]).mean() < 0.02 and own.fill.max() < 0.05


def test_ordinal_grades_are_ordered():
    rng = np.random.default_rng(4)
    grades = rng.integers(0, 4, 600)
    rows, columns = np.arange(600), np.zeros(600, int)
    weights, thresholds = toxicity.fit(rows, columns, grades + rng.normal(0, 0.3, 600), grades, 1)
    assert (np.diff(thresholds) > 0).all() and weights[0] > 0
    model = toxicity.Ordinal({}, weights, thresholds)
    severity = model.chances(weights[0] * np.arange(4.0)).sum(axis=1)
    assert (np.diff(severity) > 0.5).all()


PAGE = (
    "<html><head><title>t</title><style>p{}</style></head><body><header>Site</header><nav><a>Home</a></nav>"
    '<div class="cookie-notice">We use cookies</div><article><h1>A &amp; B</h1><p>One\n two<br>three<p>Four <span class="ad">buy</span>five</p>'
    '<script>var x="</p>";</script><button>Send</button><ul><li>x<li>y</ul><div class="comments"><p>me too</p></div></article>'
    "<aside>side</aside><form><p>mail</p></form><footer>&copy; z</footer></body>"
)


def test_article_of_a_page():
    assert extraction.extract(PAGE, frozenset(), None) == "A & B\nOne two three\nFour five\nx\ny"
    assert extraction.extract("", frozenset(), None) == ""
    assert extraction.extract("<p>a<aside>b</aside><p>c &lt;d&gt;", frozenset(), None) == "a\nc <d>"


@pytest.mark.parametrize("names", ["content has-sidebar", "layout no-sidebar", "page-wrap side-left", "post comments-open", "entry legal-news"])
def test_names_that_only_mention_what_is_dropped(names):
    side = '<div class="sidebar">menu</div><div id="site-footer">c</div><div class="post-comments"><article>me too</article><article>so do I</article></div>'
    for page in ('<div class="{}"><p>a</p>SIDE</div>', '<div class="{}"><article><p>a</p></article>SIDE</div>', '<main class="{}"><p>a</p>SIDE</main>'):
        assert extraction.extract("<body>" + page.format(names).replace("SIDE", side), frozenset(), None) == "a"
    assert extraction.extract('<div class="sidebar-wrapper"><p>b</p><article class="legal"><p>a</p></article></div>', frozenset(), None) == "a"
    assert extraction.extract('<p>b</p><div class="legal"><article><p>a b c</p></article></div>', frozenset(), None) == "a b c"
    assert extraction.extract('<p>a b c</p><div class="comments"><article>d</article></div>', frozenset(), None) == "a b c"
    assert extraction.extract('<div class="widgets"><p>a</p><nav>b</nav></div>', frozenset(), None) == "a"


def test_records_stream_in_chunks():
    payload = "äb".encode() * 1000
    import hashlib

    sha1 = hashlib.sha1(payload).hexdigest()
    record = warc._head("urn:page:7:0", "http://a/b c", None, sha1, len(payload)) + payload + b"\r\n\r\n"
    revisit = warc._head("urn:page:6:1", None, "urn:page:7:0", sha1, len(payload)) + b"\r\n\r\n"
    data = gzip.compress(record) + gzip.compress(revisit)
    rows = list(warc.stream_records(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(data))), 1024))
    assert [len(r[-1]) for r in rows] == [1024, 1024, 952, 0]
    assert b"".join(r[-1] for r in rows) == payload
    assert [r[6] for r in rows] == [False, False, True, True] and rows[2][7] == rows[3][7] == 3000
    assert rows[2][8] == rows[3][8] == warc.base32(bytes.fromhex(sha1)) and rows[3][4] == "urn:page:7:0"
    for k, done in enumerate((1024, 2048, 3000)):
        assert rows[k][8] == warc.base32(hashlib.sha1(payload[:done]).digest())
    with pytest.raises(ValueError):
        list(warc.stream_records(io.BufferedReader(io.BytesIO(record.replace(b"b", b"c"))), 1024))


@pytest.mark.parametrize(("lines", "words"), [(2, 10), (3, 7), (4, 5), (5, 4), (6, 8), (8, 3)])
def test_recall_of_short_passages(lines, words):
    """Passages of 20 words or more in two to eight lines, in two documents between other lines: all of
    each is marked in the second one, and nothing else is."""
    rng = random.Random(lines)

    def line(n):
        return " ".join("".join(rng.choices("abcdefgh", k=7)) for _ in range(n))

    for _ in range(100):
        passage = [line(words) for _ in range(lines)]
        docs = [[line(rng.randint(1, 12)) for _ in range(rng.randint(1, 4))] + passage + [line(3)] for _ in range(2)]
        known = {"\n".join(docs[0][s : s + n]) for s, n in linededup.chunks(docs[0])}
        gone = {k for s, n in linededup.chunks(docs[1]) if "\n".join(docs[1][s : s + n]) in known for k in range(s, s + n)}
        assert [docs[1][k] for k in sorted(gone)] == passage


MEGABYTE = 1 << 20


@pytest.mark.parametrize("unit", ["<script ", '<a "', "<a '", "<!--", "<", "</", '<a href="x" ', "<![CDATA[", "</script", "<nav>", '<a ">', "<p>", "&amp;"])
@pytest.mark.parametrize("end", ["", ">", '"></script>'])
def test_hostile_pages_take_time_in_proportion(unit, end):
    import time

    page = unit * (MEGABYTE // len(unit)) + end
    start = time.process_time()
    extraction.extract(page, frozenset(), None)
    assert time.process_time() - start < 6  # a second or two here; with a quadratic scan hours


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<article><p>One two</p><a class="share">Share this</a><p>Three</p></article>', "One two\nThree"),
        (
            "<main><h1>Top</h1><article><p>The story is long and goes on.</p></article><h2>More stories</h2><ul><li>Card</li></ul></main>",
            "Top\nThe story is long and goes on.",
        ),
        ("<article><p>Before <span hidden>gone <span>inner</span> too</span> after</p></article>", "Before after"),
        ('<p title="it>Hello</p><p class="x">World</p>', "Hello\nWorld"),
        ('<p title="a > b" data-x=\'1 "2"\'>Hello</p>', "Hello"),
        ("<nav><a>Home</a><article><p>Story</p></article>", "Story"),
        ("<nav>Home<p>Text here</p><p>More</p>", "Text here\nMore"),
        ("<article><p>A</p><video src=x>Your browser has no video.</video><p>B</p></article>", "A\nB"),
        ("<article><p>a < b and c <3 d</p></article>", "a < b and c <3 d"),
        ("<article><SCRIPT>x</scripty> y</SCRIPT >z<br/>w</article>", "z w"),
        ("<main><p>The story itself, as the main text.</p><article>Card one</article><article>Card two</article></main>",
         "The story itself, as the main text.\nCard one\nCard two"),
    ],
)
def test_main_text_of(page, text):
    assert extraction.extract(page, frozenset(), None) == text


def test_repeats_of_a_long_text_in_little_memory():
    """The second half repeats the first; also against the places that were put there."""
    import tracemalloc

    rng = np.random.default_rng(2)
    half = rng.integers(0, 1 << 40, 100_000)
    codes = np.concatenate([half, half, [-1]])
    tracemalloc.start()
    starts, lengths = repetition.longest_repeats(codes, np.zeros(len(codes), np.int64))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert lengths.max() == 100_000 and len(starts) == 2 * (100_000 - 4)
    assert peak < 300 * len(codes)  # bytes; with an array of all words for each step twice that


def test_scoring_takes_little_memory():
    import tracemalloc

    texts = [(f"some words of text number {i} " * 40).encode() for i in range(language.GUESS_BYTES // 1000)]
    codes = np.unique(language.grams(texts[:20], 3)[0])
    model = language.Filter.build(["l1", "l2"], codes, np.ones((len(codes), 2), bool))
    tracemalloc.start()
    try:
        model.scores(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 50 << 20
