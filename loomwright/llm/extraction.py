"""Main text of web pages by equivalence classes of template tokens.

The tags of a page, told apart by their path from the root, and its blocks of text are
tokens. Over the pages of one host a token has an occurrence vector: how often each page has
it. Tokens with the same vector form an equivalence class, and classes that many pages share
come from the template that the host fills in. Classes are nested by the paths of their
tags; the class whose tags every page has exactly once is the frame, and what stands between
its tags are the slots. Text that the pages of a host share is part of the template, and of
the slots the one with the article is extracted.

Vectors are never built: a sum over the pages of a hash of page and count stands for them,
so that a host with any number of pages is summed up before the shuffle.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_batches, map_batches, mix, staged, texts_of, work_for

# A token belongs to the template of a host that has it on this part of its pages, and on
# so many pages at least.
SHARE, LEAST_PAGES = 0.5, 3
# Outlines that this part of the pages of a host has, or more, have templates of their own.
OUTLINE_SHARE = 1 / 64

# Names of elements, of roles and of parts of class names and ids.
RAW = "script|style|noscript|template|textarea|select|svg|iframe|object|canvas|math|xmp|title|video|audio"
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
FRAME = frozenset("article aside body center div footer form header html main nav section table".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NO_TEXT = frozenset("head nav footer aside form button dialog menu label input noscript".split())
NO_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
# A class or id tells something only if all its parts are of these or, besides one of these, of
# the names of parts of a page below. Others are left to the template.
NO_TEXT_PARTS = re.compile(
    r"(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner\w*|nav|navbar|navigation|menu\w*|sidebar\w*|side|aside|"
    r"foot|footer|cookies?|consent|gdpr|notices?|notification\w*|alerts?|popup|modal|overlay|newsletter|subscri\w*|signup|login|"
    r"share|sharing|social|comments?|commentlist|disqus|repl(?:y|ies)|respond|related|recommend\w*|breadcrumbs?|pagination|pager|"
    r"widgets?|skip|legal|copyright|disclaimer|toolbar|search|form|hidden)\d*",
    re.IGNORECASE,
)
OTHER_PARTS = re.compile(
    r"(?:area|bar|block|body|bottom|box|buttons?|container|content|entry|group|holder|icons?|inner|items?|links?|list|main|outer|page|"
    r"panel|posts?|primary|secondary|section|site|slot|text|thread|top|unit|wrap|wrapper|\d*)",
    re.IGNORECASE,
)


def _no_text_name(names: str) -> bool:
    """Whether one of the classes and ids says that this is no main text. ``has-sidebar`` or
    ``comments-open`` say something else."""
    for name in names.split():
        parts = re.split("[-_]", name)
        said = [bool(NO_TEXT_PARTS.fullmatch(part)) for part in parts]
        if any(said) and all(own or OTHER_PARTS.fullmatch(part) for own, part in zip(said, parts, strict=True)):
            return True
    return False


HEADER_NAMES = re.compile(r"(?:^|[-_\s])(?:header|masthead|topbar|site-title)(?:$|[-_\s\d])", re.IGNORECASE)
MAIN_NAMES = re.compile(
    r"(?:^|[-_\s])(?:article|articlebody|post|entry|story|content|main|text|body)(?:$|[-_\s\d])", re.IGNORECASE
)

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_QUOTE_OR_END = re.compile(r"[\"'>]")
_RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW.split("|")}
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_DIGITS = re.compile(r"\d+")

# What an element is for: nothing special, no main text, a page header, the main text, or no main
# text by its name only.
PLAIN, DROPPED, HEADER, MAIN, DOUBTFUL = 0, 1, 2, 3, 4


# Elements within more others than this belong to the last of those, as in browsers.
MOST_DEPTH = 200
# In an element without text that is never closed, these begin something else.
RESTART = HEADINGS | frozenset("article main p section".split())


class Element:
    __slots__ = ("name", "path", "role", "main", "inner")

    def __init__(self, name: str, path: str, role: int, main: int):
        self.name, self.path, self.role, self.main = name, path, role, main
        self.inner = 0  # open elements of the same name in an inline element


def _end_of_tag(page: str, at: int) -> tuple[int, int]:
    """Where the attributes of a tag end, and where the tag does. A quote is closed by the next one if a
    blank or the end of the tag follows; otherwise it was never closed and the tag ends at
    the next ``>``. Without one, there is no tag: -1."""
    start = at
    while found := _QUOTE_OR_END.search(page, at):
        if found[0] == ">":
            return found.start(), found.end()
        close = page.find(found[0], found.end())
        if close < 0 or (page[close + 1 : close + 2] or ">") not in " \t\r\n\f/>":
            close = page.find(">", found.end())
            return (start, -1) if close < 0 else (close, close + 1)
        at = close + 1
    return start, -1


def tags_of(page: str) -> list[tuple[int, int, bool, str, str]]:
    """The tags of a page: start, end, whether it closes, name, attributes. Comments and what is
    in elements without markup are tags without a name. One pass: whatever is searched for is passed
    over when it is found, and if it is not there, nothing behind can be a tag either."""
    out, at, size = [], 0, len(page)
    last = page.rfind(">")
    while 0 <= (start := page.find("<", at)):
        first = page[start + 1 : start + 2]
        if page.startswith(("<!--", "<![CDATA["), start):
            close = "-->" if page.startswith("<!--", start) else "]]>"
            end = page.find(close, start + 4)
            at = size if end < 0 else end + len(close)
            out.append((start, at, False, "", ""))
            continue
        if start > last:
            break
        name = _NAME.match(page, start + 2 if first == "/" else start + 1)
        if name is None:
            if first and first in "!?/":
                at = page.find(">", start) + 1
                out.append((start, at, False, "", ""))
            else:
                at = start + 1
            continue
        inner, end = _end_of_tag(page, name.end())
        if end < 0:
            # An open quote takes in all that is left.
            at = start + 1
            last = -1
            continue
        own = name[0].lower()
        if first != "/" and own in _RAW_ENDS and page[inner - 1] != "/":
            closing = _RAW_ENDS[own].search(page, end)
            end = size if closing is None else (page.find(">", closing.end()) + 1 or size)
            own = ""
        out.append((start, end, first == "/", own, page[name.end() : inner]))
        at = end
    return out


def _attributes(text: str) -> dict[str, str]:
    return {name.lower(): value.strip("\"'") for name, value in _ATTRIBUTE.findall(text)} if text.strip(" /") else {}


def _opened(name: str, attributes: dict[str, str], parent: Element) -> Element:
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".strip()
    label = _DIGITS.sub("0", f"{name}.{'.'.join(names.split())}") if names else name
    aria = attributes.get("role", "").lower()
    role = parent.role
    # What stands in a dropped element stays dropped.
    if role != DROPPED and name not in ("html", "body"):
        hidden = "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "")
        article = name == "article" or aria in ("main", "article") or name == "main"
        if name in NO_TEXT or aria in NO_TEXT_ROLES or hidden:
            role = DROPPED
        elif role == DOUBTFUL or (names and not article and attributes.get("itemprop") != "articleBody" and _no_text_name(names)):
            role = DOUBTFUL
        elif name == "header" or (names and HEADER_NAMES.search(names)):
            role = HEADER
        elif article:
            role = MAIN
    # How surely this is the article: 3 for its element, 2 for the main one, 1 by its name.
    main = parent.main
    if role != DROPPED:
        if name == "article" or attributes.get("itemprop") == "articleBody":
            main = max(main, 3)
        elif name == "main" or aria == "main":
            main = max(main, 2)
        elif names and MAIN_NAMES.search(names) and name not in ("html", "body"):
            main = max(main, 1)
    return Element(name, f"{parent.path}/{label}", role, main)


def read_page(page: str) -> tuple[list[tuple[Element, str]], Counter]:
    """The blocks of text of a page, each with the element it stands in, and how often each
    path occurs. Unclosed and stray tags are taken as browsers take them, more or less; but an
    element without text that is never closed ends where an article, a heading or a paragraph begins."""
    root = Element("", "", PLAIN, 0)
    stack, blocks, tags, parts = [root], [], Counter(), []
    found = tags_of(page)
    opened = Counter(name for *_, closes, name, _ in found if name in NO_TEXT and not closes)
    opened.subtract(Counter(name for *_, closes, name, _ in found if name in NO_TEXT and closes))
    unclosed = {name for name, times in opened.items() if times > 0 and name not in VOID}

    def end_block() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                blocks.append((block(), text))

    def block() -> Element:
        return next(e for e in reversed(stack) if not e.name or e.name in BLOCKS)

    def muted() -> bool:
        """Whether text stands in an inline element that drops it. The block goes on around it."""
        top = stack[-1]
        return top.name not in BLOCKS and top.name != "" and top.role in (DROPPED, DOUBTFUL)

    at = beyond = 0
    for start, end, closes, name, attributes in found:
        if start > at and not muted():
            parts.append(page[at:start])
        at = end
        if not name:
            continue
        if name == "br":
            parts.append(" ")
        elif closes:
            if name in BLOCKS and beyond:
                end_block()
                beyond -= 1
            elif name in BLOCKS and any(e.name == name for e in stack):
                end_block()
                while stack.pop().name != name:
                    pass
            elif name in BLOCKS:
                end_block()
            elif stack[-1].name == name and stack[-1].inner:
                stack[-1].inner -= 1
            elif len(stack) > 1 and stack[-1].name == name:
                stack.pop()
        elif name in BLOCKS:
            end_block()
            if unclosed and name in RESTART and any(e.name in unclosed for e in stack):
                while any(e.name in unclosed for e in stack):
                    stack.pop()
            if name == "p" or name in HEADINGS:
                closing = {"p"}
            else:
                closing = {"p", name} if name in ("li", "td", "th", "tr", "dt", "dd", "option") else {"p"}
            while stack[-1].name in closing:
                stack.pop()
            if len(stack) > MOST_DEPTH:
                beyond += name not in VOID
                continue
            element = _opened(name, _attributes(attributes), stack[-1])
            tags[element.path] += 1
            if name not in VOID:
                stack.append(element)
        elif name not in VOID and not attributes.endswith("/"):
            # Inline elements count only if they drop text.
            element = _opened(name, _attributes(attributes), stack[-1]) if attributes.strip(" /") else stack[-1]
            if element.role != stack[-1].role and element.role in (DROPPED, DOUBTFUL) and len(stack) <= MOST_DEPTH:
                stack.append(element)
            elif stack[-1].name == name:
                stack[-1].inner += 1
    if at < len(page) and not muted():
        parts.append(page[at:])
    end_block()
    return blocks, tags


def host_of(url: str | None) -> str:
    """The host of an address; none has the empty name."""
    found = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return found[1].lower() if found else ""


def _text_token(path: str, text: str) -> int:
    return np.uint64(xxhash.xxh3_64_intdigest(f"{path}\n{text}")).astype(np.int64)


def _hash(text: str) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(text)).astype(np.int64))


def _outline(tags: Counter) -> int:
    """What pages of one template have in common: the outer elements that hold others."""
    return _hash(str(sorted((p, n) for p, n in tags.items() if p.count("/") <= 3 and _element_of(p) in FRAME)))


def _read(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    """For each page its host, a hash of its texts, and its outline and tokens: path, hash of the
    text or none, how often, and characters."""
    hosts, contents, packed = [], [], []
    for url, page in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
        blocks, tags = read_page(page)
        own: Counter = Counter({(path, None): times for path, times in tags.items()})
        size: dict[tuple, int] = defaultdict(int)
        for element, text in blocks:
            key = element.path, int(_text_token(element.path, text))
            own[key] += 1
            size[key] += len(text) if element.role not in (DROPPED, HEADER, DOUBTFUL) else 0
        own["", None] += 1
        tokens = [(path, text, n, size.get((path, text), 0)) for (path, text), n in own.items()]
        hosts.append(host_of(url))
        contents.append(_hash("\n".join(text for _, text in blocks)))
        packed.append(zlib.compress(json.dumps((_outline(tags), tokens)).encode(), 1))
    return {"host": pa.array(hosts, pa.string()), "content": pa.array(contents, pa.int64()), "packed": pa.array(packed, pa.binary())}


def _tokens(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    """Tokens of the pages of a batch, summed up by host and outline: how many pages have a token, how
    often, the sum that stands for the vector, and the characters of text."""
    found: dict[tuple, list] = defaultdict(lambda: [0, 0, 0, 0])
    for host, row, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_numpy(), batch.column(2).to_pylist(), strict=True):
        outline, own = json.loads(zlib.decompress(packed))
        times = np.array([n for _, _, n, _ in own], np.uint64)
        hashed = mix(times + mix(np.full(len(own), row).astype(np.uint64)))
        for (path, text, n, chars), vector in zip(own, (hashed >> np.uint64(24)).tolist(), strict=True):
            sums = found[host, outline, path, text]
            sums[0] += 1
            sums[1] += n
            sums[2] += vector
            sums[3] += chars
    keys, sums = list(found), np.array(list(found.values()), np.int64).reshape(-1, 4)
    return {
        "host": pa.array([k[0] for k in keys], pa.string()),
        "outline": pa.array([k[1] for k in keys], pa.int64()),
        "path": pa.array([k[2] for k in keys], pa.string()),
        "text": pa.array([k[3] for k in keys], pa.int64()),
        **{name: pa.array(sums[:, i]) for i, name in enumerate(("pages", "times", "vector", "chars"))},
    }


def templates(pages: DataFrame) -> DataFrame:
    """The template of each host: ``host``, ``texts`` (hashes of the text that its pages share)
    and ``classes`` (the paths of each equivalence class with the number of pages, whether
    every page has each of them once, and the characters that vary below each path).

    Pages with the same texts are copies, which say nothing about a template, and count once. Of a
    host only tokens that half of its pages have are kept, or half of those with the same outline, if
    ``OUTLINE_SHARE`` of its pages have that outline: the template of a host is no larger than
    twice a page for each of those.
    """
    read = map_batches(pages.select("url", "html"), _read, "host string, content long, packed binary")
    rows = read.groupBy("host", "content").agg(F.min("packed").alias("packed"))
    schema = "host string, outline long, path string, text long, pages long, times long, vector long, chars long"
    sums = [F.sum(c).alias(c) for c in ("pages", "times", "vector", "chars")]
    key = ["host", "path", "text"]
    by_outline = staged(map_batches(rows, _tokens, schema, text=2).groupBy("outline", *key).agg(*sums), "outlines")
    outlines = by_outline.where("path = '' AND text IS NULL").select("host", "outline", F.col("pages").alias("all"))
    sizes = staged(outlines.groupBy("host").agg(F.sum("all").alias("pages")), "sizes")
    outlines = outlines.join(sizes, "host").where(F.col("all") >= OUTLINE_SHARE * F.col("pages")).select("host", "outline", "all")
    outlines = staged(outlines, "outline-pages")
    often = by_outline.where(F.col("text").isNotNull() & (F.col("pages") >= LEAST_PAGES)).join(outlines, ["host", "outline"])
    often = often.where(F.col("pages") >= SHARE * F.col("all")).select(*key).distinct().withColumn("often", F.lit(True))
    # Tags have no text and are joined to nothing.
    tokens = staged(by_outline.groupBy(*key).agg(*sums).join(often, key, "left"), "tokens")
    # Written, so that the size of the table is known before it is joined: the tokens of a
    # large host need not come together for it.
    hosts = tokens.where("path = '' AND text IS NULL").select("host", F.col("pages").alias("all"), F.col("vector").alias("each"))
    hosts = staged(hosts, "hosts")
    on_half = (F.col("pages") >= LEAST_PAGES) & (F.col("pages") >= SHARE * F.col("all"))
    template = on_half | F.coalesce("often", F.lit(False))
    shared = tokens.join(hosts, "host").where(template)
    texts = shared.where("text IS NOT NULL").groupBy("host").agg(F.collect_list("text").alias("texts"))
    varying = tokens.join(hosts, "host").where("text IS NOT NULL").where(~template)
    slots = varying.groupBy("host", "path").agg(F.sum("chars").alias("varies"))
    tags = shared.where("text IS NULL AND path <> ''").join(slots, ["host", "path"], "left")
    member = F.struct("path", F.coalesce("varies", F.lit(0)).alias("varies"))
    classes = tags.groupBy("host", "vector").agg(
        F.max("pages").alias("pages"), F.max((F.col("vector") == F.col("each")).cast("int")).alias("once"), F.collect_list(member).alias("members")
    )
    nested = classes.groupBy("host").agg(F.collect_list(F.struct("pages", "once", "members")).alias("classes"))
    return nested.join(texts, "host", "full_outer")


def _element_of(path: str) -> str:
    """The name of the element at the end of a path."""
    return path[path.rindex("/") + 1 :].partition(".")[0]


def main_slot(classes: list[dict] | None) -> str | None:
    """The slot of the frame where most of the varying text stands: from the root down to the
    child that has more than half of what its parent has. Classes nest by their paths: what
    varies in a class counts for all paths above it."""
    below: dict[str, int] = defaultdict(int)
    for group in classes or ():
        for member in group["members"]:
            path = member["path"]
            while path:
                below[path] += member["varies"]
                path = path.rpartition("/")[0]
    frame = sorted((m["path"] for g in classes or () if g["once"] for m in g["members"]), key=lambda p: p.count("/"))
    chosen = None
    for path in frame:
        if below[path] and (chosen is None or (path.startswith(chosen + "/") and 2 * below[path] > below[chosen])):
            chosen = path
    return chosen


def extract(page: str, texts: frozenset[int], slot: str | None) -> str:
    """The main text of a page, given the text that its host repeats and the slot of the article."""
    blocks, tags = read_page(page)
    kept = [(e, t) for e, t in blocks if e.role != DROPPED and (e.role != HEADER or (e.main and e.name in HEADINGS))]
    sure = [(e, t) for e, t in kept if e.role != DOUBTFUL]
    if not any(e.main >= 2 for e, _ in sure):
        # What holds the only article with most of the text, or all text, is no menu whatever its
        # name. Several articles can be comments or cards.
        inside = [(e, t) for e, t in kept if e.main >= 2]
        articles = sum(n for path, n in tags.items() if _element_of(path) in ("article", "main"))
        if sure and (articles > 1 or sum(len(t) for _, t in inside) <= sum(len(t) for _, t in sure)):
            inside = []
        sure = inside or sure or kept
    kept = sure
    # A page is more than its template.
    fresh = [(e, t) for e, t in kept if int(_text_token(e.path, t)) not in texts] or kept
    surest = max((e.main for e, _ in fresh), default=0)
    if surest >= 2:
        inner = [i for i, (e, _) in enumerate(fresh) if e.main == 3]
        articles = sum(n for path, n in tags.items() if _element_of(path) == "article")
        weight = sum(len(fresh[i][1]) for i in inner)
        if inner and articles <= 1 and 2 * weight > sum(len(t) for e, t in fresh if e.main >= 2):
            # One article with most of the text is the story, with the headings in front of it.
            chosen = [t for i, (e, t) in enumerate(fresh) if e.main == 3 or (e.main == 2 and e.name in HEADINGS and i < inner[0])]
        else:
            # Articles within the main element can be cards, so its own text stays too.
            chosen = [t for e, t in fresh if e.main >= 2]
    else:
        inside = [(e, t) for e, t in fresh if slot and (e.path == slot or e.path.startswith(slot + "/"))]
        chosen = [t for e, t in inside or fresh if e.main == surest or inside]
    return "\n".join(chosen)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages`` (``page_id, url, html``).

    ``text`` has the blocks of the article, in order, a line each. A null ``html`` is an empty
    page, and a page without main text has an empty text. Pages without a host share a
    template. On hosts with fewer than ``LEAST_PAGES`` pages only the page itself tells what
    is what.
    """
    pages = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    by_host = staged(templates(pages), "templates")

    @F.arrow_udf("string")
    def hosts(url: pa.Array) -> pa.Array:
        return pa.array([host_of(u) for u in url.to_pylist()], pa.string())

    joined = pages.withColumn("host", hosts("url")).join(by_host, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work_for(__name__)
        known: dict[str, tuple[frozenset[int], str | None]] = {}
        for batch in in_batches(batches, 4 << 20, text=2):
            out = []
            for page, host, texts, classes in zip(texts_of(batch.column(2)), *(batch.column(k) for k in (3, 4, 5)), strict=True):
                name = host.as_py()
                if name not in known:
                    if len(known) > 200:
                        known.clear()
                    known[name] = frozenset(texts.as_py() or ()), main_slot(classes.as_py())
                out.append(extract(page, *known[name]))
            yield pa.RecordBatch.from_pydict(
                {
                    "page_id": batch.column(0),
                    "url": batch.column(1),
                    "text": pa.array(out, pa.string()),
                    "n_chars": pa.array([len(t) for t in out], pa.int64()),
                }
            )

    columns = joined.select("page_id", "url", "html", "host", "texts", "classes")
    return columns.mapInArrow(run, "page_id long, url string, text string, n_chars long")
