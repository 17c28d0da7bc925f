"""Near duplicates: fast similarity sketching, banding, exact verification.

A sketch has ``BANDS * ROWS`` coordinates. In each round all shingles of a text are hashed
into the coordinates, and a coordinate keeps the least value of the first round that reached
it; in later rounds every shingle goes to one coordinate, so all are filled after twice as
many rounds at most. Two sketches agree in a coordinate with the probability of the
similarity of the sets, as with MinHash, but a sketch takes few passes over the shingles.

Equal sets are one node from the start. Nodes that agree in a band are candidates. In a band
everybody is first compared with one node only, its leader, the one that most others agree with,
and linked nodes become one component. What is left are pairs of a band in different components.
They are found without forming the pairs of a band: two sets differ in all that they differ in from
their leader, but for what they differ in alike, so sets that are similar enough need an overlap
of their differences. Differences are ordered by rarity, and only prefixes that have to meet are
joined. Links are confirmed on the full sets, and pairs within a component need no confirmation.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW_ID, ROW_TEXT, join_rows, map_batches, mix, remembers, row_key, scratch, staged, texts_of
from .components import connected_components

ROWS, BANDS = 5, 40
SIMILARITY = 80  # percent
# Bits of each coordinate that a sketch is stored with, to rule pairs out. With 200
# coordinates, a pair that is similar enough seems less than this by chance once in 10^9.
RULE_OUT = 0.61
# Words whose hash a worker remembers, some 180 bytes each, and bytes of text that it takes at once.
MOST_WORDS, BATCH_BYTES = 100_000, 1 << 20


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < MOST_WORDS:
            self[word] = value
        return value


_hashes = _Hashes()
remembers(_hashes.clear)


def shingles(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, hashed, one text after the other; and how many
    each text has. Words are separated by ASCII blanks, A-Z are made small. A text with fewer
    words than a shingle has, but some, is one shingle."""
    split = [text.encode().lower().split() for text in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    flat = np.fromiter((_hashes[w] for own in split for w in own), np.uint64, int(sizes.sum()))
    owner = np.repeat(np.arange(len(split)), sizes)
    ends = np.cumsum(sizes)
    place = np.arange(len(flat)) - np.repeat(ends - sizes, sizes)
    # A shingle starts where enough words follow, or at the first word of a short text.
    starts = np.flatnonzero((place + words <= sizes[owner]) | ((place == 0) & (sizes[owner] < words)))
    value = np.zeros(len(starts), np.uint64)
    for k in range(words):
        at = starts + k
        inside = at < ends[owner[starts]]
        value = mix(value * np.uint64(0x9E3779B97F4A7C15) + np.where(inside, flat[np.minimum(at, len(flat) - 1)], np.uint64(k + 1)))
    whose = owner[starts]
    order = np.lexsort((value, whose))
    value, whose = value[order], whose[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (whose[1:] != whose[:-1])
    return value[new], np.bincount(whose[new], minlength=len(texts))


def sketches(values: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """A sketch of each set; a row of zeros for empty sets."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(len(counts) * size, empty)
    owner = np.repeat(np.arange(len(counts)), counts)
    open_ = values
    for round_ in range(2 * size):
        if not len(open_):
            break
        spread = mix(open_ + np.uint64((0x632BE59BD9B4E019 * (round_ + 1)) & 0xFFFFFFFFFFFFFFFF))
        if round_ < size:
            place = ((spread >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        else:
            place = np.full(len(open_), round_ - size)
        # The round stands in front, so that earlier rounds win.
        value = (spread & np.uint64(0x00FFFFFFFFFFFFFF)) | (np.uint64(min(round_, 255)) << np.uint64(56))
        cell = owner * size + place
        if round_ >= size:
            fresh = out[cell] == empty
            np.minimum.at(out, cell[fresh], value[fresh])
        else:
            np.minimum.at(out, cell, value)
        full = (out.reshape(-1, size) != empty).all(axis=1)
        left = ~full[owner]
        open_, owner = open_[left], owner[left]
    out[out == empty] = 0
    return out.reshape(-1, size)


def _fingerprints(values: np.ndarray, counts: np.ndarray) -> list[bytes | None]:
    """128 bits of each whole set; none for empty sets."""
    ends = np.cumsum(counts)
    data = values.astype("<u8")
    return [
        xxhash.xxh3_128_digest(data[end - n : end].tobytes()) if n else None
        for n, end in zip(counts.tolist(), ends.tolist(), strict=True)
    ]


def sketch_documents(docs: DataFrame, words: int, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """For each document its key, ``n_shingles``, ``node`` (a fingerprint of its set), ``bands``
    (a hash for each) and ``brief`` (a byte of each coordinate)."""

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        values, counts = shingles(texts_of(batch.column(1)), words)
        table = sketches(values, counts, rows * bands)
        hashed = np.zeros((len(counts), bands), np.uint64)
        for k in range(rows):
            hashed = mix(hashed + table[:, k::rows] + np.arange(bands, dtype=np.uint64))
        brief = mix(table).astype(np.uint8)
        return {
            "doc_id": batch.column(0),
            ROW_TEXT: batch.column(2),
            "n_shingles": pa.array(counts, pa.int64()),
            "node": pa.array(_fingerprints(values, counts), pa.binary()),
            "bands": pa.ListArray.from_arrays(
                np.arange(0, hashed.size + 1, bands, dtype=np.int32), pa.array(hashed.ravel().astype(np.int64))
            ),
            "brief": pa.array([row.tobytes() for row in brief], pa.binary()),
        }

    schema = f"doc_id long, {ROW_TEXT} long, n_shingles long, node binary, bands array<long>, brief binary"
    rows_ = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias(ROW_TEXT))
    return map_batches(rows_, run, schema, size=BATCH_BYTES)


def node_sets(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """``node, shingles`` of ``nodes``, each from the document that ``nodes`` names."""

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        values, counts = shingles(texts_of(batch.column(1)), words)
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        return {"node": batch.column(0), "shingles": pa.ListArray.from_arrays(offsets, pa.array(values.astype(np.int64)))}

    texts = docs.select(*row_key(), "text")
    wanted = join_rows(texts, nodes.select(ROW_ID, ROW_TEXT, "node"), "inner")
    # Rows that repeat a document bring the same node once more.
    wanted = wanted.select("node", "text").dropDuplicates(["node"])
    return map_batches(wanted, run, "node binary, shingles array<long>", size=BATCH_BYTES)


def _alike(a: str, b: str) -> Column:
    """Whether enough coordinates agree for the pair to be worth a comparison."""

    @F.pandas_udf("boolean")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype=bool)
        left, right = (np.frombuffer(b"".join(x), np.uint8).reshape(len(x), -1) for x in (a, b))
        return pd.Series((left == right).mean(axis=1) >= RULE_OUT)

    return alike(a, b)


def _similar(similarity: int) -> Column:
    both = F.size(F.array_intersect("left", "right"))
    return 100 * both >= similarity * (F.size("left") + F.size("right") - both)


def verified(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    return pairs.join(left, "a").join(right, "b").where(_similar(similarity)).select("a", "b")


def deltas(around: DataFrame, sets: DataFrame) -> DataFrame:
    """For each ``node, leader``: the sizes of both sets (``n, n_leader``), how many shingles one of them
    has and the other has not (``delta``), and which (``differs``)."""
    own = around.join(sets.withColumnRenamed("shingles", "left"), "node")
    both = own.join(sets.select(F.col("node").alias("leader"), F.col("shingles").alias("right")), "leader")
    differs = F.concat(F.array_except("left", "right"), F.array_except("right", "left"))
    sized = both.select(*around.columns, F.size("left").alias("n"), F.size("right").alias("n_leader"), differs.alias("differs"))
    return sized.withColumn("delta", F.size("differs"))


def _slack(similarity: int) -> float:
    """Two sets are linked if they differ in no more than this part of their sizes together."""
    return (100 - similarity) / (100 + similarity)


def listed(both: DataFrame, similarity: int, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """``both`` (staged ``deltas``) of the leaders around whom some node is not linked to them: whether
    the node is (``close``), and in ``ordered`` what it differs in like some other node around the same
    leader, the rarest first, with ``shared`` for how much that is. What only one node
    differs in meets nothing."""
    close = F.col("delta") <= _slack(similarity) * (F.col("n") + F.col("n_leader")) + 1e-9
    both = both.withColumn("close", close)
    apart = keep(both.where(~F.col("close")).select("leader").distinct(), "apart")
    both = both.join(apart, "leader", "left_semi")
    rows = both.select("leader", "node", F.explode("differs").alias("shingle"))
    # Written, so that the join stands right on its shuffles and a leader of many can be split.
    often = keep(rows.groupBy("leader", "shingle").agg(F.count("*").alias("nodes")).where("nodes > 1"), "often")
    found = rows.join(often, ["leader", "shingle"]).groupBy("leader", "node")
    # No longer than the set of a document.
    ordered = keep(found.agg(F.array_sort(F.collect_list(F.struct("nodes", "shingle"))).alias("ordered")), "ordered")
    kept = both.drop("differs").join(ordered, ["leader", "node"])
    return kept.withColumn("shared", F.size("ordered"))


def _prefix(rows: DataFrame, least: Column, mark: str) -> DataFrame:
    """What has to meet if at least ``least`` of what is shared is common to a pair, with its place."""
    length = F.greatest(F.col("shared") - F.greatest(F.ceil(least - 1e-9), F.lit(1)) + 1, F.lit(0)).cast("int")
    facts = [F.col(c).alias(f"{mark}_{c}") for c in ("node", "component", "n", "delta", "shared")]
    found = rows.select("leader", *facts, F.posexplode(F.slice("ordered", F.lit(1), length)).alias(f"{mark}_at", "entry"))
    return found.withColumn("shingle", F.col("entry.shingle")).drop("entry")


def open_pairs(around: DataFrame, similarity: int) -> DataFrame:
    """Pairs ``a, b`` of different components that can be linked, from ``listed`` rows with a
    ``component``. None that is linked is missing.

    A and B, which differ from their leader L in dA and dB, are linked if they differ in no more than
    c (|A| + |B|), that is if dA and dB have (|dA| + |dB| - c (|A| + |B|)) / 2 in common or more. As
    |B| <= |L| + |dB|, the sizes around L tell how much that is at least, whatever B is. Two that
    are both linked to L are in one component, so A is not, and |dA| > c (|A| + |L|)."""
    c, s = _slack(similarity), similarity / 100
    beyond = F.col("delta") - c * (F.col("n") + F.col("n_leader"))
    far, near = around.where(~F.col("close")), around.where("close")
    # What the other one differs in at least, if it is not linked to the leader, or if it is.
    other_far, other_near = c * (s * F.col("n") + F.col("n_leader")), F.greatest(F.lit(1), beyond / (1 + c))
    joins = [
        (_prefix(far, (beyond + (1 - c) * other_far) / 2, "a"), _prefix(far, (beyond + (1 - c) * other_far) / 2, "b"), True),
        (_prefix(far, (beyond + (1 - c) * other_near) / 2, "a"), _prefix(near, F.floor((1 - c) * F.col("delta") / 2) + 1, "b"), False),
    ]
    common = F.least(F.col("a_shared") - F.col("a_at"), F.col("b_shared") - F.col("b_at"))
    needed = (F.col("a_delta") + F.col("b_delta") - c * (F.col("a_n") + F.col("b_n"))) / 2
    fits = (needed <= common + 1e-9) & (100 * F.least("a_n", "b_n") >= similarity * F.greatest("a_n", "b_n"))
    pairs = []
    for left, right, alike in joins:
        apart = F.col("a_component") < F.col("b_component") if alike else F.col("a_component") != F.col("b_component")
        met = left.join(right, ["leader", "shingle"]).where(apart & fits)
        pairs.append(met.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")))
    return pairs[0].unionByName(pairs[1]).distinct()


def link_nodes(docs: DataFrame, sketched: DataFrame, words: int, similarity: int) -> DataFrame:
    """``node, component`` of the nodes that are linked to another."""
    with scratch(docs.sparkSession) as keep:
        return _link_nodes(docs, sketched, words, similarity, keep)


def _link_nodes(
    docs: DataFrame, sketched: DataFrame, words: int, similarity: int, keep: Callable[[DataFrame, str], DataFrame]
) -> DataFrame:
    named = F.min(F.struct("doc_id", ROW_TEXT)).alias("named")
    facts = [F.first(c).alias(c) for c in ("n_shingles", "bands", "brief")]
    nodes = sketched.where(F.col("node").isNotNull()).groupBy("node").agg(named, *facts)
    nodes = keep(nodes.select("node", F.col("named.doc_id").alias(ROW_ID), f"named.{ROW_TEXT}", "n_shingles", "bands", "brief"), "nodes")
    entries = nodes.select("node", F.explode("bands").alias("band"))
    # Aggregates are written before they are joined: then the join stands right on its shuffles, and Spark
    # splits a band or a leader of very many.
    shared = keep(entries.groupBy("band").agg(F.count("*").alias("members")).where("members > 1"), "shared")
    entries = keep(entries.join(shared, "band"), "bands")
    # The node that most others agree with leads each band that it is in.
    weight = keep(entries.groupBy("node").agg(F.sum("members").alias("weight")), "weights")
    weighted = entries.join(weight, "node")
    leaders = keep(weighted.groupBy("band").agg(F.max(F.struct("weight", "node")).alias("leader")), "leaders")
    best = weighted.join(leaders, "band").groupBy("node").agg(F.max("leader").alias("leader"))
    best = keep(best.select("node", F.col("leader.node").alias("leader")), "best")
    small = nodes.select("node", "n_shingles", "brief")

    def plausible(pairs: DataFrame) -> DataFrame:
        for side in ("a", "b"):
            pairs = pairs.join(small.withColumnsRenamed({"node": side, "n_shingles": f"n_{side}", "brief": f"brief_{side}"}), side)
        fits = 100 * F.least("n_a", "n_b") >= similarity * F.greatest("n_a", "n_b")
        return pairs.where(fits).where(_alike("brief_a", "brief_b")).select("a", "b")

    sets = keep(node_sets(docs, nodes.join(best.select("node"), "node"), words), "sets")
    stars = best.where(F.col("node") != F.col("leader")).toDF("a", "b")
    edges = keep(verified(plausible(stars), sets, similarity), "edges")
    components = connected_components(edges)
    # What bands still join across components.
    placed = entries.join(components, "node", "left").select("band", "node", F.coalesce("component", "node").alias("component"))
    open_ = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    led = keep(open_.join(leaders, "band").select("band", F.col("leader.node").alias("leader")), "open")
    around = placed.join(led, "band").where(F.col("node") != F.col("leader")).select("node", "component", "leader").distinct()
    both = keep(deltas(around, sets), "deltas")
    # What a node differs in from a leader says exactly whether they are linked.
    led_by = both.where(F.col("delta") <= _slack(similarity) * (F.col("n") + F.col("n_leader")) + 1e-9)
    led_by = led_by.select(F.col("node").alias("a"), F.col("leader").alias("b"))
    pairs = keep(open_pairs(keep(listed(both, similarity, keep), "listed"), similarity), "pairs")
    more = verified(plausible(pairs), sets, similarity)
    return connected_components(edges.unionByName(led_by).unionByName(more))


def near_duplicates(docs: DataFrame, words: int = 5, similarity: int = SIMILARITY) -> DataFrame:
    """Groups of near duplicates among ``docs`` (``doc_id, text``), a row for each row:
    ``doc_id``, ``n_shingles`` (distinct word shingles), ``component_id`` (the smallest
    ``doc_id`` that links lead to, itself included) and ``kept`` (whether that is its own).

    Two texts are linked if ``100 * intersection >= similarity * union`` of their sets. A
    pair at the limit is missed once in ten million. Null and blank texts have no shingles
    and are linked with nothing; a null ``doc_id`` counts as the largest, and as a group of
    its own it is kept. Rows that repeat an id are in one group each.
    """
    with scratch(docs.sparkSession) as keep:
        sketched = keep(sketch_documents(docs, words), "sketches")
        own = staged(sketched.select("doc_id", ROW_TEXT, "n_shingles", "node"), "nodes")
        linked = link_nodes(docs, sketched, words, similarity)
    rows = own.join(linked, "node", "left")
    group = F.coalesce("component", "node")
    rows = rows.withColumn("group", group)
    first = rows.where(F.col("group").isNotNull()).groupBy("group").agg(F.min("doc_id").alias("first"))
    # Written, so that the join stands right on its shuffles and Spark can split a large group.
    rows = rows.join(staged(first, "groups"), "group", "left")
    component = F.coalesce("first", "doc_id")
    return rows.select(
        *("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept")),
        F.col("doc_id").alias(ROW_ID),
        ROW_TEXT,
    )
