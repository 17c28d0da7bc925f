"""Best-fit packing by linear grouping.

Documents are cut into pieces of at most ``capacity`` tokens, and the pieces put into as
few sequences as possible. The plan needs only the number of pieces of each length, at
most ``capacity`` rows however large the corpus is:

1. Large lengths are rounded up within groups of equal cardinality to a few sizes.
2. A linear program over configurations (multisets of sizes that fit in a sequence), with
   configurations generated by a knapsack, says how often each is used.
3. The actual lengths take the places of the rounded ones, group by group.
4. What is left over and the small lengths go, longest first, where they fit best.

The pieces then look up their place by their rank among those of the same length, which
is counted in blocks, so that a length that a third of all pieces share is no hot key.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, staged, texts_of
from .tokens import ID_BYTES, REMEMBER, encoder

LARGE = 3  # a length is large if it exceeds the capacity divided by this
GROUPS = 128  # sizes that the large lengths are rounded up to
CLOSE = 1e-3  # how near to the best the linear program is solved
BLOCK_ROWS = 200  # pieces of one length that one task ranks


# --- pieces -----------------------------------------------------------------------------


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, remember: int = REMEMBER, size: int = 4 << 20) -> DataFrame:
    """The token ids of every whole text, followed by ``end_id``, in pieces.

    Only documents of more than ``capacity`` ids are cut; their first piece takes the
    remainder, all others are full. Returns ``doc_id, piece, start, length`` and ``ids``
    (little-endian unsigned 32-bit). Null and empty texts give one piece with ``end_id``
    alone; a null ``doc_id`` stays null; repeated rows each have their pieces. ``remember`` (words
    in the memory of a worker) and ``size`` (bytes of text that it encodes at once) trade memory for
    time; no piece depends on them.
    """
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def cut(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        texts = texts_of(batch.column(1))
        rows, piece, start, length, ids = [], [], [], [], []
        for row, data in enumerate(encoder(tokenizer, remember=remember).encode(texts)):
            data += end
            n = len(data) // ID_BYTES
            at, stop, k = 0, n % capacity or min(n, capacity), 0
            while at < n:
                rows.append(row)
                piece.append(k)
                start.append(at)
                length.append(stop - at)
                ids.append(data[ID_BYTES * at : ID_BYTES * stop])
                at, stop, k = stop, stop + capacity, k + 1
        return {
            "doc_id": batch.column(0).take(pa.array(rows, pa.int64())),
            "piece": pa.array(piece, pa.int32()),
            "start": pa.array(start, pa.int64()),
            "length": pa.array(length, pa.int64()),
            "ids": pa.array(ids, pa.binary()),
        }

    schema = "doc_id long, piece int, start long, length long, ids binary"
    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), cut, schema, size)


# --- plan -------------------------------------------------------------------------------


@dataclass
class Bins:
    """``count`` sequences that look alike; ``items`` are (length, copies, offset)."""

    count: int
    free: int
    items: list[tuple[int, int, int]] = field(default_factory=list)

    def put(self, length: int, copies: int, capacity: int) -> None:
        self.items.append((length, copies, capacity - self.free))
        self.free -= length * copies

    def part(self, count: int) -> Bins:
        self.count -= count
        return Bins(count, self.free, list(self.items))


def group_sizes(lengths: list[tuple[int, int]], groups: int) -> list[list[tuple[int, int]]]:
    """Split (length, count), longest first, into groups of equal cardinality; a length
    that reaches over a border is split."""
    total = sum(n for _, n in lengths)
    each = -(-total // groups)
    out: list[list[tuple[int, int]]] = [[]]
    room = each
    for length, n in lengths:
        while n:
            if not room:
                out.append([])
                room = each
            taken = min(n, room)
            out[-1].append((length, taken))
            n -= taken
            room -= taken
    return out


def _best_configuration(sizes: list[int], values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of sizes that fits and has the greatest value (a bounded knapsack)."""
    best = np.zeros(capacity + 1)
    steps = []
    for g, size in enumerate(sizes):
        most, copies = capacity // size, 1
        while most > 0:
            copies = min(copies, most)
            weight, gain = copies * size, copies * values[g]
            taken = np.zeros(capacity + 1, bool)
            offered = best[: capacity + 1 - weight] + gain
            taken[weight:] = offered > best[weight:] + 1e-12
            best[weight:] = np.where(taken[weight:], offered, best[weight:])
            steps.append((g, copies, weight, taken))
            most -= copies
            copies *= 2
    chosen, room = np.zeros(len(sizes)), capacity
    for g, copies, weight, taken in reversed(steps):
        if taken[room]:
            chosen[g] += copies
            room -= weight
    return float(best[capacity]), chosen


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 2000) -> list[tuple[int, list[int]]]:
    """How often to use which configuration: the linear program over all of them, solved
    by column generation and rounded down."""
    k = len(sizes)
    basis = np.diag([float(capacity // size) for size in sizes])
    inverse = np.diag(1 / np.diag(basis))
    need = np.asarray(demand, float)
    use = inverse @ need
    for _ in range(rounds):
        # The sum of each column of the inverse is the price of a size; a configuration
        # helps if its sizes are worth more than the sequence it takes.
        value, column = _best_configuration(sizes, np.maximum(inverse.sum(axis=0), 0), capacity)
        if value <= 1 + CLOSE:
            break
        change = inverse @ column
        ratio = np.where(change > 1e-9, np.maximum(use, 0) / np.where(change > 1e-9, change, 1), np.inf)
        out = int(ratio.argmin())
        basis[:, out] = column
        pivot = inverse[out] / change[out]
        inverse -= np.outer(change, pivot)
        inverse[out] = pivot
        use = inverse @ need
    return [(int(use[j] + 1e-6), basis[:, j].astype(int).tolist()) for j in range(k) if use[j] >= 1 - 1e-6]


def _substitute(use: list[tuple[int, list[int]]], queues: list[list[tuple[int, int]]], capacity: int) -> list[Bins]:
    """Fill configurations with actual lengths. ``queues`` hold what is left, and are used up."""
    out = []
    queues_left = [list(reversed(q)) for q in queues]
    for times, configuration in use:
        while times:
            wanted = [(g, a) for g, a in enumerate(configuration) if a and queues_left[g]]
            if not wanted:
                break
            # As many equal sequences as the lengths in front allow.
            same = min(times, min(queues_left[g][-1][1] // a for g, a in wanted))
            bins = Bins(max(same, 1), capacity)
            for g, a in wanted:
                while a and queues_left[g]:
                    length, n = queues_left[g].pop()
                    taken = a if same else min(a, n)
                    bins.put(length, taken, capacity)
                    n -= taken * bins.count
                    if n:
                        queues_left[g].append((length, n))
                    a -= taken
            out.append(bins)
            times -= bins.count
    queues[:] = [list(reversed(q)) for q in queues_left]
    return out


def best_fit(bins: list[Bins], lengths: list[tuple[int, int]], capacity: int) -> list[Bins]:
    """Best-fit decreasing over counts. A copy goes where the least room is left; the next
    copy of the same length then fits best in the same sequence, until it is too full, so
    equal sequences are filled at once."""
    by_free: dict[int, list[Bins]] = defaultdict(list)
    done = []
    for b in bins:
        by_free[b.free].append(b)
    order = sorted(by_free)

    def push(b: Bins) -> None:
        if not by_free[b.free]:
            bisect.insort(order, b.free)
        by_free[b.free].append(b)

    for length, n in sorted(lengths, reverse=True):
        while n:
            at = bisect.bisect_left(order, length)
            if at < len(order):
                free = order[at]
                b = by_free[free].pop()
                if not by_free[free]:
                    del order[at]
            else:
                b = Bins(-(-n // (capacity // length)), capacity)
            fit = b.free // length
            full = min(b.count, n // fit)
            if full:
                part = b.part(full) if full < b.count else b
                part.put(length, fit, capacity)
                n -= full * fit
                push(part)
                if part is b:
                    continue
            if n and n < fit:
                part = b.part(1) if b.count > 1 else b
                part.put(length, n, capacity)
                n = 0
                push(part)
                if part is b:
                    continue
            if b.count:
                push(b)
    return done + [b for free in by_free for b in by_free[free]]


def plan(counts: dict[int, int], capacity: int, groups: int = GROUPS) -> list[Bins]:
    """Sequences for ``counts`` pieces of each length, all of them at most ``capacity``."""
    lengths = sorted(((n, c) for n, c in counts.items() if n < capacity), reverse=True)
    bins = [Bins(counts[capacity], 0, [(capacity, 1, 0)])] if counts.get(capacity) else []
    large = [(n, c) for n, c in lengths if n > capacity // LARGE]
    small = [(n, c) for n, c in lengths if n <= capacity // LARGE]
    if large:
        grouped = group_sizes(large, groups)
        sizes = [group[0][0] for group in grouped]
        use = configurations(sizes, [sum(c for _, c in group) for group in grouped], capacity)
        bins += _substitute(use, grouped, capacity)
        small += [pair for group in grouped for pair in group]
    return best_fit(bins, small, capacity)


def places(bins: list[Bins]) -> pd.DataFrame:
    """For each length, which ranks go where: ``copies`` in each sequence from ``sequence``
    on, the first at ``offset``."""
    rows, ranks, sequence = [], defaultdict(int), 0
    for b in bins:
        for length, copies, offset in b.items:
            rows.append((length, ranks[length], copies, sequence, offset))
            ranks[length] += copies * b.count
        sequence += b.count
    table = pd.DataFrame(rows, columns=["length", "rank", "copies", "sequence", "offset"], dtype="int64")
    return table.sort_values(["length", "rank"], ignore_index=True)


# --- placing ----------------------------------------------------------------------------


def _ranks(pieces: DataFrame, length: str, counts: dict[int, int]) -> DataFrame:
    """Add ``__rank``, counted from 0 among the pieces of a length: within blocks that a
    hash deals out, plus what the blocks before hold."""
    # A row for each length, so as many as the capacity at most.
    split = pieces.sparkSession.createDataFrame(
        [(n, c // BLOCK_ROWS + 1) for n, c in counts.items()], "__length long, __blocks long"
    )
    marked = pieces.withColumn("__mark", F.xxhash64(*pieces.columns)).withColumn("__length", F.col(length).cast("long"))
    marked = marked.join(F.broadcast(split), "__length").withColumn("__block", F.pmod("__mark", "__blocks"))
    sizes = marked.groupBy("__length", "__block").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("__length").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__length", "__block", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    within = Window.partitionBy("__length", "__block").orderBy("__mark", *pieces.columns)
    ranked = marked.withColumn("__row", F.row_number().over(within) - 1)
    return ranked.join(starts, ["__length", "__block"]).withColumn("__rank", F.col("__row") + F.col("__before"))


def pack(pieces: DataFrame, capacity: int = 2048, length: str = "length", groups: int = GROUPS) -> DataFrame:
    """Give each row of ``pieces`` a ``sequence_id`` and its ``offset`` there.

    Rows have 1 to ``capacity`` tokens, as their column ``length`` says; longer, empty and
    null lengths are an error. All columns are kept, but those with the two new names are
    replaced. Sequences have no gaps and are numbered from 0. Equal rows each get a place.
    An empty table stays empty. The pieces are written once, as the plan counts them
    before it places them.
    """
    columns = pieces.drop("sequence_id", "offset").columns
    # A number for each row, so that rows which are equal are dealt to different blocks.
    pieces = staged(pieces.select(*columns, F.monotonically_increasing_id().alias("__piece")), "pieces")
    counted = pieces.groupBy(F.col(length).cast("long")).count().collect()  # a row per length
    counts = {row[0]: row[1] for row in counted}
    if any(n is None or not 0 < n <= capacity for n in counts):
        raise ValueError(f"pieces need a length of 1 to {capacity}")
    table = places(plan(counts, capacity, groups)) if counts else places([])
    # Capacity bounds the lengths, and lengths bound the places: no row per piece.
    shared = pieces.sparkSession.sparkContext.broadcast({c: table[c].to_numpy() for c in table})

    @F.pandas_udf("sequence_id long, offset long")
    def place(size: pd.Series, rank: pd.Series) -> pd.DataFrame:
        t = shared.value
        size, rank = size.to_numpy("int64"), rank.to_numpy("int64")
        key = (t["length"] << 44) | t["rank"]
        at = np.searchsorted(key, (size << 44) | rank, "right") - 1
        nth = rank - t["rank"][at]
        copies = t["copies"][at]
        return pd.DataFrame({"sequence_id": t["sequence"][at] + nth // copies, "offset": t["offset"][at] + nth % copies * size})

    ranked = _ranks(pieces, length, counts)
    placed = ranked.withColumn("__place", place(F.col(length).cast("long"), F.col("__rank").cast("long")))
    return placed.select(*columns, "__place.sequence_id", "__place.offset")


def ids_crc32(ids: str = "ids") -> Column:
    return F.crc32(F.col(ids)).cast("long")
