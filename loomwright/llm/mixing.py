"""Mix sources to target weights, to the word.

Every document gets a random key from a hash of its id. Sorted by source and key over the whole
cluster, with the sum of the sizes before each document, a source is cut exactly where its
budget ends: documents before the cut are taken once more than those behind it, and the one
across it in part. A source whose budget exceeds its size repeats in epochs.

Budgets come from weights: all sources share the total, no source gives more than ``most_epochs``
times its size, and what a source cannot give goes to the others by their weights.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_batches, scratch, staged
from .ordering import running_totals

WORD = r"[^\x20\x09-\x0D]+"
_WORD = re.compile(WORD)
WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3
SEED = 2024


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(seed: int = SEED) -> Column:
    """A hash of the id, the same in every run; a null id is an empty one."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def budgets(
    sources: DataFrame,
    keep: Callable[[DataFrame, str], DataFrame],
    weights: Sequence[int] = WEIGHTS,
    percent: int = 100,
    most_epochs: int = MOST_EPOCHS,
) -> DataFrame:
    """``source, source_size, sources_before`` (what the sources before it hold) and ``target``.

    Sources in the order of their code points, null last, weigh ``weights`` in turn. A share beyond
    ``most_epochs`` times the size is cut there and the excess shared again. In the order of
    what a unit of weight costs at most, a source is cut if its share of what those before it
    left, among those from it on, is more than it may give; one pass over running sums tells,
    however many sources there are."""
    ranked = running_totals(sources, [F.col("source").asc_nulls_last()], ["source_size"], keep)
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("position") % len(weights) + 1).cast("int"))
    ranked = ranked.select(
        *("source", "source_size", F.col("source_size_before").alias("sources_before")),
        turn.cast("long").alias("weight"),
        (F.col("source_size") * most_epochs).alias("most"),
    )
    order = [F.col("most") / F.col("weight"), F.col("source").asc_nulls_last()]
    placed = running_totals(ranked, order, ["most", "weight"], keep)
    total, all_weights = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    budget = (total or 0) * percent // 100
    share = (F.lit(budget) - F.col("most_before")) / (F.lit(all_weights or 0) - F.col("weight_before"))
    full = F.col("most") / F.col("weight") < share
    given, left = placed.where(full).agg(F.sum("most"), F.sum("weight")).first()
    spare, rest = budget - (given or 0), (all_weights or 0) - (left or 0)
    target = F.when(full, F.col("most").cast("double")).otherwise(F.lit(float(spare)) * F.col("weight") / F.lit(float(max(rest, 1))))
    return placed.select("source", "source_size", "sources_before", target.alias("target"))


def plan(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    percent: int = 100,
    most_epochs: int = MOST_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """What the mix takes of each row of ``docs`` (``doc_id, text, source``): ``doc_id``, ``source``,
    ``size`` (words of the text), ``source_size``, ``target`` (of the source), ``epochs`` (how often
    the whole text is taken), ``part`` (words of it that are taken once more) and ``taken``
    (all words, repeats counted); and the key of the row.

    Targets add up to ``percent`` of all words, unless the sources cannot give that much. Each source
    gives its target, rounded down to a word. Null texts have no words, a null source is one of its
    own. Rows that share an id and a source stand next to each other in the draw; which of
    several equal rows the cut takes in part makes no difference."""
    with scratch(docs.sparkSession) as keep:
        rows = docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.xxhash64("text").alias("text_hash"),
            n_words(F.col("text")).alias("size"),
            random_key(seed).alias("key"),
            F.monotonically_increasing_id().alias("row"),
        )
        sized = keep(rows, "sizes")
        sources = keep(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
        budget = keep(budgets(sources, keep, weights, percent, most_epochs), "budgets")
        order = [F.col("source").asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ("key", "doc_id", "text_hash", "row")]]
        # Written, so that the join stands right on its shuffles and a large source can be split.
        ordered = keep(running_totals(sized, order, ["size"], keep), "ordered")
        named = budget.withColumnRenamed("source", "__source")
        joined = ordered.join(named, F.col("source").eqNullSafe(F.col("__source")))
        words = F.floor("target")
        epochs = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("long")
        joined = joined.withColumn("epochs", epochs)
        cut = words - F.col("epochs") * F.col("source_size")
        inside = cut - (F.col("size_before") - F.col("sources_before"))
        joined = joined.withColumn("part", F.greatest(F.lit(0), F.least("size", inside)).cast("long"))
        taken = (F.col("epochs") * F.col("size") + F.col("part")).alias("taken")
        return staged(
            joined.select("doc_id", "source", "text_hash", "size", "source_size", "target", "epochs", "part", taken), "mix"
        )


def _first_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut texts behind their first ``words`` words."""
    for batch in in_batches(batches, 4 << 20, text=3):
        out = []
        for text, words in zip(batch.column("text").to_pylist(), batch.column("words").to_pylist(), strict=True):
            if words is not None:
                found = next(islice(_WORD.finditer(text), words - 1, None))
                text = text[: found.end()]
            out.append(text)
        columns = {c: batch.column(c) for c in ("doc_id", "source", "epoch")}
        yield pa.RecordBatch.from_pydict({**columns, "text": pa.array(out, pa.string())})


def mixture(docs: DataFrame, planned: DataFrame) -> DataFrame:
    """The rows of the mix that ``plan`` made of ``docs``: ``doc_id, source, epoch, text``, a row for
    each time that words of a text are taken; of a text that is taken in part, the first words.
    Epochs are numbered from 0; texts without words are not in the mix. Rows that repeat a document
    count its epochs on."""
    key = ["doc_id", "source", "text_hash"]
    # Equal rows are next to each other in the draw, so one of them at most is cut.
    taken = planned.where("taken > 0").groupBy(*key).agg(F.sum("taken").alias("taken"), F.first("size").alias("size"))
    epoch = F.explode(F.sequence(F.lit(0), F.floor((F.col("taken") - 1) / F.col("size")).cast("long")))
    times = taken.withColumn("epoch", epoch)
    left = F.col("taken") - F.col("epoch") * F.col("size")
    times = staged(times.select(*key, "epoch", F.when(left < F.col("size"), left).alias("words")), "times")
    id_, source = F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source")
    texts = docs.select(id_, source, F.xxhash64("text").alias("text_hash"), "text").dropDuplicates(key)
    other = texts.withColumnsRenamed({c: f"__{c}" for c in key})
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in key])
    joined = times.join(other, same).select("doc_id", "source", "epoch", "text", "words")
    return joined.mapInArrow(_first_words, "doc_id long, source string, epoch long, text string")
