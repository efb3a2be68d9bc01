"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import small_or_not, text_of

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
EPOCHS = 2
BUCKET_ROWS = 20_000
SEED = 17


def size_of(text: str = "text") -> Column:
    """Words between blanks; null has none."""
    return F.regexp_count(text_of(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def _order_key(key: str) -> Column:
    """The shuffled place of a document: depends on its id alone, so reruns agree."""
    return F.xxhash64(F.lit(SEED), F.col(f"`{key}`"))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """``source, source_size, weight, target`` from ``source, source_size``.

    The sources, by code point with null last, take the weights in turn and share ``share`` times
    all words. A target stops at ``epochs`` times its source's size; the excess is shared again by
    weight. The level at which that ends is found in one pass: with the sources in order of
    capacity per weight, those up to some place are full and the others share what remains.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source")))
    each = F.array(*[F.lit(float(w)) for w in weights])
    listed = sizes.withColumn("weight", F.get(each, (place - 1) % len(weights)))
    full = F.col("source_size") * float(epochs)
    ratio = full / F.col("weight")
    everything = Window.partitionBy()
    # Rank by ratio; sources of equal ratio are full or open together.
    upward = Window.orderBy("ratio").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    levels = (
        listed.withColumns({"full": full, "ratio": ratio})
        .withColumns(
            {
                "budget": F.sum("source_size").over(everything) * float(share),
                "all_weight": F.sum("weight").over(everything),
                "full_so_far": F.sum("full").over(upward),
                "weight_so_far": F.sum("weight").over(upward),
            }
        )
        # The level if this source and all before it were full.
        .withColumn(
            "is_full",
            F.col("ratio") * (F.col("all_weight") - F.col("weight_so_far")) + F.col("full_so_far") <= F.col("budget"),
        )
        .withColumns(
            {
                "gone": F.coalesce(F.sum(F.when(F.col("is_full"), F.col("full"))).over(everything), F.lit(0.0)),
                "open_weight": F.sum(F.when(~F.col("is_full"), F.col("weight"))).over(everything),
            }
        )
    )
    level = (F.col("budget") - F.col("gone")) * F.col("weight") / F.col("open_weight")
    target = F.when(F.col("is_full"), F.col("full")).otherwise(F.least(level, F.col("full")))
    return levels.select("source", "source_size", "weight", target.alias("target"))


def mixture(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Per source: ``source, source_size, target`` and ``last_0, last_1, ...``: up to which order
    key each epoch of the source is taken (null: nothing of it).

    Every document of a source, in shuffled order and epoch after epoch, has a virtual finish time:
    the source's words up to and with it, divided by the source's target. All are sorted by that
    time and cut where their words reach the budget. A source finishes its target at time 1, so
    each gets its share up to a document.

    The running sums are taken in two steps, within and over ranges of the order key, and the cut
    is found in ranges of the finish time first, so a source with a third of all rows, or all of
    them, is spread over tasks. Rows of one order key (repeated rows of a document) go together.
    """
    docs_sizes = docs.select(
        F.col(f"`{source}`").cast("string").alias("source"), _order_key(key).alias("o"), size_of(text).alias("n")
    )
    keyed = cut_lineage(docs_sizes.groupBy("source", "o").agg(F.sum("n").alias("n"), F.count("*").alias("rows")))
    rows = keyed.agg(F.sum("rows")).first()[0] or 0
    ranges = max(1, -(-rows // bucket_rows))
    span = float(1 << 64) / ranges
    bucket = F.floor((F.col("o").cast("double") + float(1 << 63)) / span)
    keyed = keyed.withColumn("b", bucket)
    sums = cut_lineage(keyed.groupBy("source", "b").agg(F.sum("n").alias("bn")))
    before = F.coalesce(
        F.sum("bn").over(Window.partitionBy("source").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    offsets = sums.withColumn("before", before).drop("bn")
    by_source = cut_lineage(
        targets(sums.groupBy("source").agg(F.sum("bn").alias("source_size")), weights, share, epochs)
    )
    running = F.sum("n").over(Window.partitionBy("source", "b").orderBy("o"))
    within = keyed.select("source", "o", "n", "b", running.alias("within")).alias("k")
    same = F.col("k.source").eqNullSafe(F.col("f.source")) & (F.col("k.b") == F.col("f.b"))
    placed = within.join(small_or_not(offsets, 48).alias("f"), same).select(
        "k.source", "o", "n", (F.col("before") + F.col("within")).alias("upto")
    )
    small = small_or_not(by_source, 96).alias("s")
    words = F.col("upto") + F.col("epoch") * F.col("source_size")
    timed = cut_lineage(
        placed.alias("p")
        .join(small, F.col("p.source").eqNullSafe(F.col("s.source")))
        .select("p.source", "o", "n", "upto", "source_size", "target")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
        .withColumn("finish", F.try_divide(words, F.col("target")))
        .where("finish is not null")
        .select("source", "o", "epoch", "n", "finish")
    )
    taken = timed.where(F.col("finish") <= _last_finish(timed, by_source, ranges))
    last = taken.groupBy("source").agg(
        *[F.max(F.when(F.col("epoch") == e, F.col("o"))).alias(f"last_{e}") for e in range(epochs)]
    )
    return (
        by_source.alias("s")
        .join(last.alias("l"), F.col("s.source").eqNullSafe(F.col("l.source")), "left")
        .select("s.source", "source_size", "target", *[f"last_{e}" for e in range(epochs)])
    )


def _last_finish(timed: DataFrame, by_source: DataFrame, ranges: int) -> float:
    """The largest finish time up to which all words fit the budget (the sum of the targets).

    First the range of finish times in which the budget runs out, then the place in that range.
    """
    budget = by_source.agg(F.round(F.sum("target"), 3)).first()[0] or 0.0
    numbered = timed.withColumn("r", F.floor(F.col("finish") * ranges))
    sums = numbered.groupBy("r").agg(F.sum("n").alias("rn"))
    upto = F.sum("rn").over(Window.orderBy("r"))
    over = sums.withColumn("upto", upto).where(F.col("upto") > budget).orderBy("r").first()
    if over is None:
        return float("inf")
    rest = numbered.where(F.col("r") == over["r"])
    at = F.sum("n").over(Window.orderBy("finish")) + F.lit(over["upto"] - over["rn"])
    last = rest.select("finish", at.alias("at")).where(F.col("at") <= budget).agg(F.max("finish")).first()[0]
    # Nothing of that range fits: everything before it does.
    return last if last is not None else (over["r"] / ranges) * (1 - 1e-12)


def mixed(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row; see :func:`mixture`.

    ``taken`` counts the words that the mix takes of the row, repeats counted: 0 up to ``epochs``
    times its size. A null text has size 0; a null source is a source of its own; a null id is
    shuffled like any other. An empty table gives no rows.
    """
    plan = cut_lineage(mixture(docs, weights, share, epochs, key, text, source))
    rows = docs.select(
        F.col(f"`{key}`").alias("doc_id"),
        F.col(f"`{source}`").cast("string").alias("_source"),
        _order_key(key).alias("o"),
        size_of(text).alias("size"),
    )
    plan = small_or_not(plan, 96)
    found = rows.join(plan, rows["_source"].eqNullSafe(plan["source"]))
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * _copies(epochs)).alias("taken"))


def mixed_documents(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The rows of ``docs`` that the mix takes, whole, as often as it takes them, with their columns.
    Documents without words go with the first epoch that reaches their place."""
    plan = cut_lineage(mixture(docs, weights, share, epochs, key, text, source))
    plan = small_or_not(plan, 96)
    plan = plan.toDF(*[f"_mix_{c}" for c in plan.columns])
    copies = _copies(epochs, "_mix_", _order_key(key))
    found = docs.join(plan, docs[source].cast("string").eqNullSafe(plan["_mix_source"]))
    return (
        found.withColumn("_mix_copies", copies)
        .where("_mix_copies > 0")
        .withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies"))))
        .select(*[docs[c] for c in docs.columns])
    )


def _copies(epochs: int, prefix: str = "", order: Column | None = None) -> Column:
    order = F.col("o") if order is None else order
    taken = [F.when(order <= F.col(f"{prefix}last_{e}"), 1).otherwise(0) for e in range(epochs)]
    return sum(taken[1:], taken[0])
