"""Toxicity by two class-conditional Kneser-Ney models of the letters of words, over shared backoffs.

A model gives each byte of a word its probability after up to ``ORDER - 1`` bytes before it in the
word. Those highest-order counts are kept by class. What a class hasn't seen falls back to counts
of distinct left neighbours that both classes share, so a rare expression is judged by its parts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import nlargest

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import Scratch, ship, small_or_not
from .wordhash import mix

ORDER = 5
SHORT = 2  # bytes of context that the shared model keeps
DISCOUNT = 0.75
PIECE_BYTES = 48
CALIBRATION_ROWS = 20_000
CALIBRATION_SHARE = 5  # at most one labelled document in so many calibrates instead of being counted
THRESHOLD = 0.3
CACHED_WORDS = 300_000
BLOCK_WORDS = 50_000
SCALES = (1.0, 10.0, 10.0)

WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    """Runs of letters, lower case; a run of over PIECE_BYTES letters is cut into such pieces."""
    found = WORD.findall(text.lower()) if text else []
    if max(map(len, found), default=0) > PIECE_BYTES:
        found = [w[i : i + PIECE_BYTES] for w in found for i in range(0, len(w), PIECE_BYTES)]
    return found


@dataclass
class Grams:
    """For each byte of each word (with an end mark): hashes of its gram and context at full order,
    of the shorter ones, and the word it belongs to."""

    full: np.ndarray
    context: np.ndarray
    short: np.ndarray
    short_context: np.ndarray
    byte: np.ndarray
    word: np.ndarray


def grams(found: list[str]) -> Grams:
    """All grams of a list of words. A byte is 1 to 256, 0 stands before a word, 257 ends it."""
    encoded = [w.encode("utf-8", "surrogatepass") for w in found]
    lengths = np.array([len(w) + 1 for w in encoded], np.int64)
    data = np.frombuffer(b"".join(w + b"\x00" for w in encoded), np.uint8).astype(np.uint64) + np.uint64(1)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    data[ends - 1] = 257
    word = np.repeat(np.arange(len(found)), lengths)
    place = np.arange(len(data)) - starts[word]

    def context(width: int) -> np.ndarray:
        out = np.zeros(len(data), np.uint64)
        for back in range(width, 0, -1):
            before = np.zeros(len(data), np.uint64)
            before[back:] = data[:-back] if back < len(data) else 0
            before[place < back] = 0
            out = out * np.uint64(512) + before
        return out

    long, short = context(ORDER - 1), context(SHORT)
    join = lambda c: mix(c * np.uint64(512) + data)
    return Grams(join(long), mix(long + np.uint64(1) << np.uint64(9)), join(short + np.uint64(1 << 40)), short, data, word)


@dataclass
class Model:
    """Exact counts, written once, with one row per key; whatever their number, none come to the driver."""

    full: DataFrame  # full; n0, n1: counts by class
    context: DataFrame  # context; t0, t1: counts, k0, k1: distinct grams, by class
    short: DataFrame  # short; s: distinct full grams that end in it
    short_context: DataFrame  # short_context; st: as s, sk: distinct bytes (keys of two bytes: under 2^17)
    single: list[float]  # by byte: distinct short contexts before it
    weights: np.ndarray | None = None

    def gram_ratios(self, found: DataFrame) -> DataFrame:
        """``full, ratio`` of distinct grams: log-likelihood of its byte after its context in toxic
        texts, less that in ordinary ones."""
        every = sum(self.single) + 258
        single = F.get(F.lit([(n + 1) / every for n in self.single]), F.col("byte"))
        count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double")
        above = lambda c: F.greatest(count(c) - DISCOUNT, F.lit(0.0))
        lower = F.when(count("st") > 0, (above("s") + DISCOUNT * count("sk") * F.col("one")) / count("st"))
        p = [
            F.when(count(f"t{c}") > 0, (above(f"n{c}") + DISCOUNT * count(f"k{c}") * F.col("lower")) / count(f"t{c}"))
            for c in (0, 1)
        ]
        logs = [F.log(F.greatest(F.coalesce(x, F.col("lower")), F.lit(1e-12))) for x in p]
        rows = (
            found.select("full", "context", "short", "short_context", "byte")
            .join(self.full, "full", "left")
            .join(self.context, "context", "left")
            .join(self.short, "short", "left")
            .join(F.broadcast(self.short_context), "short_context", "left")
        )
        rows = rows.withColumn("one", single).withColumn("lower", F.coalesce(lower, F.col("one")))
        return rows.select("full", (logs[1] - logs[0]).alias("ratio"))


def word_ratios(vocabulary: DataFrame, model: Model) -> DataFrame:
    """``word, n, ratio`` from ``word, n`` (distinct words, checkpointed): the ratios of each word's
    grams added up. Words go by blocks, and a block gets each of its grams' ratios once, so the gram
    that most words share is no larger a key than others."""
    size = vocabulary.count()
    blocks = max(size // BLOCK_WORDS, min(size // 1000, 1000)) + 1
    placed = vocabulary.withColumn("block", F.pmod(F.xxhash64("word"), F.lit(blocks)))

    def needed(rows: pd.DataFrame) -> pd.DataFrame:
        full = np.unique(grams(rows["word"].tolist()).full.view(np.int64))
        return pd.DataFrame({"block": rows["block"].iloc[0], "full": full})

    def added(rows: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        g = grams(rows["word"].tolist())
        known = given.sort_values("full")
        each = known["ratio"].to_numpy()[np.searchsorted(known["full"].to_numpy(), g.full.view(np.int64))]
        return pd.DataFrame({"word": rows["word"], "n": rows["n"], "ratio": np.bincount(g.word, each, len(rows))})

    found = gram_counts(vocabulary.select("word", F.col("n").alias("toxic"), F.lit(0).cast("bigint").alias("ordinary")))
    wanted = placed.select("word", "block").groupBy("block").applyInPandas(needed, "block bigint, full bigint")
    given = wanted.join(model.gram_ratios(found), "full").select("block", "full", "ratio")
    both = placed.groupBy("block").cogroup(given.groupBy("block"))
    return both.applyInPandas(added, "word string, n bigint, ratio double")


def features(
    docs: DataFrame, model: Model, key: str, text: str, driver_words: int = CACHED_WORDS, scratch: Scratch | None = None
) -> DataFrame:
    """``k, a, b, c`` for each row of ``docs``: its log-likelihood ratio over its letters, the largest
    ratio of a word, and the mean of the three largest (0 each without words).

    The ratios of the most frequent words, at most ``driver_words`` of them, go to all tasks; other
    words leave their texts, meet their ratios in a join, and are added up by text again.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("string").alias("t"))
    counted = word_counts(rows.select("t", F.lit(0).alias("y")))
    vocabulary = scratch.write(counted.select("word", F.col("ordinary").alias("n")), "vocabulary")
    ratios = scratch.write(word_ratios(vocabulary, model), "ratios")
    scratch.drop("vocabulary")
    level = F.floor(F.log2("n")).cast("int").alias("level")
    levels = sorted(((r["level"], r["count"]) for r in ratios.groupBy(level).count().collect()), reverse=True)
    least, kept = 1 << 62, 0  # words as frequent as this are kept
    for exponent, count in levels:
        kept += count
        if kept > driver_words:
            break
        least = 1 << exponent
    frequent = ratios.where(F.col("n") >= least).select("word", "ratio").toArrow()  # bounded above
    shared = spark.sparkContext.broadcast((frequent["word"].to_pylist(), frequent["ratio"].to_pylist()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = dict(zip(*shared.value, strict=True))
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sums, sizes, tops, rest = [], [], [], []
                for t in part.column(1).to_pylist():
                    found = words(t)
                    every = list(map(known.get, found))
                    here = [r for r in every if r is not None] if None in every else every
                    rest.append([w for w, r in zip(found, every, strict=True) if r is None] if here is not every else [])
                    sums.append(sum(here))
                    sizes.append(sum(map(len, found)) + len(found))
                    tops.append(nlargest(3, here))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(sums, pa.float64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(tops, pa.list_(pa.float64())),
                        pa.array(rest, pa.list_(pa.string())),
                    ],
                    names=["k", "total", "size", "top", "rest"],
                )

    kind = rows.schema["k"].dataType.simpleString()
    out = rows.mapInArrow(run, f"k {kind}, total double, size bigint, top array<double>, rest array<string>")
    if any(1 << exponent < least for exponent, _ in levels):
        out = scratch.write(out.withColumn("row", F.monotonically_increasing_id()), "scored")
        apart = out.where(F.size("rest") > 0).select("row", F.explode("rest").alias("word"))
        others = apart.join(ratios.where(F.col("n") < least).select("word", "ratio"), "word")
        others = others.groupBy("row").agg(F.sum("ratio").alias("more"), F.collect_list("ratio").alias("found"))
        top = F.slice(F.sort_array(F.concat("top", "found"), asc=False), 1, 3)
        joined = out.where(F.size("rest") > 0).join(others, "row").select("k", F.expr("total + more"), "size", top)
        whole = out.where(F.size("rest") == 0).select("k", "total", "size", "top")
        out = whole.unionAll(joined.toDF("k", "total", "size", "top"))
    mean = F.aggregate("top", F.lit(0.0), lambda x, y: x + y) / F.size("top")
    some = F.col("size") > 0
    return out.select(
        "k",
        F.when(some, F.col("total") / F.col("size")).otherwise(0.0).alias("a"),
        F.when(some, F.array_max("top")).otherwise(0.0).alias("b"),
        F.when(some, mean).otherwise(0.0).alias("c"),
    )


def design(features: np.ndarray) -> np.ndarray:
    x = np.clip(features / SCALES, -5, 5)
    return np.column_stack([np.ones(len(x)), x])


def logistic(features: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 30) -> np.ndarray:
    """Weights of a logistic regression, by Newton's method."""
    x = design(features)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        w += np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
    return w


def word_counts(labelled: DataFrame) -> DataFrame:
    """``word, toxic, ordinary`` from ``t, y``: how often each word stands in texts of each class.
    Each task adds its own up first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def result() -> pa.RecordBatch:
            every = list(counts[0].keys() | counts[1].keys())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(every, pa.string()),
                    pa.array([counts[1][w] for w in every], pa.int64()),
                    pa.array([counts[0][w] for w in every], pa.int64()),
                ],
                names=["word", "toxic", "ordinary"],
            )

        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[y].update(words(text))
                if len(counts[0]) + len(counts[1]) > CACHED_WORDS:
                    yield result()
                    counts[0].clear()
                    counts[1].clear()
        yield result()

    found = labelled.select("t", "y").mapInArrow(run, "word string, toxic bigint, ordinary bigint")
    return found.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def gram_counts(counted: DataFrame) -> DataFrame:
    """``full, context, short, short_context, byte, toxic, ordinary``: one row per distinct gram."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            g = grams(batch["word"].tolist())
            rows = pd.DataFrame(
                {
                    "full": g.full.view(np.int64),
                    "context": g.context.view(np.int64),
                    "short": g.short.view(np.int64),
                    "short_context": mix(g.short_context).view(np.int64),
                    "byte": g.byte.astype(np.int32),
                    "toxic": batch["toxic"].to_numpy()[g.word],
                    "ordinary": batch["ordinary"].to_numpy()[g.word],
                }
            )
            keys = ["full", "context", "short", "short_context", "byte"]
            yield rows.groupby(keys, sort=False, as_index=False).sum()

    keys = ["full", "context", "short", "short_context", "byte"]
    types = "full bigint, context bigint, short bigint, short_context bigint, byte int, toxic bigint, ordinary bigint"
    return counted.mapInPandas(run, types).groupBy(*keys).agg(
        F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")
    )


def tables(found: DataFrame, scratch: Scratch | None = None) -> Model:
    """The model's tables of exact keys, from written counts. One row per byte comes to the driver."""
    scratch = scratch or Scratch(found.sparkSession)
    sums = lambda a, b: [F.sum("ordinary").alias(a), F.sum("toxic").alias(b)]
    seen = [F.count_if(F.col("ordinary") > 0).alias("k0"), F.count_if(F.col("toxic") > 0).alias("k1")]
    short_context = found.groupBy("short_context").agg(F.count("*").alias("st"), F.count_distinct("byte").alias("sk"))
    single = [0.0] * 258
    for r in found.groupBy("byte").agg(F.count_distinct("short_context").alias("n")).collect():
        single[r["byte"]] = float(r["n"])
    return Model(
        found.groupBy("full").agg(*sums("n0", "n1")),
        found.groupBy("context").agg(*sums("t0", "t1"), *seen),
        found.groupBy("short").agg(F.count("*").alias("s")),
        scratch.write(short_context, "short_contexts"),
        single,
    )


def toxicity_model(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    calibration_rows: int = CALIBRATION_ROWS,
) -> Model:
    """Counts over all labelled texts but those that turn the features into a probability: of one
    in five, the first ``calibration_rows`` by hash. ``labels`` should be without what is held out. Null ids and labels are left out; an id with several labels counts once, with the largest.
    Without labels, or with one class only, the score is constant."""
    ship(docs.sparkSession)
    known = (
        labels.select(F.col(f"`{key}`").alias("_id"), F.col(f"`{label}`").cast("int").alias("y"))
        .dropna()
        .groupBy("_id")
        .agg(F.least(F.max("y"), F.lit(1)).alias("y"))
    )
    texts = docs.select(F.col(f"`{key}`").alias("_id2"), F.col(f"`{text}`").alias("t"))
    known = cut_lineage(known)
    held = F.pmod(F.xxhash64("_id", F.lit("calibration")), F.lit(CALIBRATION_SHARE)) == 0
    first = cut_lineage(known.where(held).orderBy(F.xxhash64("_id"), "_id").limit(calibration_rows))
    others = small_or_not(cut_lineage(known.join(F.broadcast(first.select("_id")), "_id", "left_anti")), 32)
    counted = word_counts(texts.join(others, texts["_id2"] == others["_id"]).select("t", "y"))
    scratch = Scratch(docs.sparkSession)
    model = tables(scratch.write(gram_counts(counted), "grams"), scratch)
    chosen = texts.join(F.broadcast(first), texts["_id2"] == first["_id"]).select("t", "y")
    rows = features(chosen, model, "y", "t", scratch=scratch).withColumnRenamed("k", "y").toPandas()  # bounded above
    scratch.drop("ratios", "scored")
    if rows["y"].nunique() < 2:
        share = (rows["y"].sum() + 1) / (len(rows) + 2)
        model.weights = np.array([np.log(share / (1 - share)), 0.0, 0.0, 0.0])
    else:
        model.weights = logistic(rows[["a", "b", "c"]].to_numpy(), rows["y"].to_numpy())
    return model


def toxicity_scores(
    docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", driver_words: int = CACHED_WORDS
) -> DataFrame:
    """``key, score`` of every whole text. Null and empty texts are scored as texts without words.
    The words of all texts are counted and given their ratios at once."""
    ship(docs.sparkSession)
    columns = zip(("a", "b", "c"), SCALES, model.weights[1:].tolist(), strict=True)
    z = F.lit(float(model.weights[0]))
    for name, scale, weight in columns:
        z = z + weight * F.least(F.greatest(F.col(name) / scale, F.lit(-5.0)), F.lit(5.0))
    rows = features(docs, model, key, text, driver_words)
    return rows.select(F.col("k").alias(key), (1 / (1 + F.exp(-z))).alias("score"))
