"""Quality by a sparse ensemble of rules: conjunctions read off tree paths, weighed by a lasso."""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import text_of, words_of

SAMPLE_ROWS = 20_000
TREES = 12
DEPTH = 3
PENALTY = 0.0005
THRESHOLD = 0.3


def statistics(text: Column, words: Column) -> dict[str, Column]:
    """The statistics of a text that rules speak of, all 0 for an empty one."""
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")
    n = F.size(words)
    each = F.greatest(n, F.lit(1)).cast("double")
    repeated = F.size(F.filter(words, lambda x, i: (i > 0) & (x == F.get(words, i - 1))))
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    without = lambda pattern: F.length(F.regexp_replace(text, pattern, ""))
    return {
        "words": F.log1p(n.cast("double")),
        "word_length": F.length(text) / each,
        "letters": without(r"[^\p{L}]+") / chars,
        "capitals": without(r"[^\p{Lu}]+") / chars,
        "digits": without(r"[^0-9]+") / chars,
        "marks": without(r"[\p{L}\p{N}\s.,;:'-]+") / chars,
        "lone_marks": count(r"(?<!\S)[^\p{L}\p{N}\s]+(?!\S)") / each,
        "ends": count(r"[.!?](?=\s|$)") / each,
        "lines": count(r"\n") / each,
        "distinct": F.size(F.array_distinct(words)) / each,
        "repeated": repeated / each,
    }


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once. A named column would do as well, but a filter on
    what follows from it is moved below its projection, and then repeats it for each mention."""
    return F.get(F.transform(F.array(value), body), 0)


STATISTICS = (
    "words", "word_length", "letters", "capitals", "digits", "marks", "lone_marks", "ends", "lines", "distinct", "repeated",
)


def measured(text: Column) -> Column:
    """A struct of all statistics of the whole text."""

    def of(t: Column) -> Column:
        return let(words_of(t), lambda w: F.struct(*[c.cast("double").alias(n) for n, c in statistics(t, w).items()]))

    return let(text, of)


@dataclass(frozen=True)
class Rule:
    """All of ``(statistic, is_above, bound)`` hold."""

    terms: tuple[tuple[str, bool, float], ...]

    def column(self, statistic: Callable[[str], Column]) -> Column:
        out = F.lit(True)
        for name, above, bound in self.terms:
            value = statistic(name)
            out = out & ((value > bound) if above else (value <= bound))
        return out


def merged(terms: list[tuple[str, bool, float]]) -> Rule:
    """One bound a statistic and side: the tightest."""
    best: dict[tuple[str, bool], float] = {}
    for name, above, bound in terms:
        old = best.get((name, above))
        best[name, above] = bound if old is None else (max if above else min)(old, bound)
    return Rule(tuple(sorted((n, a, b) for (n, a), b in best.items())))


def tree_rules(description: str, names: tuple[str, ...] = STATISTICS) -> list[Rule]:
    """The paths to every node of trees given in Spark's debug text, as rules without repeats."""
    rules: dict[Rule, None] = {}
    path: list[tuple[int, tuple[str, bool, float]]] = []
    for line in description.splitlines():
        depth = len(line) - len(line.lstrip())
        if found := re.match(r"\s*(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line):
            path = [p for p in path if p[0] < depth]
            path.append((depth, (names[int(found[1])], found[2] == ">", float(found[3]))))
            rules[merged([term for _, term in path])] = None
        elif "Tree" in line:
            path = []
    return list(rules)


@dataclass(frozen=True)
class RuleModel:
    """Weighted rules; the score is the logistic function of intercept and weights that apply."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...] = field(default=())

    def column(self, text: Column) -> Column:
        """The score of a text: statistics, rules and weights in one expression."""

        def score(s: Column) -> Column:
            total = F.lit(self.intercept)
            for rule, weight in self.rules:
                total = total + F.when(rule.column(lambda n: s[n]), F.lit(weight)).otherwise(F.lit(0.0))
            return 1 / (1 + F.exp(-total))

        return let(measured(text), score)


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, key: str, text: str, label: str) -> DataFrame:
    """The statistics and ``y`` of a bounded sample: the ``rows`` labelled ids that come first by hash. Ids with
    several labels count once, with the largest; null ids and labels are left out."""
    known = (
        labels.select(F.col(f"`{key}`").alias("_id"), F.col(f"`{label}`").cast("double").alias("y"))
        .dropna()
        .groupBy("_id")
        .agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(rows)
    )
    texts = docs.select(F.col(f"`{key}`").alias("_id2"), F.col(f"`{text}`").alias("_text"))
    # At most SAMPLE_ROWS ids of a number each: small enough to broadcast.
    joined = texts.join(F.broadcast(known), texts["_id2"] == known["_id"])
    return cut_lineage(joined.select("y", measured(text_of("_text")).alias("_s"))).select("y", "_s.*")


def fit(sample: DataFrame) -> RuleModel:
    """Trees give the rules, an L1-penalised logistic regression their weights."""
    counts = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}  # two classes
    all_, good = sum(counts.values()), counts.get(1.0, 0)
    prior = (good + 1) / (all_ + 2)
    plain = RuleModel(math.log(prior / (1 - prior)))
    if not good or good == all_:
        return plain
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = sample.coalesce(4)
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="x").transform(rows)
    # The rarer class weighs as much as the other while the trees look for rules.
    balance = F.when(F.col("y") == 1, all_ / (2 * good)).otherwise(all_ / (2 * (all_ - good)))
    forest = RandomForestClassifier(
        featuresCol="x", labelCol="y", weightCol="b", numTrees=TREES, maxDepth=DEPTH, seed=7, maxBins=64,
        subsamplingRate=0.7, featureSubsetStrategy="0.5",
    ).fit(vectors.withColumn("b", balance).select("x", "y", "b"))
    rules = tree_rules(forest.toDebugString)
    if not rules:
        return plain
    held = [F.when(r.column(F.col), 1.0).otherwise(0.0).alias(f"r{i}") for i, r in enumerate(rules)]
    marked = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="x").transform(
        rows.select("y", *held)
    )
    lasso = LogisticRegression(
        featuresCol="x", labelCol="y", elasticNetParam=1.0, regParam=PENALTY, standardization=False, maxIter=60
    ).fit(marked.select("x", "y"))
    weights = [(r, float(w)) for r, w in zip(rules, lasso.coefficients, strict=True) if w != 0.0]
    return RuleModel(float(lasso.intercept), tuple(weights))


def quality_model(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> RuleModel:
    """A model fitted on at most ``sample_rows`` labelled documents. ``labels`` should already be
    without what is held out. Without labels, or with one class only, the score is constant."""
    return fit(labelled_sample(docs, labels, sample_rows, key, text, label))


def scored(docs: DataFrame, model: RuleModel, text: str = "text", column: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text, computed in column expressions only. Null and
    empty texts are scored as texts without words; repeated rows and null ids each keep their row.
    A column of the name ``column`` is replaced, so choose one that isn't there."""
    return docs.withColumn(column, model.column(text_of(text)))
