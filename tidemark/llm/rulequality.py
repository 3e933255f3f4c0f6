"""Quality scores by a sparse ensemble of rules.

Each text becomes a row of statistics (`STATISTICS`), counted in one scan by column
expressions. A forest of shallow trees is grown on labelled rows; every path from a root
to a node is a rule, a conjunction of limits on statistics. Lasso logistic regression
over the rules' truth values keeps few of them. These, with their weights, are compiled
into one column expression, so scoring is a projection.

Forest and regression are fitted on at most about `SAMPLE_ROWS` labelled rows, drawn by a
hash of the id and the text's statistics; rows are counted and scored in full.

Defined results: a null text counts as empty, whose statistics are all 0, and has a score
as any other; very long texts are counted whole; rows that are repeated are learnt as often
as they stand (a share of them, if sampled) and score alike; labels other than 0 and 1
are not learnt; an id with several labels is learnt with each distinct one. Without
labelled rows, or with one label only, there are no rules and all scores are the
smoothed share of label 1. Other columns are never read. An empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.once import computed_once
from tidemark.session import stage

SAMPLE_ROWS = 40_000
TREES, DEPTH, BINS = 24, 3, 64
LASSO = 0.002
ITERATIONS = 60
SEED = 11
LEAST_SUPPORT = 0.002  # a rule that holds for a smaller share of the sample, or a larger one of its opposite, goes

_SPACE = r"[\x20\x09-\x0D]+"


def _removed(text: Column, pattern: str) -> Column:
    """Characters that match."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def _again(items: Column) -> Column:
    """How many items equal the one before."""
    return F.size(F.filter(items, lambda x, i: (i > 0) & (x == F.get(items, i - 1))))


#: The statistics, in the order in which `_statistics` gives them.
STATISTICS = (
    "chars", "words", "word_length", "longest_word", "upper", "digits", "symbols", "stops", "distinct_words", "repeated_words",
    "distinct_lines", "line_words", "bare_words",
)


def _statistics() -> list[Column]:
    """STATISTICS of a text from `text`, `word_list` and `line_list`; none is null."""
    text, words, lines = F.col("text"), F.col("word_list"), F.col("line_list")
    n_chars, n_words, n_lines = F.length(text), F.size(words), F.size(lines)
    return [
        F.log1p(n_chars),
        F.log1p(n_words),
        _share(F.aggregate(words, F.lit(0), lambda n, w: n + F.length(w)), n_words),
        F.log1p(F.aggregate(words, F.lit(0), lambda n, w: F.greatest(n, F.length(w)))),
        _share(_removed(text, r"\p{Lu}+"), n_chars),
        _share(_removed(text, r"[0-9]+"), n_chars),
        _share(_removed(text, r"[^\p{L}\p{N}\s.,'-]+"), n_chars),
        _share(_removed(text, r"[.,]+"), n_words),
        _share(F.size(F.array_distinct(words)), n_words),
        _share(_again(words), n_words),
        _share(F.size(F.array_distinct(lines)), n_lines),
        _share(n_words, n_lines),
        _share(F.size(F.filter(words, lambda w: ~w.rlike(r"\p{L}"))), n_words),
    ]


@dataclass(frozen=True)
class Rule:
    """Holds where every statistic lies in (low, high]."""

    limits: tuple[tuple[str, float, float], ...]

    def column(self) -> Column:
        return reduce(and_, [c for name, low, high in self.limits for c in (
            [F.col(name) > low] * (low > -math.inf) + [F.col(name) <= high] * (high < math.inf)
        )])

    def holds(self, row: dict[str, float]) -> bool:
        return all(low < row[name] <= high for name, low, high in self.limits)


@dataclass(frozen=True)
class Ensemble:
    base: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """The chance of label 1, from the statistics' columns."""
        z = F.lit(self.base)
        for rule, weight in self.weights:
            z = z + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-z))


def statistics(docs: DataFrame, text: str = "text", keep: str = "doc_id") -> DataFrame:
    """id and STATISTICS of every row."""
    rows = docs.select(F.col(f"`{keep}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    some = lambda parts: F.filter(parts, lambda x: x != "")
    split = computed_once(rows, {"word_list": some(F.split("text", _SPACE)), "line_list": some(F.split("text", "\n"))})
    return split.select("id", *[c.alias(name) for name, c in zip(STATISTICS, _statistics(), strict=True)])


def _rules(tree, names: list[str]) -> list[Rule]:
    """Paths from the root to every node below it, nearest first; limits of one statistic are merged."""
    found: list[Rule] = []
    open_ = [(tree._call_java("rootNode"), {})]
    while open_:
        node, limits = open_.pop(0)
        if limits:
            found.append(Rule(tuple((n, *limits[n]) for n in sorted(limits))))
        if "InternalNode" in node.getClass().getName():
            name, threshold = names[node.split().featureIndex()], float(node.split().threshold())
            low, high = limits.get(name, (-math.inf, math.inf))
            open_.append((node.leftChild(), {**limits, name: (low, min(high, threshold))}))
            open_.append((node.rightChild(), {**limits, name: (max(low, threshold), high)}))
    return found


def fit(labelled: DataFrame) -> Ensemble:
    """Learn from STATISTICS, `id` and `label` (0 or 1)."""
    labelled = labelled.where(F.col("label").isin(0, 1))
    rows, ones = labelled.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < ones < rows:
        return Ensemble(math.log((ones + 1) / (rows - ones + 1)), ())
    names = list(STATISTICS)
    spot = F.pmod(F.xxhash64("id", *names), F.lit(1 << 30))
    drawn = labelled.where(spot < int((1 << 30) * min(1.0, SAMPLE_ROWS / rows)))
    drawn = drawn.select(F.col("label").cast("double").alias("label"), *names, array_to_vector(F.array(*names)).alias("features"))
    drawn = stage(drawn.repartition(8), "quality-sample")  # at most about SAMPLE_ROWS rows
    found = drawn.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not 0 < found[1] < found[0]:
        return Ensemble(math.log((ones + 1) / (rows - ones + 1)), ())
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, maxBins=BINS, featureSubsetStrategy="onethird", seed=SEED
    ).fit(drawn)
    rules = list(dict.fromkeys(rule for tree in forest.trees for rule in _rules(tree, names)))
    if not rules:
        return Ensemble(math.log((ones + 1) / (rows - ones + 1)), ())
    support = drawn.agg(*[F.avg(rule.column().cast("double")).alias(f"r{i}") for i, rule in enumerate(rules)]).first()
    rules = [rule for rule, s in zip(rules, support, strict=True) if LEAST_SUPPORT <= s <= 1 - LEAST_SUPPORT]
    if not rules:
        return Ensemble(math.log((ones + 1) / (rows - ones + 1)), ())
    truth = stage(drawn.select("label", array_to_vector(F.array(*[r.column().cast("double") for r in rules])).alias("features")), "quality-truth")
    line = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=ITERATIONS, standardization=True).fit(truth)
    weights = line.coefficients.toArray().tolist()
    return Ensemble(float(line.intercept), tuple((r, w) for r, w in zip(rules, weights, strict=True) if w))


def scores(docs: DataFrame, labels: DataFrame, training: Column, text: str = "text", keep: str = "doc_id") -> DataFrame:
    """id and `score` of every row of `docs`; learnt from `labels` (id, label) of ids for which `training` holds."""
    stats = stage(statistics(docs, text, keep), "quality-statistics")
    known = stage(labels.where("id IS NOT NULL").select("id", "label").distinct(), "quality-labels")
    return stats.select("id", fit(stats.where(training).join(known, "id")).score().alias("score"))
