"""Quality classifier: a sparse ensemble of rules.

Random trees are fitted to statistics of labelled texts. Every path from a root to
a node is a rule, a conjunction of threshold tests. Lasso logistic regression over
the rules keeps few of them with weights, and the score is compiled into one
column expression, so scoring is a projection that Spark evaluates by itself.

The bounded sample is one partition, so the weights are found in one task: Newton steps,
each solved by coordinate descent over the weighted products of the rules, until no
weight moves.

Labels come from rows outside the held-out fold only. The fit uses at most
``sample_rows`` labelled rows, those of smallest hash, which is the one bound here;
scores cover every text.

Defined cases: a null text is scored as an empty one; repeated rows get equal
scores; labelled ids without a document, null ids and labels other than 0 and 1 are not
learned from; with no labelled rows of either class the score is (n1 + 1) / (n + 2).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import log

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.quality_rules import full_lines, n_stop_words
from orderflow.llm.text import SPACE, bound, whole, words


@dataclass(frozen=True)
class Fit:
    sample_rows: int = 20_000
    trees: int = 24
    depth: int = 3
    lasso: float = 0.002
    seed: int = 11


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col("__features")[self.feature]
        return value > self.threshold if self.above else value <= self.threshold


Rule = tuple[Test, ...]


@dataclass(frozen=True)
class Ensemble:
    """score = 1 / (1 + exp(-(bias + sum of the weights of rules that hold)))"""

    bias: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """Over the columns of features()."""
        total = F.lit(self.bias)
        for rule, weight in self.rules:
            total = total + F.when(holds(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def holds(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, (test.column() for test in rule))


FEATURES = (
    "log_words",
    "mean_word",
    "symbols",
    "marks",
    "capitals",
    "digits",
    "stop_words",
    "distinct_words",
    "duplicate_lines",
    "line_words",
)


def features(docs: DataFrame) -> DataFrame:
    """The documents with one struct column ``__features`` of doubles, all of the text alone."""
    text = whole("text")

    def lost(pattern: str) -> Column:
        return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))

    tokens = bound(
        words(text),
        lambda w: F.struct(
            F.size(w).alias("n"),
            F.size(F.array_distinct(w)).alias("distinct"),
            n_stop_words(w).alias("stop"),
        ),
    )
    lines = bound(
        full_lines(text),
        lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("distinct")),
    )
    counted = docs.withColumn(
        "__counts",
        F.struct(
            tokens.alias("w"),
            lines.alias("l"),
            lost(SPACE).alias("spaces"),
            F.length(text).alias("chars"),
            lost(r"[#*$%&|<>]").alias("symbols"),
            lost(r"[!?=~^_@\\/{}\[\]]").alias("marks"),
            lost("[A-Z]").alias("capitals"),
            lost("[0-9]").alias("digits"),
        ),
    )
    c = F.col("__counts")
    n = F.greatest(c["w"]["n"], F.lit(1))
    solid = F.greatest(c["chars"] - c["spaces"], F.lit(1))
    lines_n = F.greatest(c["l"]["n"], F.lit(1))
    values = {
        "log_words": F.log1p(c["w"]["n"].cast("double")),
        "mean_word": (c["chars"] - c["spaces"]) / n,
        "symbols": c["symbols"] / n,
        "marks": c["marks"] / n,
        "capitals": c["capitals"] / solid,
        "digits": c["digits"] / solid,
        "stop_words": c["w"]["stop"] / n,
        "distinct_words": c["w"]["distinct"] / n,
        "duplicate_lines": (c["l"]["n"] - c["l"]["distinct"]) / lines_n,
        "line_words": c["w"]["n"] / lines_n,
    }
    return counted.withColumn(
        "__features", F.struct(*(values[k].cast("double").alias(k) for k in FEATURES))
    ).drop("__counts")


def held_out(doc_id: Column) -> Column:
    """The quarter of the ids that no label is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, fit: Fit) -> DataFrame:
    """Features and label of the labelled rows to fit on.

    The sampled labels are at most ``fit.sample_rows`` rows, so they can be
    broadcast and the texts stay where they are.
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .where(~held_out(F.col("doc_id")))
        .select(F.col("doc_id").alias("__id"), F.col("quality").cast("double").alias("label"))
        .orderBy(F.xxhash64(F.lit(fit.seed), "__id"), "__id", "label")
        .limit(fit.sample_rows)
    )
    rows = docs.select("doc_id", "text").join(
        F.broadcast(chosen), F.col("doc_id") == F.col("__id")
    )
    return features(rows).select("doc_id", "label", "__features")


def _paths(node, names: tuple[str, ...], path: Rule = ()) -> list[Rule]:
    found = [path] if path else []
    if node.getClass().getSimpleName() == "InternalNode":
        split = node.split()
        name, threshold = names[split.featureIndex()], split.threshold()
        for above, child in ((False, node.leftChild()), (True, node.rightChild())):
            found += _paths(child, names, (*path, Test(name, above, threshold)))
    return found


def _canonical(rule: Rule) -> Rule:
    """Each feature and direction once, with its tightest threshold."""
    tightest: dict[tuple[str, bool], float] = {}
    for test in rule:
        key = (test.feature, test.above)
        better = max if test.above else min
        tightest[key] = better(tightest.get(key, test.threshold), test.threshold)
    return tuple(Test(f, above, t) for (f, above), t in sorted(tightest.items()))


def _logit(share: float) -> float:
    return log(share / (1 - share))


def _loss(margin: np.ndarray, labels: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, margin) - labels * margin))


def lasso_weights(
    flags: np.ndarray, labels: np.ndarray, penalty: float, steps: int = 100, tol: float = 1e-8
) -> tuple[float, np.ndarray]:
    """Bias and weights that minimise the mean logistic loss plus ``penalty`` times the
    sum of weights, each counted in standard deviations of its flag."""
    spread = flags.std(axis=0)
    some = np.flatnonzero(spread > 0)
    # A column of ones for the bias, which is not penalised.
    x = np.column_stack([np.ones(len(labels)), flags[:, some] / spread[some]])
    cost = np.r_[0.0, np.full(len(some), penalty)]
    w = np.zeros(x.shape[1])
    w[0] = _logit(float(labels.mean()))
    value = _loss(x @ w, labels) + float(cost @ np.abs(w))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(x @ w)))
        weight = np.maximum(p * (1 - p), 1e-6)
        products = (x * weight[:, None]).T @ x / len(labels)
        aim = products @ w + x.T @ (labels - p) / len(labels)
        new = w.copy()
        for _ in range(1000):
            moved = 0.0
            for j in range(len(new)):
                pull = aim[j] - products[j] @ new + products[j, j] * new[j]
                to = np.sign(pull) * max(abs(pull) - cost[j], 0.0) / products[j, j]
                moved = max(moved, abs(to - new[j]))
                new[j] = to
            if moved < tol:
                break
        # Half the step until the aim itself gets better.
        step = new - w
        for _ in range(30):
            found = _loss(x @ (w + step), labels) + float(cost @ np.abs(w + step))
            if found <= value + 1e-15:
                break
            step /= 2
        w, gain, value = w + step, value - found, found
        if gain < tol * 1e-2:
            break
    weights = np.zeros(flags.shape[1])
    weights[some] = w[1:] / spread[some]
    return float(w[0]), weights


def _fitted(flags: DataFrame, penalty: float) -> tuple[float, list[float]]:
    """Bias and weights for the rows (label, flags) of one partition."""

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = list(batches)
        if not found:
            return
        rows = pa.Table.from_batches(found)
        values = np.column_stack([rows.column(c).to_numpy() for c in rows.column_names[1:]])
        bias, weights = lasso_weights(values.astype(float), rows.column(0).to_numpy(), penalty)
        yield pa.RecordBatch.from_arrays([pa.array([bias]), pa.array([weights.tolist()])], ["b", "w"])

    row = flags.mapInArrow(fit, "b double, w array<double>").head()
    return row["b"], list(row["w"])


def fit_ensemble(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> Ensemble:
    """Trees, their paths as rules, and lasso weights. The sample is bounded and
    put in one order, so refits agree."""
    rows = sample(docs, labels, fit).repartition(1).sortWithinPartitions("doc_id", "__features").cache()
    try:
        return _fit(rows, fit)
    finally:
        rows.unpersist()


def _fit(rows: DataFrame, fit: Fit) -> Ensemble:
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        share = (counts.get(1.0, 0) + 1) / (sum(counts.values()) + 2)
        return Ensemble(_logit(share), ())
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(
        rows.select("label", "__features.*")
    )
    forest = RandomForestClassifier(
        featuresCol="x", numTrees=fit.trees, maxDepth=fit.depth, seed=fit.seed, maxBins=64
    ).fit(data)
    rules = sorted(
        {
            _canonical(path)
            for tree in forest.trees
            for path in _paths(tree._call_java("rootNode"), FEATURES)
        },
        key=repr,
    )
    if not rules:
        return Ensemble(_logit(counts[1.0] / sum(counts.values())), ())
    flags = rows.select("label", *(holds(rule).alias(f"r{i}") for i, rule in enumerate(rules)))
    bias, weights = _fitted(flags, fit.lasso)
    return Ensemble(bias, tuple((r, w) for r, w in zip(rules, weights, strict=True) if w))


def scored(docs: DataFrame, ensemble: Ensemble) -> DataFrame:
    """The documents with ``score``; all other columns unchanged."""
    return features(docs).withColumn("score", ensemble.score()).drop("__features")
