"""Fitted models as column expressions and as SQL text, without a model object at scoring time.

A fitted classifier is turned into plain numbers (weights, or nodes of trees) and these into one
expression over named columns. Scoring then is a projection: it needs no vector column, is
generated code like any other expression, and the same numbers give the SQL text for engines
that have no model library.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Leaf:
    """The end of a branch."""

    value: float


@dataclass(frozen=True)
class Branch:
    """Rows whose feature is at most the threshold (or one of the values) go left."""

    feature: str
    left: Branch | Leaf
    right: Branch | Leaf
    threshold: float | None = None
    values: tuple[float, ...] = ()


@dataclass(frozen=True)
class Linear:
    """Logistic regression: weights by feature name."""

    intercept: float
    weights: tuple[tuple[str, float], ...]
    threshold: float = 0.5


@dataclass(frozen=True)
class Trees:
    """Boosted trees with their weights; the margin counts twice in the probability."""

    trees: tuple[tuple[float, Branch | Leaf], ...]
    threshold: float = 0.5


def _node(node, names: Sequence[str]) -> Branch | Leaf:
    if node.subtreeDepth() == 0:
        return Leaf(float(node.prediction()))
    split = node.split()
    feature = names[split.featureIndex()]
    left, right = _node(node.leftChild(), names), _node(node.rightChild(), names)
    if split.getClass().getSimpleName() == "ContinuousSplit":
        return Branch(feature, left, right, threshold=float(split.threshold()))
    return Branch(feature, left, right, values=tuple(float(value) for value in split.leftCategories()))


def from_fitted(model: LogisticRegressionModel | GBTClassificationModel, names: Sequence[str]) -> Linear | Trees:
    """The numbers of a fitted model; ``names`` are the features in the order of its vector."""
    if model.numFeatures != len(names):
        raise ValueError(f"the model has {model.numFeatures} features, not {len(names)}")
    if isinstance(model, LogisticRegressionModel):
        weights = zip(names, (float(weight) for weight in model.coefficients.toArray()), strict=True)
        return Linear(float(model.intercept), tuple(weights), float(model.getThreshold()))
    roots = [tree._call_java("rootNode") for tree in model.trees]
    trees = ((float(weight), _node(root, names)) for weight, root in zip(model.treeWeights, roots, strict=True))
    return Trees(tuple(trees))


def _number(value: float) -> str:
    return f"CAST({value!r} AS DOUBLE)"


def _tree_sql(node: Branch | Leaf) -> str:
    if isinstance(node, Leaf):
        return _number(node.value)
    if node.threshold is not None:
        test = f"{node.feature} <= {_number(node.threshold)}"
    else:
        test = f"{node.feature} IN ({', '.join(map(_number, node.values))})"
    return f"CASE WHEN {test} THEN {_tree_sql(node.left)} ELSE {_tree_sql(node.right)} END"


def margin_sql(model: Linear | Trees) -> str:
    """The margin as SQL text over columns named like the features (NULL where a feature is)."""
    if isinstance(model, Linear):
        parts = [f"{_number(weight)} * CAST({name} AS DOUBLE)" for name, weight in model.weights if weight]
        return "(" + " + ".join([_number(model.intercept), *parts]) + ")"
    features = sorted({name for _, tree in model.trees for name in _features(tree)})
    parts = [f"{_number(weight)} * {_tree_sql(tree)}" for weight, tree in model.trees]
    total = "(" + " + ".join([_number(0.0), *parts]) + ")"
    missing = " OR ".join(f"{name} IS NULL" for name in features)
    return f"CASE WHEN {missing} THEN NULL ELSE {total} END" if missing else total


def probability_sql(model: Linear | Trees) -> str:
    """The probability of the positive class as SQL text."""
    factor = 1.0 if isinstance(model, Linear) else 2.0
    return f"1e0 / (1e0 + exp(- {_number(factor)} * {margin_sql(model)}))"


def _features(node: Branch | Leaf) -> set[str]:
    if isinstance(node, Leaf):
        return set()
    return {node.feature} | _features(node.left) | _features(node.right)


def _tree(node: Branch | Leaf) -> Column:
    if isinstance(node, Leaf):
        return F.lit(node.value)
    feature = F.col(node.feature).cast("double")
    test = feature <= node.threshold if node.threshold is not None else feature.isin(*node.values)
    return F.when(test, _tree(node.left)).otherwise(_tree(node.right))


def margin(model: Linear | Trees) -> Column:
    """The margin as a column; NULL where a feature is."""
    if isinstance(model, Linear):
        parts = [F.lit(weight) * F.col(name).cast("double") for name, weight in model.weights if weight]
        return reduce(lambda left, right: left + right, parts, F.lit(model.intercept))
    parts = [F.lit(weight) * _tree(tree) for weight, tree in model.trees]
    total = reduce(lambda left, right: left + right, parts, F.lit(0.0))
    features = sorted({name for _, tree in model.trees for name in _features(tree)})
    known = reduce(lambda left, right: left & right, [F.col(name).isNotNull() for name in features], F.lit(True))
    return F.when(known, total)


def probability(model: Linear | Trees) -> Column:
    factor = 1.0 if isinstance(model, Linear) else 2.0
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.lit(factor) * margin(model)))


def score_rows(rows: DataFrame, model: Linear | Trees) -> DataFrame:
    """``rows`` with ``proba_positive`` and ``prediction`` (NULL where a feature is NULL)."""
    scored = rows.withColumn("proba_positive", probability(model))
    return scored.withColumn("prediction", (F.col("proba_positive") > model.threshold).cast("int"))


#: Two small models over row features, stated as numbers: scoring can be repeated in SQL.
STATED_LINEAR = Linear(
    intercept=-3.25,
    weights=(
        ("log_amount", 0.375),
        ("currency_mismatch", 0.5),
        ("is_weekend", -0.25),
        ("hour_of_day", 0.03125),
    ),
)
STATED_TREES = Trees(
    trees=(
        (
            1.0,
            Branch(
                "log10_amount_bucket",
                Branch("hour_of_day", Leaf(-0.75), Leaf(-0.25), threshold=11.5),
                Branch("currency_mismatch", Leaf(0.125), Leaf(0.625), values=(0.0,)),
                threshold=2.5,
            ),
        ),
        (
            0.5,
            Branch(
                "day_of_week",
                Branch("log10_amount_bucket", Leaf(-0.5), Leaf(0.5), threshold=3.5),
                Leaf(0.25),
                values=(1.0, 7.0),
            ),
        ),
        (0.25, Branch("is_weekend", Leaf(-0.125), Leaf(0.875), threshold=0.5)),
    ),
)
