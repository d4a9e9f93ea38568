"""Fitted trees as one column expression, so that scoring needs neither vectors nor Python."""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import Column, functions as F


def _number(x: float) -> str:
    return f"{float(x)!r}D"


def _below(column: str, threshold: float, edges: list[float] | None) -> str:
    """The test that goes left. With ``edges`` the model saw bins, each starting at its edge, and the column has the values."""
    if edges is None:
        return f"{column} <= {_number(threshold)}"
    edge = edges[math.floor(threshold) + 1]
    return f"{column} < {_number(edge)}" if math.isfinite(edge) else f"NOT isnan({column})"


def _node_sql(node, inputs: list[str], edges: list[list[float]] | None) -> str:
    """A tree's answer as nested CASE: a value on the threshold goes left, as in the model; NaN is greater than all."""
    if node.getClass().getSimpleName() == "LeafNode":
        return _number(node.prediction())
    split = node.split()
    column = inputs[split.featureIndex()]
    if split.getClass().getSimpleName() == "CategoricalSplit":
        test = f"{column} IN ({', '.join(_number(c) for c in split.leftCategories())})"
    else:
        test = _below(column, split.threshold(), edges[split.featureIndex()] if edges else None)
    left, right = (_node_sql(child, inputs, edges) for child in (node.leftChild(), node.rightChild()))
    return f"CASE WHEN {test} THEN {left} ELSE {right} END"


def margin_column(model: GBTClassificationModel, inputs: list[str], edges: list[list[float]] | None = None) -> Column:
    """Weighted sum of all trees over columns of doubles, in the order of the model's features.

    ``edges``, those of a Bucketizer, say that the model was fitted to bins of these columns.
    """
    quoted = [f"`{c}`" for c in inputs]
    terms = [f"{_number(w)} * ({_node_sql(tree._java_obj.rootNode(), quoted, edges)})" for w, tree in zip(model.treeWeights, model.trees)]
    return F.expr(" + ".join(terms))


def probability_column(model: GBTClassificationModel, inputs: list[str], edges: list[list[float]] | None = None) -> Column:
    """Probability of class 1: the logistic curve of twice the margin."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * margin_column(model, inputs, edges)))
