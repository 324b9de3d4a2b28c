"""Additive attributions of the boosted model (path-dependent tree Shapley values)."""

from __future__ import annotations

from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from premia.operators.boost import BoostedModel, Tree, binned


def _leaf_paths(tree: Tree, node: int = 0, path: tuple = ()):
    """(leaf value, {feature: (cover ratio, [(split, goes left), ...])}) for every leaf."""
    if node not in tree.children:
        rules: dict[str, list] = {}
        for parent, child, goes_left in path:
            split = tree.splits[parent]
            entry = rules.setdefault(split.feature, [1.0, []])
            entry[0] *= tree.rows[child] / max(tree.rows[parent], 1)
            entry[1].append((split, goes_left))
        yield tree.values[node], rules
        return
    left, right = tree.children[node]
    yield from _leaf_paths(tree, left, (*path, (node, left, True)))
    yield from _leaf_paths(tree, right, (*path, (node, right, False)))


def expected_value(tree: Tree) -> float:
    """Cover-weighted mean of the leaves."""
    return sum(v * float(np.prod([r[0] for r in rules.values()])) for v, rules in _leaf_paths(tree))


def _times(poly: np.ndarray, absent: float, present: np.ndarray) -> np.ndarray:
    """``poly`` (coefficients x rows) times (absent + present t)."""
    out = np.zeros((len(poly) + 1, poly.shape[1]))
    out[:-1] = poly * absent
    out[1:] += poly * present
    return out


def _without(poly: np.ndarray, absent: float, present: np.ndarray) -> np.ndarray:
    """``poly`` divided by the factor (absent + present t): from the top where the row has the feature, else from below.

    A row's ``present`` is 0 or 1; without it the factor is the constant ``absent``, which is above 0.
    """
    n = len(poly) - 1
    out = np.empty((n, poly.shape[1]))
    carry = np.zeros(poly.shape[1])
    for k in range(n - 1, -1, -1):
        carry = poly[k + 1] - absent * carry
        out[k] = carry
    gone = present == 0
    out[:, gone] = poly[:-1, gone] / absent
    return out


def tree_attributions(bins: np.ndarray, trees: list[Tree], features: list[str]) -> np.ndarray:
    """Rows x features. For each leaf a feature on its path is present (indicator) or absent (cover ratio); its share
    is the Shapley-weighted sum over the subsets of the other path features. One polynomial per path holds the product
    of all its features; dividing a feature's factor out gives the subsets of the others."""
    out = np.zeros((len(bins), len(features)))
    for tree in trees:
        for value, rules in _leaf_paths(tree):
            if not rules:
                continue
            names = list(rules)
            present = np.ones((len(names), len(bins)))
            for i, name in enumerate(names):
                at = bins[:, features.index(name)]
                for split, goes_left in rules[name][1]:
                    present[i] *= split.goes_left(at) == goes_left
            absent = [rules[name][0] for name in names]
            d = len(names)
            weights = np.array([factorial(k) * factorial(d - k - 1) / factorial(d) for k in range(d)])
            poly = np.ones((1, len(bins)))
            for i in range(d):
                poly = _times(poly, absent[i], present[i])
            for i, name in enumerate(names):
                subsets = weights @ _without(poly, absent[i], present[i])
                out[:, features.index(name)] += value * (present[i] - absent[i]) * subsets
    return out


def shap_contributions(df: DataFrame, model: BoostedModel, keep: list[str]) -> DataFrame:
    """``keep`` columns, one attribution column per feature and ``expected``; they add up to the log prediction.

    The ensemble (bounded by trees x leaves) travels with the task; rows are partitioned by Spark.
    """
    rows = binned(df, model.binning, keep)
    features = model.binning.features
    text = model.to_json()

    def explain(batches):
        own = BoostedModel.from_json(text)
        expected = own.base + sum(expected_value(t) for t in own.trees)
        for batch in batches:
            bins = batch[[f"b_{f}" for f in features]].to_numpy()
            values = pd.DataFrame(tree_attributions(bins, own.trees, features), columns=features)
            yield pd.concat([batch[keep].reset_index(drop=True), values], axis=1).assign(expected=expected)

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema.fields)
    named = ", ".join(f"`{f}` double" for f in features)
    return rows.mapInPandas(explain, f"{kept}, {named}, expected double")
