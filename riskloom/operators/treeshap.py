"""Exact path-dependent tree contributions (Shapley values) for tree ensembles.

A leaf's value counts for a row in proportion to the conditions on its path that hold. With the
path's distinct features as players, feature j has a share z_j of the training rows that pass its
conditions, and o_j says whether the row passes them. The leaf gives feature i
value * (o_i - z_i) * sum over subsets S of the other features of
|S|! (D - |S| - 1)! / D! * prod(o in S) * prod(z outside S). The sums by size of S are the coefficients of
the product of (z_j + o_j t): the path is extended one feature at a time, and feature i is taken out again by
one division by (z_i + o_i t), so a leaf costs D^2 steps however deep it is. All rows with the same o (at most
the rows of a batch) are one row of the numpy arrays, and all features are taken out at once.
"""

from __future__ import annotations

from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tree_table(tree_model) -> dict[str, np.ndarray]:
    """Arrays left/right/feature/threshold/value/cover of one Spark decision tree
    (split rule: x[feature] <= threshold goes left)."""
    left, right, feat, thr, val, cover = [], [], [], [], [], []
    stack = [(tree_model._java_obj.rootNode(), -1, 0)]
    while stack:
        node, parent, side = stack.pop()
        me = len(left)
        left.append(-1); right.append(-1); feat.append(-1); thr.append(0.0)
        val.append(float(node.prediction())); cover.append(float(node.impurityStats().count()))
        if parent >= 0:
            (left if side == 0 else right)[parent] = me
        if node.getClass().getSimpleName() == "InternalNode":
            split = node.split()
            feat[me], thr[me] = int(split.featureIndex()), float(split.threshold())
            stack.append((node.rightChild(), me, 1))
            stack.append((node.leftChild(), me, 0))
    return {k: np.array(v) for k, v in (("left", left), ("right", right), ("feature", feat),
                                         ("threshold", thr), ("value", val), ("cover", cover))}


def leaf_paths(t: dict[str, np.ndarray]) -> list[tuple[np.ndarray, list[list[tuple[float, bool]]], np.ndarray, float]]:
    """For each leaf below at least one split that holds training rows: (features, their conditions
    (threshold, goes left), their shares, value)."""
    out = []
    stack: list[tuple[int, dict[int, tuple[float, list[tuple[float, bool]]]]]] = [(0, {})]
    while stack:
        node, path = stack.pop()
        if t["cover"][node] <= 0:
            continue  # no row came here: its leaves weigh nothing
        if t["left"][node] >= 0:
            f, cut = int(t["feature"][node]), float(t["threshold"][node])
            for child, left in ((int(t["left"][node]), True), (int(t["right"][node]), False)):
                share, held = path.get(f, (1.0, []))
                step = float(t["cover"][child] / t["cover"][node])
                stack.append((child, {**path, f: (share * step, [*held, (cut, left)])}))
        elif path:
            feats = np.array(list(path))
            out.append((feats, [path[f][1] for f in feats.tolist()], np.array([path[f][0] for f in feats.tolist()]), float(t["value"][node])))
    return out


def path_contributions(z: np.ndarray, o: np.ndarray) -> np.ndarray:
    """[row, feature] contributions of a leaf of value 1 with shares ``z`` for rows that pass as ``o`` says."""
    d = len(z)
    whole = np.zeros((len(o), d + 1))  # coefficients of the product of (z_j + o_j t)
    whole[:, 0] = 1.0
    for j in range(d):
        moved = whole[:, :-1] * o[:, j:j + 1]
        whole *= z[j]
        whole[:, 1:] += moved
    size_weight = [factorial(s) * factorial(d - s - 1) / factorial(d) for s in range(d)]
    passed = o > 0
    # without feature i: divided by z_i where the row fails it, by (z_i + t), highest power first, where it passes
    rest, total = np.zeros((len(o), d)), np.zeros((len(o), d))
    for s in reversed(range(d)):
        rest = np.where(passed, whole[:, s + 1:s + 2] - z * rest, whole[:, s:s + 1] / z)
        total += size_weight[s] * rest
    return (o - z) * total


def add_contributions(x: np.ndarray, leaves: list, phi: np.ndarray, scale: float = 1.0) -> None:
    """Add a tree's contributions for the rows of ``x`` into ``phi`` (both rows x features)."""
    passes: dict[tuple[int, float], np.ndarray] = {}
    for feats, conditions, z, value in leaves:
        ok = np.ones((len(x), len(feats)), bool)
        for j, (f, held) in enumerate(zip(feats.tolist(), conditions, strict=True)):
            for cut, left in held:
                below = passes.get((f, cut))
                if below is None:
                    below = passes[f, cut] = x[:, f] <= cut
                ok[:, j] &= below if left else ~below
        packed = np.packbits(ok, axis=1)
        _, first, back = np.unique(packed.view(f"S{packed.shape[1]}" if packed.shape[1] > 1 else np.uint8).ravel(), return_index=True, return_inverse=True)
        phi[:, feats] += (scale * value * path_contributions(z, ok[first].astype(float)))[back]


def expected_value(t: dict[str, np.ndarray]) -> float:
    leaves = t["left"] < 0
    return float((t["value"][leaves] * t["cover"][leaves]).sum() / t["cover"][0])


def spark_trees(model, unit: float = 2.0) -> list[dict[str, np.ndarray]]:
    """The trees of a Spark boosted classifier in log-odds (twice its margin)."""
    tables = [(tree_table(t), float(w)) for t, w in zip(model.trees, model.treeWeights, strict=True)]
    return [{**t, "value": t["value"] * w * unit} for t, w in tables]


def tree_shap(df: DataFrame, trees: list[dict[str, np.ndarray]], width: int, prior: float = 0.0, col: str = "features",
              names: list[str] | None = None, id_col: str = "account_id") -> DataFrame:
    """``(account_id, feature, shap, base)`` for every row and each of ``width`` features, zeros included;
    sum(shap) + base = the model's log-odds. Null and NaN count as lower than any number."""
    base = prior + float(sum(expected_value(t) for t in trees))
    labels = np.array(names or [f"f{i}" for i in range(width)], dtype=object)
    packed = [leaf_paths(t) for t in trees]  # trees x leaves, a bounded table

    def explain(batches):
        for whole in batches:
            for at in range(0, len(whole), 5000):
                pdf = whole.iloc[at:at + 5000]
                x = np.array(pdf[col].tolist(), dtype=float).reshape(len(pdf), -1)
                x = np.where(np.isnan(x), -np.inf, x)
                phi = np.zeros((len(pdf), width))
                for leaves in packed:
                    add_contributions(x, leaves, phi)
                yield pd.DataFrame({id_col: np.repeat(pdf[id_col].to_numpy(), width), "feature": np.tile(labels, len(pdf)),
                                    "shap": phi.ravel(), "base": base})

    id_type = df.schema[id_col].dataType.simpleString()
    rows = df.select(id_col, F.col(col).cast("array<double>").alias(col))
    return rows.mapInPandas(explain, f"{id_col} {id_type}, feature string, shap double, base double")
