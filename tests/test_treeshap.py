import itertools
import math

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from riskloom.operators import treeshap
from riskloom.sources.fixtures import fixture
from tests.conftest import SF


def random_tree(rng, n_feat, depth):
    left, right, feat, thr, val, cover = [], [], [], [], [], []

    def grow(d, n):
        me = len(left)
        left.append(-1); right.append(-1); feat.append(-1); thr.append(0.0)
        val.append(float(rng.normal())); cover.append(float(n))
        if d < depth and n >= 2:
            feat[me] = int(rng.integers(n_feat))  # features repeat along paths
            thr[me] = float(rng.normal())
            nl = int(rng.integers(1, n))
            left[me] = grow(d + 1, nl)
            right[me] = grow(d + 1, n - nl)
        return me

    grow(0, 200)
    return {k: np.array(v) for k, v in (("left", left), ("right", right), ("feature", feat),
                                         ("threshold", thr), ("value", val), ("cover", cover))}


def cond_expectation(t, x, S, node=0):
    if t["left"][node] < 0:
        return t["value"][node]
    f = t["feature"][node]
    a, b = t["left"][node], t["right"][node]
    if f in S:
        return cond_expectation(t, x, S, a if x[f] <= t["threshold"][node] else b)
    c = t["cover"][node]
    return (t["cover"][a] / c * cond_expectation(t, x, S, a) + t["cover"][b] / c * cond_expectation(t, x, S, b))


def shapley_brute(t, x, m):
    phi = np.zeros(m)
    for i in range(m):
        rest = [j for j in range(m) if j != i]
        for r in range(len(rest) + 1):
            for S in itertools.combinations(rest, r):
                wgt = math.factorial(r) * math.factorial(m - r - 1) / math.factorial(m)
                phi[i] += wgt * (cond_expectation(t, x, set(S) | {i}) - cond_expectation(t, x, set(S)))
    return phi


def test_tree_contributions_equal_exact_shapley():
    rng = np.random.default_rng(1)
    for _ in range(20):
        m = int(rng.integers(2, 6))
        t = random_tree(rng, m, int(rng.integers(1, 5)))
        x = rng.normal(size=(6, m))
        phi = np.zeros((6, m))
        treeshap.add_contributions(x, treeshap.leaf_paths(t), phi)
        for row, got in zip(x, phi, strict=True):
            assert np.allclose(got, shapley_brute(t, row, m), atol=1e-10)
            assert got.sum() + treeshap.expected_value(t) == pytest.approx(cond_expectation(t, row, set(range(m))))


def test_gbt_contributions_sum_to_log_odds(spark):
    v = fixture(spark, SF, "vec_accounts").withColumn("vec", array_to_vector(F.col("features").cast("array<double>")))
    m = GBTClassifier(featuresCol="vec", labelCol="y", maxDepth=4, maxIter=8, seed=1).fit(v)
    long = treeshap.tree_shap(v, treeshap.spark_trees(m), m.numFeatures)
    assert long.count() == v.count() * m.numFeatures
    c = long.groupBy("account_id").agg(F.sum("shap").alias("s"), F.first("base").alias("b"))
    p = m.transform(v).select("account_id", vector_to_array("rawPrediction")[1].alias("margin"))
    j = c.join(p, "account_id").toPandas()
    assert len(j) == v.count() and np.abs(j.s + j.b - 2 * j.margin).max() < 1e-9


def test_deep_paths_equal_exact_shapley():
    """Twelve different features on one path, and repeated ones."""
    rng = np.random.default_rng(4)
    for _ in range(2):
        m = 12
        order = np.append(rng.permutation(m), rng.integers(0, m, 3))
        n = len(order)
        t = {k: np.zeros(2 * n + 1) for k in ("threshold", "value", "cover")} | {k: np.full(2 * n + 1, -1) for k in ("left", "right", "feature")}
        t["cover"][0] = 3000.0
        for k, f in enumerate(order.tolist()):  # node k: a leaf n + 1 + k on one side, node k + 1 on the other
            leaf, sides = n + 1 + k, ["left", "right"]
            rng.shuffle(sides)
            t["feature"][k], t["threshold"][k] = f, rng.normal() / 2
            t[sides[0]][k], t[sides[1]][k] = leaf, k + 1
            t["cover"][leaf] = t["cover"][k] * rng.uniform(0.05, 0.4)
            t["cover"][k + 1] = t["cover"][k] - t["cover"][leaf]
        t["value"] = rng.normal(size=2 * n + 1)
        x = rng.normal(size=(3, m))
        phi = np.zeros((3, m))
        treeshap.add_contributions(x, treeshap.leaf_paths(t), phi)
        for row, got in zip(x, phi, strict=True):
            worth = np.array([cond_expectation(t, row, {j for j in range(m) if s >> j & 1}) for s in range(1 << m)])
            size = np.array([bin(s).count("1") for s in range(1 << m)])
            w = np.array([math.factorial(s) * math.factorial(m - s - 1) / math.factorial(m) for s in range(m)])
            for i in range(m):
                without = np.flatnonzero((np.arange(1 << m) >> i & 1) == 0)
                want = (w[size[without]] * (worth[without | 1 << i] - worth[without])).sum()
                assert got[i] == pytest.approx(want, abs=1e-9)
