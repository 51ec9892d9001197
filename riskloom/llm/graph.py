"""Connected components of an edge table, by alternating large-star and small-star rounds.

Each round groups by one end (partial minimum before the shuffle) and joins the minimum back
(a sort-merge join, whose hot keys AQE splits), so no neighbourhood meets in one task. Every
round is written to the shared checkpoint folder; the rounds end when a round changes nothing.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import cut_lineage


def _round(edges: DataFrame, large: bool) -> DataFrame:
    """edges: (a, b), a > b. Large star hangs the larger neighbours of each node on its smallest
    neighbour; small star does so with the node and its smaller neighbours."""
    if large:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        tied = edges.join(least, "a").select(F.col("b").alias("x"), "m")
        out = tied.union(least.select("a", "m")).toDF("a", "b")
    return out.where("a != b").distinct()


def _sign(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(id, component) for every id that occurs in ``edges`` (two integer columns, any order,
    repeats and loops allowed): the smallest id reachable. Ids without an edge have no row."""
    a, b = edges.columns[:2]
    now = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a != b").distinct()
    now = cut_lineage(now)
    last = _sign(now)
    for _ in range(max_rounds if last[0] else 0):
        now = cut_lineage(_round(_round(now, large=True), large=False))
        this = _sign(now)
        if this == last:
            break
        last = this
    else:
        if last[0]:
            raise RuntimeError(f"components: {max_rounds} rounds were not enough")
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        now.select("b", "b").distinct())


def forest(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and links u[i]-v[i] of one block: the smallest node reachable from each."""
    label = np.arange(n)
    while len(u):
        a, b = label[u], label[v]
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while not np.array_equal(up := label[label], label):
            label = up
        open_ = label[u] != label[v]
        u, v = u[open_], v[open_]
    return label
