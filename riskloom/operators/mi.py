"""Mutual information of continuous features with a binary label, kNN estimator
(Ross 2014, k = 5), distributed.

For a point i of class c: d_i = distance to its k_i-th nearest neighbour of the same
class (k_i = min(k, n_c - 1)); m_i = number of points of any class closer than d_i
(all points equal to x_i when d_i = 0). MI = psi(N) + <psi(k_i)> - <psi(n_c)> - <psi(m_i)>,
floored at 0. Equal points of a class have equal d and m, so everything runs on distinct
(feature, class, value) rows with counts: a value that a third of the rows share is one
row. The k nearest neighbours sit among the k distinct values on either side, so d comes
from an equi-join on within-class rank; m is a difference of two running counts (range
queries answered by sorting query points among the data points). Ranks and counts are
bucketed running totals. Unlike the reference's library no jitter is added, so ties are
resolved exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.cumulative import count_below, running_totals
from riskloom.session import cut_lineage

K_NEIGHBOURS = 5


def digamma(x: Column) -> Column:
    """psi(x) for x >= 1: recurrence to x + 6, then the asymptotic series."""
    z = x + 6.0
    z2 = z * z
    asym = (F.log(z) - 1.0 / (2.0 * z) - 1.0 / (12.0 * z2) + 1.0 / (120.0 * z2 * z2)
            - 1.0 / (252.0 * z2 * z2 * z2) + 1.0 / (240.0 * z2 * z2 * z2 * z2))
    for j in range(6):
        asym = asym - 1.0 / (x + float(j))
    return asym


def feature_buckets(df: DataFrame, value: str, boundaries: DataFrame, n_bounds: int) -> DataFrame:
    """``_bkt`` = number of the feature's boundaries below ``value`` (monotone)."""
    j = df.join(boundaries, "feature")  # one row per feature
    return j.withColumn("_bkt", count_below(F.col(value), F.col("_b"), F.size("_b"), n_bounds)).drop("_b")


ROWS_PER_BUCKET = 250_000


def mi_knn(long: DataFrame, k: int = K_NEIGHBOURS, label: str = "y", buckets: int | None = None) -> DataFrame:
    """``(feature, mi)`` from ``long(account_id, y, feature, value)``. The number of value buckets per
    feature follows the feature with most distinct values (about 250k rows each, 16 at least)."""
    v = long.where(F.col("value").isNotNull()).groupBy("feature", F.col(label).alias("y"), "value").agg(F.count(F.lit(1)).alias("c"))
    v = cut_lineage(v)
    cnt = v.groupBy("feature", "y").agg(F.sum("c").alias("n_c"))
    v = v.join(cnt.where("n_c > 1"), ["feature", "y"]).withColumn("k_i", F.least(F.lit(k), F.col("n_c") - 1))
    if buckets is None:
        biggest = v.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        buckets = max(16, -(-biggest // ROWS_PER_BUCKET))
    probs = [i / buckets for i in range(1, buckets)]
    bounds = v.groupBy("feature").agg(F.percentile_approx("value", probs, max(10_000, 4 * buckets)).alias("_b"))
    bounds = cut_lineage(bounds)

    # rank of the distinct values within a class
    vb = feature_buckets(v.withColumn("_one", F.lit(1)), "value", bounds, len(probs))
    ranked = running_totals(vb, [F.col("value")], ["_one"], F.col("_bkt"), by=["feature", "y"])
    ranked = cut_lineage(ranked.select("feature", "y", "value", "c", "n_c", "k_i", F.col("cum__one").alias("r")))

    # distance to the k_i-th nearest same-class neighbour; equal points come first, at distance 0
    offs = F.array(*[F.lit(j) for j in range(-k, k + 1) if j != 0])
    q = ranked.select("*", F.explode(offs).alias("_off")).withColumn("nr", F.col("r") + F.col("_off")).drop("_off", "r")
    nb = ranked.select("feature", "y", F.col("r").alias("nr"), F.col("value").alias("nv"), F.col("c").alias("nc"))
    near = F.when(F.col("nv").isNotNull(), F.struct(F.abs(F.col("nv") - F.col("value")).alias("d"), "nc"))
    dist = q.join(nb, ["feature", "y", "nr"], "left").groupBy("feature", "y", "value").agg(
        F.first("c").alias("c"), F.first("k_i").alias("k_i"), F.first("n_c").alias("n_c"),
        F.array_sort(F.collect_list(near)).alias("_near"))  # <= 2k entries
    start = F.struct((F.col("c") - 1).alias("seen"), F.lit(0.0).alias("d"))
    reached = F.aggregate("_near", start, lambda s, e: F.when(s["seen"] >= F.col("k_i"), s).otherwise(
        F.struct((s["seen"] + e["nc"]).alias("seen"), e["d"].alias("d"))))
    dist = cut_lineage(dist.select("feature", "y", "value", "c", "k_i", "n_c", reached["d"].alias("d")))

    # m_i: points in the open interval (x - d, x + d), or equal to x when d = 0
    zero = F.col("d") == 0
    data = v.select("feature", F.col("value").alias("qv"), F.lit(1).alias("typ"), "y", "value",
                    F.lit(0).alias("side"), F.col("c").alias("is_data"))
    none = F.lit(0).cast("long").alias("is_data")
    hi = dist.select("feature", (F.col("value") + F.col("d")).alias("qv"),
                     F.when(zero, F.lit(2)).otherwise(F.lit(0)).alias("typ"), "y", "value", F.lit(1).alias("side"), none)
    lo = dist.select("feature", (F.col("value") - F.col("d")).alias("qv"),
                     F.when(zero, F.lit(0)).otherwise(F.lit(2)).alias("typ"), "y", "value", F.lit(2).alias("side"), none)
    pts = feature_buckets(data.unionByName(hi).unionByName(lo), "qv", bounds, len(probs))
    counted = running_totals(pts, [F.col("qv"), F.col("typ"), F.col("y"), F.col("value"), F.col("side")], ["is_data"],
                             F.col("_bkt"), by=["feature"])
    m = counted.where(F.col("side") > 0).groupBy("feature", "y", "value").agg(
        (F.max(F.when(F.col("side") == 1, F.col("cum_is_data")))
         - F.max(F.when(F.col("side") == 2, F.col("cum_is_data")))).alias("m"))
    j = dist.join(m, ["feature", "y", "value"])

    def mean(x: str) -> Column:
        return F.sum(F.col("c") * digamma(F.col(x).cast("double"))) / F.sum("c")

    agg = j.groupBy("feature").agg(F.sum("c").alias("n"), mean("k_i").alias("pk"), mean("n_c").alias("pn"), mean("m").alias("pm"))
    mi = digamma(F.col("n").cast("double")) + F.col("pk") - F.col("pn") - F.col("pm")
    return agg.select("feature", F.greatest(mi, F.lit(0.0)).alias("mi"))
