"""Stratified k-fold assignment and class weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.cumulative import hash_bucket, running_totals


def seeded_hash(id_col: str, seed: int = 42) -> Column:
    """md5 of ``seed|id``: a portable pseudo-random order (same in Spark and DuckDB)."""
    return F.md5(F.concat(F.lit(str(seed)), F.lit("|"), F.col(id_col).cast("string")))


def stratified_folds(df: DataFrame, k: int = 5, seed: int = 42, id_col: str = "account_id",
                     label: str = "y") -> DataFrame:
    """Adds ``fold`` in 0..k-1: rows of each class are ranked in seeded-hash order and
    dealt round-robin, so every fold holds n_class/k rows of each class (within one).
    The rank is a running count over range-partitioned rows, not a one-task window."""
    h = df.withColumn("_h", seeded_hash(id_col, seed)).withColumn("_one", F.lit(1))
    ranked = running_totals(h, [F.col("_h"), F.col(id_col)], ["_one"], hash_bucket("_h"), by=[label])
    return ranked.withColumn("fold", ((F.col("cum__one") - 1) % k).cast("int")).drop("_h", "_one", "cum__one")


def class_weights(df: DataFrame, label: str = "y", mode: str = "ratio") -> DataFrame:
    """Adds ``w``: positives weighted n_neg / n_pos ("ratio") or n / (2 n_class)
    ("balanced"); negatives 1 (ratio) or n / (2 n_neg) (balanced)."""
    from riskloom.functions.params import attach_params

    counts = df.agg(F.count_if(F.col(label) == 1).alias("_np"), F.count_if(F.col(label) != 1).alias("_nn"))
    j = attach_params(df, counts)
    if mode == "ratio":
        w = F.when(F.col(label) == 1, F.col("_nn") / F.col("_np")).otherwise(F.lit(1.0))
    else:
        n = F.col("_np") + F.col("_nn")
        w = F.when(F.col(label) == 1, n / (2.0 * F.col("_np"))).otherwise(n / (2.0 * F.col("_nn")))
    return j.withColumn("w", w).drop("_np", "_nn")
