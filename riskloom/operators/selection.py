"""Feature selection: top-N by a score plus must-keep families."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The reference keeps the top 300 by mutual information, plus every
# engineered family below and the key features; ratio_, plain z_/zflag_ and
# miss_flag_ columns must earn their rank.
TOP_N = 300
MUST_KEEP_PREFIXES = ("beh_", "iforest_", "ae_", "z_composite", "feat_", "meta_", "int_")


def must_keep(feature: Column, keys: Sequence[str]) -> Column:
    cond = feature.isin(list(keys)) if keys else F.lit(False)
    for p in MUST_KEEP_PREFIXES:
        cond = cond | feature.startswith(p)
    return cond


def sql_must_keep(col: str, keys: Sequence[str]) -> str:
    parts = [f"{col} IN ({', '.join(repr(k) for k in keys)})"] if keys else []
    parts += [f"starts_with({col}, '{p}')" for p in MUST_KEEP_PREFIXES]
    return "(" + " OR ".join(parts) + ")"


def select_features(scores: DataFrame, keys: Sequence[str], top_n: int = TOP_N, score: str = "mi") -> DataFrame:
    """``(feature, mi_rank, must_keep)`` for the kept features. Scores are compared
    at 9 decimals so that equal scores (up to summation noise) tie and are broken by
    name; one row per feature, so the ranking window runs on the catalog."""
    w = Window.orderBy(F.round(F.col(score), 9).desc(), F.col("feature"))
    r = scores.select("feature", F.col(score).alias("_s"), F.row_number().over(w).alias("mi_rank"),
                      must_keep(F.col("feature"), keys).alias("must_keep"))
    # threshold = score of the top_n-th feature (0 when there are fewer features)
    thr = F.coalesce(F.max(F.when(F.col("mi_rank") == top_n, F.col("_s"))).over(Window.partitionBy()), F.lit(0.0))
    r = r.withColumn("mi_threshold", F.round(thr, 6))
    return r.where((F.col("mi_rank") <= top_n) | F.col("must_keep")).drop("_s")
