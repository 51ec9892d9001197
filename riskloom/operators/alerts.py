"""Risk scores, tiers and tier statistics (input: ``scored(account_id, y, prob)``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.params import attach_params
from riskloom.functions.quantiles import exact_percentiles
from riskloom.functions.scoring import TIER_ORDER, calibrated_score, tier_col


def calibration_params(scored: DataFrame, prob: str = "prob") -> DataFrame:
    """One row ``(p1, p99)``: exact linear 1st / 99th percentiles of the probabilities."""
    return exact_percentiles(scored, prob, [0.01, 0.99], names=["p1", "p99"])


def risk_scores(scored: DataFrame, prob: str = "prob", params: DataFrame | None = None) -> DataFrame:
    """Adds ``risk_score`` (0..1000) and ``tier``.

    ``params`` is a one-row ``(p1, p99)`` table (fitted on training scores when new
    accounts are calibrated); by default it is fitted on ``scored`` itself. The
    one-row table is broadcast: its size is fixed.
    """
    params = calibration_params(scored, prob) if params is None else params
    out = attach_params(scored, params.select("p1", "p99"))
    out = out.withColumn("risk_score", calibrated_score(prob, F.col("p1"), F.col("p99")))
    return out.drop("p1", "p99").withColumn("tier", tier_col("risk_score"))


def tier_distribution(tiered: DataFrame) -> DataFrame:
    """Count, share of all rows and positives per tier; all four tiers are listed."""
    spark = tiered.sparkSession
    dim = spark.createDataFrame([(t, i) for i, t in enumerate(TIER_ORDER)], "tier string, tier_rank int")
    counts = tiered.groupBy("tier").agg(
        F.count(F.lit(1)).alias("n_accounts"), F.sum("y").cast("long").alias("n_positives")
    )
    return (
        dim.join(counts, "tier", "left")
        .withColumn("n_total", F.sum(F.coalesce("n_accounts", F.lit(0))).over(Window.partitionBy()))
        .select(
            "tier",
            "tier_rank",
            F.coalesce("n_accounts", F.lit(0)).cast("long").alias("n_accounts"),
            F.round(F.try_divide(F.coalesce("n_accounts", F.lit(0)) * 100.0, F.col("n_total")), 6).alias("pct_accounts"),
            F.coalesce("n_positives", F.lit(0)).cast("long").alias("n_positives"),
        )
    )


def positive_score_summary(tiered: DataFrame) -> DataFrame:
    """Min / max / mean / median score of the positives, count and share >= 500, >= 750."""
    pos = tiered.where(F.col("y") == 1)
    med = exact_percentiles(pos, "risk_score", [0.5], names=["median_score"])
    agg = pos.agg(
        F.count(F.lit(1)).alias("n_positives"),
        F.min("risk_score").alias("min_score"),
        F.max("risk_score").alias("max_score"),
        F.round(F.avg("risk_score"), 6).alias("mean_score"),
        F.count_if(F.col("risk_score") >= 500).alias("n_ge_500"),
        F.count_if(F.col("risk_score") >= 750).alias("n_ge_750"),
    )
    return attach_params(agg, med).select(
        "n_positives", "min_score", "max_score", "mean_score",
        F.round("median_score", 6).alias("median_score"),
        "n_ge_500",
        F.round(F.try_divide(F.col("n_ge_500") * 100.0, F.col("n_positives")), 6).alias("pct_ge_500"),
        "n_ge_750",
        F.round(F.try_divide(F.col("n_ge_750") * 100.0, F.col("n_positives")), 6).alias("pct_ge_750"),
    )
