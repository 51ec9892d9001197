"""Read-side queries of the alert queue: filters, top-k, ranks, lookups, samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.cumulative import hash_bucket, quantile_bucket, running_totals
from riskloom.functions.scoring import FLAG_PROBABILITY, TIER_ORDER
from riskloom.operators.folds import seeded_hash

QUEUE_LIMIT = 200
HIST_BINS = 50
SAMPLE_ROWS = 3000


def alert_queue(tiered: DataFrame, tiers: Sequence[str], lo: int, hi: int, label: int | None = None,
                limit: int | None = QUEUE_LIMIT) -> DataFrame:
    """Tier IN, lo <= score <= hi, optional label; score descending (id breaks ties);
    five display columns; ``limit`` rows (None: all rows, for the CSV export)."""
    f = tiered.where(F.col("tier").isin(list(tiers)) & F.col("risk_score").between(lo, hi))
    if label is not None:
        f = f.where(F.col("y") == label)
    out = f.select(F.col("account_id").alias("account"), "risk_score", "tier", F.col("prob").alias("fraud_prob"),
                   F.col("y").alias("label"))
    out = out.orderBy(F.col("risk_score").desc(), F.col("account"))
    return out.limit(limit) if limit is not None else out


def kpi_row(tiered: DataFrame, conf: DataFrame) -> DataFrame:
    """Accounts per alerting tier plus true positives and precision at the threshold."""
    from riskloom.functions.params import attach_params

    c = tiered.agg(*[F.count_if(F.col("tier") == t).alias(n) for t, n in
                     (("AUTO-FREEZE", "n_freeze"), ("INVESTIGATOR", "n_investigate"), ("WATCHLIST", "n_watch"))])
    k = conf.select("tp", F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0)).alias("precision"))
    return attach_params(c, k)


def score_histogram(tiered: DataFrame, bins: int = HIST_BINS) -> DataFrame:
    """Fixed-width bins over 0..1000 (score 1000 falls in the last bin) x tier."""
    b = F.least(F.width_bucket(F.col("risk_score").cast("double"), F.lit(0.0), F.lit(1000.0), F.lit(bins)), F.lit(bins))
    return tiered.groupBy(b.cast("int").alias("bin"), "tier").agg(F.count(F.lit(1)).alias("n"))


def tier_breakdown(tiered: DataFrame) -> DataFrame:
    """Accounts per tier in the fixed tier order; absent tiers listed with 0."""
    spark = tiered.sparkSession
    dim = spark.createDataFrame([(t, i) for i, t in enumerate(TIER_ORDER)], "tier string, tier_rank int")
    c = tiered.groupBy("tier").agg(F.count(F.lit(1)).alias("n"))
    return dim.join(c, "tier", "left").select("tier", "tier_rank", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def rank_by_score(df: DataFrame, score: str = "risk_score", seed: int = 42,
                  rows_per_bucket: int | None = None) -> DataFrame:
    """Adds ``rank`` (1 = highest integer score; equal scores ordered by a seeded hash
    of the id). The running count is bucketed on one numeric key that follows the
    full order, (-score) * 4096 + hash prefix, so a score value held by a third of
    the rows is still spread over many buckets and tasks."""
    h = df.withColumn("_h", seeded_hash("account_id", seed)).withColumn("_one", F.lit(1))
    h = h.withColumn("_k", (-F.col(score).cast("long") * 4096 + hash_bucket("_h")).cast("double"))
    bucket = quantile_bucket(h, "_k", rows_per_bucket=rows_per_bucket) if rows_per_bucket else quantile_bucket(h, "_k")
    r = running_totals(h, [F.col(score).desc(), F.col("_h")], ["_one"], bucket).drop("_k")
    return r.withColumn("rank", F.col("cum__one")).drop("_h", "_one", "cum__one")


def positives_ranked(tiered: DataFrame) -> DataFrame:
    return rank_by_score(tiered.where(F.col("y") == 1))


def nth_riskiest_positive(tiered: DataFrame, n: int) -> DataFrame:
    return positives_ranked(tiered).where(F.col("rank") == n)


def account_lookup(tiered: DataFrame, account_ids: DataFrame) -> DataFrame:
    """Rows of the given accounts with the model decision (prob > 0.3 -> FLAG)."""
    j = tiered.join(account_ids.select("account_id").distinct(), "account_id")  # broadcast only if it is small
    return j.select("account_id", "risk_score", "prob", "tier", "y",
                    F.when(F.col("prob") > FLAG_PROBABILITY, "FLAG").otherwise("PASS").alias("decision"))


def confusion_matrix(conf: DataFrame) -> DataFrame:
    """``(predicted, actual, n)`` cells from confusion counts."""
    cells = [("positive", "positive", "tp"), ("positive", "negative", "fp"),
             ("negative", "positive", "fn"), ("negative", "negative", "tn")]
    return conf.select(F.explode(F.array(*[
        F.struct(F.lit(p).alias("predicted"), F.lit(a).alias("actual"), F.col(c).cast("long").alias("n"))
        for p, a, c in cells])).alias("c")).select("c.*")


def seeded_sample(df: DataFrame, n: int = SAMPLE_ROWS, seed: int = 42) -> DataFrame:
    """Portable sample of at most ``n`` rows: smallest seeded hashes (top-k)."""
    return df.withColumn("_h", seeded_hash("account_id", seed)).orderBy("_h").limit(n).drop("_h")


def tier_exemplar(tiered: DataFrame) -> DataFrame:
    """Highest-scoring account per tier (lowest id on ties); empty tiers give no row.
    One grouped aggregation: max_by on (score, -id)."""
    key = F.struct(F.col("risk_score"), (-F.col("account_id")).alias("nid"))
    return tiered.groupBy("tier").agg(F.max_by("account_id", key).alias("account_id"),
                                      F.max("risk_score").alias("risk_score"))
