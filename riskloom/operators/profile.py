"""Column profiling and pruning: leakage, missingness, variance, class contrasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.catalog import null_long, numeric_features, to_long

# Fixed values (thresholds of the profiling steps).
HARD_LEAK = 0.80          # |r| above: dropped
SOFT_LEAK = 0.25          # |r| above (and <= HARD_LEAK): flagged, kept
VARIANCE_MIN = 0.001      # population variance (nulls as 0) must exceed this
# Null-fraction histogram: right-closed bins and their labels.
MISSING_BINS = (
    ("0% (complete)", -0.001, 0.0),
    ("0-10%", 0.0, 0.10),
    ("10-50%", 0.10, 0.50),
    ("50-100%", 0.50, 0.9999),
    ("100% (empty)", 0.9999, 1.0001),
)


def class_profile(df: DataFrame, label: str = "y") -> DataFrame:
    """Rows, positives, negatives, negatives per positive, positive rate."""
    a = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(label) == 1).alias("n_pos"),
        F.count_if(F.col(label) == 0).alias("n_neg"),
    )
    return a.select(
        "n_rows", "n_pos", "n_neg",
        F.try_divide(F.col("n_neg"), F.col("n_pos")).alias("imbalance"),
        F.try_divide(F.col("n_pos"), F.col("n_rows")).alias("pos_rate"),
    )


def target_correlation(df: DataFrame, features: Sequence[str] | None = None, label: str = "y") -> DataFrame:
    """Pairwise-complete Pearson r of each numeric column with the label, and the
    leak class: 'hard' (|r| > 0.8, dropped), 'soft' (0.25 < |r| <= 0.8) or 'none'.
    Constant or empty columns give r NULL (no division error under ANSI)."""
    features = list(features or numeric_features(df, exclude=("account_id", label)))
    long = to_long(df, features, label=label).where(F.col("value").isNotNull())
    y = F.col(label).cast("double")
    stats = long.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"),
        F.covar_samp("value", y).alias("cov"),
        F.stddev_samp("value").alias("sx"),
        F.stddev_samp(y).alias("sy"),
    )
    r = F.try_divide(F.col("cov"), F.col("sx") * F.col("sy"))
    r = F.when((F.col("sx") == 0) | (F.col("sy") == 0), F.lit(None)).otherwise(r)
    out = stats.select("feature", "n", r.alias("r")).withColumn("abs_r", F.abs("r"))
    return out.withColumn(
        "leak_class",
        F.when(F.col("abs_r") > HARD_LEAK, "hard").when(F.col("abs_r") > SOFT_LEAK, "soft").otherwise("none"),
    )


def leak_crosstab(df: DataFrame, leaks: DataFrame, label: str = "y") -> DataFrame:
    """Value x label counts for each hard-leak column (``leaks``: feature)."""
    names = [r["feature"] for r in leaks.select("feature").collect()]  # bounded: columns
    if not names:
        return df.sparkSession.createDataFrame([], "feature string, value double, y int, n long")
    long = to_long(df, names, label=label)
    return long.groupBy("feature", "value", label).agg(F.count(F.lit(1)).alias("n"))


def missing_profile(df: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """Null fraction per column (all types); ``empty`` marks columns to drop."""
    features = list(features or [c for c in df.columns if c not in ("account_id", "y")])
    frac = null_long(df, features).groupBy("feature").agg(
        F.avg(F.col("is_null").cast("double")).alias("null_frac")
    )
    return frac.withColumn("empty", F.col("null_frac") == 1.0)


def missing_bins(profile: DataFrame) -> DataFrame:
    """Histogram of null fractions over right-closed bins; every bin listed."""
    spark = profile.sparkSession
    bins = spark.createDataFrame([(i, lab) for i, (lab, _, _) in enumerate(MISSING_BINS)], "bin int, label string")
    case = None
    for i, (_, lo, hi) in enumerate(MISSING_BINS):
        cond = (F.col("null_frac") > lo) & (F.col("null_frac") <= hi)
        case = F.when(cond, F.lit(i)) if case is None else case.when(cond, F.lit(i))
    counts = profile.groupBy(case.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return bins.join(counts, "bin", "left").select("bin", "label", F.coalesce("n", F.lit(0)).cast("long").alias("n_features"))


def low_variance(df: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """Population variance with nulls as 0; ``keep`` iff variance > 0.001."""
    features = list(features or numeric_features(df))
    long = to_long(df, features, label=None)
    v = long.groupBy("feature").agg(F.var_pop(F.coalesce("value", F.lit(0.0))).alias("variance"))
    return v.withColumn("keep", F.col("variance") > VARIANCE_MIN)


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop the named columns that are present, then check none is left."""
    present = [n for n in names if n in df.columns]
    out = df.drop(*present)
    assert not any(n in out.columns for n in names)
    return out


def strip_prefixed(df: DataFrame, prefixes: Sequence[str] = ("z_", "zflag_", "iforest_", "ae_")) -> DataFrame:
    """Drop full-data-derived families so they can be refitted inside folds."""
    return df.drop(*[c for c in df.columns if c.startswith(tuple(prefixes))])


def class_contrast(df: DataFrame, features: Sequence[str] | None = None, label: str = "y") -> DataFrame:
    """Mean for positives and negatives, ratio m1 / (m0 + 1e-9), bias-corrected skew."""
    features = list(features or numeric_features(df, exclude=("account_id", label)))
    long = to_long(df, features, label=label)
    a = long.groupBy("feature").agg(
        F.avg(F.when(F.col(label) == 1, F.col("value"))).alias("mean_pos"),
        F.avg(F.when(F.col(label) == 0, F.col("value"))).alias("mean_neg"),
        F.count("value").alias("n"),
        F.skewness("value").alias("g1"),
        F.var_pop("value").alias("m2"),
    )
    n = F.col("n")
    skew = F.when((n >= 3) & (F.col("m2") > 0), F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2))
    return a.select(
        "feature", "mean_pos", "mean_neg",
        (F.col("mean_pos") / (F.col("mean_neg") + F.lit(1e-9))).alias("ratio"),
        skew.alias("skew"),
    )


def binary_feature_rates(df: DataFrame, prefix: str, label: str = "y", min_ones: int = 10, top: int = 5) -> DataFrame:
    """Columns with the prefix, exactly two distinct values and more than ``min_ones``
    ones: positive rate among rows where the column is 1; top ``top`` by |rate|."""
    features = [f for f in numeric_features(df, exclude=("account_id", label)) if f.startswith(prefix)]
    long = to_long(df, features, label=label)
    a = long.groupBy("feature").agg(
        F.count_distinct("value").alias("n_distinct"),
        F.count_if(F.col("value") == 1).alias("n_ones"),
        F.avg(F.when(F.col("value") == 1, F.col(label).cast("double"))).alias("rate"),
    ).where((F.col("n_distinct") == 2) & (F.col("n_ones") > min_ones))
    w = Window.orderBy(F.abs("rate").desc(), F.col("feature"))
    return a.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top).select(
        "feature", "n_ones", "rate", "rank")


def quality_gate(df: DataFrame, named: Sequence[str] = (), label: str = "y") -> DataFrame:
    """``(check_name, violations)``: null cells, label outside {0,1}, rows without a
    label, string feature columns, named leak columns present. One aggregation."""
    from pyspark.sql import types as T

    feats = [c for c in df.columns if c not in ("account_id", label)]
    strings = sum(1 for f in df.schema.fields if f.name in feats and isinstance(f.dataType, T.StringType))
    nulls = None
    for c in feats:
        t = F.col(c).isNull().cast("long")
        nulls = t if nulls is None else nulls + t
    a = df.agg(
        F.sum(nulls if nulls is not None else F.lit(0)).cast("long").alias("no_nulls"),
        F.count_if(~F.col(label).isin(0, 1) | F.col(label).isNull()).alias("label_domain"),
        (F.count(F.lit(1)) - F.count(label)).alias("row_count"),
    )
    present = sum(1 for n in named if n in df.columns)
    checks = ["no_nulls", "label_domain", "row_count"]
    return a.select(F.explode(F.array(
        *[F.struct(F.lit(c).alias("check_name"), F.col(c).cast("long").alias("violations")) for c in checks],
        F.struct(F.lit("string_columns").alias("check_name"), F.lit(strings).cast("long").alias("violations")),
        F.struct(F.lit("named_leak_present").alias("check_name"), F.lit(present).cast("long").alias("violations")),
    )).alias("c")).select("c.check_name", "c.violations")
