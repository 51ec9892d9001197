"""Fitted statistics: fit on a subset (``fit_filter``), apply to any rows.

z-scores (also leave-one-fold-out), standardisation of a feature array,
percentile flags and binned mutual information."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.params import attach_params
from riskloom.functions.quantiles import exact_percentiles

# Z-score epsilon, clip and flag cut; recon-error flag percentile.
Z_EPS = 1e-9
Z_CLIP = 10.0
Z_FLAG = 3.0
RECON_PCT = 0.99


def z_expressions(targets: Sequence[str]) -> dict[str, Column]:
    """``z_<c>``, ``zflag_<c>`` of each target and their composite, over ``c``, ``_mu_<c>`` and ``_sd_<c>``."""
    out, flags = {}, []
    for c in targets:
        z = (F.col(c) - F.col(f"_mu_{c}")) / (F.col(f"_sd_{c}") + F.lit(Z_EPS))
        # greatest/least skip NULLs: keep an undefined z undefined instead of clipping it
        out[f"z_{c}"] = F.when(z.isNotNull(), F.least(F.greatest(z, F.lit(-Z_CLIP)), F.lit(Z_CLIP)))
        flags.append(F.coalesce((F.abs(z) > Z_FLAG).cast("int"), F.lit(0)))  # undefined z: not flagged
        out[f"zflag_{c}"] = flags[-1]
    if flags:
        comp = flags[0]
        for f in flags[1:]:
            comp = comp + f
        out["z_composite_score"] = comp
    return out


def _z_columns(targets: Sequence[str]) -> list[Column]:
    return [v.alias(k) for k, v in z_expressions(targets).items()]


def zscore_params(df: DataFrame, targets: Sequence[str], fit_filter: Column | None = None) -> DataFrame:
    """One row: mean and sample std of each target over the fitting rows."""
    fit = df if fit_filter is None else df.where(fit_filter)
    return fit.agg(*[x for c in targets for x in (F.avg(c).alias(f"_mu_{c}"), F.stddev_samp(c).alias(f"_sd_{c}"))])


def zscores(df: DataFrame, targets: Sequence[str], fit_filter: Column | None = None,
            keep: Sequence[str] = ("account_id",)) -> DataFrame:
    """``z_<c>`` = clip((x - mean) / (std + 1e-9), -10, 10), ``zflag_<c>`` = |z| > 3
    (unclipped), ``z_composite_score`` = number of flags."""
    targets = [t for t in targets if t in df.columns]
    j = attach_params(df, zscore_params(df, targets, fit_filter))
    return j.select(*keep, *_z_columns(targets))


def fold_zscores(df: DataFrame, targets: Sequence[str], folds: int = 5, fold_col: str = "fold",
                 keep: Sequence[str] = ("account_id",)) -> DataFrame:
    """Each row's z-scores with statistics fitted on the *other* folds only.

    Every row is replicated into the k-1 training sets it belongs to and the
    statistics are one grouped aggregation (k rows, stable moment merging);
    they are broadcast back and joined on the row's own fold."""
    targets = [t for t in targets if t in df.columns]
    train = df.select(
        F.explode(F.filter(F.sequence(F.lit(0), F.lit(folds - 1)), lambda i: i != F.col(fold_col))).alias("_held_out"),
        *targets)
    params = train.groupBy("_held_out").agg(
        *[x for c in targets for x in (F.avg(c).alias(f"_mu_{c}"), F.stddev_samp(c).alias(f"_sd_{c}"))])
    j = df.join(F.broadcast(params), df[fold_col] == params["_held_out"])  # k rows
    return j.select(*keep, fold_col, *_z_columns(targets))


def array_moments(df: DataFrame, col: str = "features", fit_filter: Column | None = None) -> DataFrame:
    """``(pos, mean, std_pop)`` of each array position over the fitting rows."""
    fit = df if fit_filter is None else df.where(fit_filter)
    long = fit.select(F.posexplode(col).alias("pos", "x"))
    return long.groupBy("pos").agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"))


def standardize(df: DataFrame, col: str = "features", fit_filter: Column | None = None,
                out: str = "features_std") -> DataFrame:
    """(x - mean) / std per position (population std; zero std -> 1). The moments
    table has one row per position (bounded by the array width); it is packed into
    one row of arrays and attached."""
    m = array_moments(df, col, fit_filter)
    packed = m.agg(F.array_sort(F.collect_list(F.struct("pos", "mean", "std"))).alias("_m"))
    j = attach_params(df, packed)
    z = F.transform(F.col(col), lambda x, i: (x - F.col("_m")[i]["mean"]) / F.when(
        F.col("_m")[i]["std"] == 0, F.lit(1.0)).otherwise(F.col("_m")[i]["std"]))
    return j.withColumn(out, z).drop("_m")


def percentile_flag(df: DataFrame, col: str, pct: float = RECON_PCT, out: str = "flag",
                    fit_filter: Column | None = None) -> DataFrame:
    """``out`` = value strictly above the exact linear percentile of the fitting rows."""
    fit = df if fit_filter is None else df.where(fit_filter)
    cut = exact_percentiles(fit, col, [pct], names=["_cut"])
    return attach_params(df, cut).withColumn(out, (F.col(col) > F.col("_cut")).cast("int")).drop("_cut")


def mi_binned(long: DataFrame, bins: int = 16, label: str = "y") -> DataFrame:
    """Mutual information (nats) of each feature with the label on equal-width bins
    between the feature's min and max (NULLs ignored). Fully partial-aggregated:
    per-feature min/max (feature rows, broadcast), then (feature, bin, y) counts."""
    v = long.where(F.col("value").isNotNull())
    rng = v.groupBy("feature").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    j = v.join(F.broadcast(rng), "feature")
    width = F.col("_hi") - F.col("_lo")
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("value") - F.col("_lo")) / width * bins), F.lit(bins - 1))).cast("int")
    cells = j.groupBy("feature", b.alias("bin"), F.col(label).alias("_y")).agg(F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window

    wf = Window.partitionBy("feature")
    cells = cells.select(
        "feature", "bin", "_y", "n",
        F.sum("n").over(wf).alias("_t"),
        F.sum("n").over(Window.partitionBy("feature", "bin")).alias("_nb"),
        F.sum("n").over(Window.partitionBy("feature", "_y")).alias("_ny"),
    )
    term = (F.col("n") / F.col("_t")) * F.log((F.col("n") * F.col("_t")) / (F.col("_nb") * F.col("_ny")))
    return cells.groupBy("feature").agg(F.sum(term).alias("mi"))
