"""Row-level features: missing flags, row meta, median imputation, row moments,
interactions. Row operators work on arrays of the row's values (no shuffle)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.dates import parse_open_date, temporal_columns
from riskloom.functions.quantiles import exact_percentiles
from riskloom.operators import encode, profile
from riskloom.operators.catalog import numeric_features, to_long
from riskloom.operators.steps import StepLog

# Missing-flag band and cap, high-missing cut, derived-family
# prefixes excluded from row moments, ratio epsilon.
MISS_FLAG_MIN = 0.10
MISS_FLAG_CAP = 300
HIGH_MISSING = 0.5
ROW_STAT_EXCLUDE = ("meta_", "miss_flag_", "feat_")
EPS = 1e-9


def add_temporal(df: DataFrame, date_col: str, ref_date: _dt.date) -> DataFrame:
    """Six temporal features from a month-day-year text column, which is dropped."""
    d = parse_open_date(date_col, ref_date)
    cols = temporal_columns(d, ref_date)
    return df.select(*[c for c in df.columns if c != date_col], *[v.alias(k) for k, v in cols.items()])


def miss_flag_columns(null_fracs: Mapping[str, float], present: Sequence[str], cap: int | None = MISS_FLAG_CAP) -> list[str]:
    """Columns (in column order) with 0.10 < null fraction < 1: the first ``cap`` of them
    (None: all). The cap is the data model's own limit on flag columns."""
    keep = [c for c in present if c in null_fracs and MISS_FLAG_MIN < null_fracs[c] < 1.0]
    return keep[:cap]


def row_meta_columns(columns: Sequence[str]) -> dict[str, Column]:
    """Missing / zero / negative / nonzero counts and ratios over the listed columns.
    A missing cell counts as nonzero (NaN != 0 is true in the reference)."""
    arr = F.array(*[F.col(c).cast("double") for c in columns])
    total = float(len(columns))
    miss = F.size(F.filter(arr, lambda x: x.isNull()))
    zero = F.size(F.filter(arr, lambda x: x == 0))
    return {
        "meta_missing_count": miss.cast("double"),
        "meta_missing_ratio": (miss / F.lit(total)),
        "meta_zero_count": zero.cast("double"),
        "meta_zero_ratio": (zero / F.lit(total)),
        "meta_negative_count": F.size(F.filter(arr, lambda x: x < 0)).cast("double"),
        "meta_nonzero_count": F.size(F.filter(arr, lambda x: F.coalesce(x != 0, F.lit(True)))).cast("double"),
        "meta_is_high_missing": ((miss / F.lit(total)) > HIGH_MISSING).cast("double"),
    }


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, median)``: exact per-column medians over the long form."""
    long = to_long(df, columns, label=None)
    return exact_percentiles(long, "value", [0.5], by=["feature"], names=["median"])


def impute(df: DataFrame, med: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill NULLs with the fitted medians (one value per column, a bounded table)."""
    m = {r["feature"]: r["median"] for r in med.collect()}
    return df.select(*[
        F.coalesce(F.col(c), F.lit(m.get(c))).alias(c) if c in columns else F.col(c) for c in df.columns
    ])


def row_stat_columns(columns: Sequence[str]) -> dict[str, Column]:
    """Mean, std (ddof 1), bias-corrected skew and excess kurtosis, max, min, range
    and linear IQR of the row's values."""
    arr = F.array(*[F.col(c).cast("double") for c in columns])
    n = F.lit(float(len(columns)))
    mean = F.aggregate(arr, F.lit(0.0), lambda a, x: a + x) / n

    nn = float(len(columns))
    zero = F.struct(*[F.lit(0.0).alias(k) for k in ("s2", "s3", "s4")])
    # the mean is bound once per row, so the three power sums are one pass over the row's values
    sums = F.transform(F.array(mean), lambda m: F.aggregate(arr, zero, lambda a, x: F.struct(
        *[(a[f"s{k}"] + F.pow(x - m, F.lit(float(k)))).alias(f"s{k}") for k in (2, 3, 4)])))

    def from_sums(make) -> Column:
        return F.transform(sums, lambda s: make(s["s2"], s["s3"], s["s4"]))[0]

    std = from_sums(lambda s2, s3, s4: F.sqrt(s2 / (n - 1)))
    skew = from_sums(lambda s2, s3, s4: F.when(F.lit(nn) < 3, F.lit(None)).when(s2 == 0, F.lit(0.0)).otherwise(
        F.lit(nn * (nn - 1) ** 0.5 / (nn - 2) if nn > 2 else 0.0) * s3 / F.pow(s2, 1.5)))
    kurt = from_sums(lambda s2, s3, s4: F.when(F.lit(nn) < 4, F.lit(None)).when(s2 == 0, F.lit(0.0)).otherwise(
        F.lit(nn * (nn + 1) * (nn - 1)) * s4 / (F.lit((nn - 2) * (nn - 3) if nn > 3 else 1.0) * s2 * s2)
        - F.lit(3 * (nn - 1) ** 2 / ((nn - 2) * (nn - 3)) if nn > 3 else 0.0)))
    srt = F.array_sort(arr)

    def q(p):
        pos = p * (nn - 1)
        lo, hi = int(pos // 1), int(-(-pos // 1))
        a, b = F.element_at(srt, lo + 1), F.element_at(srt, hi + 1)
        return a + F.lit(pos - lo) * (b - a)

    mx, mn = F.array_max(arr), F.array_min(arr)
    return {
        "beh_row_mean": mean,
        "beh_row_std": std,
        "beh_row_skew": skew,
        "beh_row_kurt": kurt,
        "beh_row_max": mx,
        "beh_row_min": mn,
        "beh_row_range": mx - mn,
        "beh_row_q75_q25": q(0.75) - q(0.25),
    }


def add_row_stats(df: DataFrame, exclude: Sequence[str] = ("account_id", "y")) -> DataFrame:
    cols = [c for c in numeric_features(df, exclude) if not c.startswith(ROW_STAT_EXCLUDE)]
    return df.select("*", *[v.alias(k) for k, v in row_stat_columns(cols).items()])


def interaction_columns(df: DataFrame, keys: Sequence[str], ratios: Sequence[tuple[str, str]],
                        age_col: str = "feat_account_age_days", age_keys: Sequence[str] = ()) -> dict[str, Column]:
    """Pairwise products of present key features, a / (b + 1e-9) ratios and age
    products (only for columns that are present)."""
    present = [k for k in keys if k in df.columns]
    out: dict[str, Column] = {}
    for i, a in enumerate(present):
        for b in present[i + 1:]:
            out[f"int_{a}x{b}"] = F.col(a) * F.col(b)
    for a, b in ratios:
        if a in df.columns and b in df.columns:
            out[f"ratio_{a}_{b}"] = F.try_divide(F.col(a), F.col(b) + F.lit(EPS))
    if age_col in df.columns:
        for k in age_keys:
            if k in df.columns:
                out[f"int_age_{k}"] = F.col(age_col) * F.col(k)
    return out


def clean_accounts(raw: DataFrame, date_col: str | None, ref_date: _dt.date,
                   manual: Mapping[str, Mapping[str, int]], label: str = "y", steps: StepLog | None = None) -> tuple[DataFrame, dict]:
    """Phase-one chain: drop hard leaks, empty and low-variance columns; temporal
    features; encodings; missing flags and row meta; median imputation.

    Column decisions need small per-feature statistics (collected, one row per
    column); the data itself stays distributed. Returns the clean table and a
    log of decisions; ``steps`` records what each step did and took."""
    steps = StepLog(("account_id", label)) if steps is None else steps
    log: dict = {"n_rows": None}
    raw = steps.written("load", raw)  # several small statistics passes read it: materialise once
    feats = [c for c in raw.columns if c not in ("account_id", label)]
    corr = profile.target_correlation(raw, label=label)
    leaks = [r["feature"] for r in corr.where("leak_class = 'hard'").select("feature").collect()]
    df = steps.columns("leakage", raw.drop(*leaks))
    log["leak_dropped"] = sorted(leaks)
    feats = [c for c in feats if c not in leaks]
    mp = {r["feature"]: r["null_frac"] for r in profile.missing_profile(df, feats).collect()}
    empty = [c for c in feats if mp.get(c) == 1.0]
    df = steps.columns("empty", df.drop(*empty))
    log["empty_dropped"] = empty
    feats = [c for c in feats if c not in empty]
    num = [c for c in feats if c in numeric_features(df, exclude=("account_id", label))]
    lv = [r["feature"] for r in profile.low_variance(df, num).where("NOT keep").collect()] if num else []
    df = steps.columns("low_variance", df.drop(*lv))
    log["low_variance_dropped"] = [c for c in num if c in lv]
    if date_col and date_col in df.columns:
        df = steps.columns("temporal", add_temporal(df, date_col, ref_date))
    plan = encode.encode_plan(df, {k: v for k, v in manual.items() if k in df.columns}).collect()
    plan = sorted(plan, key=lambda r: df.columns.index(r["feature"]))
    df = steps.columns("encode", encode.apply_encodings(df, plan, manual))
    log["encoded"] = [(r["feature"], r["encoding"]) for r in plan]
    candidates = [c for c in df.columns if c not in ("account_id", label)]
    flags = miss_flag_columns(mp, candidates)
    log["miss_flags_left_out"] = miss_flag_columns(mp, candidates, cap=None)[len(flags):]
    num_now = [c for c in df.columns if c not in ("account_id", label)]
    meta = row_meta_columns(num_now)
    df = df.select(*df.columns, *[v.alias(k) for k, v in meta.items()],
                   *[F.col(c).isNull().cast("double").alias(f"miss_flag_{c}") for c in flags])
    log["miss_flags"] = flags
    df = steps.written("flags_and_meta", df)  # medians and imputation both read the encoded table
    cols = [c for c in df.columns if c not in ("account_id", label)]
    med = medians(df, cols)
    df = steps.last("impute", impute(df, med, cols))
    log["features"] = cols
    return df, log
