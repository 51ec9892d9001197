"""Dates, encodings, missing flags, row meta, imputation, row moments,
interactions, quality gate (O-16, O-18, O-20..O-33, O-80)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions.dates import parse_open_date
from riskloom.functions.scoring import round6
from riskloom.operators import encode, features, profile
from riskloom.plans import accounts as A
from riskloom.plans.registry import query
from riskloom.sources.fixtures import with_views


def _v(body, *extra):
    return with_views(body, "acct_raw", extra=tuple(extra))


def _chain(body, *extra):
    return with_views(body, "acct_raw", extra=A.CHAIN + tuple(extra))


def _r6(df, keep=("account_id", "y")):
    return df.select(*[F.col(c) if c in keep else round6(c).alias(c) for c in df.columns])


def _sql_r6(cols, src):
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols) + f" FROM {src}"


@query("parse_open_date", _v(f"SELECT account_id, {A.SQL_DATE} AS opened FROM acct_raw"))
def q_parse_open_date(spark, sf_dir):
    r = A.raw(spark, sf_dir)
    return r.select("account_id", parse_open_date("s_opened", A.REF_DATE).alias("opened"))


@query("temporal_features", _v(
    f"SELECT account_id, {A.sql_temporal('d')} FROM (SELECT account_id, {A.SQL_DATE} AS d FROM acct_raw)"))
def q_temporal_features(spark, sf_dir):
    r = A.raw(spark, sf_dir).select("account_id", "s_opened")
    return features.add_temporal(r, "s_opened", A.REF_DATE)


@query("age_bucket_positives", _v(
    f"""SELECT feat_account_age_bucket AS age_bucket, count(*) AS n FROM
        (SELECT y, {A.sql_temporal('d')} FROM (SELECT y, {A.SQL_DATE} AS d FROM acct_raw)) WHERE y = 1
        GROUP BY 1"""))
def q_age_bucket_positives(spark, sf_dir):
    r = features.add_temporal(A.raw(spark, sf_dir).select("account_id", "y", "s_opened"), "s_opened", A.REF_DATE)
    return r.where("y = 1").groupBy(F.col("feat_account_age_bucket").alias("age_bucket")).agg(
        F.count(F.lit(1)).alias("n")).orderBy("age_bucket")


STRING_COLS = ("s_segment", "s_nation", "s_name")


@query("encode_plan", _v(
    """SELECT feature, n_distinct, CASE WHEN feature = 's_segment' THEN 'manual'
                                        WHEN n_distinct <= 50 THEN 'ordinal' ELSE 'frequency' END AS encoding FROM ("""
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS n_distinct FROM acct_raw" for c in STRING_COLS)
    + ")"))
def q_encode_plan(spark, sf_dir):
    return encode.encode_plan(A.raw(spark, sf_dir), A.MANUAL, STRING_COLS)


@query("encode_manual", _v(f"SELECT account_id, {A.SQL_SEGMENT} AS s_segment FROM acct_raw"))
def q_encode_manual(spark, sf_dir):
    r = A.raw(spark, sf_dir)
    return r.select("account_id", encode.manual_code("s_segment", A.SEGMENT_MAP).alias("s_segment"))


@query("encode_ordinal", _v(
    """SELECT a.account_id, coalesce(nc.code, -1.0) AS s_nation FROM acct_raw a
       LEFT JOIN nation_codes nc ON coalesce(CAST(a.s_nation AS VARCHAR), 'nan') = nc.category""",
    ("nation_codes", A.SQL_NATION_CODES)))
def q_encode_ordinal(spark, sf_dir):
    r = A.raw(spark, sf_dir).select("account_id", "s_nation")
    plan = [{"feature": "s_nation", "encoding": "ordinal", "n_distinct": 25}]
    return encode.apply_encodings(r, plan, {}).select("account_id", "s_nation")


@query("encode_frequency", _v(
    """SELECT a.account_id, round(coalesce(ns.share, 0.0), 6) AS s_name FROM acct_raw a
       LEFT JOIN name_share ns ON a.s_name = ns.category""", ("name_share", A.SQL_NAME_SHARE)))
def q_encode_frequency(spark, sf_dir):
    r = A.raw(spark, sf_dir).select("account_id", "s_name")
    nd = r.agg(F.count_distinct("s_name")).first()[0]
    plan = [{"feature": "s_name", "encoding": "frequency", "n_distinct": nd}]
    return encode.apply_encodings(r, plan, {}).select("account_id", round6("s_name").alias("s_name"))


_FLAG_COLS = tuple(f"miss_flag_{c}" for c in A.FLAGGED)


@query("miss_flags", _v(
    "SELECT account_id, " + ", ".join(f"CAST({c} IS NULL AS DOUBLE) AS miss_flag_{c}" for c in A.FLAGGED)
    + " FROM acct_raw"))
def q_miss_flags(spark, sf_dir):
    r = A.raw(spark, sf_dir)
    feats = [c for c in r.columns if c not in ("account_id", "y")]
    mp = {x["feature"]: x["null_frac"] for x in profile.missing_profile(r, feats).collect()}
    flags = features.miss_flag_columns(mp, feats)
    return r.select("account_id", *[F.col(c).isNull().cast("double").alias(f"miss_flag_{c}") for c in flags])


@query("row_meta", _chain("SELECT account_id, " + _sql_r6(A.META, "meta")))
def q_row_meta(spark, sf_dir):
    df, log = _pre_impute(spark, sf_dir)
    return _r6(df.select("account_id", *A.META))


def _pre_impute(spark, sf_dir):
    """The chain up to (not including) imputation."""
    raw = A.raw(spark, sf_dir).drop("f_leak", "f_empty", "f_const")
    df = features.add_temporal(raw, A.DATE_COL, A.REF_DATE)
    plan = encode.encode_plan(df, A.MANUAL, STRING_COLS).collect()
    df = encode.apply_encodings(df, sorted(plan, key=lambda r: df.columns.index(r["feature"])), A.MANUAL)
    cols = [c for c in df.columns if c not in ("account_id", "y")]
    meta = features.row_meta_columns(cols)
    df = df.select(*df.columns, *[v.alias(k) for k, v in meta.items()],
                   *[F.col(c).isNull().cast("double").alias(f"miss_flag_{c}") for c in A.FLAGGED])
    return df, None


@query("impute_median", _chain("SELECT feature, round(median, 6) AS median FROM medians"))
def q_impute_median(spark, sf_dir):
    df, _ = _pre_impute(spark, sf_dir)
    cols = [c for c in df.columns if c not in ("account_id", "y")]
    return features.medians(df, cols).select("feature", round6("median").alias("median"))


@query("clean_accounts", _chain("SELECT account_id, y, " + _sql_r6(A.PRE_IMPUTE_COLS, "clean")))
def q_clean_accounts(spark, sf_dir):
    return _r6(A.clean(spark, sf_dir))


ROW_COLS = A.CLEAN_BASE
_ROW_STATS = ("beh_row_mean", "beh_row_std", "beh_row_skew", "beh_row_kurt", "beh_row_max", "beh_row_min",
              "beh_row_range", "beh_row_q75_q25")
_N = float(len(ROW_COLS))
SQL_ROW_STATS = f"""SELECT account_id, m AS beh_row_mean, sqrt(s2 / ({_N} - 1)) AS beh_row_std,
   CASE WHEN s2 = 0 THEN 0.0 ELSE {_N * (_N - 1) ** 0.5 / (_N - 2)!r} * s3 / pow(s2, 1.5) END AS beh_row_skew,
   CASE WHEN s2 = 0 THEN 0.0 ELSE {_N * (_N + 1) * (_N - 1)!r} * s4 / ({(_N - 2) * (_N - 3)!r} * s2 * s2)
        - {3 * (_N - 1) ** 2 / ((_N - 2) * (_N - 3))!r} END AS beh_row_kurt,
   mx AS beh_row_max, mn AS beh_row_min, mx - mn AS beh_row_range, q75 - q25 AS beh_row_q75_q25
FROM (SELECT l.account_id, any_value(a.m) AS m, sum(pow(l.value - a.m, 2)) AS s2, sum(pow(l.value - a.m, 3)) AS s3,
             sum(pow(l.value - a.m, 4)) AS s4, max(l.value) AS mx, min(l.value) AS mn,
             quantile_cont(l.value, 0.75) AS q75, quantile_cont(l.value, 0.25) AS q25
      FROM ({A.sql_long('clean', ROW_COLS, with_y=False)}) l
      JOIN (SELECT account_id, avg(value) AS m FROM ({A.sql_long('clean', ROW_COLS, with_y=False)}) GROUP BY account_id) a
        ON l.account_id = a.account_id
      GROUP BY l.account_id)"""


@query("row_stats", _chain("SELECT account_id, " + _sql_r6(_ROW_STATS, "rs"), ("rs", SQL_ROW_STATS)))
def q_row_stats(spark, sf_dir):
    df = features.add_row_stats(A.clean(spark, sf_dir))
    return _r6(df.select("account_id", *_ROW_STATS))


def _inter_sql():
    keys = list(A.KEYS)
    parts = []
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            parts.append(f"{a} * {b} AS int_{a}x{b}")
    for a, b in A.RATIOS:
        parts.append(f"{a} / ({b} + 1e-9) AS ratio_{a}_{b}")
    for k in A.AGE_KEYS:
        parts.append(f"feat_account_age_days * {k} AS int_age_{k}")
    names = [p.split(" AS ")[1] for p in parts]
    return "SELECT account_id, " + ", ".join(parts) + " FROM clean", names


_INTER_SQL, _INTER_NAMES = _inter_sql()


# Products and ratios of identical inputs are bit-identical in both engines: no rounding.
@query("interactions", _chain("SELECT account_id, " + ", ".join(_INTER_NAMES) + " FROM inter", ("inter", _INTER_SQL)))
def q_interactions(spark, sf_dir):
    c = A.clean(spark, sf_dir)
    cols = features.interaction_columns(c, A.KEYS, A.RATIOS, age_keys=A.AGE_KEYS)
    return c.select("account_id", *[v.alias(k) for k, v in cols.items()])


@query("quality_gate", _chain(
    """SELECT * FROM (VALUES ('no_nulls', (SELECT CAST(sum(""" + " + ".join(
        f"CAST({c} IS NULL AS INTEGER)" for c in A.PRE_IMPUTE_COLS) + """) AS BIGINT) FROM clean)),
        ('label_domain', (SELECT CAST(count_if(y NOT IN (0, 1) OR y IS NULL) AS BIGINT) FROM clean)),
        ('row_count', (SELECT abs(count(*) - count(y)) FROM clean)),
        ('string_columns', CAST(0 AS BIGINT)),
        ('named_leak_present', CAST(0 AS BIGINT))) t(check_name, violations)"""))
def q_quality_gate(spark, sf_dir):
    return profile.quality_gate(A.clean(spark, sf_dir), named=A.NAMED_LEAKS)
