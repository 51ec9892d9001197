"""Requests with recomputed derived columns (O-96): whole training rows as requests, and sparse ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions.scoring import round6
from riskloom.operators import derive
from riskloom.plans import accounts as A
from riskloom.plans.fitted import _zcols, SQL_ZP, SQL_ZT, Z_TARGETS, behaviour_table
from riskloom.plans.registry import query
from riskloom.plans.rowfeatures import _INTER_NAMES, _INTER_SQL, _ROW_STATS, SQL_ROW_STATS
from riskloom.sources.artifacts import materialized_all
from riskloom.sources.fixtures import with_views

ENCODINGS = {"s_segment": "manual", "s_nation": "ordinal", "s_name": "frequency"}
Z_NAMES = tuple(n for c in Z_TARGETS for n in (f"z_{c}", f"zflag_{c}")) + ("z_composite_score",)
NAMES = A.PRE_IMPUTE_COLS + _ROW_STATS + tuple(_INTER_NAMES) + Z_NAMES


def derivation(spark, sf_dir) -> derive.Derivation:
    """The fitted derivation of the account fixture; its tables are artifacts."""
    params = dict(columns=A.CLEAN_BASE, encodings=ENCODINGS, manual=A.MANUAL, date_col=A.DATE_COL, ref_date=A.REF_DATE, flags=A.FLAGGED,
                  keys=A.KEYS, ratios=A.RATIOS, age_keys=A.AGE_KEYS, z_targets=Z_TARGETS)

    def build():
        d = derive.fit(A.raw(spark, sf_dir), behaviour_table(spark, sf_dir), **params)
        return d.codes, d.shares, d.medians, d.zparams

    names = ("codes", "shares", "medians", "zparams")
    tables = materialized_all(spark, tuple(f"derive_{n}" for n in names), sf_dir, build)
    return derive.Derivation(**params, **dict(zip(names, tables)))


def whole_rows(spark, sf_dir):
    """One request per account that supplies its whole raw row, missing cells as NULL values."""
    r = A.raw(spark, sf_dir)
    given = F.map_from_entries(F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value")) for c in A.NUMERIC + A.STRINGS]))
    return r.select(F.concat(F.lit("ACC-"), F.col("account_id").cast("string")).alias("account_id"), given.alias("features"))


def _round(c: str):
    return F.col(c) if c in _INTER_NAMES else round6(c)


def _chain(body, *extra):
    return with_views(body, "acct_raw", extra=A.CHAIN + (("rs", SQL_ROW_STATS), ("zt", SQL_ZT), ("zp", SQL_ZP), ("inter", _INTER_SQL)) + tuple(extra))


_SQL_Z = f"SELECT account_id AS zid, {_zcols()} FROM zt, zp p"


@query("derive_whole_rows", _chain(
    "SELECT 'ACC-' || CAST(zt.account_id AS VARCHAR) AS account_id, "
    + ", ".join(f"round(zt.{c}, 6) AS {c}" for c in A.PRE_IMPUTE_COLS + _ROW_STATS) + ", "
    + ", ".join(f"inter.{c}" for c in _INTER_NAMES) + ", " + ", ".join(f"CAST(zz.{c} AS DOUBLE) AS {c}" for c in Z_NAMES)
    + ", CAST(NULL AS VARCHAR) AS parse_error FROM zt JOIN inter ON zt.account_id = inter.account_id JOIN zz ON zt.account_id = zz.zid",
    ("zz", _SQL_Z)))
def q_derive_whole_rows(spark, sf_dir):
    """A request that supplies a whole training row gets that row's clean and derived columns."""
    v = derive.recompute(whole_rows(spark, sf_dir), derivation(spark, sf_dir), NAMES)
    return v.select("account_id", *[_round(c).alias(c) for c in NAMES], "parse_error")


SPARSE = ("f_spend", "f_max", "f_bal", "feat_account_age_days", "meta_missing_count", "miss_flag_f_bal", "int_f_spendxf_max", "int_f_balxf_max",
          "int_f_ordersxf_urgent", "ratio_f_max_f_bal", "int_age_f_spend", "z_f_spend", "z_f_orders", "z_f_bal")


def sparse_requests(spark, sf_dir):
    """Spend and largest order where known; the opening date of every third account, a missing balance of every
    seventh, a supplied ratio of every eleventh."""
    i = F.col("account_id")
    some = {"f_spend": F.col("f_spend").cast("string"), "f_max": F.col("f_max").cast("string"),
            "s_opened": F.when(i % 3 == 0, F.col("s_opened")), "ratio_f_max_f_bal": F.when(i % 11 == 0, F.lit("2.5"))}
    held = F.filter(F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in some.items()]), lambda e: e["value"].isNotNull())
    gone = F.when(i % 7 == 0, F.array(F.struct(F.lit("f_bal").alias("key"), F.lit(None).cast("string").alias("value")))).otherwise(
        F.array().cast("array<struct<key:string,value:string>>"))
    return A.raw(spark, sf_dir).select(F.concat(F.lit("ACC-"), i.cast("string")).alias("account_id"), F.map_from_entries(F.concat(held, gone)).alias("features"))


def _sql_median(src, c):
    return f"(SELECT quantile_cont({c}, 0.5) FROM {src})"


_SQL_SPARSE_IN = f"""SELECT account_id, f_spend AS v_spend, f_max AS v_max, account_id % 7 = 0 AS gone, account_id % 11 = 0 AS own_ratio,
       account_id % 3 = 0 AND s_opened IS NOT NULL AS dated, coalesce(datediff('day', {A.SQL_DATE}, DATE '{A.REF_DATE.isoformat()}'), -1) AS days,
       coalesce(f_spend, {_sql_median('clean', 'f_spend')}) AS f_spend, coalesce(f_max, {_sql_median('clean', 'f_max')}) AS f_max,
       {_sql_median('clean', 'f_bal')} AS f_bal FROM acct_raw"""
_SQL_SPARSE_AGE = f"""SELECT *, CASE WHEN dated THEN CAST(days AS DOUBLE) ELSE {_sql_median('clean', 'feat_account_age_days')} END AS age FROM sp_in"""


def _sql_z(c, value):
    return f"least(greatest(({value} - p.mu_{c}) / (p.sd_{c} + 1e-9), -10.0), 10.0)"


_SQL_ZRAW = "SELECT " + ", ".join(f"{_sql_z(c, 'zt.' + c)} AS z_{c}" for c in ("f_spend", "f_orders", "f_bal")) + " FROM zt, zp p"


@query("derive_sparse_requests", _chain(f"""SELECT 'ACC-' || CAST(account_id AS VARCHAR) AS account_id, round(f_spend, 6) AS f_spend,
       round(f_max, 6) AS f_max, round(f_bal, 6) AS f_bal, round(age, 6) AS feat_account_age_days,
       CASE WHEN gone THEN 1.0 WHEN v_spend IS NOT NULL OR v_max IS NOT NULL OR dated THEN 0.0
            ELSE {_sql_median('clean', 'meta_missing_count')} END AS meta_missing_count,
       CASE WHEN gone THEN 1.0 ELSE {_sql_median('clean', 'miss_flag_f_bal')} END AS miss_flag_f_bal,
       CASE WHEN v_spend IS NOT NULL OR v_max IS NOT NULL THEN f_spend * f_max
            ELSE {_sql_median('inter', 'int_f_spendxf_max')} END AS int_f_spendxf_max,
       CASE WHEN gone OR v_max IS NOT NULL THEN f_bal * f_max ELSE {_sql_median('inter', 'int_f_balxf_max')} END AS int_f_balxf_max,
       {_sql_median('inter', 'int_f_ordersxf_urgent')} AS int_f_ordersxf_urgent,
       CASE WHEN own_ratio THEN 2.5 WHEN gone OR v_max IS NOT NULL THEN f_max / (f_bal + 1e-9)
            ELSE {_sql_median('inter', 'ratio_f_max_f_bal')} END AS ratio_f_max_f_bal,
       CASE WHEN dated OR v_spend IS NOT NULL THEN age * f_spend ELSE {_sql_median('inter', 'int_age_f_spend')} END AS int_age_f_spend,
       round(CASE WHEN v_spend IS NOT NULL THEN {_sql_z('f_spend', 'f_spend')} ELSE {_sql_median('zraw', 'z_f_spend')} END, 6) AS z_f_spend,
       round({_sql_median('zraw', 'z_f_orders')}, 6) AS z_f_orders,
       round(CASE WHEN gone THEN {_sql_z('f_bal', 'f_bal')} ELSE {_sql_median('zraw', 'z_f_bal')} END, 6) AS z_f_bal,
       CAST(NULL AS VARCHAR) AS parse_error FROM sp_age, zp p""",
    ("sp_in", _SQL_SPARSE_IN), ("sp_age", _SQL_SPARSE_AGE), ("zraw", _SQL_ZRAW)))
def q_derive_sparse_requests(spark, sf_dir):
    """Only what depends on the supplied names is recomputed; the rest keeps the training medians."""
    v = derive.recompute(sparse_requests(spark, sf_dir), derivation(spark, sf_dir), SPARSE)
    return v.select("account_id", *[_round(c).alias(c) for c in SPARSE], "parse_error")
