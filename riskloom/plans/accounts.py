"""Shared account-table inputs: the raw fixture, its phase-one chain, and the SQL
text of the same chain for the oracle."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from riskloom.operators import features
from riskloom.operators.steps import StepLog
from riskloom.sources.fixtures import fixture

# Fixed parameters of the fixture account table.
REF_DATE = _dt.date(2001, 8, 2)
DATE_COL = "s_opened"
SEGMENT_MAP = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "HOUSEHOLD": 4, "MACHINERY": 5}
MANUAL = {"s_segment": SEGMENT_MAP}
NAMED_LEAKS = ("F2230", "f_leak")
KEYS = ("f_bal", "f_orders", "f_spend", "f_max", "f_urgent", "f_ev_value")
RATIOS = (("f_spend", "f_orders"), ("f_ev_value", "f_events"), ("f_max", "f_bal"))
AGE_KEYS = ("f_spend", "f_bal")

NUMERIC = ("f_bal", "f_orders", "f_spend", "f_max", "f_urgent", "f_events", "f_ev_value", "f_errors",
           "f_leak", "f_soft", "f_empty", "f_const")
STRINGS = ("s_segment", "s_nation", "s_name", "s_opened")
# Column decisions of the chain on this fixture; each is checked on its own by
# the leakage_corr / missing_profile / low_variance queries.
CLEAN_BASE = ("f_bal", "f_orders", "f_spend", "f_max", "f_urgent", "f_events", "f_ev_value", "f_errors",
              "f_soft", "s_segment", "s_nation", "s_name")
TEMPORAL = ("feat_account_age_days", "feat_account_age_bucket", "feat_opening_month", "feat_opening_dow",
            "feat_opening_year", "feat_is_new_account")
META = ("meta_missing_count", "meta_missing_ratio", "meta_zero_count", "meta_zero_ratio",
        "meta_negative_count", "meta_nonzero_count", "meta_is_high_missing")
FLAGGED = ("f_bal", "f_events", "f_ev_value", "f_errors")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "acct_raw")


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phase-one output, persisted between applications."""
    return clean_and_steps(spark, sf_dir)[0]


def clean_and_steps(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Phase-one output and the log of the run that wrote it, both persisted."""
    from riskloom.sources.artifacts import materialized

    runs: list[StepLog] = []

    def build():
        runs.append(StepLog())
        return features.clean_accounts(raw(spark, sf_dir), DATE_COL, REF_DATE, MANUAL, steps=runs[-1])[0]

    def steps():
        if not runs:  # the table is there, but its run was lost before it saved its log
            build().write.format("noop").mode("overwrite").save()
        return runs[-1].frame(spark)

    table = materialized(spark, "clean_accounts", sf_dir, build)
    return table, materialized(spark, "clean_steps", sf_dir, steps)


# --- SQL ----------------------------------------------------------------------


def sql_long(src: str, cols, with_y: bool = True, value_type: str = "DOUBLE") -> str:
    y = "y, " if with_y else ""
    return " UNION ALL ".join(
        f"SELECT account_id, {y}'{c}' AS feature, CAST({c} AS {value_type}) AS value FROM {src}" for c in cols
    )


SQL_DATE = (f"CASE WHEN CAST(try_strptime(s_opened, '%m-%d-%Y') AS DATE) BETWEEN DATE '1950-01-01' "
            f"AND DATE '{REF_DATE.isoformat()}' THEN CAST(try_strptime(s_opened, '%m-%d-%Y') AS DATE) END")


def sql_temporal(d: str = "d") -> str:
    age = f"datediff('day', {d}, DATE '{REF_DATE.isoformat()}')"
    bucket = (f"CASE WHEN {age} IS NULL OR {age} <= -1 THEN -1 WHEN {age} <= 7 THEN 0 WHEN {age} <= 30 THEN 1 "
              f"WHEN {age} <= 90 THEN 2 WHEN {age} <= 365 THEN 3 WHEN {age} <= 730 THEN 4 "
              f"WHEN {age} <= 1825 THEN 5 ELSE 6 END")
    return ", ".join([
        f"CAST(coalesce({age}, -1) AS DOUBLE) AS feat_account_age_days",
        f"CAST({bucket} AS DOUBLE) AS feat_account_age_bucket",
        f"CAST(coalesce(month({d}), 0) AS DOUBLE) AS feat_opening_month",
        f"CAST(coalesce(isodow({d}) - 1, -1) AS DOUBLE) AS feat_opening_dow",
        f"CAST(coalesce(year({d}), 0) AS DOUBLE) AS feat_opening_year",
        f"CAST(coalesce(CAST({age} < 90 AS INTEGER), 0) AS DOUBLE) AS feat_is_new_account",
    ])


SQL_SEGMENT = ("CAST(CASE s_segment " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in SEGMENT_MAP.items())
               + " ELSE -1 END AS DOUBLE)")
SQL_NATION_CODES = ("SELECT category, CAST(dense_rank() OVER (ORDER BY category) - 1 AS DOUBLE) AS code FROM "
                    "(SELECT DISTINCT coalesce(CAST(s_nation AS VARCHAR), 'nan') AS category FROM acct_raw)")
SQL_NAME_SHARE = ("SELECT s_name AS category, count(*) / sum(count(*)) OVER () AS share "
                  "FROM acct_raw WHERE s_name IS NOT NULL GROUP BY s_name")

# Stage 1: drops, temporal features, encodings (before flags and imputation).
SQL_ENC = f"""SELECT a.account_id, a.y, {', '.join('a.' + c for c in CLEAN_BASE[:9])},
       {SQL_SEGMENT.replace('s_segment', 'a.s_segment')} AS s_segment,
       coalesce(nc.code, -1.0) AS s_nation, coalesce(ns.share, 0.0) AS s_name,
       {sql_temporal('a.d')}
FROM (SELECT *, {SQL_DATE} AS d FROM acct_raw) a
LEFT JOIN nation_codes nc ON coalesce(CAST(a.s_nation AS VARCHAR), 'nan') = nc.category
LEFT JOIN name_share ns ON a.s_name = ns.category"""

_ENC_COLS = CLEAN_BASE + TEMPORAL


def _cnt(pred: str) -> str:
    return " + ".join(f"CAST(coalesce({pred.format(c=c)}, false) AS INTEGER)" for c in _ENC_COLS)


SQL_META = f"""SELECT *,
   CAST(({_cnt('{c} IS NULL')}) AS DOUBLE) AS meta_missing_count,
   ({_cnt('{c} IS NULL')}) / {float(len(_ENC_COLS))} AS meta_missing_ratio,
   CAST(({_cnt('{c} = 0')}) AS DOUBLE) AS meta_zero_count,
   ({_cnt('{c} = 0')}) / {float(len(_ENC_COLS))} AS meta_zero_ratio,
   CAST(({_cnt('{c} < 0')}) AS DOUBLE) AS meta_negative_count,
   CAST(({' + '.join(f'CAST(coalesce({c} <> 0, true) AS INTEGER)' for c in _ENC_COLS)}) AS DOUBLE) AS meta_nonzero_count,
   CAST(({_cnt('{c} IS NULL')}) / {float(len(_ENC_COLS))} > 0.5 AS DOUBLE) AS meta_is_high_missing,
   {', '.join(f'CAST({c} IS NULL AS DOUBLE) AS miss_flag_{c}' for c in FLAGGED)}
FROM enc"""

PRE_IMPUTE_COLS = _ENC_COLS + META + tuple(f"miss_flag_{c}" for c in FLAGGED)
SQL_MEDIANS = ("SELECT feature, quantile_cont(value, 0.5) AS median FROM ("
               + sql_long("meta", PRE_IMPUTE_COLS, with_y=False) + ") GROUP BY feature")
SQL_CLEAN = ("SELECT account_id, y, "
             + ", ".join(f"coalesce({c}, (SELECT median FROM medians WHERE feature = '{c}')) AS {c}"
                         for c in PRE_IMPUTE_COLS)
             + " FROM meta")
CHAIN = (("nation_codes", SQL_NATION_CODES), ("name_share", SQL_NAME_SHARE), ("enc", SQL_ENC),
         ("meta", SQL_META), ("medians", SQL_MEDIANS), ("clean", SQL_CLEAN))
