"""Screening of new accounts (O-60, O-96..O-99): requests are derived from the
raw account table (one request per account, values as text, one malformed value
per 97 accounts, one unknown name)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions.scoring import SCREEN_ACTIONS, round6
from riskloom.operators import alerts, explain, features, screen
from riskloom.plans import accounts as A
from riskloom.plans import common
from riskloom.plans import explaining as X
from riskloom.plans.registry import query
from riskloom.session import cut_lineage
from riskloom.sources.fixtures import fixture, with_views

REQ_NAMES = ("f_bal", "f_orders", "f_spend", "f_max", "f_urgent", "f_events", "f_ev_value", "f_errors", "f_soft",
             "f_leak")  # f_leak is not in the trained catalog: ignored
FEATS = list(A.PRE_IMPUTE_COLS)
API_TYPO = {k: v for k, v in X.TYPO_ATTRS.items() if k != "dow"}


def requests(spark, sf_dir):
    """``(account_id STRING, features MAP<STRING,STRING>)`` built from the raw table."""
    r = A.raw(spark, sf_dir)
    entries = []
    for n in REQ_NAMES:
        v = F.col(n).cast("string")
        if n == "f_orders":
            v = F.when(F.col("account_id") % 97 == 0, F.col("s_segment")).otherwise(v)
        entries.append(F.struct(F.lit(n).alias("key"), v.alias("value")))
    m = F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"].isNotNull()))
    return r.select(F.concat(F.lit("ACC-"), F.col("account_id").cast("string")).alias("account_id"), m.alias("features"))


def fitted_tables(spark, sf_dir):
    """Training medians, scorer parameters and calibration percentiles (persisted)."""
    from riskloom.sources.artifacts import materialized

    clean = A.clean(spark, sf_dir)
    med = materialized(spark, "train_medians", sf_dir, lambda: features.medians(clean, FEATS))
    params = materialized(spark, "scorer_params", sf_dir, lambda: explain.fit_linear_scorer(clean, FEATS))
    cal = materialized(spark, "calibration", sf_dir, lambda: calibration(clean, params))
    return med, params, cal


def calibration(clean, params):
    """Calibration percentiles of the scored table; each row is scored once, the percentiles read its probability twice."""
    return alerts.calibration_params(cut_lineage(explain.linear_contributions(clean, params, FEATS).select("prob")), "prob")


def _flat(df):
    return df.select(
        "account_id", "risk_score", "tier", round6("fraud_probability").alias("fraud_probability"), "action",
        F.concat_ws(",", F.transform("top_risk_factors", lambda x: x["feature"])).alias("top_factors"),
        F.col("typology.witting").alias("witting"), F.col("typology.unwitting").alias("unwitting"),
        F.col("typology.synthetic").alias("synthetic"), "model_version")


# --- SQL --------------------------------------------------------------------------
def _req_value(n):
    v = f"CAST({n} AS VARCHAR)"
    if n == "f_orders":
        v = f"CASE WHEN account_id % 97 = 0 THEN s_segment ELSE {v} END"
    return f"{v} AS v_{n}"


SQL_REQ = ("SELECT 'ACC-' || CAST(account_id AS VARCHAR) AS account_id, "
           + ", ".join(_req_value(n) for n in REQ_NAMES) + " FROM acct_raw")
SQL_FMED = ("SELECT feature, quantile_cont(value, 0.5) AS median FROM (" + A.sql_long("clean", FEATS, with_y=False)
            + ") GROUP BY feature")
_SUPPLIED = [n for n in sorted(REQ_NAMES) if n in FEATS]
SQL_ERR = ("coalesce(" + ", ".join(
    f"CASE WHEN v_{n} IS NOT NULL AND TRY_CAST(v_{n} AS DOUBLE) IS NULL THEN 'could not convert value of {n} to float' END"
    for n in _SUPPLIED) + ")")
SQL_VEC = ("SELECT account_id, " + ", ".join(
    (f"coalesce(TRY_CAST(v_{f} AS DOUBLE), (SELECT median FROM fmed WHERE feature = '{f}')) AS {f}" if f in REQ_NAMES
     else f"(SELECT median FROM fmed WHERE feature = '{f}') AS {f}") for f in FEATS)
    + f", {SQL_ERR} AS parse_error FROM sreq")
SQL_SC = " UNION ALL ".join(
    f"SELECT v.account_id, '{f}' AS feature, v.{f} AS value, w.w_{f} * (v.{f} - w.mu_{f}) / w.sd_{f} AS shap "
    f"FROM svec v, lw w WHERE v.parse_error IS NULL" for f in FEATS)
SQL_SP = ("SELECT account_id, " + ", ".join(API_TYPO.values()) + ", ens, "
          + common.sql_score("ens", "k.p1", "k.p99") + " AS risk_score FROM ("
          "SELECT v.*, (0.35 * (1.0 / (1.0 + exp(-(w.intercept + ("
          + " + ".join(f"w.w_{f} * (v.{f} - w.mu_{f}) / w.sd_{f}" for f in FEATS)
          + ")))))) / 0.35 AS ens FROM svec v, lw w WHERE v.parse_error IS NULL), lcal k")


def _sql_typo_api():
    # the screening variant has no opening-weekday rule
    return X._sql_typo(dow=False)


SQL_TOPF = """SELECT account_id, string_agg(feature, ',' ORDER BY shap DESC, feature) AS top_factors FROM (
  SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY shap DESC, feature) AS r FROM sc WHERE shap > 0)
  WHERE r <= 5 GROUP BY account_id"""
SQL_SCREEN = f"""SELECT p.account_id, p.risk_score, {common.sql_tier_case('p.risk_score')} AS tier,
       round(round_even(p.ens, 4), 6) AS fraud_probability,
       {common.sql_action_case(common.sql_tier_case('p.risk_score'), SCREEN_ACTIONS)} AS action,
       coalesce(t.top_factors, '') AS top_factors, {_sql_typo_api()}, '{screen.MODEL_VERSION}' AS model_version
FROM sp p LEFT JOIN topf t ON p.account_id = t.account_id"""
SQL_ERRROWS = f"""SELECT account_id, 0 AS risk_score, 'ERROR' AS tier, 0.0 AS fraud_probability,
       'Screening failed: ' || parse_error AS action, '' AS top_factors, CAST(NULL AS DOUBLE) AS witting,
       CAST(NULL AS DOUBLE) AS unwitting, CAST(NULL AS DOUBLE) AS synthetic, '{screen.MODEL_VERSION}' AS model_version
FROM svec WHERE parse_error IS NOT NULL"""
SCREEN_CTES = (("sreq", SQL_REQ), ("fmed", SQL_FMED), ("svec", SQL_VEC), ("sc", SQL_SC), ("sp", SQL_SP),
               ("topf", SQL_TOPF), ("scr", SQL_SCREEN), ("serr", SQL_ERRROWS))


def _v(body):
    return with_views(body, "acct_raw", extra=A.CHAIN + X.LIN + SCREEN_CTES)


@query("impute_requests", _v("SELECT account_id, " + ", ".join(f"round({f}, 6) AS {f}" for f in FEATS)
                             + ", parse_error FROM svec"))
def q_impute_requests(spark, sf_dir):
    med, _, _ = fitted_tables(spark, sf_dir)
    v = screen.request_vectors(requests(spark, sf_dir), med, FEATS)
    return v.select("account_id", *[round6(f).alias(f) for f in FEATS], "parse_error")


@query("ensemble_score", with_views(
    "SELECT account_id, round((0.35 * p + 0.31 * p2) / (0.35 + 0.31), 6) AS prob FROM scored_events", "scored_events"))
def q_ensemble_score(spark, sf_dir):
    """Two of the three default-weighted members present: weights renormalised."""
    se = fixture(spark, sf_dir, "scored_events")
    e = screen.ensemble_score(se, {"xgb": "p", "lgb": "p2"})
    return e.select("account_id", round6("prob").alias("prob"))


@query("screen_batch", _v("SELECT * FROM scr UNION ALL SELECT * FROM serr"))
def q_screen_batch(spark, sf_dir):
    med, params, cal = fitted_tables(spark, sf_dir)
    out = screen.screen_requests(requests(spark, sf_dir), med, params, cal, FEATS, API_TYPO)
    return _flat(out)


@query("screen_errors", _v("SELECT account_id, tier, risk_score, action FROM serr"))
def q_screen_errors(spark, sf_dir):
    med, params, cal = fitted_tables(spark, sf_dir)
    out = screen.screen_requests(requests(spark, sf_dir), med, params, cal, FEATS, API_TYPO)
    out = cut_lineage(out.select("account_id", "tier", "risk_score", "action"))  # else the filter repeats the scoring for each use of a column
    return out.where(F.col("tier") == screen.ERROR_TIER)


@query("screen_stream")
def q_screen_stream(spark, sf_dir):
    """Continuous screening: requests arrive as files; each micro-batch runs the
    batch transform and is appended to a parquet sink (rows-only check; the tests
    check equality with ``screen_batch``)."""
    from riskloom.streaming.screening import run_screen_stream

    med, params, cal = fitted_tables(spark, sf_dir)
    out = run_screen_stream(spark, requests(spark, sf_dir), med, params, cal, FEATS, API_TYPO)
    return _flat(out)
