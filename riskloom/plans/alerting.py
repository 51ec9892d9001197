"""Scores, tiers and tier statistics (O-75, O-76, O-34, O-77, O-78)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions.scoring import round6
from riskloom.operators import alerts
from riskloom.plans import common
from riskloom.plans.registry import query
from riskloom.sources.fixtures import with_views

_T = common.TIERED_CTES


@query("risk_scores", with_views(
    "SELECT account_id, y, round(prob, 6) AS prob, risk_score FROM tiered", "scored_events", extra=_T))
def q_risk_scores(spark, sf_dir):
    t = common.tiered(spark, sf_dir)
    return t.select("account_id", "y", round6("prob").alias("prob"), "risk_score")


@query("tier_accounts", with_views(
    f"SELECT account_id, risk_score, tier, {common.sql_action_case('tier')} AS action FROM tiered",
    "scored_events", extra=_T))
def q_tier_accounts(spark, sf_dir):
    from riskloom.functions.scoring import action_col

    t = common.tiered(spark, sf_dir)
    return t.select("account_id", "risk_score", "tier", action_col("tier").alias("action"))


@query("tier_distribution", with_views(
    """SELECT d.tier, d.tier_rank, CAST(coalesce(c.n, 0) AS BIGINT) AS n_accounts,
              round(coalesce(c.n, 0) * 100.0 / (SELECT count(*) FROM tiered), 6) AS pct_accounts,
              CAST(coalesce(c.npos, 0) AS BIGINT) AS n_positives
       FROM (VALUES ('AUTO-FREEZE', 0), ('INVESTIGATOR', 1), ('WATCHLIST', 2), ('MONITORED', 3)) d(tier, tier_rank)
       LEFT JOIN (SELECT tier, count(*) AS n, sum(y) AS npos FROM tiered GROUP BY tier) c ON d.tier = c.tier""",
    "scored_events", extra=_T))
def q_tier_distribution(spark, sf_dir):
    return alerts.tier_distribution(common.tiered(spark, sf_dir))


@query("positive_score_summary", with_views(
    """SELECT count(*) AS n_positives, min(risk_score) AS min_score, max(risk_score) AS max_score,
              round(avg(risk_score), 6) AS mean_score, round(quantile_cont(risk_score, 0.5), 6) AS median_score,
              CAST(count_if(risk_score >= 500) AS BIGINT) AS n_ge_500, round(count_if(risk_score >= 500) * 100.0 / count(*), 6) AS pct_ge_500,
              CAST(count_if(risk_score >= 750) AS BIGINT) AS n_ge_750, round(count_if(risk_score >= 750) * 100.0 / count(*), 6) AS pct_ge_750
       FROM tiered WHERE y = 1""",
    "scored_events", extra=_T))
def q_positive_score_summary(spark, sf_dir):
    return alerts.positive_score_summary(common.tiered(spark, sf_dir))


@query("calibrate_new", with_views(
    f"""SELECT n.account_id, {common.sql_score('n.prob', 'c.p1', 'c.p99')} AS risk_score
        FROM (SELECT account_id, p AS prob FROM scored_events) n, cal c""",
    "scored_events", extra=(("scored", common.SQL_SCORED), ("cal", common.SQL_CAL))))
def q_calibrate_new(spark, sf_dir):
    """New scores (the uninformative member) calibrated with the training p1/p99."""
    from riskloom.sources.fixtures import fixture

    params = alerts.calibration_params(common.scored(spark, sf_dir), "prob")
    new = fixture(spark, sf_dir, "scored_events").select("account_id", F.col("p").alias("prob"))
    return alerts.risk_scores(new, "prob", params).select("account_id", "risk_score")
