"""Alert-queue read side (O-37, O-70, O-83..O-92, O-94, O-95) on the tiered scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions.scoring import round6
from riskloom.operators import metrics, readside
from riskloom.plans import common
from riskloom.plans.metrics import BASE as MBASE, SQL_CONF
from riskloom.plans.registry import query
from riskloom.sources.fixtures import with_views

_T = common.TIERED_CTES


def _v(body, *extra):
    return with_views(body, "scored_events", extra=_T + tuple(extra))


QUEUE_TIERS = ("AUTO-FREEZE", "INVESTIGATOR", "WATCHLIST")


@query("alert_queue", _v(
    """SELECT account_id AS account, risk_score, tier, round(prob, 6) AS fraud_prob, y AS label FROM tiered
       WHERE tier IN ('AUTO-FREEZE', 'INVESTIGATOR', 'WATCHLIST') AND risk_score BETWEEN 500 AND 1000
       ORDER BY risk_score DESC, account_id LIMIT 200"""))
def q_alert_queue(spark, sf_dir):
    q = readside.alert_queue(common.tiered(spark, sf_dir), QUEUE_TIERS, 500, 1000)
    return q.withColumn("fraud_prob", round6("fraud_prob"))


@query("alert_queue_positives", _v(
    """SELECT account_id AS account, risk_score, tier, round(prob, 6) AS fraud_prob, y AS label FROM tiered
       WHERE tier IN ('AUTO-FREEZE', 'INVESTIGATOR', 'WATCHLIST', 'MONITORED') AND risk_score BETWEEN 0 AND 1000 AND y = 1
       ORDER BY risk_score DESC, account_id LIMIT 200"""))
def q_alert_queue_positives(spark, sf_dir):
    q = readside.alert_queue(common.tiered(spark, sf_dir), ("AUTO-FREEZE", "INVESTIGATOR", "WATCHLIST", "MONITORED"),
                             0, 1000, label=1)
    return q.withColumn("fraud_prob", round6("fraud_prob"))


def _conf(spark, sf_dir):
    s = common.scored(spark, sf_dir)
    return metrics.confusion(s, metrics.best_threshold(s))


_MB = tuple(x for x in MBASE if x[0] != "scored")


@query("kpi_row", _v(
    """SELECT (SELECT CAST(count_if(tier = 'AUTO-FREEZE') AS BIGINT) FROM tiered) AS n_freeze,
              (SELECT CAST(count_if(tier = 'INVESTIGATOR') AS BIGINT) FROM tiered) AS n_investigate,
              (SELECT CAST(count_if(tier = 'WATCHLIST') AS BIGINT) FROM tiered) AS n_watch,
              tp, coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision FROM conf""", *_MB, ("conf", SQL_CONF)))
def q_kpi_row(spark, sf_dir):
    return readside.kpi_row(common.tiered(spark, sf_dir), _conf(spark, sf_dir))


@query("score_histogram", _v(
    "SELECT CAST(least(floor(risk_score * 50 / 1000.0) + 1, 50) AS INTEGER) AS bin, tier, count(*) AS n FROM tiered GROUP BY 1, 2"))
def q_score_histogram(spark, sf_dir):
    return readside.score_histogram(common.tiered(spark, sf_dir))


@query("tier_breakdown", _v(
    """SELECT d.tier, d.tier_rank, CAST(coalesce(c.n, 0) AS BIGINT) AS n
       FROM (VALUES ('AUTO-FREEZE', 0), ('INVESTIGATOR', 1), ('WATCHLIST', 2), ('MONITORED', 3)) d(tier, tier_rank)
       LEFT JOIN (SELECT tier, count(*) AS n FROM tiered GROUP BY tier) c ON d.tier = c.tier"""))
def q_tier_breakdown(spark, sf_dir):
    return readside.tier_breakdown(common.tiered(spark, sf_dir))


SQL_RANKED = """SELECT account_id, risk_score, row_number() OVER (ORDER BY risk_score DESC,
                md5(concat('42', '|', CAST(account_id AS VARCHAR)))) AS rank FROM tiered WHERE y = 1"""


@query("positives_ranked", _v("SELECT account_id, risk_score, rank FROM pr", ("pr", SQL_RANKED)))
def q_positives_ranked(spark, sf_dir):
    return readside.positives_ranked(common.tiered(spark, sf_dir)).select("account_id", "risk_score", "rank")


@query("account_lookup", _v(
    """SELECT t.account_id, t.risk_score, round(t.prob, 6) AS prob, t.tier, t.y,
              CASE WHEN t.prob > 0.3 THEN 'FLAG' ELSE 'PASS' END AS decision
       FROM tiered t JOIN pr ON t.account_id = pr.account_id WHERE pr.rank IN (1, 10)""", ("pr", SQL_RANKED)))
def q_account_lookup(spark, sf_dir):
    """The 1st and 10th riskiest positives looked up by id."""
    t = common.tiered(spark, sf_dir)
    ids = readside.positives_ranked(t).where(F.col("rank").isin(1, 10)).select("account_id")
    return readside.account_lookup(t, ids).withColumn("prob", round6("prob"))


@query("confusion_matrix", _v(
    """SELECT * FROM (SELECT 'positive' AS predicted, 'positive' AS actual, tp AS n FROM conf
       UNION ALL SELECT 'positive', 'negative', fp FROM conf UNION ALL SELECT 'negative', 'positive', fn FROM conf
       UNION ALL SELECT 'negative', 'negative', tn FROM conf)""", *_MB, ("conf", SQL_CONF)))
def q_confusion_matrix(spark, sf_dir):
    return readside.confusion_matrix(_conf(spark, sf_dir))


@query("seeded_sample", _v(
    """SELECT account_id, risk_score, tier, y FROM tiered
       ORDER BY md5(concat('42', '|', CAST(account_id AS VARCHAR))) LIMIT 3000"""))
def q_seeded_sample(spark, sf_dir):
    return readside.seeded_sample(common.tiered(spark, sf_dir)).select("account_id", "risk_score", "tier", "y")


@query("tier_exemplar", _v(
    """SELECT tier, account_id, risk_score FROM (
         SELECT tier, account_id, risk_score, row_number() OVER (PARTITION BY tier ORDER BY risk_score DESC, account_id) AS r
         FROM tiered) WHERE r = 1"""))
def q_tier_exemplar(spark, sf_dir):
    return readside.tier_exemplar(common.tiered(spark, sf_dir)).select("tier", "account_id", "risk_score")
