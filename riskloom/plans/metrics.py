"""Evaluation queries (O-61..O-69, O-50, O-55, O-57) on the scored accounts."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions.scoring import round6
from riskloom.operators import folds, metrics
from riskloom.plans import common
from riskloom.plans.registry import query
from riskloom.sources.fixtures import fixture, with_views

STEP = repr(metrics.GRID_STEP)
SQL_GRID = f"SELECT j, CASE WHEN j = 199 THEN CAST(0.99 AS DOUBLE) ELSE j * {STEP} + CAST(0.01 AS DOUBLE) END AS t FROM range(200) r(j)"


def sql_thresholds(src: str, by: str = "") -> str:
    """Per-group grid counts by brute force (every row against every grid point)."""
    g = f"{by}, " if by else ""
    gj = f"GROUP BY {by}, j, t" if by else "GROUP BY j, t"
    return f"""SELECT {g}j, t, count_if(s.y = 1 AND s.prob >= g.t) AS tp, count_if(s.y <> 1 AND s.prob >= g.t) AS fp,
                  count_if(s.y = 1 AND s.prob < g.t) AS fn, count_if(s.y <> 1 AND s.prob < g.t) AS tn
           FROM {src} s, grid g {gj}"""


def sql_f(beta2: float, tp="tp", fp="fp", fn="fn") -> str:
    b = repr(beta2)
    a = repr(1.0 + beta2)
    return (f"coalesce(CAST({a} AS DOUBLE) * {tp} / nullif(CAST({a} AS DOUBLE) * {tp} + CAST({b} AS DOUBLE) * {fn}"
            f" + {fp}, 0), 0.0)")


SQL_BEST = f"""SELECT coalesce(max(t), CAST(0.5 AS DOUBLE)) AS threshold, coalesce(max(f2), 0.0) AS best_f2 FROM (
    SELECT t, f2 FROM (SELECT j, t, tp, fp, {sql_f(4.0)} AS f2 FROM thr) WHERE tp + fp > 0 AND f2 > 0
    ORDER BY f2 DESC, j ASC LIMIT 1)"""

SQL_CONF = """SELECT b.threshold, CAST(count_if(s.prob >= b.threshold AND s.y = 1) AS BIGINT) AS tp,
                     CAST(count_if(s.prob >= b.threshold AND s.y <> 1) AS BIGINT) AS fp,
                     CAST(count_if(s.prob < b.threshold AND s.y = 1) AS BIGINT) AS fn,
                     CAST(count_if(s.prob < b.threshold AND s.y <> 1) AS BIGINT) AS tn
              FROM scored s, best b GROUP BY b.threshold"""

SQL_CURVE = """SELECT score, pos, neg, tp, fp, n_pos, n_neg, tp / (tp + fp) AS precision,
                      coalesce(tp / nullif(n_pos, 0), 1.0) AS recall FROM (
    SELECT c.score, c.pos, c.neg,
           sum(c.pos) OVER (ORDER BY c.score DESC ROWS UNBOUNDED PRECEDING) AS tp,
           sum(c.neg) OVER (ORDER BY c.score DESC ROWS UNBOUNDED PRECEDING) AS fp, t.n_pos, t.n_neg
    FROM (SELECT prob AS score, count_if(y = 1) AS pos, count_if(y <> 1) AS neg FROM scored GROUP BY prob) c,
         (SELECT count_if(y = 1) AS n_pos, count_if(y <> 1) AS n_neg FROM scored) t)"""

SQL_AP = "SELECT coalesce(sum(pos / nullif(n_pos, 0) * precision), 0.0) AS average_precision FROM curve"
SQL_AUC = ("SELECT sum(pos * ((n_neg - fp) + CAST(0.5 AS DOUBLE) * neg)) / nullif(max(n_pos) * max(n_neg), 0)"
           " AS roc_auc FROM curve")
SQL_RAP = """SELECT coalesce(max(recall) FILTER (WHERE precision >= 0.5), 0.0) AS recall_at_precision FROM
             (SELECT precision, recall FROM curve UNION ALL SELECT 1.0, 0.0)"""

BASE = (("scored", common.SQL_SCORED), ("grid", SQL_GRID), ("thr", sql_thresholds("scored")),
        ("best", SQL_BEST))


def _v(body, *extra):
    return with_views(body, "scored_events", extra=BASE + tuple(extra))


def _scored(spark, sf_dir):
    return common.scored(spark, sf_dir)


@query("best_threshold", _v("SELECT round(threshold, 6) AS threshold, round(best_f2, 6) AS best_f2 FROM best"))
def q_best_threshold(spark, sf_dir):
    b = metrics.best_threshold(_scored(spark, sf_dir))
    return b.select(round6("threshold").alias("threshold"), round6("best_f2").alias("best_f2"))


@query("confusion", _v("SELECT round(threshold, 6) AS threshold, tp, fp, fn, tn FROM conf", ("conf", SQL_CONF)))
def q_confusion(spark, sf_dir):
    s = _scored(spark, sf_dir)
    c = metrics.confusion(s, metrics.best_threshold(s))
    return c.select(round6("threshold").alias("threshold"), "tp", "fp", "fn", "tn")


@query("fbeta_metrics", _v(
    f"""SELECT round(coalesce(tp / nullif(tp + fp, 0), 0.0), 6) AS precision,
               round(coalesce(tp / nullif(tp + fn, 0), 0.0), 6) AS recall,
               round({sql_f(1.0)}, 6) AS f1, round({sql_f(4.0)}, 6) AS f2 FROM conf""", ("conf", SQL_CONF)))
def q_fbeta_metrics(spark, sf_dir):
    s = _scored(spark, sf_dir)
    r = metrics.rates(metrics.confusion(s, metrics.best_threshold(s)))
    return r.select(*[round6(c).alias(c) for c in ("precision", "recall", "f1", "f2")])


@query("pr_curve", _v(
    """SELECT round(score, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall FROM curve
       UNION ALL SELECT NULL, 1.0, 0.0""", ("curve", SQL_CURVE)))
def q_pr_curve(spark, sf_dir):
    c = metrics.pr_curve(_scored(spark, sf_dir))
    return c.select(*[round6(x).alias(x) for x in ("threshold", "precision", "recall")])


@query("recall_at_precision", _v("SELECT round(recall_at_precision, 6) AS recall_at_precision FROM rap",
                                 ("curve", SQL_CURVE), ("rap", SQL_RAP)))
def q_recall_at_precision(spark, sf_dir):
    r = metrics.recall_at_precision(_scored(spark, sf_dir))
    return r.select(round6("recall_at_precision").alias("recall_at_precision"))


@query("roc_auc", _v("SELECT round(roc_auc, 6) AS roc_auc FROM auc", ("curve", SQL_CURVE), ("auc", SQL_AUC)))
def q_roc_auc(spark, sf_dir):
    return metrics.roc_auc(_scored(spark, sf_dir)).select(round6("roc_auc").alias("roc_auc"))


@query("average_precision", _v("SELECT round(average_precision, 6) AS average_precision FROM ap",
                               ("curve", SQL_CURVE), ("ap", SQL_AP)))
def q_average_precision(spark, sf_dir):
    a = metrics.average_precision(_scored(spark, sf_dir))
    return a.select(round6("average_precision").alias("average_precision"))


@query("metrics_table", _v(
    f"""SELECT metric, round(value, 6) AS value FROM (
          SELECT 'roc_auc' AS metric, roc_auc AS value FROM auc
          UNION ALL SELECT 'average_precision', average_precision FROM ap
          UNION ALL SELECT 'f2', {sql_f(4.0)} FROM conf
          UNION ALL SELECT 'f1', {sql_f(1.0)} FROM conf
          UNION ALL SELECT 'recall', coalesce(tp / nullif(tp + fn, 0), 0.0) FROM conf
          UNION ALL SELECT 'precision', coalesce(tp / nullif(tp + fp, 0), 0.0) FROM conf
          UNION ALL SELECT 'recall_at_precision', recall_at_precision FROM rap
          UNION ALL SELECT 'tp', CAST(tp AS DOUBLE) FROM conf UNION ALL SELECT 'fp', CAST(fp AS DOUBLE) FROM conf
          UNION ALL SELECT 'fn', CAST(fn AS DOUBLE) FROM conf UNION ALL SELECT 'tn', CAST(tn AS DOUBLE) FROM conf)""",
    ("conf", SQL_CONF), ("curve", SQL_CURVE), ("auc", SQL_AUC), ("ap", SQL_AP), ("rap", SQL_RAP)))
def q_metrics_table(spark, sf_dir):
    m = metrics.metric_record(_scored(spark, sf_dir))
    return m.select("metric", round6("value").alias("value"))


SQL_FOLDS = """SELECT account_id, y, prob,
       CAST((row_number() OVER (PARTITION BY y ORDER BY md5(concat('42', '|', CAST(account_id AS VARCHAR))), account_id) - 1) % 5
            AS INTEGER) AS fold
FROM scored"""


@query("stratified_folds", _v(
    "SELECT fold, y, count(*) AS n FROM folded GROUP BY fold, y", ("folded", SQL_FOLDS)))
def q_stratified_folds(spark, sf_dir):
    f = folds.stratified_folds(_scored(spark, sf_dir))
    return f.groupBy("fold", "y").agg(F.count(F.lit(1)).alias("n"))


@query("fold_assignment", _v("SELECT account_id, fold FROM folded", ("folded", SQL_FOLDS)))
def q_fold_assignment(spark, sf_dir):
    return folds.stratified_folds(_scored(spark, sf_dir)).select("account_id", "fold")


@query("fold_f2", _v(
    """SELECT round(avg(best_f2), 6) AS mean_f2, round(stddev_pop(best_f2), 6) AS std_f2 FROM (
         SELECT fold, coalesce(max(f2) FILTER (WHERE rn = 1), 0.0) AS best_f2 FROM (
           SELECT fold, f2, row_number() OVER (PARTITION BY fold ORDER BY f2 DESC, j) AS rn
           FROM (SELECT fold, j, tp, fp, """ + sql_f(4.0) + """ AS f2 FROM fthr) WHERE tp + fp > 0 AND f2 > 0)
         GROUP BY fold)""",
    ("folded", SQL_FOLDS), ("fthr", sql_thresholds("folded", "fold"))))
def q_fold_f2(spark, sf_dir):
    f = folds.stratified_folds(_scored(spark, sf_dir))
    b = metrics.best_threshold(f, "prob", by=["fold"])
    return b.agg(round6(F.avg("best_f2")).alias("mean_f2"), round6(F.stddev_pop("best_f2")).alias("std_f2"))


@query("class_weights", with_views(
    """SELECT account_id, y, round(CASE WHEN y = 1 THEN CAST(n_neg AS DOUBLE) / n_pos ELSE 1.0 END, 6) AS w
       FROM vec_accounts, (SELECT count_if(y = 1) AS n_pos, count_if(y <> 1) AS n_neg FROM vec_accounts)""",
    "vec_accounts"))
def q_class_weights(spark, sf_dir):
    v = fixture(spark, sf_dir, "vec_accounts").select("account_id", "y")
    return folds.class_weights(v).select("account_id", "y", round6("w").alias("w"))


# --- blend of two members (p, p2) weighted by their average precision --------

SQL_MEMBERS = """SELECT account_id, y, 'p' AS member, p AS prob FROM scored_events
                 UNION ALL SELECT account_id, y, 'p2', p2 FROM scored_events"""
SQL_MCURVE = """SELECT member, pos, n_pos, tp / (tp + fp) AS precision FROM (
    SELECT c.member, c.pos, sum(c.pos) OVER (PARTITION BY c.member ORDER BY c.score DESC ROWS UNBOUNDED PRECEDING) AS tp,
           sum(c.neg) OVER (PARTITION BY c.member ORDER BY c.score DESC ROWS UNBOUNDED PRECEDING) AS fp, t.n_pos
    FROM (SELECT member, prob AS score, count_if(y = 1) AS pos, count_if(y <> 1) AS neg FROM members GROUP BY member, prob) c
    JOIN (SELECT member, count_if(y = 1) AS n_pos FROM members GROUP BY member) t ON c.member = t.member)"""
SQL_WEIGHTS = """SELECT member, ap, ap / sum(ap) OVER () AS weight FROM (
    SELECT member, coalesce(sum(pos / nullif(n_pos, 0) * precision), 0.0) AS ap FROM mcurve GROUP BY member)"""
_B = (("members", SQL_MEMBERS), ("mcurve", SQL_MCURVE), ("weights", SQL_WEIGHTS))


def blend_weights_df(spark, sf_dir):
    se = fixture(spark, sf_dir, "scored_events")
    members = se.select("account_id", "y", F.lit("p").alias("member"), F.col("p").alias("prob")).unionByName(
        se.select("account_id", "y", F.lit("p2").alias("member"), F.col("p2").alias("prob")))
    return metrics.blend_weights(members)


@query("blend_weights", with_views(
    "SELECT member, round(ap, 6) AS average_precision, round(weight, 6) AS weight FROM weights",
    "scored_events", extra=_B))
def q_blend_weights(spark, sf_dir):
    w = blend_weights_df(spark, sf_dir)
    return w.select("member", round6("average_precision").alias("average_precision"), round6("weight").alias("weight"))


@query("blend", with_views(
    """SELECT s.account_id, s.y, round(w1.weight * s.p + w2.weight * s.p2, 6) AS blend
       FROM scored_events s, (SELECT weight FROM weights WHERE member = 'p') w1,
            (SELECT weight FROM weights WHERE member = 'p2') w2""",
    "scored_events", extra=_B))
def q_blend(spark, sf_dir):
    se = fixture(spark, sf_dir, "scored_events")
    b = metrics.blend(se, blend_weights_df(spark, sf_dir), ["p", "p2"])
    return b.select("account_id", "y", round6("blend").alias("blend"))
