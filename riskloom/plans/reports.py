"""Step logs of the phase-one chain (O-06) and the model card (O-95)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import explain, metrics, profile
from riskloom.plans import accounts as A
from riskloom.plans import explaining as X
from riskloom.plans import metrics as M
from riskloom.plans.profiling import SQL_CORR, SQL_LONG_NUM, SQL_MISSING
from riskloom.plans.registry import query
from riskloom.sources.fixtures import with_views


def _row(step, metric, value):
    return F.struct(F.lit(step).alias("step"), F.lit(metric).alias("metric"), value.cast("double").alias("value"))


@query("step_log", with_views(
    f"""SELECT * FROM (
      SELECT 'load' AS step, 'rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM acct_raw
      UNION ALL SELECT 'load', 'feature_columns', {float(len(A.NUMERIC) + len(A.STRINGS))}
      UNION ALL SELECT 'leakage', 'dropped', CAST(count_if(leak_class = 'hard') AS DOUBLE) FROM corr
      UNION ALL SELECT 'leakage', 'flagged', CAST(count_if(leak_class = 'soft') AS DOUBLE) FROM corr
      UNION ALL SELECT 'empty', 'dropped', CAST(count_if(null_frac = 1.0) AS DOUBLE) FROM mp
      UNION ALL SELECT 'low_variance', 'dropped', CAST(count_if(NOT keep) AS DOUBLE) FROM
          (SELECT feature, var_pop(coalesce(value, 0.0)) > 0.001 AS keep FROM raw_long
           WHERE feature NOT IN (SELECT feature FROM corr WHERE leak_class = 'hard')
             AND feature NOT IN (SELECT feature FROM mp WHERE null_frac = 1.0) GROUP BY feature)
      UNION ALL SELECT 'final', 'rows', CAST(count(*) AS DOUBLE) FROM clean
      UNION ALL SELECT 'final', 'feature_columns', {float(len(A.PRE_IMPUTE_COLS))}
      UNION ALL SELECT 'final', 'null_cells', CAST(sum({' + '.join(f'CAST({c} IS NULL AS INTEGER)' for c in A.PRE_IMPUTE_COLS)}) AS DOUBLE) FROM clean)""",
    "acct_raw", extra=A.CHAIN + (SQL_LONG_NUM, ("corr", SQL_CORR), ("mp", SQL_MISSING))))
def q_step_log(spark, sf_dir):
    """``(step, metric, value)``: what each phase-one step removed, and the result."""
    raw = A.raw(spark, sf_dir)
    corr = profile.target_correlation(raw)
    mp = profile.missing_profile(raw)
    hard = corr.where("leak_class = 'hard'").select("feature")
    empty = mp.where("empty").select("feature")
    num = [f for f in A.NUMERIC]
    lv = profile.low_variance(raw, num).join(hard, "feature", "left_anti").join(empty, "feature", "left_anti")
    clean = A.clean(spark, sf_dir)
    feats = [c for c in clean.columns if c not in ("account_id", "y")]
    nulls = None
    for c in feats:
        t = F.col(c).isNull().cast("int")
        nulls = t if nulls is None else nulls + t
    parts = [
        raw.agg(F.array(_row("load", "rows", F.count(F.lit(1))),
                        _row("load", "feature_columns", F.lit(len(raw.columns) - 2))).alias("r")),
        corr.agg(F.array(_row("leakage", "dropped", F.count_if(F.col("leak_class") == "hard")),
                         _row("leakage", "flagged", F.count_if(F.col("leak_class") == "soft"))).alias("r")),
        mp.agg(F.array(_row("empty", "dropped", F.count_if("empty"))).alias("r")),
        lv.agg(F.array(_row("low_variance", "dropped", F.count_if(~F.col("keep")))).alias("r")),
        clean.agg(F.array(_row("final", "rows", F.count(F.lit(1))),
                          _row("final", "feature_columns", F.lit(len(feats))),
                          _row("final", "null_cells", F.sum(nulls))).alias("r")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.explode("r").alias("e")).select("e.step", "e.metric", "e.value")


_N_RAW = len(A.NUMERIC) + len(A.STRINGS)
_LOW_VARIANCE = """SELECT count_if(NOT keep) FROM (SELECT feature, var_pop(coalesce(value, 0.0)) > 0.001 AS keep FROM raw_long
    WHERE feature NOT IN (SELECT feature FROM corr WHERE leak_class = 'hard')
      AND feature NOT IN (SELECT feature FROM mp WHERE null_frac = 1.0) GROUP BY feature)"""
_FLAGS = ("SELECT count(*) FROM mp WHERE null_frac > 0.1 AND null_frac < 1.0 AND feature IN ("
          + ", ".join(f"'{c}'" for c in A.CLEAN_BASE) + ")")


def _sql_nulls(columns, src):
    return f"(SELECT CAST(sum({' + '.join(f'CAST({c} IS NULL AS INTEGER)' for c in columns)}) AS BIGINT) FROM {src})"


@query("phase_steps", with_views(
    f"""SELECT CAST(position AS INTEGER) AS position, step, CAST(sum(delta) OVER (ORDER BY position) - delta AS INTEGER) AS columns_in,
       CAST(sum(delta) OVER (ORDER BY position) AS INTEGER) AS columns_out, CAST(delta AS INTEGER) AS column_delta, n_rows, null_cells, true AS timed
    FROM (SELECT 0 AS position, 'load' AS step, {_N_RAW} AS delta, (SELECT count(*) FROM acct_raw) AS n_rows,
                 {_sql_nulls(A.NUMERIC + A.STRINGS, 'acct_raw')} AS null_cells
      UNION ALL SELECT 1, 'leakage', -(SELECT count_if(leak_class = 'hard') FROM corr), NULL, NULL
      UNION ALL SELECT 2, 'empty', -(SELECT count_if(null_frac = 1.0) FROM mp), NULL, NULL
      UNION ALL SELECT 3, 'low_variance', -({_LOW_VARIANCE}), NULL, NULL
      UNION ALL SELECT 4, 'temporal', {len(A.TEMPORAL) - 1}, NULL, NULL
      UNION ALL SELECT 5, 'encode', 0, NULL, NULL
      UNION ALL SELECT 6, 'flags_and_meta', {len(A.META)} + ({_FLAGS}), (SELECT count(*) FROM meta), {_sql_nulls(A.PRE_IMPUTE_COLS, 'meta')}
      UNION ALL SELECT 7, 'impute', 0, (SELECT count(*) FROM clean), {_sql_nulls(A.PRE_IMPUTE_COLS, 'clean')})""",
    "acct_raw", extra=A.CHAIN + (SQL_LONG_NUM, ("corr", SQL_CORR), ("mp", SQL_MISSING))))
def q_phase_steps(spark, sf_dir):
    """The log that the phase-one run wrote: columns before and after each step, rows and missing cells where a
    step's output was written, and whether its time was taken."""
    log = A.clean_and_steps(spark, sf_dir)[1]
    return log.select("position", "step", "columns_in", "columns_out", "column_delta", F.col("rows").alias("n_rows"), "null_cells",
                      (F.col("seconds") >= 0).alias("timed"))


_CARD_SCORED = ("scored", "SELECT account_id, y, prob FROM lt")
_CARD_METRICS = (_CARD_SCORED, ("grid", M.SQL_GRID), ("thr", M.sql_thresholds("scored")), ("best", M.SQL_BEST),
                 ("conf", M.SQL_CONF), ("curve", M.SQL_CURVE), ("auc", M.SQL_AUC), ("ap", M.SQL_AP))


@query("model_card", with_views(
    f"""SELECT * FROM (
      SELECT 'member' AS section, 'linear' AS key, '1.0' AS value
      UNION ALL SELECT 'model', 'n_features', CAST({len(X.FEATS)} AS VARCHAR)
      UNION ALL SELECT 'top_feature', CAST(rk AS VARCHAR), feature FROM
          (SELECT feature, row_number() OVER (ORDER BY importance DESC, feature) AS rk FROM gi) WHERE rk <= 5
      UNION ALL SELECT 'metric', 'roc_auc', printf('%.4f', roc_auc) FROM auc
      UNION ALL SELECT 'metric', 'average_precision', printf('%.4f', average_precision) FROM ap
      UNION ALL SELECT 'metric', 'f2', printf('%.4f', {M.sql_f(4.0)}) FROM conf)""",
    "acct_raw", extra=A.CHAIN + X.LIN + (("gi", X.SQL_GI),) + _CARD_METRICS))
def q_model_card(spark, sf_dir):
    """Members and weights, feature count, top-5 features, headline metrics."""
    s = X.scored_accounts(spark, sf_dir)
    g = explain.global_importance(explain.contrib_long(s))
    from pyspark.sql import Window

    top = g.select("feature", F.row_number().over(Window.orderBy(F.col("importance").desc(), "feature")).alias("rk")) \
        .where("rk <= 5").select(F.lit("top_feature").alias("section"), F.col("rk").cast("string").alias("key"),
                                 F.col("feature").alias("value"))
    sc = s.select("account_id", "y", "prob")
    auc = metrics.roc_auc(sc).select(F.lit("metric").alias("section"), F.lit("roc_auc").alias("key"),
                                     F.format_string("%.4f", "roc_auc").alias("value"))
    ap = metrics.average_precision(sc).select(F.lit("metric").alias("section"), F.lit("average_precision").alias("key"),
                                              F.format_string("%.4f", "average_precision").alias("value"))
    r = metrics.rates(metrics.confusion(sc, metrics.best_threshold(sc)))
    f2 = r.select(F.lit("metric").alias("section"), F.lit("f2").alias("key"), F.format_string("%.4f", "f2").alias("value"))
    fixed = spark.createDataFrame([("member", "linear", "1.0"), ("model", "n_features", str(len(X.FEATS)))],
                                  "section string, key string, value string")
    return fixed.unionByName(top).unionByName(auc).unionByName(ap).unionByName(f2)
