"""Fitted statistics queries (O-41, O-42, O-45, O-47, O-48b, O-51, O-16, O-17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions.scoring import round6
from riskloom.operators import features, fitted, folds, profile, selection
from riskloom.operators.catalog import to_long
from riskloom.plans import accounts as A
from riskloom.plans import common
from riskloom.plans.registry import query
from riskloom.plans.rowfeatures import SQL_ROW_STATS
from riskloom.sources.fixtures import fixture, with_views

#: The account fixture has about 30 columns, so its query ranks with this parameter instead of 300.
TOP_N = 10
Z_TARGETS = A.KEYS + ("beh_row_mean", "beh_row_std", "meta_missing_ratio")
SQL_ZT = ("SELECT c.*, rs.beh_row_mean, rs.beh_row_std, rs.beh_row_skew, rs.beh_row_kurt, rs.beh_row_max, "
          "rs.beh_row_min, rs.beh_row_range, rs.beh_row_q75_q25 FROM clean c JOIN rs ON c.account_id = rs.account_id")
SQL_ZP = "SELECT " + ", ".join(f"avg({c}) AS mu_{c}, stddev_samp({c}) AS sd_{c}" for c in Z_TARGETS) + " FROM zt"


def _zcols(src_mu="p"):
    out, flags = [], []
    for c in Z_TARGETS:
        z = f"(({c} - {src_mu}.mu_{c}) / ({src_mu}.sd_{c} + 1e-9))"
        out.append(f"round(CASE WHEN {z} IS NOT NULL THEN least(greatest({z}, -10.0), 10.0) END, 6) AS z_{c}")
        out.append(f"coalesce(CAST(abs({z}) > 3.0 AS INTEGER), 0) AS zflag_{c}")
        flags.append(f"coalesce(CAST(abs({z}) > 3.0 AS INTEGER), 0)")
    out.append("(" + " + ".join(flags) + ") AS z_composite_score")
    return ", ".join(out)


def _chain(body, *extra):
    return with_views(body, "acct_raw", extra=A.CHAIN + (("rs", SQL_ROW_STATS), ("zt", SQL_ZT)) + tuple(extra))


def behaviour_table(spark, sf_dir):
    """Clean accounts + row moments (phase-two input, persisted once per application)."""
    from riskloom.sources.artifacts import materialized

    return materialized(spark, "behaviour", sf_dir, lambda: features.add_row_stats(A.clean(spark, sf_dir)))


def _r6z(df):
    return df.select(*[round6(c).alias(c) if c.startswith("z_") and c != "z_composite_score" else F.col(c)
                       for c in df.columns])


@query("zscores", _chain(f"SELECT account_id, {_zcols()} FROM zt, zp p", ("zp", SQL_ZP)))
def q_zscores(spark, sf_dir):
    return _r6z(fitted.zscores(behaviour_table(spark, sf_dir), Z_TARGETS))


SQL_ZFOLDS = """SELECT *, CAST((row_number() OVER (PARTITION BY y ORDER BY md5(concat('42', '|', CAST(account_id AS VARCHAR))),
                account_id) - 1) % 5 AS INTEGER) AS fold FROM zt"""
SQL_ZFP = ("SELECT h.i AS held_out, " + ", ".join(f"avg(z.{c}) AS mu_{c}, stddev_samp(z.{c}) AS sd_{c}" for c in Z_TARGETS)
           + " FROM zf z, range(5) h(i) WHERE z.fold <> h.i GROUP BY h.i")


@query("fold_zscores", _chain(f"SELECT account_id, fold, {_zcols()} FROM zf JOIN zfp p ON zf.fold = p.held_out",
                              ("zf", SQL_ZFOLDS), ("zfp", SQL_ZFP)))
def q_fold_zscores(spark, sf_dir):
    b = folds.stratified_folds(behaviour_table(spark, sf_dir))
    return _r6z(fitted.fold_zscores(b, Z_TARGETS))


@query("strip_families", _chain(
    "SELECT account_id, y, " + ", ".join(A.PRE_IMPUTE_COLS) + ", beh_row_mean, beh_row_std, beh_row_skew, beh_row_kurt, "
    "beh_row_max, beh_row_min, beh_row_range, beh_row_q75_q25 FROM zt"))
def q_strip_families(spark, sf_dir):
    b = behaviour_table(spark, sf_dir)
    z = fitted.zscores(b, Z_TARGETS, keep=b.columns)
    return profile.strip_prefixed(z)


SQL_VEC_LONG = ("SELECT v.account_id, v.y, CAST(u.pos - 1 AS INTEGER) AS pos, CAST(u.x AS DOUBLE) AS x FROM vec_accounts v, "
                "unnest(v.features) WITH ORDINALITY AS u(x, pos)")


@query("standardize", with_views(
    """SELECT l.account_id, l.pos, round((l.x - m.mean) / CASE WHEN m.sd = 0 THEN 1.0 ELSE m.sd END, 6) AS z
       FROM vl l JOIN (SELECT pos, avg(x) AS mean, stddev_pop(x) AS sd FROM vl GROUP BY pos) m ON l.pos = m.pos""",
    "vec_accounts", extra=(("vl", SQL_VEC_LONG),)))
def q_standardize(spark, sf_dir):
    v = fixture(spark, sf_dir, "vec_accounts").withColumn("features", F.col("features").cast("array<double>"))
    s = fitted.standardize(v)
    return s.select("account_id", F.posexplode("features_std").alias("pos", "z")).select(
        "account_id", "pos", round6("z").alias("z"))


@query("recon_flag", with_views(
    """SELECT account_id, round(prob, 6) AS score, CAST(prob > (SELECT quantile_cont(prob, 0.99) FROM scored) AS INTEGER) AS flag
       FROM scored""", "scored_events", extra=(("scored", common.SQL_SCORED),)))
def q_recon_flag(spark, sf_dir):
    s = common.scored(spark, sf_dir)
    f = fitted.percentile_flag(s, "prob", out="flag")
    return f.select("account_id", round6("prob").alias("score"), "flag")


MI_COLS = A.PRE_IMPUTE_COLS
SQL_MI = f"""SELECT feature, sum((n / t) * ln((n * t) / (nb * ny))) AS mi FROM (
  SELECT feature, bin, y, n, sum(n) OVER (PARTITION BY feature) AS t,
         sum(n) OVER (PARTITION BY feature, bin) AS nb, sum(n) OVER (PARTITION BY feature, y) AS ny FROM (
    SELECT l.feature, CASE WHEN r.hi = r.lo THEN 0 ELSE least(floor((l.value - r.lo) / (r.hi - r.lo) * 16), 15) END AS bin,
           l.y, count(*) AS n
    FROM cl l JOIN (SELECT feature, min(value) AS lo, max(value) AS hi FROM cl WHERE value IS NOT NULL GROUP BY feature) r
      ON l.feature = r.feature WHERE l.value IS NOT NULL GROUP BY 1, 2, 3))
GROUP BY feature"""


@query("mi_binned", _chain("SELECT feature, round(mi, 6) AS mi FROM mi",
                           ("cl", A.sql_long("clean", MI_COLS)), ("mi", SQL_MI)))
def q_mi_binned(spark, sf_dir):
    c = A.clean(spark, sf_dir)
    m = fitted.mi_binned(to_long(c, list(MI_COLS)))
    return m.select("feature", round6("mi").alias("mi"))


@query("select_features", _chain(
    f"""SELECT feature, CAST(mi_rank AS INTEGER) AS mi_rank, must_keep,
               round(coalesce(max(CASE WHEN mi_rank = {TOP_N} THEN mi END) OVER (), 0.0), 6) AS mi_threshold
        FROM (SELECT feature, mi, row_number() OVER (ORDER BY round(mi, 9) DESC, feature) AS mi_rank,
                     {selection.sql_must_keep('feature', A.KEYS)} AS must_keep FROM mi)
        QUALIFY mi_rank <= {TOP_N} OR must_keep""",
    ("cl", A.sql_long("clean", MI_COLS)), ("mi", SQL_MI)))
def q_select_features(spark, sf_dir):
    c = A.clean(spark, sf_dir)
    m = fitted.mi_binned(to_long(c, list(MI_COLS)))
    return selection.select_features(m, A.KEYS, top_n=TOP_N)
