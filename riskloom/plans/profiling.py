"""Load, class profile, leakage, missingness, variance, contrasts (O-01, O-02,
O-10..O-15, O-18, O-79, O-81) on the raw account fixture."""

from __future__ import annotations


from riskloom.functions.scoring import round6
from riskloom.operators import profile
from riskloom.plans import accounts as A
from riskloom.plans.registry import query
from riskloom.sources import accounts as src
from riskloom.sources.fixtures import with_views


def _v(body, *extra):
    return with_views(body, "acct_raw", extra=tuple(extra))


ALL_RAW = ("account_id", "y") + A.NUMERIC + A.STRINGS


@query("load_accounts", _v(f"SELECT {', '.join(ALL_RAW)} FROM acct_raw"))
def q_load_accounts(spark, sf_dir):
    return src.prepare_accounts(A.raw(spark, sf_dir), target="y")


@query("class_profile", _v(
    """SELECT count(*) AS n_rows, CAST(count_if(y = 1) AS BIGINT) AS n_pos, CAST(count_if(y = 0) AS BIGINT) AS n_neg,
              round(count_if(y = 0) / nullif(count_if(y = 1), 0), 6) AS imbalance,
              round(count_if(y = 1) / count(*), 6) AS pos_rate FROM acct_raw"""))
def q_class_profile(spark, sf_dir):
    p = profile.class_profile(A.raw(spark, sf_dir))
    return p.select("n_rows", "n_pos", "n_neg", round6("imbalance").alias("imbalance"),
                    round6("pos_rate").alias("pos_rate"))


SQL_LONG_NUM = ("raw_long", A.sql_long("acct_raw", A.NUMERIC))
SQL_CORR = """SELECT feature, n, r, abs(r) AS abs_r,
       CASE WHEN abs(r) > 0.8 THEN 'hard' WHEN abs(r) > 0.25 THEN 'soft' ELSE 'none' END AS leak_class
FROM (SELECT feature, count(*) AS n,
             CASE WHEN stddev_samp(value) = 0 OR stddev_samp(CAST(y AS DOUBLE)) = 0 THEN NULL
                  ELSE covar_samp(value, CAST(y AS DOUBLE)) / (stddev_samp(value) * stddev_samp(CAST(y AS DOUBLE))) END AS r
      FROM raw_long WHERE value IS NOT NULL GROUP BY feature)"""


@query("leakage_corr", _v("SELECT feature, n, round(r, 6) AS r, round(abs_r, 6) AS abs_r, leak_class FROM corr",
                          SQL_LONG_NUM, ("corr", SQL_CORR)))
def q_leakage_corr(spark, sf_dir):
    c = profile.target_correlation(A.raw(spark, sf_dir))
    return c.select("feature", "n", round6("r").alias("r"), round6("abs_r").alias("abs_r"), "leak_class")


@query("leakage_crosstab", _v(
    """SELECT l.feature, l.value, l.y, count(*) AS n FROM raw_long l
       WHERE l.feature IN (SELECT feature FROM corr WHERE leak_class = 'hard') GROUP BY l.feature, l.value, l.y""",
    SQL_LONG_NUM, ("corr", SQL_CORR)))
def q_leakage_crosstab(spark, sf_dir):
    raw = A.raw(spark, sf_dir)
    c = profile.target_correlation(raw)
    return profile.leak_crosstab(raw, c.where("leak_class = 'hard'"))


SQL_MISSING = ("SELECT feature, avg(CAST(value IS NULL AS DOUBLE)) AS null_frac FROM ("
               + " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS value FROM acct_raw" if c in A.NUMERIC else
                                    f"SELECT '{c}', CASE WHEN {c} IS NULL THEN NULL ELSE 0.0 END FROM acct_raw"
                                    for c in A.NUMERIC + A.STRINGS)
               + ") GROUP BY feature")


@query("missing_profile", _v("SELECT feature, round(null_frac, 6) AS null_frac, null_frac = 1.0 AS empty FROM mp",
                             ("mp", SQL_MISSING)))
def q_missing_profile(spark, sf_dir):
    m = profile.missing_profile(A.raw(spark, sf_dir))
    return m.select("feature", round6("null_frac").alias("null_frac"), "empty")


@query("missing_bins", _v(
    """SELECT b.bin, b.label, CAST(coalesce(c.n, 0) AS BIGINT) AS n_features
       FROM (VALUES (0, '0% (complete)'), (1, '0-10%'), (2, '10-50%'), (3, '50-100%'), (4, '100% (empty)')) b(bin, label)
       LEFT JOIN (SELECT CASE WHEN null_frac > -0.001 AND null_frac <= 0.0 THEN 0
                              WHEN null_frac > 0.0 AND null_frac <= 0.1 THEN 1
                              WHEN null_frac > 0.1 AND null_frac <= 0.5 THEN 2
                              WHEN null_frac > 0.5 AND null_frac <= 0.9999 THEN 3
                              WHEN null_frac > 0.9999 AND null_frac <= 1.0001 THEN 4 END AS bin, count(*) AS n
                  FROM mp GROUP BY 1) c ON b.bin = c.bin""", ("mp", SQL_MISSING)))
def q_missing_bins(spark, sf_dir):
    return profile.missing_bins(profile.missing_profile(A.raw(spark, sf_dir)))


@query("low_variance", _v(
    """SELECT feature, round(var_pop(coalesce(value, 0.0)), 6) AS variance, var_pop(coalesce(value, 0.0)) > 0.001 AS keep
       FROM raw_long GROUP BY feature""", SQL_LONG_NUM))
def q_low_variance(spark, sf_dir):
    v = profile.low_variance(A.raw(spark, sf_dir))
    return v.select("feature", round6("variance").alias("variance"), "keep")


@query("drop_named", _v(f"SELECT * EXCLUDE (f_leak) FROM acct_raw"))
def q_drop_named(spark, sf_dir):
    return profile.drop_columns(A.raw(spark, sf_dir), A.NAMED_LEAKS)


@query("class_contrast", _v(
    """SELECT feature, round(avg(value) FILTER (WHERE y = 1), 6) AS mean_pos,
              round(avg(value) FILTER (WHERE y = 0), 6) AS mean_neg,
              round(avg(value) FILTER (WHERE y = 1) / (avg(value) FILTER (WHERE y = 0) + 1e-9), 6) AS ratio,
              round(CASE WHEN count(value) >= 3 AND var_pop(value) > 0 THEN skewness(value) END, 6) AS skew
       FROM raw_long GROUP BY feature""", SQL_LONG_NUM))
def q_class_contrast(spark, sf_dir):
    c = profile.class_contrast(A.raw(spark, sf_dir))
    return c.select("feature", *[round6(x).alias(x) for x in ("mean_pos", "mean_neg", "ratio", "skew")])


@query("binary_feature_rates", _v(
    """SELECT feature, n_ones, round(rate, 6) AS rate, CAST(row_number() OVER (ORDER BY abs(rate) DESC, feature) AS INTEGER) AS rank
       FROM (SELECT feature, count(DISTINCT value) AS n_distinct, CAST(count_if(value = 1) AS BIGINT) AS n_ones,
                    avg(CAST(y AS DOUBLE)) FILTER (WHERE value = 1) AS rate
             FROM raw_long GROUP BY feature) WHERE n_distinct = 2 AND n_ones > 10
       QUALIFY row_number() OVER (ORDER BY abs(rate) DESC, feature) <= 5""", SQL_LONG_NUM))
def q_binary_feature_rates(spark, sf_dir):
    b = profile.binary_feature_rates(A.raw(spark, sf_dir), prefix="f_")
    return b.select("feature", "n_ones", round6("rate").alias("rate"), "rank")
