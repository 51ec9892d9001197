"""The same operators on the text-derived account table (``doc_accounts``):
encoder choice and ordinal codes (O-24..O-26), class contrast (O-79) and binned
mutual information (O-48b)."""

from __future__ import annotations

from riskloom.functions.scoring import round6
from riskloom.operators import encode, fitted, profile
from riskloom.operators.catalog import to_long
from riskloom.plans.registry import query
from riskloom.sources.fixtures import fixture, with_views

DOC_STRINGS = ("s_lang", "s_source")
DOC_NUMERIC = ("f_chars", "f_spaces")


def _docs(spark, sf_dir):
    return fixture(spark, sf_dir, "doc_accounts")


def _labelled(spark, sf_dir):
    """The documents that have a label: class statistics need it, encodings don't."""
    return _docs(spark, sf_dir).where("y IS NOT NULL")


def _v(body, *extra):
    return with_views(body, "doc_accounts", extra=tuple(extra))


@query("doc_encode_plan", _v(
    "SELECT feature, n_distinct, CASE WHEN n_distinct <= 50 THEN 'ordinal' ELSE 'frequency' END AS encoding FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS n_distinct FROM doc_accounts"
                         for c in DOC_STRINGS) + ")"))
def q_doc_encode_plan(spark, sf_dir):
    return encode.encode_plan(_docs(spark, sf_dir), {}, DOC_STRINGS)


def _codes(c):
    return (f"SELECT category, CAST(dense_rank() OVER (ORDER BY category) - 1 AS DOUBLE) AS code FROM "
            f"(SELECT DISTINCT coalesce(CAST({c} AS VARCHAR), 'nan') AS category FROM doc_accounts)")


@query("doc_encoded", _v(
    """SELECT d.account_id, coalesce(a.code, -1.0) AS s_lang, coalesce(b.code, -1.0) AS s_source FROM doc_accounts d
       LEFT JOIN lang_codes a ON coalesce(d.s_lang, 'nan') = a.category
       LEFT JOIN source_codes b ON coalesce(d.s_source, 'nan') = b.category""",
    ("lang_codes", _codes("s_lang")), ("source_codes", _codes("s_source"))))
def q_doc_encoded(spark, sf_dir):
    d = _docs(spark, sf_dir)
    plan = encode.encode_plan(d, {}, DOC_STRINGS).collect()  # one row per string column
    return encode.apply_encodings(d, plan, {}).select("account_id", "s_lang", "s_source")


_LONG = " UNION ALL ".join(f"SELECT account_id, y, '{c}' AS feature, {c} AS value FROM doc_accounts WHERE y IS NOT NULL" for c in DOC_NUMERIC)


@query("doc_class_contrast", _v(
    """SELECT feature, round(avg(value) FILTER (WHERE y = 1), 6) AS mean_pos,
              round(avg(value) FILTER (WHERE y = 0), 6) AS mean_neg,
              round(avg(value) FILTER (WHERE y = 1) / (avg(value) FILTER (WHERE y = 0) + 1e-9), 6) AS ratio,
              round(CASE WHEN count(value) >= 3 AND var_pop(value) > 0 THEN skewness(value) END, 6) AS skew
       FROM dl GROUP BY feature""", ("dl", _LONG)))
def q_doc_class_contrast(spark, sf_dir):
    c = profile.class_contrast(_labelled(spark, sf_dir), list(DOC_NUMERIC))
    return c.select("feature", *[round6(x).alias(x) for x in ("mean_pos", "mean_neg", "ratio", "skew")])


@query("doc_mi_binned", _v(
    """SELECT feature, round(sum((n / t) * ln((n * t) / (nb * ny))), 6) AS mi FROM (
         SELECT feature, bin, y, n, sum(n) OVER (PARTITION BY feature) AS t,
                sum(n) OVER (PARTITION BY feature, bin) AS nb, sum(n) OVER (PARTITION BY feature, y) AS ny FROM (
           SELECT l.feature, CASE WHEN r.hi = r.lo THEN 0 ELSE least(floor((l.value - r.lo) / (r.hi - r.lo) * 16), 15) END AS bin,
                  l.y, count(*) AS n
           FROM dl l JOIN (SELECT feature, min(value) AS lo, max(value) AS hi FROM dl GROUP BY feature) r
             ON l.feature = r.feature GROUP BY 1, 2, 3))
       GROUP BY feature""", ("dl", _LONG)))
def q_doc_mi_binned(spark, sf_dir):
    m = fitted.mi_binned(to_long(_labelled(spark, sf_dir), list(DOC_NUMERIC)))
    return m.select("feature", round6("mi").alias("mi"))
