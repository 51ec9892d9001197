"""Linear contributions, importance, cards, narratives, typology (O-34..O-39,
O-71..O-74, O-82, O-88, O-89, O-93, O-100) on the clean account table."""

from __future__ import annotations


from pyspark.sql import functions as F

from riskloom.functions.scoring import round6
from riskloom.functions.typology import dominant_col, typology_columns
from riskloom.operators import alerts, explain
from riskloom.plans import accounts as A
from riskloom.plans import common
from riskloom.plans.registry import query
from riskloom.sources.fixtures import with_views

FEATS = A.PRE_IMPUTE_COLS
RAW_PREFIXES = ("f_", "s_")


def scored_accounts(spark, sf_dir):
    """Clean accounts scored by the closed-form linear scorer, calibrated and tiered
    (persisted once per application)."""
    from riskloom.sources.artifacts import materialized

    def build():
        c = A.clean(spark, sf_dir)
        params = explain.fit_linear_scorer(c, FEATS)
        s = explain.linear_contributions(c, params, FEATS)
        return alerts.risk_scores(s, "prob")

    return materialized(spark, "scored_accounts", sf_dir, build)


# --- SQL chain ----------------------------------------------------------------
SQL_LP = ("SELECT avg(CAST(y AS DOUBLE)) AS rate, " + ", ".join(
    f"avg({f}) AS mu_{f}, CASE WHEN stddev_pop({f}) = 0 THEN 1.0 ELSE stddev_pop({f}) END AS sd_{f}, "
    f"avg({f}) FILTER (WHERE y = 1) AS m1_{f}, avg({f}) FILTER (WHERE y <> 1) AS m0_{f}" for f in FEATS) + " FROM clean")
SQL_LW = ("SELECT ln(rate / (1 - rate)) AS intercept, " + ", ".join(
    f"mu_{f}, sd_{f}, coalesce((m1_{f} - m0_{f}) / sd_{f}, 0.0) AS w_{f}" for f in FEATS) + " FROM lp")
SQL_LC = " UNION ALL ".join(
    f"SELECT c.account_id, c.y, '{f}' AS feature, c.{f} AS value, w.w_{f} * (c.{f} - w.mu_{f}) / w.sd_{f} AS shap "
    f"FROM clean c, lw w" for f in FEATS)
SQL_LS = ("SELECT *, 1.0 / (1.0 + exp(-margin)) AS prob FROM (SELECT c.*, w.intercept + ("
          + " + ".join(f"w.w_{f} * (c.{f} - w.mu_{f}) / w.sd_{f}" for f in FEATS) + ") AS margin FROM clean c, lw w)")
SQL_LCAL = "SELECT quantile_cont(prob, 0.01) AS p1, quantile_cont(prob, 0.99) AS p99 FROM ls"
SQL_LT = (f"SELECT *, {common.sql_tier_case('risk_score')} AS tier FROM "
          f"(SELECT s.*, {common.sql_score('s.prob', 'k.p1', 'k.p99')} AS risk_score FROM ls s, lcal k)")
LIN = (("lp", SQL_LP), ("lw", SQL_LW), ("lc", SQL_LC), ("ls", SQL_LS), ("lcal", SQL_LCAL), ("lt", SQL_LT))


def _v(body, *extra):
    return with_views(body, "acct_raw", extra=A.CHAIN + LIN + tuple(extra))


@query("linear_contrib", _v("SELECT account_id, feature, round(value, 6) AS value, round(shap, 6) AS shap FROM lc"))
def q_linear_contrib(spark, sf_dir):
    s = scored_accounts(spark, sf_dir)
    lg = explain.contrib_long(s, keep=("account_id",))
    return lg.select("account_id", "feature", round6("value").alias("value"), round6("shap").alias("shap"))


@query("account_scores", _v("SELECT account_id, y, round(margin, 6) AS margin, round(prob, 6) AS prob, risk_score, tier FROM lt"))
def q_account_scores(spark, sf_dir):
    s = scored_accounts(spark, sf_dir)
    return s.select("account_id", "y", round6("margin").alias("margin"), round6("prob").alias("prob"), "risk_score", "tier")


SQL_GI = """SELECT feature, avg(abs(shap)) AS importance, avg(shap) FILTER (WHERE y = 1) AS mean_shap_pos,
                   avg(shap) FILTER (WHERE y <> 1) AS mean_shap_neg,
                   CASE WHEN avg(shap) FILTER (WHERE y = 1) > 0 THEN 'up' ELSE 'down' END AS direction
            FROM lc GROUP BY feature"""


def _gi(spark, sf_dir):
    return explain.global_importance(explain.contrib_long(scored_accounts(spark, sf_dir)))


@query("global_importance", _v(
    "SELECT feature, round(importance, 6) AS importance, round(mean_shap_pos, 6) AS mean_shap_pos, "
    "round(mean_shap_neg, 6) AS mean_shap_neg, direction FROM gi", ("gi", SQL_GI)))
def q_global_importance(spark, sf_dir):
    g = _gi(spark, sf_dir)
    return g.select("feature", *[round6(c).alias(c) for c in ("importance", "mean_shap_pos", "mean_shap_neg")], "direction")


def _sql_category():
    parts = []
    for name, prefixes in explain.CATEGORIES:
        ps = RAW_PREFIXES if prefixes is None else prefixes
        cond = " OR ".join(f"starts_with(feature, '{p}')" for p in ps)
        parts.append(f"WHEN {cond} THEN '{name}'")
    return "CASE " + " ".join(parts) + " END"


@query("importance_by_family", _v(
    f"""SELECT category, count(*) AS n_features, round(sum(importance), 6) AS total, round(avg(importance), 6) AS mean
        FROM (SELECT {_sql_category()} AS category, importance FROM gi) WHERE category IS NOT NULL GROUP BY category""",
    ("gi", SQL_GI)))
def q_importance_by_family(spark, sf_dir):
    c = explain.importance_by_category(_gi(spark, sf_dir), RAW_PREFIXES)
    return c.select("category", "n_features", round6("total").alias("total"), round6("mean").alias("mean"))


SQL_RANKED_FACTORS = """SELECT account_id, feature, value, shap,
       row_number() OVER (PARTITION BY account_id, shap > 0 ORDER BY shap DESC, feature) AS r
FROM lc WHERE shap <> 0"""


@query("alert_cards", _v(
    """SELECT account_id, CASE WHEN shap > 0 THEN 'risk' ELSE 'protective' END AS kind, CAST(r AS INTEGER) AS rank,
              feature, round(value, 6) AS value, round(shap, 6) AS shap_contrib,
              CASE WHEN shap > 0.1 THEN 'HIGH' WHEN shap > 0.05 THEN 'MEDIUM' WHEN shap > 0 THEN 'LOW' END AS magnitude
       FROM rf WHERE (shap > 0 AND r <= 5) OR (shap < 0 AND r <= 3)""", ("rf", SQL_RANKED_FACTORS)))
def q_alert_cards(spark, sf_dir):
    s = scored_accounts(spark, sf_dir)
    cols = explain.card_columns()
    cards = s.select("account_id", cols["top_risk_factors"].alias("risk"), cols["protective_factors"].alias("prot"))
    risk = cards.select("account_id", F.lit("risk").alias("kind"), F.posexplode("risk").alias("rank", "f")).select(
        "account_id", "kind", (F.col("rank") + 1).alias("rank"), "f.feature", round6("f.value").alias("value"),
        round6("f.shap_contrib").alias("shap_contrib"), F.col("f.magnitude").alias("magnitude"))
    prot = cards.select("account_id", F.lit("protective").alias("kind"), F.posexplode("prot").alias("rank", "f")).select(
        "account_id", "kind", (F.col("rank") + 1).alias("rank"), "f.feature", round6("f.value").alias("value"),
        round6("f.shap_contrib").alias("shap_contrib"), F.lit(None).cast("string").alias("magnitude"))
    return risk.unionByName(prot)


_NARR = ("concat('" + explain.NARRATIVE_HEAD + "', CAST(t.risk_score AS VARCHAR), '/1000. Primary risk driver: ', "
         "coalesce(f.feature, '" + explain.NO_FACTOR + "'), "
         "CASE WHEN f.feature IS NULL THEN '' ELSE printf(' (contribution: +%.4f)', f.shap) END, "
         "'. Base probability: ', printf('%.1f%%', t.prob * 100), '. Recommended action: ', "
         + common.sql_action_case("t.tier") + ")")


@query("narratives", _v(
    f"""SELECT t.account_id, t.tier, {common.sql_action_case('t.tier')} AS action, {_NARR} AS narrative
        FROM lt t LEFT JOIN (SELECT * FROM rf WHERE shap > 0 AND r = 1) f ON t.account_id = f.account_id""",
    ("rf", SQL_RANKED_FACTORS)))
def q_narratives(spark, sf_dir):
    s = scored_accounts(spark, sf_dir)
    cols = explain.card_columns()
    return s.select("account_id", cols["tier"].alias("tier"), cols["action"].alias("action"),
                    cols["narrative"].alias("narrative"))


@query("top_alerts", _v(
    """SELECT t.account_id, t.risk_score, t.tier, f.feature AS top_feature, round(f.shap, 6) AS top_shap
       FROM (SELECT * FROM lt ORDER BY risk_score DESC, account_id LIMIT 5) t
       LEFT JOIN (SELECT * FROM rf WHERE shap > 0 AND r = 1) f ON t.account_id = f.account_id""",
    ("rf", SQL_RANKED_FACTORS)))
def q_top_alerts(spark, sf_dir):
    """Top-5 accounts by risk score with their card headline (a top-k report)."""
    s = scored_accounts(spark, sf_dir)
    cols = explain.card_columns()
    top = s.orderBy(F.col("risk_score").desc(), F.col("account_id")).limit(5)
    first = F.try_element_at(cols["top_risk_factors"], F.lit(1))
    return top.select("account_id", "risk_score", "tier", first["feature"].alias("top_feature"),
                      round6(first["shap_contrib"]).alias("top_shap"))


SQL_TOPPOS = "SELECT account_id FROM lt WHERE y = 1 ORDER BY risk_score DESC, md5(concat('42', '|', CAST(account_id AS VARCHAR))) LIMIT 1"


@query("waterfall", _v(
    """SELECT account_id, feature, round(shap, 6) AS shap, concat(feature, ' = ', printf('%.3f', value)) AS label,
              CAST(row_number() OVER (ORDER BY shap, feature) AS INTEGER) AS bar
       FROM (SELECT * FROM lc WHERE account_id = (SELECT account_id FROM tp) ORDER BY abs(shap) DESC, feature LIMIT 15)""",
    ("tp", SQL_TOPPOS)))
def q_waterfall(spark, sf_dir):
    s = scored_accounts(spark, sf_dir)
    from riskloom.operators import readside

    target = readside.nth_riskiest_positive(s, 1).select("account_id")
    lg = explain.contrib_long(s.join(target, "account_id", "left_semi"), keep=("account_id",))
    w = explain.waterfall(lg)
    return w.select("account_id", "feature", round6("shap").alias("shap"), "label", F.col("bar").cast("int"))


SQL_TOPFEAT = "SELECT feature FROM gi ORDER BY importance DESC, feature LIMIT 1"


@query("dependence", _v(
    """SELECT account_id, feature, round(value, 6) AS value, round(shap, 6) AS shap,
              CASE WHEN y = 1 THEN 'positive' ELSE 'negative' END AS label
       FROM lc WHERE feature = (SELECT feature FROM tf)""", ("gi", SQL_GI), ("tf", SQL_TOPFEAT)))
def q_dependence(spark, sf_dir):
    s = scored_accounts(spark, sf_dir)
    lg = explain.contrib_long(s)
    g = explain.global_importance(lg)
    top = g.orderBy(F.col("importance").desc(), F.col("feature")).limit(1).select("feature")
    d = lg.join(F.broadcast(top), "feature")  # one row
    return d.select("account_id", "feature", round6("value").alias("value"), round6("shap").alias("shap"),
                    F.when(F.col("y") == 1, "positive").otherwise("negative").alias("label"))


@query("contrib_fallback", _v(
    """SELECT t.account_id, g.feature, round(g.mean_shap_pos * (t.prob / 0.5), 6) AS shap
       FROM lt t, gi g""", ("gi", SQL_GI)))
def q_contrib_fallback(spark, sf_dir):
    """Contributions when no explainer is available: class mean x p / 0.5. The
    per-feature means are a catalog-sized table (broadcast)."""
    s = scored_accounts(spark, sf_dir)
    g = explain.global_importance(explain.contrib_long(s)).select("feature", "mean_shap_pos")
    from riskloom.operators import screen

    return screen.fallback_contributions(s.select("account_id", "prob"), g).select(
        "account_id", "feature", round6("shap").alias("shap"))


# --- typology ------------------------------------------------------------------
TYPO_ATTRS = dict(age="feat_account_age_bucket", occupation="s_segment", missing="meta_missing_ratio",
                  acct_type="s_nation", dow="feat_opening_dow")


def _typo_cols(dow=True):
    a = TYPO_ATTRS
    return typology_columns(F.col(a["age"]), F.col(a["occupation"]), F.col(a["missing"]), F.col(a["acct_type"]),
                            F.col(a["dow"]) if dow else None)


def _sql_typo(dow=True):
    a = TYPO_ATTRS
    w = (f"(CASE WHEN {a['age']} >= 5 THEN 0.3 ELSE 0.0 END + CASE WHEN {a['occupation']} <= 2 THEN 0.15 ELSE 0.0 END"
         f" + CASE WHEN {a['missing']} < 0.25 THEN 0.1 ELSE 0.0 END + CASE WHEN {a['acct_type']} <= 2 THEN 0.1 ELSE 0.0 END)")
    u = (f"(CASE WHEN {a['age']} >= 3 AND {a['age']} <= 4 THEN 0.2 ELSE 0.0 END"
         f" + CASE WHEN {a['occupation']} >= 6 THEN 0.25 ELSE 0.0 END)")
    s = (f"(CASE WHEN {a['age']} <= 2 THEN 0.4 ELSE 0.0 END + CASE WHEN {a['missing']} > 0.45 THEN 0.3 ELSE 0.0 END"
         f" + CASE WHEN {a['acct_type']} = 8 THEN 0.2 ELSE 0.0 END"
         + (f" + CASE WHEN {a['dow']} = 6 THEN 0.1 ELSE 0.0 END" if dow else "") + ")")
    w, u, s = (f"CAST({x} AS DOUBLE)" for x in (w, u, s))
    tot = f"({w} + {u} + {s} + 1e-9)"
    return f"round_even({w} / {tot}, 3) AS witting, round_even({u} / {tot}, 3) AS unwitting, round_even({s} / {tot}, 3) AS synthetic"


SQL_TYPO = f"SELECT account_id, y, risk_score, {_sql_typo()} FROM lt"


@query("account_typology", _v("SELECT account_id, witting, unwitting, synthetic FROM ty", ("ty", SQL_TYPO)))
def q_account_typology(spark, sf_dir):
    s = scored_accounts(spark, sf_dir)
    return s.select("account_id", *[v.alias(k) for k, v in _typo_cols().items()])


@query("typology_flagged", _v("SELECT account_id, risk_score, witting, unwitting, synthetic FROM ty WHERE risk_score >= 500",
                              ("ty", SQL_TYPO)))
def q_typology_flagged(spark, sf_dir):
    s = scored_accounts(spark, sf_dir).where(F.col("risk_score") >= 500)
    return s.select("account_id", "risk_score", *[v.alias(k) for k, v in _typo_cols().items()])


@query("dominant_type", _v(
    """SELECT CASE WHEN witting >= unwitting AND witting >= synthetic THEN 'witting'
                   WHEN unwitting >= synthetic THEN 'unwitting' ELSE 'synthetic' END AS dominant, count(*) AS n
       FROM ty WHERE y = 1 GROUP BY 1""", ("ty", SQL_TYPO)))
def q_dominant_type(spark, sf_dir):
    s = scored_accounts(spark, sf_dir).where(F.col("y") == 1)
    t = s.select(*[v.alias(k) for k, v in _typo_cols().items()])
    return t.groupBy(dominant_col(F.col("witting"), F.col("unwitting"), F.col("synthetic")).alias("dominant")).agg(
        F.count(F.lit(1)).alias("n"))


@query("typology_means", _v(
    "SELECT round(avg(witting), 6) AS witting, round(avg(unwitting), 6) AS unwitting, round(avg(synthetic), 6) AS synthetic "
    "FROM ty WHERE y = 1", ("ty", SQL_TYPO)))
def q_typology_means(spark, sf_dir):
    s = scored_accounts(spark, sf_dir).where(F.col("y") == 1)
    t = s.select(*[v.alias(k) for k, v in _typo_cols().items()])
    return t.agg(*[round6(F.avg(c)).alias(c) for c in ("witting", "unwitting", "synthetic")])
