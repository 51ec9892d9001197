"""Linear scorer with exact contributions, global importance, alert cards.

Contributions live in an array of structs on the account's row, so the top-k
factor choice is a per-row array sort (no shuffle); the long form
``(account_id, feature, value, shap)`` is one explode away for global statistics.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.params import attach_params
from riskloom.functions.scoring import action_col, magnitude_col, tier_col
from riskloom.operators.catalog import family_of

TOP_RISK = 5
TOP_PROTECTIVE = 3
# Narrative template pieces.
NARRATIVE_HEAD = "Account flagged with risk score "
NO_FACTOR = "multiple factors"


def fit_linear_scorer(df: DataFrame, features: Sequence[str], label: str = "y",
                      fit_filter: Column | None = None) -> DataFrame:
    """Closed-form linear scorer on standardised features:
    w_j = mean(z_j | y=1) - mean(z_j | y=0), z_j = (x_j - mean_j) / std_j (population
    std, zero -> 1), intercept = logit(positive rate).

    Statistics are one ``groupBy(feature)`` over the long form (partial aggregation,
    one row per feature per task); the result is one row holding the intercept and
    per-feature arrays in column order (bounded by the feature count)."""
    from riskloom.operators.catalog import to_long

    fit = df if fit_filter is None else df.where(fit_filter)
    pos = {f: i for i, f in enumerate(features)}
    long = to_long(fit, list(features), label=label)
    st = long.groupBy("feature").agg(
        F.avg("value").alias("mu"), F.stddev_pop("value").alias("sd0"),
        F.avg(F.when(F.col(label) == 1, F.col("value"))).alias("m1"),
        F.avg(F.when(F.col(label) != 1, F.col("value"))).alias("m0"))
    posmap = F.create_map(*[x for f, i in pos.items() for x in (F.lit(f), F.lit(i))])
    sd = F.when(F.col("sd0") == 0, F.lit(1.0)).otherwise(F.col("sd0"))
    st = st.select(posmap[F.col("feature")].alias("pos"), "mu", sd.alias("sd"),
                   F.coalesce((F.col("m1") - F.col("m0")) / sd, F.lit(0.0)).alias("w"))
    packed = st.agg(F.array_sort(F.collect_list(F.struct("pos", "mu", "sd", "w"))).alias("_p"))
    rate = fit.agg(F.avg(F.col(label).cast("double")).alias("_rate"))
    one = attach_params(packed, rate)
    return one.select(F.log(F.try_divide(F.col("_rate"), 1 - F.col("_rate"))).alias("intercept"),
                      F.transform("_p", lambda x: x["mu"]).alias("mu"),
                      F.transform("_p", lambda x: x["sd"]).alias("sd"),
                      F.transform("_p", lambda x: x["w"]).alias("w"))


def linear_contributions(df: DataFrame, params: DataFrame, features: Sequence[str]) -> DataFrame:
    """Adds ``contrib`` = array<struct<feature, value, shap>> with shap_j = w_j z_j,
    ``margin`` = intercept + sum(shap) and ``prob`` = sigmoid(margin). Row-local."""
    j = attach_params(df, params)
    names = F.array(*[F.lit(f) for f in features])
    vals = F.array(*[F.col(f).cast("double") for f in features])
    contrib = F.transform(vals, lambda x, i: F.struct(
        names[i].alias("feature"), x.alias("value"),
        (F.col("w")[i] * (x - F.col("mu")[i]) / F.col("sd")[i]).alias("shap")))
    out = j.withColumn("contrib", contrib)
    out = out.withColumn("margin", F.col("intercept") + F.aggregate("contrib", F.lit(0.0), lambda a, x: a + x["shap"]))
    out = out.withColumn("prob", 1.0 / (1.0 + F.exp(-F.col("margin"))))
    return out.drop("intercept", "mu", "sd", "w")


def contrib_long(df: DataFrame, keep: Sequence[str] = ("account_id", "y")) -> DataFrame:
    return df.select(*keep, F.explode("contrib").alias("c")).select(*keep, "c.feature", "c.value", "c.shap")


def global_importance(long: DataFrame, label: str = "y") -> DataFrame:
    """Mean |shap|, mean shap for positives and negatives, direction; joined by name."""
    g = long.groupBy("feature").agg(
        F.avg(F.abs("shap")).alias("importance"),
        F.avg(F.when(F.col(label) == 1, F.col("shap"))).alias("mean_shap_pos"),
        F.avg(F.when(F.col(label) != 1, F.col("shap"))).alias("mean_shap_neg"),
    )
    return g.withColumn("direction", F.when(F.col("mean_shap_pos") > 0, "up").otherwise("down"))


# Importance categories by prefix, in the reference's order.
CATEGORIES = (
    ("Raw", None), ("Behavioural (beh_)", ("beh_",)), ("Z-score (z_)", ("z_", "zflag_")),
    ("Interactions (int_)", ("int_",)), ("Missingness (miss_)", ("miss_",)), ("Meta (meta_)", ("meta_",)),
    ("Temporal (feat_)", ("feat_",)),
)


def category_col(feature: Column, raw_prefixes: Sequence[str]) -> Column:
    out = None
    for name, prefixes in CATEGORIES:
        ps = tuple(raw_prefixes) if prefixes is None else prefixes
        cond = None
        for p in ps:
            c = feature.startswith(p)
            cond = c if cond is None else (cond | c)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out


def importance_by_category(gi: DataFrame, raw_prefixes: Sequence[str] = ("F",)) -> DataFrame:
    """Count, total and mean importance per category; empty categories hidden and
    features of no category (ratio_, iforest_, ae_) left out."""
    c = gi.withColumn("category", category_col(F.col("feature"), raw_prefixes)).where(F.col("category").isNotNull())
    return c.groupBy("category").agg(F.count(F.lit(1)).alias("n_features"), F.sum("importance").alias("total"),
                                     F.avg("importance").alias("mean"))


def card_columns(score: str = "risk_score", prob: str = "prob", protective: str = "weakest") -> dict[str, Column]:
    """Top-5 positive factors (largest first), three protective factors, tier,
    action and narrative, from the row's ``contrib`` array.

    ``protective='weakest'`` takes the head of the descending order among negative
    contributions (the reference's choice); 'strongest' takes the most negative."""
    by_desc = F.array_sort("contrib", lambda a, b: F.when(a["shap"] > b["shap"], -1).when(a["shap"] < b["shap"], 1)
                           .otherwise(F.when(a["feature"] < b["feature"], -1).when(a["feature"] > b["feature"], 1)
                                      .otherwise(0)))
    pos = F.slice(F.filter(by_desc, lambda x: x["shap"] > 0), 1, TOP_RISK)
    neg_all = F.filter(by_desc, lambda x: x["shap"] < 0)
    neg = F.slice(neg_all, 1, TOP_PROTECTIVE) if protective == "weakest" else F.slice(F.reverse(neg_all), 1, TOP_PROTECTIVE)
    top = F.transform(pos, lambda x: F.struct(x["feature"].alias("feature"), x["value"].alias("value"),
                                              x["shap"].alias("shap_contrib"), magnitude_col(x["shap"]).alias("magnitude")))
    prot = F.transform(neg, lambda x: F.struct(x["feature"].alias("feature"), x["value"].alias("value"),
                                               x["shap"].alias("shap_contrib")))
    tier = tier_col(score)
    first = F.try_element_at(pos, F.lit(1))
    driver = F.coalesce(first["feature"], F.lit(NO_FACTOR))
    contrib_txt = F.when(first.isNotNull(), F.format_string(" (contribution: +%.4f)", first["shap"])).otherwise(F.lit(""))
    narrative = F.concat(
        F.lit(NARRATIVE_HEAD), F.col(score).cast("string"), F.lit("/1000. Primary risk driver: "), driver, contrib_txt,
        F.lit(". Base probability: "), F.format_string("%.1f%%", F.col(prob) * 100), F.lit(". Recommended action: "),
        action_col(tier), F.lit(""))
    return {"tier": tier, "action": action_col(tier), "top_risk_factors": top, "protective_factors": prot,
            "narrative": narrative}


def waterfall(long_one: DataFrame, top: int = 15) -> DataFrame:
    """One account's contributions: top ``top`` by |shap|, ordered by shap, labelled."""
    from pyspark.sql import Window

    w = Window.partitionBy("account_id").orderBy(F.abs("shap").desc(), F.col("feature"))
    r = long_one.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= top)
    w2 = Window.partitionBy("account_id").orderBy(F.col("shap"), F.col("feature"))
    return r.select("account_id", "feature", "shap",
                    F.concat_ws(" = ", "feature", F.format_string("%.3f", F.col("value"))).alias("label"),
                    F.row_number().over(w2).alias("bar"))


def family_table(features: Sequence[str]) -> list[tuple[str, str]]:
    return [(f, family_of(f)) for f in features]
