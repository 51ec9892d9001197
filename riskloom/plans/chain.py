"""The connected training chain on the account table: behaviour table -> interactions -> folds ->
in-fold features -> selection -> member scores -> blend -> calibrated score and tier -> final boosted
member -> contributions -> cards (O-17, O-51..O-59, O-71..O-76).

Every step's output is written once per application and read by the next one. In-fold features
(z-scores, isolation forest, PCA error) of a row come from statistics that never saw its fold, both
for the members' scores and for the final member that explains them.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from riskloom.functions.scoring import round6
from riskloom.operators import alerts, anomaly, boosting, explain, features, fitted, folds, metrics, models, selection
from riskloom.operators.catalog import to_long
from riskloom.plans import accounts as A
from riskloom.plans.fitted import Z_TARGETS, behaviour_table
from riskloom.plans.registry import query
from riskloom.sources.artifacts import materialized, materialized_all

MEMBERS = models.NAMES
#: The member whose contributions explain an account.
EXPLAINED = "level"
_IDS = ("account_id", "y", "fold")


def by_account(left, right):
    """Inner join on the account by sorted shuffles. The chain's tables hold few distinct values, so a small file has
    many rows, and by its size Spark would send all of them through the driver as a broadcast."""
    return left.join(right.hint("merge"), "account_id")


def engineered(spark, sf_dir):
    """One row per account: clean, row, interaction and in-fold columns, label and fold."""

    def base():
        b = behaviour_table(spark, sf_dir)
        more = features.interaction_columns(b, A.KEYS, A.RATIOS, age_keys=A.AGE_KEYS)
        return folds.stratified_folds(b.select("*", *[v.alias(k) for k, v in more.items()]))

    def build():
        b = materialized(spark, "chain_base", sf_dir, base)
        vec = anomaly.with_anomaly_vector(b, A.KEYS).select(*_IDS, "features")
        z = fitted.fold_zscores(b, Z_TARGETS).drop("fold")
        forest = anomaly.fold_isolation_forest(vec).select(
            "account_id", F.col("if_score").alias("iforest_score"), F.col("if_decision").alias("iforest_decision"),
            F.col("if_anomaly").alias("iforest_anomaly"))
        error = anomaly.fold_pca_error(vec).withColumnRenamed("recon_error", "ae_recon_error")
        return b.join(z, "account_id").join(forest, "account_id").join(error, "account_id")

    return materialized(spark, "chain_engineered", sf_dir, build)


def selected(spark, sf_dir) -> list[str]:
    """The kept features, in rank order (one row per column on the driver)."""
    return [r["feature"] for r in selection_table(spark, sf_dir).orderBy("mi_rank").collect()]


def selection_table(spark, sf_dir):
    def build():
        t = engineered(spark, sf_dir)
        cols = [c for c in t.columns if c not in _IDS]
        return selection.select_features(fitted.mi_binned(to_long(t, cols)), A.KEYS)

    return materialized(spark, "chain_selection", sf_dir, build)


def training(spark, sf_dir):
    """(account_id, y, fold, features) over the selected features; an undefined value is 0."""

    def build():
        t, cols = engineered(spark, sf_dir), selected(spark, sf_dir)
        arr = F.array(*[F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(0.0)) for c in cols])
        return t.select(*_IDS, arr.alias("features"))

    return materialized(spark, "chain_training", sf_dir, build)


def trained(spark, sf_dir):
    """(node table, out-of-fold scores): all members on all folds and on all rows, saved by one run."""
    return materialized_all(spark, ("chain_nodes", "chain_members"), sf_dir, lambda: models.train(training(spark, sf_dir)))


def member_scores(spark, sf_dir):
    return trained(spark, sf_dir)[1]


def weights(spark, sf_dir):
    """(member, ap, weight), as ``metrics.blend_weights`` gives them."""
    return materialized(spark, "chain_weights", sf_dir, lambda: metrics.blend_weights(member_scores(spark, sf_dir)))


def blended(spark, sf_dir):
    """Out-of-fold member scores, their blend by average precision, score and tier."""

    def build():
        long = member_scores(spark, sf_dir)
        wide = long.groupBy("account_id", "y").pivot("member", MEMBERS).agg(F.first("prob"))
        return alerts.risk_scores(metrics.blend(wide, weights(spark, sf_dir), MEMBERS, out="prob"), "prob")

    return materialized(spark, "chain_blended", sf_dir, build)


def final_members(spark, sf_dir) -> dict[str, list[dict]]:
    """The three members on all folds, read from the saved node table."""
    return models.final_members(trained(spark, sf_dir)[0])


def contributions(spark, sf_dir):
    """(account_id, feature, shap, base) of the level-wise member in log-odds: accounts x selected features."""

    def build():
        names = selected(spark, sf_dir)
        return models.contributions(training(spark, sf_dir), final_members(spark, sf_dir)[EXPLAINED], len(names), names)

    return materialized(spark, "chain_contributions", sf_dir, build)


def importance(spark, sf_dir):
    """Global importance of the explained member's contributions, a row a feature."""

    def build():
        labels = training(spark, sf_dir).select("account_id", "y")
        return explain.global_importance(by_account(contributions(spark, sf_dir), labels))

    return materialized(spark, "chain_importance", sf_dir, build)


def blend_metrics(spark, sf_dir):
    """The blend's (metric, value) rows."""
    return materialized(spark, "chain_metrics", sf_dir, lambda: metrics.metric_record(blended(spark, sf_dir).select("account_id", "y", "prob")))


@query("select_engineered")
def q_select_engineered(spark, sf_dir):
    """Top 300 by mutual information plus the must-keep families, on the engineered table."""
    return selection_table(spark, sf_dir)


@query("account_oof")
def q_account_oof(spark, sf_dir):
    s = member_scores(spark, sf_dir)
    return s.select("account_id", "y", "fold", "member", round6("prob").alias("prob"))


@query("account_blend_scores")
def q_account_blend_scores(spark, sf_dir):
    b = blended(spark, sf_dir)
    return b.select("account_id", "y", *[round6(c).alias(c) for c in (*MEMBERS, "prob")], "risk_score", "tier")


@query("account_blend_metrics")
def q_account_blend_metrics(spark, sf_dir):
    return blend_metrics(spark, sf_dir).select("metric", round6("value").alias("value"))


@query("account_tree_contrib")
def q_account_tree_contrib(spark, sf_dir):
    c = contributions(spark, sf_dir)
    return c.select("account_id", "feature", round6("shap").alias("shap"), round6("base").alias("base"))


@query("account_tree_importance")
def q_account_tree_importance(spark, sf_dir):
    return importance(spark, sf_dir).select("feature", *[round6(c).alias(c) for c in ("importance", "mean_shap_pos", "mean_shap_neg")], "direction")


@query("account_tree_cards")
def q_account_tree_cards(spark, sf_dir):
    """Alert cards of every account: the blend's score and tier, the boosted member's factors."""
    cols = F.array(*[F.lit(c) for c in selected(spark, sf_dir)])
    m = {EXPLAINED: final_members(spark, sf_dir)[EXPLAINED]}
    values = training(spark, sf_dir).select("account_id", F.map_from_arrays(cols, "features").alias("v"))
    long = by_account(contributions(spark, sf_dir), values).select(
        "account_id", F.struct("feature", F.element_at("v", F.col("feature")).alias("value"), "shap").alias("c"))
    rows = long.groupBy("account_id").agg(F.collect_list("c").alias("contrib"))  # one entry per feature
    t = by_account(blended(spark, sf_dir), rows)
    own = models.score(training(spark, sf_dir), m).select("account_id", F.col(EXPLAINED).alias("member_prob"))
    cards = by_account(t, own).select("account_id", "risk_score", round6("prob").alias("prob"), round6("member_prob").alias("member_prob"),
                                              *[v.alias(k) for k, v in explain.card_columns().items()])
    return cards.select("account_id", "risk_score", "prob", "member_prob", "tier", "action", "narrative",
                        F.to_json("top_risk_factors").alias("top_risk_factors"), F.to_json("protective_factors").alias("protective_factors"))


@query("account_split_ledger")
def q_account_split_ledger(spark, sf_dir):
    """Every split of the chain's members: (member, fold, tree, node, feature, gain, rows)."""
    ledger = boosting.split_ledger(trained(spark, sf_dir)[0], selected(spark, sf_dir))
    return ledger.select("member", "fold", "tree", "node", "feature", round6("gain").alias("gain"), "rows")


@query("account_model_importance")
def q_account_model_importance(spark, sf_dir):
    """Splits, total and mean gain a split of each feature in the members on all folds."""
    final = trained(spark, sf_dir)[0].where(F.col("fold") == boosting.ALL)
    imp = boosting.importances(boosting.split_ledger(final, selected(spark, sf_dir)))
    return imp.select("member", "feature", "splits", *[round6(c).alias(c) for c in ("total_gain", "mean_gain")])


def release_root(spark, sf_dir) -> str:
    """The folder of the chain's releases; the first one is published on first use."""
    from riskloom.plans.derivation import derivation
    from riskloom.sources import releases
    from riskloom.sources.artifacts import artifact_path

    root = artifact_path(spark, "chain_releases", sf_dir)
    if not releases.versions(spark, root):
        names = selected(spark, sf_dir)
        releases.publish(spark, root, nodes=trained(spark, sf_dir)[0], features=names,
                         medians=features.medians(engineered(spark, sf_dir), names), weights=weights(spark, sf_dir),
                         calibration=alerts.calibration_params(blended(spark, sf_dir), "prob"),
                         class_means=importance(spark, sf_dir), explained=EXPLAINED,
                         derivation=derivation(spark, sf_dir))
    return root


def _responses(df):
    return df.select("account_id", "risk_score", "tier", round6("fraud_probability").alias("fraud_probability"), "action",
                     F.to_json("top_risk_factors").alias("top_risk_factors"), "typology.*", "model_version")


@query("account_screen")
def q_account_screen(spark, sf_dir):
    """Requests screened by the released members, weights, medians and calibration."""
    from riskloom.operators import screen
    from riskloom.plans import screening
    from riskloom.sources import releases

    root = release_root(spark, sf_dir)
    release = releases.load(spark, root, releases.current(spark, root))
    return _responses(screen.screen_release(screening.requests(spark, sf_dir), release, screening.API_TYPO))


@query("account_screen_recomputed")
def q_account_screen_recomputed(spark, sf_dir):
    """Requests that supply whole raw rows, screened with the derived columns recomputed from them (z-scores by
    the moments of all training rows; detector columns keep their medians)."""
    from riskloom.operators import screen
    from riskloom.plans import derivation, screening
    from riskloom.sources import releases

    root = release_root(spark, sf_dir)
    release = releases.load(spark, root, releases.current(spark, root))
    return _responses(screen.screen_release(derivation.whole_rows(spark, sf_dir), release, screening.API_TYPO, derive="recompute"))


@query("account_screen_stream")
def q_account_screen_stream(spark, sf_dir):
    """The same requests through the stream; the tests check equality with ``account_screen``."""
    from riskloom.plans import screening
    from riskloom.streaming.screening import run_release_stream

    return _responses(run_release_stream(spark, screening.requests(spark, sf_dir), release_root(spark, sf_dir), screening.API_TYPO))


@query("account_model_card")
def q_account_model_card(spark, sf_dir):
    """(section, key, value): the members with their blend weights and trees, top-5 features, the blend's metrics.
    Each part is saved by a run of its own, so the driver never holds the broadcast tables of all parts at once."""
    nodes, w = trained(spark, sf_dir)[0], weights(spark, sf_dir)
    trees = nodes.where((F.col("fold") == boosting.ALL) & (F.col("tree") >= 0)).groupBy("member").agg(F.count_distinct("tree").alias("n"))
    top = q_account_tree_importance(spark, sf_dir).orderBy(F.desc("importance"), "feature").limit(5)
    rank = F.row_number().over(Window.orderBy(F.desc("importance"), "feature"))
    parts = [
        w.select(F.lit("weight").alias("section"), F.col("member").alias("key"), F.format_string("%.4f", "weight").alias("value")),
        trees.select(F.lit("trees").alias("section"), F.col("member").alias("key"), F.col("n").cast("string").alias("value")),
        top.select(F.lit("top_feature").alias("section"), rank.cast("string").alias("key"), F.col("feature").alias("value")),
        q_account_blend_metrics(spark, sf_dir).select(F.lit("metric").alias("section"), F.col("metric").alias("key"), F.format_string("%.4f", "value").alias("value")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
