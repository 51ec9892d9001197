"""Model training queries (O-52..O-59): rows-only checks; properties and plain programs in tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions.scoring import round6
from riskloom.operators import boosting, folds, metrics, models
from riskloom.plans.registry import query
from riskloom.sources.artifacts import materialized_all, materialized
from riskloom.sources.fixtures import fixture

WIDTH = 64
NAMES = [f"e{i}" for i in range(WIDTH)]


def _vec(spark, sf_dir):
    """vec_accounts with folds (written: every job of the fit reads it)."""

    def build():
        v = fixture(spark, sf_dir, "vec_accounts")
        return folds.stratified_folds(v.select("account_id", "y", "features"))

    return materialized(spark, "vec_folds", sf_dir, build)


def _trained(spark, sf_dir):
    """(node table, out-of-fold scores), from one run of the booster."""
    return materialized_all(spark, ("vec_nodes", "vec_oof"), sf_dir, lambda: models.train(_vec(spark, sf_dir)))


@query("model_oof")
def q_model_oof(spark, sf_dir):
    """Out-of-fold probabilities of the three members (each id once per member)."""
    return _trained(spark, sf_dir)[1].select("account_id", "y", "fold", "member", round6("prob").alias("prob"))


@query("model_blend")
def q_model_blend(spark, sf_dir):
    """Members blended by their out-of-fold average precision, then the metric record."""
    oof = _trained(spark, sf_dir)[1]
    w = metrics.blend_weights(oof)
    wide = oof.groupBy("account_id", "y").pivot("member", models.NAMES).agg(F.first("prob"))
    b = metrics.blend(wide, w, models.NAMES, out="prob")
    return metrics.metric_record(b.select("account_id", "y", "prob")).select("metric", round6("value").alias("value"))


@query("split_ledger")
def q_split_ledger(spark, sf_dir):
    """Every split of every fitted member: the ledger that importances are read from."""
    ledger = boosting.split_ledger(_trained(spark, sf_dir)[0], NAMES)
    return ledger.select("member", "fold", "tree", "node", "feature", round6("gain").alias("gain"), "rows")


@query("feature_importance")
def q_feature_importance(spark, sf_dir):
    """Final members: splits, total and mean gain of each feature that was used."""
    final = _trained(spark, sf_dir)[0].where(F.col("fold") == boosting.ALL)
    imp = boosting.importances(boosting.split_ledger(final, NAMES))
    return imp.select("member", "feature", "splits", *[round6(c).alias(c) for c in ("total_gain", "mean_gain")])


@query("tree_contrib")
def q_tree_contrib(spark, sf_dir):
    """Exact tree contributions of the level-wise member (log-odds), per account and
    feature; the tests check sum + base = log-odds."""
    member = models.final_members(_trained(spark, sf_dir)[0])["level"]
    feats = fixture(spark, sf_dir, "vec_accounts").select("account_id", "features")
    c = models.contributions(feats, member, WIDTH, NAMES)
    return c.select("account_id", "feature", round6("shap").alias("shap"), round6("base").alias("base"))
