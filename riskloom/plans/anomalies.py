"""Anomaly and kNN-MI queries (O-43, O-46, O-48a): rows-only checks; the tests
check their properties and compare with brute force on small inputs."""

from __future__ import annotations


from riskloom.functions.scoring import round6
from riskloom.operators import anomaly, mi
from riskloom.operators.catalog import to_long
from riskloom.plans import accounts as A
from riskloom.plans.registry import query
from riskloom.sources.fixtures import fixture


@query("isolation_forest")
def q_isolation_forest(spark, sf_dir):
    v = fixture(spark, sf_dir, "vec_accounts")
    s = anomaly.isolation_forest(v)
    return s.select("account_id", round6("if_score").alias("if_score"), round6("if_decision").alias("if_decision"),
                    "if_anomaly")


@query("pca_recon")
def q_pca_recon(spark, sf_dir):
    v = fixture(spark, sf_dir, "vec_accounts")
    return anomaly.pca_recon_error(v).select("account_id", round6("recon_error").alias("recon_error"))


@query("mi_knn")
def q_mi_knn(spark, sf_dir):
    c = A.clean(spark, sf_dir)
    return mi.mi_knn(to_long(c, list(A.PRE_IMPUTE_COLS))).select("feature", round6("mi").alias("mi"))


def _behaviour_vectors(spark, sf_dir):
    from riskloom.plans.fitted import behaviour_table

    b = behaviour_table(spark, sf_dir)
    return anomaly.with_anomaly_vector(b, A.KEYS).select("account_id", "y", "features")


@query("isolation_forest_accounts")
def q_isolation_forest_accounts(spark, sf_dir):
    """Isolation forest on the account table's behaviour, temporal, meta and key columns."""
    s = anomaly.isolation_forest(_behaviour_vectors(spark, sf_dir))
    return s.select("account_id", round6("if_score").alias("if_score"), round6("if_decision").alias("if_decision"),
                    "if_anomaly")


@query("pca_recon_accounts")
def q_pca_recon_accounts(spark, sf_dir):
    """PCA reconstruction error on the same columns, fitted on the negatives."""
    e = anomaly.pca_recon_error(_behaviour_vectors(spark, sf_dir))
    return e.select("account_id", round6("recon_error").alias("recon_error"))


@query("fold_isolation_forest")
def q_fold_isolation_forest(spark, sf_dir):
    """In-fold anomaly scores: forest i is fitted on the other folds and scores the
    held-out rows (all five forests grown and applied in one pass)."""
    from riskloom.operators import folds

    v = folds.stratified_folds(_behaviour_vectors(spark, sf_dir))
    out = anomaly.fold_isolation_forest(v)
    return out.select("account_id", "fold", round6("if_score").alias("if_score"), "if_anomaly")


@query("fold_pca_recon")
def q_fold_pca_recon(spark, sf_dir):
    """In-fold reconstruction errors: scaler and projection from the other folds' moments."""
    from riskloom.operators import folds

    v = folds.stratified_folds(_behaviour_vectors(spark, sf_dir))
    return anomaly.fold_pca_error(v).select("account_id", round6("recon_error").alias("recon_error"))
