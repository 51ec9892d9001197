import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import anomaly, fitted, folds
from riskloom.sources.fixtures import fixture
from tests.conftest import SF, SF2


def _vec(spark):
    return fixture(spark, SF2, "vec_accounts")


def test_isolation_forest_properties(spark):
    v = _vec(spark)
    out = anomaly.isolation_forest(v).toPandas()
    s = -out["if_score"]
    assert ((s > 0) & (s <= 1)).all()
    n, rate = len(out), v.agg(F.avg("y")).first()[0]
    flagged = int(out["if_anomaly"].sum())
    assert abs(flagged - max(rate, 0.005) * n) <= 2
    again = anomaly.isolation_forest(v).toPandas()
    assert np.allclose(out.sort_values("account_id")["if_score"], again.sort_values("account_id")["if_score"])


def test_pca_error_matches_numpy(spark):
    v = _vec(spark)
    got = anomaly.pca_recon_error(v).toPandas().sort_values("account_id")
    pdf = v.toPandas().sort_values("account_id")
    X = np.vstack(pdf["features"].to_numpy()).astype(float)
    sd = X.std(axis=0)
    Z = (X - X.mean(axis=0)) / np.where(sd == 0, 1, sd)
    neg = Z[pdf["y"].to_numpy() != 1]
    mu = neg.mean(axis=0)
    _, _, vt = np.linalg.svd(neg - mu, full_matrices=False)
    P = vt[: min(20, X.shape[1] // 2)].T
    R = (Z - mu) - (Z - mu) @ P @ P.T
    ref = (R * R).mean(axis=1)
    assert (got["recon_error"] >= 0).all()
    assert np.allclose(got["recon_error"].to_numpy(), ref, rtol=1e-6, atol=1e-8)


def test_fold_statistics_ignore_held_out_rows(spark):
    v = fixture(spark, SF, "acct_raw").select("account_id", "y", "f_spend", "f_max")
    f = folds.stratified_folds(v)
    a = fitted.fold_zscores(f, ["f_spend", "f_max"]).where("fold = 0").orderBy("account_id").collect()
    changed = f.withColumn("f_spend", F.when(F.col("fold") == 0, F.col("f_spend") * 100).otherwise(F.col("f_spend")))
    b = fitted.fold_zscores(changed, ["f_spend", "f_max"]).where("fold = 0").orderBy("account_id").collect()
    # held-out values changed, so their z-scores change, but the fitted stats (f_max) are identical
    assert [r["z_f_max"] for r in a] == [r["z_f_max"] for r in b]


def test_in_fold_pca_error_equals_one_fit_per_fold(spark):
    """Moments of the other folds give what a scaler and a projection fitted on them give."""
    f = folds.stratified_folds(_vec(spark)).withColumn(
        "features", F.concat(F.slice("features", 1, 9), F.array(F.lit(3.0), F.when(F.col("fold") == 2, 1.0).otherwise(0.0), F.col("features")[0] * 1e6 + 1e9)))
    got = {r["account_id"]: r["recon_error"] for r in anomaly.fold_pca_error(f).collect()}
    assert len(got) == f.count()
    for i in (0, 2):
        want = anomaly.pca_recon_error(f, fit_filter=F.col("fold") != i).join(f.where(F.col("fold") == i).select("account_id"), "account_id")
        for r in want.collect():
            assert abs(got[r["account_id"]] - r["recon_error"]) <= 1e-9 * max(1.0, abs(r["recon_error"]))
