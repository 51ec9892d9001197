import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.functions.cumulative import boundaries_below
from riskloom.operators import folds, metrics
from tests.bruteforce import average_precision as ap_brute
from tests.bruteforce import roc_auc as auc_brute


def scored(spark, y, p):
    return spark.createDataFrame([(i, int(a), float(b)) for i, (a, b) in enumerate(zip(y, p))],
                                 "account_id long, y int, prob double")


def test_five_row_average_precision(spark):
    s = scored(spark, [1, 0, 1, 0, 0], [0.9, 0.8, 0.7, 0.6, 0.5])
    assert metrics.average_precision(s).first()[0] == pytest.approx(0.833333, abs=1e-6)
    assert metrics.roc_auc(s).first()[0] == pytest.approx(auc_brute(np.array([1, 0, 1, 0, 0]),
                                                                    np.array([0.9, 0.8, 0.7, 0.6, 0.5])))


def test_all_tied_scores(spark):
    s = scored(spark, [1, 0, 0, 1, 0], [0.4] * 5)
    assert metrics.average_precision(s).first()[0] == pytest.approx(0.4)
    assert metrics.roc_auc(s).first()[0] == pytest.approx(0.5)


def test_no_positives_and_no_prediction(spark):
    s = scored(spark, [0, 0, 0], [0.2, 0.5, 0.995])
    b = metrics.best_threshold(s).first()
    assert (b["threshold"], b["best_f2"]) == (0.5, 0.0)
    assert metrics.roc_auc(s).first()[0] is None
    low = scored(spark, [1, 0], [0.001, 0.002])  # nothing reaches the first grid point
    assert metrics.best_threshold(low).first()["threshold"] == 0.5


def f2_over_the_grid(y, p):
    """F2 of all 200 thresholds at once (row: threshold); the first maximum, or the default."""
    grid = np.linspace(0.01, 0.99, 200)
    called = p[None, :] >= grid[:, None]
    found, n_called, n_true = called.astype(int) @ (y == 1).astype(int), called.sum(axis=1), (y == 1).sum()
    f2 = np.where(n_called > 0, 5.0 * found / np.maximum(1, 4 * n_true + n_called), 0.0)
    return (grid[f2.argmax()], f2.max()) if f2.max() > 0 else (0.5, 0.0)


@pytest.mark.parametrize("buckets", [4, 64])
def test_curve_doesnt_depend_on_buckets(spark, buckets):
    rng = np.random.default_rng(3)
    p = [None if i % 5 == 0 else float("nan") if i % 7 == 0 else float(x) for i, x in enumerate(np.round(rng.random(1000), 2))]
    rows = spark.createDataFrame([(i, int(i % 4 == 0), x) for i, x in enumerate(p)], "account_id long, y int, prob double")
    one, many = (sorted(map(str, metrics.score_curve(rows, buckets=b).collect())) for b in (1, buckets))
    assert one == many and len(one) > 50


def test_bucket_search_equals_numpy(spark):
    bounds = sorted(np.random.default_rng(1).normal(size=4095).tolist())
    x = [*np.random.default_rng(2).normal(size=300).tolist(), *bounds[::500], float("nan")]
    got = spark.createDataFrame([(v,) for v in x], "x double").select(boundaries_below(F.col("x"), bounds)).collect()
    want = [len(bounds) if v != v else int(np.searchsorted(bounds, v)) for v in x]
    assert [r[0] for r in got] == want


def test_metrics_match_brute_force(spark):
    rng = np.random.default_rng(5)
    y = (rng.random(800) < 0.2).astype(int)
    p = np.round(np.clip(rng.normal(0.3 + 0.3 * y, 0.2), 0, 1), 3)
    s = scored(spark, y, p)
    t, f = f2_over_the_grid(y, p)
    b = metrics.best_threshold(s).first()
    assert b["threshold"] == pytest.approx(t, abs=1e-12) and b["best_f2"] == pytest.approx(f, abs=1e-12)
    assert metrics.average_precision(s).first()[0] == pytest.approx(ap_brute(y, p), abs=1e-12)
    assert metrics.roc_auc(s).first()[0] == pytest.approx(auc_brute(y, p), abs=1e-12)
    curve = metrics.pr_curve(s).toPandas()
    assert len(curve) == len(np.unique(p)) + 1
    assert ((curve["threshold"].isna()) & (curve["precision"] == 1.0) & (curve["recall"] == 0.0)).sum() == 1


def test_stratified_folds_balanced(spark):
    rng = np.random.default_rng(9)
    y = (rng.random(1003) < 0.1).astype(int)
    s = scored(spark, y, rng.random(1003))
    f = folds.stratified_folds(s).groupBy("y", "fold").count().toPandas()
    for _, g in f.groupby("y"):
        assert g["count"].max() - g["count"].min() <= 1 and len(g) == 5
    assert folds.stratified_folds(s).select("account_id").distinct().count() == 1003


def test_confusion_and_rates(spark):
    s = scored(spark, [1, 1, 0, 0], [0.9, 0.2, 0.8, 0.1])
    th = spark.createDataFrame([(0.5,)], "threshold double")
    c = metrics.rates(metrics.confusion(s, th)).first()
    assert (c["tp"], c["fp"], c["fn"], c["tn"]) == (1, 1, 1, 1)
    assert c["precision"] == 0.5 and c["recall"] == 0.5 and c["f2"] == pytest.approx(0.5)


def test_rank_with_hot_score_matches_window(spark):
    from pyspark.sql import Window

    from riskloom.operators.folds import seeded_hash
    from riskloom.operators.readside import rank_by_score

    rng = np.random.default_rng(2)
    scores = np.where(rng.random(3000) < 0.34, 0, rng.integers(0, 1001, 3000))  # a third share one score
    df = spark.createDataFrame([(i, int(s)) for i, s in enumerate(scores)], "account_id long, risk_score int")
    r = rank_by_score(df, rows_per_bucket=100)  # many buckets, the hot score spread over them
    w = Window.orderBy(F.col("risk_score").desc(), seeded_hash("account_id"))
    chk = r.withColumn("ref", F.row_number().over(w))
    assert chk.where("rank != ref").count() == 0 and chk.count() == 3000


def test_summaries_without_positives(spark):
    from riskloom.operators import alerts

    t = spark.createDataFrame([(1, 0, 0.2, 600, "WATCHLIST"), (2, 0, 0.1, 100, "MONITORED")],
                              "account_id long, y int, prob double, risk_score int, tier string")
    s = alerts.positive_score_summary(t).first()
    assert s["n_positives"] == 0 and s["pct_ge_500"] is None and s["median_score"] is None
    d = {r["tier"]: r["n_accounts"] for r in alerts.tier_distribution(t).collect()}
    assert d == {"AUTO-FREEZE": 0, "INVESTIGATOR": 0, "WATCHLIST": 1, "MONITORED": 1}
