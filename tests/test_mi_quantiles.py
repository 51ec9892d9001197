import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.functions.cumulative import quantile_bucket, running_totals
from riskloom.functions.quantiles import exact_percentiles
from riskloom.operators.mi import mi_knn
from tests.bruteforce import mi_knn as mi_brute


def test_exact_percentiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.normal(size=3000), np.full(1000, 0.25), rng.integers(0, 5, 500).astype(float)])
    rows = [(int(i % 3), float(v)) for i, v in enumerate(vals)] + [(0, None), (5, None)]
    df = spark.createDataFrame(rows, "g int, v double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    got = {r["g"]: r for r in exact_percentiles(df, "v", probs, by=["g"]).collect()}
    for g in (0, 1, 2):
        ref = np.percentile(vals[np.arange(len(vals)) % 3 == g], [q * 100 for q in probs])
        assert np.allclose([got[g][f"q{i}"] for i in range(len(probs))], ref, rtol=0, atol=1e-12)
    assert 5 not in got  # a group without values has no row
    one = exact_percentiles(df, "v", [0.5], names=["m"]).first()["m"]
    assert one == pytest.approx(np.median(vals))


def test_median_even_count(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double")
    assert exact_percentiles(df, "v", [0.5]).first()[0] == 2.5


def test_empty_percentile_gives_null(spark):
    df = spark.createDataFrame([], "v double")
    assert exact_percentiles(df, "v", [0.5]).collect()[0][0] is None


def test_running_totals_match_window(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), float(x)) for i, x in enumerate(rng.normal(size=2000))]
    df = spark.createDataFrame(rows, "id long, x double").withColumn("one", F.lit(1))
    b = quantile_bucket(df, "x", descending=True, buckets=16)
    out = running_totals(df, [F.col("x").desc(), F.col("id")], ["one"], b).select("x", "cum_one").toPandas()
    out = out.sort_values("x", ascending=False).reset_index(drop=True)
    assert (out["cum_one"].to_numpy() == np.arange(1, 2001)).all()


def test_mi_knn_matches_brute_force(spark):
    rng = np.random.default_rng(11)
    n = 300
    y = (rng.random(n) < 0.3).astype(int)
    x1 = rng.normal(size=n) + 1.5 * y
    x2 = np.round(rng.normal(size=n), 1)  # many ties
    x3 = np.where(rng.random(n) < 0.2, np.nan, rng.exponential(size=n))
    x4 = (rng.random(n) < 0.1).astype(float)  # two values: one row each per class, however many points
    rows = []
    for i in range(n):
        for name, col in (("a", x1), ("b", x2), ("c", x3), ("d", x4)):
            v = None if np.isnan(col[i]) else float(col[i])
            rows.append((i, int(y[i]), name, v))
    long = spark.createDataFrame(rows, "account_id long, y int, feature string, value double")
    got = {r["feature"]: r["mi"] for r in mi_knn(long).collect()}
    for name, col in (("a", x1), ("b", x2), ("c", x3), ("d", x4)):
        ok = ~np.isnan(col)
        assert got[name] == pytest.approx(mi_brute(col[ok], y[ok]), abs=1e-9)


@pytest.mark.parametrize("rows_per_bucket", [5, 250_000])
def test_percentiles_dont_depend_on_buckets(spark, rows_per_bucket):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=900), np.zeros(450)])
    df = spark.createDataFrame([(i % 2, float(v)) for i, v in enumerate(x)], "g int, x double")
    r = exact_percentiles(df, "x", [0.01, 0.5, 0.99], by=["g"], names=["a", "b", "c"], rows_per_bucket=rows_per_bucket)
    for row in r.collect():
        assert list(row)[1:] == pytest.approx(np.quantile(x[row["g"]::2], [0.01, 0.5, 0.99]).tolist(), abs=1e-12)
