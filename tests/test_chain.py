"""The connected chain on the account table: each step's output is checked from the step before."""

import json
import os
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import features, metrics, models
from riskloom.plans import chain
from riskloom.streaming import screening
from tests.bruteforce import average_precision
from tests.conftest import SF


@pytest.fixture(scope="module")
def frames(spark):
    return {"members": chain.member_scores(spark, SF).toPandas(), "blend": chain.blended(spark, SF).toPandas()}


def test_every_account_is_scored_out_of_fold(spark, frames):
    n = chain.engineered(spark, SF).count()
    per = frames["members"].groupby("member").account_id.agg(["size", "nunique"])
    assert set(per.index) == set(chain.MEMBERS) and (per["size"] == n).all() and (per["nunique"] == n).all()
    kept = set(chain.selected(spark, SF))
    assert any(c.startswith("beh_") for c in kept) and {"iforest_score", "ae_recon_error", "z_composite_score"} <= kept


def test_blend_weights_scores_and_tiers_follow(frames):
    m, b = frames["members"], frames["blend"].set_index("account_id")
    ap = {k: average_precision(g.y.to_numpy(), g.prob.to_numpy()) for k, g in m.groupby("member")}
    wide = m.pivot(index="account_id", columns="member", values="prob")
    want = sum(wide[k] * ap[k] for k in ap) / sum(ap.values())
    assert np.allclose(b.prob.loc[want.index], want, atol=1e-12)
    lo, hi = np.quantile(b.prob, [0.01, 0.99])
    score = np.round(np.clip((b.prob - lo) / (hi - lo + 1e-9) * 1000, 0, 1000))
    assert (np.abs(score - b.risk_score) <= 1e-9).all()
    blend_ap = average_precision(b.y.to_numpy(), b.prob.to_numpy())
    assert blend_ap >= max(ap.values()) - 0.1


def test_contributions_explain_the_saved_member(spark):
    c = chain.contributions(spark, SF)
    t = chain.training(spark, SF)
    assert c.count() == t.count() * len(chain.selected(spark, SF))
    odds = models.score(t, chain.final_members(spark, SF)).select("account_id", F.col(f"{chain.EXPLAINED}_odds").alias("odds"))
    j = c.groupBy("account_id").agg(F.sum("shap").alias("s"), F.first("base").alias("b")).join(odds, "account_id").toPandas()
    assert np.abs(j.s + j.b - j.odds).max() < 1e-9
    cards = chain.q_account_tree_cards(spark, SF)
    assert cards.count() == t.count() and cards.where("tier is null or narrative is null").count() == 0
    ledger = chain.q_account_split_ledger(spark, SF)
    assert {r["member"] for r in ledger.select("member").distinct().collect()} == set(chain.MEMBERS)
    assert ledger.where("feature is null").count() == 0


def test_row_moments_are_linear_in_the_columns(spark):
    names = [f"c{i}" for i in range(40)]
    rng = np.random.default_rng(2)
    x = rng.normal(size=(5, 40))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{n} double" for n in names))
    got = df.select(*[v.alias(k) for k, v in features.row_stat_columns(names).items()]).toPandas()
    assert np.allclose(got.beh_row_std, x.std(axis=1, ddof=1))
    z = (x - x.mean(axis=1)[:, None])
    s2, s3 = (z ** 2).sum(axis=1), (z ** 3).sum(axis=1)
    assert np.allclose(got.beh_row_skew, 40 * 39 ** 0.5 / 38 * s3 / s2 ** 1.5)
    plan = df.select(features.row_stat_columns(names)["beh_row_kurt"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") <= 4  # a fixed number of passes over the row


def test_a_batch_that_runs_again_replaces_its_output(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(str(i), {"a": str(i)}) for i in range(30)], "account_id string, features map<string,string>")
    landing, sink, point = (str(tmp_path / x) for x in ("in", "out", "point"))
    rows.repartition(3).write.parquet(landing)
    monkeypatch.setattr(screening.screen, "screen_requests", lambda batch, *a: batch.select("account_id"))
    fails = {"left": 1}
    start = screening.start_screen_stream

    def run():
        q = start(spark, landing, sink, point, None, None, None, [], {}, rows.schema, files_per_batch=1)
        q.awaitTermination()

    original = screening.os.path.join

    def breaks(*parts):  # the second batch dies after its output was written
        path = original(*parts)
        if str(parts[-1]) == "batch_id=1" and fails["left"]:
            fails["left"] = 0
            rows.limit(2).select("account_id").write.mode("overwrite").parquet(path)
            raise RuntimeError("executor lost")
        return path

    monkeypatch.setattr(screening.os.path, "join", breaks)
    with pytest.raises(Exception, match="executor lost"):
        run()
    run()
    out = spark.read.parquet(sink)
    assert out.count() == 30 and out.select("account_id").distinct().count() == 30
    assert out.select("batch_id").distinct().count() == 3


def test_python_tasks_run_from_another_folder(tmp_path):
    root = Path(__file__).resolve().parents[1]
    code = f"""
import sys
sys.path.insert(0, {str(root)!r})
import __spark_entry__ as e
from pyspark.sql import SparkSession
s = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
assert e.queries()["isolation_forest"](s, {SF!r}).count() > 0
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path, env=env, timeout=300)


def test_curve_totals_leave_out_rows_without_a_score(spark):
    rows = spark.createDataFrame([(1, 1, None), (2, 1, 0.5), (3, 0, 0.5), (4, 0, 0.1)], "account_id long, y int, prob double")
    top = metrics.score_curve(rows).orderBy(F.desc("score")).first()
    assert (top["n_pos"], top["n_neg"], top["precision"], top["recall"]) == (1, 2, 0.5, 1.0)


def test_the_model_card_reads_parts_that_were_saved_one_by_one(spark):
    card = chain.q_account_model_card(spark, SF)
    assert card._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange") == 0
    rows = {(r["section"], r["key"]): r["value"] for r in card.collect()}
    want = {r["member"]: f"{r['weight']:.4f}" for r in metrics.blend_weights(chain.member_scores(spark, SF)).collect()}
    assert {k: v for (s, k), v in rows.items() if s == "weight"} == want
    assert sum(s == "top_feature" for s, _ in rows) == 5 and sum(s == "metric" for s, _ in rows) == 11


def _steps(spark, monkeypatch, tmp_path):
    """The chain's steps on a small file of many rows: contributions of 2,000 accounts, most of them zero."""
    def saved(df, name):
        df.repartition(1).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    shap = F.when((F.col("account_id") % 5 == 0) & (F.col("feature") == "a"), 0.5).when(F.col("feature") == "b", -0.25).otherwise(0.0)
    ids = spark.range(2000).select(F.col("id").alias("account_id"), F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("y"))
    contrib = saved(ids.select("account_id", F.explode(F.array(*map(F.lit, "abc"))).alias("feature")).withColumn("shap", shap).withColumn("base", F.lit(-1.0)), "contrib")
    values = F.array(*[F.col("account_id") * k for k in (1.0, 2.0, 3.0)])
    table = saved(ids.select("account_id", "y", F.lit(0).alias("fold"), values.alias("features")), "training")
    blend = saved(ids.select("account_id", "y", F.lit(0.5).alias("prob"), F.lit(500).alias("risk_score"), F.lit("LOW").alias("tier")), "blended")
    monkeypatch.setattr(chain, "materialized", lambda spark, name, scope, build: build())
    for name, value in (("contributions", contrib), ("training", table), ("blended", blend), ("selected", [*"abc"]),
                        ("final_members", {chain.EXPLAINED: [{"prior": 0.0}]})):
        monkeypatch.setattr(chain, name, lambda *_, value=value: value)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_importance_sends_no_contributions_through_the_driver(spark, monkeypatch, tmp_path):
    _steps(spark, monkeypatch, tmp_path)
    imp = chain.importance(spark, "x")
    assert "Broadcast" not in _plan(imp)
    got = {r["feature"]: (r["importance"], r["mean_shap_pos"], r["mean_shap_neg"], r["direction"]) for r in imp.collect()}
    assert got == {"a": (0.1, 0.5, pytest.approx(0.5 * 200 / 1800), "up"), "b": (0.25, -0.25, -0.25, "down"), "c": (0.0, 0.0, 0.0, "down")}


def test_cards_send_no_account_table_through_the_driver(spark, monkeypatch, tmp_path):
    _steps(spark, monkeypatch, tmp_path)
    cards = chain.q_account_tree_cards(spark, "x")
    assert "Broadcast" not in _plan(cards)
    rows = {r["account_id"]: r for r in cards.collect()}
    assert len(rows) == 2000 and {r["member_prob"] for r in rows.values()} == {0.5}
    assert json.loads(rows[10]["top_risk_factors"])[0]["value"] == 10.0 and json.loads(rows[11]["top_risk_factors"]) == []
    assert json.loads(rows[7]["protective_factors"]) == [{"feature": "b", "value": 14.0, "shap_contrib": -0.25}]
