import pytest
from pyspark.sql import functions as F

from riskloom.operators import explain, screen
from riskloom.plans import explaining as X
from riskloom.plans import screening as S
from riskloom.streaming import screening
from tests.conftest import SF


def _contrib_row(spark, shaps):
    items = ", ".join(f"named_struct('feature', 'f{i}', 'value', {float(i)}, 'shap', CAST({s} AS DOUBLE))"
                      for i, s in enumerate(shaps))
    return spark.sql(f"SELECT 1L AS account_id, 950 AS risk_score, 0.8D AS prob, array({items}) AS contrib")


def test_card_without_positive_factor(spark):
    c = explain.card_columns()
    r = _contrib_row(spark, [-0.2, -0.01]).select(*[v.alias(k) for k, v in c.items()]).first()
    assert r["top_risk_factors"] == [] and "multiple factors" in r["narrative"]
    assert [x["feature"] for x in r["protective_factors"]] == ["f1", "f0"]  # weakest first
    assert r["tier"] == "AUTO-FREEZE"


def test_card_orders_and_magnitudes(spark):
    c = explain.card_columns(protective="strongest")
    r = _contrib_row(spark, [0.01, 0.3, 0.07, -0.5, -0.2, -0.1, -0.05, 0.2, 0.15, 0.12]).select(
        *[v.alias(k) for k, v in c.items()]).first()
    assert [x["feature"] for x in r["top_risk_factors"]] == ["f1", "f7", "f8", "f9", "f2"]
    assert [x["magnitude"] for x in r["top_risk_factors"]] == ["HIGH", "HIGH", "HIGH", "HIGH", "MEDIUM"]
    assert [x["feature"] for x in r["protective_factors"]] == ["f3", "f4", "f5"]


def test_request_edge_cases(spark):
    med = spark.createDataFrame([("a", 1.5), ("b", 2.5)], "feature string, median double")
    req = spark.createDataFrame(
        [("r1", {"a": "3", "zzz": "9"}), ("r2", {}), ("r3", {"b": "oops"}), ("r4", {"a": None})],
        "account_id string, features map<string,string>")
    v = {r["account_id"]: r for r in screen.request_vectors(req, med, ["a", "b"]).collect()}
    assert (v["r1"]["a"], v["r1"]["b"], v["r1"]["parse_error"]) == (3.0, 2.5, None)   # unknown name ignored
    assert (v["r2"]["a"], v["r2"]["b"]) == (1.5, 2.5)                                   # empty map -> medians
    assert v["r3"]["parse_error"] == "could not convert value of b to float"
    assert v["r4"]["a"] == 1.5 and v["r4"]["parse_error"] is None


def test_ensemble_renormalises(spark):
    df = spark.createDataFrame([(0.2, 0.6)], "p double, q double")
    r = screen.ensemble_score(df, {"xgb": "p", "lgb": "q"}).first()["prob"]
    assert r == pytest.approx((0.35 * 0.2 + 0.31 * 0.6) / 0.66)


def test_stream_equals_batch(spark):
    batch = S.q_screen_batch(spark, SF).collect()
    stream = S.q_screen_stream(spark, SF).collect()
    key = lambda r: r["account_id"]
    assert sorted(map(tuple, sorted(batch, key=key))) == sorted(map(tuple, sorted(stream, key=key)))
    errors = [r for r in batch if r["tier"] == screen.ERROR_TIER]
    assert errors and all(r["risk_score"] == 0 and r["action"].startswith("Screening failed") for r in errors)


def test_linear_contributions_sum_to_margin(spark):
    s = X.scored_accounts(spark, SF)
    chk = s.select((F.col("margin") - F.aggregate("contrib", F.lit(0.0), lambda a, x: a + x["shap"])).alias("d"),
                   "prob", "margin")
    for r in chk.collect():
        assert abs(r["prob"] - 1 / (1 + pytest.importorskip("math").exp(-r["margin"]))) < 1e-12
    base = chk.agg(F.min("d"), F.max("d")).first()
    assert base[0] == pytest.approx(base[1])  # the same intercept for every row


def test_absent_typology_attributes_take_their_defaults(spark):
    from riskloom.functions.typology import DEFAULTS, attribute, typology_columns

    df = spark.createDataFrame([(5.0,)], "age double")
    keys = ("age_bucket", "occupation", "missing_ratio", "account_type")
    some = typology_columns(*[attribute(df.columns, "age" if k == "age_bucket" else k, k) for k in keys])
    want = typology_columns(F.lit(5.0), *[F.lit(DEFAULTS[k]) for k in keys[1:]])
    r = df.select(*[v.alias(k) for k, v in some.items()], *[v.alias("want_" + k) for k, v in want.items()]).first()
    assert all(r[k] == r["want_" + k] for k in some)


def test_a_micro_batch_is_read_by_many_tasks(spark, tmp_path):
    rows = spark.createDataFrame([(str(i), {"a": str(i)}) for i in range(200)], "account_id string, features map<string,string>")
    files = screening.land(rows, str(tmp_path / "in"), 3)
    assert files > 1 and -(-len(list((tmp_path / "in").glob("part-*"))) // files) == 3
    assert spark.read.parquet(str(tmp_path / "in")).count() == 200


def test_calibration_reads_scores_that_were_made_once(spark, monkeypatch):
    clean = spark.range(50).select(F.col("id").alias("account_id"), (F.col("id") % 5 == 0).cast("int").alias("y"),
                                   *[(F.col("id") * (i + 1) % 17).cast("double").alias(f) for i, f in enumerate(S.FEATS)])
    params, seen = explain.fit_linear_scorer(clean, S.FEATS), []
    monkeypatch.setattr(S.alerts, "calibration_params", lambda scored, prob: seen.append(scored) or scored)
    S.calibration(clean, params)
    want = [r["prob"] for r in explain.linear_contributions(clean, params, S.FEATS).select("prob").collect()]
    assert sorted(r["prob"] for r in seen[0].collect()) == sorted(want)
    assert "EXP(" not in seen[0]._jdf.queryExecution().optimizedPlan().toString().upper()


def test_only_raising_factors_are_sorted(spark):
    row = _contrib_row(spark, [0.01, -0.3, 0.07, 0.2, -0.5, 0.06, 0.2, 0.0, 0.15]).select(
        "account_id", "contrib", F.col("prob").alias("ens"), F.lit(0.1).alias("p1"), F.lit(0.9).alias("p99"))
    out = screen.respond(row, ["account_id"], {}, "v")
    assert [x["feature"] for x in out.first()["top_risk_factors"]] == ["f3", "f6", "f8", "f2", "f5"]
    assert "array_sort(filter(" in out._jdf.queryExecution().analyzed().toString()


def test_the_error_filter_reads_finished_responses(spark):
    plan = S.q_screen_errors(spark, SF)._jdf.queryExecution().optimizedPlan().toString().upper()
    assert "EXP(" not in plan and "TRY_CAST" not in plan
