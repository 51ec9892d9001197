"""Recomputed request vectors: graph, edge cases, equality with a plain program."""

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskloom.operators import derive, screen
from riskloom.sources import releases
from tests.test_releases import release

REQUEST = "account_id string, features map<string,string>"


@pytest.fixture(scope="module")
def fitted_small(spark):
    rows = [(i, i % 2, float(i), None if i % 4 == 0 else float(i * i), "ab"[i % 2], f"n{i % 3}", f"0{1 + i % 9}-05-2020") for i in range(1, 13)]
    raw = spark.createDataFrame(rows, "account_id long, y int, p double, q double, kind string, place string, opened string")
    from riskloom.operators import encode, features

    plan = [{"feature": "kind", "encoding": "ordinal"}, {"feature": "place", "encoding": "frequency"}]
    t = encode.apply_encodings(features.add_temporal(raw, "opened", dt.date(2021, 1, 1)), plan, {})
    cols = ["p", "q", "kind", "place"]
    counted = [c for c in t.columns if c not in ("account_id", "y")]
    t = t.select("*", *[v.alias(k) for k, v in features.row_meta_columns(counted).items()], F.col("q").isNull().cast("double").alias("miss_flag_q"))
    num = [c for c in t.columns if c not in ("account_id", "y")]
    t = features.add_row_stats(features.impute(t, features.medians(t, num), num))
    return raw, t, derive.fit(raw, t, columns=cols, encodings={"kind": "ordinal", "place": "frequency"}, manual={}, date_col="opened",
                              ref_date=dt.date(2021, 1, 1), flags=["q"], keys=["p", "q"], ratios=[("p", "q")], age_keys=["p"], z_targets=["p", "beh_row_mean"])


NAMES = ["p", "q", "kind", "place", "feat_account_age_days", "feat_opening_month", "meta_missing_count", "miss_flag_q", "beh_row_mean", "int_pxq", "ratio_p_q",
         "int_age_p", "z_p", "zflag_p", "z_beh_row_mean", "z_composite_score"]


def vectors(spark, d, requests, names=NAMES):
    return [r.asDict() for r in derive.recompute(spark.createDataFrame(requests, REQUEST), d, names).collect()]


def medians_of(d):
    return {r["feature"]: r["median"] for r in d.medians.collect()}


def test_whole_rows_give_their_training_rows(spark, fitted_small):
    raw, train, d = fitted_small
    given = [(str(r["account_id"]), {c: None if r[c] is None else str(r[c]) for c in ("p", "q", "kind", "place", "opened")}) for r in raw.collect()]
    want = {str(r["account_id"]): r.asDict() for r in train.collect()}
    shared = [n for n in NAMES if n in train.columns]
    for v in vectors(spark, d, given):
        assert v["parse_error"] is None
        assert {n: v[n] for n in shared} == pytest.approx({n: want[v["account_id"]][n] for n in shared})
        assert v["int_pxq"] == pytest.approx(v["p"] * v["q"])


def test_only_dependents_of_supplied_names_change(spark, fitted_small):
    d = fitted_small[2]
    m = medians_of(d)
    (v,) = vectors(spark, d, [("r", {"p": "40"})])
    moments = d.zparams.first()
    assert v["p"] == 40 and v["int_pxq"] == 40 * m["q"] and v["int_age_p"] == 40 * m["feat_account_age_days"]
    assert v["z_p"] == pytest.approx(min((40 - moments["_mu_p"]) / (moments["_sd_p"] + 1e-9), 10)) and v["zflag_p"] == float(abs(v["z_p"]) > 3)
    assert v["beh_row_mean"] == pytest.approx((40 + m["q"] + m["kind"] + m["place"]) / 4)
    assert v["meta_missing_count"] == 0  # an absent name counts as present
    assert {n: v[n] for n in ("q", "kind", "place", "feat_account_age_days", "miss_flag_q")} == {
        n: m[n] for n in ("q", "kind", "place", "feat_account_age_days", "miss_flag_q")}


def test_edge_requests(spark, fitted_small):
    d = fitted_small[2]
    m = medians_of(d)
    rows = [("empty", {}), ("null", None), ("twice", {"q": None}), ("twice", {"q": "2"}), ("bad", {"p": "x1", "q": "2"}), ("unknown", {"zzz": "oops"}),
            ("category", {"kind": "never", "place": "never"}), ("own", {"p": "3", "int_pxq": "7", "feat_account_age_days": "11"}), ("date", {"opened": "99-99-9999"})]
    got = vectors(spark, d, rows)
    assert len(got) == len(rows)
    by = {v["account_id"]: v for v in got}
    for k in ("empty", "null", "unknown"):
        assert {n: by[k][n] for n in NAMES} == {n: m[n] for n in NAMES} and by[k]["parse_error"] is None
    assert sorted(v["miss_flag_q"] for v in got if v["account_id"] == "twice") == [0.0, 1.0]
    assert sorted(v["meta_missing_count"] for v in got if v["account_id"] == "twice") == [0.0, 1.0]
    assert by["bad"]["parse_error"] == "could not convert value of p to float"
    assert (by["category"]["kind"], by["category"]["place"]) == (-1.0, 0.0)
    assert (by["own"]["int_pxq"], by["own"]["feat_account_age_days"], by["own"]["int_age_p"]) == (7.0, 11.0, 33.0)
    assert (by["date"]["feat_account_age_days"], by["date"]["feat_opening_month"]) == (-1.0, 0.0)
    assert vectors(spark, d, []) == []


def test_levels_follow_the_graph(fitted_small):
    graph = derive.rules(fitted_small[2])
    place = {n: i for i, level in enumerate(derive.levels(graph, ["z_composite_score", "int_age_p"])) for r in level for n in r.outputs}
    assert place["feat_account_age_days"] < place["int_age_p"]
    assert place["beh_row_mean"] < place["z_beh_row_mean"] < place["z_composite_score"]
    assert "int_pxq" not in place  # nothing that isn't asked for
    assert {"p", "q", "kind", "place"} <= derive.roots(graph)["z_beh_row_mean"] and "opened" in derive.roots(graph)["int_age_p"]


def test_a_release_recomputes(spark, fitted_small, tmp_path, monkeypatch):
    d = fitted_small[2]
    root = str(tmp_path / "r")
    publish = releases.publish
    requests = spark.createDataFrame([("r", {"a": "2", "p": "4"}), ("bad", {"b": "x"})], REQUEST)
    release(spark, root, {"level": (0, 1.5, -1.0, 1.0)})
    plain = releases.load(spark, root, releases.current(spark, root))
    with pytest.raises(ValueError, match="without its derivation"):
        screen.screen_release(requests, plain, {}, derive="recompute")
    with pytest.raises(ValueError, match="median"):
        screen.screen_release(requests, plain, {}, derive="other")
    # the same member on the product of p and q, published with the derivation
    monkeypatch.setattr(releases, "publish", lambda *a, features, medians, class_means, **k: publish(
        *a, **k, features=["int_pxq", "b"], derivation=d, medians=spark.createDataFrame([("int_pxq", 1.0), ("b", 2.0)], "feature string, median double"),
        class_means=spark.createDataFrame([("int_pxq", 0.3), ("b", -0.1)], "feature string, mean_shap_pos double")))
    release(spark, root, {"level": (0, 4.5 * medians_of(d)["q"], -1.0, 1.0)})
    rel = releases.load(spark, root, releases.current(spark, root))
    more = requests.unionByName(spark.createDataFrame([("over", {"p": "5"})], REQUEST))
    got = {r["account_id"]: r for r in screen.screen_release(more, rel, {}, derive="recompute").collect()}
    assert got["r"]["fraud_probability"] < 0.5 < got["over"]["fraud_probability"]
    assert got["bad"]["tier"] == "ERROR" and "value of b" in got["bad"]["action"]
    same = {r["account_id"]: r["fraud_probability"] for r in screen.screen_release(more, rel, {}).collect()}
    assert same["r"] == same["over"]  # by default the product keeps its median
    given = [("r", {"p": "4", "q": "3", "kind": "a", "place": "n1", "opened": "03-05-2020"})]
    assert vectors(spark, rel.derivation, given) == vectors(spark, d, given)
    whole = derive.recompute(requests, d, ["a", "p"], spark.createDataFrame([("a", 5.0)], "feature string, median double")).orderBy("account_id").collect()
    assert [(r["a"], r["p"]) for r in whole] == [(5.0, medians_of(d)["p"]), (2.0, 4.0)]  # names beside the graph: supplied value or given median


def test_shares_are_merged_not_sent_through_the_driver(spark, fitted_small, tmp_path):
    d = fitted_small[2]
    d.shares.write.parquet(str(tmp_path / "shares"))
    given = spark.createDataFrame([("r", {"place": "n1"}), ("s", {"place": "none"})], REQUEST).withColumnRenamed("features", "__given")
    out = derive._with_shares(given, dataclasses.replace(d, shares=spark.read.parquet(str(tmp_path / "shares"))))
    merges = [x for x in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in x and "category" in x]
    assert len(merges) == 1 and "SortMergeJoin" in merges[0]
    assert {r["account_id"]: r["__shares"] for r in out.collect()} == {"r": {"place": pytest.approx(4 / 12)}, "s": None}
