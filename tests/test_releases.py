"""Artifacts across applications, released models, the stream that follows them."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from riskloom.operators import boosting, screen
from riskloom.sources import artifacts, releases, store
from riskloom.streaming import screening as stream

ROOT = Path(__file__).resolve().parents[1]


def test_a_second_application_builds_nothing(tmp_path):
    """Two applications with one shared folder; a half-written artifact is not read; changed input is."""
    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
from riskloom.sources import artifacts
s = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate()
built = []
def build():
    built.append(1)
    return s.range(int(sys.argv[1]))
n = artifacts.materialized(s, "t", {str(tmp_path / "in")!r}, build).count()
a, b = artifacts.materialized_all(s, ("u", "v"), {str(tmp_path / "in")!r}, lambda: (built.append(1), (s.range(2), s.range(3)))[1])
print("RESULT", len(built), n, a.count(), b.count())
"""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.parquet").write_text("1")

    def run(n):
        out = subprocess.run([sys.executable, "-c", code, str(n)], check=True, capture_output=True, text=True, timeout=200).stdout
        return [line.split()[1:] for line in out.splitlines() if line.startswith("RESULT")][0]

    assert run(5) == ["2", "5", "2", "3"]
    assert run(6) == ["0", "5", "2", "3"]
    folder = next((tmp_path / "shared" / "artifacts").glob("t-*"))
    (folder / "manifest").unlink()  # as if the first application had died before its commit
    (folder / ".manifest.crc").unlink(missing_ok=True)
    assert run(7) == ["1", "7", "2", "3"]
    (tmp_path / "in" / "x.parquet").write_text("12")
    assert run(8)[:2] == ["2", "8"]


def release(spark, root, members, p99=0.9, explained="level"):
    """A release whose members are single splits: (feature, threshold, left, right)."""
    models = {(m, boosting.ALL): [{"prior": 0.0}, {"feature": [f, -1, -1], "bin": [0, 0, 0], "threshold": [cut, 0.0, 0.0], "left": [1, -1, -1], "right": [2, -1, -1],
                                                   "value": [0.0, a, b], "gain": [1.0, 0.0, 0.0], "rows": [10.0, 4.0, 6.0]}] for m, (f, cut, a, b) in members.items()}
    frame = lambda rows, ddl: spark.createDataFrame(rows, ddl)
    return releases.publish(spark, root, nodes=boosting.node_table(spark, models), features=["a", "b"], explained=explained,
                            medians=frame([("a", 1.0), ("b", 2.0)], "feature string, median double"),
                            weights=frame([(m, 0.25 * (i + 1)) for i, m in enumerate(members)], "member string, weight double"),
                            calibration=frame([(0.1, p99)], "p1 double, p99 double"),
                            class_means=frame([("a", 0.3), ("b", -0.1)], "feature string, mean_shap_pos double"))


@pytest.fixture(scope="module")
def requests(spark):
    rows = [(f"r{i}", {"a": str(i % 5), "zz": "1"} if i % 3 else {"b": str(i)}) for i in range(12)] + [("bad", {"a": "x"}), ("none", {})]
    return spark.createDataFrame(rows, "account_id string, features map<string,string>")


def test_members_are_weighted_and_explained(spark, requests, tmp_path):
    root = str(tmp_path / "r")
    release(spark, root, {"level": (0, 1.5, -1.0, 2.0), "leaf": (1, 3.0, 0.5, -0.5)})
    rel = releases.load(spark, root, releases.current(spark, root))
    got = {r["account_id"]: r for r in screen.screen_release(requests, rel, {}).collect()}
    sig = lambda z: 1 / (1 + 2.718281828459045 ** -z)
    for i in range(12):
        a, b = (i % 5, 2.0) if i % 3 else (1.0, i)
        want = (0.25 * sig(-1.0 if a <= 1.5 else 2.0) + 0.5 * sig(0.5 if b <= 3 else -0.5)) / 0.75
        r = got[f"r{i}"]
        assert r["fraud_probability"] == round(want, 4) and r["risk_score"] == round(max(0, min(1000, (want - 0.1) / (0.8 + 1e-9) * 1000)))
        base = -1.0 * 0.4 + 2.0 * 0.6
        factors = [(x["feature"], x["shap_contrib"]) for x in r["top_risk_factors"]]
        assert factors == ([("a", round(2.0 - base, 4))] if a > 1.5 else [])
        assert r["model_version"] == "release-000001"
    assert got["bad"]["tier"] == "ERROR" and got["bad"]["risk_score"] == 0 and got["none"]["tier"] != "ERROR"


def test_without_the_explained_member_factors_fall_back(spark, requests, tmp_path):
    root = str(tmp_path / "r")
    release(spark, root, {"leaf": (1, 3.0, 0.5, -0.5)})
    rel = releases.load(spark, root, releases.current(spark, root))
    for r in screen.screen_release(requests.where("account_id != 'bad'"), rel, {}).collect():
        assert [(x["feature"], x["shap_contrib"]) for x in r["top_risk_factors"]] == [("a", pytest.approx(0.3 * r["fraud_probability"] / 0.5, abs=1e-4))]


def test_stream_follows_releases_and_a_replayed_batch_keeps_its_own(spark, requests, tmp_path, monkeypatch):
    root, landing, sink, point = (str(tmp_path / x) for x in ("r", "in", "out", "point"))
    first = release(spark, root, {"level": (0, 1.5, -1.0, 2.0)})
    halves = [requests.where(F.crc32("account_id") % 2 == k) for k in (0, 1)]
    halves[0].coalesce(1).write.parquet(landing)
    fails = {"left": 1}
    whole = screen.screen_release

    def dies(batch, rel, attrs):  # the batch dies after its version was noted, and a new model comes before it runs again
        if fails["left"]:
            fails["left"] = 0
            raise RuntimeError("driver lost")
        return whole(batch, rel, attrs)

    monkeypatch.setattr(stream.screen, "screen_release", dies)

    def run():
        stream.start_release_stream(spark, landing, sink, point, root, {}, requests.schema, files_per_batch=1).awaitTermination()

    with pytest.raises(Exception, match="driver lost"):
        run()
    second = release(spark, root, {"level": (1, 3.0, 0.2, 1.0), "leaf": (0, 0.5, -0.3, 0.4)}, p99=0.8)
    run()
    halves[1].coalesce(1).write.mode("append").parquet(landing)
    run()
    out = spark.read.parquet(sink).drop("batch_id")
    assert out.count() == requests.count()
    for half, version in zip(halves, (first, second), strict=True):
        want = whole(half, releases.load(spark, root, version), {})
        got = out.where(F.col("model_version") == version)
        assert sorted(map(str, want.collect())) == sorted(map(str, got.select(*want.columns).collect()))


def test_names_are_taken_once(spark, tmp_path):
    path = os.path.join(str(tmp_path), "d", "note")
    assert store.get_text(spark, path) is None
    assert store.put_text(spark, path, "ü1") and not store.put_text(spark, path, "2")
    assert store.get_text(spark, path) == "ü1" and [n for n in store.names(spark, str(tmp_path / "d")) if not n.startswith(".")] == ["note"]
    with pytest.raises(FileNotFoundError):
        releases.current(spark, str(tmp_path))
    assert artifacts.content_key(spark, "/nowhere") == artifacts.content_key(spark, "/nowhere")
