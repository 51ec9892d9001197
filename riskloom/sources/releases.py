"""Released models: all that screening needs, in one versioned folder.

A release holds the members' node table, the feature list with training medians, blend weights, calibration
percentiles and the mean contributions of the positives, and, if given, what recomputing a request's derived
columns takes. Its tables are written under a name of their own;
then a numbered manifest that names them is renamed into place, and the release with the highest number
is the current one. Readers load a release by its version, so a stream can go on with the one it began with.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators import boosting, derive, models
from riskloom.sources import store


@dataclass(frozen=True)
class Release:
    """A loaded release; each table has one row a feature, member or node."""

    version: str
    members: dict[str, list[dict]]
    features: list[str]
    medians: dict[str, float]
    weights: dict[str, float]
    calibration: tuple[float, float]
    explained: str
    mean_positive: dict[str, float]
    derivation: derive.Derivation | None = None


def publish(spark: SparkSession, root: str, *, nodes: DataFrame, features: list[str], medians: DataFrame, weights: DataFrame,
            calibration: DataFrame, class_means: DataFrame, explained: str, derivation: derive.Derivation | None = None) -> str:
    """Write a release below ``root`` and make it the current one; its version. ``nodes`` is a node table,
    ``medians`` (feature, median), ``weights`` (member, weight), ``calibration`` (p1, p99) and ``class_means``
    (feature, mean_shap_pos)."""
    folder = f"tables-{uuid.uuid4().hex}"
    where = os.path.join(root, folder)
    nodes.where(F.col("fold") == boosting.ALL).write.parquet(os.path.join(where, "nodes"))
    position = spark.createDataFrame(list(enumerate(features)), "pos int, feature string")
    position.join(medians.select("feature", "median"), "feature", "left").join(
        class_means.select("feature", "mean_shap_pos"), "feature", "left").write.parquet(os.path.join(where, "features"))
    weights.select("member", "weight").write.parquet(os.path.join(where, "weights"))
    calibration.select("p1", "p99").write.parquet(os.path.join(where, "calibration"))
    number = len(versions(spark, root)) + 1
    body = json.dumps({"tables": folder, "explained": explained,
                       "derivation": derivation and derive.save(derivation, os.path.join(where, "derivation"))})
    while not store.put_text(spark, os.path.join(root, f"release-{number:06d}"), body):
        number += 1
    return f"release-{number:06d}"


def versions(spark: SparkSession, root: str) -> list[str]:
    return [n for n in store.names(spark, root) if n.startswith("release-") and not n.endswith(".tmp")]


def current(spark: SparkSession, root: str) -> str:
    found = versions(spark, root)
    if not found:
        raise FileNotFoundError(f"no release in {root}")
    return found[-1]


def load(spark: SparkSession, root: str, version: str) -> Release:
    manifest = json.loads(store.get_text(spark, os.path.join(root, version)))

    def table(name: str) -> DataFrame:
        return spark.read.parquet(os.path.join(root, manifest["tables"], name))

    columns = table("features").orderBy("pos").collect()
    cal = table("calibration").first()
    text = manifest.get("derivation")
    derivation = derive.load(spark, os.path.join(root, manifest["tables"], "derivation"), text) if text else None
    return Release(version, models.final_members(table("nodes")), [r["feature"] for r in columns], {r["feature"]: r["median"] for r in columns},
                   {r["member"]: r["weight"] for r in table("weights").collect()}, (cal["p1"], cal["p99"]), manifest["explained"],
                   {r["feature"]: r["mean_shap_pos"] or 0.0 for r in columns}, derivation)
