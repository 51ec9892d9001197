"""Screening of new accounts: sparse requests -> full vectors -> ensemble
probability -> calibrated score -> tier -> factors -> typology -> response.
The same DataFrame transform serves batch and streaming input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fallback_contributions(scored: DataFrame, class_means: DataFrame, prob: str = "prob") -> DataFrame:
    """Per account and feature: mean positive-class contribution x p / 0.5.
    ``class_means`` (feature, mean_shap_pos) has one row per feature (broadcast)."""
    means = class_means.agg(F.collect_list(F.struct("feature", "mean_shap_pos")).alias("_m"))
    from riskloom.functions.params import attach_params

    a = attach_params(scored, means)
    ex = a.select("account_id", F.col(prob).alias("_p"), F.explode("_m").alias("m"))
    return ex.select("account_id", F.col("m.feature").alias("feature"),
                     (F.col("m.mean_shap_pos") * (F.col("_p") / 0.5)).alias("shap"))


# Default member weights when none were fitted, model version tag.
DEFAULT_WEIGHTS = {"xgb": 0.35, "lgb": 0.31, "cb": 0.34}
MODEL_VERSION = "1.0.0"
ERROR_TIER = "ERROR"


def ensemble_score(df: DataFrame, members: dict[str, str], weights: dict[str, float] | None = None,
                   out: str = "prob") -> DataFrame:
    """Weighted mean of the available members' probabilities; the weights are
    renormalised over the members present (``members``: weight name -> column)."""
    weights = weights or DEFAULT_WEIGHTS
    used = {k: c for k, c in members.items() if k in weights}
    total = sum(weights[k] for k in used)
    expr = None
    for k, c in used.items():
        term = F.lit(weights[k]) * F.col(c)
        expr = term if expr is None else expr + term
    return df.withColumn(out, expr / F.lit(total))


def request_vectors(requests: DataFrame, medians: DataFrame, features: list[str]) -> DataFrame:
    """Sparse requests ``(account_id, features MAP<STRING,STRING>)`` -> one column per
    catalog feature: the supplied value (known names only) or the training median.
    ``parse_error`` holds the first supplied known name whose value is not a number.
    Unknown names are ignored; derived columns keep their median."""
    from riskloom.functions.params import attach_params

    med = medians.agg(F.map_from_entries(F.collect_list(F.struct("feature", "median"))).alias("_med"))
    j = attach_params(requests, med)  # one row: a map of catalog size
    known = F.array(*[F.lit(f) for f in features])
    bad = F.filter(F.map_keys("features"), lambda k: F.array_contains(known, k)
                   & F.col("features")[k].isNotNull() & F.col("features")[k].try_cast("double").isNull())
    cols = [F.coalesce(F.col("features")[f].try_cast("double"), F.col("_med")[f]).alias(f) for f in features]
    err = F.when(F.size(bad) > 0, F.concat(F.lit("could not convert value of "), F.element_at(F.array_sort(bad), 1),
                                            F.lit(" to float")))
    return j.select("account_id", *cols, err.alias("parse_error"))


def screen(vectors: DataFrame, scorer_params: DataFrame, calibration: DataFrame, features: list[str],
           typology_attrs: dict[str, str]) -> DataFrame:
    """Vector -> probability of the closed-form linear scorer -> response."""
    from riskloom.functions.params import attach_params
    from riskloom.operators.explain import linear_contributions

    s = linear_contributions(vectors, scorer_params, features)
    s = ensemble_score(s, {"xgb": "prob"}, out="ens")
    return respond(attach_params(s, calibration.select("p1", "p99")), vectors.columns, typology_attrs, MODEL_VERSION)


def respond(s: DataFrame, columns: list[str], typology_attrs: dict[str, str], version: str) -> DataFrame:
    """(ens, contrib, p1, p99 and the vector's ``columns``) -> calibrated score -> tier -> top-5 factors -> typology."""
    from riskloom.functions.scoring import action_col, calibrated_score, magnitude_col, tier_col
    from riskloom.functions.typology import attribute, typology_columns

    score = calibrated_score("ens", F.col("p1"), F.col("p99"))
    s = s.withColumn("risk_score", score).withColumn("tier", tier_col("risk_score"))
    raising = F.filter("contrib", lambda x: x["shap"] > 0)  # the sort is the dearest step of a row: only what may be listed
    by_desc = F.array_sort(raising, lambda a, b: F.when(a["shap"] > b["shap"], -1).when(a["shap"] < b["shap"], 1)
                           .otherwise(F.when(a["feature"] < b["feature"], -1).when(a["feature"] > b["feature"], 1).otherwise(0)))
    top = F.transform(F.slice(by_desc, 1, 5), lambda x: F.struct(
        x["feature"].alias("feature"), F.bround(x["value"], 4).alias("value"),
        F.bround(x["shap"], 4).alias("shap_contrib"), magnitude_col(x["shap"]).alias("magnitude")))
    a = typology_attrs
    typo = typology_columns(*[attribute(columns, a.get(k), name) for k, name in (
        ("age", "age_bucket"), ("occupation", "occupation"), ("missing", "missing_ratio"), ("acct_type", "account_type"))], None)
    return s.select(
        *[c for c in ("parse_error",) if c in columns], "account_id", "risk_score", "tier", F.bround("ens", 4).alias("fraud_probability"),
        action_col("tier", screening=True).alias("action"), top.alias("top_risk_factors"),
        F.struct(*[v.alias(k) for k, v in typo.items()]).alias("typology"),
        F.lit(version).alias("model_version"))


def screen_requests(requests: DataFrame, medians: DataFrame, scorer_params: DataFrame, calibration: DataFrame,
                    features: list[str], typology_attrs: dict[str, str]) -> DataFrame:
    """Batch screening with per-row failures, in one pass: rows whose supplied values do not
    parse get tier ERROR, score 0 and the message; the rest are screened."""
    v = request_vectors(requests, medians, features)
    parsed = F.col("parse_error").isNull()
    v = v.select(*[F.when(parsed, F.col(c)).otherwise(F.lit(0.0)).alias(c) if c in features else F.col(c) for c in v.columns])
    return with_failures(screen(v, scorer_params, calibration, features, typology_attrs))


def with_failures(out: DataFrame) -> DataFrame:
    """Responses whose ``parse_error`` is set become tier ERROR, score 0 and the message."""
    parsed = F.col("parse_error").isNull()
    failed = {"risk_score": F.lit(0), "tier": F.lit(ERROR_TIER), "fraud_probability": F.lit(0.0),
              "action": F.concat(F.lit("Screening failed: "), "parse_error"),
              "top_risk_factors": F.array().cast(out.schema["top_risk_factors"].dataType),
              "typology": F.lit(None).cast(out.schema["typology"].dataType)}
    return out.select(*[F.when(parsed, F.col(c)).otherwise(failed[c]).alias(c) if c in failed else F.col(c)
                        for c in out.columns if c != "parse_error"])


def member_contributions(vectors: DataFrame, release, typology: list[str]) -> DataFrame:
    """``account_id``, ``parse_error``, the typology columns, ``ens`` (the members' probabilities by the blend's
    weights, over the members that the release has) and ``contrib`` in log-odds of the explained member. Without
    that member contributions fall back to the positives' mean contributions times p / 0.5. One Arrow pass."""
    import numpy as np
    import pyarrow as pa
    from pyspark.sql import types as T

    from riskloom.operators import boosting, treeshap

    names = release.features
    members = {m: t for m, t in release.members.items() if release.weights.get(m)}
    weight = {m: release.weights[m] for m in members}  # the tasks get these, not the release with its tables
    total = sum(weight.values())
    trees = release.members.get(release.explained)
    paths = [treeshap.leaf_paths({**t, "cover": t["rows"]}) for t in trees[1:]] if trees else None
    means = np.array([release.mean_positive[f] for f in names])
    item = T.StructType.fromDDL("feature string, value double, shap double")
    keep = ["account_id", "parse_error", *typology]
    schema = T.StructType([*[vectors.schema[c] for c in keep], T.StructField("ens", T.DoubleType()), T.StructField("contrib", T.ArrayType(item))])

    def run(batches):
        for b in batches:
            x = np.array(b.column("__x").to_pylist(), dtype=float).reshape(b.num_rows, -1)
            prob = sum(weight[m] / (1 + np.exp(-np.clip(boosting.margins(t, x), -500, 500))) for m, t in members.items()) / total
            if paths is None:
                shap = means[None] * (prob / 0.5)[:, None]
            else:
                shap, safe = np.zeros(x.shape), np.where(np.isnan(x), -np.inf, x)
                for leaves in paths:
                    treeshap.add_contributions(safe, leaves, shap)
            fields = pa.StructArray.from_arrays([pa.array(np.tile(np.array(names, dtype=object), len(x))), pa.array(x.ravel()), pa.array(shap.ravel())],
                                                names=["feature", "value", "shap"])
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(names))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(prob), pa.ListArray.from_arrays(ends, fields)], names=schema.names)

    rows = vectors.select(*keep, F.array(*[F.col(f"`{f}`").cast("double") for f in names]).alias("__x"))
    return rows.mapInArrow(run, schema)


def screen_release(requests: DataFrame, release, typology_attrs: dict[str, str], derive: str = "median") -> DataFrame:
    """Batch screening by the members, weights, medians and calibration of one release, with per-row failures.
    Derived columns keep their training medians, or follow the supplied values with ``derive="recompute"``
    (for a release that holds its derivation)."""
    from riskloom.operators.derive import recompute

    spark = requests.sparkSession
    medians = spark.createDataFrame([(f, m) for f, m in release.medians.items()], "feature string, median double")
    if derive == "recompute":
        if release.derivation is None:
            raise ValueError(f"{release.version} was published without its derivation")
        v = recompute(requests, release.derivation, release.features, medians)
    elif derive == "median":
        v = request_vectors(requests, medians, release.features)
    else:
        raise ValueError(f"derive must be 'median' or 'recompute', not {derive!r}")
    parsed = F.col("parse_error").isNull()
    v = v.select(*[F.when(parsed, F.col(c)).otherwise(F.lit(0.0)).alias(c) if c in release.features else F.col(c) for c in v.columns])
    used = list(dict.fromkeys(c for c in typology_attrs.values() if c in v.columns))
    scored = member_contributions(v, release, used).withColumns(
        {"p1": F.lit(release.calibration[0]), "p99": F.lit(release.calibration[1])})
    return with_failures(respond(scored, v.columns, typology_attrs, release.version))
