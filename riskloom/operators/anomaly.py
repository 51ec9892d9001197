"""Anomaly scores: isolation forest, PCA reconstruction error.

Isolation forest (Liu, Ting & Zhou 2008): each tree is grown on at most 256 rows
drawn by a seeded hash, so a tree is one small ``applyInPandas`` group whatever
the table size; the node table (trees x <= 511 nodes) is a bounded broadcast and
scoring is a vectorised ``mapInPandas`` over Arrow batches. PCA: Spark ML fits the
components on the negatives; the error of every row is computed batch-wise."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.params import attach_params
from riskloom.functions.quantiles import exact_percentiles

N_TREES = 100
MAX_SAMPLES = 256
MIN_CONTAMINATION = 0.005
NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, size int, depth int"


def avg_path_length(n):
    """c(n): average path length of an unsuccessful search in a binary search tree."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[n == 2] = 1.0
    nb = n[big]
    out[big] = 2.0 * (np.log(nb - 1.0) + np.euler_gamma) - 2.0 * (nb - 1.0) / nb
    return out


def _grow(X: np.ndarray, rng: np.random.Generator, max_depth: int, tree: int) -> list[tuple]:
    nodes: list[list] = []

    def build(idx: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append([tree, me, -1, 0.0, -1, -1, len(idx), depth])
        if depth >= max_depth or len(idx) <= 1:
            return me
        sub = X[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if usable.size == 0:
            return me
        f = int(rng.choice(usable))
        thr = float(rng.uniform(lo[f], hi[f]))
        go_left = sub[:, f] < thr
        if go_left.all() or not go_left.any():
            return me
        nodes[me][2], nodes[me][3] = f, thr
        nodes[me][4] = build(idx[go_left], depth + 1)
        nodes[me][5] = build(idx[~go_left], depth + 1)
        return me

    build(np.arange(len(X)), 0)
    return [tuple(n) for n in nodes]


def fit_isolation_forest(df: DataFrame, col: str = "features", n_trees: int = N_TREES,
                         max_samples: int = MAX_SAMPLES, seed: int = 42, fit_filter: Column | None = None,
                         id_col: str = "account_id") -> tuple[DataFrame, int]:
    """Node table of ``n_trees`` isolation trees and the per-tree sample size."""
    fit = df if fit_filter is None else df.where(fit_filter)
    n = fit.count()
    psi = int(min(max_samples, n))
    frac = min(1.0, 3.0 * psi / max(n, 1))  # oversample 3x, then keep the psi smallest keys
    cut = int(frac * 2147483647)
    trees = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)),
                     lambda t: F.pmod(F.xxhash64(F.lit(seed), t, F.col(id_col)), F.lit(2147483648)) <= F.lit(cut))
    picked = fit.select(F.explode(trees).alias("tree"), F.col(id_col), F.col(col).cast("array<double>").alias("x"))
    picked = picked.withColumn("key", F.xxhash64(F.lit(seed + 1), F.col("tree"), F.col(id_col)))
    max_depth = int(math.ceil(math.log2(max(psi, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["key", id_col]).head(psi)
        t = int(pdf["tree"].iloc[0])
        X = np.vstack(pdf["x"].to_numpy())
        rng = np.random.default_rng([seed, t])
        return pd.DataFrame(_grow(X, rng, max_depth, t), columns=NODE_SCHEMA_COLS)

    nodes = picked.groupBy("tree").applyInPandas(grow, NODE_SCHEMA)
    return nodes, psi


NODE_SCHEMA_COLS = [c.split()[0] for c in NODE_SCHEMA.split(", ")]


def tree_arrays(nodes: pd.DataFrame) -> list[tuple]:
    """Per tree: (feature, threshold, left, right, size, depth) arrays indexed by node."""
    out = []
    for _, t in nodes.groupby("tree"):
        t = t.sort_values("node")
        out.append(tuple(t[c].to_numpy() for c in ("feature", "threshold", "left", "right", "size", "depth")))
    return out


def _path_lengths(X: np.ndarray, trees: list[tuple]) -> np.ndarray:
    total = np.zeros(len(X))
    rows = np.arange(len(X))
    for feat, thr, left, right, size, depth in trees:
        at = np.zeros(len(X), dtype=int)
        for _ in range(int(depth.max()) + 1):
            f = feat[at]
            inner = f >= 0
            if not inner.any():
                break
            xv = X[rows, np.where(inner, f, 0)]
            at = np.where(inner, np.where(xv < thr[at], left[at], right[at]), at)
        total += depth[at] + avg_path_length(size[at])
    return total / max(len(trees), 1)


def isolation_scores(df: DataFrame, nodes: DataFrame, psi: int, col: str = "features",
                     id_col: str = "account_id") -> DataFrame:
    """Adds ``if_score`` = -2^(-E[h]/c(psi)) (higher = more normal). The node table
    is bounded (trees x nodes) and shipped to the tasks once."""
    nd = tree_arrays(nodes.toPandas())
    c = float(avg_path_length([psi])[0]) or 1.0
    schema = df.select(id_col).schema.add("if_score", "double")

    def score(batches):
        for pdf in batches:
            X = np.vstack(pdf[col].to_numpy()) if len(pdf) else np.zeros((0, 1))
            h = _path_lengths(X, nd) if len(pdf) else np.zeros(0)
            yield pd.DataFrame({id_col: pdf[id_col], "if_score": -np.power(2.0, -h / c)})


    return df.select(id_col, F.col(col).cast("array<double>").alias(col)).mapInPandas(score, schema)


def isolation_forest(df: DataFrame, col: str = "features", label: str = "y", fit_filter: Column | None = None,
                     seed: int = 42) -> DataFrame:
    """``(account_id, if_score, if_decision, if_anomaly)``: decision = score minus its
    contamination-th percentile over the fitting rows, contamination = max(rate, 0.005)."""
    fit = df if fit_filter is None else df.where(fit_filter)
    nodes, psi = fit_isolation_forest(df, col, seed=seed, fit_filter=fit_filter)
    scored = isolation_scores(df, nodes, psi, col)
    rate = fit.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0
    cont = max(rate, MIN_CONTAMINATION)
    from riskloom.session import cut_lineage

    scored = cut_lineage(scored)  # the offset and the output both read the scores
    fit_scores = scored if fit_filter is None else scored.join(fit.select("account_id"), "account_id", "left_semi")
    offset = exact_percentiles(fit_scores, "if_score", [cont], names=["_offset"])
    out = attach_params(scored, offset).withColumn("if_decision", F.col("if_score") - F.col("_offset"))
    return out.withColumn("if_anomaly", (F.col("if_decision") < 0).cast("int")).drop("_offset")


def pca_recon_error(df: DataFrame, col: str = "features", label: str = "y", fit_filter: Column | None = None,
                    k_max: int = 20) -> DataFrame:
    """``(account_id, recon_error)``: standardise (fitting rows, population std),
    fit PCA with k = min(20, d // 2) on the fitting negatives, error = mean squared
    residual of x - (mu + (x - mu) P P^T) with mu the negatives' mean."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector

    from riskloom.operators.fitted import standardize
    from riskloom.session import cut_lineage

    # the width, the PCA, the mean and the output all read the standardised rows
    std = cut_lineage(standardize(df.withColumn(col, F.col(col).cast("array<double>")), col, fit_filter, out="_z"))
    fit = std if fit_filter is None else std.where(fit_filter)
    neg = fit.where(F.col(label) != 1)
    d = len(neg.select("_z").first()["_z"])
    k = max(1, min(k_max, d // 2))
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(neg.select(array_to_vector("_z").alias("_v")))
    P = model.pc.toArray()  # d x k, bounded by the feature count
    mu_row = neg.select(F.posexplode("_z").alias("i", "v")).groupBy("i").agg(F.avg("v").alias("m")).orderBy("i")
    mu = np.array([r["m"] for r in mu_row.collect()])  # d values

    @F.pandas_udf("double")
    def err(z: pd.Series) -> pd.Series:
        X = np.vstack(z.to_numpy()) - mu
        proj = X @ P
        return pd.Series(((X * X).sum(axis=1) - (proj * proj).sum(axis=1)) / X.shape[1])

    return std.select("account_id", F.greatest(err("_z"), F.lit(0.0)).alias("recon_error"))


# Families that feed the anomaly detectors (plus the key features).
ANOMALY_PREFIXES = ("beh_", "feat_", "meta_")


def anomaly_input_columns(columns, keys) -> list[str]:
    """Columns of the anomaly detectors: behaviour, temporal and meta families plus the
    key features, in column order."""
    return [c for c in columns if c.startswith(ANOMALY_PREFIXES) or c in set(keys)]


def with_anomaly_vector(df: DataFrame, keys, out: str = "features") -> DataFrame:
    cols = anomaly_input_columns(df.columns, keys)
    return df.withColumn(out, F.array(*[F.col(c).cast("double") for c in cols]))


def fold_moments(df: DataFrame, center: np.ndarray, scale: np.ndarray, col: str = "features", label: str = "y", fold_col: str = "fold") -> dict:
    """(fold, positive) -> (rows, sums, cross products) of (x - center) / scale: summed in tasks, then by
    group; one row of d x d numbers per fold and class reaches the driver."""
    d = len(center)
    schema = "fold int, positive boolean, sums binary"

    def run(batches):
        held: dict[tuple[int, bool], np.ndarray] = {}
        for pdf in batches:
            x = (np.array(pdf["x"].tolist(), dtype=float).reshape(len(pdf), d) - center) / scale
            x = np.hstack([np.ones((len(x), 1)), x])
            for key in set(zip(pdf["fold"], pdf["positive"], strict=True)):
                own = x[((pdf["fold"] == key[0]) & (pdf["positive"] == key[1])).to_numpy()]
                held[key] = held.get(key, 0) + own.T @ own  # first row and column: count and sums
        yield pd.DataFrame([(f, p, m.tobytes()) for (f, p), m in held.items()], columns=["fold", "positive", "sums"])

    def add(pdf):
        total = np.sum([np.frombuffer(b) for b in pdf["sums"]], axis=0)
        return pdf.iloc[:1][["fold", "positive"]].assign(sums=[total.tobytes()])

    rows = df.select(F.col(fold_col).cast("int").alias("fold"), (F.col(label) == 1).alias("positive"), F.col(col).cast("array<double>").alias("x"))
    got = rows.mapInPandas(run, schema).groupBy("fold", "positive").applyInPandas(add, schema).collect()
    return {(r["fold"], r["positive"]): np.frombuffer(r["sums"]).reshape(d + 1, d + 1) for r in got}


def fold_pca_error(df: DataFrame, k: int = 5, col: str = "features", label: str = "y", fold_col: str = "fold", k_max: int = 20) -> DataFrame:
    """``(account_id, recon_error)``: each row's error under the scaler and projection that were fitted on
    the other folds (``pca_recon_error`` with ``fit_filter=fold != i`` for each i). One aggregate of moments by
    fold and class serves all fits: the moments of the other folds are added up on the driver (d x d numbers a
    fold), and one pass scores all rows. Moments are taken around the total mean, in units of the total
    deviation, so no digits cancel. A column that is constant in the fitting rows keeps its unit."""
    from riskloom.operators.fitted import array_moments

    total = {r["pos"]: (r["mean"], r["std"]) for r in array_moments(df, col).collect()}  # d rows
    d = len(total)
    center = np.array([total[i][0] for i in range(d)])
    scale = np.array([total[i][1] or 1.0 for i in range(d)])
    moments = fold_moments(df, center, scale, col, label, fold_col)
    width = max(1, min(k_max, d // 2))
    fits = {}
    for i in range(k):
        other = [(p, m) for (f, p), m in moments.items() if f != i]
        if not any(not p for p, _ in other):
            continue
        whole, neg = sum(m for _, m in other), sum(m for p, m in other if not p)
        mean = whole[0, 1:] / whole[0, 0]
        var = np.diag(whole)[1:] / whole[0, 0] - mean ** 2
        sd = np.where(var > 1e-12, np.sqrt(np.maximum(var, 0)), 1.0 / scale)
        mu = neg[0, 1:] / neg[0, 0]
        cov = (neg[1:, 1:] / neg[0, 0] - np.outer(mu, mu)) / np.outer(sd, sd)
        _, vectors = np.linalg.eigh(cov)
        fits[i] = (mu, sd, vectors[:, ::-1][:, :width])

    def score(batches):
        for pdf in batches:
            x = (np.array(pdf["x"].tolist(), dtype=float).reshape(len(pdf), d) - center) / scale
            out = np.full(len(pdf), np.nan)
            for i, (mu, sd, p) in fits.items():
                own = (pdf["fold"] == i).to_numpy()
                z = (x[own] - mu) / sd
                proj = z @ p
                out[own] = np.maximum(((z * z).sum(axis=1) - (proj * proj).sum(axis=1)) / d, 0.0)
            yield pd.DataFrame({"account_id": pdf["account_id"], "recon_error": out})

    rows = df.select("account_id", F.col(fold_col).cast("int").alias("fold"), F.col(col).cast("array<double>").alias("x"))
    schema = f"account_id {df.schema['account_id'].dataType.simpleString()}, recon_error double"
    return rows.mapInPandas(score, schema).withColumn("recon_error", F.nanvl("recon_error", F.lit(None).cast("double")))


def fold_isolation_forest(df: DataFrame, k: int = 5, col: str = "features", label: str = "y",
                          fold_col: str = "fold", seed: int = 42, n_trees: int = N_TREES,
                          max_samples: int = MAX_SAMPLES, id_col: str = "account_id") -> DataFrame:
    """In-fold isolation forests in one pass: forest i is grown on rows outside fold i
    (groups keyed by (i, tree), each <= 3 x 256 sampled rows), every row is scored
    by all k forests in one Arrow pass, forest i's offset is the contamination
    percentile over its own training rows, and each row keeps the decision of the
    forest that did not see it. ``(account_id, fold, if_score, if_decision, if_anomaly)``."""
    sizes = df.groupBy(fold_col).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(label).cast("double")).alias("r"))
    st = {r[fold_col]: (r["n"], r["r"]) for r in sizes.collect()}  # k rows
    total = sum(n for n, _ in st.values())
    n_fit = {i: total - st.get(i, (0, 0))[0] for i in range(k)}
    psi = {i: int(min(max_samples, max(n_fit[i], 1))) for i in range(k)}
    frac = min(1.0, 3.0 * max(psi.values()) / max(min(n_fit.values()), 1))
    cut = int(frac * 2147483647)
    held_out = F.filter(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: i != F.col(fold_col))
    trees = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)),
                     lambda t: F.pmod(F.xxhash64(F.lit(seed), t, F.col(id_col)), F.lit(2147483648)) <= F.lit(cut))
    # tree membership depends on the row only: hash once per row, then fan out to forests
    picked = df.select(F.col(id_col), F.col(fold_col), F.col(col).cast("array<double>").alias("x"),
                       trees.alias("_trees")) \
        .select(F.explode(held_out).alias("forest"), id_col, "x", "_trees") \
        .select("forest", id_col, "x", F.explode("_trees").alias("tree"))
    picked = picked.withColumn("key", F.xxhash64(F.lit(seed + 1), F.col("tree"), F.col(id_col)))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        forest, t = int(pdf["forest"].iloc[0]), int(pdf["tree"].iloc[0])
        m = psi[forest]
        pdf = pdf.sort_values(["key", id_col]).head(m)
        rng = np.random.default_rng([seed, t])
        depth = int(math.ceil(math.log2(max(m, 2))))
        nodes = pd.DataFrame(_grow(np.vstack(pdf["x"].to_numpy()), rng, depth, t), columns=NODE_SCHEMA_COLS)
        return nodes.assign(forest=forest)

    nodes = picked.groupBy("forest", "tree").applyInPandas(grow, NODE_SCHEMA + ", forest int").toPandas()
    c = {i: float(avg_path_length([psi[i]])[0]) or 1.0 for i in range(k)}
    by_forest = {i: tree_arrays(g) for i, g in nodes.groupby("forest")}

    def score(batches):
        for pdf in batches:
            X = np.vstack(pdf[col].to_numpy()) if len(pdf) else np.zeros((0, 1))
            out = {id_col: pdf[id_col], fold_col: pdf[fold_col]}
            for i in range(k):
                h = _path_lengths(X, by_forest[i]) if len(pdf) else np.zeros(0)
                out[f"s{i}"] = -np.power(2.0, -h / c[i])
            yield pd.DataFrame(out)

    schema = f"{id_col} long, {fold_col} int, " + ", ".join(f"s{i} double" for i in range(k))
    from riskloom.session import cut_lineage

    scored = cut_lineage(df.select(id_col, fold_col, F.col(col).cast("array<double>").alias(col))
                         .mapInPandas(score, schema))  # offsets and output both read the scores
    long = scored.select(id_col, fold_col, F.explode(F.array(*[
        F.struct(F.lit(i).alias("forest"), F.col(f"s{i}").alias("s")) for i in range(k)])).alias("e")) \
        .select(id_col, fold_col, "e.forest", "e.s")
    cont = {i: max((sum(st[j][0] * st[j][1] for j in st if j != i) / max(n_fit[i], 1)),
                   MIN_CONTAMINATION) for i in range(k)}
    # one grouped percentile call: each forest's training rows, every forest's rate
    train = long.where(F.col("forest") != F.col(fold_col))
    pc = exact_percentiles(train, "s", [cont[i] for i in range(k)], by=["forest"], names=[f"_o{i}" for i in range(k)])
    pick = None
    for i in range(k):
        pick = F.when(F.col("forest") == i, F.col(f"_o{i}")) if pick is None else pick.when(F.col("forest") == i, F.col(f"_o{i}"))
    off = pc.select("forest", pick.alias("_offset"))
    own = long.where(F.col("forest") == F.col(fold_col)).join(F.broadcast(off), "forest")  # k rows
    out = own.select(id_col, fold_col, F.col("s").alias("if_score"), (F.col("s") - F.col("_offset")).alias("if_decision"))
    return out.withColumn("if_anomaly", (F.col("if_decision") < 0).cast("int"))
