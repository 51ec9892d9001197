"""Boosted members against plain programs that grow one tree at a time on all rows."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import boosting as B
from riskloom.operators import models
from tests.bruteforce import average_precision

ROWS, WIDTH = 1000, 7


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(ROWS, WIDTH))
    x[:, 5] = rng.integers(0, 3, ROWS)
    x[::11, 2] = np.nan
    y = (x[:, 0] + x[:, 1] * x[:, 3] + (x[:, 5] == 2) + 0.3 * rng.normal(size=ROWS) > 1.5).astype(int)
    return x, y


@pytest.fixture(scope="module")
def table(spark, data):
    x, y = data
    rows = [(f"a{i}", int(y[i]), i % 3, [None if np.isnan(v) else float(v) for v in x[i]]) for i in range(ROWS)]
    return spark.createDataFrame(rows, "account_id string, y int, fold int, features array<double>").repartition(3).cache()


class Plain:
    """Splits by trying every cut of every column on the rows themselves."""

    def __init__(self, m, bins, y, w):
        self.m, self.bins, self.y, self.w = m, bins, y, w
        self.margin = np.full(len(y), np.log(w[y == 1].sum() / w[y == 0].sum()))

    def score(self, rows):
        g, h = self.g[rows].sum(), self.h[rows].sum()
        return max(abs(g) - self.m.l1, 0) ** 2 / (h + self.m.l2)

    def gains(self, rows, strict=True):
        out = {}
        for f in range(self.bins.shape[1]):
            for b in range(B.BINS - 1):
                left, right = rows[self.bins[rows, f] <= b], rows[self.bins[rows, f] > b]
                if strict and any(len(s) < self.m.least_rows or self.h[s].sum() < self.m.least_weight for s in (left, right)):
                    continue
                out[f, b] = self.score(left) + self.score(right) - self.score(rows)
        return out

    @staticmethod
    def top(gains):
        best = max((round(v, 9) for v in gains.values()), default=0)
        return min((k for k, v in gains.items() if round(v, 9) == best), default=None), best

    def value(self, rows):
        g, h = self.g[rows].sum(), self.h[rows].sum()
        return -np.sign(g) * max(abs(g) - self.m.l1, 0) / (h + self.m.l2) * self.m.step

    def tree(self):
        """{path: (feature, bin)} in order of growth; leaves get their values."""
        p = 1 / (1 + np.exp(-self.margin))
        self.g, self.h = self.w * (p - self.y), self.w * p * (1 - p)
        leaves, splits = {"": np.arange(len(self.y))}, {}
        grow = {"level": self.by_level, "leaf": self.by_gain, "symmetric": self.by_sum}[self.m.growth]
        grow(leaves, splits)
        for rows in leaves.values():
            self.margin[rows] += self.value(rows)
        return splits, {p: self.value(r) for p, r in leaves.items()}

    def cut(self, leaves, splits, path, f, b):
        rows = leaves.pop(path)
        splits[path] = (f, b)
        leaves[path + "0"], leaves[path + "1"] = rows[self.bins[rows, f] <= b], rows[self.bins[rows, f] > b]

    def by_level(self, leaves, splits):
        for _ in range(self.m.depth):
            for path in sorted(p for p in leaves if len(p) == _):
                at, gain = self.top(self.gains(leaves[path]))
                if at and gain > B.LEAST_GAIN:
                    self.cut(leaves, splits, path, *at)

    def by_gain(self, leaves, splits):
        known = {}
        while len(leaves) < self.m.leaves:
            for path in leaves:
                if path not in known:
                    known[path] = self.top(self.gains(leaves[path]))
            path = min(leaves, key=lambda p: (-known[p][1], p))
            at, gain = known[path]
            if not at or gain <= B.LEAST_GAIN:
                return
            self.cut(leaves, splits, path, *at)

    def by_sum(self, leaves, splits):
        for _ in range(self.m.depth):
            each = [self.gains(rows, strict=False) for rows in leaves.values()]
            at, gain = self.top({k: sum(g[k] for g in each) for k in each[0]})
            if gain <= B.LEAST_GAIN:
                return
            for path in list(leaves):
                self.cut(leaves, splits, path, *at)


def walk(t, node=0, path=""):
    """({path: (feature, bin)}, {path: value}) of a fitted tree."""
    if t["feature"][node] < 0:
        return {}, {path: t["value"][node]}
    splits, leaves = {path: (int(t["feature"][node]), int(t["bin"][node]))}, {}
    for child, turn in ((t["left"][node], "0"), (t["right"][node], "1")):
        a, b = walk(t, child, path + turn)
        splits.update(a)
        leaves.update(b)
    return splits, leaves


SMALL = [replace(B.LEVEL, depth=3, least_weight=3.0), replace(B.LEAF, leaves=9), replace(B.SYMMETRIC, depth=3)]


@pytest.mark.parametrize("member", SMALL, ids=lambda m: m.growth)
@pytest.mark.parametrize("part_rows", [200, 200_000])
def test_trees_equal_those_of_a_plain_program(table, data, member, part_rows, monkeypatch):
    """Split by split, with rows in one partition and in several, with columns in one block and in several."""
    monkeypatch.setattr(B, "PART_ROWS", part_rows)
    monkeypatch.setattr(B, "FEATURE_BLOCK", 3)
    monkeypatch.setattr(B, "REFRESH", 2)
    m = replace(member, rounds=4 if member.growth != "symmetric" else 12, patience=20, row_share=1.0, column_share=1.0)
    fitted, blocks, cuts = B.fit(table, [m], [1])
    x, y = data
    key = {r["account_id"]: r["key"] for r in table.select("account_id", F.xxhash64(F.lit(42), "account_id").alias("key")).collect()}
    keys = np.array([key[f"a{i}"] for i in range(ROWS)])
    inner = B.is_inner(keys)
    train = (np.arange(ROWS) % 3 != 1) & ~inner
    bins = B.to_bins(x, cuts)
    n1, n0 = y[train].sum(), (1 - y[train]).sum()
    w = np.where(y[train] == 1, n0 / n1, 1.0) if m.weighting == "ratio" else np.where(y[train] == 1, len(y[train]) / (2 * n1), len(y[train]) / (2 * n0))
    plain = Plain(m, bins[train], y[train], w)
    trees = fitted[m.name, 1]
    assert len(trees) - 1 >= 2
    margin = np.full(ROWS, trees[0]["prior"])
    for t in trees[1:]:
        splits, leaves = plain.tree()
        got = walk(t)
        assert got[0] == splits
        if m.growth == "leaf":  # nodes are numbered as they split
            order = [p for _, p in sorted((min(t["left"][n], t["right"][n]), p) for p, n in paths(t).items() if t["feature"][n] >= 0)]
            assert order == list(splits)
        assert got[1].keys() == leaves.keys() and all(abs(got[1][p] - v) < 1e-9 for p, v in leaves.items())
        margin += t["value"][B.place(t, bins)]
    assert np.allclose(B.margins(trees, x), margin)  # by thresholds as by bins


def paths(t, node=0, path=""):
    out = {path: node}
    if t["feature"][node] >= 0:
        out |= paths(t, t["left"][node], path + "0") | paths(t, t["right"][node], path + "1")
    return out


@pytest.fixture(scope="module")
def trained(table):
    shapes = [replace(B.LEVEL, depth=3, rounds=30, patience=6), replace(B.LEAF, leaves=12, rounds=30, patience=6), replace(B.SYMMETRIC, depth=4, rounds=30, patience=6)]
    nodes, oof = models.train(table, shapes, k=3)
    return nodes.cache(), oof.cache()


def test_every_row_is_scored_by_models_that_never_saw_it(trained, table, data):
    nodes, oof = trained
    x, y = data
    got = oof.toPandas()
    assert len(got) == 3 * ROWS and not got.duplicated(["member", "account_id"]).any()
    fitted = B.read_nodes(nodes)
    at = got.account_id.str[1:].astype(int).to_numpy()
    for (name, fold), g in got.groupby(["member", "fold"]):
        want = 1 / (1 + np.exp(-B.margins(fitted[name, fold], x[at[g.index]])))
        assert np.allclose(g.prob, want) and (at[g.index] % 3 == fold).all()
    single = {n: B.margins(t[:2], x) for (n, f), t in fitted.items() if f == B.ALL}
    for name, trees in models.final_members(nodes).items():
        assert len(trees) - 1 > 1, (name, len(trees))  # boosting goes on past the first tree
        p = lambda m: np.clip(1 / (1 + np.exp(-m)), 1e-12, 1 - 1e-12)
        w = np.where(y == 1, (y == 0).sum() / y.sum(), 1.0)
        loss = lambda m: -(w * np.where(y == 1, np.log(p(m)), np.log(1 - p(m)))).sum()
        assert loss(B.margins(trees, x)) < loss(single[name])
        g = got[got.member == name]
        assert average_precision(g.y.to_numpy(), g.prob.to_numpy()) > 1.5 * y.mean()


def test_contributions_of_every_member_add_up_to_its_odds(trained, table):
    nodes, _ = trained
    final = models.final_members(nodes)
    scored = models.score(table, final).toPandas().set_index("account_id")
    for name, trees in final.items():
        c = models.contributions(table, trees, WIDTH, [f"f{i}" for i in range(WIDTH)]).toPandas()
        total = c.groupby("account_id").shap.sum() + c.groupby("account_id").base.first()
        assert np.abs(total - scored[f"{name}_odds"].loc[total.index]).max() < 1e-9
        assert np.allclose(scored[name], 1 / (1 + np.exp(-scored[f"{name}_odds"])))


def test_the_ledger_holds_every_split(trained):
    nodes, _ = trained
    names = [f"c{i}" for i in range(WIDTH)]
    ledger = B.split_ledger(nodes, names)
    pdf, fitted = ledger.toPandas(), B.read_nodes(nodes)
    assert len(pdf) == sum((t["feature"] >= 0).sum() for trees in fitted.values() for t in trees[1:])
    imp = B.importances(ledger).toPandas().set_index(["member", "feature"])
    want = pdf.groupby(["member", "feature"]).gain.agg(["size", "sum", "mean"])
    assert np.allclose(imp.loc[want.index, ["splits", "total_gain", "mean_gain"]], want)
    assert (pdf[pdf.member != "symmetric"].gain > 0).all()


def test_one_class_no_column_and_no_row(spark, table):
    few = [replace(B.LEVEL, rounds=3)]
    one, blocks, _ = B.fit(table.withColumn("y", F.lit(0)), few, [0, B.ALL])
    assert [len(t) for t in one.values()] == [1, 1] and one["level", 0][0]["prior"] < -5
    empty, blocks, _ = B.fit(table.where("false"), few, [0, B.ALL])
    assert B.oof_scores(empty, blocks).count() == 0


def test_the_metric_and_its_stop():
    rng = np.random.default_rng(0)
    step, y = rng.integers(0, 50, 400), rng.integers(0, 2, 400)
    counts = np.bincount(y * B.STEPS + step, minlength=2 * B.STEPS).reshape(2, -1)
    assert abs(B.rank_metric(counts, "ap") - average_precision(y, step.astype(float))) < 1e-12
    pos, neg = step[y == 1][:, None], step[y == 0][None]
    assert abs(B.rank_metric(counts, "auc") - ((pos > neg).mean() + (pos == neg).mean() / 2)) < 1e-12
    g = B.GROWTHS["level"](0, replace(B.LEVEL, patience=3), 0, 4, (1.0, 1.0), 0.0, False)
    leaf = [{"gain": 0.0, "total": (1.0, 2.0, 9.0)}]
    g.receive(None, leaf)
    seen = [0.2, 0.5, 0.4, 0.5, 0.3, 0.9]
    for k, metric in enumerate(seen):
        g.receive(metric, leaf)
        if g.ended:
            break
    assert (k, g.best, g.best_metric) == (4, 2, 0.5)


def test_first_block_without_rows_of_a_node(spark, monkeypatch):
    """Blocks of a partition add up although the first one has no row of the nodes asked for."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(1200):
        rare, v, w = i % 20 == 0, float(rng.random()), float(rng.random())  # positives among a few rows only
        rows.append((i, int(rare and (v > 0.5) != (w > 0.8)), i % 3, [float(rare), v, w]))
    df = spark.createDataFrame(rows, "account_id long, y int, fold int, features array<double>")
    members = [replace(m, rounds=3) for m in B.MEMBERS]
    whole, _, _ = B.fit(df, members, (0, B.ALL))
    monkeypatch.setattr(B, "BLOCK_ROWS", 8)
    monkeypatch.setattr(B, "PART_ROWS", 200)  # more than one partition
    small, _, _ = B.fit(df, members, (0, B.ALL))
    assert whole.keys() == small.keys()
    for key, trees in whole.items():
        assert len(trees) == len(small[key])
        for a, b in zip(trees[1:], small[key][1:], strict=True):
            assert a["feature"].tolist() == b["feature"].tolist() and a["rows"].tolist() == b["rows"].tolist()
            assert a["value"] == pytest.approx(b["value"])


def test_jobs_of_a_small_table_do_not_grow_with_its_rounds(spark, table):
    """The models of a table of one partition grow in one job, however many trees they take."""
    jobs = {}
    for rounds in (2, 6):
        spark.sparkContext.setJobGroup(f"fit-{rounds}", "fit")
        models_, _, _ = B.fit(table, [replace(m, rounds=rounds) for m in B.MEMBERS], (0, B.ALL))
        jobs[rounds] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"fit-{rounds}"))
        assert all(1 <= len(trees) - 1 <= rounds for trees in models_.values())
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[2] == jobs[6]


def test_node_table_of_a_model_without_trees(spark):
    """A model that ended before its first tree still has its prior, and models come back from their table as they were."""
    tree = {"feature": np.array([1, -1, -1]), "bin": np.array([3, 0, 0]), "threshold": np.array([0.5, np.inf, np.inf]), "left": np.array([1, -1, -1]),
            "right": np.array([2, -1, -1]), "value": np.array([0.0, 0.1, -0.1]), "gain": np.array([2.0, 0.0, 0.0]), "rows": np.array([9, 4, 5]),
            "codes": np.array([0]), "leaf_of": np.array([1, 2])}
    made = {("level", 0): [{"prior": -0.5}], ("symmetric", B.ALL): [{"prior": 0.25}, tree]}
    back = B.read_nodes(B.node_table(spark, made))
    assert back["level", 0] == [{"prior": -0.5}] and back["symmetric", B.ALL][0] == {"prior": 0.25}
    for c, v in tree.items():
        assert back["symmetric", B.ALL][1][c].tolist() == v.tolist()


def _blocks(data, sizes):
    x, y = data
    cuts = [np.unique(np.nanquantile(x[:, j], np.arange(1, B.BINS) / B.BINS)) for j in range(x.shape[1])]
    bins, key, fold = B.to_bins(x, cuts), np.arange(len(y)) * 7919, np.arange(len(y)).astype(np.int8) % 3
    cells = [c.astype(t) for c, t in ((y, np.uint8), (fold, np.int8), (key, np.int64))]
    ends = np.cumsum([0, *sizes])
    return [B.Block({"block": k, "ids": None, "bins": bins[a:b].tobytes(), "margin": np.zeros((b - a, 2)).tobytes(),
                     **{n: c[a:b].tobytes() for n, c in zip(("y", "fold", "key"), cells, strict=True)}})
            for k, (a, b) in enumerate(zip(ends, ends[1:], strict=False))]


@pytest.mark.parametrize("member", B.MEMBERS, ids=lambda m: m.name)
@pytest.mark.parametrize("fold", [1, B.ALL])
def test_a_model_in_its_own_task_finds_what_the_blocks_find(data, member, fold, monkeypatch):
    blocks = _blocks(data, [400, 1, 599])
    m = replace(member, rounds=4, patience=9)
    g = B.GROWTHS[m.growth](1, m, fold, WIDTH, (1.0, 2.5), -0.5, False)
    local, counted = B.LocalRows(blocks, g.request()), []
    monkeypatch.setattr(B, "_FEW_ROWS", 100)  # both ways of counting
    monkeypatch.setattr(B.LocalRows, "counted", lambda self, rows, bins, f=B.LocalRows.counted: (counted.append(len(rows)), f(self, rows, bins))[1])
    B._KEPT.clear()
    trees = 0
    while not g.ended:
        s, want, before = g.request(), {}, len(counted)
        for b in blocks:
            B._add(want, b, s, f"own {member.name} {fold}")
        got = dict(local.sums(s))
        assert got.keys() == want.keys()
        for key, v in want.items():
            assert got[key].shape == v.shape and np.allclose(got[key], v, rtol=1e-9, atol=1e-9)
            if key[1] >= 0:
                assert (got[key][:, v[2] == 0] == 0).all()
                assert s["waits"].tolist() == [0] or 2 * sum(counted[before:]) <= len(local.g)  # of two siblings the one with fewer rows
        trees = max(trees, s["count"])
        g.receive(*B._merged(B._answer(got.items(), {g.index: s}), {g.index: s})[g.index])
    assert trees == 4


def test_list_columns_become_a_matrix():
    import pyarrow as pa

    rows = [[1.0, None], [float("nan"), 4.0], [5.0, 6.0]]
    for column in (pa.array(rows), pa.array([[0.0], *rows]).slice(1), pa.array(rows, pa.list_(pa.float64()))):
        assert np.array_equal(B.matrix(column), [[1, np.nan], [np.nan, 4], [5, 6]], equal_nan=True)
    with pytest.raises(ValueError):
        B.matrix(pa.array([[1.0], [2.0, 3.0], [4.0]]))
