"""Second-order histogram boosting of several members on all folds at once (O-52..O-56, O-58, O-59).

Columns are quantised once to byte bins and stored in row blocks together with the margins of every
model (a member fitted without one fold, or on all rows). A job asks every model that still grows for the
gradient, hessian and row sums by (node, feature, bin) of the nodes it waits for: blocks are summed in their
tasks, histograms of a model and feature block are added across partitions, the best split of each node is
found where the sum ends, and the driver gets one row a node and feature block. So a level of all
members and folds is one job, whatever their number, and the models needn't be in step: a member that
finished its tree asks for the next root while another is still deep in its own.

Growth: ``level`` splits all nodes of a level (depth bound); ``leaf`` splits the open leaf of most gain
until its leaf bound (nodes that may come next are looked up ahead, so a job answers many of them; the
order is that of one split at a time); ``symmetric`` uses one split for a whole level, the one whose
gains over the level's nodes have the largest sum, and a leaf is the code of its comparisons.

Each tree ends with the metric of an inner split (a tenth of the rows by hash, not the held-out fold);
``patience`` rounds without a higher one end the model, which keeps the trees up to the best. A metric of
one can't be raised and ends it at once. Rows and columns of a round are sampled by hash.

Trees since the stored margins travel with the job; every ``REFRESH`` rounds the margins are written anew. A
worker may keep margins between its tasks; it only saves time, a lost worker computes them again.

A table of at most PART_ROWS rows is one partition; there each model grows in a task of its own, by the same steps,
and all models in one job. The jobs are RDD jobs, because hundreds of small ones are needed and each costs a third of a planned query.

Null and NaN values count as lower than any number.
"""

from __future__ import annotations

import heapq
import math
import pickle
import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.session import cut_lineage

#: Bins of a column; rows of a block; rows that make a further partition; columns of one histogram.
BINS, BLOCK_ROWS, PART_ROWS, FEATURE_BLOCK = 64, 4096, 200_000, 64
#: Rounds after which the margins are written; score steps of the metric; least gain of a split.
REFRESH, STEPS, LEAST_GAIN = 25, 4096, 1e-6
ALL = -1  # the fold of a model that is fitted on all rows


@dataclass(frozen=True)
class Member:
    """A booster's shape; the defaults are what the three members share."""

    name: str
    growth: str
    rounds: int = 800
    step: float = 0.05
    depth: int = 5
    leaves: int = 63
    least_weight: float = 0.0
    least_rows: int = 1
    l1: float = 0.1
    l2: float = 1.0
    row_share: float = 0.8
    column_share: float = 0.7
    patience: int = 50
    weighting: str = "ratio"
    metric: str = "ap"


LEVEL = Member("level", "level", depth=5, least_weight=3.0)
LEAF = Member("leaf", "leaf", leaves=63, least_rows=5)
SYMMETRIC = Member("symmetric", "symmetric", rounds=600, depth=6, l1=0.0, l2=3.0, row_share=1.0, column_share=1.0,
                   weighting="balanced", metric="auc")
MEMBERS = (LEVEL, LEAF, SYMMETRIC)


# ------------------------------------------------------------------ rows


def cut_points(df: DataFrame, features: str = "features", bins: int = BINS) -> list[np.ndarray]:
    """At most ``bins - 1`` ascending quantiles of each column (one grouped job); x <= cut goes left."""
    long = df.select(F.posexplode(F.col(features).cast("array<double>")).alias("pos", "x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    shares = [i / bins for i in range(1, bins)]
    rows = {r["pos"]: r["q"] for r in long.groupBy("pos").agg(F.percentile_approx("x", shares, 100 * bins).alias("q")).collect()}
    width = df.select(F.max(F.size(features))).first()[0] or 0
    return [np.unique(rows.get(i, [])) for i in range(width)]


def to_bins(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    x = np.where(np.isnan(x), -np.inf, x)
    return np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1).astype(np.uint8) if len(cuts) else np.zeros((len(x), 0), np.uint8)


def matrix(column: pa.Array) -> np.ndarray:
    """Rows x columns of a list column; a null cell is NaN."""
    if column.null_count or len(pc.unique(pc.list_value_length(column))) != 1:
        return np.array(column.to_pylist(), dtype=float).reshape(len(column), -1)
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def row_blocks(df: DataFrame, cuts: list[np.ndarray], models: int, id_col: str = "account_id", features: str = "features") -> DataFrame:
    """(block, ids, y, fold, key, bins, margin): up to BLOCK_ROWS rows packed into one row."""
    id_type = df.schema[id_col].dataType
    schema = T.StructType([T.StructField("ids", T.ArrayType(id_type)), *T.StructType.fromDDL("y binary, fold binary, key binary, bins binary, margin binary")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                b = whole.slice(at, BLOCK_ROWS)
                x = matrix(b.column("x"))
                cells = [b.column("y").to_numpy().astype(np.uint8), b.column("fold").to_numpy().astype(np.int8),
                         b.column("key").to_numpy().astype(np.int64), to_bins(x, cuts), np.zeros((b.num_rows, models))]
                yield pa.RecordBatch.from_arrays([pa.array([b.column("id").to_pylist()], pa.list_(b.schema.field("id").type)),
                                                  *[pa.array([c.tobytes()], pa.binary()) for c in cells]], names=schema.names)

    rows = df.select(F.col(id_col).alias("id"), (F.col("y") == 1).cast("int").alias("y"), F.col("fold").cast("int").alias("fold"),
                     F.xxhash64(F.lit(42), id_col).alias("key"), F.col(features).cast("array<double>").alias("x"))
    parts = -(-rows.count() // PART_ROWS) or 1
    packed = rows.repartition(parts, "key").mapInArrow(run, schema)
    return cut_lineage(packed.select(F.monotonically_increasing_id().alias("block"), "*"))


def _mix(x: np.ndarray) -> np.ndarray:
    """Splitmix finaliser on unsigned 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def share_of(key: np.ndarray, salt: int) -> np.ndarray:
    """A number in [0, 1) for each row and salt."""
    return (_mix(key.view(np.uint64) + _mix(np.array([salt], np.uint64))) >> np.uint64(11)) / float(1 << 53)


def is_inner(key: np.ndarray) -> np.ndarray:
    return share_of(key, 1) < 0.1


class Block:
    def __init__(self, row):
        self.no, self.ids = row["block"], row["ids"]
        self.y = np.frombuffer(row["y"], np.uint8)
        self.fold = np.frombuffer(row["fold"], np.int8)
        self.key = np.frombuffer(row["key"], np.int64)
        n = len(self.y)
        self.bins = np.frombuffer(row["bins"], np.uint8).reshape(n, -1) if n else np.zeros((0, 0), np.uint8)
        self.margin = np.frombuffer(row["margin"], np.float64).reshape(n, -1)
        self.inner = is_inner(self.key)


# ------------------------------------------------------------------ trees


def place(tree: dict, x: np.ndarray, cut: str = "bin") -> np.ndarray:
    """The leaf of each row of ``x``: bins with ``cut`` = bin, values with ``cut`` = threshold."""
    if "codes" in tree:  # symmetric: one comparison a level makes the code of the leaf
        code = np.zeros(len(x), np.int64)
        for k, j in enumerate(tree["codes"]):
            code |= (x[:, tree["feature"][j]] > tree[cut][j]).astype(np.int64) << k
        return tree["leaf_of"][code]
    at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
    feature, cuts = tree["feature"], tree[cut]
    while len(rows):
        f = feature[at[rows]]
        rows, f = rows[f >= 0], f[f >= 0]
        here = at[rows]
        at[rows] = np.where(x[rows, f] <= cuts[here], tree["left"][here], tree["right"][here])
    return at


def _leaf_value(g: float, h: float, m: Member) -> float:
    """Newton step with soft-thresholded gradient, times the learning rate."""
    return -math.copysign(max(abs(g) - m.l1, 0.0), g) / (h + m.l2) * m.step if h + m.l2 > 0 else 0.0


class Tree:
    """A tree while it grows: (feature, bin, left, right, gain, g, h, n) by node."""

    def __init__(self):
        self.feature, self.bin, self.left, self.right, self.gain = [-1], [0], [-1], [-1], [0.0]
        self.sums: list[tuple[float, float, float]] = [(0.0, 0.0, 0.0)]

    def split(self, node: int, s: dict) -> tuple[int, int]:
        pair = (len(self.feature), len(self.feature) + 1)
        for side in (s["left"], s["right"]):
            for column, v in ((self.feature, -1), (self.bin, 0), (self.left, -1), (self.right, -1), (self.gain, 0.0), (self.sums, side)):
                column.append(v)
        self.feature[node], self.bin[node], self.gain[node] = s["feature"], s["bin"], s["gain"]
        self.left[node], self.right[node] = pair
        return pair

    def shape(self) -> dict:
        return {"feature": np.array(self.feature), "bin": np.array(self.bin), "left": np.array(self.left), "right": np.array(self.right)}

    def done(self, m: Member) -> dict:
        value = [0.0 if f >= 0 else _leaf_value(g, h, m) for f, (g, h, _) in zip(self.feature, self.sums, strict=True)]
        return {**self.shape(), "gain": np.array(self.gain), "value": np.array(value), "rows": np.array([n for *_, n in self.sums])}


class Growth:
    """One model: its finished trees, the tree that grows, and what it waits for."""

    joint = False

    def __init__(self, index: int, member: Member, fold: int, features: int, weights: tuple[float, float], prior: float, all_rows: bool):
        self.index, self.m, self.fold, self.features = index, member, fold, features
        self.weights, self.prior, self.judge_all = weights, prior, all_rows
        self.trees: list[dict] = []
        self.stored = self.best = 0
        self.best_metric, self.ended, self.judge = -1.0, False, False
        self.start()

    def start(self) -> None:
        self.tree = Tree()
        salt = (self.index * 100_003 + len(self.trees)) * 2
        self.salt = salt + 1_000
        keep = max(1, math.ceil(self.m.column_share * self.features - 1e-9))
        rank = share_of(np.arange(self.features), salt + 1_001)
        self.columns = np.sort(np.argsort(rank, kind="stable")[:keep])
        self.begin()

    def request(self) -> dict:
        waits = [] if len(self.trees) >= self.m.rounds else self.waits
        return {"index": self.index, "fold": self.fold, "m": self.m, "weights": self.weights, "prior": self.prior, "judge": self.judge,
                "judge_all": self.judge_all, "trees": self.trees[self.stored:], "count": len(self.trees), "shape": self.tree.shape(),
                "waits": np.array(waits, np.int64), "columns": self.columns, "salt": self.salt, "joint": self.joint, "block": FEATURE_BLOCK}

    def receive(self, metric: float | None, splits: list[dict]) -> None:
        if self.judge:
            self.judge = False
            if metric > self.best_metric:
                self.best, self.best_metric = len(self.trees), metric
            if self.best_metric >= 1.0 or len(self.trees) - self.best >= self.m.patience or len(self.trees) >= self.m.rounds:
                self.ended = True
                return
        if self.tree.left[0] < 0 and splits:
            self.tree.sums[0] = splits[0]["total"]
        self.grow(splits)

    def finish(self, tree: Tree | None = None) -> None:
        done = (tree or self.tree).done(self.m)
        self.trees.append(done if not self.joint else self.coded(done))
        self.judge = True
        self.start()

    def may_split(self, node: int) -> bool:
        return self.tree.sums[node][2] >= 2 * self.m.least_rows


class LevelGrowth(Growth):
    def begin(self) -> None:
        self.waits, self.level = [0], 0

    def grow(self, splits: list[dict]) -> None:
        nodes, self.waits = self.waits, []
        self.level += 1
        for node, s in zip(nodes, splits, strict=True):
            if s["gain"] > LEAST_GAIN:
                self.waits += self.tree.split(node, s)
        self.waits = [n for n in self.waits if self.may_split(n)] if self.level < self.m.depth else []
        if not self.waits:
            self.finish()


class LeafGrowth(Growth):
    """``known`` has the best split of each node of the look-ahead tree, ``paths`` its way from the root."""

    def begin(self) -> None:
        self.waits, self.known, self.paths = [0], {}, {0: ""}

    def grow(self, splits: list[dict]) -> None:
        self.known.update(zip(self.waits, splits, strict=True))
        order, open_ = self.best_first()
        if open_ is None:
            return self.finish(self.pruned(order))
        self.waits = []
        for node in open_:
            for child, turn in zip(self.tree.split(node, self.known[node]), "01", strict=True):
                self.paths[child] = self.paths[node] + turn
                if self.may_split(child):
                    self.waits.append(child)
                else:
                    self.known[child] = {"gain": 0.0}
        if not self.waits:
            self.grow([])

    def best_first(self) -> tuple[list[int], list[int] | None]:
        """(nodes in the order they split, None), or the open nodes to look up where the order isn't known yet."""
        heap, order = [], []

        def push(node):
            if self.known[node]["gain"] > LEAST_GAIN:
                heapq.heappush(heap, (-self.known[node]["gain"], self.paths[node], node))

        push(0)
        while heap and len(order) + 1 < self.m.leaves:
            if self.tree.left[heap[0][2]] < 0:
                return order, [n for *_, n in sorted(heap) if self.tree.left[n] < 0][:self.m.leaves - 1 - len(order)]
            node = heapq.heappop(heap)[2]
            order.append(node)
            push(self.tree.left[node])
            push(self.tree.right[node])
        return order, None

    def pruned(self, order: list[int]) -> Tree:
        """The nodes of ``order`` and their children, without what was only looked up."""
        out, new = Tree(), {0: 0}
        out.sums[0] = self.tree.sums[0]
        for node in order:
            new[self.tree.left[node]], new[self.tree.right[node]] = out.split(new[node], self.known[node])
        return out


class SymmetricGrowth(Growth):
    joint = True

    def begin(self) -> None:
        self.waits, self.codes = [0], []

    def grow(self, splits: list[dict]) -> None:
        if splits[0]["joint"] > LEAST_GAIN:
            nodes = self.waits
            pairs = [self.tree.split(n, s) for n, s in zip(nodes, splits, strict=True)]
            self.codes.append(nodes[0])
            self.waits = [a for a, _ in pairs] + [b for _, b in pairs]  # bit k of a code: right at level k
            if len(self.codes) < self.m.depth:
                return
        self.finish()

    def coded(self, done: dict) -> dict:
        return {**done, "codes": np.array(self.codes, np.int64), "leaf_of": np.array(self.waits)}


GROWTHS = {"level": LevelGrowth, "leaf": LeafGrowth, "symmetric": SymmetricGrowth}


# ------------------------------------------------------------------ jobs

#: Margins that a worker keeps between its tasks: (token, block, model) -> (trees, margin).
_KEPT: dict[tuple, tuple[int, np.ndarray]] = {}
_KEPT_VALUES = 8_000_000


def _margin(block: Block, s: dict, token: str) -> np.ndarray:
    key = (token, block.no, s["index"])
    first = s["count"] - len(s["trees"])
    upto, margin = _KEPT.get(key, (first, block.margin[:, s["index"]] + s["prior"]))
    if upto < first:
        upto, margin = first, block.margin[:, s["index"]] + s["prior"]
    for tree in s["trees"][upto - first:]:
        margin = margin + tree["value"][place(tree, block.bins)]
    if len(_KEPT) and next(iter(_KEPT))[0] != token or sum(len(m) for _, m in _KEPT.values()) > _KEPT_VALUES:
        _KEPT.clear()
    _KEPT[key] = (s["count"], margin)
    return margin


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def sums(block: Block, s: dict, token: str, bins: int = BINS) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
    """What model ``s`` asks of a block: ((model, -1), score counts by class) and ((model, feature block),
    [gradient, hessian, rows] by node, feature and bin)."""
    margin = _margin(block, s, token)
    mine = block.fold != s["fold"]
    if s["judge"]:
        seen = mine & (block.inner | s["judge_all"])
        step = np.minimum((_sigmoid(margin[seen]) * STEPS).astype(np.int64), STEPS - 1)
        yield (s["index"], -1), np.bincount(block.y[seen].astype(np.int64) * STEPS + step, minlength=2 * STEPS).reshape(2, STEPS)
    if not len(s["waits"]):
        return
    use = np.flatnonzero(mine & (~block.inner | s["judge_all"]) & (share_of(block.key, s["salt"]) < s["m"].row_share))
    slot_of = np.full(len(s["shape"]["feature"]), -1)
    slot_of[s["waits"]] = np.arange(len(s["waits"]))
    cells = block.bins[use]
    slot = slot_of[place(s["shape"], cells)]
    waiting = slot >= 0
    if not waiting.all():
        use, slot, cells = use[waiting], slot[waiting], cells[waiting]
    y, p = block.y[use], _sigmoid(margin[use])
    w = np.where(y == 1, s["weights"][1], s["weights"][0])
    g, h = w * (p - y), w * p * (1 - p)
    size, first = len(s["waits"]) * bins, slot * bins
    for at in range(0, len(s["columns"]), s["block"]):
        cols = s["columns"][at:at + s["block"]]
        found = np.empty((3, len(s["waits"]), len(cols), bins))  # counts of no rows are integers, these never
        for j, c in enumerate(cols):
            cell = first + cells[:, c]
            for k, v in enumerate((g, h, None)):
                found[k, :, j] = np.bincount(cell, v, size).reshape(-1, bins)
        yield (s["index"], at), found


def _score(g: np.ndarray, h: np.ndarray, m: Member) -> np.ndarray:
    cut = np.sign(g) * np.maximum(np.abs(g) - m.l1, 0.0)
    return cut * cut / np.maximum(h + m.l2, 1e-300)


def best_splits(hist: np.ndarray, columns: np.ndarray, m: Member, joint: bool) -> list[dict]:
    """The best split of each node of a histogram [3, node, column, bin] (one for all nodes if ``joint``);
    equal gains (at 9 decimals): the lower column, then the lower bin."""
    upto = hist.cumsum(axis=3)
    total = upto[:, :, :1, -1:]
    low, high = upto[..., :-1], total - upto[..., :-1]
    gain = _score(low[0], low[1], m) + _score(high[0], high[1], m) - _score(total[0], total[1], m)
    if not joint:
        fits = (low[2] >= m.least_rows) & (high[2] >= m.least_rows) & (low[1] >= m.least_weight) & (high[1] >= m.least_weight)
        gain = np.where(fits, gain, -1.0)
    ranked = np.round(gain.sum(axis=0, keepdims=True) if joint else gain, 9).reshape(1 if joint else len(gain), -1)
    best = np.broadcast_to(ranked.argmax(axis=1), len(gain))
    out = []
    for i, at in enumerate(best.tolist()):
        c, b = divmod(at, gain.shape[2])
        out.append({"gain": float(gain[i, c, b]), "feature": int(columns[c]), "bin": b, "left": tuple(low[:, i, c, b].tolist()),
                    "right": tuple(high[:, i, c, b].tolist()), "total": tuple(total[:, i, 0, 0].tolist()), "joint": float(ranked[0, at]) if joint else 0.0})
    return out


def rank_metric(counts: np.ndarray, kind: str) -> float:
    """Average precision or ROC area of score counts [class, step]; ties within a step."""
    neg, pos = (c[::-1].astype(float) for c in counts)
    if not pos.sum() or not neg.sum():
        return 0.0
    if kind == "auc":
        return float((pos * (neg.sum() - neg.cumsum() + neg / 2)).sum() / (pos.sum() * neg.sum()))
    tp, fp = pos.cumsum(), neg.cumsum()
    return float((pos * tp / np.maximum(tp + fp, 1)).sum() / pos.sum())


def _add(held: dict[tuple[int, int], np.ndarray], block: Block, s: dict, token: str) -> None:
    for key, found in sums(block, s, token):
        if key in held:
            held[key] += found
        else:
            held[key] = found


def _answer(items: Iterable, by_index: dict[int, dict]) -> Iterator:
    for (index, at), found in items:
        s = by_index[index]
        if at < 0:
            yield index, at, rank_metric(found, s["m"].metric)
        else:
            yield index, at, best_splits(found, s["columns"][at:at + s["block"]], s["m"], s["joint"])


def _merged(answers: Iterable, by_index: dict[int, dict]) -> dict[int, tuple[float | None, list[dict]]]:
    """Each model's metric and its best split of every node over all feature blocks."""
    metric: dict[int, float] = {}
    splits: dict[int, list[dict]] = {}
    for index, at, x in sorted(answers, key=lambda r: r[:2]):
        if at < 0:
            metric[index] = x
        elif index not in splits:
            splits[index] = x
        elif by_index[index]["joint"]:
            splits[index] = x if x[0]["joint"] > splits[index][0]["joint"] else splits[index]
        else:
            splits[index] = [b if round(b["gain"], 9) > round(a["gain"], 9) else a for a, b in zip(splits[index], x, strict=True)]
    return {i: (metric.get(i), splits.get(i, [])) for i in by_index}


def _ask(rdd, groups: list[list[dict]], token: str) -> dict[int, tuple[float | None, list[dict]]]:
    """One job: the answers to all requests. Every group of models visits the same blocks in tasks of its own."""
    parts = rdd.getNumPartitions()
    by_index = {s["index"]: s for group in groups for s in group}

    def collect(i: int, rows: Iterable) -> Iterator:
        held: dict[tuple[int, int], np.ndarray] = {}
        for row in rows:
            block = Block(row)
            for s in groups[i // parts]:
                _add(held, block, s, token)
        return iter(held.items())

    found = rdd.context.union([rdd] * len(groups)).mapPartitionsWithIndex(collect)
    if parts > 1:  # one partition holds all rows of its models: nothing to add up
        found = found.reduceByKey(np.add, min(sum(len(g) for g in groups), parts))
    return _merged(found.mapPartitions(lambda items: _answer(items, by_index)).collect(), by_index)


#: Rows of a node up to which all its columns are counted in one call.
_FEW_ROWS = 1024


class LocalRows:
    """The rows that one model may see, in its own task: what ``sums`` finds block by block and from the root, with
    margins and the rows of each node kept between the steps of a tree. Of two siblings the one with fewer rows is
    counted, the other is what the parent's histogram has besides (bins without rows are exact zeros, as if counted)."""

    def __init__(self, blocks: Sequence[Block], s: dict):
        mine = [b.fold != s["fold"] for b in blocks]
        self.y, self.key, self.margin, self.x = (np.concatenate([v[k] for v, k in zip(each, mine, strict=True)]) for each in (
            [b.y for b in blocks], [b.key for b in blocks], [b.margin[:, s["index"]] + s["prior"] for b in blocks], [b.bins for b in blocks]))
        inner = is_inner(self.key)
        self.judged, self.fitted = np.flatnonzero(inner | s["judge_all"]), np.flatnonzero(~inner | s["judge_all"])
        self.by_column = np.ascontiguousarray(self.x.T)
        self.trees, self.salt = s["count"] - len(s["trees"]), None

    def sums(self, s: dict, bins: int = BINS) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
        """As ``sums`` over all blocks."""
        for tree in s["trees"][len(s["trees"]) - (s["count"] - self.trees):]:
            self.margin += tree["value"][place(tree, self.x)]
            self.trees += 1
        if s["judge"]:
            step = np.minimum((_sigmoid(self.margin[self.judged]) * STEPS).astype(np.int64), STEPS - 1)
            yield (s["index"], -1), np.bincount(self.y[self.judged].astype(np.int64) * STEPS + step, minlength=2 * STEPS).reshape(2, STEPS)
        if not len(s["waits"]):
            return
        if self.salt != s["salt"]:
            self.begin(s)
        self.follow(s)
        found = np.stack([self.histogram(n, bins) for n in s["waits"].tolist()], axis=1)
        for at in range(0, len(s["columns"]), s["block"]):
            yield (s["index"], at), found[:, :, at:at + s["block"]]

    def begin(self, s: dict) -> None:
        """A new tree: its sampled rows and columns, their gradients and hessians."""
        use = self.fitted[share_of(self.key[self.fitted], s["salt"]) < s["m"].row_share]
        y, p = self.y[use], _sigmoid(self.margin[use])
        w = np.where(y == 1, s["weights"][1], s["weights"][0])
        self.g, self.h, self.salt = w * (p - y), w * p * (1 - p), s["salt"]
        self.cells = np.stack([self.by_column[c][use] for c in s["columns"]])
        self.at = {c: j for j, c in enumerate(s["columns"].tolist())}
        self.rows, self.pair, self.held = {0: np.arange(len(use))}, {}, {}

    def follow(self, s: dict) -> None:
        """Deal the rows of nodes that were split since to their children."""
        shape = s["shape"]
        for n in sorted(n for n in self.rows if shape["left"][n] >= 0):
            rows = self.rows.pop(n)
            left, right = int(shape["left"][n]), int(shape["right"][n])
            goes = self.cells[self.at[int(shape["feature"][n])]][rows] <= shape["bin"][n]
            self.rows[left], self.rows[right] = rows[goes], rows[~goes]
            self.pair[left], self.pair[right] = (n, right), (n, left)

    def histogram(self, node: int, bins: int) -> np.ndarray:
        """[gradient, hessian, rows] of a node by column and bin."""
        if node not in self.held:
            parent, other = self.pair.get(node, (None, None))
            if parent not in self.held:
                self.held[node] = self.counted(self.rows[node], bins)
            else:
                few, many = sorted((node, other), key=lambda n: len(self.rows[n]))
                whole, part = self.held.pop(parent), self.counted(self.rows[few], bins)
                rest = whole - part
                rest[1] = np.maximum(rest[1], 0.0)
                rest[:, rest[2] == 0] = 0.0
                self.held[few], self.held[many] = part, rest
        return self.held[node]

    def counted(self, rows: np.ndarray, bins: int) -> np.ndarray:
        columns = len(self.cells)
        whole = len(rows) == len(self.g)
        g, h = (self.g, self.h) if whole else (self.g[rows], self.h[rows])
        if len(rows) <= _FEW_ROWS:
            cell = (self.cells[:, rows] + np.arange(0, columns * bins, bins)[:, None]).ravel()
            return np.stack([np.bincount(cell, v, columns * bins) for v in (np.tile(g, columns), np.tile(h, columns), None)]).reshape(3, columns, bins)
        out = np.empty((3, columns, bins))
        for j, column in enumerate(self.cells):
            cell = (column if whole else column[rows]).astype(np.intp)
            for k, v in enumerate((g, h, None)):
                out[k, j] = np.bincount(cell, v, bins)
        return out


def _grow_in_tasks(blocks: DataFrame, models: list[Growth]) -> None:
    """One job in which every model grows to its end in a task of its own, by the steps of ``_ask``: for a table
    of one partition (PART_ROWS rows at most), where a job for each level costs far more than the level."""
    rdd = blocks.drop("ids").withColumn("ids", F.lit(None)).coalesce(1).rdd
    dear = ("leaf", "symmetric", "level")  # by the time of a tree: the longest begin first
    order = sorted((g for g in models if not g.ended), key=lambda g: (dear.index(g.m.growth), g.fold != ALL))

    def grow(i: int, rows: Iterable) -> Iterator:
        g = order[i]  # a task that runs again begins anew
        held = LocalRows([Block(row) for row in rows], g.request())
        while not g.ended:
            s = g.request()
            g.receive(*_merged(_answer(held.sums(s), {g.index: s}), {g.index: s})[g.index])
        yield g.index, g.trees[:g.best]

    if order:
        by_index = {g.index: g for g in order}
        for index, trees in rdd.context.union([rdd] * len(order)).mapPartitionsWithIndex(grow).collect():
            by_index[index].trees, by_index[index].best, by_index[index].ended = trees, len(trees), True


def _advance(blocks: DataFrame, models: list[Growth]) -> DataFrame:
    """The blocks with the margins of all finished trees, written anew."""
    new = {g.index: g.trees[g.stored:] for g in models}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = {c: b.column(c)[i].as_py() for c in b.schema.names}
                block = Block(row)
                margin = block.margin.copy()
                for index, trees in new.items():
                    for tree in trees:
                        margin[:, index] += tree["value"][place(tree, block.bins)]
                yield pa.RecordBatch.from_arrays([pa.array([margin.tobytes()], pa.binary()) if c == "margin" else b.column(c).slice(i, 1)
                                                  for c in b.schema.names], names=b.schema.names)

    return cut_lineage(blocks.mapInArrow(run, blocks.schema))


def class_counts(df: DataFrame, id_col: str = "account_id") -> dict[tuple[int, bool, int], int]:
    """Rows by (fold, inner, y); a few rows."""
    key = F.xxhash64(F.lit(42), id_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("fold"), b.column("y"), pa.array(is_inner(b.column("key").to_numpy()))], names=["fold", "y", "inner"])

    rows = df.select(F.col("fold").cast("int").alias("fold"), (F.col("y") == 1).cast("int").alias("y"), key.alias("key"))
    counts = rows.mapInArrow(run, "fold int, y int, inner boolean").groupBy("fold", "inner", "y").count()
    return {(r["fold"], r["inner"], r["y"]): r["count"] for r in counts.collect()}


def fit(df: DataFrame, members: Sequence[Member] = MEMBERS, folds: Sequence[int] = (0, 1, 2, 3, 4, ALL), *, id_col: str = "account_id",
        features: str = "features") -> tuple[dict[tuple[str, int], list[dict]], DataFrame, list[np.ndarray]]:
    """Every member without each of ``folds`` (ALL: on all rows) from (id, y, fold, features):
    ({(member, fold): trees}, blocks, cut points). ``blocks`` holds the rows in bins for ``oof_scores``."""
    df = cut_lineage(df.select(id_col, "y", "fold", features))
    cuts, counts = cut_points(df, features), class_counts(df, id_col)
    jobs = [(m, f) for m in members for f in folds]
    blocks = row_blocks(df, cuts, len(jobs), id_col, features)
    models = []
    for i, (m, f) in enumerate(jobs):
        n = {(inner, y): sum(c for (fold, held, cls), c in counts.items() if fold != f and held == inner and cls == y) for inner in (True, False) for y in (0, 1)}
        whole = not (n[True, 0] and n[True, 1])  # no inner rows to judge by: all training rows
        neg, pos = (n[False, y] + (n[True, y] if whole else 0) for y in (0, 1))
        if not neg or not pos:
            weights, prior = (1.0, 1.0), math.log((pos + 0.5) / (neg + 0.5))
        else:
            weights = (1.0, neg / pos) if m.weighting == "ratio" else ((neg + pos) / (2 * neg), (neg + pos) / (2 * pos))
            prior = math.log(weights[1] * pos / (weights[0] * neg))
        models.append(GROWTHS[m.growth](i, m, f, len(cuts), weights, prior, whole))
        models[-1].ended = not neg or not pos or not len(cuts)
    spark = df.sparkSession
    if sum(counts.values()) <= PART_ROWS:
        _grow_in_tasks(blocks, models)
    rdd, token = blocks.drop("ids").withColumn("ids", F.lit(None)).rdd.persist(), uuid.uuid4().hex
    while active := [g for g in models if not g.ended]:
        if max(len(g.trees) - g.stored for g in active) >= REFRESH:
            blocks = _advance(blocks, models)
            for g in models:
                g.stored = len(g.trees)
            rdd.unpersist()
            rdd, token = blocks.drop("ids").withColumn("ids", F.lit(None)).rdd.persist(), uuid.uuid4().hex
        wide = max(1, min(len(active), spark.sparkContext.defaultParallelism // rdd.getNumPartitions()))
        requests = [g.request() for g in active]
        answers = _ask(rdd, [requests[i::wide] for i in range(wide)], token)
        for g in active:
            g.receive(*answers[g.index])
    rdd.unpersist()
    out = {}
    for g in models:
        kept = [{**t, "threshold": np.array([cuts[f][b] if f >= 0 and b < len(cuts[f]) else np.inf for f, b in zip(t["feature"].tolist(), t["bin"].tolist(), strict=True)])}
                for t in g.trees[:g.best]]
        out[g.m.name, g.fold] = [{"prior": g.prior}, *kept]
    return out, blocks, cuts


# ------------------------------------------------------------------ results


def margins(trees: list[dict], x: np.ndarray, cut: str = "threshold") -> np.ndarray:
    """Log-odds of the rows of ``x``."""
    x = np.where(np.isnan(x), -np.inf, x) if cut == "threshold" else x
    out = np.full(len(x), trees[0]["prior"])
    for t in trees[1:]:
        out += t["value"][place(t, x, cut)]
    return out


def oof_scores(models: dict[tuple[str, int], list[dict]], blocks: DataFrame) -> DataFrame:
    """(account_id, y, fold, member, prob): each row scored by the models that did not see its fold."""
    names = list(dict.fromkeys(n for n, f in models if f != ALL))
    schema = T.StructType([T.StructField("account_id", blocks.schema["ids"].dataType.elementType), *T.StructType.fromDDL("y int, fold int, member string, prob double")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                block = Block({c: b.column(c)[i].as_py() for c in b.schema.names})
                ids = b.column("ids").slice(i, 1).flatten()
                for name in names:
                    prob = np.zeros(len(block.y))
                    for f in np.unique(block.fold).tolist():
                        own = block.fold == f
                        prob[own] = _sigmoid(margins(models[name, f], block.bins[own], "bin"))
                    yield pa.RecordBatch.from_arrays([ids, pa.array(block.y.astype(np.int32)), pa.array(block.fold.astype(np.int32)),
                                                      pa.array([name] * len(prob)), pa.array(prob)], names=schema.names)

    cores = blocks.sparkSession.sparkContext.defaultParallelism
    spread = blocks.repartition(cores) if blocks.rdd.getNumPartitions() < cores else blocks  # few blocks are one file
    return spread.mapInArrow(run, schema)


NODES = "member string, fold int, tree int, node int, feature int, bin int, threshold double, left int, right int, value double, gain double, rows double, code int"


def node_table(spark, models: dict[tuple[str, int], list[dict]]) -> DataFrame:
    """Every node of every model; tree -1 holds a model's prior. ``code``: level of a symmetric tree's split,
    or its leaf's code. Bounded by models x trees x nodes; rows are made in tasks, a model in one row until then."""
    schema = T.StructType.fromDDL(NODES)

    def table(name: str, fold: int, trees: list[dict]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame([(name, fold, -1, 0, -1, 0, 0.0, -1, -1, float(trees[0]["prior"]), 0.0, 0.0, None)], columns=schema.names)
        for k, t in enumerate(trees[1:]):
            code = {}
            if "codes" in t:
                code = {int(n): i for i, n in enumerate(t["codes"])} | {int(n): i for i, n in enumerate(t["leaf_of"])}
            nodes = np.arange(len(t["feature"]))
            yield pd.DataFrame({"member": name, "fold": fold, "tree": k, "node": nodes, **{c: t[c] for c in ("feature", "bin", "threshold", "left", "right", "value", "gain")},
                                "rows": np.asarray(t["rows"], float), "code": pd.array([code.get(i) for i in nodes.tolist()], dtype="Int32")})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, fold, trees in pdf.itertuples(index=False):
                yield from table(name, fold, pickle.loads(trees))

    packed = [(name, fold, pickle.dumps(trees)) for (name, fold), trees in models.items()]
    return spark.createDataFrame(packed, "member string, fold int, trees binary").mapInPandas(run, schema)


def read_nodes(nodes: DataFrame) -> dict[tuple[str, int], list[dict]]:
    """The models of a node table (the inverse of ``node_table``)."""
    out: dict[tuple[str, int], list[dict]] = {}
    pdf = nodes.toPandas().sort_values(["member", "fold", "tree", "node"])
    for (name, fold, tree), g in pdf.groupby(["member", "fold", "tree"], sort=True):
        if tree < 0:
            out[name, int(fold)] = [{"prior": float(g["value"].iloc[0])}]
            continue
        t = {c: g[c].to_numpy() for c in ("feature", "bin", "threshold", "left", "right", "value", "gain", "rows")}
        if g["code"].notna().any():
            coded = g[g["code"].notna()]
            inner, leaf = coded[coded["feature"] >= 0], coded[coded["feature"] < 0]
            t["codes"] = inner.sort_values("code")["node"].to_numpy()
            t["leaf_of"] = leaf.sort_values("code")["node"].to_numpy()
        out[name, int(fold)].append(t)
    return out


def split_ledger(nodes: DataFrame, names: Sequence[str]) -> DataFrame:
    """(member, fold, tree, node, feature, gain, rows) of every split."""
    label = F.array(*[F.lit(n) for n in names])
    return nodes.where("feature >= 0").select("member", "fold", "tree", "node", F.get(label, F.col("feature")).alias("feature"), "gain", "rows")


def importances(ledger: DataFrame) -> DataFrame:
    """(member, feature, splits, total_gain, mean_gain): by gain for the level-wise member, by splits for the leaf-wise one."""
    return ledger.groupBy("member", "feature").agg(F.count(F.lit(1)).alias("splits"), F.sum("gain").alias("total_gain"), F.avg("gain").alias("mean_gain"))
