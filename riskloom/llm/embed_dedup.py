"""Embedding near-dedup by spherical-cap filters from structured random product codes.

A filter direction is a pair of codewords, one for each half of a randomly rotated vector; a vector
lies in a filter's cap if the sum of its two inner products reaches the cap's height. List decoding doesn't visit all pairs of codewords: a first codeword is tried only
if it reaches the threshold together with the best second one. A vector's list holds all exceeding
filters, and its ``floor`` strongest ones where fewer exceed, so that no vector goes without. Vectors of
one label are joined on whole filters, and their cosines are computed there in double precision.

The code grows with the label: twice the codewords (four times the filters, and one more rotation)
whenever a filter would otherwise hold more than about ``CROWD`` vectors, so a vector meets a bounded
number of unrelated ones however many its label has. With 128 codewords and 4 rotations a vector has
about 33 filters; 0.035 of random pairs at cosine 0.93 share none in one rotation, 1.5e-6 in all four.

Equal vectors of a label are first grouped into one, with a count. Filters are counted on ids alone,
and vectors are only sent to filters that hold two or more. Crowded filters are cut into blocks of a
bounded number of vectors, and block pairs meet. A pair is counted in the first filter that both have,
by the lists that travel with the vectors; tasks return a count and one spanning-forest edge per
vector, never the pairs.

Defined results: a vector that is null, zero, or holds a null or non-finite component, a null label or
a null id link with nothing; vectors of different lengths don't link; rows that repeat an id count as
separate vectors; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm import graph
from riskloom.llm import text as tx
from riskloom.session import cut_lineage

THRESHOLD = 0.93
ROTATIONS, CODEWORDS, EXCEEDING, FLOOR, TOP = 4, 128, 2.6, 8, 0.7
#: Vectors of a filter on average beyond which the code grows, and the most often it does.
CROWD, MAX_LEVEL = 512, 5
#: Vectors of a block on average.
BLOCK = 2048
#: Filters of up to so many vectors are compared together, pair by pair.
SMALL = 64
#: Rows (a vector in one of its filters) of one task on average.
ROWS_PER_TASK = 50_000
_NONE = np.iinfo(np.int32).max


def cap_share(size: int) -> tuple[np.ndarray, np.ndarray]:
    """(heights, share of all directions within a cap of that height), heights falling from 1 to 0."""
    angle = np.linspace(0, np.pi, 20_001)
    mass = np.cumsum(np.sin((angle[1:] + angle[:-1]) / 2) ** (size - 2))
    return np.cos(angle[1:10_001]), mass[:10_000] / mass[-1]


class ProductCode:
    """Rotations and codebooks for vectors of one length, drawn from a fixed seed. Each level doubles the
    codewords, adds a rotation and raises the cap so that ``exceeding`` filters a vector stay the mean.
    No cap is higher than ``TOP``, which few near vectors would share: low-dimensional codes are small."""

    def __init__(self, size: int, level: int = 0, rotations: int = ROTATIONS, codewords: int = CODEWORDS, exceeding: float = EXCEEDING,
                 floor: int = FLOOR, seed: int = 7):
        rng = np.random.default_rng([seed, size, level])
        self.size = max(2, size)
        heights, share = cap_share(self.size)
        most = int(np.sqrt(2 * floor / max(1e-12, np.interp(-TOP, -heights, share))))
        self.codewords = m = min(codewords << level, max(4, most))
        self.threshold = min(float(np.interp(exceeding / m ** 2, share, heights)), TOP)
        half = self.size // 2
        self.parts = []
        for _ in range(rotations + level):
            turn, _ = np.linalg.qr(rng.normal(size=(self.size, self.size)))
            books = [rng.normal(size=(self.codewords, n)) for n in (half, self.size - half)]
            books = [np.unique(b / (np.linalg.norm(b, axis=1)[:, None] * np.sqrt(2)), axis=0) for b in books]  # halves of length 1 have 2
            self.parts.append((turn, half, *books))
        self.floor = floor

    def filters(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vector, filter) of every filter in the vectors' lists, ascending. A filter's number is
        (rotation * codewords + first) * codewords + second."""
        if unit.shape[1] < self.size:
            unit = np.pad(unit, ((0, 0), (0, self.size - unit.shape[1])))
        rows, found = [], []
        m = self.codewords
        for r, (turn, half, first, second) in enumerate(self.parts):
            x = unit @ turn
            s1, s2 = x[:, :half] @ first.T, x[:, half:] @ second.T
            # the k strongest pairs are pairs of the k strongest codewords
            k = min(self.floor, len(first) * len(second) // 2)
            t1, t2 = (-np.partition(-s, min(k, s.shape[1]) - 1, axis=1)[:, :k] for s in (s1, s2))
            sums = (t1[:, :, None] + t2[:, None, :]).reshape(len(x), -1)
            need = np.minimum(self.threshold, -np.partition(-sums, k - 1, axis=1)[:, k - 1])
            row, i = np.nonzero(s1 + s2.max(axis=1)[:, None] >= need[:, None])
            at, j = np.nonzero(s1[row, i][:, None] + s2[row] >= need[row][:, None])
            rows.append(row[at])
            found.append((r * m + i[at]) * m + j)
        row, cell = np.concatenate(rows), np.concatenate(found)
        order = np.lexsort((cell, row))
        return row[order], cell[order].astype(np.int32)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    x = x / np.abs(x).max(axis=1)[:, None]  # no overflow of squares
    return x / np.linalg.norm(x, axis=1)[:, None]


def assign(groups: DataFrame, seed: int = 7) -> DataFrame:
    """Adds ``filters``, each vector's ascending list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[tuple[int, int], ProductCode] = {}
        for whole in batches:
            kinds = np.stack([whole.column(c).to_numpy() for c in ("size", "level")], axis=1)
            for kind in np.unique(kinds, axis=0):
                size, level = kind.tolist()
                if (size, level) not in codes:
                    codes[size, level] = ProductCode(size, level, seed=seed)
                code = codes[size, level]
                rows = np.flatnonzero((kinds == kind).all(axis=1))
                step = max(64, (4096 * CODEWORDS) // code.codewords)
                for a in range(0, len(rows), step):
                    batch = whole.take(pa.array(rows[a:a + step]))
                    row, cell = code.filters(_matrix(batch.column("vec"), size))
                    ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=batch.num_rows))]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(cell))],
                                                     names=[*batch.schema.names, "filters"])

    kind = groups.schema["vec"].dataType.simpleString()
    return groups.mapInArrow(run, f"rid bigint, label string, size int, level int, n bigint, vec {kind}, filters array<int>")


def _padded(lists: pa.Array) -> np.ndarray:
    """The lists as rows of one matrix, filled up with a number that no filter has."""
    length = lists.value_lengths().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lists)), length)
    out = np.full((len(lists), max(1, int(length.max(initial=0)))), _NONE, np.int32)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)] = lists.flatten().to_numpy()
    return out


def met_before(x: np.ndarray, y: np.ndarray, cell: int) -> np.ndarray:
    """For all rows of two list matrices: do they share a filter below ``cell``?"""
    out = np.zeros((len(x), len(y)), bool)
    shared = np.intersect1d(x[x < cell], y[y < cell])

    def flags(lists: np.ndarray, some: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(some, lists), len(some) - 1)
        row, col = np.nonzero(some[at] == lists)
        m = np.zeros((len(lists), len(some)), np.float32)
        m[row, at[row, col]] = 1
        return m

    for a in range(0, len(shared), 1024):
        some = shared[a:a + 1024]
        out |= flags(x, some) @ flags(y, some).T > 0.5
    return out


def block_links(vec: np.ndarray, lists: np.ndarray, ids: np.ndarray, n: np.ndarray, side: np.ndarray, cell: int, same: bool, threshold: float):
    """(id, links, root) of the vectors of a block pair that have links here: links counts the rows of linked
    vectors whose first common filter this is; root is the smallest id of the forest they form."""
    links = np.zeros(len(ids), np.int64)
    x = np.arange(len(ids)) if same else np.flatnonzero(side == 0)
    y = x if same else np.flatnonzero(side == 1)
    label = np.arange(len(ids))
    for a in range(0, len(x), 512):
        rows = x[a:a + 512]
        near = vec[rows] @ vec[y].T >= threshold
        if same:
            near &= rows[:, None] < y[None, :]
        if not near.any():
            continue
        i, j = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        near = near[np.ix_(i, j)] & ~met_before(lists[rows[i]], lists[y[j]], cell)
        u, v = np.nonzero(near)
        i, j = rows[i[u]], y[j[v]]
        np.add.at(links, i, n[j])
        np.add.at(links, j, n[i])
        held = np.arange(len(ids))
        label = graph.forest(len(ids), np.concatenate([i, held]), np.concatenate([j, label]))
    hit = np.flatnonzero(links)
    return ids[hit], links[hit], ids[label[hit]]


def small_links(vec: np.ndarray, lists: np.ndarray, ids: np.ndarray, n: np.ndarray, begin: np.ndarray, size: np.ndarray, cell: np.ndarray, threshold: float):
    """As ``block_links``, for many small filters at once (rows begin[k]..begin[k] + size[k] - 1 are filter k):
    their pairs are compared in one go, by bounded pieces. A link's root is its smaller id."""
    out = []
    pairs = size * (size - 1) // 2
    piece = np.cumsum(pairs) // 65_536
    for p in np.unique(piece):
        k = np.flatnonzero(piece == p)
        later = np.repeat(size[k] - 1, size[k]) - tx.ragged(np.zeros(len(k), np.int64), size[k])  # rows behind each row in its filter
        first = tx.ragged(begin[k], size[k])
        i, j = np.repeat(first, later), tx.ragged(first + 1, later)
        near = np.einsum("ab,ab->a", vec[i], vec[j]) >= threshold
        i, j, f = i[near], j[near], np.repeat(cell[k], pairs[k])[near]
        for a in range(0, len(i), 2048):
            u, v, g = i[a:a + 2048], j[a:a + 2048], f[a:a + 2048]
            x = lists[u]
            own = ~((x[:, :, None] == lists[v][:, None, :]) & (x < g[:, None])[:, :, None]).any(axis=(1, 2))
            u, v = u[own], v[own]
            low = np.minimum(ids[u], ids[v])
            out.append((np.concatenate([ids[u], ids[v]]), np.concatenate([n[v], n[u]]), np.concatenate([low, low])))
    return out


def links(assigned: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """(rid, links, root) rows from every block pair of every filter of every label."""
    key = ["label", "size", "cell"]
    ids = assigned.select("rid", "label", "size", F.explode("filters").alias("cell"))
    crowd = ids.groupBy(*key).agg(F.count("rid").alias("m")).where("m > 1").select(*key, F.ceil(F.col("m") / block).cast("int").alias("blocks"))
    dealt = ids.join(crowd, key).withColumn("blk", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = cut_lineage(dealt.select("rid", "cell", F.least("blk", "other").alias("b1"), F.greatest("blk", "other").alias("b2"),
                                     F.when(F.col("blk") <= F.col("other"), 0).otherwise(1).alias("side")))
    tasks = max(1, -(-dealt.count() // ROWS_PER_TASK))
    rows = dealt.join(assigned.select("rid", "label", "size", "n", "vec", "filters"), "rid")
    key = [*key, "b1", "b2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        keys = [np.unique(table["label"].to_numpy(zero_copy_only=False).astype(str), return_inverse=True)[1], *[table[c].to_numpy() for c in key[1:]]]
        order = np.lexsort(keys[::-1])
        keys = [k[order] for k in keys]
        cut = np.any([k[1:] != k[:-1] for k in keys], axis=0)
        begin = np.concatenate([[0], np.flatnonzero(cut) + 1])
        size = np.diff(np.append(begin, len(order)))
        same = keys[3][begin] == keys[4][begin]
        ids, n, side = (table[c].to_numpy()[order] for c in ("rid", "n", "side"))
        out = []
        for length in np.unique(keys[1]).tolist():
            few = np.flatnonzero((keys[1][begin] == length) & same & (size > 1) & (size <= SMALL))
            for part in np.array_split(few, max(1, -(-int(size[few].sum()) // 16_384))):
                if len(part):
                    at = tx.ragged(begin[part], size[part])
                    rows = pa.array(order[at])
                    out += small_links(_matrix(table["vec"].take(rows).combine_chunks(), length), _padded(table["filters"].take(rows).combine_chunks()),
                                       ids[at], n[at], np.cumsum(size[part]) - size[part], size[part], keys[2][begin[part]], threshold)
        for g in np.flatnonzero((size > 1) & ~(same & (size <= SMALL))).tolist():
            a, b = int(begin[g]), int(begin[g] + size[g])
            rows = pa.array(order[a:b])
            out.append(block_links(_matrix(table["vec"].take(rows).combine_chunks(), int(keys[1][a])), _padded(table["filters"].take(rows).combine_chunks()),
                                   ids[a:b], n[a:b], side[a:b], int(keys[2][a]), bool(same[g]), threshold))
        if out:
            rid, count, root = (np.concatenate(x).astype(np.int64) for x in zip(*out, strict=True))
            if len(rid):  # one row a vector and root
                order = np.lexsort((root, rid))
                rid, count, root = rid[order], count[order], root[order]
                at = np.concatenate([[0], np.flatnonzero((rid[1:] != rid[:-1]) | (root[1:] != root[:-1])) + 1])
                yield pa.RecordBatch.from_arrays([pa.array(rid[at]), pa.array(np.add.reduceat(count, at)), pa.array(root[at])], names=["rid", "links", "root"])

    return rows.repartition(tasks, *key).mapInArrow(run, "rid bigint, links bigint, root bigint")


def label_key(vectors: DataFrame, label: str) -> Column:
    """Labels of any type as text: equal texts are equal labels."""
    own = F.col(f"`{label}`")
    if vectors.schema[label].dataType.typeName() in ("float", "double"):
        own = F.when(own == 0, F.lit(0.0)).otherwise(own)  # minus zero equals zero
    return own.cast("string")


def near_duplicates(vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
                    threshold: float = THRESHOLD, block: int = BLOCK, crowd: float = CROWD, seed: int = 7) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per input row."""
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).alias("vec"), label_key(vectors, label).alias("label"))
    finite = F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.coalesce(finite & F.exists("vec", lambda v: v != 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False))
    rows = rows.withColumn("usable", usable)
    groups = rows.where("usable").groupBy("label", "vec").agg(F.min("vec_id").alias("first"), F.count("vec_id").alias("n"))
    groups = cut_lineage(groups.select(F.monotonically_increasing_id().alias("rid"), "label", F.size("vec").alias("size"), "n", "vec", "first"))
    level = F.ceil(F.log2(F.count("rid") * FLOOR / crowd) / 2 - np.log2(CODEWORDS))
    levels = groups.groupBy("label", "size").agg(F.least(F.greatest(level, F.lit(0)), F.lit(MAX_LEVEL)).cast("int").alias("level"))
    assigned = cut_lineage(assign(groups.join(levels, ["label", "size"]).select("rid", "label", "size", "level", "n", "vec"), seed))
    found = cut_lineage(links(assigned, threshold, block))
    linked = graph.components(found.select("rid", "root"))
    named = groups.select("rid", "first").join(linked.withColumnRenamed("id", "rid"), "rid", "left").withColumn("component", F.coalesce("component", "rid"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    counted = found.groupBy("rid").agg(F.sum("links").alias("links"))
    of_group = named.join(least, "component").join(counted, "rid", "left").select("rid", "component_id", F.coalesce("links", F.lit(0)).alias("links"))
    of_vec = groups.select("rid", "label", "vec", "n").join(of_group, "rid").select("label", "vec", (F.col("links") + F.col("n") - 1).alias("n_links"), "component_id")
    good = rows.where("usable").join(of_vec, ["label", "vec"]).select("vec_id", "n_links", "component_id")
    rest = rows.where("not usable").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(rest).select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))
