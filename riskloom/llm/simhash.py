"""SimHash near-dedup: fingerprints of word shingles, linked by tiled exact comparison.

Distinct fingerprints are dealt to cells by the population counts of their two halves (1,089
cells at most). Two fingerprints within the radius lie in cells whose counts differ by no more
than it, so only those cells' blocks meet; blocks hold a bounded number of fingerprints, however
many a cell has. A task compares two blocks in tiles of numpy exclusive-ors and bit counts, and
skips tile pairs whose byte population counts differ beyond the radius. It emits a spanning forest
of the links it finds, not the links, so a large group of near copies stays linear.

Defined results: ASCII letters are lower-cased; a text of fewer words than a shingle is one shingle;
a text without words (null, empty) has fingerprint zero and is linked like any other; rows that
share a doc_id are one document for the links; a null doc_id is linked with nothing and has a null
component; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import graph
from riskloom.llm import text as tx
from riskloom.session import cut_lineage

#: Fingerprints of one block at most on average, and of one tile.
BLOCK, TILE = 65_536, 512
_LANES = np.uint64(0x0101010101010101)


def bit_sums(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(segments, 64): how many of hashes[starts[i]:starts[i + 1]] have each bit, lowest bit first.
    Eight bits at a time are summed in byte lanes over at most 255 rows."""
    out = np.zeros((len(starts) - 1, 64), dtype=np.int64)
    counts = np.diff(starts)
    chunks = -(-counts // 255)
    segment = np.repeat(np.arange(len(counts)), chunks)
    if not len(segment):
        return out
    begin = starts[:-1][segment] + 255 * tx.ragged(np.zeros(len(counts), np.int64), chunks)
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & _LANES, begin)
        wide = lanes[:, None] >> (np.arange(8, dtype=np.uint64) * np.uint64(8))[None, :] & np.uint64(255)
        np.add.at(out, (segment[:, None], np.arange(8)[None, :] * 8 + k), wide.astype(np.int64))
    return out


def text_fingerprints(texts: list[bytes], shingle: int, seed: int) -> np.ndarray:
    """Unsigned 64-bit fingerprints; a bit is set if it is set in over half of the shingles' XXH64."""
    digest = xxhash.xxh64_intdigest
    hashes: list[int] = []
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    for i, raw in enumerate(texts):
        joined = b" ".join(raw.lower().split())  # bytes: ASCII letters and ASCII white space only
        if joined:
            gaps = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 32)
            n = max(1, len(gaps) + 2 - shingle)
            begin = [0, *(gaps[:n - 1] + 1).tolist()]
            end = [*gaps[shingle - 1:].tolist(), len(joined)]
            hashes += [digest(joined[a:b], seed) for a, b in zip(begin, end, strict=True)]
        starts[i + 1] = len(hashes)
    sums = bit_sums(np.array(hashes, dtype=np.uint64), starts)
    bits = 2 * sums > np.diff(starts)[:, None]
    return (bits.astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long of the same bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text"):
            raw = pc.fill_null(part.column("text").cast(pa.large_binary()), b"").to_pylist()
            fps = text_fingerprints(raw, shingle, seed)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id bigint, fp bigint")


class Tiles:
    """A block's fingerprints, sorted by byte population counts and cut into tiles with bounds."""

    def __init__(self, fps: np.ndarray, tile: int):
        by_byte = np.bitwise_count(fps.view(np.uint8).reshape(-1, 8)).astype(np.int16)
        self.order = np.lexsort(by_byte.T[::-1])
        self.fps, by_byte = fps[self.order], by_byte[self.order]
        self.at = np.arange(0, len(fps), tile)
        self.low = np.minimum.reduceat(by_byte, self.at, axis=0)
        self.high = np.maximum.reduceat(by_byte, self.at, axis=0)
        self.ends = np.append(self.at[1:], len(fps))


def near_pairs(a: np.ndarray, b: np.ndarray, radius: int, tile: int = TILE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index arrays (i, j) of a[i], b[j] (unsigned) that differ in at most ``radius`` bits, by tile pair."""
    x, y = Tiles(a, tile), Tiles(b, tile)
    for s in range(len(x.at)):
        apart = np.maximum(0, np.maximum(x.low[s] - y.high, y.low - x.high[s])).sum(axis=1)
        left = x.fps[x.at[s]:x.ends[s], None]
        for t in np.flatnonzero(apart <= radius).tolist():
            i, j = np.nonzero(np.bitwise_count(left ^ y.fps[None, y.at[t]:y.ends[t]]) <= radius)
            if len(i):
                yield x.order[x.at[s] + i], y.order[y.at[t] + j]


def _block_links(fa: np.ndarray, ia: np.ndarray, fb: np.ndarray, ib: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest, as ids, of the links between two blocks (or inside one: b is empty)."""
    same = not len(fb)
    ids = ia if same else np.concatenate([ia, ib])
    shift = 0 if same else len(ia)
    label = np.arange(len(ids))
    pending: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0

    def fold() -> None:
        nonlocal label, pending, held
        u = np.concatenate([p[0] for p in pending] + [np.arange(len(ids))])
        v = np.concatenate([p[1] for p in pending] + [label])
        label = graph.forest(len(ids), u, v)
        pending, held = [], 0

    for i, j in near_pairs(fa, fa if same else fb, radius):
        pending.append((i, j + shift))
        held += len(i)
        if held > 1_000_000:
            fold()
    fold()
    linked = np.flatnonzero(label != np.arange(len(ids)))
    return ids[linked], ids[label[linked]]


def links(distinct: DataFrame, radius: int, block: int = BLOCK) -> DataFrame:
    """distinct: (fp, id), each fp once. (a, b): ids whose fingerprints differ in at most ``radius`` bits,
    enough of them to connect all that are linked."""
    halves = distinct.select("fp", "id", F.bit_count(F.shiftrightunsigned("fp", 32)).cast("int").alias("hi"),
                             F.bit_count(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).cast("int").alias("lo"))
    # at most 33 x 33 rows: how many blocks each cell has
    cells = halves.groupBy("hi", "lo").agg(F.ceil(F.count("fp") / block).cast("int").alias("blocks"))
    cells = cut_lineage(cells)
    rows = halves.join(F.broadcast(cells), ["hi", "lo"])
    blocks = rows.groupBy("hi", "lo", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int").alias("blk")).agg(
        F.collect_list("fp").alias("fps"), F.collect_list("id").alias("ids"))
    blocks = cut_lineage(blocks)
    # a block meets itself, the later blocks of its cell, and the blocks of the later cells near it
    steps = [(x, y) for x in range(radius + 1) for y in range(-radius, radius + 1)
             if abs(x) + abs(y) <= radius and (x, y) >= (0, 0)]
    near = F.explode(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in steps]))
    to = blocks.select("*", near.alias("d")).select(
        "hi", "lo", "blk", (F.col("hi") + F.col("d.x")).alias("h2"), (F.col("lo") + F.col("d.y")).alias("l2"))
    other = F.broadcast(cells.select(F.col("hi").alias("h2"), F.col("lo").alias("l2"), F.col("blocks").alias("n2")))
    to = to.join(other, ["h2", "l2"]).select("hi", "lo", "blk", "h2", "l2", F.explode(F.sequence(F.lit(0), F.col("n2") - 1)).alias("b2"))
    to = to.where("h2 != hi or l2 != lo or b2 >= blk")
    tasks = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = blocks.join(to, ["hi", "lo", "blk"])
    right = blocks.select(F.col("hi").alias("h2"), F.col("lo").alias("l2"), F.col("blk").alias("b2"), F.col("fps").alias("fps2"), F.col("ids").alias("ids2"))
    pairs = left.join(right, ["h2", "l2", "b2"]).select(
        (F.expr("h2 = hi and l2 = lo and b2 = blk")).alias("same"), "fps", "ids", "fps2", "ids2")
    pairs = pairs.repartition(max(tasks, 1), F.xxhash64(F.col("fps")[0], F.col("fps2")[0]))

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        for batch in frames:
            cols = [batch.column(k) for k in range(5)]
            for r in range(batch.num_rows):
                fa, ia, fb, ib = (c[r].values.to_numpy(zero_copy_only=False) for c in cols[1:])
                if cols[0][r].as_py():
                    fb, ib = none, none
                u, v = _block_links(fa.view(np.uint64), ia, fb.view(np.uint64), ib, radius)
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["a", "b"])

    return pairs.mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, seed: int = 42,
                    radius: int = 4, block: int = BLOCK) -> DataFrame:
    """(doc_id, fingerprint: 16 hex digits, component_id: smallest doc_id reachable by links)."""
    made = cut_lineage(fingerprints(docs, doc_id=doc_id, text=text, shingle=shingle, seed=seed))
    distinct = cut_lineage(made.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("id")))
    found = links(distinct, radius, block)
    # rows of one doc_id with different texts are one document
    shared = made.where("doc_id is not null").groupBy("doc_id").agg(F.min("fp").alias("x"), F.max("fp").alias("y")).where("x != y").select("doc_id")
    own = made.join(shared, "doc_id").join(distinct, "fp").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    joined = graph.components(found.union(own))
    groups = distinct.join(joined, "id", "left").select("fp", F.coalesce("component", "id").alias("component"))
    out = made.join(groups, "fp", "left")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"))


def keep_first(docs: DataFrame, *, doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the document with the smallest id, once: of rows
    with that id the one with the smallest text (null first, by bytes). A row without an id stays."""
    p = tx.unused(docs.columns)
    first = near_duplicates(docs, doc_id=doc_id, **options).where("doc_id = component_id").select(F.col("doc_id").alias(f"{p}id")).distinct()
    kept = docs.join(first, F.col(f"`{doc_id}`") == F.col(f"{p}id"), "left_semi")
    every = [F.col(f"`{c}`") for c in docs.columns]
    plain = [F.col(f"`{f.name}`") for f in docs.schema if f.dataType.typeName() != "map"]
    text = F.col(f"`{options.get('text', 'text')}`").cast("string")
    one = kept.groupBy(F.col(f"`{doc_id}`")).agg(F.min_by(F.struct(*every), F.struct(text, F.xxhash64(*plain))).alias(f"{p}row"))
    return one.select(*[F.col(f"{p}row").getField(c).alias(c) for c in docs.columns]).unionByName(docs.where(F.col(f"`{doc_id}`").isNull()))


