"""Exact duplicates: counting quotient filters of fingerprints, then verification of the bytes.

Every row gets a 64-bit fingerprint of its whole text. Each partition of the fingerprint table builds
counting quotient filters, one for each range of fingerprints; filters of a range merge without loss,
because each one lists its (quotient, remainder) entries in order. Fingerprints whose merged count is
one need nothing more. Texts of the others are grouped by their own bytes, and a group of rows counts
as equal only when those bytes confirm its size; rows that share a fingerprint alone stay apart.

Only such texts are shuffled, one for each task and distinct text. A bit map of fixed size
(``MAP_WORDS`` x 64 bits, the one table that is broadcast) tells a scan which texts may be repeated;
what it lets through in error is a group of one row. A hot group is counted in its tasks before any shuffle.

Defined results: a null text is empty and equal to other empty texts; a null id is smaller than any
other; of rows with equal text and equal id exactly one stays (the first in input order); an empty
table gives no rows; other columns are not read unless ``keep`` names them, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.text import ragged
from riskloom.session import cut_lineage

#: Fingerprints of one range, that is of one merge task.
SLICE_ITEMS = 1_000_000
#: 64-bit words of the broadcast bit map: 8 MB of bits, about 50 MB as a broadcast table at most.
MAP_WORDS = 1 << 20


class CountingQuotientFilter:
    """Multiset of fingerprints of ``width`` bits. The high ``q`` bits of one (its quotient) name its home
    slot, the other bits (its remainder) are stored; entries stand in order of fingerprint, pushed right
    where slots are taken. A count above one follows its remainder as digits in slots of their own. Bits:
    ``occupied`` (by quotient), ``run_end`` and ``digit`` (by slot). Entries come back exactly as put in."""

    def __init__(self, width: int, q: int, slots: np.ndarray, occupied: np.ndarray, run_end: np.ndarray, digit: np.ndarray):
        self.width, self.q, self.slots = width, q, slots
        self.occupied, self.run_end, self.digit = occupied, run_end, digit

    @classmethod
    def build(cls, prints: np.ndarray, counts: np.ndarray, width: int) -> CountingQuotientFilter:
        """From distinct ascending fingerprints (uint64) and their counts (1 or more)."""
        q = min(width - 1, max(1, int(len(prints) * 1.05).bit_length()))
        r = width - q
        home = (prints >> np.uint64(r)).astype(np.int64)
        low = prints & np.uint64((1 << r) - 1)
        extra = np.zeros(len(prints), np.int64)
        rest = (counts - 1).astype(np.uint64)
        while rest.any():
            extra += rest > 0
            rest = rest >> np.uint64(r) if r < 64 else rest * np.uint64(0)
        room = np.cumsum(extra + 1) - (extra + 1)
        at = np.maximum.accumulate(home - room) + room if len(home) else home
        size = max(1 << q, int(at[-1] + extra[-1] + 1) if len(at) else 0)
        slots = np.zeros(size, np.uint64)
        digit, run_end, occupied = np.zeros(size, bool), np.zeros(size, bool), np.zeros(1 << q, bool)
        slots[at] = low
        for d in range(int(extra.max()) if len(extra) else 0):
            has = extra > d
            slots[at[has] + 1 + d] = ((counts[has] - 1).astype(np.uint64) >> np.uint64(r * d)) & np.uint64((1 << r) - 1)
            digit[at[has] + 1 + d] = True
        occupied[home] = True
        last = np.append(home[1:] != home[:-1], True) if len(home) else np.zeros(0, bool)
        run_end[(at + extra)[last]] = True
        return cls(width, q, slots, occupied, run_end, digit)

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprints in order, counts)."""
        r = self.width - self.q
        home, end = np.flatnonzero(self.occupied), np.flatnonzero(self.run_end)
        begin = np.maximum(home, np.append(-1, end[:-1]) + 1) if len(end) else home
        slot = ragged(begin, end - begin + 1)
        owner = np.repeat(home, end - begin + 1).astype(np.uint64)
        digit = self.digit[slot]
        head = np.flatnonzero(~digit)
        prints = (owner[head] << np.uint64(r)) | self.slots[slot[head]]
        counts = np.ones(len(head), np.int64)
        extra = np.diff(np.append(head, len(slot))) - 1
        for d in range(int(extra.max()) if len(extra) else 0):
            has = extra > d
            counts[has] += (self.slots[slot[head[has] + 1 + d]] << np.uint64(r * d)).astype(np.int64)
        return prints, counts

    def to_bytes(self) -> bytes:
        wide = -(-(self.width - self.q) // 8)
        body = np.ascontiguousarray(self.slots.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide])
        head = np.array([self.width, self.q, len(self.slots)], "<u4").tobytes()
        return head + b"".join(np.packbits(b).tobytes() for b in (self.occupied, self.run_end, self.digit)) + body.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> CountingQuotientFilter:
        width, q, size = np.frombuffer(raw, "<u4", 3).tolist()
        at, bits = 12, []
        for n in (1 << q, size, size):
            bits.append(np.unpackbits(np.frombuffer(raw, np.uint8, -(-n // 8), at), count=n).astype(bool))
            at += -(-n // 8)
        wide = -(-(width - q) // 8)
        body = np.zeros((size, 8), np.uint8)
        body[:, :wide] = np.frombuffer(raw, np.uint8, size * wide, at).reshape(size, wide)
        return cls(width, q, body.view("<u8").ravel(), *bits)

    @classmethod
    def merge(cls, filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        """The multiset sum: equal (quotient, remainder) entries of the ordered lists add their counts."""
        parts = [f.entries() for f in filters]
        prints = np.concatenate([p for p, _ in parts])
        order = np.argsort(prints, kind="stable")  # merges the lists' ascending runs
        prints, counts = prints[order], np.concatenate([c for _, c in parts])[order]
        first = np.append(True, prints[1:] != prints[:-1]) if len(prints) else np.zeros(0, bool)
        total = np.add.reduceat(counts, np.flatnonzero(first)) if len(prints) else counts
        return cls.build(prints[first], total, filters[0].width)


def filters(prints: DataFrame, column: str, bits: int = 64, slices: int = 16) -> DataFrame:
    """(slice, filter): a merged filter of each of ``slices`` (a power of two) ranges of the fingerprints."""
    top = min(bits - 2, (slices - 1).bit_length())
    width = bits - top

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0

        def emit():
            all_prints = np.concatenate([p for p, _ in held])
            distinct, at = np.unique(all_prints, return_inverse=True)
            counts = np.bincount(at, weights=np.concatenate([c for _, c in held])).astype(np.int64)
            held[:] = [(distinct, counts)]
            return distinct, counts

        for b in batches:
            part = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            if bits < 64:
                part = part & np.uint64((1 << bits) - 1)
            held.append((part, np.ones(len(part), np.int64)))
            rows += len(part)
            if rows > SLICE_ITEMS:
                rows = 0
                emit()
        if not held:
            return
        distinct, counts = emit()
        owner = (distinct >> np.uint64(width)).astype(np.int64)
        cuts = np.append(np.flatnonzero(np.append(True, owner[1:] != owner[:-1])), len(owner))
        for at in range(0, len(cuts) - 1, 256):
            which = range(at, min(at + 256, len(cuts) - 1))
            blobs = [CountingQuotientFilter.build(distinct[cuts[i]:cuts[i + 1]] & np.uint64((1 << width) - 1),
                                                  counts[cuts[i]:cuts[i + 1]], width).to_bytes() for i in which]
            yield pa.RecordBatch.from_arrays([pa.array([int(owner[cuts[i]]) for i in which], pa.int64()), pa.array(blobs, pa.binary())],
                                             names=["slice", "filter"])

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        merged = CountingQuotientFilter.merge([CountingQuotientFilter.from_bytes(x) for x in group["filter"]])
        return pd.DataFrame({"slice": group["slice"].iloc[:1].to_numpy(), "filter": [merged.to_bytes()]})

    schema = "slice bigint, filter binary"
    return prints.select(column).mapInArrow(build, schema).groupBy("slice").applyInPandas(merge, schema)


def repeated(merged: DataFrame, bits: int = 64, least: int = 2) -> DataFrame:
    """(print, n) of the fingerprints that the filters of ``filters`` count at least ``least`` times."""

    def read(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in frames:
            for owner, raw in zip(b.column("slice").to_pylist(), b.column("filter").to_pylist(), strict=True):
                f = CountingQuotientFilter.from_bytes(raw)
                prints, counts = f.entries()
                many = counts >= least
                whole = prints[many] | (np.uint64(owner) << np.uint64(f.width))
                yield pa.RecordBatch.from_arrays([pa.array(whole.view(np.int64)), pa.array(counts[many])], names=["print", "n"])

    return merged.mapInArrow(read, "print bigint, n bigint")


def _bit(column: str) -> tuple[Column, Column]:
    """(word of the bit map, mask of the bit) of a fingerprint."""
    h = F.xxhash64(F.col(column))
    return h.bitwiseAND(MAP_WORDS - 1), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64(`{column}`), 58) as int))")


def _maybe(rows: DataFrame, bitmap: DataFrame, column: str) -> DataFrame:
    """Rows whose bit is set; the map has at most MAP_WORDS rows by construction."""
    word, mask = _bit(column)
    hit = (F.col("__word") == F.col("word")) & (F.col("__mask").bitwiseAND(F.col("bits")) != 0)
    return rows.withColumns({"__word": word, "__mask": mask}).join(F.broadcast(bitmap), hit, "left_semi").drop("__word", "__mask")


def equal_classes(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None,
                  normalise: Callable[[Column], Column] = lambda t: t, bits: int = 64, slice_items: int = SLICE_ITEMS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256[, row]) for every row: ``keep_id`` is the largest id of
    the equal texts, ``row`` a struct of the ``keep`` columns. ``bits`` shortens the fingerprints (tests)."""
    body = F.coalesce(normalise(F.col(f"`{text}`").cast("string")), F.lit(""))
    print_ = F.xxhash64(body) if bits == 64 else F.xxhash64(body).bitwiseAND((1 << bits) - 1)
    carried = [F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")] if keep else []
    rows = cut_lineage(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), print_.alias("print"), F.unhex(F.sha2(body, 256)).alias("sha"),
                                   F.monotonically_increasing_id().alias("rid"), *carried))
    slices = max(16, 1 << max(0, -(-rows.count() // slice_items) - 1).bit_length())
    many = repeated(filters(rows, "print", bits, slices), bits)
    word, mask = _bit("print")
    bitmap = cut_lineage(many.groupBy(word.alias("word")).agg(F.bit_or(mask).alias("bits")))

    bytes_ = _maybe(docs.select(print_.alias("print"), body.alias("body")), bitmap, "print")
    verified = bytes_.groupBy("print", "body").agg(F.count(F.lit(1)).alias("n_bytes"))
    verified = verified.where("n_bytes > 1").select("print", F.unhex(F.sha2("body", 256)).alias("sha"), "n_bytes")
    groups = _maybe(rows.select("doc_id", "print", "sha", "rid"), bitmap, "print").groupBy("print", "sha").agg(
        F.max(F.struct("doc_id", -F.col("rid"))).alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1")
    wrong = F.raise_error(F.lit("exact_dedup: two texts share fingerprint and digest"))
    groups = groups.join(verified, ["print", "sha"], "left").select(
        "print", "sha", F.col("top.doc_id").alias("keep"), (-F.col("top.col2")).alias("keep_rid"),
        F.when(F.col("n").eqNullSafe(F.col("n_bytes")), F.col("n")).otherwise(wrong.cast("bigint")).alias("n"))
    out = rows.join(cut_lineage(groups), ["print", "sha"], "left")
    alone = F.col("n").isNull()
    return out.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
                      F.coalesce("n", F.lit(1).cast("bigint")).alias("group_size"),
                      (alone | (F.col("rid") == F.col("keep_rid"))).alias("kept"),
                      F.lower(F.hex("sha")).alias("text_sha256"), *(["row"] if keep else []))


def dedup(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    out = equal_classes(docs, keep=docs.columns, **options)
    return out.where("kept").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
