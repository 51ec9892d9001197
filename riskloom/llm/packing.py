"""Best-fit packing of token sequences by hierarchical residual packing.

``pieces`` encodes whole texts and cuts what is longer than a sequence. ``pack`` then packs the
pieces: groups of a bounded number of items, dealt by size so that each has the whole table's mix,
pack best-fit decreasing; bins with at most ``slack`` free places, or without room for the smallest
bin that is left, are done; the others go on as single items to fewer groups, for another round, until one
group holds them all or a whole round joined nothing. Rows hold only lengths and checksums, never ids.

Defined results: a null text is empty and gives one piece that holds the end id alone; repeated
rows and null ids are packed like any other row; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm import text as tx
from riskloom.llm import tokens as tk
from riskloom.session import cut_lineage

#: Bytes of text that a task encodes at once: fewer distinct words to look up than in smaller slices.
SLICE_BYTES = 6 << 20
#: Items that one packing task holds.
ITEMS = 100_000
MEMBER = "struct<doc_id:bigint,piece:int,start:bigint,length:bigint,ids_crc32:bigint,offset:bigint>"


def pieces(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", capacity: int = 4096,
           end_id: int = 1, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of each text's ids followed by ``end_id``."""
    content = tk.read_tokenizer(tokenizer)
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tk.once(("library", zlib.crc32(content.encode())), lambda: tk.WordIds(tk.LibraryIds(content)))
        for part in tx.slices(batches, "text", SLICE_BYTES):
            words = tx.Words(tx.plain(part.column("text")))
            pool, offsets = encode(words.vocab)
            size = np.diff(offsets)[words.codes]
            per_doc = tx.segment_sums(size, words.starts)
            ids = pool[tx.ragged(offsets[words.codes], size)].astype("<u4")
            ids = np.insert(ids, np.cumsum(per_doc), np.uint32(end_id))
            total = per_doc + 1
            begin = np.cumsum(total) - total
            n = -(-total // capacity)
            row = np.repeat(np.arange(len(n)), n)
            piece = tx.ragged(np.zeros(len(n), np.int64), n)
            start = piece * capacity
            length = np.minimum(capacity, total[row] - start)
            raw, at = memoryview(ids.tobytes()), (begin[row] + start) * 4
            crc = [zlib.crc32(raw[a:a + b]) for a, b in zip(at.tolist(), (length * 4).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start),
                 pa.array(length), pa.array(crc, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-fit decreasing: (bin, offset) of each item. Open bins are stacked by free places, and
    the set bits of one integer tell which stacks hold a bin."""
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    free_bits, made = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        fits = free_bits >> need
        if fits:
            free = need + (fits & -fits).bit_length() - 1
            b = stacks[free].pop()
            if not stacks[free]:
                free_bits ^= 1 << free
        else:
            free, b, made = capacity, made, made + 1
        bins[i], offsets[i] = b, capacity - free
        free -= need
        if free:
            if not stacks[free]:
                free_bits |= 1 << free
            stacks[free].append(b)
    return bins, offsets


def _merge(items: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """One group's items (fill, members) packed: a row (fill, members) for each bin."""
    bins, offsets = best_fit(items["fill"].to_numpy(np.int64), capacity)
    order = np.lexsort((offsets, bins))
    cuts = np.flatnonzero(np.diff(bins[order])) + 1
    members, fill = items["members"].to_numpy(), items["fill"].to_numpy()
    out = []
    for group in np.split(order, cuts):
        held = []
        for i in group.tolist():
            base = int(offsets[i])
            held += [{**m, "offset": m["offset"] + base} for m in (x if isinstance(x, dict) else x.asDict() for x in members[i])]
        out.append((int(fill[group].sum()), held))
    return pd.DataFrame(out, columns=["fill", "members"])


def _deal(level: DataFrame, tasks: int) -> DataFrame:
    """Rows with ``deal`` in 0..tasks-1: neighbours in order of fill go to different groups, so every group
    has the whole table's mix of sizes and at most its share of rows, whatever ids or sizes repeat."""
    if tasks == 1:
        return level.withColumn("deal", F.lit(0).cast("bigint"))
    ranged = level.repartitionByRange(tasks, "fill", F.rand(7)).sortWithinPartitions("fill")
    return ranged.withColumn("deal", F.pmod(F.monotonically_increasing_id() + F.spark_partition_id(), F.lit(tasks)).cast("bigint"))


def pack(items: DataFrame, capacity: int = 4096, slack: int = 2, items_per_task: int = ITEMS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for the rows of ``pieces``."""
    schema = T.StructType.fromDDL(f"fill bigint, members array<{MEMBER}>")
    items = cut_lineage(items)
    member = F.struct("doc_id", "piece", "start", "length", "ids_crc32", F.lit(0).cast("bigint").alias("offset"))
    level = items.select(F.col("length").alias("fill"), F.array(member).alias("members"))
    full = F.col("fill") >= capacity - slack
    done = [level.where(full)]
    level = level.where(~full)
    count = level.count()
    while count:
        tasks = -(-count // items_per_task)
        dealt = cut_lineage(_deal(level, tasks)) if tasks > 1 else _deal(level, tasks)  # a random order is taken once
        packed = cut_lineage(dealt.groupBy("deal").applyInPandas(lambda g: _merge(g[["fill", "members"]], capacity), schema))
        bins, least = packed.agg(F.count(F.lit(1)), F.min("fill")).first()
        if tasks == 1 or bins == count:
            done.append(packed)
            break
        closed = full | (F.col("fill") > capacity - least)  # has no room for even the smallest
        done.append(packed.where(closed))
        level = packed.where(~closed)
        count = level.count()
    bins = done[0]
    for more in done[1:]:
        bins = bins.unionByName(more)
    numbered = bins.select(F.monotonically_increasing_id().alias("sequence_id"), "members")  # before the explode
    return numbered.select("sequence_id", F.explode("members").alias("m")).select("m.doc_id", "m.piece", "m.start", "m.length", "m.ids_crc32", "sequence_id", "m.offset")


def pack_documents(docs: DataFrame, capacity: int = 4096, **options) -> DataFrame:
    """The whole operator: encode, cut, pack."""
    return pack(pieces(docs, capacity=capacity, **options), capacity)
