"""Ranked lexical search of all documents for each item, by bags of words.

A document is reduced to its bag: the counts of the items' terms in it, and the length class m. Bags
are hashed and documents whose bags are equal, byte for byte, form a class. A class is scored once for
all items, and its members follow by ascending id: as at most ``k`` documents of a class can be among
an item's ``k`` best, only its ``k`` smallest ids are kept (before the shuffle too, so a class of a third of
all rows stays small). Tasks keep their ``k`` best classes of each item; the last step ranks the members.

Terms are runs of ASCII letters, digits and characters beyond ASCII, with A-Z lower-cased. N counts the
documents with a term, L all terms, n a document's terms, df the documents that hold a term, tf its
count in one. Weight w = floor(1000 ln((2N + 2) / (2 df + 1))), m = 75 + (25 n N) div L, and the score adds
w * ((10^9 tf) div (1000 tf + 12 m)) over the item's terms, repeats included; integers throughout.

Items are taken in blocks of about ``BLOCK_BYTES`` of text, so that a block's vocabulary and postings fit
a task; all documents are read for each block.

Defined results: a null text has no terms; documents without any of the items' terms get no row, items
without any hit get none; equal scores rank by ascending id, null ids last; documents with equal ids are
ranked one by one; equal item rows count once, and rows of one item id with different texts are one item
with the terms of all; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from riskloom.llm import text as tx
from riskloom.session import cut_lineage

#: Item text of one block.
BLOCK_BYTES = 16 << 20
#: Cells of a score matrix (classes x items) that a task holds at once.
CELLS = 1 << 21
NOT_TERM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LAST_ID = np.iinfo(np.int64).max


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(codes of all texts' terms in turn, each text's start among them, distinct terms)."""
    words = tx.Words(texts)  # white space never belongs to a term
    split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.replace_substring_regex(pc.ascii_lower(words.vocab), NOT_TERM, " ")))
    flat = split.flatten().dictionary_encode()
    codes, begin, vocab = flat.indices.to_numpy(), split.offsets.to_numpy().astype(np.int64), flat.dictionary
    empty = pc.index(vocab, "").as_py()
    if empty >= 0:
        real = codes != empty
        begin = np.concatenate([[0], np.cumsum(real)])[begin]
        codes = codes[real]
    out, starts = tx.of_words(words, codes, begin)
    return out, starts, vocab


class Items:
    """A block of items: their terms, and for each term its postings (item, repeats)."""

    def __init__(self, rows: list[tuple[object, str]]):
        held: dict[object, Counter] = {}
        for item, text in sorted(rows, key=lambda r: (r[0] is None, r[0], r[1])):
            codes, _, vocab = terms(tx.plain(pa.array([text], pa.string())))
            held.setdefault(item, Counter()).update(dict(zip(vocab.to_pylist(), np.bincount(codes, minlength=len(vocab)).tolist(), strict=True)))
        self.ids = list(held)
        words = sorted({t for c in held.values() for t, q in c.items() if q})
        code = {t: i for i, t in enumerate(words)}
        flat = sorted((code[t], i, q) for i, c in enumerate(held.values()) for t, q in c.items() if q)
        self.vocab = pa.array(words, pa.large_string())
        self.term, self.item, self.repeats = (np.array([p[j] for p in flat], np.int64) for j in range(3))
        self.starts = np.searchsorted(self.term, np.arange(len(words) + 1))


def bags(docs: DataFrame, items: Items, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, bag): all terms counted in n; ``bag`` holds (term code, count) of the items' terms as
    little-endian unsigned 32-bit pairs by ascending code."""
    vocab = items.vocab

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text"):
            codes, starts, found = terms(tx.plain(part.column("text")))
            known = pc.fill_null(pc.index_in(found.cast(pa.large_string()), value_set=vocab), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            here = known[codes]
            doc = np.repeat(np.arange(part.num_rows), np.diff(starts))
            key, count = np.unique((doc * len(vocab) + here)[here >= 0], return_counts=True)
            pairs = np.stack([key % max(len(vocab), 1), count], axis=1).astype("<u4")
            size = np.bincount(key // max(len(vocab), 1), minlength=part.num_rows) * 8
            offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
            bag = pa.LargeBinaryArray.from_buffers(pa.large_binary(), part.num_rows, [None, pa.py_buffer(offsets), pa.py_buffer(pairs.tobytes())])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(starts)), bag.cast(pa.binary())], names=["doc_id", "n", "bag"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n bigint, bag binary")


def _pairs(bag: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code, count, row) of all bags of a batch."""
    bag = bag.cast(pa.large_binary())
    offsets = np.frombuffer(bag.buffers()[1], np.int64, len(bag) + 1, bag.offset * 8)
    raw = np.frombuffer(bag.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]].view("<u4").reshape(-1, 2).astype(np.int64)
    return raw[:, 0], raw[:, 1], np.repeat(np.arange(len(bag)), np.diff(offsets) // 8)


def document_counts(held: DataFrame, size: int) -> np.ndarray:
    """df of each of the ``size`` terms: summed in tasks, one row per term after the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for b in batches:
            df += np.bincount(_pairs(b.column("bag"))[0], minlength=size)
        code = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(df[code])], names=["code", "df"])

    out = np.zeros(size, np.int64)
    for r in held.select("bag").mapInArrow(run, "code bigint, df bigint").groupBy("code").agg(F.sum("df").alias("df")).collect():
        out[r["code"]] = r["df"]
    return out


def term_weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)


def classes(held: DataFrame, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(bag, m, members): distinct (bag, m) and their ``k`` smallest ids."""
    m = F.expr(f"75 + ((25 * cast(n as decimal(38,0)) * {n_docs}L) div {n_terms}L)").cast("bigint")
    rows = held.where(F.length("bag") > 0).select("doc_id", m.alias("m"), "bag").withColumn("h", F.xxhash64("bag", "m"))
    first = Window.partitionBy("h", "bag", "m").orderBy(F.asc_nulls_last("doc_id"))
    rows = rows.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k)
    members = F.transform(F.array_sort(F.collect_list(F.struct("r", "doc_id"))), lambda x: x["doc_id"])
    return rows.groupBy("h", "bag", "m").agg(members.alias("members")).select("bag", "m", "members")


def best_classes(found: DataFrame, items: Items, weights: np.ndarray, k: int, id_type: T.DataType) -> DataFrame:
    """(item_id, score, members): each task's ``k`` best classes of each item, by score, then least id."""
    n_items = len(items.ids)
    heaviest = np.bincount(items.item, weights=items.repeats * weights[items.term] * 1e6, minlength=n_items).max(initial=0)
    exact = heaviest < 2 ** 53  # then sums in doubles are the integers themselves
    schema = T.StructType([T.StructField("item_id", id_type), T.StructField("score", T.LongType()), T.StructField("members", T.ArrayType(T.LongType()))])
    ids = pa.array(items.ids, to_arrow_type(id_type))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top_item, top_score, top_first = (np.zeros(0, np.int64) for _ in range(3))
        top_members: list = []
        floor = np.ones(n_items, np.int64)  # the least score that can still enter
        step = max(1, CELLS // max(n_items, 1))
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                b = whole.slice(at, step)
                code, tf, row = _pairs(b.column("bag"))
                m = b.column("m").to_numpy(zero_copy_only=False)
                part = weights[code] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[row]))
                cells = b.num_rows * n_items
                scores = np.zeros(cells, np.int64)
                reach = np.diff(items.starts)[code]
                cuts = np.searchsorted(np.cumsum(reach), np.arange(0, reach.sum() + CELLS, CELLS))
                for a, z in zip(cuts, [*cuts[1:], len(code)], strict=True):
                    if a == z:
                        continue
                    hit = tx.ragged(items.starts[code[a:z]], reach[a:z])
                    cell = np.repeat(row[a:z] * n_items, reach[a:z]) + items.item[hit]
                    add = np.repeat(part[a:z], reach[a:z]) * items.repeats[hit]
                    if exact:
                        scores += np.bincount(cell, weights=add, minlength=cells).astype(np.int64)
                    else:
                        np.add.at(scores, cell, add)
                grid = scores.reshape(b.num_rows, n_items)
                r, i = np.nonzero(grid >= floor)
                if not len(r):
                    continue
                members = b.column("members")
                least = pc.fill_null(pc.list_element(members, 0), LAST_ID).to_numpy(zero_copy_only=False)
                base = len(top_members)
                used, back = np.unique(r, return_inverse=True)
                top_members += members.take(pa.array(used)).to_pylist()
                item = np.concatenate([top_item[:, None], np.stack([i], 1)])[:, 0]
                score = np.concatenate([top_score, grid[r, i]])
                first = np.concatenate([top_first, least[r]])
                owner = np.concatenate([top_owner, base + back]) if len(top_item) else base + back
                order = np.lexsort((first, -score, item))
                item, score, first, owner = item[order], score[order], first[order], owner[order]
                begin = np.searchsorted(item, np.arange(n_items + 1))
                place = np.arange(len(item)) - begin[item]
                stay = place < k
                kth = place == k - 1
                floor[item[kth]] = np.maximum(score[kth], 1)
                top_item, top_score, top_first, owner = item[stay], score[stay], first[stay], owner[stay]
                held, top_owner = np.unique(owner, return_inverse=True)
                top_members = [top_members[x] for x in held.tolist()]
        if len(top_item):
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(top_item)), pa.array(top_score),
                                              pa.array([top_members[x] for x in top_owner.tolist()], pa.list_(pa.int64()))], names=["item_id", "score", "members"])

    return found.mapInArrow(run, schema)


def rank(docs: DataFrame, items: DataFrame, *, k: int = 20, item_id: str = "item_id", item_text: str = "text",
         doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item with a score above 0."""
    queries = items.select(F.col(f"`{item_id}`").alias("item_id"), F.coalesce(F.col(f"`{item_text}`").cast("string"), F.lit("")).alias("text")).distinct()
    id_type = queries.schema["item_id"].dataType
    queries = cut_lineage(queries)
    total = queries.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    parts = []
    for b in range(blocks):
        block = Items([tuple(r) for r in queries.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()])
        if len(block.vocab):
            parts.append(_rank_block(docs, block, k, id_type, doc_id, text))
    if not parts:
        spark = docs.sparkSession
        return spark.createDataFrame([], T.StructType([T.StructField("item_id", id_type), *T.StructType.fromDDL("rank int, doc_id bigint, score bigint")]))
    return reduce(DataFrame.unionByName, parts)


def _rank_block(docs: DataFrame, items: Items, k: int, id_type: T.DataType, doc_id: str, text: str) -> DataFrame:
    held = cut_lineage(bags(docs, items, doc_id=doc_id, text=text))
    n_docs, n_terms = held.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = term_weights(document_counts(held, len(items.vocab)), n_docs)
    found = classes(held, n_docs, max(n_terms, 1), k)
    best = best_classes(found, items, weights, k, id_type)
    each = best.select("item_id", "score", F.explode("members").alias("doc_id"))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
