"""Substring dedup: windows of words that also start in a document with a smaller id, by partitioned
suffix trees.

A window of 50 words is a suffix cut at depth 50. To leave out suffixes that occur in one document,
each window is first named by its anchor: the least hash of its 20-word sequences. Equal windows have
equal anchors, so only windows whose anchor occurs in two documents or more go on. Consecutive windows
with one anchor travel as one run of text, and the runs are dealt by their anchor to memory-sized
groups: the anchor is the common part of the suffixes there, as a prefix would be. A task builds the
truncated suffix tree of its group from the words themselves: nodes at depth 1, 2, 4, ... name the
sequences below them, and the nodes at depth 50 with several suffixes are the repeats. The smallest
document below such a node keeps its words; all other suffixes below it are removed.

Exact copies stay out of the trees: of equal texts only the one with the smallest id takes part, and the
others lose every window.

An anchor with more than ``group`` documents is split by a longer prefix, the whole window: its
windows are then named by 128-bit fingerprints, and each one's smallest document is found by a
partial minimum and a join, so that no group grows with the data.

Defined results: a null text has no words; rows that share a doc_id don't remove each other's words;
a row with a null doc_id loses nothing and removes nothing; repeated rows get equal results; texts
shorter than a window lose nothing; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import text as tx
from riskloom.session import cut_lineage

WINDOW, ANCHOR = 50, 20
#: Documents of one anchor, and runs of one task on average.
GROUP = 20_000
_BASE = 0x9E3779B97F4A7C15 | 1


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def sequence_hashes(h: np.ndarray, length: int) -> np.ndarray:
    """Hash of h[i], ..., h[i + length - 1] for every i, from hashes of power-of-two lengths."""
    out, done, block, size = None, 0, h, 1
    while True:
        if length & size:
            if out is None:
                out, done = block, size
            else:  # the block goes behind what is there
                n = max(0, len(h) - done - size + 1)
                out, done = out[:n] * _power(size) + block[done:done + n], done + size
        if size * 2 > length:
            return out
        n = max(0, len(block) - size)
        block, size = block[:n] * _power(size) + block[size:size + n], size * 2


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i:i + width] for every i."""
    size = 1
    while size * 2 <= width:
        x, size = np.minimum(x[:-size], x[size:]), size * 2
    return np.minimum(x[:len(x) - (width - size)], x[width - size:]) if width > size else x


def window_anchors(words: tx.Words, hashes: tx.WordHashes, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, text and anchor) of every window inside a text."""
    n = len(words.codes)
    if n < window:
        none = np.zeros(0, np.int64)
        return none, none, none
    h = hashes.of(words.vocab)[words.codes]
    least = sliding_min(tx.mix64(sequence_hashes(h, anchor)), window - anchor + 1)
    doc = words.doc
    at = np.flatnonzero(doc[:n - window + 1] == doc[window - 1:])
    return at, doc[at], least[at].view(np.int64)


def _source(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows are told apart by their id and their text: equal rows have equal results."""
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text)).alias("rk"), F.col(text).alias("text"))


def anchors(source: DataFrame, window: int, anchor: int) -> DataFrame:
    """(doc_id, rk, anchor): the distinct anchors of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = tx.WordHashes()
        for part in tx.slices(batches, "text"):
            _, doc, found = window_anchors(tx.Words(tx.plain(part.column("text"))), hashes, window, anchor)
            order = np.lexsort((found, doc))
            doc, found = doc[order], found[order]
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (found[1:] != found[:-1])
            rows = pa.array(doc[new])
            yield pa.RecordBatch.from_arrays([part.column("doc_id").take(rows), part.column("rk").take(rows), pa.array(found[new])],
                                             names=["doc_id", "rk", "anchor"])

    return source.where("doc_id is not null").mapInArrow(run, "doc_id bigint, rk bigint, anchor bigint")


def _listed(part: pa.RecordBatch, doc: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Which windows have an anchor of their row's list."""
    lists = part.column("anchors")
    names, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    row = np.repeat(np.arange(len(lists)), np.diff(np.concatenate([[0], ends])))
    known = np.unique(np.rec.fromarrays([row, names], names="r,a")) if len(row) else None
    if known is None or not len(doc):
        return np.zeros(len(doc), bool)
    keys = tx.mix64(tx.mix64(row.astype(np.uint64)) + names.view(np.uint64))
    return np.isin(tx.mix64(tx.mix64(doc.astype(np.uint64)) + found.view(np.uint64)), keys)


def _runs(at: np.ndarray, doc: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first index, length) of maximal runs of consecutive windows with one anchor in one text."""
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1]) | (found[1:] != found[:-1])
    begin = np.concatenate([[0], np.flatnonzero(cut) + 1])
    return begin, np.diff(np.append(begin, len(at)))


def runs(listed: DataFrame, window: int, anchor: int) -> DataFrame:
    """(anchor, doc_id, rk, start, words): the texts of the runs of windows with a listed anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = tx.WordHashes()
        for part in tx.slices(batches, "text"):
            texts = tx.plain(part.column("text"))
            words = tx.Words(texts)
            at, doc, found = window_anchors(words, hashes, window, anchor)
            keep = _listed(part, doc, found)
            at, doc, found = at[keep], doc[keep], found[keep]
            begin, length = _runs(at, doc, found)
            if not len(begin):
                continue
            raw = [b" ".join(t.encode().split()) for t in texts.to_pylist()]
            size = np.array([len(r) for r in raw]) + 1
            buffer = np.frombuffer(b" ".join(raw), dtype=np.uint8)
            # words of empty texts don't exist, so the k-th word starts behind the k-th gap between words
            base = np.cumsum(size) - size
            inner = np.flatnonzero(buffer == 32)
            inner = inner[~np.isin(inner, base[1:] - 1)]
            first = base[words.counts > 0]
            starts = np.sort(np.concatenate([first, inner + 1]))
            ends = np.append(starts[1:] - 1, len(buffer))
            last = words.starts[1:] - 1
            ends[last[words.counts > 0]] = (base + size - 1)[words.counts > 0]
            a, b = starts[at[begin]], ends[at[begin] + length - 1 + window - 1]
            whole = buffer.tobytes()
            rows = pa.array(doc[begin])
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[begin]), part.column("doc_id").take(rows), part.column("rk").take(rows),
                 pa.array(at[begin] - words.starts[doc[begin]]), pa.array([whole[x:y].decode() for x, y in zip(a.tolist(), b.tolist(), strict=True)], pa.string())],
                names=["anchor", "doc_id", "rk", "start", "words"])

    return listed.mapInArrow(run, "anchor bigint, doc_id bigint, rk bigint, start bigint, words string")


def tree_nodes(codes: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The truncated suffix tree of word sequences codes[starts[i]:starts[i + 1]]: (suffix, its node at
    ``depth``) for every suffix of at least ``depth`` words. Node names of depth 2m are pairs of names of
    depth m, numbered in sorted order, so equal names are equal words."""
    left = np.repeat(starts[1:], np.diff(starts)) - np.arange(len(codes))  # words from here to the end
    name, size = codes.astype(np.int64), 1
    while size < depth:
        step = min(size, depth - size)  # the last step overlaps: depth = size + step
        at = np.flatnonzero(left >= size + step)
        if not len(at):
            return at, at
        width = int(name.max()) + 1
        _, number = np.unique(name[at] * width + name[at + step], return_inverse=True)
        name = np.zeros(len(codes), np.int64)
        name[at] = number
        size += step
    at = np.flatnonzero(left >= depth)
    return at, name[at]


def repeats(found: DataFrame, groups: int, window: int) -> DataFrame:
    """(doc_id, rk, start, stop): windows start..stop-1 of a row whose words start in a smaller document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        texts = rows["words"].combine_chunks().dictionary_encode()  # copies share one run
        words = tx.Words(tx.plain(texts.dictionary))
        suffix, node = tree_nodes(words.codes, words.starts, window)
        of_text = words.doc[suffix]
        run_text = texts.indices.to_numpy()
        docs, start = rows["doc_id"].to_numpy(), rows["start"].to_numpy()
        low = np.full(len(words), np.iinfo(np.int64).max)
        np.minimum.at(low, run_text, docs)  # the smallest document of each run text
        least = np.full(int(node.max()) + 1 if len(node) else 0, np.iinfo(np.int64).max)
        np.minimum.at(least, node, low[of_text])
        size = np.bincount(of_text, minlength=len(words))
        begin = np.cumsum(size) - size
        n = size[run_text]
        row = np.repeat(np.arange(len(run_text)), n)
        at = tx.ragged(begin[run_text], n)
        hit = docs[row] > least[node[at]]
        row, window_at = row[hit], (start[row] + at - begin[run_text[row]])[hit]
        first, length = _runs(window_at, row, np.zeros(len(row), np.int64))
        out = row[first]
        yield pa.RecordBatch.from_arrays(
            [pa.array(docs[out]), pa.array(rows["rk"].to_numpy()[out]), pa.array(window_at[first]), pa.array(window_at[first] + length)],
            names=["doc_id", "rk", "start", "stop"])

    return found.repartition(groups, "anchor").mapInArrow(run, "doc_id bigint, rk bigint, start bigint, stop bigint")


def crowded(listed: DataFrame, window: int, anchor: int) -> DataFrame:
    """As ``repeats``, for anchors of many documents: windows by 128-bit fingerprints and a minimum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        hashes = tx.WordHashes()
        for part in tx.slices(batches, "text"):
            words = tx.Words(tx.plain(part.column("text")))
            at, doc, found = window_anchors(words, hashes, window, anchor)
            keep = _listed(part, doc, found)
            at, doc = at[keep], doc[keep]
            if not len(at):
                continue
            other = np.array([xxhash.xxh64_intdigest(w.encode(), 1) for w in words.vocab.to_pylist()], dtype=np.uint64)[words.codes]
            x = sequence_hashes(hashes.of(words.vocab)[words.codes], window)[at].view(np.int64)
            y = sequence_hashes(other, window)[at].view(np.int64)
            rows = pa.array(doc)
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), part.column("doc_id").take(rows), part.column("rk").take(rows),
                                              pa.array(at - words.starts[doc])], names=["x", "y", "doc_id", "rk", "start"])

    windows = listed.mapInArrow(run, "x bigint, y bigint, doc_id bigint, rk bigint, start bigint")
    least = windows.groupBy("x", "y").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    hit = windows.join(least.select("x", "y", "least"), ["x", "y"]).where("doc_id > least")
    return hit.select("doc_id", "rk", "start", (F.col("start") + 1).alias("stop"))


def copies(source: DataFrame) -> DataFrame:
    """(doc_id, rk) of the rows whose text, by 124 bits of two hashes, also belongs to a smaller id."""
    second = F.conv(F.substring(F.md5(F.col("text").cast("binary")), 1, 15), 16, 10).cast("bigint")
    named = cut_lineage(source.where("doc_id is not null and text is not null").select("doc_id", "rk", second.alias("rk2")))
    first = named.groupBy("rk", "rk2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    return named.join(first, ["rk", "rk2"]).where("doc_id > first").select("doc_id", "rk").distinct()


def repeated_spans(source: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, group: int = GROUP) -> DataFrame:
    """(doc_id, rk, start, stop) of every repeated window that is to go (stop may lie behind the text)."""
    again = cut_lineage(copies(source))
    own = cut_lineage(anchors(source, window, anchor))
    shared = own.groupBy("anchor").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y"), F.min("rk").alias("a"), F.max("rk").alias("b"),
                                       F.count("rk").alias("n")).where("x < y and a < b")
    lists = own.join(shared.select("anchor", (F.col("n") > group).alias("many")), "anchor").groupBy("doc_id", "rk").agg(
        F.collect_list(F.when(~F.col("many"), F.col("anchor"))).alias("few"),
        F.collect_list(F.when(F.col("many"), F.col("anchor"))).alias("many"))
    lists = cut_lineage(lists.join(again, ["doc_id", "rk"], "left_anti"))
    total, many = lists.agg(F.sum(F.size("few")), F.sum(F.size("many"))).first()
    rows = source.join(lists, ["doc_id", "rk"])
    groups = max(1, -(-(total or 0) // group))
    spans = repeats(runs(rows.select("doc_id", "rk", "text", F.col("few").alias("anchors")), window, anchor), groups, window)
    if many:
        spans = spans.unionByName(crowded(rows.where(F.size("many") > 0).select("doc_id", "rk", "text", F.col("many").alias("anchors")), window, anchor))
    whole = again.select("doc_id", "rk", F.lit(0).cast("bigint").alias("start"), F.lit(1 << 40).cast("bigint").alias("stop"))
    return spans.unionByName(whole)


def removed_words(words: tx.Words, spans: pa.ListArray, window: int) -> np.ndarray:
    """Which words of the texts lie in a window of their row's spans."""
    change = np.zeros(len(words.codes) + 1, dtype=np.int64)
    n = pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False)
    flat = spans.flatten()
    base, end = np.repeat(words.starts[:-1], n), np.repeat(words.starts[1:], n)
    start, stop = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("start", "stop"))
    stop = np.minimum(base + stop + window - 1, end)
    some = stop - base - start >= window  # a copy shorter than a window loses nothing
    np.add.at(change, (base + start)[some], 1)
    np.add.at(change, stop[some], -1)
    return np.cumsum(change[:-1]) > 0


def dedup(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None, window: int = WINDOW,
          anchor: int = ANCHOR, group: int = GROUP, digests: bool = False) -> DataFrame:
    """``keep`` columns (all by default) with ``text`` as its kept words joined by spaces, or, with
    ``digests``, with n_words, n_removed and kept_sha256 instead. A text that loses nothing stays as it is
    in the first form."""
    p = tx.unused(docs.columns)  # names of this function's own columns
    source = _source(docs, doc_id, text)
    spans = repeated_spans(source, window, anchor, group).groupBy("doc_id", "rk").agg(
        F.collect_list(F.struct("start", "stop")).alias(f"{p}spans"))
    if digests:
        rows = source.join(spans, ["doc_id", "rk"], "left")
        kept, text_col = ["doc_id"], "text"
    else:
        key = spans.select(F.col("doc_id").alias(f"{p}id"), F.col("rk").alias(f"{p}rk"), f"{p}spans")
        marked = docs.withColumn(f"{p}rk2", F.xxhash64(F.col(text)))
        same = (F.col(doc_id).cast("bigint") == F.col(f"{p}id")) & (F.col(f"{p}rk2") == F.col(f"{p}rk"))
        rows = marked.join(key, same, "left").drop(f"{p}id", f"{p}rk", f"{p}rk2")
        kept, text_col = [c for c in (docs.columns if keep is None else keep) if c != text], text

    def compute(part: pa.RecordBatch) -> dict:
        texts = tx.plain(part.column(text_col))
        words = tx.Words(texts)
        gone = removed_words(words, part.column(f"{p}spans"), window)
        n_gone = tx.segment_sums(gone.astype(np.int64), words.starts)
        out, n = [], 0
        originals = part.column(text_col).to_pylist()
        for t, lost, count in zip(originals, n_gone.tolist(), words.counts.tolist(), strict=True):
            if lost:
                own = t.encode().split()
                flags = gone[n:n + count].tolist()
                out.append(b" ".join([w for w, g in zip(own, flags, strict=True) if not g]))
            elif digests:
                out.append(b" ".join((t or "").encode().split()))
            else:
                out.append(t)
            n += count
        if digests:
            return {"n_words": pa.array(words.counts, pa.int64()), "n_removed": pa.array(n_gone, pa.int64()),
                    "kept_sha256": pa.array([hashlib.sha256(b).hexdigest() for b in out], pa.string())}
        return {text: pa.array([b.decode() if isinstance(b, bytes) else b for b in out], pa.string())}

    schema = "n_words bigint, n_removed bigint, kept_sha256 string" if digests else f"`{text}` string"
    out = tx.annotate(rows, text_col, schema, compute, [*kept, f"{p}spans"]).drop(f"{p}spans")
    return out if digests else out.select(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)])
