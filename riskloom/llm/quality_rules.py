"""Quality rules: plain text statistics, and a log-likelihood ratio of hashed n-grams.

Words are split into runs of letters or digits and runs of other characters. Their unigrams and
bigrams are hashed into ``buckets``; two multinomials with additive smoothing are fitted, one over
every document (the raw corpus), one over a trusted target (documents labelled good, at most
``max_trusted`` of them in hash order of their id; the corpus counts cover all rows). A document's
score is the mean log ratio of its n-grams, target over raw; it is kept if the score reaches a fixed
threshold and no base rule fails. The threshold is the same for every document: nothing is drawn.

Defined results: a null text has no words and fails the base rules; without any trusted document the
ratio is zero everywhere, so that only the base rules decide; repeated rows count each time; computed
columns replace kept columns of the same name; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import text as tx

BUCKETS = 1 << 14
#: Labelled documents that the target is fitted on at most.
MAX_TRUSTED = 20_000
#: Least mean log ratio (in nats) of a kept document.
THRESHOLD = -0.25
PART = r"([\pL\pN]+|[^\pL\pN]+)"
SYMBOLS = b"#*$%&|<>"
_IS_SYMBOL = np.zeros(256, dtype=np.int64)
_IS_SYMBOL[list(SYMBOLS)] = 1


def gram_buckets(words: tx.Words, hashes: tx.WordHashes, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each n-gram of all texts in turn, each text's start): unigrams, then bigrams."""
    codes, offsets, vocab = tx.parts(words.vocab, PART)
    part, starts = tx.of_words(words, codes, offsets)
    h = hashes.of(vocab)[part]
    two = tx.mix64(h[:-1] * np.uint64(3) + h[1:]) if len(h) else h
    n = np.diff(starts)
    pairs = np.maximum(n - 1, 0)
    both = np.concatenate([tx.mix64(h), two]) & np.uint64(buckets - 1)
    at = np.column_stack([starts[:-1], starts[:-1] + len(h)]).ravel()
    size = np.column_stack([n, pairs]).ravel()
    return both[tx.ragged(at, size)].astype(np.int64), np.concatenate([[0], np.cumsum(n + pairs)])


def trusted_ids(labels: DataFrame, *, doc_id: str = "doc_id", quality: str = "quality", max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """At most ``max_trusted`` ids of documents labelled good."""
    good = labels.where((F.col(quality) == 1) & F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("bigint").alias("doc_id")).distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_trusted)


def fit(docs: DataFrame, trusted: DataFrame, *, doc_id: str = "doc_id", text: str = "text", buckets: int = BUCKETS, smoothing: float = 1.0) -> np.ndarray:
    """The log ratio of each bucket. ``trusted`` holds a bounded number of ids, so it is broadcast."""
    flagged = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).join(
        F.broadcast(trusted.select("doc_id", F.lit(True).alias("good"))), "doc_id", "left")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = tx.WordHashes()
        raw, good = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for part in tx.slices(batches, "text"):
            grams, starts = gram_buckets(tx.Words(tx.plain(part.column("text"))), hashes, buckets)
            raw += np.bincount(grams, minlength=buckets)
            is_good = pc.fill_null(part.column("good"), False).to_numpy(zero_copy_only=False)
            good += np.bincount(grams[np.repeat(is_good, np.diff(starts))], minlength=buckets)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(raw[seen]), pa.array(good[seen])], names=["bucket", "raw", "good"])

    sums = flagged.select("text", "good").mapInArrow(count, "bucket bigint, raw bigint, good bigint")
    rows = sums.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).toPandas()  # one row per bucket
    raw, good = np.full(buckets, smoothing), np.full(buckets, smoothing)
    raw[rows["bucket"].to_numpy(np.int64)] += rows["raw"].to_numpy(float)
    good[rows["bucket"].to_numpy(np.int64)] += rows["good"].to_numpy(float)
    if good.sum() == smoothing * buckets:
        return np.zeros(buckets)
    return np.log(good / good.sum()) - np.log(raw / raw.sum())


def repeated_words(words: tx.Words, window: int = 5) -> np.ndarray:
    """Per text: words that lie in a window of ``window`` words found twice or more in it."""
    n, doc, codes = len(words.codes), words.doc, words.codes.astype(np.uint64)
    covered = np.zeros(n + 1, dtype=np.int64)
    if n >= window:
        m = n - window + 1
        key = tx.mix64(doc[:m].astype(np.uint64))
        for k in range(window):
            key = tx.mix64(key + codes[k:k + m] * np.uint64(0x9E3779B97F4A7C15))
        at = np.flatnonzero(doc[:m] == doc[window - 1:])
        at = at[np.argsort(key[at], kind="stable")]
        same = key[at[1:]] == key[at[:-1]]
        x, y = at[1:][same], at[:-1][same]
        for k in range(window):  # the windows themselves decide, not their hashes
            if not np.array_equal(codes[x + k], codes[y + k]):
                return _repeated_exactly(words, window)
        again = np.unique(np.concatenate([x, y]))
        np.add.at(covered, again, 1)
        np.add.at(covered, again + window, -1)
    return tx.segment_sums((np.cumsum(covered[:-1]) > 0).astype(np.int64), words.starts)


def _repeated_exactly(words: tx.Words, window: int) -> np.ndarray:
    out = np.zeros(len(words), dtype=np.int64)
    for i in range(len(words)):
        own = words.codes[words.starts[i]:words.starts[i + 1]]
        if len(own) >= window:
            view = np.lib.stride_tricks.sliding_window_view(own, window)
            _, inverse, counts = np.unique(view, axis=0, return_inverse=True, return_counts=True)
            hit = np.zeros(len(own), dtype=bool)
            for at in np.flatnonzero(counts[inverse.ravel()] > 1):
                hit[at:at + window] = True
            out[i] = hit.sum()
    return out


def repeated_lines(texts: list[str]) -> np.ndarray:
    """Per text: lines with a word that equal an earlier line."""
    out = np.zeros(len(texts), dtype=np.int64)
    for i, t in enumerate(texts):
        if "\n" in t:
            lines = [x for x in t.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
            out[i] = len(lines) - len(set(lines))
    return out


def statistics(texts: pa.Array, words: tx.Words) -> dict[str, np.ndarray]:
    """The base statistics of whole texts (large strings without nulls)."""
    raw = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    counts = words.counts
    repeats = repeated_words(words)
    chars = pc.utf8_length(words.vocab).to_numpy(zero_copy_only=False).astype(np.int64)[words.codes]
    return {
        "n_words": counts, "word_chars": tx.segment_sums(chars, words.starts),
        "n_symbols": tx.segment_sums(_IS_SYMBOL[raw[ends[0]:ends[-1]]], ends - ends[0]),
        "n_dup_lines": repeated_lines(texts.to_pylist()), "n_repeat_words": repeats,
        "base_failed": (counts < 10) | (100 * repeats > 20 * counts),
    }


def assess(docs: DataFrame, ratio: np.ndarray, *, text: str = "text", keep: list[str] | None = None, threshold: float = THRESHOLD, prefix: str = "") -> DataFrame:
    """``keep`` columns with the statistics, base_failed, llr and kept (names after ``prefix``) of every document."""
    buckets = len(ratio)

    def compute(part: pa.RecordBatch) -> dict:
        texts = tx.plain(part.column(text))
        words = tx.Words(texts)
        out = statistics(texts, words)
        grams, starts = gram_buckets(words, tx.WordHashes(), buckets)
        out["llr"] = tx.segment_sums(ratio[grams], starts) / np.maximum(1, np.diff(starts))
        out["kept"] = ~out["base_failed"] & (out["llr"] >= threshold)
        return {prefix + k: v for k, v in out.items()}

    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    schema = ", ".join([*[f"{prefix}{c} bigint" for c in counts], f"{prefix}base_failed boolean, {prefix}llr double, {prefix}kept boolean"])
    return tx.annotate(docs, text, schema, compute, keep)


def rules(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None, prefix: str = "") -> DataFrame:
    """The whole operator: fit on all documents, then decide on every one."""
    return assess(docs, fit(docs, trusted_ids(labels), doc_id=doc_id, text=text), text=text, keep=keep, prefix=prefix)
