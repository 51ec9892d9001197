"""Quality classifier by weak labels: heuristic labellers, expectation-maximisation, a hashed linear scorer.

Labellers look at every document: symbols among the characters, table bars, upper-case letters, words that
repeat a word just before or are repeated by the next, repeated windows and lines, words of letters only, and common short words. Each
calls a document good or bad by fixed limits, or abstains. Expectation-maximisation over the vote patterns
of the whole corpus estimates their accuracies without any label. The posteriors label a bounded sample
(documents in hash order of the id, at most ``max_sample`` and about ``max_bytes`` of text), on which a logistic regression over hashed features is
trained: runs of letters, other runs, case shapes and repeats, as shares of the text. It scores every
whole text; ``kept`` says whether the score (P(good)) reaches ``threshold``.

Defined results: a text without words (null, empty) scores 0 and is not kept; a null id isn't sampled;
repeated rows count each time in the vote patterns; on an empty table the scorer is neutral and there are
no rows; computed columns replace kept columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import quality_rules as qr
from riskloom.llm import text as tx
from riskloom.llm import weak

MAX_SAMPLE, BUCKETS, THRESHOLD = 20_000, 1 << 16, 0.3
#: Bytes of text after which the sample takes no further document: it bounds the features on the driver.
MAX_BYTES = 24 << 20
VOTERS = 10


def _share(flag: np.ndarray, words: tx.Words) -> np.ndarray:
    return tx.segment_sums(flag.astype(np.int64), words.starts) / np.maximum(1, words.counts)


def word_traits(words: tx.Words) -> dict[str, np.ndarray]:
    """Flags of each word of the texts in turn."""
    vocab, codes = words.vocab, words.codes

    def match(pattern: str) -> np.ndarray:
        return pc.match_substring_regex(vocab, pattern).to_numpy(zero_copy_only=False)[codes]

    doc = words.doc
    again, near = np.zeros(len(codes), bool), np.zeros(len(codes), bool)
    for back in (1, 2, 3):
        same = (codes[back:] == codes[:-back]) & (doc[back:] == doc[:-back])
        near[back:] |= same
        if back == 1:
            again[1:] = same
    return {"symbol": match(r"[#*$%&|<>]"), "bar": match(r"^\|$"), "upper": match(r"^[^\pL]*\pLu[\pLu]+[^\pL]*$"), "shout": match(r"!!"),
            "again": again, "near": near, "letters": match(r"^\pL+[.,;:!?]?$"), "short": match(r"^\pL{1,4}[.,]?$")}


def _followed(flag: np.ndarray, words: tx.Words) -> np.ndarray:
    """Share of words whose next word has the flag."""
    after = np.zeros(len(flag), bool)
    after[:-1] = flag[1:]
    return _share(after, words)


def votes(texts: pa.Array, words: tx.Words, traits: dict[str, np.ndarray]) -> np.ndarray:
    """(texts, VOTERS): 2 for bad, 1 for good, 0 for no opinion."""
    n = np.maximum(1, words.counts)
    share = {k: _share(v, words) for k, v in traits.items()}
    repeats, lines = qr.repeated_words(words) / n, qr.repeated_lines(texts.to_pylist()) * 10 / n

    def vote(x: np.ndarray, bad: float, good: float) -> np.ndarray:
        return np.where(words.counts < 5, 0, np.where(x >= bad, 2, np.where(x <= good, 1, 0)))

    return np.column_stack([
        vote(share["symbol"], 0.2, 0.05), vote(share["bar"], 0.15, 0.02), vote(share["upper"] + share["shout"], 0.4, 0.1),
        vote(share["again"], 0.25, 0.1), vote(share["near"], 0.4, 0.15), vote(_followed(traits["again"], words), 0.25, 0.1), vote(repeats, 0.3, 0.1), vote(lines, 1.0, 0.3), vote(-share["letters"], -0.5, -0.8), vote(-share["short"], -0.02, -0.15)])


def feature_codes(words: tx.Words, traits: dict[str, np.ndarray], hashes: tx.WordHashes, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every feature occurrence of all texts in turn, each text's start)."""
    codes, offsets, vocab = tx.parts(words.vocab, qr.PART)
    part, starts = tx.of_words(words, codes, offsets)
    shape = sum(traits[k].astype(np.uint64) << np.uint64(i) for i, k in enumerate(sorted(traits)))
    h = np.concatenate([tx.mix64(hashes.of(vocab)[part]), tx.mix64(shape + np.uint64(1 << 32))]) & np.uint64(buckets - 1)
    at = np.column_stack([starts[:-1], len(part) + words.starts[:-1]]).ravel()
    size = np.column_stack([np.diff(starts), words.counts]).ravel()
    return h[tx.ragged(at, size)].astype(np.int64), np.concatenate([[0], np.cumsum(np.diff(starts) + words.counts)])


class Model:
    def __init__(self, weights: np.ndarray, intercept: float, labels: weak.LabelModel | None):
        self.weights, self.intercept, self.labels = weights, intercept, labels

    def scores(self, texts: pa.Array) -> np.ndarray:
        """P(good)."""
        words = tx.Words(texts)
        codes, starts = feature_codes(words, word_traits(words), tx.WordHashes(), len(self.weights))
        odds = tx.segment_sums(self.weights[codes], starts) / np.maximum(1, words.counts) + self.intercept
        return np.where(words.counts > 0, 1 / (1 + np.exp(np.clip(odds, -500, 500))), 0.0)


def fit(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", max_sample: int = MAX_SAMPLE, max_bytes: int = MAX_BYTES, buckets: int = BUCKETS) -> Model:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for part in tx.slices(batches, "text"):
            texts = tx.plain(part.column("text"))
            words = tx.Words(texts)
            codes, n = np.unique(weak.pattern_codes(votes(texts, words, word_traits(words))), return_counts=True)
            for c, k in zip(codes.tolist(), n.tolist(), strict=True):
                total[c] = total.get(c, 0) + k
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["code", "n"])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    seen = rows.select("text").mapInArrow(count, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")).orderBy("code").toPandas()
    if not len(seen):
        return Model(np.zeros(buckets), 0.0, None)
    pattern, counts = weak.patterns(seen["code"].to_numpy(np.int64), VOTERS), seen["n"].to_numpy(float)
    start = np.where((pattern == 2).any(axis=1), 0.8, 0.05)
    labeller = weak.fit_label_model(pattern, counts, start)

    ids = rows.where("doc_id is not null").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_sample)
    sizes = rows.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("size"))
    before = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, -1)  # at most max_sample rows
    picked = sizes.select("doc_id", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before")).where(F.col("before") < max_bytes).select("doc_id")
    sample = rows.join(F.broadcast(picked), "doc_id").select("text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = tx.WordHashes()
        for part in tx.slices(batches, "text"):
            texts = tx.plain(part.column("text"))
            words = tx.Words(texts)
            traits = word_traits(words)
            code = weak.pattern_codes(votes(texts, words, traits))
            codes, starts = feature_codes(words, traits, hashes, buckets)
            doc = np.repeat(np.arange(len(texts)), np.diff(starts))
            keys, n = np.unique(doc * buckets + codes, return_counts=True)
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(keys // buckets, minlength=len(texts)))]).astype(np.int32))
            share = (n / np.maximum(1, words.counts)[keys // buckets]).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.ListArray.from_arrays(ends, pa.array((keys % buckets).astype(np.int32))),
                                              pa.ListArray.from_arrays(ends, pa.array(share))], names=["votes", "cols", "share"])

    table = sample.mapInArrow(encode, "votes bigint, cols array<int>, share array<float>").toArrow()  # the bounded sample
    bad = labeller.posterior(weak.patterns(table["votes"].to_numpy(), VOTERS))
    cols = table["cols"].combine_chunks()
    starts = np.concatenate([[0], np.cumsum(pc.list_value_length(cols).to_numpy(zero_copy_only=False))]).astype(np.int64)
    flat, vals = cols.flatten().to_numpy().astype(np.int64), table["share"].combine_chunks().flatten().to_numpy().astype(np.float64)
    weights, intercept = weak.fit_linear(starts, flat, vals, bad, buckets, l1=1e-3, rounds=150)
    return Model(weights, intercept, labeller)


def classify(docs: DataFrame, model: Model, *, text: str = "text", keep: list[str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` columns with score (P(good)) and kept of every whole text."""

    def compute(part: pa.RecordBatch) -> dict:
        s = model.scores(tx.plain(part.column(text)))
        return {"score": s, "kept": s >= threshold}

    return tx.annotate(docs, text, "score double, kept boolean", compute, keep)
