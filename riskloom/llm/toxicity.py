"""Toxicity by weak supervision: lexicon and pattern voters, a generative label model with correlations,
and a linear classifier trained on its posterior labels.

A text's features are its runs of letters (lower-cased) and their first four to seven letters. On a
bounded sample of labelled documents (``max_labelled``, in hash order of the id; rows whose crc32 of the
id modulo 4 is 2 are never read; of documents with the same least shingle hash, mostly copies, one is
used) the features' document counts by label, at one, two and three
occurrences, give lexicons: a feature enters with the least number of occurrences that tells toxic
documents. Voters then look at every document of the corpus: hits of each lexicon, of two halves of it,
their variety and density, and shouting. The label model is fitted to the vote patterns of all documents,
starting from the sample's rates, and estimates the voters' accuracies and how far they repeat each other
within a class. Its posteriors label the sample, on which a sparse logistic regression over lexicon
counts is trained; that scores every whole text.

Defined results: a text without letters (null, empty) scores the intercept, that is, as clean; without
labelled toxic documents every score is 0; a null id is not held out and trains nothing; repeated rows
count each time in the vote patterns; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import langid, substring, weak
from riskloom.llm import text as tx
from riskloom.session import cut_lineage

#: Labelled documents of the sample at most; lexicon entries at most.
MAX_LABELLED, MAX_FEATURES = 20_000, 50_000
#: An entry's least number of toxic documents in the sample, and least log odds of a toxic document.
LEAST_TOXIC, LEAST_ODDS = 6, 3.5
#: Occurrences that are told apart when a lexicon is made, and counted at most by the classifier.
LEVELS, MOST = 3, 4
THRESHOLD = 0.3
VOTERS = 11
_PREFIXES = (4, 5, 6, 7)
_KINDS = 1 + len(_PREFIXES)


def run_features(runs: list[str]) -> np.ndarray:
    """(runs, kinds) feature hashes: the run, its first four letters, five, ... The lowest bits tell the kind."""
    h = xxhash.xxh64_intdigest
    flat = [h(s) for r in runs for s in (r, *[r[:n] for n in _PREFIXES])]
    return (np.array(flat, dtype=np.uint64).reshape(-1, _KINDS) & ~np.uint64(7)) | np.arange(_KINDS, dtype=np.uint64)


def labelled_ids(labels: DataFrame, *, doc_id: str = "doc_id", toxic: str = "toxic", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, toxic) of at most ``max_labelled`` labelled documents that are not held out."""
    rows = labels.where(F.col(doc_id).isNotNull() & F.col(toxic).isNotNull() & ~langid.held_out(F.col(doc_id), 4, 2))
    rows = rows.groupBy(F.col(doc_id).cast("bigint").alias("doc_id")).agg(F.max(F.col(toxic).cast("int")).alias("toxic"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)


#: Similarity of 4-word shingles from which a sampled document counts as a copy.
COPY = 0.8


def without_copies(sample: DataFrame) -> DataFrame:
    """(text, toxic) of the sample's documents without copies: of documents of one label that share their
    least 4-word hash and at least ``COPY`` of their shingles with one of smaller id, that one. A copied document
    would make its rare words look like entries. Documents of different labels stay, as do those that
    only share a passage. The sample is bounded, so a group is too; it is written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = tx.WordHashes()
        for part in tx.slices(batches, "text"):
            words = tx.Words(tx.plain(part.column("text")))
            h, doc = hashes.of(words.vocab)[words.codes], words.doc
            least, held = np.zeros(len(words), np.uint64), []
            grams = tx.mix64(substring.sequence_hashes(h, 4)) if len(h) >= 4 else np.zeros(0, np.uint64)
            inside = doc[:-3] == doc[3:] if len(h) >= 4 else np.zeros(0, bool)
            cuts = np.searchsorted(doc[:-3][inside], np.arange(len(words) + 1)) if len(h) >= 4 else np.zeros(len(words) + 1, int)
            grams = grams[inside]
            ids = part.column("doc_id").to_numpy(zero_copy_only=False)
            for i in range(len(words)):
                own = np.unique(grams[cuts[i]:cuts[i + 1]])
                least[i] = own[0] if len(own) else tx.mix64(ids[i:i + 1].astype(np.int64).view(np.uint64))[0]
                held.append(own.tobytes())
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(least.view(np.int64)), pa.array(held, pa.binary())],
                                             names=["doc_id", "text", "toxic", "least", "grams"])

    def distinct(group: pd.DataFrame) -> pd.DataFrame:
        kept: list[np.ndarray] = []
        rows = []
        for i, raw in group.sort_values("doc_id")["grams"].items():
            own = np.frombuffer(raw, np.uint64)
            if all(len(common := np.intersect1d(own, k, assume_unique=True)) < COPY * (len(own) + len(k) - len(common)) or not len(own) for k in kept):
                kept.append(own)
                rows.append(i)
        return group.loc[rows, ["text", "toxic"]]

    named = sample.select("doc_id", "text", "toxic").mapInArrow(run, "doc_id bigint, text string, toxic int, least bigint, grams binary")
    named = cut_lineage(named)
    sizes = named.groupBy("least", "toxic").agg(F.count(F.lit(1)).alias("n"))
    rows = named.join(sizes, ["least", "toxic"])
    alone = rows.where("n = 1").select("text", "toxic")
    groups = rows.where("n > 1").groupBy("least", "toxic").applyInPandas(distinct, "text string, toxic int")
    return cut_lineage(alone.unionByName(groups))


class Lexicon:
    """Entries (sorted feature hashes) and the occurrences that each needs."""

    def __init__(self, features: np.ndarray, level: np.ndarray):
        self.features, self.level = features, level

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Index of each hash, or -1."""
        if not len(self.features):
            return np.full(hashes.shape, -1)
        at = np.minimum(np.searchsorted(self.features, hashes), len(self.features) - 1)
        return np.where(self.features[at] == hashes, at, -1)

    def hits(self, run: np.ndarray, starts: np.ndarray, runs: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, entry, occurrences) of the entries that occur often enough in a text."""
        found = self.find(run_features(runs))
        some = (found >= 0).any(axis=1) if len(found) else np.zeros(0, bool)
        doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        held = some[run] if len(run) else np.zeros(0, bool)
        pair = np.column_stack([np.repeat(doc[held], _KINDS), found[run[held]].ravel()])
        pair = pair[pair[:, 1] >= 0]
        size = max(1, len(self.features))
        key, n = np.unique(pair[:, 0] * size + pair[:, 1], return_counts=True)
        doc, entry = key // size, key % size
        enough = n >= self.level[entry] if len(key) else np.zeros(0, bool)
        return doc[enough], entry[enough], n[enough]

    def votes(self, texts: pa.Array, words: tx.Words, starts: np.ndarray, doc: np.ndarray, entry: np.ndarray, n: np.ndarray) -> np.ndarray:
        """(texts, VOTERS) votes."""
        size = np.diff(starts)
        kind = (self.features[entry] & np.uint64(7)).astype(np.int64)
        half = (self.features[entry] >> np.uint64(3) & np.uint64(1)) == 0

        def total(flag: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
            return np.bincount(doc[flag], weights=None if weight is None else weight[flag], minlength=len(size))

        def vote(x: np.ndarray, yes: float, no: float = 0) -> np.ndarray:
            return np.where(x >= yes, 2, np.where(x <= no, 1, 0))

        every = np.ones(len(doc), bool)
        density = 100 * total(kind < 2, n.astype(float)) / np.maximum(1, size)
        shout = pc.count_substring_regex(texts, "!!|[?]!").to_numpy(zero_copy_only=False) / np.maximum(1, words.counts)
        return np.column_stack([
            *[vote(total(kind == k), 2 if k == 0 else 1) for k in range(_KINDS)],
            vote(total(half), 2), vote(total(~half), 2), vote(total(every), 4, 1), vote(total(every, n.astype(float)), 5, 2),
            vote(density, 1.0, 0.1), np.where(shout > 0.05, 2, 0)])


def _parts(part: pa.RecordBatch):
    texts = tx.plain(part.column("text"))
    words = tx.Words(texts)
    return texts, words, *langid.letter_runs(words)


def fit_lexicon(sample: DataFrame) -> Lexicon:
    """sample: (text, toxic) rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text"):
            _, _, run, starts, runs = _parts(part)
            distinct, number = np.unique(run_features(runs).ravel(), return_inverse=True)
            size = max(1, len(distinct))
            doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            keys, n = np.unique((doc[:, None] * size + number.reshape(-1, _KINDS)[run]).ravel(), return_counts=True)
            toxic = part.column("toxic").to_numpy(zero_copy_only=False)[keys // size] == 1
            of = keys % size
            for level in range(1, LEVELS + 1):
                bad = np.bincount(of[toxic & (n >= level)], minlength=len(distinct))
                good = np.bincount(of[~toxic & (n >= level)], minlength=len(distinct))
                some = np.flatnonzero(bad + good)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(distinct[some].view(np.int64)), pa.array(np.full(len(some), level, np.int32)), pa.array(bad[some]), pa.array(good[some])],
                    names=["feature", "level", "bad", "good"])

    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    sums = sample.select("text", "toxic").mapInArrow(count, "feature bigint, level int, bad bigint, good bigint").groupBy("feature", "level").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    odds = F.log((F.col("bad") + 0.5) / (bad + 1.0)) - F.log((F.col("good") + 0.5) / (good + 1.0))
    entries = sums.where(F.col("bad") >= LEAST_TOXIC).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
    entries = entries.groupBy("feature").agg(F.min("level").alias("level"), F.max("odds").alias("odds"))
    rows = entries.orderBy(F.desc("odds"), "feature").limit(MAX_FEATURES).toPandas()  # a bounded list
    features = rows["feature"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(features)
    return Lexicon(features[order], rows["level"].to_numpy(np.int64)[order])


def corpus_patterns(texts: DataFrame, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """Vote patterns of all documents and how many have each (at most 3 ** VOTERS rows)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for part in tx.slices(batches, "text"):
            whole, words, run, starts, runs = _parts(part)
            codes, n = np.unique(weak.pattern_codes(lexicon.votes(whole, words, starts, *lexicon.hits(run, starts, runs))), return_counts=True)
            for c, k in zip(codes.tolist(), n.tolist(), strict=True):
                total[c] = total.get(c, 0) + k
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["code", "n"])

    rows = texts.mapInArrow(count, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")).orderBy("code").toPandas()
    return weak.patterns(rows["code"].to_numpy(np.int64), VOTERS), rows["n"].to_numpy(float)


class Model:
    """A fitted classifier: weights of the lexicon's entries and an intercept."""

    def __init__(self, lexicon: Lexicon, weights: np.ndarray, intercept: float, labels: weak.LabelModel | None):
        self.lexicon, self.weights, self.intercept, self.labels = lexicon, weights, intercept, labels

    def scores(self, texts: pa.Array) -> np.ndarray:
        run, starts, runs = langid.letter_runs(tx.Words(texts))
        doc, entry, n = self.lexicon.hits(run, starts, runs)
        odds = np.bincount(doc, weights=np.minimum(n, MOST) * self.weights[entry], minlength=len(texts)) + self.intercept
        return np.where(np.isneginf(odds), 0.0, 1 / (1 + np.exp(-np.clip(odds, -500, 500))))


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", max_labelled: int = MAX_LABELLED) -> Model:
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    ids = labelled_ids(labels, max_labelled=max_labelled)
    sample = without_copies(rows.join(F.broadcast(ids), "doc_id"))
    lexicon = fit_lexicon(sample)
    if not len(lexicon.features):
        return Model(lexicon, np.zeros(0), -np.inf, None)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches, "text"):
            whole, words, run, starts, runs = _parts(part)
            doc, entry, n = lexicon.hits(run, starts, runs)
            codes = weak.pattern_codes(lexicon.votes(whole, words, starts, doc, entry, n))
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(codes)))]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(codes), part.column("toxic"), pa.ListArray.from_arrays(ends, pa.array(entry.astype(np.int32))),
                 pa.ListArray.from_arrays(ends, pa.array(np.minimum(n, MOST).astype(np.int32)))], names=["votes", "toxic", "cols", "n"])

    # the bounded sample, as vote patterns and lexicon counts
    table = sample.mapInArrow(encode, "votes bigint, toxic int, cols array<int>, n array<int>").toArrow()
    codes = table["votes"].to_numpy()
    votes, counts = corpus_patterns(rows.select("text"), lexicon)
    known, number = np.unique(codes, return_inverse=True)
    toxic = np.bincount(number, weights=table["toxic"].to_numpy(), minlength=len(known))
    rate = (toxic + 0.1) / (np.bincount(number, minlength=len(known)) + 1)
    every = weak.pattern_codes(votes)
    at = np.minimum(np.searchsorted(known, every), len(known) - 1)
    lean = np.where((votes == 2).sum(axis=1) > (votes == 1).sum(axis=1), 0.9, 0.05)
    labeller = weak.fit_label_model(votes, counts, np.where(known[at] == every, rate[at], lean), correlated=True)
    posterior = labeller.posterior(weak.patterns(codes, VOTERS))
    cols = table["cols"].combine_chunks()
    starts = np.concatenate([[0], np.cumsum(pc.list_value_length(cols).to_numpy(zero_copy_only=False))]).astype(np.int64)
    vals = table["n"].combine_chunks().flatten().to_numpy().astype(np.float64)
    weights, intercept = weak.fit_linear(starts, cols.flatten().to_numpy().astype(np.int64), vals, posterior, len(lexicon.features))
    return Model(lexicon, weights, intercept, labeller)


def score(docs: DataFrame, model: Model, *, text: str = "text", keep: list[str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` columns with score and predicted of every whole text."""

    def compute(part: pa.RecordBatch) -> dict:
        s = model.scores(tx.plain(part.column(text)))
        return {"score": s, "predicted": pa.array((s >= threshold).astype(np.int32))}

    return tx.annotate(docs, text, "score double, predicted int", compute, keep)
