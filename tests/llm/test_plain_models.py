"""The label model, the linear fit and the whole pipeline against plain programs."""

import collections
import math
import random
import zlib

import numpy as np
import pyarrow as pa

import corpus_pipeline
from riskloom.llm import langid, quality_rules, weak
from riskloom.llm import text as tx
from riskloom.llm import tokens as tk
from tests.llm.test_language_limits import plain_score
from tests.llm.test_text_ops import brute_fingerprint, brute_rules, union_find, words_of

SF = "/root/testdata/sf0.001"


def plain_em(rows, first, rounds, smoothing):
    """Expectation-maximisation document by document: P(positive) of each row of votes."""
    positive = list(first)
    for k in range(rounds):
        table = [[[smoothing] * 3 for _ in rows[0]] for _ in range(2)]
        for votes, p in zip(rows, positive, strict=True):
            for j, v in enumerate(votes):
                table[0][j][v] += 1 - p
                table[1][j][v] += p
        prior = min(max(sum(positive) / len(rows), 1e-4), 1 - 1e-4)
        new = []
        for votes in rows:
            odds = math.log(prior / (1 - prior))
            for j, v in enumerate(votes):
                odds += math.log(table[1][j][v] / sum(table[1][j])) - math.log(table[0][j][v] / sum(table[0][j]))
            new.append(1 / (1 + math.exp(-odds)))
        if k and max(abs(a - b) for a, b in zip(new, positive, strict=True)) < 1e-6:
            return positive, new
        positive = new
    return positive, positive


def test_label_model_equals_plain_em():
    rng = random.Random(3)
    rows = []
    for _ in range(600):
        truth = rng.random() < 0.3
        rows.append(tuple(0 if rng.random() < 0.4 else 1 + (truth if rng.random() < right else not truth) for right in (0.9, 0.8, 0.7, 0.85)))
    votes = np.array(rows)
    codes, back, counts = np.unique(weak.pattern_codes(votes), return_inverse=True, return_counts=True)
    distinct = weak.patterns(codes, 4)
    guess = (distinct == 2).sum(axis=1) > (distinct == 1).sum(axis=1)
    start = np.where(guess, 0.8, 0.2)
    model = weak.fit_label_model(distinct, counts, start, rounds=60)
    _, want = plain_em(rows, start[back], 60, 1.0)
    assert np.allclose(model.posterior(distinct)[back], want, atol=1e-9)


def test_linear_fit_reaches_the_plain_minimum():
    rng = np.random.default_rng(6)
    x = (rng.random((300, 5)) < 0.4) * rng.random((300, 5))
    y = 1 / (1 + np.exp(-(x @ np.array([3.0, -2.0, 0.0, 1.0, -1.0]) + 0.3)))
    starts = np.concatenate([[0], np.cumsum((x > 0).sum(axis=1))])
    cols, vals = np.nonzero(x)[1], x[x > 0]
    w, b = weak.fit_linear(starts, cols, vals, y, 5, l1=0.0, l2=1e-6, rounds=4000)
    pw, pb = np.zeros(5), 0.0
    for _ in range(100_000):  # plain gradient steps
        error = 1 / (1 + np.exp(-(x @ pw + pb))) - y
        pw, pb = pw - 2.0 * (x.T @ error) / 300, pb - 2.0 * error.mean()
    assert np.allclose(w, pw, atol=0.01) and abs(b - pb) < 0.01


def plain_pipeline(docs, good, profiles, least):
    """The five stages over a list of (doc_id, text); pieces as a counter."""
    kept = []
    for i, t in docs:
        if any(c.isalpha() for c in t or ""):
            name, score = plain_score(profiles, t, langid.SIZE)
            kept += [(i, t)] * (score >= least[name])
    size = quality_rules.BUCKETS
    raw, target, own = np.ones(size), np.ones(size), {}
    for i, t in kept:
        own[i] = quality_rules.gram_buckets(tx.Words(tx.plain(pa.array([t]))), tx.WordHashes(), size)[0]
        raw += np.bincount(own[i], minlength=size)
        target += np.bincount(own[i], minlength=size) * (i in good)
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    kept = [(i, t) for i, t in kept if not brute_rules(t)[5] and ratio[own[i]].mean() >= quality_rules.THRESHOLD]
    prints = [(i, brute_fingerprint(t)) for i, t in kept]
    group = union_find([i for i, _ in prints], [(a, b) for k, (a, x) in enumerate(prints) for b, y in prints[:k] if (x ^ y).bit_count() <= 4])
    kept = sorted((i, t) for i, t in kept if group[i] == i)
    first, out = {}, collections.Counter()
    for i, t in kept:
        w = words_of(t)
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k:k + 50]), i)
    library = tk.LibraryIds(tk.read_tokenizer()).tokenizer
    for i, t in kept:
        w, gone = words_of(t), set()
        for k in range(len(w) - 49):
            if first[tuple(w[k:k + 50])] < i:
                gone.update(range(k, k + 50))
        # a text that loses no word stays as it is
        left = " ".join(x for k, x in enumerate(w) if k not in gone) if gone else t
        ids = [*library.encode(left, add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            piece = np.array(ids[at:at + 4096], dtype="<u4")
            out[i, k, at, len(piece), zlib.crc32(piece.tobytes())] += 1
    return out


def test_pipeline_equals_a_plain_program(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = {r[0] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").select("doc_id").collect()}
    profiles = langid.fit(docs)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = plain_pipeline(rows, good, profiles, langid.least_scores(docs, profiles))
    got = collections.Counter(tuple(r) for r in corpus_pipeline.run(spark, SF).select("doc_id", "piece", "start", "length", "ids_crc32").collect())
    assert got == want and 0 < len({k[0] for k in got}) < len(rows)
