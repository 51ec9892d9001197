"""Embedding dedup against brute force, weak-label models on held-out rows, graph helpers, the pipeline."""

import collections
import random
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskloom.llm import embed_dedup, graph, quality_model, quality_rules, simhash, substring, toxicity, weak
from riskloom.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 50)]
    edges = chain + star + [(300, 300), (7, 6), (6, 7)]
    random.Random(1).shuffle(edges)
    got = dict(tuple(r) for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(50)}}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_forest_labels_are_the_smallest_reachable():
    rng = np.random.default_rng(0)
    u, v = rng.integers(0, 200, 150), rng.integers(0, 200, 150)
    label = np.arange(200)
    for _ in range(200):
        for a, b in zip(u, v, strict=True):
            label[a] = label[b] = min(label[a], label[b])
    assert graph.forest(200, u, v).tolist() == label.tolist()


def vectors(rng, size):
    base = rng.normal(size=(60, size))
    near = base[:30] + 0.12 * rng.normal(size=(30, size)) * np.linalg.norm(base[:30], axis=1)[:, None] / np.sqrt(size)
    dense = base[0] + 0.05 * rng.normal(size=(40, size)) * np.linalg.norm(base[0]) / np.sqrt(size)
    return np.concatenate([base, near, dense, np.repeat(base[5:6], 25, axis=0), 3 * base[6:8]]).astype(np.float32)


@pytest.mark.parametrize("block, crowd", [(embed_dedup.BLOCK, embed_dedup.CROWD), (7, embed_dedup.CROWD), (embed_dedup.BLOCK, 0.02)])
def test_embedding_links_equal_brute_force(spark, block, crowd, monkeypatch):
    monkeypatch.setattr(embed_dedup, "SMALL", 16)
    rng = np.random.default_rng(4)
    rows = []
    for size in (64, 8, 3):
        for x in vectors(rng, size):
            rows.append((len(rows), x.tolist(), int(rng.integers(0, 2)) if size == 64 else 5))
    rows += [(rows[0][0], rows[0][1], rows[0][2])]  # a repeated row
    n = len(rows)
    rows += [(n + 1, None, 1), (n + 2, [0.0] * 64, 1), (n + 3, [None] * 64, 1), (n + 4, [float("nan")] * 64, 1), (n + 5, [float("inf")] * 64, 1),
             (n + 6, rows[0][1], None), (None, rows[0][1], rows[0][2]), (n + 7, [], 1)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, kept string")
    got = collections.Counter(tuple(r) for r in embed_dedup.near_duplicates(table, block=block, crowd=crowd).collect())

    def usable(i, x, y):
        return i is not None and y is not None and x and all(v is not None and np.isfinite(v) for v in x) and any(x)

    links = np.zeros(len(rows), int)
    component = [i for i, _, _ in rows]
    pairs = []
    for a, (ia, xa, ya) in enumerate(rows):
        for b, (ib, xb, yb) in enumerate(rows):
            if a != b and usable(ia, xa, ya) and usable(ib, xb, yb) and ya == yb and len(xa) == len(xb):
                x, y = np.array(xa, float), np.array(xb, float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93:
                    links[a] += 1
                    pairs.append((a, b))
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if component[b] < component[a]:
                component[a], changed = component[b], True
    want = collections.Counter((r[0], int(k), c, r[0] is None or r[0] == c) for r, k, c in zip(rows, links, component, strict=True))
    assert got == want


def test_embedding_recall_at_the_threshold():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(4000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = rng.normal(size=x.shape)
    y -= (x * y).sum(axis=1)[:, None] * x
    y = 0.93 * x + np.sqrt(1 - 0.93 ** 2) * y / np.linalg.norm(y, axis=1)[:, None]
    for level, pairs in ((0, 4000), (2, 1000)):
        code = embed_dedup.ProductCode(64, level)
        (r1, f1), (r2, f2) = code.filters(x[:pairs]), code.filters(y[:pairs])
        both = np.intersect1d(r1.astype(np.int64) << 32 | f1, r2.astype(np.int64) << 32 | f2)
        shared = np.bincount(both >> 32, minlength=pairs)
        assert (shared > 0).all() and shared.mean() > 10
        if level == 0:  # list decoding finds what all pairs of codewords give
            unit = x[:50]
            for r, (turn, half, first, second) in enumerate(code.parts):
                z = unit @ turn
                total = ((z[:, :half] @ first.T)[:, :, None] + (z[:, half:] @ second.T)[:, None, :]).reshape(50, -1)
                for i in range(50):
                    own = f1[(r1 == i) & (f1 // code.codewords ** 2 == r)] - r * code.codewords ** 2
                    strongest = np.argsort(-total[i])[:max(code.floor, int((total[i] >= code.threshold).sum()))]
                    assert set(own.tolist()) == set(strongest.tolist())


def test_label_model_finds_accuracies_and_damps_copies():
    rng = np.random.default_rng(1)
    y = rng.random(20_000) < 0.2
    right = [0.95, 0.9, 0.8, 0.8]
    votes = np.column_stack([np.where(rng.random(len(y)) < p, y, ~y) + 1 for p in right])
    votes = np.column_stack([votes, votes[:, 3]])  # a voter that repeats another
    votes[rng.random(votes.shape) < 0.1] = 0
    pattern, counts = np.unique(weak.pattern_codes(votes), return_counts=True)
    pattern = weak.patterns(pattern, votes.shape[1])
    start = np.where((pattern == 2).sum(axis=1) > (pattern == 1).sum(axis=1), 0.8, 0.1)
    model = weak.fit_label_model(pattern, counts.astype(float), start, correlated=True)
    found = model.accuracies()
    assert np.abs(found[:2] - right[:2]).max() < 0.1 and abs(model.prior - 0.2) < 0.1, (found, model.prior)
    assert model.weight[4] < 0.7 < model.weight[0], model.weight
    plain = weak.LabelModel(model.prior, model.table, np.zeros((5, 5)))
    assert ((model.posterior(votes) > 0.5) == y).mean() >= ((plain.posterior(votes) > 0.5) == y).mean() > 0.85


def test_linear_fit_separates_soft_labels():
    rng = np.random.default_rng(2)
    cols = np.concatenate([rng.choice(50, 8, replace=False) for _ in range(400)])
    x = cols.reshape(400, 8)
    y = np.where((x < 10).sum(axis=1) >= 2, 0.95, 0.05)
    w, b = weak.fit_linear(np.arange(0, 3201, 8), cols, np.ones(3200), y, 50)
    score = w[x].sum(axis=1) + b
    assert ((score > 0) == (y > 0.5)).mean() > 0.9 and w[:10].mean() > w[10:].mean() + 1


def toxic_table(spark):
    rng = random.Random(8)
    pool = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(500)]
    docs, labels = [], []
    for i in range(900):
        words = [rng.choice(pool) for _ in range(rng.randint(20, 120))]
        bad = i % 6 == 0
        if bad:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["zonker", "wuzzle", "quimby"]) + rng.choice(["", "s", "ish"]))
        docs.append((i, " ".join(words), "clash"))
        if i % 10 != 9:
            labels.append((i, int(bad)))
    docs += [(2000, None, "x"), (2001, "", "x"), (None, "zonker zonker wuzzle quimby", "x"), (0, docs[0][1], "x"), (2002, "word " * 30_000 + "zonker wuzzle quimby zonkers", "x")]
    labels += [(None, 1), (5, None), (3, 0), (3, 0)]
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_on_held_out_rows(spark):
    docs, labels = toxic_table(spark)
    model = toxicity.fit(docs, labels)
    out = toxicity.score(docs, model, keep=["doc_id", "score"])
    assert out.columns == ["doc_id", "score", "predicted"]
    got = [tuple(r) for r in out.collect()]
    assert len(got) == docs.count() and all(0 <= s <= 1 and p == int(s >= 0.3) for _, s, p in got)
    held = [(i, p) for i, _, p in got if i is not None and i < 900 and zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(p == int(i % 6 == 0) for i, p in held) >= 0.97 * len(held)
    by = {i: p for i, _, p in got}
    assert by[2000] == by[2001] == 0 and by[2002] == 1 and by[None] == 1


def test_toxicity_never_reads_held_out_labels(spark):
    docs, labels = toxic_table(spark)
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.score(docs, toxicity.fit(docs, x), keep=["doc_id"]).collect() for x in (labels, flipped))
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_toxicity_without_labels(spark):
    docs, labels = toxic_table(spark)
    for none in (labels.where("false"), labels.where("toxic = 0")):
        assert toxicity.score(docs, toxicity.fit(docs, none)).agg(F.max("score")).first()[0] == 0
    assert toxicity.score(docs.where("false"), toxicity.fit(docs.where("false"), labels)).count() == 0


def test_quality_classifier_tells_junk_without_labels(spark):
    rng = random.Random(3)
    pool = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    rows = []
    for i in range(400):
        words = [rng.choice(pool) for _ in range(rng.randint(30, 90))]
        kind = i % 8
        if kind == 5:
            words = [w + rng.choice(["$$$", "###", "&&&"]) for w in words]
        elif kind == 6:
            words = [w.upper() + "!!" for w in words]
        elif kind == 7:
            words = [w for w in words for _ in range(4)]
        rows.append((i, " ".join(words), "k"))
    rows += [(900, None, "k"), (901, "", "k"), (None, rows[0][1], "k"), (1, rows[1][1], "k"), (902, "fine words here " * 20_000, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, KEPT string")
    model = quality_model.fit(docs)
    out = quality_model.classify(docs, model, keep=["doc_id", "KEPT"])
    assert out.columns == ["doc_id", "score", "kept"]
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(rows) and all(0 <= s <= 1 for _, s, _ in got)
    own = [(i, k) for i, _, k in got if i is not None and i < 400]
    assert all(k for i, k in own if i % 8 < 5)
    assert sum(not k for i, k in own if i % 8 >= 5) >= 0.95 * sum(i % 8 >= 5 for i, _ in own)
    assert not any(k for i, _, k in got if i in (900, 901))
    empty = docs.where("false")
    assert quality_model.classify(empty, quality_model.fit(empty)).count() == 0


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.withColumn("score", F.lit("clash")).withColumn("KEPT", F.lit(1)).withColumn("rk", F.lit("clash"))
    awkward = spark.createDataFrame([(10**6, None, "en", "s", 0), (10**6 + 1, "", "en", "s", 0), (10**6 + 2, "12 34 %%", "en", "s", 8),
                                     (None, None, None, None, None)], docs.schema)
    now = extra.unionByName(awkward, allowMissingColumns=True)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "quality_rules", "simhash_near_dedup", "substring_dedup", "best_fit_packing"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = now
        now = stage(spark, before, SF).cache()
        if k < 4:
            assert now.columns == before.columns
        if name == "language_id":
            assert now.where("doc_id >= 1000000 or doc_id is null").count() == 0
        elif name == "quality_rules":
            judged = quality_rules.rules(before, spark.read.parquet(f"{SF}/labels.parquet"), keep=["doc_id"])
            assert {r[0] for r in judged.where("kept").select("doc_id").collect()} == {r[0] for r in now.select("doc_id").collect()}
            assert now.count() < before.count()
        elif name == "simhash_near_dedup":
            groups = simhash.near_duplicates(before).select("component_id").distinct().count()
            assert now.count() == groups < before.count()
        elif name == "substring_dedup":
            lost = substring.dedup(before, digests=True).agg(F.sum("n_words") - F.sum("n_removed")).first()[0]
            assert sum(len((r[0] or "").encode().split()) for r in now.select("text").collect()) == lost
            assert now.where("n_chars != length(text)").count() == 0
        else:
            assert now.select("doc_id").distinct().count() == before.count()
    whole = corpus_pipeline.run(spark, SF)
    assert whole.columns == now.columns and whole.count() > 0


@pytest.mark.parametrize("key", sorted(LLM_QUERIES))
def test_registered_queries_return_their_columns(spark, key):
    need = {1: "vec_id n_links component_id kept", 2: "doc_id fingerprint component_id", 3: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
            4: "doc_id n_tokens", 5: "doc_id piece start length ids_crc32 sequence_id offset", 6: "doc_id n_words n_removed kept_sha256", 7: "doc_id held_out lang_pred score",
            8: "doc_id n_tokens ids_sha256 decoded_sha256", 9: "doc_id score kept", 10: "doc_id held_out score predicted",
            11: "item_id rank doc_id score", 12: "doc_id keep_id group_size kept text_sha256", 13: "doc_id leaf subroot root proof_sha256 folded_root verified"}[int(key[2:].split("_")[0])]
    out = LLM_QUERIES[key](spark, SF)
    assert set(need.split()) <= set(out.columns)
    rows = spark.read.parquet(f"{SF}/{'embeddings' if key.startswith('op1_') else 'documents'}.parquet").count()
    assert out.count() >= rows


def test_entry_works_without_the_package(tmp_path):
    code = """
import sys, importlib.abc
class Gone(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name.startswith(("riskloom.llm", "corpus_pipeline")):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
sys.path.insert(0, %r)
import __spark_entry__ as e
assert "tier_distribution" in e.queries() and not any(k.startswith("op") for k in e.queries())
assert "pipeline" not in e.queries() and "pipeline" not in e.oracle_sql()
""" % str(ROOT)
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path, timeout=120)
