"""Ranked search, exact duplicates and the Merkle manifest against plain programs."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import exact_dedup, lexical, merkle
from riskloom.llm.exact_dedup import CountingQuotientFilter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, idx int, n int, print string, `KEPT` int, `a.b` int"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    pool = ["".join(rng.choice("abcdeXYZ") for _ in range(rng.randint(1, 4))) for _ in range(60)]
    text = lambda n: " ".join(rng.choice(pool) for _ in range(n))
    out = [(i, text(rng.randint(1, 40)), rng.choice(["en", None]), rng.choice(["hot", "hot", "b", "", None, "ü"])) for i in range(70)]
    copy = text(30)
    out += [(100 + i, copy, "en", "hot") for i in range(40)]
    out += [(200, None, "en", "s"), (201, "", "en", "s"), (202, "\n \t\n", None, "b"), (203, "a\nb\n\nA B", "de", None), (204, "x\x00y-ä_Ä\x7fÉ", "en", "lone"),
            (205, "word é \n" * 9000, "en", "b"), (206, "a\nb\n\nA B", "de", "b"), (None, copy, "en", "hot"), (None, None, None, None)]
    out += [(300, text(12), "en", "b")] * 3 + [(301, copy, "en", "hot"), (301, text(9), "en", "hot"), (301, text(9), "en", "hot")]
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, len(t) if t else None, "x", 1, 2, "p", 3, 4) for i, t, lang, s in rows], SCHEMA)


# ---------------------------------------------------------------- exact duplicates


@pytest.mark.parametrize("width", [5, 9, 33, 64])
def test_filters_return_what_was_put_in_and_merge_without_loss(width):
    rng = np.random.default_rng(width)
    parts, whole = [], collections.Counter()
    for _ in range(4):
        values = np.unique(rng.integers(0, 2 ** min(width, 63), 300, dtype=np.uint64) & np.uint64((1 << width) - 1))
        counts = np.where(rng.random(len(values)) < 0.3, rng.integers(1, 2 ** 40, len(values)), 1)
        f = CountingQuotientFilter.from_bytes(CountingQuotientFilter.build(values, counts, width).to_bytes())
        back = f.entries()
        assert np.array_equal(back[0], values) and np.array_equal(back[1], counts)
        parts.append(f)
        whole.update(dict(zip(values.tolist(), counts.tolist(), strict=True)))
    merged = CountingQuotientFilter.merge(parts).entries()
    assert dict(zip(merged[0].tolist(), merged[1].tolist(), strict=True)) == dict(whole)
    assert np.all(np.diff(merged[0].astype(object)) > 0)
    none = CountingQuotientFilter.build(np.zeros(0, np.uint64), np.zeros(0, np.int64), width).entries()
    assert len(none[0]) == 0


def test_repeated_fingerprints_of_many_partitions(spark):
    data = [(int(x) - 2 ** 40,) for x in np.random.default_rng(1).integers(0, 2 ** 41, 500)] * 2 + [(7,)] * 400 + [(-1,), (-(2 ** 63),)]
    df = spark.createDataFrame(data, "v long").repartition(7)
    got = {r["print"]: r["n"] for r in exact_dedup.repeated(exact_dedup.filters(df, "v", slices=8)).collect()}
    assert got == {v: n for v, n in collections.Counter(x for x, in data).items() if n > 1}


@pytest.mark.parametrize("bits", [64, 4])
def test_equal_classes_are_those_of_the_bytes(spark, rows, bits):
    """With 4 bits nearly all texts share fingerprints, and only the bytes tell them apart."""
    got = exact_dedup.equal_classes(table(spark, rows).repartition(5), bits=bits).collect()
    groups = collections.defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    want = collections.Counter()
    for t, ids in groups.items():
        most = max((i for i in ids if i is not None), default=None)
        left = 1
        for i in sorted(ids, key=lambda i: i != most):
            want[i, most, len(ids), bool(left), hashlib.sha256(t.encode()).hexdigest()] += 1
            left = 0
    assert collections.Counter(tuple(r) for r in got) == want


def test_dedup_keeps_one_whole_row_of_each_text(spark, rows):
    docs = table(spark, rows)
    kept = exact_dedup.dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(r["text"] or "" for r in kept.collect()) == sorted({t or "" for _, t, *_ in rows})
    assert exact_dedup.dedup(docs, normalise=F.lower).count() == len({(t or "").lower() for _, t, *_ in rows})
    assert exact_dedup.equal_classes(docs.where("false")).count() == 0


# ---------------------------------------------------------------- Merkle manifest


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plain_manifest(rows, arity):
    """Counter of result rows, by trees built in lists."""

    def leaf(i, t, lang, s, n):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, s, lang, n, t)))

    def tree(digests):
        """(root, proof of each leaf as a list of (left siblings, right siblings))."""
        proofs, level, at = [[] for _ in digests], digests, list(range(len(digests)))
        while len(level) > 1:
            runs = [level[i:i + arity] for i in range(0, len(level), arity)]
            for leaf_no, pos in enumerate(at):
                run = runs[pos // arity]
                proofs[leaf_no].append((run[:pos % arity], run[pos % arity + 1:]))
            at = [p // arity for p in at]
            level = [sha("".join(r)) for r in runs]
        return level[0], proofs

    by = collections.defaultdict(list)
    for i, t, lang, s in rows:
        n = len(t) if t else None
        told = leaf(i, t.replace("\n", ""), lang, s, n) if i is not None and t and zlib.crc32(str(i).encode()) % 2 == 0 else None
        by[s].append((i is not None, i or 0, leaf(i, t, lang, s, n), told, i))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in order}
    root, upper = tree([trees[s][0] for s in order])
    out = collections.Counter()
    for k, s in enumerate(order):
        for (_, _, h, told, i), proof in zip(sorted(by[s], key=lambda x: x[:3]), trees[s][1], strict=True):
            whole = proof + upper[k]
            now = told or h
            for left, right in whole:
                now = sha("".join([*left, now, *right]))
            out[i, h, trees[s][0], root, sha("".join("".join(a + b) for a, b in whole)), now, now == root] += 1
    return out


@pytest.mark.parametrize("arity", [2, 3, 4])
def test_manifest_equals_trees_built_in_lists(spark, rows, arity):
    got = merkle.audit(table(spark, rows).repartition(6), arity=arity).collect()
    want = plain_manifest(rows, arity)
    assert collections.Counter(tuple(r) for r in got) == want
    assert {v for *_, v in want} == {True, False}


def test_manifest_of_one_row_one_source_and_no_row(spark, rows):
    for few in ([rows[0]], [r for r in rows if r[3] == "hot"], [(1, None, None, None)]):
        assert collections.Counter(tuple(r) for r in merkle.audit(table(spark, few)).collect()) == plain_manifest(few, 3)
    assert merkle.audit(table(spark, rows).where("false")).count() == 0


# ---------------------------------------------------------------- ranked search


def plain_rank(docs, items, k):
    bag = [(i, collections.Counter(TERM.findall(lower(t or "")))) for i, t, *_ in docs]
    n_docs, total = sum(1 for _, b in bag if b), sum(sum(b.values()) for _, b in bag)
    df = collections.Counter(t for _, b in bag for t in b)
    merged = collections.defaultdict(collections.Counter)
    for item, text in {(i, t or "") for i, t in items}:
        merged[item].update(TERM.findall(lower(text)))
    out = collections.Counter()
    for item, q in merged.items():
        scored = []
        for i, b in bag:
            m = 100 - 25 + (25 * sum(b.values()) * n_docs) // max(total, 1)
            score = sum(r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * b[t]) // (1000 * b[t] + 12 * m))
                        for t, r in q.items() if t in b)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        for place, (score, _, _, i) in enumerate(sorted(scored)[:k]):
            out[item, place + 1, i, -score] += 1
    return out


ITEMS = [(1, "a Xb"), (2, None), (3, ""), (4, "zzzz nothing9 of it"), (5, "ä x y É word WORD"), (6, "word " * 50 + "é a b c"), (7, "a b\nA-B"),
         (1, "Xb c"), (5, "ä x y É word WORD"), (None, "a cd")]


@pytest.mark.parametrize("k", [1, 3, 20])
def test_search_equals_scores_of_all_pairs(spark, rows, k):
    items = spark.createDataFrame([(i, t, 5) for i, t in ITEMS], "item_id int, text string, doc_id int")
    got = lexical.rank(table(spark, rows).repartition(5), items, k=k)
    want = plain_rank(rows, ITEMS, k)
    assert collections.Counter(tuple(r) for r in got.collect()) == want
    assert max(r[1] for r in want) == k


def test_search_in_blocks_with_small_score_matrices(spark, rows, monkeypatch):
    rng = random.Random(3)
    items = [(i, " ".join(rng.choice([t for _, t, *_ in rows if t and len(t) < 300]).split()[:6])) for i in range(40)]
    table_ = spark.createDataFrame(items, "item_id long, text string")
    whole = plain_rank(rows, items, 5)
    monkeypatch.setattr(lexical, "CELLS", 64)
    assert collections.Counter(tuple(r) for r in lexical.rank(table(spark, rows), table_, k=5, block_bytes=300).collect()) == whole


def test_search_of_empty_tables(spark, rows):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    assert lexical.rank(table(spark, rows).where("false"), items).count() == 0
    assert lexical.rank(table(spark, [(1, None, None, None), (2, "--", None, None)]), items).count() == 0
    empty = lexical.rank(table(spark, rows), items.where("false"))
    assert empty.count() == 0 and empty.columns == ["item_id", "rank", "doc_id", "score"]


def test_scores_beyond_doubles_stay_exact(spark):
    big = [(1, "q " * 70000 + "r")]
    docs = [(i, "q r " * (i + 1) if i % 3 else "s t", None, None) for i in range(12)]
    items = spark.createDataFrame(big, "item_id int, text string")
    assert collections.Counter(tuple(r) for r in lexical.rank(table(spark, docs), items).collect()) == plain_rank(docs, big, 20)
