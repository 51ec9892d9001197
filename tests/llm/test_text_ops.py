"""Text operators against brute force, on small tables with awkward rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from riskloom.llm import bpe, langid, packing, quality_rules, simhash, substring, token_counts
from riskloom.llm import text as tx
from riskloom.llm import tokens as tk

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, KEPT int"


def table(spark, rows):
    """documents with extra columns whose names clash with results."""
    data = [(i, t, lang, "s", len(t) if t else 0, "x", 7) for i, t, lang in rows]
    return spark.createDataFrame(data, SCHEMA)


def sentence(rng, n, pool):
    return " ".join(rng.choice(pool) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    pool = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    out = [(i, sentence(rng, rng.randint(1, 150), pool), "en" if i % 2 else "de") for i in range(60)]
    passage = sentence(rng, 70, pool)
    out += [(100 + i, sentence(rng, 30, pool) + " " + passage + "\n" + sentence(rng, 25, pool), "en") for i in range(8)]
    copy = sentence(rng, 120, pool)
    out += [(200 + i, copy if i % 2 else copy + " " + pool[i], "de") for i in range(12)]
    out += [(300, None, "en"), (301, "", "de"), (302, " \t\n ", None), (303, "one", "en"), (304, "a b c", None),
            (305, "x y " * 4000, "en"), (306, "l one\nl one\n\n \nl one", "de"), (307, "ÀÉ ß\x85b\xa0c\x1cd <|endoftext|> 日本 ４", "en"),
            (308, "12 34 -- !!", "en"), (309, "Is'LL don't 'S <|startoftext|>x", "de"), (None, copy, "en"), (None, None, None)]
    out += [(400, sentence(rng, 60, pool), "en")] * 2 + [(401, copy, "en"), (401, passage, "de")]
    return out


def words_of(t):
    return WORD.findall(t or "")


def test_words_equal_the_pattern(rows):
    texts = [t for _, t, _ in rows]
    found = tx.Words(tx.plain(pa.array(texts)))
    vocab = found.vocab.to_pylist()
    for i, t in enumerate(texts):
        assert [vocab[c] for c in found.codes[found.starts[i]:found.starts[i + 1]]] == words_of(t)


def test_slices_cover_all_rows():
    batch = pa.record_batch({"text": ["a" * n for n in (0, 10, 500, 3, 3, 3)]})
    parts = list(tx.slices([batch, batch.slice(0, 0)], "text", limit=8))
    assert sum((p.column("text").to_pylist() for p in parts), []) == batch.column("text").to_pylist()


def brute_fingerprint(t):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    grams = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def union_find(ids, linked):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in linked:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("block", [simhash.BLOCK, 5])
def test_simhash_equals_brute_force(spark, rows, block):
    got = [tuple(r) for r in simhash.near_duplicates(table(spark, rows), block=block).collect()]
    fps = [(i, brute_fingerprint(t)) for i, t, _ in rows]
    ids = {i for i, _ in fps if i is not None}
    known = [(i, f) for i, f in fps if i is not None]
    links = [(a, b) for a, x in known for b, y in known if (x ^ y).bit_count() <= 4]
    component = union_find(ids, links)
    want = [(i, f"{f:016x}", component.get(i)) for i, f in fps]
    assert collections.Counter(got) == collections.Counter(want)


def test_simhash_keeps_one_of_each_group(spark, rows):
    docs = table(spark, rows)
    first = {r[0] for r in simhash.near_duplicates(docs).collect() if r[0] == r[2]}
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert {i for i in ids if i is not None} == {i for i in first if i is not None}
    assert len([i for i in ids if i is not None]) == len(first - {None}) and ids.count(None) == 2


def test_near_pairs_skip_no_pair():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    b = np.concatenate([a[:200] ^ (np.uint64(1) << rng.integers(0, 63, 200, dtype=np.uint64)), rng.integers(0, 1 << 63, 100, dtype=np.uint64)])
    got = {(int(i), int(j)) for x, y in simhash.near_pairs(a, b, 4, tile=16) for i, j in zip(x, y, strict=True)}
    want = {(i, j) for i in range(300) for j in range(300) if (int(a[i]) ^ int(b[j])).bit_count() <= 4}
    assert got == want


def brute_rules(t):
    w = words_of(t)
    lines, seen, dup = (t or "").split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = {j for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), dup, len(hit), len(w) < 10 or 100 * len(hit) > 20 * len(w)


def test_quality_statistics_and_verdict(spark, rows):
    junk = [(500 + i, " ".join(f"{w}$$$" for w in words_of(t)[:60]), "en") for i, t, _ in rows[:15]]
    docs = table(spark, rows + junk)
    good = spark.createDataFrame([(i, 1) for i in range(0, 60, 2)] + [(None, 1), (7, None)], "doc_id long, quality int")
    out = quality_rules.rules(docs, good, keep=["doc_id", "text"]).collect()
    for r in out:
        assert tuple(r)[2:8] == brute_rules(r["text"])
        assert r["kept"] == (not r["base_failed"] and r["llr"] >= quality_rules.THRESHOLD)
    long = [r for r in out if r["n_words"] >= 20 and r["doc_id"] is not None]
    assert not any(r["kept"] for r in long if r["doc_id"] >= 500)
    assert all(r["kept"] or r["base_failed"] for r in long if r["doc_id"] < 60)
    none = quality_rules.rules(docs, good.where("false"), keep=["doc_id"]).agg(F.max(F.abs("llr"))).first()[0]
    assert none == 0


def test_quality_ratio_equals_brute_force(spark, rows):
    docs = table(spark, rows)
    ids = spark.createDataFrame([(1,), (3,)], "doc_id long")
    ratio = quality_rules.fit(docs, ids, buckets=256)
    raw, good = np.ones(256), np.ones(256)
    for i, t, _ in rows:
        codes, starts = quality_rules.gram_buckets(tx.Words(tx.plain(pa.array([t]))), tx.WordHashes(), 256)
        raw += np.bincount(codes, minlength=256)
        if i in (1, 3):
            good += np.bincount(codes, minlength=256)
    assert np.allclose(ratio, np.log(good / good.sum()) - np.log(raw / raw.sum()))


def test_repeated_words_fall_back_exactly(rows):
    words = tx.Words(tx.plain(pa.array([t for _, t, _ in rows])))
    assert quality_rules._repeated_exactly(words, 5).tolist() == quality_rules.repeated_words(words).tolist()


def test_packing_is_an_exact_layout(spark, rows):
    docs = table(spark, rows)
    out = packing.pack(packing.pieces(docs, capacity=64), 64, items_per_task=20).collect()
    library = tk.LibraryIds(tk.read_tokenizer()).tokenizer
    want = collections.Counter()
    for i, t, _ in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), 64)):
            piece = np.array(ids[at:at + 64], dtype="<u4")
            want[i, k, at, len(piece), zlib.crc32(piece.tobytes())] += 1
    assert collections.Counter(tuple(r)[:5] for r in out) == want
    bins = collections.defaultdict(list)
    for r in out:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r["length"] for r in out)
    assert len(bins) <= 1.15 * -(-total // 64) + 2
    # one task packs no better than a few percent beyond the tree
    single = len({r["sequence_id"] for r in packing.pack(packing.pieces(docs, capacity=64), 64).collect()})
    assert len(bins) <= single * 1.05 + 1


def test_packing_of_items_that_never_fit_ends(spark):
    items = spark.range(200).selectExpr("id doc_id", "0 piece", "0L start", "40L length", "1L ids_crc32")
    out = packing.pack(items.withColumn("piece", F.col("piece").cast("int")), 64, items_per_task=10)
    assert out.select("sequence_id").distinct().count() == 200


def test_best_fit_fills_whole_bins():
    bins, offsets = packing.best_fit(np.array([6, 4, 3, 7, 5, 5]), 10)
    assert len(set(bins.tolist())) == 3 and (np.bincount(bins, weights=[6, 4, 3, 7, 5, 5]) == 10).all()


@pytest.mark.parametrize("group", [substring.GROUP, 3])
def test_substring_equals_brute_force(spark, rows, group):
    out = substring.dedup(table(spark, rows), digests=True, group=group).collect()
    first = {}
    for i, t, _ in rows:
        w = words_of(t)
        for k in range(len(w) - 49):
            if i is not None:
                key = tuple(w[k:k + 50])
                first[key] = min(first.get(key, i), i)
    want = collections.Counter()
    for i, t, _ in rows:
        w, gone = words_of(t), set()
        for k in range(len(w) - 49):
            if i is not None and first[tuple(w[k:k + 50])] < i:
                gone.update(range(k, k + 50))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        want[i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    assert collections.Counter(tuple(r) for r in out) == want
    assert sum(r["n_removed"] for r in out) > 1000


def test_substring_as_a_stage_keeps_columns_and_untouched_texts(spark, rows):
    docs = table(spark, rows)
    out = substring.dedup(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    before = {(r["doc_id"], r["text"]) for r in docs.collect()}
    short = [r for r in out.collect() if r["doc_id"] is not None and r["doc_id"] < 60]
    assert all((r["doc_id"], r["text"]) in before for r in short)


def test_tree_nodes_name_equal_sequences():
    codes = np.array([1, 2, 3, 1, 2, 3, 1, 9, 2, 3, 1])
    at, node = substring.tree_nodes(codes, np.array([0, 7, 11]), 3)
    named = {}
    for i, k in zip(at.tolist(), node.tolist(), strict=True):
        named.setdefault(k, set()).add(tuple(codes[i:i + 3].tolist()))
    assert all(len(v) == 1 for v in named.values()) and len(named) == len({x for v in named.values() for x in v})
    assert at.tolist() == [0, 1, 2, 3, 4, 7, 8]


def test_language_profiles_and_edge_cases(spark):
    rng = random.Random(2)
    north = ["".join(rng.choice("snöklw") for _ in range(4)) for _ in range(50)]
    south = ["".join(rng.choice("aeiprt") for _ in range(4)) for _ in range(50)]
    rows = [(i, sentence(rng, 40, north if i % 2 else south), "no" if i % 2 else "so") for i in range(80)]
    rows += [(90, None, "no"), (91, "", "so"), (92, "123 !! --", "so"), (93, "日本語", None), (None, sentence(rng, 40, north), "xx")]
    docs = table(spark, rows)
    profiles = langid.fit(docs)
    assert [n for n, _ in profiles] == ["no", "so"]  # a row without an id trains nothing
    got = {r["doc_id"]: r for r in langid.identify(docs, profiles, keep=["doc_id"]).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang in rows[:80])
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (90, 91, 92))
    assert got[93]["lang_pred"] == "no" and got[93]["score"] == 0  # nothing known: the first by name
    assert all(0 <= r["score"] <= 1 for r in got.values())
    held = {r[0] for r in docs.where(langid.held_out(F.col("doc_id"))).select("doc_id").collect()}
    assert held == {i for i, _, _ in rows if i is not None and zlib.crc32(str(i).encode()) % 3 == 1}
    assert langid.identify(docs, [], keep=["doc_id"]).where("lang_pred != 'und'").count() == 0


def test_language_profile_equals_brute_force(spark):
    docs = table(spark, [(0, "Ab-ba ab", "x"), (4, "abc", "x")]).where(~langid.held_out(F.col("doc_id")))
    counts = collections.Counter()
    for _, text in docs.select("doc_id", "text").collect():
        for run in re.findall(r"[a-z]+", text.lower()):
            s = f"_{run}_"
            counts.update(s[i:i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1) if s[i:i + n] != "_")

    def code(g):
        return sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))

    want = [code(g) for g, _ in sorted(counts.items(), key=lambda x: (-x[1], code(x[0])))]
    fitted = dict(langid.fit(docs))
    assert fitted.get("x", []) == want[:langid.SIZE]


def test_bpe_equals_the_library(spark, rows):
    rng = random.Random(11)
    odd = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzé'’.,!0129-ΑΣσ한") for _ in range(rng.randint(1, 18))) for _ in range(3000)]
    docs = table(spark, [*rows, (999, " ".join(odd), "en"), (1000, "a" * 3000, "en")])
    library = tk.LibraryIds(tk.read_tokenizer()).tokenizer
    for r in bpe.encode(docs, keep=["doc_id", "text"]).collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == ids
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False)
    for r in bpe.encode(docs, keep=["doc_id", "text"], digests=True).collect():
        ids = np.array(library.encode(r["text"] or "", add_special_tokens=False).ids, dtype="<u4")
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())


def test_token_counts_equal_a_plain_program(spark, rows):
    model = token_counts.Unigram(token_counts.read_pieces())

    def plain(word):
        s = token_counts.MARK + word
        best = [(0.0, 0)] + [None] * len(s)
        for end in range(1, len(s) + 1):
            options = [(best[b][0] + model.pieces[s[b:end]], -(-best[b][1] + 1)) for b in range(end) if s[b:end] in model.pieces]
            if s[end - 1] not in model.pieces:
                size = len(s[end - 1].encode())
                options.append((best[end - 1][0] + size * model.byte, -(-best[end - 1][1] + size)))
            top = max(options)
            best[end] = (top[0], top[1])
        return -best[-1][1], best[-1][0]

    out = token_counts.count_tokens(table(spark, rows), keep=["doc_id", "text"], model=model).collect()
    for r in out:
        w = words_of(r["text"])
        counts = [plain(x) for x in set(w)]
        lookup = dict(zip(set(w), counts, strict=True))
        assert r["n_words"] == len(w) and r["n_chars"] == len(r["text"] or "")
        assert r["n_tokens"] == sum(lookup[x][0] for x in w)
        assert abs(r["log_prob"] - sum(lookup[x][1] for x in w)) < 1e-6 * (1 + abs(r["log_prob"]))


def test_unigram_model_equals_plain_viterbi_training(spark, rows):
    names = token_counts.read_pieces()
    counts = collections.Counter(w for r in rows for w in words_of(r[1]))
    whole = sum(1 / (i + 3.7) for i in range(len(names) + 256))
    score = {p: -float(np.log((i + 3.7) * whole)) for i, p in enumerate(names)}
    byte = -float(np.log((len(names) + 258.7) * whole))
    for _ in range(2):
        uses, byte_uses = collections.Counter(), 0
        for word, n in counts.items():
            s = token_counts.MARK + word
            best = [(0.0, 0, [])]
            for end in range(1, len(s) + 1):
                options = [(best[b][0] + score[s[b:end]], best[b][1] - 1, -b, s[b:end]) for b in range(end) if s[b:end] in score]
                if s[end - 1] not in score:
                    size = len(s[end - 1].encode())
                    options.append((best[end - 1][0] + size * byte, best[end - 1][1] - size, 1 - end, size))
                top = max(options, key=lambda o: (round(o[0], 9), *o[1:3]))
                best.append((top[0], top[1], best[-top[2]][2] + [top[3]]))
            for p in best[-1][2]:
                if isinstance(p, int):
                    byte_uses += n * p
                else:
                    uses[p] += n
        total = sum(uses.values()) + 0.1 * len(names) + byte_uses + 25.6
        score = {p: float(np.log((uses[p] + 0.1) / total)) for p in names}
        byte = float(np.log((byte_uses / 256 + 0.1) / total))
    model = token_counts.fit(table(spark, rows).repartition(3))
    assert abs(model.byte - byte) < 1e-9
    assert max(abs(model.pieces[p] - score[p]) for p in names) < 1e-9
    assert abs(np.exp(model.score[:-1]).sum() + 256 * np.exp(model.byte) - 1) < 1e-9


def test_more_training_rounds_raise_the_likelihood(spark, rows):
    docs = table(spark, rows)
    total = [token_counts.count_tokens(docs, keep=["doc_id"], model=token_counts.fit(docs, rounds=k)).agg({"log_prob": "sum"}).first()[0]
             for k in (0, 1, 2)]
    assert total[0] < total[1] <= total[2] + 1e-6


def test_empty_tables(spark):
    docs = table(spark, [(1, "x", "en")]).where("doc_id < 0")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert simhash.near_duplicates(docs).count() == 0
    assert quality_rules.rules(docs, labels).count() == 0
    assert token_counts.count_tokens(docs).count() == 0
    assert packing.pack_documents(docs).count() == 0
    assert substring.dedup(docs, digests=True).count() == 0
    assert langid.identify(docs, langid.fit(docs)).count() == 0
    assert bpe.encode(docs).count() == 0


def test_groups_that_hold_a_share_pack_as_well_as_one(spark):
    """Sizes of which only two fit together: 20 groups of 200 make as few sequences as one of 4,000."""
    rng = np.random.default_rng(3)
    data = [(i if i % 3 else None, 0, 0, int(n), 1) for i, n in enumerate(rng.integers(1500, 2400, 4000))]
    items = spark.createDataFrame(data, "doc_id long, piece int, start long, length long, ids_crc32 long")
    for share in (200, 100_000):
        got = packing.pack(items, items_per_task=share).toPandas()
        assert len(got) == 4000 and got.sequence_id.nunique() == 2000
        for _, g in got.sort_values("offset").groupby("sequence_id"):
            assert g.offset.tolist() == [0, *g.length.cumsum()[:-1]] and g.length.sum() <= 4096


def test_word_ids_are_the_librarys_with_full_and_empty_tables(rows):
    library = tk.LibraryIds(tk.read_tokenizer())
    texts = [t for _, t, _ in rows if t] + ["ÉÀ ïß Ž9 č-č x\u00a0y ﬀ İI Dž ǆ <|endoftext|>a n'T 'LL ''s été's"]
    words = tx.Words(tx.plain(pa.array(texts * 2))).vocab
    for limit in (3, 400_000):
        encode = tk.WordIds(library, limit)
        for part in (words.slice(0, 40), words, words.slice(10)):
            ids, cuts = encode(part)
            for i, w in enumerate(part.to_pylist()):
                assert ids[cuts[i]:cuts[i + 1]].tolist() == library.tokenizer.encode(w, add_special_tokens=False).ids, w
