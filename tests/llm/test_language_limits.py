"""Language scores against a plain restatement; unlearned languages and gibberish leave the pipeline."""

import collections
import random
import re

import pyarrow as pa
import pytest

import corpus_pipeline
from riskloom.llm import langid
from riskloom.llm import text as tx

SF = "/root/testdata/sf0.01"
ODD = {
    "finnish": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, "
               "ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
    "polish": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem "
              "i powinni postępować wobec innych w duchu braterstwa.",
    "turkish": "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı "
               "kardeşlik zihniyeti ile hareket etmelidirler.",
    "cyrillic with a Latin word": "Все люди рождаются свободными и равными в своем достоинстве и правах a",
    "gibberish": " ".join("".join(random.Random(k).choices("abcdefghijklmnopqrstuvwxyz", k=3 + k % 7)) for k in range(150)),
}


def plain_score(profiles, text, size):
    counts = collections.Counter()
    for run in re.findall(r"[^\W\d_]+", text.lower()):
        s = f"_{run}_"
        counts.update(s[i:i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1) if s[i:i + n] != "_")
    own = sorted((-n, sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))) for g, n in counts.items())[:size]
    far = []
    for name, codes in profiles:
        rank = {g: k for k, g in enumerate(codes)}
        far.append((sum(min(size, abs(rank[g] - k)) if g in rank else size for k, (_, g) in enumerate(own)) / len(own) / size, name))
    return min(far)[1], 1 - min(far)[0]


@pytest.mark.parametrize("size", [400, 30])
def test_scores_equal_a_plain_restatement(size, monkeypatch):
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choices(pool, k=rng.randint(1, 6))) for _ in range(rng.randint(1, 90))) for pool in ("abcdeé", "efghü", "яжabc") for _ in range(12)]
    codes, of = langid.grams(["abc", "bead", "edé"])
    other, _ = langid.grams(["fgh", "hüge", "he"])
    profiles = [("a", list(dict.fromkeys(codes.tolist()))[:size]), ("b", list(dict.fromkeys(other.tolist()))[:size])]
    monkeypatch.setattr(langid, "CELLS", 2000)
    names, scores = langid.Profiles(profiles, size).predict(tx.plain(pa.array(texts)))
    for text, name, score in zip(texts, names, scores, strict=True):
        want = plain_score(profiles, text, size)
        assert name == want[0] and abs(score - want[1]) < 1e-12


def test_unlearned_languages_leave_and_learned_ones_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(10**6 + k, t, None, "s", len(t)) for k, t in enumerate(ODD.values())], docs.schema)
    kept = {r[0] for r in corpus_pipeline.language_stage(spark, docs.unionByName(odd), SF).select("doc_id").collect()}
    assert not [name for k, name in enumerate(ODD) if 10**6 + k in kept]
    assert len(kept) >= 0.995 * docs.count()


def test_a_rarely_trained_language_does_not_set_its_own_limit(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rare = spark.createDataFrame([(2 * 10**6, ODD["finnish"], "fi", "s", 0)], docs.schema).where(~langid.held_out(langid.F.col("doc_id")))
    both = docs.unionByName(rare)
    profiles = langid.fit(both)
    least = langid.least_scores(both, profiles)
    assert set(least) == {n for n, _ in profiles} and all(0.3 < x < 0.6 for x in least.values())
