"""Labels of any type, clashing names, rows of one id with several texts, copies in a labelled sample."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskloom.llm import embed_dedup, quality_model, simhash, substring, toxicity


@pytest.mark.parametrize("kind, values", [("string", ["a", "b", None]), ("bigint", [2 ** 40, 2 ** 40 + 1, None]), ("double", [1.2, 1.7, None])])
def test_only_equal_labels_link_whatever_their_type(spark, kind, values):
    rng = np.random.default_rng(1)
    base = rng.normal(size=8)
    rows = [(i, [float(x) for x in base + 0.01 * rng.normal(size=8)], values[i % 3]) for i in range(30)]
    got = {r["vec_id"]: r for r in embed_dedup.near_duplicates(spark.createDataFrame(rows, f"vec_id long, embedding array<float>, label {kind}")).collect()}
    for i in range(30):
        assert got[i]["component_id"] == (i if i % 3 == 2 else i % 3) and got[i]["n_links"] == (0 if i % 3 == 2 else 9)


def test_minus_zero_labels_and_empty_vectors_table(spark):
    rows = [(1, [1.0, 0.0], 0.0), (2, [1.0, 0.0], -0.0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label double")
    assert {r["component_id"] for r in embed_dedup.near_duplicates(df).collect()} == {1}
    assert embed_dedup.near_duplicates(df.where("false")).count() == 0


WORDS = [f"w{i}" for i in range(300)]


def test_columns_with_the_names_of_own_columns(spark):
    rng = np.random.default_rng(2)
    text = " ".join(rng.choice(WORDS, 120))
    rows = [(i, text if i < 3 else " ".join(rng.choice(WORDS, 80)), "k", i, "x", 3, 1.5, "z") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __id string, __rk long, __rk2 string, __spans int, __score double, `__lang_pred` string")
    got = {r["doc_id"]: r for r in substring.dedup(docs).collect()}
    assert got[0]["text"] == text and got[1]["text"] == "" and got[2]["text"] == ""
    assert all(tuple(got[i])[2:] == rows[i][2:] for i in range(8))
    kept = simhash.keep_first(docs, shingle=4, radius=4)
    assert kept.columns == docs.columns and {r["doc_id"]: tuple(r) for r in kept.collect()} == {i: rows[i] for i in (0, 3, 4, 5, 6, 7)}


def test_of_rows_with_one_id_the_smallest_text_stays(spark):
    rng = np.random.default_rng(3)
    texts = sorted(" ".join(rng.choice(WORDS, 60)) for _ in range(4))
    for order in (texts, texts[::-1]):
        docs = spark.createDataFrame([(1, t, "s") for t in order] + [(None, "x", "s"), (None, "x", "t")], "doc_id long, text string, source string").repartition(3)
        got = simhash.keep_first(docs, shingle=4, radius=4).collect()
        assert collections.Counter(map(tuple, got)) == {(1, texts[0], "s"): 1, (None, "x", "s"): 1, (None, "x", "t"): 1}


def test_copies_of_a_labelled_sample_go_and_shared_passages_stay(spark):
    rng = np.random.default_rng(4)
    passage = " ".join(rng.choice(WORDS, 40))
    rows = [(i, passage + " " + " ".join(rng.choice(WORDS, 60)), i % 2) for i in range(40)]
    rows += [(100 + i, rows[0][1] + f" end{i}", 0) for i in range(5)] + [(200, rows[0][1], 1), (300, "", 0), (301, "", 0), (302, None, 1)]
    sample = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = collections.Counter(map(tuple, toxicity.without_copies(sample).collect()))
    assert got == collections.Counter((t, y) for _, t, y in rows[:40] + rows[45:])


def test_training_and_scoring_count_the_same_features(spark):
    """Texts without any repeated word train on what they hold, not as empty rows."""
    rng = np.random.default_rng(5)
    good, bad = [f"{a}{b}" for a in "abcdefgh" for b in "aeiou"], [f"|{i}|#" for i in range(40)]
    rows = [(i, " ".join(rng.permutation(good if i % 2 else bad)[:14])) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = quality_model.fit(docs)
    assert np.count_nonzero(model.weights) > 0
    small = quality_model.fit(docs, max_bytes=2000)
    got = {r["doc_id"]: r["score"] for r in quality_model.classify(docs, model).collect()}
    assert np.mean([got[i] for i in range(1, 300, 2)]) > np.mean([got[i] for i in range(0, 300, 2)]) + 0.3
    assert small.labels is not None


def test_pipeline_stages_of_an_empty_table_and_of_clashing_names(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = docs.withColumns({"__score": F.lit("k"), "__lang_pred": F.lit(7), "__kept": F.lit(None).cast("int"), "___x": F.lit(1)})
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, extra, sf)
        assert out.columns == extra.columns, name
        assert out.where("__score != 'k' or __lang_pred != 7 or __kept is not null").count() == 0
        assert 0 < out.count() <= docs.count()
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), sf).count() == 0, name
