"""The corpus pipeline: each stage works on the documents that the stage before it kept.

Every stage calls one operator of ``riskloom.llm``; its result is written as Parquet in the shared
checkpoint folder and read again as the next stage's documents. All but the last stage return the
columns of ``documents``, whatever other columns they have.

Defined results: a null or empty text has no letter and goes in the first stage; rows without an id are
judged like others and stay apart in the third; of rows with one id the third stage keeps one; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import langid, packing, quality_rules, simhash, substring
from riskloom.llm import text as tx
from riskloom.session import cut_lineage
from riskloom.sources.tables import read_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rank-order profiles; texts without a letter or below the least score of the language found go."""
    profiles = langid.fit(docs)
    least = langid.least_scores(docs, profiles)
    p = tx.unused(docs.columns)
    found = langid.identify(docs, profiles, prefix=p)
    if not least:
        return found.where("false").select(docs.columns)
    limit = F.element_at(F.create_map(*[F.lit(x) for pair in least.items() for x in pair]), F.col(f"{p}lang_pred"))
    return found.where((F.col(f"{p}lang_pred") != "und") & (F.col(f"{p}score") >= limit)).select(docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Base rules and the hashed n-gram ratio; documents that are not kept go."""
    p = tx.unused(docs.columns)
    judged = quality_rules.rules(docs, read_table(spark, sf_dir, "labels"), prefix=p)
    return judged.where(F.col(f"{p}kept")).select(docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash over 4-word shingles, at most 4 differing bits: one document of each group stays."""
    return simhash.keep_first(docs, shingle=4, radius=4)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of 50-word windows that start in a document with a smaller id are cut from the text."""
    out = substring.dedup(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing into sequences of 4096 tokens: one row per piece."""
    return packing.pack_documents(docs, capacity=4096)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_stage),
    ("quality_rules", quality_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("substring_dedup", substring_stage),
    ("best_fit_packing", packing_stage),
]

#: Not expressible in SQL (learned models, tokenizer); tests hold it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut_lineage(docs)
    return docs
