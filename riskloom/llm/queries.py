"""Registered queries of the package: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import (
    bpe,
    embed_dedup,
    exact_dedup,
    langid,
    lexical,
    merkle,
    packing,
    quality_model,
    quality_rules,
    simhash,
    substring,
    token_counts,
    toxicity,
)
from riskloom.sources.tables import read_table

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def deco(fn):
        LLM_QUERIES[key] = fn
        if sql is not None:
            LLM_ORACLE[key] = sql
        return fn

    return deco


@query("op2_simhash_near_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


@query("op5_best_fit_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


@query("op8_bpe_codec")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(read_table(spark, sf_dir, "documents"), keep=["doc_id"], digests=True)


@query("op3_quality_rules")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return quality_rules.rules(docs, labels, keep=["doc_id"])


@query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.fit(docs), keep=["doc_id"])
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


OP6_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
     p AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
     win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS k FROM p WHERE i + 49 <= len(ws)),
     least AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
     hit AS (SELECT doc_id, i FROM win JOIN least USING (k) WHERE doc_id > m),
     gone AS (SELECT DISTINCT doc_id, i + j AS i FROM hit, range(50) r(j)),
     kept AS (SELECT p.doc_id, string_agg(ws[i], ' ' ORDER BY i) AS t, count(*) AS n FROM p ANTI JOIN gone USING (doc_id, i) GROUP BY p.doc_id)
SELECT w.doc_id, len(w.ws) AS n_words, len(w.ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


@query("op6_substring_dedup", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup(read_table(spark, sf_dir, "documents"), digests=True)


OP1_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
     e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
           WHERE list_cosine_similarity(a.x, b.x) >= 0.93),
     reach AS (SELECT vec_id AS id, vec_id AS r FROM v UNION SELECT reach.id, e.b FROM reach JOIN e ON reach.r = e.a),
     comp AS (SELECT id, min(r) AS component_id FROM reach GROUP BY id),
     n AS (SELECT a, count(*) AS n_links FROM e GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN comp ON vec_id = id LEFT JOIN n ON vec_id = a
"""


@query("op1_embedding_near_dedup", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


@query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), keep=["doc_id"])


@query("op9_quality_classifier")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality_model.classify(docs, quality_model.fit(docs), keep=["doc_id"])


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    scored = toxicity.score(docs, toxicity.fit(docs, labels), keep=["doc_id"])
    return scored.select("doc_id", langid.held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", "predicted")


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
     b AS (SELECT DISTINCT item_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM benchmark),
     q AS (SELECT item_id, t, count(*) AS q FROM (SELECT item_id, unnest(ts) AS t FROM b) GROUP BY ALL),
     nl AS (SELECT count(*) FILTER (len(ts) > 0) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS l FROM d),
     tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
     w AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, nl GROUP BY t, n_docs),
     m AS (SELECT r, doc_id, 100 - 25 + (25 * len(ts) * n_docs) // l AS m FROM d, nl),
     part AS (SELECT r, t, w * ((1000000000 * tf) // (1000 * tf + 12 * m)) AS s FROM tf JOIN w USING (t) JOIN m USING (r)),
     score AS (SELECT item_id, r, CAST(sum(q * s) AS BIGINT) AS score FROM part JOIN q USING (t) GROUP BY ALL),
     ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
                FROM score JOIN m USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""


@query("op11_ranked_search", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP12_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
     g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
"""


@query("op12_exact_dedup", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.equal_classes(read_table(spark, sf_dir, "documents"))


_LEAF = " || ".join(f"coalesce(octet_length(encode({c})) || ':' || {c}, '-')" for c in
                    ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", "(TEXT)"))
#: CRC-32 by its bits: the byte's table entry is the polynomial folded eight times.
_CRC = "list_reduce([4294967295] || [ord(c) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')], lambda a, c: xor(a >> 8, tab[(xor(a, c) & 255) + 1]))"
OP13_SQL = f"""
WITH RECURSIVE
     bits AS (SELECT i, list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END) AS v
              FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256))),
     crc AS (SELECT list(v ORDER BY i) AS tab FROM bits),
     leaf AS (SELECT doc_id, source, sha256({_LEAF.replace("(TEXT)", "text")}) AS leaf,
                     CASE WHEN xor({_CRC}, 4294967295) % 2 = 0 THEN sha256({_LEAF.replace("(TEXT)", "replace(text, chr(10), '')")}) END AS told FROM documents, crc),
     pos AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n FROM leaf),
     node AS (SELECT 0 AS k, source, idx, n, leaf AS d FROM pos
              UNION ALL
              SELECT k + 1, source, idx // 3, (any_value(n) + 2) // 3, sha256(string_agg(d, '' ORDER BY idx)) FROM node WHERE n > 1 GROUP BY k, source, idx // 3),
     sub AS (SELECT source, k AS height, d AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM node WHERE n = 1),
     top AS (SELECT 0 AS k, idx, n, subroot AS d FROM sub
             UNION ALL
             SELECT k + 1, idx // 3, (any_value(n) + 2) // 3, sha256(string_agg(d, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY k, idx // 3),
     root AS (SELECT d AS root FROM top WHERE n = 1),
     step AS (SELECT a.source, a.k, a.idx, coalesce(string_agg(b.d, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS before,
                     coalesce(string_agg(b.d, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS after
              FROM node a JOIN node b ON a.k = b.k AND a.source IS NOT DISTINCT FROM b.source AND a.idx // 3 = b.idx // 3 WHERE a.n > 1 GROUP BY ALL),
     above AS (SELECT a.k, a.idx, coalesce(string_agg(b.d, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS before,
                      coalesce(string_agg(b.d, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS after
               FROM top a JOIN top b ON a.k = b.k AND a.idx // 3 = b.idx // 3 WHERE a.n > 1 GROUP BY ALL),
     walk AS (SELECT doc_id, pos.source, pos.idx AS place, 0 AS k, coalesce(told, leaf) AS d, '' AS proof FROM pos
              UNION ALL
              SELECT doc_id, walk.source, place, walk.k + 1,
                     sha256(CASE WHEN walk.k < height THEN step.before || d || step.after ELSE above.before || d || above.after END),
                     proof || CASE WHEN walk.k < height THEN step.before || step.after ELSE above.before || above.after END
              FROM walk JOIN sub ON walk.source IS NOT DISTINCT FROM sub.source
              LEFT JOIN step ON step.source IS NOT DISTINCT FROM walk.source AND step.k = walk.k
                   AND step.idx = place // CAST(pow(3, walk.k) AS BIGINT)
              LEFT JOIN above ON above.k = walk.k - height AND above.idx = sub.idx // CAST(pow(3, greatest(walk.k - height, 0)) AS BIGINT)
              WHERE (walk.k < height AND step.k IS NOT NULL) OR (walk.k >= height AND above.k IS NOT NULL)),
     done AS (SELECT DISTINCT ON (source, place) doc_id, source, place, d AS folded_root, sha256(proof) AS proof_sha256 FROM walk ORDER BY k DESC)
SELECT pos.doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM pos JOIN done ON pos.source IS NOT DISTINCT FROM done.source AND pos.idx = place JOIN sub ON pos.source IS NOT DISTINCT FROM sub.source, root
"""


@query("op13_merkle_manifest", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(read_table(spark, sf_dir, "documents"))
