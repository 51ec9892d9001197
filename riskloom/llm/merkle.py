"""Merkle manifest of a table: leaves by source, one tree a source, one tree over the sources.

A leaf is the SHA-256 of a row's fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and its
value. Leaves of a source ascend by id; runs of ``arity`` neighbours become a parent until one node, the
subroot, is left; subroots in order of source (null first) make the root in the same way. A parent's
digest is the SHA-256 of its children's digests as lowercase hex.

Every level is one sibling-shift self-join: a node's slot is its index modulo the arity, the indices of
its siblings are computed (exclusive-or for two, slot offsets otherwise), and nodes equijoin nodes on
(source, index). Each row then holds its siblings, and rows of slot zero emit the parents. Going down
again, each node joins its parent's path, so a leaf ends with the siblings of all levels in a row: the
proof, which is hashed and folded without a shuffle. All sources climb together, one job a level.

Positions come from a range sort by (source, id): a partition's rows number themselves, and the counts
by (partition, source) give the offsets, so a source that holds most rows is spread over all tasks.

Defined results: a null id sorts first and is never tampered with; rows with equal id sort by digest,
and equal rows each have a leaf; null fields and texts are ``-``; an empty table gives no rows; columns
that aren't named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import cut_lineage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "array<struct<before:binary,after:binary>>"


def _sha(x: Column) -> Column:
    return F.unhex(F.sha2(x, 256))


def _hex(x: Column) -> Column:
    return F.lower(F.hex(x))


def field_text(value: Column) -> Column:
    """``-`` for null, else byte count, ``:`` and value."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    return _sha(F.concat(*[field_text(f) for f in fields]))


def numbered(rows: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, int]:
    """``rows`` with idx (from 0, by ``order`` in the group) and n (rows of the group); and the largest n."""
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    ranged = cut_lineage(ranged.withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33)  # the partition's number; a row's place in it is in the lower bits
    counts = ranged.groupBy(part.alias("__part"), F.col(group).alias("__g")).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__c"))
    whole = Window.partitionBy("__g")
    before = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut_lineage(counts.select("__part", "__g", "__first", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__before"),
                                       F.sum("__c").over(whole).alias("n")))
    most = counts.agg(F.max("n")).first()[0] or 0
    same = (part == F.col("__part")) & F.col(group).eqNullSafe(F.col("__g"))
    out = ranged.join(counts, same).withColumn("idx", F.col("__before") + F.col("__at") - F.col("__first"))
    return out.select(*rows.columns, "idx", "n"), most


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes (g, idx, n, digest, ...) with ``before`` and ``after``: the digests of their run's other
    nodes to the left and to the right, joined."""
    slot = F.col("idx") % arity
    out, names = nodes, []
    for o in range(1, arity):
        other = F.col("idx").bitwiseXOR(1) if arity == 2 else F.col("idx") - slot + (slot + o) % arity
        right = nodes.select(F.col("g").alias(f"__g{o}"), F.col("idx").alias(f"__i{o}"), F.col("digest").alias(f"__d{o}"))
        out = out.withColumn("__other", other).join(
            right, F.col("g").eqNullSafe(F.col(f"__g{o}")) & (F.col("__other") == F.col(f"__i{o}")), "left").drop("__other", f"__g{o}", f"__i{o}")
        names.append(f"__d{o}")
    run = F.array("digest", *names)
    none = F.lit(b"")

    def joined(side) -> Column:
        return F.concat(*[F.coalesce(F.when(side(p), F.get(run, ((F.lit(p + arity) - slot) % arity).cast("int"))), none) for p in range(arity)])

    return out.withColumns({"before": joined(lambda p: F.lit(p) < slot), "after": joined(lambda p: F.lit(p) > slot)}).drop(*names)


def climb(nodes: DataFrame, most: int, arity: int) -> tuple[list[DataFrame], DataFrame]:
    """(levels with siblings from the leaves up, tops): a top (g, digest, height) is the last node of each g
    and the number of levels below it."""
    levels, level = [], nodes
    tops = nodes.where("n = 1").select("g", "digest", F.lit(0).alias("height"))
    while most > 1:
        level = cut_lineage(with_siblings(level.where("n > 1"), arity))
        levels.append(level)
        parent = _sha(_hex(F.concat("digest", "after")))
        level = level.where(F.col("idx") % arity == 0).select(
            "g", F.expr(f"idx div {arity}").alias("idx"), F.ceil(F.col("n") / arity).cast("bigint").alias("n"), parent.alias("digest"))
        tops = tops.union(level.where("n = 1").select("g", "digest", F.lit(len(levels)).alias("height")))
        most = -(-most // arity)
    return levels, tops


def descend(levels: list[DataFrame], nodes: DataFrame, tops: DataFrame, arity: int, carry: list[str]) -> DataFrame:
    """(g, idx, digest, carry..., top, path) of the leaves. ``tops`` has (g, height, top, above): what the
    leaves of g inherit. ``path`` lists (before, after) from the leaf up, then ``above``."""
    down = None
    for k in reversed(range(len(levels))):
        parents = tops.where(F.col("height") == k + 1).select(  # trees whose last node stands just above
            F.col("g").alias("__g"), F.lit(0).cast("bigint").alias("__i"), F.col("top").alias("__top"), F.col("above").alias("__above"))
        if down is not None:
            parents = parents.union(down.select("g", "idx", "top", "path"))
        up = (F.col("g").eqNullSafe(F.col("__g"))) & (F.col("__up") == F.col("__i"))
        held = levels[k].withColumn("__up", F.expr(f"idx div {arity}")).join(parents, up)
        path = F.concat(F.array(F.struct("before", "after")), "__above").alias("path")
        down = held.select("g", "idx", "digest", *(carry if k == 0 else []), F.col("__top").alias("top"), path)
    lone = tops.where("height = 0").select(F.col("g").alias("__g"), "top", "above")
    short = nodes.where("n = 1").join(lone, F.col("g").eqNullSafe(F.col("__g"))).select(
        "g", "idx", "digest", *carry, "top", F.col("above").alias("path"))
    return short if down is None else down.union(short)


def manifest(docs: DataFrame, *, doc_id: str = "doc_id", source: str = "source", fields: tuple[str, ...] = FIELDS,
             arity: int = 3, tampered: tuple[dict[str, Column], Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: (doc_id, leaf, subroot, root, path, told): digests are binary, ``path`` is
    the proof. ``tampered`` is (changed fields, condition): ``told`` is the leaf of the changed fields where
    the condition holds, else null."""
    cols = {f: F.col(f"`{f}`") for f in fields}
    told = F.lit(None).cast("binary")
    if tampered:
        changed, when = tampered
        told = F.when(when, leaf_digest([changed.get(f, cols[f]) for f in fields]))
    rows = cut_lineage(docs.select(F.col(f"`{source}`").alias("g"), F.col(f"`{doc_id}`").alias("doc_id"),
                                   leaf_digest(list(cols.values())).alias("digest"), told.alias("told")))
    leaves, most = numbered(rows.withColumn("__r", F.monotonically_increasing_id()), "g", ["doc_id", "digest", "__r"])
    leaves = cut_lineage(leaves.drop("__r"))
    levels, subroots = climb(leaves, most, arity)
    over = cut_lineage(subroots).select(F.lit(0).alias("g"), F.col("g").alias("source"), "digest", F.col("height").alias("below"))
    over, many = numbered(over, "g", ["source"])
    over = cut_lineage(over)
    upper, root = climb(over, many, arity)
    root = cut_lineage(root.select("g", "height", F.col("digest").alias("top"), F.array().cast(STEP).alias("above")))
    proofs = descend(upper, over, root, arity, ["source", "below"])
    tops = cut_lineage(proofs.select(F.col("source").alias("g"), F.col("below").alias("height"),
                                     F.struct(F.col("digest").alias("subroot"), F.col("top").alias("root")).alias("top"), F.col("path").alias("above")))
    out = descend(levels, leaves, tops, arity, ["doc_id", "told"])
    return out.select("doc_id", F.col("digest").alias("leaf"), "top.subroot", "top.root", "path", "told")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(path, leaf, lambda acc, x: _sha(_hex(F.concat(x["before"], acc, x["after"]))))


def proof_sha256(path: Column) -> Column:
    """Hex digest of the proof's siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda x: _hex(F.concat(x["before"], x["after"]))), ""), 256)


def audit(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """The manifest in hex, and whether each row folds to the root after half of the rows (an even CRC-32 of
    the id) lost the line feeds of their text."""
    body = F.col(f"`{text}`")
    hit = (F.crc32(F.col(f"`{doc_id}`").cast("string")) % 2 == 0) & F.contains(body, F.lit("\n"))
    m = manifest(docs, doc_id=doc_id, tampered=({text: F.translate(body, "\n", "")}, hit), **options)
    out = m.select("doc_id", *[_hex(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")], proof_sha256(F.col("path")).alias("proof_sha256"),
                   _hex(fold(F.coalesce("told", "leaf"), F.col("path"))).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
