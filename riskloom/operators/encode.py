"""Categorical encodings: manual ordinal maps, ordinal codes, frequency shares."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.catalog import string_features

# Manual risk orderings of the reference's named columns
# (unknown or missing -> -1) and the cardinality cut between ordinal and frequency.
REFERENCE_MAPPINGS: dict[str, dict[str, int]] = {
    "F3886": {"Savings": 1, "Current": 2, "MSME Micro": 3, "MSME Small": 4,
              "Staff Loans": 5, "SB-NRI(NRE)": 6, "SB-NRI(NRO)": 7, "SB-PMJDY": 8},
    "F3889": {"G365D": 1, "L365D": 2, "L180D": 3, "L90D": 4, "L31D": 5, "L14D": 6, "L7D": 7},
    "F3890": {"R": 1, "M": 2, "U": 3, "SU": 4},
    "F3891": {"salaried": 1, "retired": 2, "agriculture": 3, "housewife": 4,
              "others": 5, "selfemployed": 6, "student": 7},
    "F3892": {"F": 1, "O": 2, "M": 3},
    "F3893": {"RETAIL": 1, "CORPORATE": 2},
    "F2230": {"Sep25": 9, "Oct25": 10, "Nov25": 11, "Dec25": 12},
}
HIGH_CARDINALITY = 50


def manual_code(col: str, mapping: Mapping[str, int]):
    """Map lookup; unknown or NULL -> -1."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(float(v)))])
    return F.coalesce(m[F.col(col)], F.lit(-1.0))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, n_distinct)`` (NULL not counted), one pass over the long form; no rows without columns."""
    if not columns:
        return df.sparkSession.createDataFrame([], "feature string, n_distinct long")
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("v"))
                                for c in columns])).alias("kv")
    long = df.select(pairs).select("kv.feature", "kv.v")
    return long.groupBy("feature").agg(F.count_distinct("v").alias("n_distinct"))


def encode_plan(df: DataFrame, manual: Mapping[str, Mapping[str, int]], columns: Sequence[str] | None = None) -> DataFrame:
    """``(feature, n_distinct, encoding)``: manual if mapped, ordinal if <= 50
    distinct values, frequency otherwise."""
    columns = list(columns or string_features(df))
    nd = distinct_counts(df, columns)
    manual_names = list(manual)
    enc = (F.when(F.col("feature").isin(manual_names), "manual") if manual_names else F.when(F.lit(False), "")) \
        .when(F.col("n_distinct") <= HIGH_CARDINALITY, "ordinal").otherwise("frequency")
    return nd.withColumn("encoding", enc)


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, category, c)`` of all ``columns`` in one grouped count over one scan; NULL is a category."""
    items = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("string").alias("category")) for c in columns])
    return df.select(F.explode(items).alias("e")).groupBy("e.feature", "e.category").agg(F.count(F.lit(1)).alias("c"))


def ordinal_codes(counts: DataFrame) -> DataFrame:
    """``(feature, category, code)``: codes 0.. in sorted order of the text values; a NULL is
    its own category 'nan' (text conversion precedes filling)."""
    cats = counts.select("feature", F.coalesce("category", F.lit("nan")).alias("category")).distinct()
    w = Window.partitionBy("feature").orderBy("category")  # the chooser lets at most 51 categories through
    return cats.withColumn("code", (F.dense_rank().over(w) - 1).cast("double"))


def ordinal_table(df: DataFrame, col: str) -> DataFrame:
    """``(category, code)`` of one column."""
    return ordinal_codes(category_counts(df, [col])).select("category", "code")


def category_shares(counts: DataFrame) -> DataFrame:
    """``(feature, category, share)``: share of the column's non-null rows."""
    held = counts.where(F.col("category").isNotNull())
    total = held.groupBy("feature").agg(F.sum("c").alias("_t"))  # one row a column
    return held.join(F.broadcast(total), "feature").select("feature", "category", (F.col("c") / F.col("_t")).alias("share"))


def frequency_table(df: DataFrame, col: str) -> DataFrame:
    """``(category, share)`` of one column."""
    return category_shares(category_counts(df, [col])).select("category", "share")


def apply_encodings(df: DataFrame, plan_rows: Sequence, manual: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """Replace each planned string column by its numeric code (double), with two passes over ``df`` however
    many columns there are: one counts all categories, one looks all codes up. Ordinal codes are one map of at
    most 51 entries a column, attached to the rows; shares are looked up by one join on (column, value), whose
    hot values adaptive execution splits, and gathered by row."""
    kinds: dict[str, list[str]] = {"manual": [], "ordinal": [], "frequency": []}
    for r in plan_rows:
        kinds[r["encoding"]].append(r["feature"])
    ordinal, frequency = kinds["ordinal"], kinds["frequency"]
    codes = {c: manual_code(c, manual[c]) for c in kinds["manual"]}
    if not ordinal and not frequency:
        return df.withColumns(codes)
    from riskloom.functions.params import attach_params
    from riskloom.session import cut_lineage

    out = df
    counts = cut_lineage(category_counts(df, ordinal + frequency))
    if ordinal:
        entry = F.struct(F.concat_ws("\0", "feature", "category").alias("k"), F.col("code").alias("v"))
        one = ordinal_codes(counts.where(F.col("feature").isin(ordinal))).agg(F.map_from_entries(F.collect_list(entry)).alias("_ordinal"))
        out = attach_params(out, one)
        for c in ordinal:
            key = F.concat_ws("\0", F.lit(c), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("nan")))
            codes[c] = F.coalesce(F.element_at("_ordinal", key), F.lit(-1.0))
    if frequency:
        out = cut_lineage(out.withColumn("_row", F.monotonically_increasing_id()))  # the row numbers are read twice
        items = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("string").alias("category")) for c in frequency])
        long = out.select("_row", F.explode(items).alias("e")).select("_row", "e.feature", "e.category").where(F.col("category").isNotNull())
        shares = category_shares(counts.where(F.col("feature").isin(frequency)))
        found = long.join(shares, ["feature", "category"]).groupBy("_row").agg(
            F.map_from_entries(F.collect_list(F.struct("feature", "share"))).alias("_shares"))  # an entry a column
        out = out.join(found, "_row", "left")
        codes |= {c: F.coalesce(F.element_at("_shares", F.lit(c)), F.lit(0.0)) for c in frequency}
    return out.withColumns(codes).select(*[F.col(f"`{c}`") for c in df.columns])
