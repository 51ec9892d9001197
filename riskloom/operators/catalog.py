"""Feature catalog and the long ``(account_id, y, feature, value)`` form.

Statistics over many columns run on the long form: one explode inside the scan
stage, then a ``groupBy(feature)`` whose partial aggregation leaves one row per
feature per task, so the shuffle is (tasks x features) rows whatever the row count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.DecimalType)

# Column-family prefixes of derived features.
FAMILIES = (
    ("miss_flag_", "miss_flag"), ("meta_", "meta"), ("feat_", "temporal"), ("beh_", "behaviour"),
    ("int_", "interaction"), ("ratio_", "ratio"), ("zflag_", "zflag"), ("z_", "zscore"),
    ("iforest_", "iforest"), ("ae_", "recon"),
)


def family_of(name: str) -> str:
    for prefix, fam in FAMILIES:
        if name.startswith(prefix):
            return fam
    return "raw"


def catalog(df: DataFrame, exclude: Sequence[str] = ("account_id", "y")) -> list[tuple[int, str, str, str]]:
    """``(pos, name, family, kind)`` for every feature column, from the schema only."""
    out = []
    for pos, f in enumerate(c for c in df.schema.fields if c.name not in exclude):
        kind = "num" if isinstance(f.dataType, NUMERIC) else "str"
        out.append((pos, f.name, family_of(f.name), kind))
    return out


def catalog_df(df: DataFrame, exclude: Sequence[str] = ("account_id", "y")) -> DataFrame:
    return df.sparkSession.createDataFrame(
        catalog(df, exclude), "pos int, feature string, family string, kind string"
    )


def numeric_features(df: DataFrame, exclude: Sequence[str] = ("account_id", "y")) -> list[str]:
    return [n for _, n, _, k in catalog(df, exclude) if k == "num"]


def string_features(df: DataFrame, exclude: Sequence[str] = ("account_id", "y")) -> list[str]:
    return [n for _, n, _, k in catalog(df, exclude) if k == "str"]


def to_long(df: DataFrame, features: Sequence[str], id_col: str = "account_id", label: str | None = "y",
            value_type: str = "double") -> DataFrame:
    """``(id, [y,] feature, value)`` with one row per account and feature (nulls kept)."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast(value_type).alias("value")) for f in features
    ])).alias("kv")
    keep = [c for c in (id_col, label) if c and c in df.columns]
    return df.select(*keep, pairs).select(*keep, "kv.feature", "kv.value")


def null_long(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, is_null)`` for every cell of every listed column (any type)."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).isNull().alias("is_null")) for f in features
    ])).alias("kv")
    return df.select(pairs).select("kv.feature", "kv.is_null")
