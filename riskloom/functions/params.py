"""Attaching small fitted parameter tables to data rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_params(df: DataFrame, params: DataFrame) -> DataFrame:
    """Append the columns of a one-row parameter table to every row of ``df``.

    The parameter table has a fixed size (one row), so it is broadcast and the
    join is a map-side lookup on a constant key.
    """
    key = "_param_key"
    left = df.withColumn(key, F.lit(1))
    right = F.broadcast(params.withColumn(key, F.lit(1)))
    return left.join(right, key).drop(key)
