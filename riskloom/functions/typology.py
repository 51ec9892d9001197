"""Account typology: additive rule scores normalised to three probabilities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Defaults used when an attribute is absent, and the rule weights.
DEFAULTS = {"age_bucket": 3.0, "occupation": 3.0, "missing_ratio": 0.3, "account_type": 1.0, "opening_dow": 0.0}


def attribute(columns: list[str], column: str | None, name: str) -> Column:
    """The attribute's column, or its default value where the table has no such column."""
    return F.col(column) if column in columns else F.lit(DEFAULTS[name])


def _w(cond: Column, weight: float) -> Column:
    return F.when(cond, F.lit(weight)).otherwise(F.lit(0.0))


def typology_columns(age: Column, occupation: Column, missing: Column, acct_type: Column,
                     dow: Column | None = None) -> dict[str, Column]:
    """``witting`` / ``unwitting`` / ``synthetic`` probabilities rounded to 3 places.
    ``dow`` = opening weekday (Mon=0); the screening variant passes None (no rule)."""
    witting = (_w(age >= 5, 0.3) + _w(occupation <= 2, 0.15) + _w(missing < 0.25, 0.1)
               + _w(acct_type <= 2, 0.1))
    unwitting = _w((age >= 3) & (age <= 4), 0.2) + _w(occupation >= 6, 0.25)
    synthetic = _w(age <= 2, 0.4) + _w(missing > 0.45, 0.3) + _w(acct_type == 8, 0.2)
    if dow is not None:
        synthetic = synthetic + _w(dow == 6, 0.1)
    total = witting + unwitting + synthetic + F.lit(1e-9)
    return {
        "witting": F.bround(witting / total, 3),
        "unwitting": F.bround(unwitting / total, 3),
        "synthetic": F.bround(synthetic / total, 3),
    }


def dominant_col(w: Column, u: Column, s: Column) -> Column:
    """Argmax with the first listed winning ties."""
    return F.when((w >= u) & (w >= s), F.lit("witting")).when(u >= s, F.lit("unwitting")).otherwise(F.lit("synthetic"))
