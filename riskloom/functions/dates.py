"""Opening-date parsing and the temporal features derived from it."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date format (month-day-year, padded or not), earliest
# valid date, and the right-closed age buckets in days -> 0..6 (null -> -1).
DATE_FORMAT = "M-d-yyyy"
MIN_VALID = _dt.date(1950, 1, 1)
AGE_EDGES = (7, 30, 90, 365, 730, 1825)
NEW_ACCOUNT_DAYS = 90


def parse_open_date(s: Column | str, ref_date: _dt.date) -> Column:
    """Date or NULL: unparseable or outside [1950-01-01, ref_date] gives NULL."""
    c = F.col(s) if isinstance(s, str) else s
    d = F.try_to_date(c, DATE_FORMAT)
    return F.when(d.between(F.lit(MIN_VALID), F.lit(ref_date)), d)


def age_bucket(age: Column) -> Column:
    """Right-closed buckets (-1,7], (7,30], ... (1825, inf) -> 0..6; NULL -> -1."""
    out = None
    for i, edge in enumerate(AGE_EDGES):
        cond = age <= edge
        out = F.when(cond, F.lit(i)) if out is None else out.when(cond, F.lit(i))
    out = out.otherwise(F.lit(len(AGE_EDGES)))
    return F.when(age.isNull() | (age <= -1), F.lit(-1)).otherwise(out).cast("double")


def temporal_columns(date: Column, ref_date: _dt.date) -> dict[str, Column]:
    """The six temporal features of an opening date (NULL-safe defaults)."""
    age = F.datediff(F.lit(ref_date), date)
    return {
        "feat_account_age_days": F.coalesce(age, F.lit(-1)).cast("double"),
        "feat_account_age_bucket": age_bucket(age),
        "feat_opening_month": F.coalesce(F.month(date), F.lit(0)).cast("double"),
        "feat_opening_dow": F.coalesce(F.weekday(date), F.lit(-1)).cast("double"),
        "feat_opening_year": F.coalesce(F.year(date), F.lit(0)).cast("double"),
        "feat_is_new_account": F.coalesce((age < NEW_ACCOUNT_DAYS).cast("int"), F.lit(0)).cast("double"),
    }
