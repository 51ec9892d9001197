"""Running totals in a global order without funnelling all rows into one task.

An unpartitioned window (``Window.orderBy(x)``) moves every row into a single
task. Here every row gets a *bucket* that is monotone in the order key
(quantile boundaries of a numeric key, or a prefix of a uniform hash); each
bucket is summed (one row per bucket), the buckets' prefix offsets are computed
on that small table and joined back, and the running total inside a bucket is
an ordinary window partitioned by bucket. Buckets are deterministic, so every
branch of the plan (and every retried task) sees the same assignment.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 250_000


def count_below(x: Column, arr: Column, size: Column, most: int) -> Column:
    """Number of elements of an ascending array (``size`` of them, at most ``most``) below x, by binary
    search: the expression stays small and takes log2(most) steps. NULL counts none, NaN counts all
    (it sorts above every number)."""
    steps = [1 << i for i in reversed(range(max(1, most).bit_length()))]

    def go(at, s):
        fits = (at + s <= size) & (F.get(arr, at + s - 1) < x)
        return F.when(fits, at + s).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), go)


def boundaries_below(x: Column, bounds: list[float]) -> Column:
    """``count_below`` for boundaries known to the driver."""
    return count_below(x, F.array(*[F.lit(float(b)) for b in bounds]), F.lit(len(bounds)), len(bounds)) if bounds else F.lit(0)


def quantile_bucket(df: DataFrame, col: str, descending: bool = False, buckets: int | None = None,
                    rows_per_bucket: int = ROWS_PER_BUCKET) -> Column:
    """Bucket id monotone in ``col`` under Spark's order (ascending: NULL first, NaN last;
    descending: the reverse). The bucket count follows the data (about ``rows_per_bucket`` rows
    each, no upper limit); boundaries are approximate quantiles of ``col`` (one small
    aggregation, k-1 values brought to the driver). One bucket needs no boundary job."""
    if buckets is None:
        buckets = max(1, -(-df.count() // rows_per_bucket))
    k = int(buckets)
    if k <= 1:
        return F.lit(0)
    probs = [i / k for i in range(1, k)]
    row = df.agg(F.percentile_approx(F.col(col).cast("double"), probs, max(10_000, 4 * k)).alias("b")).first()
    bounds = sorted({float(v) for v in (row["b"] or []) if v is not None and v == v})
    x = F.col(col).cast("double")
    if not descending:
        return boundaries_below(x, bounds)
    found = boundaries_below(-x, sorted(-b for b in bounds))
    return F.when(x.isNull(), F.lit(len(bounds))).when(F.isnan(x), F.lit(0)).otherwise(found)


def hash_bucket(hex_col: str, digits: int = 3) -> Column:
    """Bucket id = leading hex digits of a uniform hex hash (monotone in the hash)."""
    return F.conv(F.substring(F.col(hex_col), 1, digits), 16, 10).cast("int")


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    sums: Sequence[str],
    bucket: Column,
    by: Sequence[str] = (),
    prefix: str = "cum_",
) -> DataFrame:
    """Adds ``cum_<c>`` = sum of ``c`` over rows of the same ``by`` group up to and
    including this row in ``order``. ``bucket`` must be non-decreasing along
    ``order``; ``order`` should be unique."""
    by = list(by)
    b = df.withColumn("_bkt", bucket)
    totals = b.groupBy(*by, "_bkt").agg(*[F.sum(c).alias(f"_tot_{c}") for c in sums])
    before = Window.partitionBy(*by).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "_bkt", *[F.coalesce(F.sum(f"_tot_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in sums]
    )
    within = Window.partitionBy(*by, "_bkt").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = b.join(offsets, [*by, "_bkt"])  # small: broadcast by its size; else a join on the window's own keys
    for c in sums:
        out = out.withColumn(f"{prefix}{c}", F.col(f"_off_{c}") + F.sum(c).over(within))
    return out.drop("_bkt", *[f"_off_{c}" for c in sums])
