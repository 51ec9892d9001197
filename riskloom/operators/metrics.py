"""Classification metrics on ``scored(by..., y, prob)``.

Every metric is computed from one aggregation to distinct scores (positives and
negatives per score) followed by running totals in score order; the threshold
search works on at most 201 grid cells per group. ``by`` groups (folds, members)
must be few.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.cumulative import quantile_bucket, running_totals

# Threshold grid = 200 evenly spaced points from 0.01 to 0.99 (ends
# included), prediction is prob >= t, F-beta with beta = 2, precision floor 0.5 for
# recall@precision, default threshold 0.5 when no grid point predicts anything.
GRID_START = 0.01
GRID_STOP = 0.99
GRID_N = 200
GRID_STEP = (GRID_STOP - GRID_START) / (GRID_N - 1)
DEFAULT_THRESHOLD = 0.5
BETA = 2.0


def grid_value(j):
    """Grid point j (Column or int) exactly as an evenly spaced grid computes it."""
    if isinstance(j, int):
        return GRID_STOP if j == GRID_N - 1 else j * GRID_STEP + GRID_START
    return F.when(j == GRID_N - 1, F.lit(GRID_STOP)).otherwise(j * F.lit(GRID_STEP) + F.lit(GRID_START))


def _grid_index(prob):
    """Number of grid points <= prob (0..200), exact at the boundaries."""
    c = F.least(F.greatest(F.floor((prob - F.lit(GRID_START)) / F.lit(GRID_STEP)) + 1, F.lit(0)), F.lit(GRID_N))
    c = F.when((c < GRID_N) & (grid_value(c) <= prob), c + 1).otherwise(c)
    c = F.when((c > 0) & (grid_value(c - 1) > prob), c - 1).otherwise(c)
    return c.cast("int")


def f_beta(tp, fp, fn, beta: float = BETA):
    b2 = beta * beta
    num = (1.0 + b2) * tp
    den = (1.0 + b2) * tp + b2 * fn + fp
    return F.coalesce(F.try_divide(num, den), F.lit(0.0))


def score_curve(scored: DataFrame, prob: str = "prob", by: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """One row per (group, distinct score), highest first: pos, neg, tp/fp at
    threshold = score, group totals n_pos / n_neg, precision and recall. Rows whose
    score is NULL or NaN have no place on a curve and are left out of it and of its totals."""
    from riskloom.session import cut_lineage

    by = list(by)
    counts = scored.where(F.col(prob).isNotNull() & ~F.isnan(prob)).groupBy(*by, F.col(prob).alias("score")).agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") != 1).alias("neg")
    )
    counts = cut_lineage(counts)  # counted, bucketed, summed and read: one row per distinct score
    bucket = quantile_bucket(counts, "score", descending=True, buckets=buckets)
    run = running_totals(counts, [F.col("score").desc()], ["pos", "neg"], bucket, by=by)
    totals = counts.groupBy(*by).agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    joined = run.join(F.broadcast(totals), by) if by else _attach(run, totals)
    return joined.select(
        *by, "score", "pos", "neg",
        F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"), "n_pos", "n_neg",
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        F.coalesce(F.try_divide(F.col("cum_pos"), F.col("n_pos")), F.lit(1.0)).alias("recall"),
    )


def _attach(df, one_row):
    from riskloom.functions.params import attach_params

    return attach_params(df, one_row)


def pr_curve(scored: DataFrame, prob: str = "prob", by: Sequence[str] = (), curve: DataFrame | None = None) -> DataFrame:
    """Precision / recall at every distinct score plus the terminal (1, 0) point."""
    by = list(by)
    curve = (curve if curve is not None else score_curve(scored, prob, by)).select(*by, F.col("score").alias("threshold"), "precision", "recall")
    groups = scored.select(*by).distinct() if by else scored.sparkSession.range(1).select()
    terminal = groups.select(*by, F.lit(None).cast("double").alias("threshold"),
                             F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return curve.unionByName(terminal)


def average_precision(scored: DataFrame, prob: str = "prob", by: Sequence[str] = (),
                      curve: DataFrame | None = None) -> DataFrame:
    """AP = sum over distinct scores of (recall step) x precision."""
    by = list(by)
    c = curve if curve is not None else score_curve(scored, prob, by)
    return c.groupBy(*by).agg(
        F.coalesce(F.sum(F.try_divide(F.col("pos"), F.col("n_pos")) * F.col("precision")), F.lit(0.0))
        .alias("average_precision")
    )


def roc_auc(scored: DataFrame, prob: str = "prob", by: Sequence[str] = (), curve: DataFrame | None = None) -> DataFrame:
    """Mann-Whitney form with ties counted half: equals the trapezoidal ROC area."""
    by = list(by)
    c = curve if curve is not None else score_curve(scored, prob, by)
    wins = F.col("pos") * ((F.col("n_neg") - F.col("fp")) + 0.5 * F.col("neg"))
    return c.groupBy(*by).agg(
        F.try_divide(F.sum(wins), F.first("n_pos") * F.first("n_neg")).alias("roc_auc")
    )


def recall_at_precision(scored: DataFrame, prob: str = "prob", by: Sequence[str] = (),
                        min_precision: float = 0.5, curve: DataFrame | None = None) -> DataFrame:
    by = list(by)
    c = pr_curve(scored, prob, by, curve)
    return c.groupBy(*by).agg(
        F.coalesce(F.max(F.when(F.col("precision") >= min_precision, F.col("recall"))), F.lit(0.0))
        .alias("recall_at_precision")
    )


def threshold_table(scored: DataFrame, prob: str = "prob", by: Sequence[str] = ()) -> DataFrame:
    """tp / fp / fn / tn and F-beta at each of the 200 grid thresholds per group.

    Each row lands in one grid cell (number of grid points <= prob); counts per cell
    are at most 201 rows per group, so the suffix sums run on a tiny table.
    """
    by = list(by)
    cells = scored.groupBy(*by, _grid_index(F.col(prob)).alias("cell")).agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") != 1).alias("neg")
    )
    groups = scored.select(*by).distinct() if by else scored.sparkSession.range(1).select()
    dense = groups.select(*by, F.explode(F.sequence(F.lit(0), F.lit(GRID_N))).alias("cell"))
    dense = dense.join(cells, [*by, "cell"], "left").fillna(0, ["pos", "neg"])
    w_all = Window.partitionBy(*by)
    w_suffix = Window.partitionBy(*by).orderBy(F.col("cell").desc()).rowsBetween(Window.unboundedPreceding, 0)
    t = dense.select(
        *by, "cell",
        F.sum("pos").over(w_suffix).alias("tp"), F.sum("neg").over(w_suffix).alias("fp"),
        F.sum("pos").over(w_all).alias("n_pos"), F.sum("neg").over(w_all).alias("n_neg"),
    ).where(F.col("cell") >= 1)
    j = F.col("cell") - 1
    return t.select(
        *by, j.alias("grid_index"), grid_value(j).alias("threshold"),
        "tp", "fp", (F.col("n_pos") - F.col("tp")).alias("fn"), (F.col("n_neg") - F.col("fp")).alias("tn"),
    ).withColumn("f2", f_beta(F.col("tp"), F.col("fp"), F.col("fn")))


def best_threshold(scored: DataFrame, prob: str = "prob", by: Sequence[str] = ()) -> DataFrame:
    """Grid threshold with the highest F2 (lowest threshold on ties); thresholds that
    predict nothing are skipped; (0.5, 0.0) when no F2 is above zero."""
    by = list(by)
    keys = by or ["_g"]
    if not by:
        scored = scored.withColumn("_g", F.lit(0))
    t = threshold_table(scored, prob, keys).where((F.col("tp") + F.col("fp")) > 0).where(F.col("f2") > 0)
    w = Window.partitionBy(*keys).orderBy(F.col("f2").desc(), F.col("grid_index").asc())
    best = t.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(
        *keys, "threshold", F.col("f2").alias("best_f2"))
    groups = scored.select(*keys).distinct() if by else scored.sparkSession.range(1).select(F.lit(0).alias("_g"))
    out = groups.join(best, keys, "left")
    return out.select(*by, F.coalesce("threshold", F.lit(DEFAULT_THRESHOLD)).alias("threshold"),
                      F.coalesce("best_f2", F.lit(0.0)).alias("best_f2"))


def confusion(scored: DataFrame, thresholds: DataFrame, prob: str = "prob", by: Sequence[str] = ()) -> DataFrame:
    """tp / fp / fn / tn at the group's threshold (``thresholds``: by..., threshold)."""
    by = list(by)
    j = scored.join(F.broadcast(thresholds.select(*by, "threshold")), by) if by else _attach(
        scored, thresholds.select("threshold"))
    pred = F.col(prob) >= F.col("threshold")
    pos = F.col("y") == 1
    return j.groupBy(*by).agg(
        F.first("threshold").alias("threshold"),
        F.count_if(pred & pos).alias("tp"), F.count_if(pred & ~pos).alias("fp"),
        F.count_if(~pred & pos).alias("fn"), F.count_if(~pred & ~pos).alias("tn"),
    )


def rates(conf: DataFrame) -> DataFrame:
    """Precision, recall, F1, F2 from confusion counts; 0 on zero denominators."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return conf.select(
        "*",
        F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0)).alias("recall"),
        f_beta(tp, fp, fn, 1.0).alias("f1"),
        f_beta(tp, fp, fn, 2.0).alias("f2"),
    )


def metric_record(scored: DataFrame, prob: str = "prob") -> DataFrame:
    """The 11-entry metric record as ``(metric, value)`` rows."""
    from riskloom.session import cut_lineage

    best = best_threshold(scored, prob)
    r = rates(confusion(scored, best, prob))
    curve = cut_lineage(score_curve(scored, prob))  # one curve feeds three metrics
    auc = roc_auc(scored, prob, curve=curve)
    ap = average_precision(scored, prob, curve=curve)
    rp = recall_at_precision(scored, prob, curve=curve)
    one = _attach(_attach(_attach(r, auc), ap), rp)
    names = ["roc_auc", "average_precision", "f2", "f1", "recall", "precision", "recall_at_precision",
             "tp", "fp", "fn", "tn"]
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names
    ])).alias("m")).select("m.metric", "m.value")


def blend_weights(members: DataFrame, prob: str = "prob") -> DataFrame:
    """``(member, average_precision, weight)``: members weighted by AP, normalised."""
    ap = average_precision(members, prob, by=["member"])
    return ap.select("member", "average_precision",
                     (F.col("average_precision") / F.sum("average_precision").over(Window.partitionBy())).alias("weight"))


def blend(wide: DataFrame, weights: DataFrame, members: Sequence[str], out: str = "blend") -> DataFrame:
    """Weighted sum of member columns; the member list is fixed, so the weights are
    pivoted to one row and attached (no shuffle of the scored rows)."""
    row = weights.agg(*[F.max(F.when(F.col("member") == m, F.col("weight"))).alias(f"_w_{m}") for m in members])
    j = _attach(wide, row)
    expr = None
    for m in members:
        term = F.col(f"_w_{m}") * F.col(m)
        expr = term if expr is None else expr + term
    return j.withColumn(out, expr).drop(*[f"_w_{m}" for m in members])
