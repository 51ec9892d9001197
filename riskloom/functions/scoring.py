"""Tier, action, magnitude and typology expressions (pure Columns, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's results.
# Tier lower bounds on the 0-1000 score, highest first, and the action texts.
TIER_BOUNDS = (("AUTO-FREEZE", 900), ("INVESTIGATOR", 750), ("WATCHLIST", 500), ("MONITORED", 0))
TIER_ORDER = ("AUTO-FREEZE", "INVESTIGATOR", "WATCHLIST", "MONITORED")
ACTIONS = {
    "AUTO-FREEZE": "Account frozen immediately. SAR filed to FIU-IND.",
    "INVESTIGATOR": "Route to AML investigator queue. Enhanced due diligence required.",
    "WATCHLIST": "Flag for enhanced monitoring. Review in next 48 hours.",
    "MONITORED": "Continue standard monitoring.",
}
# The screening service words the WATCHLIST action differently.
SCREEN_ACTIONS = dict(ACTIONS, WATCHLIST="Flag for enhanced monitoring. Review within 48 hours.")
# Contribution magnitude cut points (strictly greater).
MAGNITUDE_HIGH = 0.1
MAGNITUDE_MEDIUM = 0.05
# Model decision flag on the probability (strictly greater).
FLAG_PROBABILITY = 0.3


def tier_col(score: Column | str) -> Column:
    s = F.col(score) if isinstance(score, str) else score
    out = None
    for name, lo in TIER_BOUNDS[:-1]:
        out = F.when(s >= lo, F.lit(name)) if out is None else out.when(s >= lo, F.lit(name))
    return out.otherwise(F.lit(TIER_BOUNDS[-1][0]))


def action_col(tier: Column | str, screening: bool = False) -> Column:
    t = F.col(tier) if isinstance(tier, str) else tier
    table = SCREEN_ACTIONS if screening else ACTIONS
    out = None
    for name in TIER_ORDER:
        out = F.when(t == name, F.lit(table[name])) if out is None else out.when(t == name, F.lit(table[name]))
    return out


def tier_rank_col(tier: Column | str) -> Column:
    """0 for AUTO-FREEZE ... 3 for MONITORED."""
    t = F.col(tier) if isinstance(tier, str) else tier
    out = None
    for i, name in enumerate(TIER_ORDER):
        out = F.when(t == name, F.lit(i)) if out is None else out.when(t == name, F.lit(i))
    return out


def magnitude_col(contrib: Column | str) -> Column:
    c = F.col(contrib) if isinstance(contrib, str) else contrib
    return (
        F.when(c > MAGNITUDE_HIGH, F.lit("HIGH"))
        .when(c > MAGNITUDE_MEDIUM, F.lit("MEDIUM"))
        .otherwise(F.lit("LOW"))
    )


def calibrated_score(prob: Column | str, p1: Column, p99: Column) -> Column:
    """((p - p1) / (p99 - p1 + 1e-9)) * 1000, clipped to 0..1000, rounded half-even."""
    p = F.col(prob) if isinstance(prob, str) else prob
    raw = (p - p1) / (p99 - p1 + F.lit(1e-9)) * F.lit(1000.0)
    clipped = F.least(F.greatest(raw, F.lit(0.0)), F.lit(1000.0))
    return F.when(raw.isNotNull(), F.bround(clipped, 0).cast("int"))  # no score for a missing probability


def round6(c: Column | str) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    return F.round(x.cast("double"), 6)
