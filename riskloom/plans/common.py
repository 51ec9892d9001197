"""Base inputs shared by several plans, in both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.scoring import ACTIONS, TIER_BOUNDS
from riskloom.operators.alerts import risk_scores
from riskloom.sources.fixtures import fixture

# --- Spark side --------------------------------------------------------------


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(account_id, y, prob)``: the informative score of ``scored_events``."""
    return fixture(spark, sf_dir, "scored_events").select("account_id", "y", F.col("p2").alias("prob"))


def tiered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``scored`` + ``risk_score`` + ``tier`` (persisted once per application)."""
    from riskloom.sources.artifacts import materialized

    return materialized(spark, "tiered_events", sf_dir, lambda: risk_scores(scored(spark, sf_dir), "prob"))


# --- SQL side (CTE bodies) ---------------------------------------------------

SQL_SCORED = "SELECT account_id, y, p2 AS prob FROM scored_events"


def sql_tier_case(col: str) -> str:
    parts = " ".join(f"WHEN {col} >= {lo} THEN '{name}'" for name, lo in TIER_BOUNDS[:-1])
    return f"CASE {parts} ELSE '{TIER_BOUNDS[-1][0]}' END"


def sql_action_case(col: str, table: dict[str, str] = ACTIONS) -> str:
    parts = " ".join(f"WHEN {col} = '{t}' THEN '{a}'" for t, a in table.items())
    return f"CASE {parts} END"


def sql_score(prob: str, p1: str, p99: str) -> str:
    raw = f"(({prob} - {p1}) / ({p99} - {p1} + 1e-9) * 1000.0)"
    return (
        f"CASE WHEN {raw} IS NOT NULL THEN CAST(round_even(least(greatest({raw}, 0.0), 1000.0), 0) AS INTEGER) END"
    )


SQL_CAL = "SELECT quantile_cont(prob, 0.01) AS p1, quantile_cont(prob, 0.99) AS p99 FROM scored"
SQL_TIERED = (
    f"SELECT account_id, y, prob, risk_score, {sql_tier_case('risk_score')} AS tier FROM "
    f"(SELECT s.*, {sql_score('s.prob', 'c.p1', 'c.p99')} AS risk_score FROM scored s, cal c)"
)
TIERED_CTES = (("scored", SQL_SCORED), ("cal", SQL_CAL), ("tiered", SQL_TIERED))
