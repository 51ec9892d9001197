"""Input views derived from the shared tables.

Each view is one SQL text run by both engines: Spark binds the table names to
DataFrames (``spark.sql(text, customer=df, ...)``), the DuckDB oracle binds them to
its pre-registered views. Work grows with the tables: every view is a scan, an
aggregation or an equi-join of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.sources.tables import read_table

# Account table with hard/soft leaks, an empty and a constant column, 90 % and
# 25 % missing columns, strings of 5 / 25 / n distinct values and bad dates.
ACCT_RAW = """
WITH o AS (SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS spend,
                  max(o_totalprice) AS max_order, min(o_orderdate) AS first_order,
                  sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS n_urgent
           FROM {orders} GROUP BY o_custkey),
     e AS (SELECT user_id, count(*) AS n_events, round(sum(value), 2) AS ev_value,
                  sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS n_errors
           FROM {events} GROUP BY user_id)
SELECT c.c_custkey AS account_id,
       CASE WHEN c.c_acctbal < -800 THEN 1 ELSE 0 END AS y,
       CASE WHEN c.c_custkey % 4 = 0 THEN NULL ELSE c.c_acctbal END AS f_bal,
       CAST(o.n_orders AS DOUBLE) AS f_orders, o.spend AS f_spend, o.max_order AS f_max,
       CAST(o.n_urgent AS DOUBLE) AS f_urgent, CAST(e.n_events AS DOUBLE) AS f_events,
       e.ev_value AS f_ev_value, CAST(e.n_errors AS DOUBLE) AS f_errors,
       CAST(CASE WHEN c.c_acctbal < -800 THEN 1 ELSE 0 END AS DOUBLE) AS f_leak,
       CAST(CASE WHEN c.c_acctbal < -800 THEN 1 ELSE 0 END + 0.1 * (c.c_custkey % 4) AS DOUBLE) AS f_soft,
       CAST(NULL AS DOUBLE) AS f_empty, CAST(7 AS DOUBLE) AS f_const,
       c.c_mktsegment AS s_segment, n.n_name AS s_nation, c.c_name AS s_name,
       CASE WHEN c.c_custkey % 50 = 0 THEN '99-99-9999'
            ELSE concat(lpad(CAST(month(o.first_order) AS STRING), 2, '0'), '-',
                        lpad(CAST(day(o.first_order) AS STRING), 2, '0'), '-',
                        CAST(year(o.first_order) AS STRING)) END AS s_opened
FROM {customer} c LEFT JOIN o ON c.c_custkey = o.o_custkey
     LEFT JOIN e ON c.c_custkey = e.user_id
     LEFT JOIN {nation} n ON c.c_nationkey = n.n_nationkey
"""

# Scored accounts: p is uninformative, p2 informative; y marks error events.
SCORED_EVENTS = """
SELECT event_id AS account_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS y,
       CAST(least(value / 250.0, 1.0) AS DOUBLE) AS p,
       CAST(0.6 * least(value / 250.0, 1.0) + CASE WHEN event_type = 'error' THEN (event_id % 5) / 10.0 ELSE 0.0 END AS DOUBLE) AS p2
FROM {events}
"""

# Dense numeric accounts: 64 features per row.
VEC_ACCOUNTS = """
SELECT vec_id AS account_id, CASE WHEN label = 0 THEN 1 ELSE 0 END AS y, embedding AS features
FROM {embeddings}
"""

# Text-derived accounts with two string columns.
DOC_ACCOUNTS = """
SELECT d.doc_id AS account_id, l.toxic AS y, CAST(d.n_chars AS DOUBLE) AS f_chars,
       CAST(length(d.text) - length(replace(d.text, ' ', '')) AS DOUBLE) AS f_spaces,
       d.lang AS s_lang, d.source AS s_source
FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id
"""

VIEWS = {
    "acct_raw": (ACCT_RAW, ("orders", "events", "customer", "nation")),
    "scored_events": (SCORED_EVENTS, ("events",)),
    "vec_accounts": (VEC_ACCOUNTS, ("embeddings",)),
    "doc_accounts": (DOC_ACCOUNTS, ("documents", "labels")),
}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named view as a Spark DataFrame over the tables in ``sf_dir``."""
    text, tables = VIEWS[name]
    frames = {t: read_table(spark, sf_dir, t) for t in tables}
    return spark.sql(text, **frames)


def fixture_sql(name: str) -> str:
    """The named view's SQL text over plain table names (DuckDB oracle)."""
    text, tables = VIEWS[name]
    return text.format(**{t: t for t in tables})


def with_views(body: str, *names: str, extra: tuple[tuple[str, str], ...] = ()) -> str:
    """``WITH view AS (...), ... body`` for the oracle."""
    parts = [f"{n} AS ({fixture_sql(n)})" for n in names]
    parts += [f"{n} AS ({sql})" for n, sql in extra]
    return "WITH " + ",\n".join(parts) + "\n" + body
