"""riskloom: account-risk scoring and alerting as Spark DataFrame operators.

Sub-packages
  sources    table reads, shared fixture views, sinks and fitted-table persistence
  functions  column expressions (tiers, typology, dates, quantiles, safe maths)
  operators  profiling, encoding, features, fitted statistics, anomaly scores,
             models, metrics, explanations, alerts, read-side queries, screening
  plans      the registry of named queries and their DuckDB oracle SQL
  streaming  continuous screening with Structured Streaming
"""

__version__ = "0.1.0"
