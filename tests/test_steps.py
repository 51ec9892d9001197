"""Step log by observed writes."""

import datetime as dt

from pyspark.sql import functions as F

from riskloom.operators import features
from riskloom.operators.steps import StepLog


def raw(spark, n):
    t = spark.range(1, n + 1).select(F.col("id").alias("account_id"), (F.col("id") % 2).cast("int").alias("y"), (F.col("id") * 1.5).alias("a"),
                                     F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 5).cast("double").alias("b"))
    return t.withColumn("gone", F.lit(None).cast("double")).withColumn("flat", F.lit(7.0)).withColumn("leak", F.col("y").cast("double"))


def test_steps_of_a_run(spark, tmp_path):
    steps = StepLog()
    out, log = features.clean_accounts(raw(spark, 30), None, dt.date(2021, 1, 1), {"none": {}}, steps=steps)
    out.write.parquet(str(tmp_path / "clean"))
    rows = {r["step"]: r for r in steps.frame(spark).collect()}
    assert list(rows) == ["load", "leakage", "empty", "low_variance", "encode", "flags_and_meta", "impute"]
    assert [rows[k]["column_delta"] for k in ("load", "leakage", "empty", "low_variance", "encode")] == [5, -1, -1, -1, 0]
    assert rows["leakage"]["removed"] == ["leak"] and rows["empty"]["removed"] == ["gone"] and rows["low_variance"]["removed"] == ["flat"]
    assert "miss_flag_b" in rows["flags_and_meta"]["added"] and len(rows["flags_and_meta"]["added"]) == 8
    assert rows["load"]["rows"] == rows["flags_and_meta"]["rows"] == rows["impute"]["rows"] == 30
    assert rows["load"]["null_cells"] == 40 and rows["flags_and_meta"]["null_cells"] == 10 and rows["impute"]["null_cells"] == 0
    assert rows["leakage"]["rows"] is None and rows["leakage"]["null_cells"] is None
    assert all(r["seconds"] >= 0 for r in rows.values())
    for a, b in zip(list(rows.values()), list(rows.values())[1:]):
        assert a["columns_out"] == b["columns_in"]


def test_an_empty_table_logs_zero(spark, tmp_path):
    steps = StepLog()
    t = steps.written("load", raw(spark, 5).where("account_id > 9"))
    steps.last("kept", t.drop("flat")).write.parquet(str(tmp_path / "empty"))
    rows = steps.frame(spark).collect()
    assert [(r["rows"], r["null_cells"], r["columns_out"]) for r in rows] == [(0, 0, 5), (0, 0, 4)]
    nothing = StepLog()
    none = spark.createDataFrame([], "account_id long, y int, a double")
    nothing.last("kept", none).write.parquet(str(tmp_path / "none"))
    assert [(r["rows"], r["null_cells"]) for r in nothing.frame(spark).collect()] == [(0, 0)]
