"""Step log of a phase: columns in and out, rows, missing cells and elapsed time of every step.

Rows and missing cells are observed metrics of writes that happen anyway (``Dataset.observe``), so the log costs
no pass of its own. Steps that only drop or add columns have no write and leave both NULL. An empty table logs 0.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SCHEMA = ("position int, step string, columns_in int, columns_out int, column_delta int, added array<string>, removed array<string>, "
          "rows long, null_cells long, seconds double")


@dataclass
class _Step:
    name: str
    before: list[str]
    after: list[str]
    begun: float
    ended: float | None
    seen: Observation | None = None


@dataclass
class StepLog:
    """Steps in the order in which they are recorded; ``ids`` aren't counted as columns."""

    ids: tuple[str, ...] = ("account_id", "y")
    _steps: list[_Step] = field(default_factory=list)
    _mark: float = field(default_factory=time.perf_counter)

    def columns(self, name: str, df: DataFrame) -> DataFrame:
        """Record a step that changed columns only."""
        self._add(name, df, None)
        return df

    def written(self, name: str, df: DataFrame) -> DataFrame:
        """Record a step and cut the lineage: the write counts rows and missing cells."""
        from riskloom.session import cut_lineage

        seen = Observation()
        out = cut_lineage(self._observe(df, seen))
        self._add(name, df, seen)
        return out

    def last(self, name: str, df: DataFrame) -> DataFrame:
        """Record the step whose output the caller writes: it ends when the log is read."""
        seen = Observation()
        self._add(name, df, seen, ended=False)
        return self._observe(df, seen)

    def frame(self, spark: SparkSession) -> DataFrame:
        """One row a step. Call it after the last step's output was written."""
        rows = []
        for i, s in enumerate(self._steps):
            got = s.seen.get if s.seen else {}
            seconds = (s.ended or time.perf_counter()) - s.begun
            rows.append((i, s.name, len(s.before), len(s.after), len(s.after) - len(s.before), [c for c in s.after if c not in s.before],
                         [c for c in s.before if c not in s.after], got.get("rows"), (got.get("null_cells") or 0) if s.seen else None, seconds))
        return spark.createDataFrame(rows, SCHEMA)

    def _observe(self, df: DataFrame, seen: Observation) -> DataFrame:
        missing = F.size(F.filter(F.array(*[F.col(f"`{c}`").isNull() for c in self._names(df)], F.lit(False)), lambda x: x))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(missing.cast("long")).alias("null_cells"))

    def _names(self, df: DataFrame) -> list[str]:
        return [c for c in df.columns if c not in self.ids]

    def _add(self, name: str, df: DataFrame, seen: Observation | None, ended: bool = True) -> None:
        now = time.perf_counter()
        before = self._steps[-1].after if self._steps else []
        self._steps.append(_Step(name, before, self._names(df), self._mark, now if ended else None, seen))
        self._mark = now
