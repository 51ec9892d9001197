"""The trained members of the chain: boosted trees of three growths (``boosting``), their node table as
the saved artifact, and what is read from it: probabilities, log-odds and contributions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators import boosting, treeshap

#: Names of the members, in the order of their columns.
NAMES = [m.name for m in boosting.MEMBERS]


def train(df: DataFrame, members: Sequence[boosting.Member] = boosting.MEMBERS, k: int = 5) -> tuple[DataFrame, DataFrame]:
    """(node table, out-of-fold scores) of all members on all folds and on all rows, from one run.
    ``df`` has account_id, y, fold and features."""
    models, blocks, _ = boosting.fit(df, members, (*range(k), boosting.ALL))
    return boosting.node_table(df.sparkSession, models), boosting.oof_scores(models, blocks)


def final_members(nodes: DataFrame, names: Sequence[str] = NAMES) -> dict[str, list[dict]]:
    """The members that were fitted on all rows, from a node table."""
    held = boosting.read_nodes(nodes.where(F.col("fold") == boosting.ALL))
    return {n: held[n, boosting.ALL] for n in names if (n, boosting.ALL) in held}


def score(df: DataFrame, members: dict[str, list[dict]], keep: Sequence[str] = ("account_id", "y"), features: str = "features") -> DataFrame:
    """``keep`` columns, a probability for each member, and its log-odds as ``<member>_odds``."""
    made = [T.StructField(c, T.DoubleType()) for n in members for c in (n, f"{n}_odds")]
    schema = T.StructType([*[df.schema[c] for c in keep], *made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array(b.column("__x").to_pylist(), dtype=float).reshape(b.num_rows, -1)
            odds = [boosting.margins(trees, x) for trees in members.values()]
            cols = [pa.array(v) for o in odds for v in (1.0 / (1.0 + np.exp(-np.clip(o, -500, 500))), o)]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], *cols], names=schema.names)

    return df.select(*keep, F.col(features).cast("array<double>").alias("__x")).mapInArrow(run, schema)


def contributions(df: DataFrame, trees: list[dict], width: int, names: list[str], features: str = "features") -> DataFrame:
    """(account_id, feature, shap, base) of one member, in log-odds."""
    tables = [{**t, "cover": t["rows"]} for t in trees[1:]]
    return treeshap.tree_shap(df, tables, width, trees[0]["prior"], features, names)
