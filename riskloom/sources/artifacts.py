"""Fitted-artifact persistence between phases and applications.

Each phase output (clean table, node table, fitted parameter tables) is written as parquet under the
shared checkpoint folder and read back by every later step. Writing cuts the lineage (a lost executor
re-reads files instead of recomputing the whole chain). The folder's name holds a hash of the input files
(path, length, time of change) and of the package's sources, so a second application, or a driver that was
started again after a loss, goes on from what is there, and changed inputs or code start afresh. An artifact
counts once its manifest stands beside it: the data is written under a name of its own first, and a
half-written one is never read. Inputs are looked at once per application.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskloom.session import checkpoint_dir
from riskloom.sources import store

_KEYS: dict[tuple[str, str], str] = {}
_FOUND: dict[tuple[str, str], str] = {}


def content_key(spark: SparkSession, scope: str) -> str:
    """Hash of the input files in ``scope`` and of the code, as this application first saw them."""
    own = (spark.sparkContext.applicationId, scope)
    if own not in _KEYS:
        _KEYS[own] = hashlib.sha1(f"{scope} {store.fingerprint(spark, scope)} {store.code_version()}".encode()).hexdigest()[:16]
    return _KEYS[own]


def artifact_path(spark: SparkSession, name: str, scope: str) -> str:
    return os.path.join(checkpoint_dir(spark), "artifacts", f"{name}-{content_key(spark, scope)}")


def materialized(spark: SparkSession, name: str, scope: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The artifact ``name`` for ``scope`` (e.g. the input folder), built on first use by any application."""
    path = artifact_path(spark, name, scope)
    known = (spark.sparkContext.applicationId, path)
    if known not in _FOUND:
        manifest = os.path.join(path, "manifest")
        data = store.get_text(spark, manifest)
        if data is None:
            own = f"data-{uuid.uuid4().hex}"
            build().write.parquet(os.path.join(path, own))
            data = own if store.put_text(spark, manifest, own) else store.get_text(spark, manifest)
        _FOUND[known] = os.path.join(path, data)
    return spark.read.parquet(_FOUND[known])


def materialized_all(spark: SparkSession, names: tuple[str, ...], scope: str, build: Callable[[], tuple[DataFrame, ...]]) -> tuple[DataFrame, ...]:
    """Several artifacts that one run makes together, in the order of ``names``."""
    made: list[tuple[DataFrame, ...]] = []

    def part(i: int) -> DataFrame:
        if not made:
            made.append(build())
        return made[0][i]

    return tuple(materialized(spark, n, scope, lambda i=i: part(i)) for i, n in enumerate(names))
