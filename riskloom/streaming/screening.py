"""Continuous screening with Structured Streaming.

Requests land as parquet files in a landing folder; a file-source stream applies
the batch screening transform to each micro-batch inside ``foreachBatch`` and
writes the responses to the batch's own folder of the parquet sink. The transform
is stateless (no watermark needed); fitted tables are small and attached per batch.
A batch that is run again after a restart overwrites its folder, so the sink holds
every response once although ``foreachBatch`` itself is at-least-once.
"""

from __future__ import annotations

import functools
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from riskloom.operators import screen
from riskloom.session import checkpoint_dir
from riskloom.sources import releases, store

#: Most rows of a landed file.
FILE_ROWS = 100_000


def start_screen_stream(spark: SparkSession, landing: str, sink: str, checkpoint: str, medians: DataFrame,
                        scorer_params: DataFrame, calibration: DataFrame, features: list[str],
                        typology_attrs: dict[str, str], schema, available_now: bool = True,
                        files_per_batch: int | None = None):
    """Start the stream; returns the StreamingQuery."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(landing)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        out = screen.screen_requests(batch, medians, scorer_params, calibration, features, typology_attrs)
        out.write.mode("overwrite").parquet(os.path.join(sink, f"batch_id={batch_id}"))

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def start_release_stream(spark: SparkSession, landing: str, sink: str, checkpoint: str, releases_root: str,
                         typology_attrs: dict[str, str], schema, available_now: bool = True, files_per_batch: int | None = None,
                         derive: str = "median"):
    """Screening by released models (``derive`` as in ``screen_release``). A micro-batch takes the release that is current when it first runs and
    writes its version beside the sink before its responses, so a batch that runs again uses the same one, and
    members, weights, calibration and medians change together between batches."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    screened = screen.screen_release if derive == "median" else functools.partial(screen.screen_release, derive=derive)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        note = f"{sink.rstrip('/')}-versions/{batch_id}"
        store.put_text(spark, note, releases.current(spark, releases_root))
        release = releases.load(spark, releases_root, store.get_text(spark, note))
        out = screened(batch, release, typology_attrs)
        out.write.mode("overwrite").parquet(os.path.join(sink, f"batch_id={batch_id}"))

    w = reader.parquet(landing).writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")).start()


def land(requests: DataFrame, landing: str, batches: int) -> int:
    """Write ``requests`` as files for all cores, of FILE_ROWS rows at most; how many of them make one of ``batches`` micro-batches."""
    spark = requests.sparkSession
    requests.repartition(batches * spark.sparkContext.defaultParallelism).write.option("maxRecordsPerFile", FILE_ROWS).parquet(landing)
    return max(1, -(-sum(n.startswith("part-") for n in store.names(spark, landing)) // batches))


def run_release_stream(spark: SparkSession, requests: DataFrame, releases_root: str, typology_attrs: dict[str, str], batches: int = 3) -> DataFrame:
    """Land ``requests``, drain them through at most ``batches`` micro-batches, return the sink."""
    base = os.path.join(checkpoint_dir(spark), "screen-stream", uuid.uuid4().hex)
    landing, sink, ckpt = (os.path.join(base, x) for x in ("landing", "sink", "checkpoint"))
    files = land(requests, landing, batches)
    schema = spark.read.parquet(landing).schema
    start_release_stream(spark, landing, sink, ckpt, releases_root, typology_attrs, schema, files_per_batch=files).awaitTermination()
    return spark.read.parquet(sink).drop("batch_id")


def run_screen_stream(spark: SparkSession, requests: DataFrame, medians: DataFrame, scorer_params: DataFrame,
                      calibration: DataFrame, features: list[str], typology_attrs: dict[str, str], batches: int = 3) -> DataFrame:
    """Land ``requests``, drain them through at most ``batches`` micro-batches, return the sink."""
    base = os.path.join(checkpoint_dir(spark), "screen-stream", uuid.uuid4().hex)
    landing, sink, ckpt = (os.path.join(base, x) for x in ("landing", "sink", "checkpoint"))
    files = land(requests, landing, batches)
    schema = spark.read.parquet(landing).schema
    q = start_screen_stream(spark, landing, sink, ckpt, medians, scorer_params, calibration, features,
                            typology_attrs, schema, files_per_batch=files)
    q.awaitTermination()
    return spark.read.parquet(sink).drop("batch_id")
