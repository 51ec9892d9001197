"""Session helpers: a local session for tests and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the provided session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("riskloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is only read here. When it
    is unset on a local master (tests) a private scratch folder is created and set;
    on any other master that is an error, for executors would not share the folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors share (master {master})")
    path = tempfile.mkdtemp(prefix="riskloom-ckpt-", dir=os.environ.get("RISKLOOM_SCRATCH", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers (once per application), so that tasks
    can import it wherever the driver was started from."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    here = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="riskloom-zip-")) / "riskloom.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(here.rglob("*.py")):
            z.write(f, Path("riskloom") / f.relative_to(here))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(app)


def prepare(spark: SparkSession) -> None:
    """What every query needs of its session: the shared folder and the shipped package."""
    checkpoint_dir(spark)
    ship_package(spark)


def _lineage_dir(spark: SparkSession) -> str:
    return os.path.join(checkpoint_dir(spark), "lineage", spark.sparkContext.applicationId)


def cut_lineage(df):
    """Write ``df`` once as parquet under the shared checkpoint folder and read it
    back: later passes read files (surviving executor loss) and the input plan is
    computed once (``Dataset.checkpoint`` computes an unpersisted input twice)."""
    spark = df.sparkSession
    path = os.path.join(_lineage_dir(spark), uuid.uuid4().hex)
    df.write.parquet(path)
    return spark.read.parquet(path)


def drop_lineage(spark: SparkSession) -> None:
    """Delete what ``cut_lineage`` wrote for this application (when its results are saved)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_lineage_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
