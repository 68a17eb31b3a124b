"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this engine should carry. On a cluster the
# submitter sets partition counts and memory; these only keep behaviour
# (time zone, AQE, no UI server) the same everywhere.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(
    cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "touchline", **conf: str
) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in {
        **BASE_CONF,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": "8g",
        **conf,
    }.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names shared storage and is used as is (the
    setting cannot change at run time). Only when it is unset in local mode
    (tests) is a scratch folder chosen, once per application, and registered
    with ``setCheckpointDir``. A cluster without the setting is an error: a
    machine-local folder is not visible to the executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: set it to a folder on shared storage"
        )
    path = tempfile.mkdtemp(prefix="touchline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def _scratch_home(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/scratch/{spark.sparkContext.applicationId}"


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables, on the storage that the driver and all
    executors share. All of an application's lie in one folder of its own."""
    return f"{_scratch_home(spark)}/{name}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables. DataFrames that still read them
    can't be used any more, so this is for the end of a job."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_home(spark))
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
