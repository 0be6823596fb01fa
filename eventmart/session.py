"""Session helpers shared by tests, the benchmark and the streaming wiring."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: str = "*", app: str = "eventmart", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark. Clusters bring their own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="warehouse-", dir="/tmp"),
    }
    settings.update(conf)
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path for files all executors must see.

    It lies under ``spark.checkpoint.dir``. Only a local session may leave
    that unset; then a temporary folder is set for the whole session.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="eventmart-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Makes ``DataFrame.checkpoint`` usable without overriding the cluster's folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark, "checkpoints"))


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder on whatever file system it lies; one that is not there is no error."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
