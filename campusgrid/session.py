"""Session helpers: a tuned local/test session, the shared work folder, and shipping the package."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_PACKAGE_DIR = os.path.dirname(os.path.abspath(__file__))


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session with the settings the library relies on. On a cluster pass the
    same ``spark.sql.adaptive.*`` settings to ``spark-submit`` instead."""
    builder = (
        SparkSession.builder.master(master)
        .appName("campusgrid")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.python.filterPushdown.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor can reach.

    A session in one process without the setting gets a temporary folder of its own; on a
    cluster (a local one of several processes too) the setting is required, as a
    machine-local folder would be lost with its machine."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    fallback = tempfile.mkdtemp(prefix="campusgrid-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame) -> DataFrame:
    """Persist a frame that several jobs read. A lost block is recomputed from lineage."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (file readers are pickled by name)."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="campusgrid-py-"), "campusgrid.zip")
    parent = os.path.dirname(_PACKAGE_DIR)
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(_PACKAGE_DIR):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, parent))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
