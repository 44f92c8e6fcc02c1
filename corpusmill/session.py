"""Session construction and shared scratch locations.

Lineage cuts and intermediate tables live under the cluster's shared
``spark.checkpoint.dir``.  We only pick a directory ourselves when the
session has none configured (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Strings compared with DuckDB must keep exact bytes.
    "spark.sql.parquet.binaryAsString": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "corpusmill", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    prepare(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``corpusmill`` importable in Python workers (UDFs, mapInPandas, data sources).

    Zips the package once per application and hands it to ``addPyFile``,
    which distributes it to every executor.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import corpusmill
    root = os.path.dirname(os.path.abspath(corpusmill.__file__))
    # A code artifact on the driver, not data: addPyFile serves it to every executor.
    zpath = os.path.join(tempfile.mkdtemp(prefix="corpusmill-pkg-"), "corpusmill.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(zpath)
    _SHIPPED.add(sc.applicationId)


def prepare(spark: SparkSession) -> str:
    """Checkpoint dir + package shipping; idempotent.  Returns the checkpoint dir."""
    ship_package(spark)
    return ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint dir, creating a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        # Other machines do not see this machine's folders.
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="corpusmill-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/corpusmill-scratch/{name}-{uuid.uuid4().hex}"
