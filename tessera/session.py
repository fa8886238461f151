"""Session construction and shared-folder helpers.

Writers in this package never use a machine-local temporary folder on a
cluster: every scratch or landing table goes under the shared folder the
cluster names in ``spark.checkpoint.dir``.  Only when that setting is unset
(local runs, tests) do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every session of this package wants.  Shuffle width is sized by the
# caller: ~2-3x the total executor cores on a cluster, the core count locally.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Small inputs that fan out into many output folders (partitioned writes)
    # should not be coalesced into a single task; at scale the 64 MB advisory
    # size governs and this floor is irrelevant.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    Read from ``spark.checkpoint.dir``; set a local one only when it is unset.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tessera-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    try:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(os.path.join(root, "rdd-checkpoints"))
    except Exception:  # connect sessions have no SparkContext
        pass
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the shared root."""
    return os.path.join(shared_root(spark), "tessera", f"{name}-{uuid.uuid4().hex[:12]}")


def app_id(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:  # connect sessions have no SparkContext
        return spark.conf.get("spark.app.id", "app")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that their Python workers can import it
    wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_tessera_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tessera-package-"), "tessera_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(path)
    sc._tessera_shipped = True
