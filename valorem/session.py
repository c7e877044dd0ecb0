"""Session helpers.

The library never creates a cluster session itself inside an operator: every
function takes the caller's ``SparkSession``. ``local_session`` is for tests,
the bench and ad-hoc runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "valorem") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("VALOREM_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts, stream checkpoints and scratch tables.

    Reads ``spark.checkpoint.dir`` (the cluster's shared folder). A local
    session (``local[...]``: one process, one disk) without it gets a private
    temp folder; on a cluster a machine-local folder would lose data, so there
    the setting is required.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root and not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="valorem-ckpt-")
    if not sc.getCheckpointDir():  # e.g. the conf was given after the context started
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/valorem/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Cut lineage: reliable checkpoint into the shared checkpoint folder.

    Survives executor loss (the data live in the shared folder, not on an
    executor), and later plans read the checkpoint instead of recomputing.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
