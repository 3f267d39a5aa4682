"""Session helpers: builder for local runs and the shared scratch folder.

On a cluster the shared folder is ``spark.checkpoint.dir`` (set by the cluster); every
intermediate table, streaming checkpoint and landing area this library writes lives under it.
A machine-local temporary folder is used only when the setting is absent and the master is local (tests).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, partitions: int | None = None, app: str = "routeflow") -> SparkSession:
    """Local session with the settings the library assumes (AQE on, UTC, UI off)."""
    cpus = os.environ.get("BENCH_CPUS") or "8"
    master = master or f"local[{cpus}]"
    partitions = partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("ROUTEFLOW_DRIVER_MEMORY", "8g"))
        .config("spark.sql.sources.partitionOverwriteMode", "static")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder for intermediate data (``spark.checkpoint.dir``).

    Read from the session. Where it is unset a temporary folder serves local masters (tests); a cluster without the
    setting is an error, since its machines do not share that folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="routeflow-ckpt-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared root (never reused, never cleared)."""
    return f"{shared_root(spark)}/routeflow/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written under the shared root and read back: joins are then planned on its true size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
