from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .appName("routeflow-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir() and not s.sparkContext.getConf().get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="routeflow-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def fresh(spark):
    """A fresh pipeline instance (layer folders) under the shared root."""
    from routeflow.plans.layers import new_layers

    return new_layers(spark, "test")


def route_row(**overrides):
    """One raw-shaped row (24 source columns + source_file), the smoke row by default."""
    from routeflow import fixed_values as FV
    from routeflow.schemas import SOURCE_COLUMNS

    row = dict(zip(SOURCE_COLUMNS, FV.SMOKE_ROW))
    row["source_file"] = "t.csv"
    row.update(overrides)
    return row


def routes_df(spark, rows):
    from pyspark.sql import types as T

    from routeflow.schemas import SOURCE_FIELDS

    schema = T.StructType([T.StructField(n, t, True) for n, t in SOURCE_FIELDS] + [T.StructField("source_file", T.StringType())])
    return spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in rows], schema)
