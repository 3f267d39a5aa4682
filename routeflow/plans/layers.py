"""Layer layout of one pipeline instance and the batch build of its raw and curated tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routeflow.operators.curate import curate
from routeflow.schemas import CURATED_SCHEMA, RAW_SCHEMA
from routeflow.session import scratch_path
from routeflow.sources.fixtures import FIXTURE_TABLES, landing_text_from_tables, lines_from_tables, routes_from_tables, routes_of_lines
from routeflow.sources.landing import CSV_WRITE_OPTIONS
from routeflow.sources.ledger import file_state, file_system
from routeflow.sources.tables import COMPRESSION, make_folder, new_load_id, read_curated, read_raw, write_layer


@dataclass(frozen=True)
class Layers:
    """Paths of the layer tables under one root (one prefix per layer)."""

    root: str

    @property
    def landing(self) -> str:
        return f"{self.root}/landing"

    @property
    def raw(self) -> str:
        return f"{self.root}/raw/routes"

    @property
    def curated(self) -> str:
        return f"{self.root}/curated/routes"

    @property
    def audit(self) -> str:
        return f"{self.root}/curated/audit_log"

    @property
    def enriched(self) -> str:
        return f"{self.root}/ai/enriched_routes"

    def states(self, table: str) -> str:
        """Kept states of the raw or curated table (``operators/states.py``)."""
        return f"{self.root}/states/{table}"

    @property
    def checkpoints(self) -> str:
        return f"{self.root}/_checkpoints"

    def checkpoint(self, name: str) -> str:
        return f"{self.checkpoints}/{name}"


def new_layers(spark: SparkSession, name: str) -> Layers:
    """A fresh pipeline instance under the shared root."""
    return Layers(scratch_path(spark, name))


def load_raw_rows(rows: DataFrame, layers: Layers, load_id: str | None = None) -> str:
    """Append typed raw-shaped rows to the raw table (``load_timestamp`` = write time)."""
    return write_layer(rows, layers.raw, load_id or new_load_id("load"), RAW_SCHEMA)


def curate_batch(spark: SparkSession, layers: Layers, load_id: str | None = None) -> str:
    """Batch form of the incremental task: curate the whole raw table into the curated table."""
    return write_layer(curate(read_raw(spark, layers.raw)), layers.curated, load_id or new_load_id("curate"), CURATED_SCHEMA)


_BUILT: dict[tuple, Layers] = {}


def _input_key(spark: SparkSession, sf_dir: str, what: str) -> tuple:
    files = (file_state(spark, f"{sf_dir.rstrip('/')}/{t}.parquet") for t in FIXTURE_TABLES)
    return (what, spark.sparkContext.applicationId, sf_dir.rstrip("/"), *files)


def _raw_layers(spark: SparkSession, sf_dir: str) -> Layers:
    key = _input_key(spark, sf_dir, "raw")
    layers = _BUILT.get(key)
    if layers is None:
        layers = new_layers(spark, "fixture-layers")
        load_raw_rows(routes_from_tables(spark, sf_dir), layers)
        _BUILT[key] = layers
    return layers


def fixture_layers(spark: SparkSession, sf_dir: str) -> Layers:
    """Raw and curated tables built once per session from the driver tables in ``sf_dir``, and anew when their files change.

    Views, checks and enrichment read these tables, as they read the stored layers in production;
    the load and curation steps themselves are measured by their own queries.
    """
    key = _input_key(spark, sf_dir, "layers")
    layers = _BUILT.get(key)
    if layers is None:
        layers = _raw_layers(spark, sf_dir)
        curate_batch(spark, layers)
        _BUILT[key] = layers
    return layers


def fixture_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table alone: what reads no curated row does not wait for one to be written."""
    return read_raw(spark, _raw_layers(spark, sf_dir).raw)


def fixture_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_curated(spark, fixture_layers(spark, sf_dir).curated)


def fixture_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rows without their load time, as a load would bring them.

    Rendered from joined lines, which are stored once per session: the rows are written by the loads alone, and a load of some of
    them renders no others.
    """
    key = _input_key(spark, sf_dir, "lines")
    layers = _BUILT.get(key)
    lines = lines_from_tables(spark, sf_dir)
    if layers is None:
        layers = new_layers(spark, "fixture-lines")
        lines.write.parquet(f"{layers.root}/lines", compression=COMPRESSION)
        _BUILT[key] = layers
    return routes_of_lines(spark.read.schema(lines.schema).parquet(f"{layers.root}/lines"))


def fixture_landing(spark: SparkSession, sf_dir: str, line_breaks: bool = False) -> Layers:
    """Landing CSV built once per session: ``landing/1`` holds the finished flights, ``landing/2`` the others."""
    key = _input_key(spark, sf_dir, f"landing-{line_breaks}")
    layers = _BUILT.get(key)
    if layers is None:
        layers = new_layers(spark, "fixture-landing")
        text = landing_text_from_tables(spark, sf_dir, line_breaks)
        finished = F.coalesce(F.col("codeshare") == "1", F.lit(False))
        for part, rows in ((1, text.where(finished)), (2, text.where(~finished))):
            rows.write.options(**CSV_WRITE_OPTIONS).csv(f"{layers.landing}/{part}")
        _BUILT[key] = layers
    return layers


def land_files(spark: SparkSession, source: Layers, target: Layers, part: int) -> None:
    """Let the files of one part of a stored landing arrive in the landing folder of ``target``."""
    make_folder(spark, target.landing)
    folder, fs = file_system(spark, f"{source.landing}/{part}")
    landing, _ = file_system(spark, target.landing)
    copy = spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for f in fs.listStatus(folder):
        if not f.getPath().getName().startswith(("_", ".")):
            copy(fs, f.getPath(), fs, landing, False, False, conf)
