"""Layer tables and reporting views under SQL names, and inserts through SQL with column defaults.

* ``declare_table`` makes an external table whose columns have defaults, so that ``INSERT INTO t (some columns) VALUES ...`` fills the rest.
* ``declare_slices`` shows a layer table to SQL: a table partitioned by slice, whose partitions are the folders of the slices that the layer's
  ledger lists. ``refresh_slices`` adds those committed since and drops those a reset took out; what is not committed is never a partition.
* ``store_view`` keeps a view over such tables.

Every statement is kept as a small file beside the data, created in one step. ``attach`` runs the newest
statement of each name again, so tables and views survive the session with any catalog; with a shared metastore, which keeps them
itself, it changes nothing. Tables are external: dropping a name drops no data.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import asdict, dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from routeflow.schemas import LOAD_ID
from routeflow.sources import ledger
from routeflow.sources.tables import DATA, ROWS

SLICE = "slice"
TABLE, SLICES, VIEW = "table", "slices", "view"
#: Partitions that one ALTER TABLE adds or drops.
BATCH = 200

_S = T.StringType()


@dataclass(frozen=True)
class Names:
    """A database of SQL names, and the folder that keeps their definitions and the tables' data."""

    database: str
    root: str

    def of(self, name: str) -> str:
        return f"`{self.database}`.`{name}`"

    def data(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    @property
    def definitions(self) -> str:
        return f"{self.root}/definitions"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _columns(schema: T.StructType, defaults: Mapping[str, str]) -> str:
    unknown = set(defaults) - set(schema.names)
    if unknown:
        raise ValueError(f"defaults for columns the table does not have: {sorted(unknown)}")
    made = (f"`{f.name}` {f.dataType.simpleString()}" + (f" DEFAULT {defaults[f.name]}" if f.name in defaults else "") for f in schema)
    return ", ".join(made)


def _open(spark: SparkSession, names: Names) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{names.database}` LOCATION {_literal(names.root + '/database')}")


@dataclass(frozen=True)
class Definition:
    """A kept statement; ``path`` is the layer table's folder for slices, the data's for tables."""

    name: str
    kind: str
    statement: str
    path: str = ""


def _kept(spark: SparkSession, names: Names) -> list[Definition]:
    """All definitions ever kept, oldest first: one small text file each."""
    return [Definition(**json.loads(ledger.read_text(spark, f"{names.definitions}/{f}"))) for f in ledger.file_names(spark, names.definitions)]


def definitions(spark: SparkSession, names: Names) -> list[Definition]:
    """The newest definition of each name, in the order in which the names were first defined."""
    return list({d.name: d for d in _kept(spark, names)}.values())


def _define(spark: SparkSession, names: Names, name: str, kind: str, statement: str, path: str = "") -> None:
    """Run a statement, then keep it unless it is the one kept for this name."""
    _open(spark, names)
    spark.sql(statement)
    made = Definition(name, kind, statement, path)
    while True:
        kept = _kept(spark, names)
        if {d.name: d for d in kept}.get(name) == made:
            return
        if ledger.publish(spark, names.definitions, ledger.entry_name(len(kept)), json.dumps(asdict(made))):
            return


def declare_table(
    spark: SparkSession, names: Names, name: str, schema: T.StructType, defaults: Mapping[str, str] | None = None, options: str = "", path: str | None = None
) -> str:
    """``CREATE TABLE IF NOT EXISTS`` with defaults (SQL expressions by column); ``options`` holds PARTITIONED BY and CLUSTERED BY clauses."""
    path = path or names.data(name)
    statement = f"CREATE TABLE IF NOT EXISTS {names.of(name)} ({_columns(schema, defaults or {})}) USING parquet {options} LOCATION {_literal(path)}"
    _define(spark, names, name, TABLE, statement, path)
    return names.of(name)


def declare_slices(spark: SparkSession, names: Names, name: str, path: str, schema: T.StructType) -> str:
    """Show the layer table at ``path`` to SQL under ``name``, with its load id and its slice as further columns."""
    full = T.StructType([*schema.fields, T.StructField(LOAD_ID, _S), T.StructField(SLICE, _S)])
    statement = (
        f"CREATE TABLE IF NOT EXISTS {names.of(name)} ({_columns(full, {})}) USING parquet PARTITIONED BY (`{SLICE}`) LOCATION {_literal(names.data(name))}"
    )
    _define(spark, names, name, SLICES, statement, path)
    refresh_slices(spark, names, name, path)
    return names.of(name)


def partitions(spark: SparkSession, names: Names, name: str) -> set[str]:
    """Slices that are partitions of the table."""
    return {r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {names.of(name)}").collect()}


def refresh_slices(spark: SparkSession, names: Names, name: str, path: str) -> None:
    """Make the table's partitions the layer's committed slices; a slice that is one already is not looked at again."""
    committed = {e.folder for e in ledger.live(ledger.entries(spark, path))}
    shown = partitions(spark, names, name)
    new, gone = sorted(committed - shown), sorted(shown - committed)
    for k in range(0, len(new), BATCH):
        adds = (f"PARTITION (`{SLICE}` = {_literal(f)}) LOCATION {_literal(f'{path}/{DATA}/{f}/{ROWS}')}" for f in new[k : k + BATCH])
        spark.sql(f"ALTER TABLE {names.of(name)} ADD IF NOT EXISTS {' '.join(adds)}")
    for k in range(0, len(gone), BATCH):
        drops = (f"PARTITION (`{SLICE}` = {_literal(f)})" for f in gone[k : k + BATCH])
        spark.sql(f"ALTER TABLE {names.of(name)} DROP IF EXISTS {', '.join(drops)}")


def store_view(spark: SparkSession, names: Names, name: str, query: str) -> str:
    """``CREATE OR REPLACE VIEW`` over tables and views of the catalog."""
    _define(spark, names, name, VIEW, f"CREATE OR REPLACE VIEW {names.of(name)} AS {query}")
    return names.of(name)


def attach(spark: SparkSession, names: Names) -> list[str]:
    """Define the kept tables and views in this session's catalog; returns their names."""
    _open(spark, names)
    kept = definitions(spark, names)
    for d in kept:
        spark.sql(d.statement)
        if d.kind == SLICES:
            refresh_slices(spark, names, d.name, d.path)
    return [d.name for d in kept]


def detach(spark: SparkSession, names: Names) -> None:
    """Forget the names in this session's catalog; data and definitions stay."""
    for d in reversed(definitions(spark, names)):
        spark.sql(f"DROP {'VIEW' if d.kind == VIEW else 'TABLE'} IF EXISTS {names.of(d.name)}")
