"""A layer table's ledger as a streaming source: one small row per committed slice, in order of commitment.

The offset is a ledger position. A trigger asks for the entries after the last one by name (positions have no gaps), so it lists no folder,
however many slices the table holds; the rows of the slices are read by the batch with Spark's own Parquet scan.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from routeflow.sources import ledger

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not import this package

NAME = "layer_ledger"
SCHEMA = "position long, load_id string, folder string, kind string"
#: Entries asked for at once.
LOOK_AHEAD = 64


def _store(folder: str):
    """Arrow's file system and path of a folder given as Hadoop writes it (file:/a, file:///a, /a, hdfs://..., s3a://...)."""
    from pyarrow import fs

    if folder.startswith("/") or folder.startswith("file:"):
        return fs.LocalFileSystem(), re.sub(r"^file:(//)?", "", folder)
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", folder))


@dataclass
class Positions(InputPartition):
    start: int
    end: int


class LedgerReader(DataSourceStreamReader):
    """``most`` bounds the slices of a batch; ``from`` is the position to start from (a checkpoint's own offset wins)."""

    def __init__(self, options: dict[str, str], digits: int):
        self.folder = options["ledger"]
        self.next = int(options.get("from", "0"))
        self.most = int(options.get("most", "0"))
        self.digits = digits

    def _file(self, root: str, position: int) -> str:
        return f"{root}/{position:0{self.digits}d}.json"

    def initialOffset(self) -> dict:
        return {"position": self.next}

    def latestOffset(self) -> dict:
        store, root = _store(self.folder)
        end = self.next
        while not self.most or end < self.next + self.most:
            asked = store.get_file_info([self._file(root, end + k) for k in range(LOOK_AHEAD)])
            missing = [k for k, info in enumerate(asked) if not info.is_file]
            end += missing[0] if missing else LOOK_AHEAD
            if missing:
                break
        return {"position": min(end, self.next + self.most) if self.most else end}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self.next = end["position"]
        return [Positions(start["position"], end["position"])] if start["position"] < end["position"] else []

    def read(self, partition: Positions) -> Iterator[tuple]:
        store, root = _store(self.folder)
        for position in range(partition.start, partition.end):
            with store.open_input_stream(self._file(root, position)) as file:
                entry = json.loads(file.read().decode().splitlines()[-1])
            yield entry["position"], entry["load_id"], entry["folder"], entry["kind"]


class LedgerSource(DataSource):
    digits = ledger.DIGITS

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return LedgerReader(self.options, self.digits)


def stream_slices(spark: SparkSession, path: str, start: int = 0, most: int | None = None) -> DataFrame:
    """Streaming (position, load_id, folder, kind) of the slices committed to the layer table at ``path``."""
    spark.dataSource.register(LedgerSource)
    options = {"ledger": f"{path.rstrip('/')}/{ledger.LEDGER}", "from": str(start), "most": str(most or 0)}
    return spark.readStream.format(NAME).options(**options).load()
