"""A batch data source over SQLite files: ``spark.read.format("sqlite_table").option("path", f).option("table", t)``.

The rows are read in ranges of rowid, one range a task; the file must be
reachable under the same path on every executor.
"""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import BinaryType, BooleanType, DoubleType, LongType, StringType, StructField, StructType

_TYPES = {"INTEGER": LongType(), "INT": LongType(), "BIGINT": LongType(), "REAL": DoubleType(), "BLOB": BinaryType(), "BOOLEAN": BooleanType()}


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


class SqliteTable(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite_table"

    def schema(self) -> StructType:
        with sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True) as con:
            columns = con.execute(f"PRAGMA table_info({_quoted(self.options['table'])})").fetchall()
        if not columns:
            raise ValueError(f"no table {self.options['table']}")
        return StructType([StructField(c[1], _TYPES.get(c[2].upper().split("(")[0], StringType())) for c in columns])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options, schema)


class _Reader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType) -> None:
        self.path, self.table, self.schema = options["path"], options["table"], schema
        self.parts = int(options.get("partitions", "8"))

    def partitions(self) -> list[InputPartition]:
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as con:
            low, high = con.execute(f"SELECT min(rowid), max(rowid) FROM {_quoted(self.table)}").fetchone()
        if low is None:
            return [InputPartition((0, 0))]
        step = max(1, -(-(high - low + 1) // self.parts))
        return [InputPartition((a, min(a + step, high + 1))) for a in range(low, high + 1, step)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        names = ", ".join(_quoted(f.name) for f in self.schema.fields)
        kinds = [f.dataType for f in self.schema.fields]
        convert = {StringType(): str, BooleanType(): bool, DoubleType(): float, LongType(): int}
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as con:
            for row in con.execute(f"SELECT {names} FROM {_quoted(self.table)} WHERE rowid >= ? AND rowid < ?", partition.value):
                yield tuple(v if v is None else convert.get(k, lambda x: x)(v) for v, k in zip(row, kinds, strict=True))


def tables(path: str) -> dict[str, list[str]]:
    """The tables of a file and their columns."""
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as con:
        names = [r[0] for r in con.execute("SELECT name FROM sqlite_master WHERE type = 'table' ORDER BY name")]
        return {n: [c[1] for c in con.execute(f"PRAGMA table_info({_quoted(n)})")] for n in names}


def read_sqlite(spark: SparkSession, path: str, table: str, partitions: int = 8):
    spark.dataSource.register(SqliteTable)
    return spark.read.format("sqlite_table").option("path", path).option("table", table).option("partitions", str(partitions)).load()
