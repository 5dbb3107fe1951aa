"""SQLite files as tables: ranges of row ids are partitions, filters go to the database.

The files must be on a path that all machines see (a mounted share); SQLite reads no other store.
"""

from __future__ import annotations

import os
import re
import sqlite3
from collections.abc import Iterator
from contextlib import closing
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not

#: Rows of a partition, and of an Arrow batch.
PARTITION_ROWS, BATCH_ROWS = 1_000_000, 10_000
#: Declared types of columns, by the words that stand in them, in this order.
AFFINITIES = [("INT", "bigint"), ("CHAR", "string"), ("CLOB", "string"), ("TEXT", "string"), ("BLOB", "binary"), ("REAL", "double"), ("FLOA", "double"), ("DOUB", "double")]
COMPARED = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def local(path: str) -> str:
    return re.sub(r"^file:/+", "/", path)


def connected(path: str) -> sqlite3.Connection:
    """Read-only."""
    return sqlite3.connect(f"file:{quote(local(path))}?mode=ro", uri=True)


def name(text: str) -> str:
    return '"' + text.replace('"', '""') + '"'


def databases(path: str) -> list[str]:
    """A file, or all files of a folder."""
    path = local(path)
    if not os.path.isdir(path):
        return [path]
    found = sorted(os.path.join(path, f) for f in os.listdir(path) if not f.startswith((".", "_")) and not f.endswith(("-journal", "-wal", "-shm")))
    if not found:
        raise FileNotFoundError(f"no database in {path}")
    return found


@dataclass
class Rows(InputPartition):
    path: str
    first: int | None
    last: int | None


class SqliteRanges(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.table, self.schema = options["path"], options["table"], schema
        self.rows = int(options.get("partitionrows", PARTITION_ROWS))
        self.where: list[str] = []
        self.values: list = []

    def partitions(self) -> list[InputPartition]:
        """Ranges of row ids of each file, from the ends of its index; tables and views without row ids are one partition."""
        out: list[InputPartition] = []
        for path in databases(self.path):
            with closing(connected(path)) as db:
                there = {c[1].lower() for c in db.execute(f"PRAGMA table_info({name(self.table)})")}
                if missing := [c for c in self.schema.names if c.lower() not in there]:  # SQLite would read a quoted name that it doesn't know as a text
                    raise ValueError(f"no such column in {self.table} of {path}: {', '.join(missing)}" if there else f"no table {self.table} in {path}")
                try:
                    least, most = db.execute(f"SELECT (SELECT min(rowid) FROM {name(self.table)}), (SELECT max(rowid) FROM {name(self.table)})").fetchone()
                except sqlite3.OperationalError as e:
                    if "rowid" not in str(e):
                        raise
                    out.append(Rows(path, None, None))
                    continue
            if least is not None:
                out += [Rows(path, a, min(a + self.rows - 1, most)) for a in range(least, most + 1, self.rows)]
        return out or [Rows(databases(self.path)[0], 1, 0)]

    def read(self, partition: Rows) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(self.schema)
        where = [*self.where, *(["rowid BETWEEN ? AND ?"] if partition.first is not None else [])]
        values = [*self.values, *([partition.first, partition.last] if partition.first is not None else [])]
        with closing(connected(partition.path)) as db:
            rows = db.execute(f"SELECT {', '.join(map(name, schema.names))} FROM {name(self.table)}" + (f" WHERE {' AND '.join(where)}" if where else ""), values)
            while some := rows.fetchmany(BATCH_ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)


class SqliteReader(SqliteRanges):
    """The same with filters; Spark refuses a reader that takes filters where the session does not allow it."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Comparisons of columns with numbers and texts go to the database; the others are yielded, for Spark to do."""
        kinds = {f.name: f.dataType for f in self.schema}
        for f in filters:
            plain, wanted = (f.child, "NOT ") if isinstance(f, Not) else (f, "")
            values = list(plain.value) if isinstance(plain, In) else [plain.value] if type(plain) in COMPARED else []
            path = getattr(plain, "attribute", ())
            known = len(path) == 1 and isinstance(kinds.get(path[0]), (T.LongType, T.DoubleType, T.StringType)) and all(isinstance(v, (int, float, str)) for v in values)
            if known and type(plain) in COMPARED:
                self.where.append(f"{wanted}({name(path[0])} {COMPARED[type(plain)]} ?)")
            elif known and isinstance(plain, In) and len(values) < 500:
                self.where.append(f"{wanted}({name(path[0])} IN ({', '.join('?' * len(values))}))")
            elif known and isinstance(plain, (IsNull, IsNotNull)):
                self.where.append(f"{wanted}({name(path[0])} IS {'NOT ' * isinstance(plain, IsNotNull)}NULL)")
            else:
                yield f
                continue
            self.values += values


class SqliteSource(DataSource):
    """``spark.read.format("sqlite")`` with options path and table, partitionRows, and filters (true: they go to the database)."""

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> str:
        with closing(connected(databases(self.options["path"])[0])) as db:
            columns = db.execute(f"PRAGMA table_info({name(self.options['table'])})").fetchall()
        if not columns:
            raise ValueError(f"no table {self.options['table']} in {self.options['path']}")
        kind = lambda declared: next((t for word, t in AFFINITIES if word in declared.upper()), "string")
        return ", ".join(f"`{c[1].replace('`', '``')}` {kind(c[2])}" for c in columns)

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return (SqliteReader if self.options.get("filters") == "true" else SqliteRanges)(self.options, schema)


def registered(spark: SparkSession) -> None:
    """Spark looks for a source of the same name in the active session, so that must be the one that registers it."""
    sessions = spark._jvm.org.apache.spark.sql.classic.SparkSession
    before = sessions.getActiveSession()
    sessions.setActiveSession(spark._jsparkSession)
    try:
        spark.dataSource.register(SqliteSource)
    finally:
        if before.isDefined():
            sessions.setActiveSession(before.get())


def scan_sqlite(spark: SparkSession, path: str, table: str, columns: dict[str, str] | None = None, partition_rows: int = PARTITION_ROWS) -> DataFrame:
    """A table of one SQLite file, or of all files of a folder, read by ranges of ``partition_rows`` row ids.

    ``columns``: names and types to read; only these are asked for. Without it all columns come, by their declared types. Filters
    are done by the database where the session's ``spark.sql.python.filterPushdown.enabled`` allows it. A value that its column's
    type can't hold, a missing table and a missing column end the read.
    """
    registered(spark)
    allowed = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    reader = spark.read.format("sqlite").option("filters", allowed.lower()).option("path", path).option("table", table).option("partitionRows", str(partition_rows))
    return (reader.schema(", ".join(f"`{c}` {kind}" for c, kind in columns.items())) if columns else reader).load()
