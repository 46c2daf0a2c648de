"""Published tables as versions, all committed by one appended row.

    root/<table>/version=<v>/<partition columns>/...   rows written by run v; never overwritten
    root/_maps/<table>/<v>/                            which version holds each partition, after run v
    root/control/                                      one appended row per commit
    root/_work/<v>/                                    intermediate tables of run v

A run writes only into folders that carry its own version, so a reader never sees a half-written
table and a failed run can simply be repeated: what it left is named by no commit. The control row
holds, for every table, the map that is current, and the high-water mark; appending it (one file,
moved into place by Spark's job commit) publishes all tables together.

A map has one row per partition: the partition values, the folder that holds its rows (of the version that
wrote it) and their count; an unpartitioned table has one row per version. A run that rewrites some
partitions writes these only and a new map; the others keep pointing at older versions. A partition without
rows has no map row, so an emptied partition disappears.

A table is read from the folders in its map, and from no others: the driver gets one folder name per live
partition, as many as Spark's own file index holds. What older runs have left is neither listed nor read;
its folders can be deleted by age, once no reader needs the commits that name them.

One run at a time may write a root.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce
from typing import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from starloom.session import written
from starloom.sources.io import WriteMode, delete_path, path_exists, read_table, write_table

CONTROL_SCHEMA = (
    "mark_key string, mark_value timestamp_ntz, seq bigint, version string, "
    "tables map<string,struct<map:string,schema:string,parts:array<string>,fmt:string>>, committed_at timestamp"
)
_ENTRY = "map<string,struct<map:string,schema:string,parts:array<string>,fmt:string>>"

FOLDER, ROWS = "__folder", "__rows"

#: Called instead of a run's write with the table, its rows and the function that writes them.
OnWrite = Callable[[str, DataFrame, Callable[[DataFrame], None]], None]


@dataclass(frozen=True)
class Entry:
    """Where a commit finds a table."""

    map: str
    schema: str  # JSON
    parts: tuple[str, ...] = ()
    fmt: str = "parquet"

    @property
    def fields(self) -> StructType:
        import json

        return StructType.fromJson(json.loads(self.schema))

    def map_schema(self) -> StructType:
        table = self.fields
        fields = [StructField(c, table[c].dataType) for c in self.parts] + [StructField(FOLDER, StringType()), StructField(ROWS, LongType())]
        return StructType(fields)


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def _null_safe(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> Column:
    return _all([left[c].eqNullSafe(right[c]) for c in cols])


class Store:
    """The committed tables below one root."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt
        self.control_path = f"{self.root}/control"
        self.seq, self.tables = 0, {}
        head = self._head()
        if head is not None:
            self.seq = head["seq"]
            self.tables = {
                name: Entry(e["map"], e["schema"], tuple(e["parts"] or ()), e["fmt"]) for name, e in (head["tables"] or {}).items()
            }

    def control(self) -> DataFrame | None:
        if not path_exists(self.spark, self.control_path):
            return None
        return self.spark.read.schema(CONTROL_SCHEMA).parquet(self.control_path)

    def _head(self) -> Row | None:
        control = self.control()
        return None if control is None else control.orderBy(F.desc("seq")).select("seq", "tables").first()

    def has(self, table: str) -> bool:
        return table in self.tables

    def map_of(self, table: str, entry: Entry | None = None) -> DataFrame:
        entry = entry or self.tables[table]
        return self.spark.read.schema(entry.map_schema()).parquet(f"{self.root}/_maps/{table}/{entry.map}")

    def read(self, table: str, within: DataFrame | None = None) -> DataFrame:
        """The committed rows; ``within`` (rows of the map) reads these partitions only."""
        entry = self.tables[table]
        fields = entry.fields
        live = (self.map_of(table) if within is None else within).select(FOLDER).collect()  # one per live partition
        if not live:
            return self.spark.createDataFrame([], fields)
        base = f"{self.root}/{table}"
        schema = StructType([*fields.fields, StructField("version", StringType())])
        rows = read_table(self.spark, [f"{base}/{unquote(r[0])}" for r in live], entry.fmt, schema, options={"basePath": base})
        return rows.select(*fields.fieldNames())

    def begin(self, on_write: OnWrite | None = None) -> "Run":
        return Run(self, on_write=on_write)


@dataclass
class Run:
    """The writes of one run; invisible until ``commit``."""

    store: Store
    version: str = ""
    entries: dict[str, Entry] = field(default_factory=dict)
    on_write: OnWrite | None = None

    def __post_init__(self) -> None:
        self.version = f"{self.store.seq + 1:08d}-{uuid.uuid4().hex[:8]}"

    @property
    def spark(self) -> SparkSession:
        return self.store.spark

    def work(self, df: DataFrame, name: str) -> DataFrame:
        """An intermediate table of this run."""
        return written(df, f"{self.store.root}/_work/{self.version}/{name}-{uuid.uuid4().hex[:6]}")

    def _write(self, table: str, df: DataFrame, parts: Sequence[str], fmt: str | None) -> tuple[Entry, DataFrame]:
        """Write the rows of this version once; returns the entry and its map rows. The files of an
        unpartitioned table are not read again."""
        entry = Entry(self.version, df.schema.json(), tuple(parts), fmt or self.store.fmt)
        folder = f"version={self.version}"
        path = f"{self.store.root}/{table}/{folder}"

        def save(rows: DataFrame) -> None:
            write_table(rows, path, fmt=entry.fmt, mode=WriteMode.ERROR_IF_EXISTS, partition_by=list(parts) or None)

        if self.on_write is None:
            save(df)
        else:
            self.on_write(table, df, save)
        if not parts:
            return entry, self.spark.range(1).select(F.lit(folder).alias(FOLDER), F.lit(None).cast("bigint").alias(ROWS))
        back = read_table(self.spark, path, entry.fmt, entry.fields)
        inside = F.regexp_extract("_metadata.file_path", rf"({folder}(?:/[^/]+)*)/[^/]+$", 1)
        rows = back.select(*parts, inside.alias(FOLDER)).groupBy(*parts, FOLDER).agg(F.count(F.lit(1)).alias(ROWS))
        return entry, rows.select(*[f.name for f in entry.map_schema().fields])

    def _publish(self, table: str, entry: Entry, rows: DataFrame) -> None:
        rows.coalesce(1).write.parquet(f"{self.store.root}/_maps/{table}/{self.version}")
        self.entries[table] = entry

    def replace(self, table: str, df: DataFrame, parts: Sequence[str] = (), fmt: str | None = None) -> None:
        """The whole table is ``df``."""
        self._publish(table, *self._write(table, df, parts, fmt))

    def rewrite(self, table: str, df: DataFrame, touched: DataFrame, parts: Sequence[str], fmt: str | None = None) -> None:
        """The partitions in ``touched`` (distinct partition values) become ``df``; the others stay."""
        entry, rows = self._write(table, df, parts, fmt)
        if self.store.has(table):
            kept = self.store.map_of(table)
            rows = kept.join(touched, _null_safe(kept, touched, parts), "left_anti").unionByName(rows)
        self._publish(table, entry, rows)

    def append(self, table: str, df: DataFrame, fmt: str | None = None) -> None:
        """The rows of ``df`` join those of an unpartitioned table."""
        entry, rows = self._write(table, df, (), fmt)
        if self.store.has(table):
            rows = self.store.map_of(table).unionByName(rows)
        self._publish(table, entry, rows)

    def rows_of(self, table: str) -> int:
        """Rows of a partitioned table that this run has written, from its map."""
        return self.store.map_of(table, self.entries[table]).agg(F.coalesce(F.sum(ROWS), F.lit(0))).first()[0]

    def commit(self, mark_key: str, mark: DataFrame | None = None) -> None:
        """Append the control row. ``mark`` is one row ``mark_value`` that never leaves Spark, so no
        time zone of the driver can touch it."""
        entries = {**self.store.tables, **self.entries}
        rows = {n: Row(map=e.map, schema=e.schema, parts=list(e.parts), fmt=e.fmt) for n, e in entries.items()}
        tables = self.spark.createDataFrame([(rows,)], f"tables {_ENTRY}")
        value = F.lit(None).cast("timestamp_ntz") if mark is None else mark.select("mark_value").scalar().cast("timestamp_ntz")
        row = tables.select(
            F.lit(mark_key).alias("mark_key"), value.alias("mark_value"), F.lit(self.store.seq + 1).cast("bigint").alias("seq"),
            F.lit(self.version).alias("version"), "tables", F.current_timestamp().alias("committed_at"),
        )
        write_table(row.coalesce(1), self.store.control_path, mode=WriteMode.APPEND, rebalance=False)
        self.close()

    def close(self) -> None:
        delete_path(self.spark, f"{self.store.root}/_work/{self.version}")
