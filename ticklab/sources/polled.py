"""A polled tick table as a stream (S4, O6, R1): a Python streaming data source with offsets of its own.

A poll reads the rows after the mark, oldest first, at most ``limit`` of them. The mark is a pair (time, tick id), so
rows that share a time are neither lost nor read twice where a poll ends between them; rows that share both are
read in one poll, over the limit if need be. The end of a poll is the stream's offset, kept in the query's
checkpoint: a stopped query goes on after its last poll, and a batch that failed is read again between the same marks.

* Planning looks at the key columns only, of the row groups that can hold the next ``limit`` rows (Parquet
  statistics, ``event_date`` folders), and keeps ``limit`` keys at most.
* Reading is one task per about 128 MB of row groups; no row passes through the driver.

Defined cases: rows without a time are never read; a null id is the first of its time; with ``quotes`` only rows with
a positive bid and ask are read and counted (as ``read_since``); columns that a file lacks are null, others are left
out; times without a zone are UTC. A row that arrives after a poll has passed its place is not read: ``delay``
seconds keep the polls that far behind the newest time, for feeds that are late by no more. An empty or missing folder
gives an empty stream until files come. Files and folders whose names start with ``_`` or ``.`` are not there yet.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ticklab.schema import TICKS

LIMIT = 1_000_000
TASK_BYTES = 128 << 20
FIRST = -(1 << 63)  # the id of a row without one, and the time before all times


class RowGroup(NamedTuple):
    file: str
    index: int
    low: int
    high: int
    nbytes: int


class Slice(InputPartition):
    """Row groups of one task, and the marks between which it reads."""

    def __init__(self, groups: list[RowGroup], start: tuple[int, int], end: tuple[int, int]):
        self.groups, self.start, self.end = groups, start, end


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path in it; Hadoop's ``file:/x`` is a local path."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))


def micros(times: pa.ChunkedArray | pa.Array) -> pa.Array:
    zone = "UTC" if pa.types.is_timestamp(times.type) and times.type.tz else None
    return times.cast(pa.timestamp("us", zone), safe=False).cast(pa.int64())


def _keys(rows: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(time, id, has a time) of every row."""
    names = rows.schema.names
    ts = micros(rows.column("event_time")) if "event_time" in names else pa.nulls(rows.num_rows, pa.int64())
    ids = rows.column("tick_id").cast(pa.int64()) if "tick_id" in names else pa.nulls(rows.num_rows, pa.int64())
    return ts.fill_null(0).to_numpy(zero_copy_only=False), ids.fill_null(FIRST).to_numpy(zero_copy_only=False), ts.is_valid().to_numpy(zero_copy_only=False)


def _after(ts: np.ndarray, ids: np.ndarray, mark: tuple[int, int]) -> np.ndarray:
    return (ts > mark[0]) | ((ts == mark[0]) & (ids > mark[1]))


def _quoted(rows: pa.RecordBatch | pa.Table) -> np.ndarray:
    keep = np.ones(rows.num_rows, bool)
    for name in ("bid_price", "ask_price"):
        if name not in rows.schema.names:
            return np.zeros(rows.num_rows, bool)
        price = rows.column(name).cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False)
        keep &= (price > 0)  # NaN is no price
    return keep


class PolledReader(DataSourceStreamReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.limit = options["path"], int(options.get("limit", LIMIT))
        if self.limit < 1:
            raise ValueError("limit: at least one row a poll")
        self.quotes = str(options.get("quotes", "true")).lower() == "true"
        self.delay = int(float(options.get("delay", 0)) * 1_000_000)
        self.since = int(options.get("since", FIRST))
        self.schema = schema
        self.at: tuple[int, int] | None = None  # where the next poll begins
        self.footers: dict[tuple, list[RowGroup]] = {}

    # ---------------------------------------------------------------- offsets
    def initialOffset(self) -> dict:
        return {"ts": self.since, "id": (1 << 63) - 1 if self.since > FIRST else FIRST}

    def latestOffset(self) -> dict:
        """The end of the next poll. Spark tells where it begins by the last call of ``partitions``, also when a query
        starts again from its checkpoint."""
        start = self.at or _mark(self.initialOffset())
        groups = sorted((g for g in self._row_groups(start[0]) if g.high >= start[0]), key=lambda g: g.low)
        last = max((g.high for g in groups), default=FIRST) - self.delay
        ts, ids = np.empty(0, np.int64), np.empty(0, np.int64)
        for g in groups:
            if g.low > last or (len(ts) == self.limit and g.low > ts[-1]):
                break
            rows = self._read(g, ["event_time", "tick_id", "bid_price", "ask_price"])
            t, i, known = _keys(rows)
            keep = known & _after(t, i, start) & (t <= last)
            if self.quotes:
                keep &= _quoted(rows)
            ts, ids = np.concatenate([ts, t[keep]]), np.concatenate([ids, i[keep]])
            first = np.lexsort((ids, ts))[:self.limit]
            ts, ids = ts[first], ids[first]
        return {"ts": int(ts[-1]), "id": int(ids[-1])} if len(ts) else {"ts": start[0], "id": start[1]}

    # ---------------------------------------------------------------- one poll
    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        low, self.at = _mark(start), _mark(end)
        if low == self.at:
            return []
        tasks: list[list[RowGroup]] = []
        size = TASK_BYTES
        for g in self._row_groups(low[0]):
            if g.high < low[0] or g.low > self.at[0]:
                continue
            if size >= TASK_BYTES:
                tasks.append([])
                size = 0
            tasks[-1].append(g)
            size += g.nbytes
        return [Slice(t, low, self.at) for t in tasks]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(self.schema)
        fs, _ = filesystem(self.path)
        for g in partition.groups:
            with fs.open_input_file(g.file) as f:
                file = pq.ParquetFile(f)
                names = [n for n in schema.names if n in file.schema_arrow.names]
                for rows in file.iter_batches(batch_size=1 << 16, row_groups=[g.index], columns=names):
                    ts, ids, known = _keys(rows)
                    keep = known & _after(ts, ids, partition.start) & ~_after(ts, ids, partition.end)
                    if self.quotes:
                        keep &= _quoted(rows)
                    if keep.any():
                        yield _as(rows.filter(pa.array(keep)), schema)

    def commit(self, end: dict) -> None:
        """Nothing to release: files belong to the feed."""

    # ---------------------------------------------------------------- files
    def _row_groups(self, since: int) -> Iterator[RowGroup]:
        """Row groups of all files, but those in ``event_date`` folders well before ``since``; a file's footer is read once."""
        fs, base = filesystem(self.path)
        seen = {}
        for info in _files(fs, base, since):
            key = (info.path, info.size, info.mtime_ns)
            seen[key] = self.footers.get(key) or list(self._footer(fs, info.path))
            yield from seen[key]
        self.footers = seen

    def _footer(self, fs: pafs.FileSystem, name: str) -> Iterator[RowGroup]:
        with fs.open_input_file(name) as f:
            file = pq.ParquetFile(f)
            if "event_time" not in file.schema_arrow.names:
                return
            kind = file.schema_arrow.field("event_time").type
            for k in range(file.metadata.num_row_groups):
                meta = file.metadata.row_group(k)
                column = next(c for c in map(meta.column, range(meta.num_columns)) if c.path_in_schema == "event_time")
                stats = column.statistics if column.physical_type == "INT64" else None
                if stats is not None and stats.has_min_max:
                    low, high = micros(pa.array([stats.min, stats.max], kind)).to_pylist()
                else:  # Spark's INT96 times carry no statistics
                    both = pc.min_max(micros(file.read_row_group(k, ["event_time"]).column(0))).as_py()
                    low, high = both["min"], both["max"]
                if low is not None:
                    yield RowGroup(name, k, low, high, meta.total_byte_size)

    def _read(self, g: RowGroup, names: list[str]) -> pa.Table:
        fs, _ = filesystem(self.path)
        with fs.open_input_file(g.file) as f:
            file = pq.ParquetFile(f)
            return file.read_row_group(g.index, [n for n in names if n in file.schema_arrow.names]).combine_chunks()


def _mark(offset: dict) -> tuple[int, int]:
    return offset["ts"], offset["id"]


def _files(fs: pafs.FileSystem, folder: str, since: int) -> Iterator[pafs.FileInfo]:
    infos = fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
    for info in sorted(infos, key=lambda i: i.path):
        if info.base_name.startswith(("_", ".")):
            continue
        if info.type == pafs.FileType.Directory:
            day = re.fullmatch(r"event_date=(\d{4}-\d\d-\d\d)", info.base_name)
            if day and since > FIRST:
                # a day's folder may be named in another zone: one day more is read
                end = dt.datetime.fromisoformat(day[1]).replace(tzinfo=dt.timezone.utc) + dt.timedelta(days=2)
                if end.timestamp() * 1_000_000 < since:
                    continue
            yield from _files(fs, info.path, since)
        elif info.size:
            yield info


def _as(rows: pa.RecordBatch, schema: pa.Schema) -> pa.RecordBatch:
    """The rows with the columns and types of ``schema``."""
    out = []
    for field in schema:
        if field.name not in rows.schema.names:
            out.append(pa.nulls(rows.num_rows, field.type))
        elif pa.types.is_timestamp(field.type):
            out.append(micros(rows.column(field.name)).cast(field.type))
        else:
            out.append(rows.column(field.name).cast(field.type))
    return pa.RecordBatch.from_arrays(out, schema=schema)


class PolledTicks(DataSource):
    """``spark.readStream.format("polled_ticks")``; options: path, limit, since (microseconds), delay (seconds), quotes."""

    @classmethod
    def name(cls) -> str:
        return "polled_ticks"

    def schema(self) -> StructType:
        return TICKS

    def streamReader(self, schema: StructType) -> PolledReader:
        return PolledReader(dict(self.options), schema)


def poll_ticks(spark: SparkSession, path: str, limit: int = LIMIT, since: dt.datetime | None = None, delay: float = 0,
               quotes: bool = True) -> DataFrame:
    """The tick folder ``path`` as a stream of polls; one poll a trigger (``processingTime``; ``availableNow`` and ``once``
    make a single poll). ``since``: only rows strictly after it (UTC if it has no zone)."""
    spark.dataSource.register(PolledTicks)
    reader = spark.readStream.format("polled_ticks").option("path", path).option("limit", limit)
    reader = reader.option("delay", delay).option("quotes", str(quotes).lower())
    if since is not None:
        zoned = since if since.tzinfo else since.replace(tzinfo=dt.timezone.utc)
        reader = reader.option("since", (zoned - dt.datetime.fromtimestamp(0, dt.timezone.utc)) // dt.timedelta(microseconds=1))
    return reader.load()
