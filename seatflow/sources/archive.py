"""Snapshot archives as a data source: a partition per day and hour, sampled and read where it is scanned.

Files lie in `root/YYYY/MM/DD/HH/<name>.pb`. The driver lists folders, never files: bounds on `date` reach the reader, so
only the hours of the wanted days become partitions. The task of an hour lists its own folder, picks evenly spaced names,
and opens those alone. The archive is any store that Arrow reads by URI.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from datetime import date, datetime, timedelta

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

from seatflow.schemas import SNAPSHOTS_PER_HOUR

FORMAT = "snapshot_archive"
_SUFFIX = ".pb"


def evenly_picked(names: list[str], k: int | None) -> list[str]:
    """k evenly spaced names, both ends included; all when there are no more, or no `k`. The same places as `evenly_spaced`."""
    n = len(names)
    if k is None or n <= k:
        return names
    if k <= 1:
        return names[:k]
    return [names[i] for i in sorted({round(place * (n - 1) / (k - 1)) for place in range(k)})]


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    store, path = fs.FileSystem.from_uri(uri)
    return store, path.rstrip("/")


def _names(store: fs.FileSystem, folder: str, kind: fs.FileType) -> list[str]:
    found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted(info.base_name for info in found if info.type == kind)


class Hour(InputPartition):
    """One folder of an hour."""

    def __init__(self, day: date, hour: int, folder: str):
        super().__init__((day, hour))
        self.day, self.hour, self.folder = day, hour, folder


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["path"]
        self.k = int(options["k"]) if options.get("k") else None
        self.contents = options.get("contents", "true").lower() == "true"
        self.first: date | None = None
        self.last: date | None = None
        self.days: set[date] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes bounds on `date`; the others, and NULLs, stay with Spark."""
        for one in filters:
            value = getattr(one, "value", None)
            on_date = getattr(one, "attribute", None) == ("date",)
            if on_date and isinstance(one, EqualTo) and isinstance(value, date):
                self.days = {value} if self.days is None else self.days & {value}
            elif on_date and isinstance(one, In) and all(isinstance(v, date) for v in value):
                self.days = set(value) if self.days is None else self.days & set(value)
            elif on_date and isinstance(one, (GreaterThan, GreaterThanOrEqual)) and isinstance(value, date):
                low = value + timedelta(days=isinstance(one, GreaterThan))
                self.first = low if self.first is None else max(self.first, low)
            elif on_date and isinstance(one, (LessThan, LessThanOrEqual)) and isinstance(value, date):
                high = value - timedelta(days=isinstance(one, LessThan))
                self.last = high if self.last is None else min(self.last, high)
            else:
                yield one

    def _wanted(self, day: date) -> bool:
        return (self.days is None or day in self.days) and not (self.first and day < self.first) and not (self.last and day > self.last)

    def _day_folders(self, store: fs.FileSystem, root: str) -> Iterator[tuple[date, str]]:
        """The wanted days that are there; with bounds on both sides, no other folder is looked at."""
        if self.days is not None or (self.first and self.last):
            span = sorted(self.days) if self.days is not None else [
                self.first + timedelta(days=i) for i in range((self.last - self.first).days + 1)]
            yield from ((day, f"{root}/{day:%Y/%m/%d}") for day in span if self._wanted(day))
            return
        for year in _names(store, root, fs.FileType.Directory):
            for month in _names(store, f"{root}/{year}", fs.FileType.Directory):
                for number in _names(store, f"{root}/{year}/{month}", fs.FileType.Directory):
                    try:
                        day = datetime.strptime(f"{year}/{month}/{number}", "%Y/%m/%d").date()
                    except ValueError:
                        continue
                    if self._wanted(day):
                        yield day, f"{root}/{year}/{month}/{number}"

    def partitions(self) -> list[Hour]:
        store, root = _opened(self.root)
        return [
            Hour(day, int(name), f"{folder}/{name}")
            for day, folder in self._day_folders(store, root)
            for name in _names(store, folder, fs.FileType.Directory) if name.isdigit() and int(name) < 24
        ]

    def read(self, partition: Hour | None) -> Iterator[tuple]:
        if partition is None:  # no hour is wanted
            return
        store, _ = _opened(self.root)
        names = [n for n in _names(store, partition.folder, fs.FileType.File) if n.endswith(_SUFFIX)]
        for name in evenly_picked(names, self.k):
            path = f"{partition.folder}/{name}"
            if self.contents:
                with store.open_input_file(path) as file:
                    yield path, partition.day, partition.hour, file.read()
            else:
                yield path, partition.day, partition.hour, None


class SnapshotArchive(DataSource):
    """Options: `path`, `k` (files per hour, all without), `contents` (false lists names only)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "path string, date date, hour int, content binary"

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(dict(self.options))


def _scan(spark: SparkSession, root: str, k: int | None, contents: bool, first: date | None, last: date | None) -> DataFrame:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SnapshotArchive)
    reader = spark.read.format(FORMAT).option("contents", str(contents).lower())
    rows = (reader if k is None else reader.option("k", str(k))).load(root)
    if first is not None:
        rows = rows.where(F.col("date") >= F.lit(first))
    return rows if last is None else rows.where(F.col("date") <= F.lit(last))


def archived_snapshots(
    spark: SparkSession, root: str, first: date | None = None, last: date | None = None, k: int | None = SNAPSHOTS_PER_HOUR
) -> DataFrame:
    """(path, date, hour, content) of `k` evenly spaced files of every hour of the days first..last; no other file is opened."""
    return _scan(spark, root, k, True, first, last)


def archived_names(spark: SparkSession, root: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """(path, date, hour) of all files of these days, listed by the tasks; no file is opened."""
    return _scan(spark, root, None, False, first, last).select("path", "date", "hour")
