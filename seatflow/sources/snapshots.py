"""Vehicle snapshot files: listing and decoding."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from datetime import date
from functools import reduce

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seatflow.runtime import stored
from seatflow.schemas import VEHICLES

# Field numbers and types of the public realtime feed format that are read here.
_MESSAGES = {
    "Feed": [("header", 1, "Header"), ("entity", 2, "[Entity]")],
    "Header": [("timestamp", 3, "uint64")],
    "Entity": [("id", 1, "string"), ("vehicle", 4, "Vehicle")],
    "Vehicle": [("trip", 1, "Trip"), ("timestamp", 5, "uint64"), ("occupancy_status", 9, "int32")],
    "Trip": [("trip_id", 1, "string"), ("route_id", 5, "string")],
}


LANDED = "path string, content binary, hour int, date date"


def path_hour(path: str | Column) -> Column:
    """Hour directory of `.../YYYY/MM/DD/HH/<file>.pb`, NULL when it is not a number."""
    return F.element_at(F.split(path, "/"), -2).try_cast("int")


def path_date(path: str | Column) -> Column:
    """Day directories of the same layout, as a date; NULL when they are not one."""
    path = F.col(path) if isinstance(path, str) else path
    return F.try_to_date(F.left(F.substring_index(path, "/", -5), F.lit(10)), "yyyy/MM/dd")


def with_path_clock(paths: DataFrame) -> DataFrame:
    return paths.withColumns({"date": path_date("path"), "hour": path_hour("path")})


def _files(spark: SparkSession, root: str, days: Sequence[str | date] | None) -> DataFrame | None:
    """The `*.pb` files below root, or below the folders of `days` that are there."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.pb")
    if days is None:
        return reader.load(root)
    found = []
    for day in days:
        try:
            found.append(reader.load(f"{root.rstrip('/')}/{str(day).replace('-', '/')}"))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return reduce(DataFrame.union, found) if found else None


def list_snapshots(spark: SparkSession, root: str, days: Sequence[str | date] | None = None) -> DataFrame:
    """(path, date, hour) of every `*.pb` below root, or of the given days only.

    Only `path` is read, no file contents, and with `days` no other day's folder is listed.
    """
    files = _files(spark, root, days)
    paths = spark.createDataFrame([], "path string") if files is None else files.select("path")
    return with_path_clock(paths)


def land_snapshots(spark: SparkSession, root: str, days: Sequence[str | date], table: str) -> None:
    """Copy the files of some days into a (path, content, hour) table by day, one folder a time.

    After that nothing depends on the number of files: sampling reads the table's paths, and decoding reads the
    contents that are wanted, on the executors and of the wanted days alone. A day that is landed again replaces itself.
    """
    for day in days:
        files = _files(spark, root, [day])
        if files is not None:
            rows = with_path_clock(files.select("path", "content")).where(F.col("date") == F.lit(str(day)).cast("date"))
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(table)


def landed(spark: SparkSession, table: str) -> DataFrame:
    """The (path, content, hour, date) rows of such a table."""
    return spark.read.schema(LANDED).parquet(table)


def snapshots_by_hour(listing: DataFrame) -> DataFrame:
    """Files per (date, hour)."""
    return listing.groupBy("date", "hour").agg(F.count("*").alias("n_files"))


def read_contents(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """(path, content) of the named files."""
    return spark.read.format("binaryFile").load(list(paths)).select("path", "content")


def read_chosen(spark: SparkSession, chosen: DataFrame) -> DataFrame:
    """Decoded vehicles of the sampled files, and of no other file.

    A join cannot keep the file source from opening the files it drops, so the names go to the
    reader, whose file index lives on the driver anyway. They come one partition at a time. For long
    histories land the days first (`land_snapshots`) and read the table.
    """
    names = [row.path for row in stored(chosen.select("path"), "chosen").toLocalIterator()]
    if not names:
        return spark.createDataFrame([], VEHICLES)
    return decode_snapshots(read_contents(spark, names))


def feed_message():
    """Message class for `_MESSAGES`, built in code as the feed's own bindings are not installed."""
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

    kinds = {"uint64": 4, "int32": 5, "string": 9, "message": 11}
    file = descriptor_pb2.FileDescriptorProto(name="seatflow_feed.proto", package="seatflow", syntax="proto2")
    for message, fields in _MESSAGES.items():
        built = file.message_type.add(name=message)
        for name, number, kind in fields:
            repeated, kind = kind.startswith("["), kind.strip("[]")
            one = built.field.add(name=name, number=number, label=3 if repeated else 1)
            one.type = kinds.get(kind, kinds["message"])
            if kind in _MESSAGES:
                one.type_name = f".seatflow.{kind}"
    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName("seatflow.Feed"))


def decode_snapshots(files: DataFrame) -> DataFrame:
    """One row per feed entity of (path, content) rows; a file that cannot be read gives one error row."""
    names = VEHICLES.names

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        feed_type = feed_message()
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"]):
                rows.extend(_entities(feed_type, path, bytes(content)))
            frame = pd.DataFrame(rows, columns=names)
            yield frame.astype({"header_ts": "Int64", "vehicle_ts": "Int64", "occupancy_status": "Int32"})

    return files.select("path", "content").mapInPandas(decode, VEHICLES)


def _entities(feed_type, path: str, content: bytes) -> list[tuple]:
    try:
        feed = feed_type.FromString(content)
    except Exception as error:  # a damaged file must not stop the other days
        return [(path, None, False, None, None, None, None, f"{type(error).__name__}: {error}")]
    header = feed.header.timestamp or None
    rows = []
    for entity in feed.entity:
        vehicle = entity.vehicle
        rows.append((
            path,
            header,
            entity.HasField("vehicle"),
            vehicle.timestamp if vehicle.HasField("timestamp") else None,
            vehicle.trip.trip_id,
            vehicle.trip.route_id,
            vehicle.occupancy_status if vehicle.HasField("occupancy_status") else None,
            None,
        ))
    return rows
