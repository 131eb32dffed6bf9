"""Parquet inputs and stored feature tables."""

from __future__ import annotations

import os
import re
from collections.abc import Sequence
from datetime import date, datetime
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seatflow.operators.ordering import keep_last
from seatflow.schemas import TRAFFIC_KEY, FeatureTable

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def parquet_files(spark: SparkSession, directory: str) -> list[str]:
    """Paths of the `*.parquet` files in a directory; none is an error."""
    try:
        reader = spark.read.schema("path string").option("pathGlobFilter", "*.parquet")
        files = sorted(unquote(name) for name in reader.parquet(directory).inputFiles())
    except AnalysisException as missing:
        raise FileNotFoundError(f"no such directory: {directory}") from missing
    if not files:
        raise FileNotFoundError(f"no parquet files in {directory}")
    return files


def _plain_path(uri: Column) -> Column:
    """A file URI without its percent escapes; a plus sign is itself there."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def union_parquets(spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """Rows of all files by column name, with `_file_seq` and `_row_seq` giving their order.

    Without a schema the files' own ones are merged, which reads every footer once more.
    """
    if not paths:
        raise ValueError("no parquet files given")
    places = {re.sub(_SCHEME, "", p if re.match(_SCHEME, p) else os.path.abspath(p)): i for i, p in enumerate(paths)}
    order = spark.createDataFrame(list(places.items()), "_path string, _file_seq int")
    reader = spark.read.option("mergeSchema", "true") if schema is None else spark.read.schema(schema)
    rows = reader.parquet(*paths)
    columns = rows.columns
    rows = rows.select(
        "*",
        F.regexp_replace(_plain_path(F.col("_metadata.file_path")), _SCHEME, "").alias("_path"),
        F.col("_metadata.row_index").alias("_row_seq"),
    )
    return rows.join(order, "_path", "left").select(*columns, "_file_seq", "_row_seq")


def traffic_parquets(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None
) -> DataFrame:
    """Union of hourly traffic files, the last row of each key kept."""
    rows = union_parquets(spark, paths, schema)
    return keep_last(rows, TRAFFIC_KEY, ["_file_seq", "_row_seq"]).drop("_file_seq", "_row_seq")


def feature_table(
    spark: SparkSession,
    table: FeatureTable,
    path: str,
    columns: Sequence[str] | None = None,
    since: str | date | datetime | None = None,
    until: str | date | datetime | None = None,
) -> DataFrame:
    """A stored table, projected and bounded on event time, `until` exclusive.

    The partition column is bounded too, since a bound on event time alone prunes no directory.
    """
    return bounded(spark.read.schema(table.schema).parquet(path), table, columns, since, until)


def bounded(
    rows: DataFrame,
    table: FeatureTable,
    columns: Sequence[str] | None = None,
    since: str | date | datetime | None = None,
    until: str | date | datetime | None = None,
) -> DataFrame:
    """What `feature_table` reads, of rows from anywhere."""
    if since is not None:
        rows = rows.where(F.col("event_time") >= F.lit(str(since)).cast("timestamp_ntz"))
        if table.partition:
            rows = rows.where(F.col(table.partition) >= str(since)[:10])
    if until is not None:
        rows = rows.where(F.col("event_time") < F.lit(str(until)).cast("timestamp_ntz"))
        if table.partition:
            rows = rows.where(F.col(table.partition) <= str(until)[:10])
    return rows.select(*(columns or table.schema.names))


def table_exists(spark: SparkSession, path: str, schema: T.StructType) -> bool:
    try:
        spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return False
        raise
    return True


def has_rows(df: DataFrame, column: str = "date") -> bool:
    """Whether a table holds anything, reading one column of one row."""
    return not df.select(column).isEmpty()


def split_frames(spark: SparkSession, path: str, version: int) -> tuple[DataFrame, DataFrame]:
    """The train and test frames of a stored split."""
    folder = f"{path}/version={version}"
    return spark.read.parquet(f"{folder}/train"), spark.read.parquet(f"{folder}/test")


def past_export(spark: SparkSession, path: str) -> DataFrame:
    """The joined past table written by the export job."""
    return spark.read.parquet(path)
