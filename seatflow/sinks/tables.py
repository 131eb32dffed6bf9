"""Parquet outputs and keyed feature tables (K1, K2, K6, K8)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatflow.operators.ordering import first_per, interleaved
from seatflow.runtime import held
from seatflow.schemas import TRAFFIC_COLUMNS, FeatureTable
from seatflow.sources.tables import table_exists

#: The one partition of a table that has none.
_WHOLE = "_whole"


def save_hourly(rows: DataFrame, path: str) -> bool:
    """Hourly rows as snappy parquet in their fixed column order; nothing is written for no rows (K1)."""
    if rows.isEmpty():
        return False
    rows.select(*TRAFFIC_COLUMNS).write.option("compression", "snappy").parquet(path)
    return True


def conform(df: DataFrame, table: FeatureTable) -> DataFrame:
    """Columns, order, types and comments of a table (K8)."""
    return df.select(*[
        F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in table.described().fields
    ])


def upsert(
    incoming: DataFrame,
    table: FeatureTable,
    path: str,
    merge: Callable[[DataFrame, FeatureTable, str], None] | None = None,
) -> None:
    """Insert rows, replacing those with the same key (K2).

    Only the partitions that the incoming rows touch are read and rewritten, and an old partition
    stays until its new one is written; a table without partitions is kept as a single one. Of incoming
    rows with the same key the greatest in the order of their columns counts; NULL is a value of a key, and of a partition, like
    others. What is left of the incoming rows is held once, so they are worked out once whatever they come from. Plain parquet has
    one writer at a time; `merge` hands the same rows to a table format with transactions instead.
    """
    spark = incoming.sparkSession
    if merge is not None:
        merge(conform(incoming, table), table, path)
        return
    part = table.partition or _WHOLE
    rest = [F.col(c).desc_nulls_last() for c in table.schema.names if c not in table.key]
    with held(first_per(conform(incoming, table), table.key, rest or [F.lit(0)]), table.name) as rows:
        if table_exists(spark, path, table.schema):
            current = read_table(spark, table, path)
            if table.partition:
                current = _touched(current, rows, table.partition)
            keys = rows.select(*[F.col(c).alias(f"_new_{c}") for c in table.key])
            same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_new_{c}")) for c in table.key])
            rows = current.join(keys, same, "left_anti").unionByName(rows)
        rows = conform(rows, table)
        if not table.partition:
            rows = rows.withColumn(_WHOLE, F.lit(0))
        # rebalancing splits a day too large for one file and joins small ones
        rows.hint("rebalance", part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)


def save_buckets(rows: DataFrame, table: FeatureTable, name: str, path: str, buckets: int) -> None:
    """A copy of a table in buckets of its days, under a name of the session's catalog.

    Copies with the same number of buckets join by day without moving a row. A keyed table bounds what a day holds,
    so no bucket outgrows the others by one day. `table.name` says which table; another session finds the files by `open_buckets`.
    """
    order = [c for c in ("date", "hour") if c in table.key]
    rows = conform(rows, table).repartition(buckets, "date")  # a file per bucket
    writer = rows.write.mode("overwrite").option("path", path).bucketBy(buckets, "date").sortBy(*order)
    writer.format("parquet").saveAsTable(name)


def open_buckets(spark: SparkSession, table: FeatureTable, name: str, path: str, buckets: int) -> None:
    """Name the files of `save_buckets` in the catalog of a session that does not know them."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields)
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (date) INTO {buckets} BUCKETS LOCATION '{place}'")


def cluster_days(
    spark: SparkSession,
    table: FeatureTable,
    path: str,
    first: str,
    last: str,
    columns: Sequence[str] = ("route_id", "hour"),
    rows_per_file: int = 0,
) -> None:
    """Rewrite the stored days first..last with the rows of a day in interleaved order of `columns`.

    Every stretch of a day's files then covers a narrow span of each column, and reads bounded on any of them pass
    over the stretches whose least and greatest value exclude it. The rows themselves stay as they are. `rows_per_file` splits
    days into files of that many rows at most (0: no bound).
    """
    rows = read_table(spark, table, path).where(F.col(table.partition).between(first, last))
    placed, order = interleaved(rows, columns)
    placed = placed.repartitionByRange(table.partition, order).sortWithinPartitions(table.partition, order)
    writer = conform(placed, table).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("maxRecordsPerFile", rows_per_file).partitionBy(table.partition).parquet(path)


def read_table(spark: SparkSession, table: FeatureTable, path: str) -> DataFrame:
    """A stored table in its own columns."""
    return spark.read.schema(table.schema).parquet(path).select(*table.schema.names)


def _touched(current: DataFrame, rows: DataFrame, partition: str) -> DataFrame:
    """Current rows in the partitions of the incoming ones.

    The bounds prune directories before the scan, and the join those between them.
    """
    day = F.col(partition)
    low, high, some_null = rows.agg(F.min(day), F.max(day), F.coalesce(F.bool_or(day.isNull()), F.lit(False))).first()
    near = day.between(low, high) if low is not None else F.lit(False)
    parts = rows.select(day.alias("_part")).distinct()
    return current.where(near | day.isNull() if some_null else near).join(parts, day.eqNullSafe(F.col("_part")), "left_semi")


def save_split(train: DataFrame, test: DataFrame, path: str, version: int) -> None:
    """Store both frames of a split under a version (K6)."""
    train.write.mode("overwrite").parquet(f"{path}/version={version}/train")
    test.write.mode("overwrite").parquet(f"{path}/version={version}/test")
