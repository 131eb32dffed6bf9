"""Session settings and the shared folder that intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}


def local_session(cores: str = "*", app: str = "seatflow") -> SparkSession:
    """A single-machine session for tests and the bench, with a shared folder of its own; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="seatflow-"))
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder in `spark.checkpoint.dir`; a temporary one only on a local master."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="seatflow-")
    return _LOCAL_FOLDERS[context.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nobody has written to yet, below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/seatflow/{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once and read it back: cuts lineage, so a lost executor costs a re-read.

    Also pins values such as partition ids that must not differ between two uses.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def observed(df: DataFrame, metrics: Sequence[Column], write: Callable[[DataFrame], None]) -> Row:
    """Aggregates of `df` that its own write takes in passing; the metrics are named, and hold for no rows too.

    They are taken in the tasks that write, whose results Spark counts once each, also when a lost executor makes
    others run again. So `df` must reach the writer as it is: a shuffle belongs before this, not into `write`.
    """
    seen = Observation()
    write(df.observe(seen, *metrics))
    return Row(**seen.get)


def stored_with(df: DataFrame, name: str, metrics: Sequence[Column]) -> tuple[DataFrame, Row]:
    """`df` stored as by `stored`, and aggregates taken while it is written."""
    path = fresh_path(df.sparkSession, name)
    seen = observed(df, metrics, lambda rows: rows.write.parquet(path))
    return df.sparkSession.read.schema(df.schema).parquet(path), seen


@contextmanager
def held(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """`df` stored as by `stored`, and removed again at the end."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def use_checkpoints(spark: SparkSession) -> None:
    """Give iterative MLlib fits a checkpoint folder, so that their lineage is cut now and then."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(fresh_path(spark, "checkpoints"))
