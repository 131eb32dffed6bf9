"""Arrays that every executor fetches once from the driver and maps into memory."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
from pyspark import SparkFiles
from pyspark.sql import SparkSession


def ship(spark: SparkSession, write: Callable[[str], None]) -> str:
    """Let `write` fill a folder on the driver and hand its files to all executors; returns their common name."""
    name = f"arrays-{uuid.uuid4().hex}"
    folder = tempfile.mkdtemp()
    write(folder)
    for file in sorted(os.listdir(folder)):
        os.rename(os.path.join(folder, file), path := os.path.join(folder, f"{name}-{file}"))
        spark.sparkContext.addFile(path)
    return name


def mapped(name: str, file: str, kind: str) -> np.ndarray:
    """The array in one of the files, read page by page as it is touched."""
    path = SparkFiles.get(f"{name}-{file}")
    return np.memmap(path, kind, mode="r") if os.path.getsize(path) else np.zeros(0, kind)
