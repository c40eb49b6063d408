"""Bounds on what a Python worker holds: batches of few rows and bytes, and freed
memory that goes back when a task ends."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import SparkSession

#: Rows and bytes of an Arrow batch on its way to a Python worker.
BATCH_ROWS, BATCH_BYTES = 1_000, 4 << 20

Batch = TypeVar("Batch")


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold at most BATCH_ROWS rows and about BATCH_BYTES bytes
    in this session (smaller settings stay): a Python worker holds two of them,
    and texts can be long. The settings stay, as results are computed later."""
    of_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        if not 0 < of_bytes(spark.conf.get(key)) <= most:
            spark.conf.set(key, str(most))


def frugal(run: Callable[[Iterator[Batch]], Iterator[Batch]]) -> Callable[[Iterator[Batch]], Iterator[Batch]]:
    """``run`` for ``mapInArrow`` or ``mapInPandas``, whose worker gives freed
    memory back when a task ends: workers stay for later tasks, beside stages
    that need none."""

    def tidy(batches: Iterator[Batch]) -> Iterator[Batch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
            if trim is not None:
                trim(0)

    return tidy
