"""Small helpers the operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeload.scratch import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, so that no later loss recomputes it."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


def text_crc(name: str) -> Column:
    """CRC-32 of a number's decimal text."""
    return F.crc32(column(name).cast("string").cast("binary"))


@contextlib.contextmanager
def no_cycle_search() -> Iterator[None]:
    """Python's search for reference cycles off, for loops that make many small objects and no cycles."""
    was_on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was_on:
            gc.enable()


def give_back() -> None:
    """Return freed memory to the system: Python workers live on between tasks and would keep their largest size."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
        if trim is not None:
            trim(0)
