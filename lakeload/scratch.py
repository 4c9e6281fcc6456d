"""Shared scratch space for staged writes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local session without the setting gets a temporary folder of its
    own; on a cluster that folder would exist on one machine only.
    """
    context = spark.sparkContext
    folder = spark.conf.get(_SETTING, None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="lakeload-"))
    return context.getCheckpointDir()


def run_dir(spark: SparkSession, purpose: str) -> str:
    """A path no other run uses."""
    return f"{shared_dir(spark)}/lakeload/{purpose}-{uuid.uuid4().hex}"
