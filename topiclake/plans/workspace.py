"""Where intermediate tables and checkpoints go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.gettempdir()


def new_dir(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that nothing has used before."""
    return f"{shared_dir(spark)}/topiclake-{purpose}-{uuid.uuid4().hex}"
