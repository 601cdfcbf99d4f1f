"""Folders for intermediate tables that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


@lru_cache
def _local_root(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"orderflow-{application}-")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder of the session.

    Only a local session without that setting gets a folder of its own.
    """
    root = spark.conf.get(SETTING, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {SETTING} to a folder that all executors share")
        root = _local_root(spark.sparkContext.applicationId)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
