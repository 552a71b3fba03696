"""Where jobs keep checkpoints and intermediate tables."""

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


@cache
def _temporary() -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="wattline-", ignore_cleanup_errors=True)


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder path under the shared folder the session names.

    Only a local session, where all tasks share one machine, falls back to a
    temporary folder, which goes when the process ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _temporary().name
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
