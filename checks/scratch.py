"""Fresh folders for queries that write."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def fresh_folder(spark: SparkSession) -> str:
    """A new folder name under the one that the session names for checkpoints.

    A session without that setting gets one under its warehouse. Executors share
    either; a temporary folder of one machine is never used.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        shared = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}"
