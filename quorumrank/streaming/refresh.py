"""Incremental ingest: update-log files that arrive are appended to the log as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.health import LOG_SCHEMA, latest_updates


def follow_updates(spark: SparkSession, incoming: str, log_path: str, checkpoint: str) -> StreamingQuery:
    """Appends newline-JSON log records that appear under ``incoming`` to the Parquet log, each file once, then stops."""
    rows = spark.readStream.schema(LOG_SCHEMA).json(incoming)
    return rows.writeStream.format("parquet").option("path", log_path).option(
        "checkpointLocation", checkpoint
    ).trigger(availableNow=True).start()


def current_status(spark: SparkSession, log_path: str) -> DataFrame:
    """Latest update of each source in the followed log."""
    return latest_updates(spark.read.schema(LOG_SCHEMA).parquet(log_path))
