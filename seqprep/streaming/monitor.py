"""Metric monitor: windowed means of a logged series, stream or batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import TimestampNTZType


def monitor(
    df: DataFrame,
    ts: str = "ts",
    run: str = "run",
    value: str = "value",
    window: str = "10 minutes",
    watermark: str = "10 minutes",
) -> DataFrame:
    """Mean and count of the series per run and tumbling window.

    On a stream, rows later than the watermark are dropped and a window comes
    out once it is closed (append mode). A batch table gives the same windows,
    all of them. The sums are combined before the shuffle, so one run may hold
    most rows. Windows are counted from the epoch in UTC.
    """
    at = F.col(ts)
    if isinstance(df.schema[ts].dataType, TimestampNTZType):
        # A watermark needs an instant. Times without zone are taken as UTC, whatever the session's zone.
        at = F.concat(at.cast("string"), F.lit("Z"))
    timed = df.withColumn("_at", at.cast("timestamp"))
    if df.isStreaming:
        timed = timed.withWatermark("_at", watermark)
    return (
        timed.groupBy(F.window("_at", window).alias("_w"), F.col(run).alias("run"))
        .agg(F.avg(value).alias("mean_value"), F.count(value).alias("n_values"))
        .select(F.col("_w.start").alias("window_start"), "run", "mean_value", "n_values")
    )


def monitor_to(windows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the windows of a monitored stream to ``path`` as they close, and stop when all input is read; resumable."""
    return (
        windows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
