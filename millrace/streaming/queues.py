"""Queue counts over time windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def queue_status_stream(
    df: DataFrame,
    window: str = "1 day",
    watermark: str = "1 hour",
    keys: Sequence[str] = ("connection_id",),
    ts: str = "ts",
) -> DataFrame:
    """Count and bytes of each queue in each time window.

    A window is given out once, when the watermark has passed its end; later rows
    of it are left out, as is usual for a watermark.
    """
    timed = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    return (
        timed.groupBy(F.window(ts, window), *keys)
        .agg(F.count("*").alias("queued_count"), F.sum("size_bytes").alias("queued_bytes"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *keys,
            "queued_count",
            "queued_bytes",
        )
    )
