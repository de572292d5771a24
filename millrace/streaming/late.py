"""Rows that a watermark has passed, by a relationship of their own."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows that leave a task in one frame.
_FRAME = 10_000


def _processor():
    """Passes rows on with whether the watermark is past the end of their window; keeps no state."""
    from pyspark.sql.streaming import StatefulProcessor

    class Late(StatefulProcessor):
        def init(self, handle):
            # A stateful operator has a variable; this one stays empty.
            self.nothing = handle.getValueState("nothing", "none int")

        def handleInputRows(self, key, rows, timerValues):
            past = timerValues.getCurrentWatermarkInMs()
            for batch in rows:
                for k in range(0, len(batch), _FRAME):
                    part = batch.iloc[k : k + _FRAME]
                    yield pd.DataFrame({"row": part["row"], "late": part["until"] <= past})

        def close(self):
            pass

    return Late()


def label_late(
    df: DataFrame,
    window: str = "1 day",
    watermark: str = "1 hour",
    ts: str = "ts",
    name: str = "relationship",
    groups: int = 128,
) -> DataFrame:
    """The rows of a stream with ``on_time`` or ``late`` in ``name``.

    A row is late if the watermark of its batch is past the end of its time window: those that
    ``queue_status_stream`` with the same window and watermark does not count any more. A row
    without a time is late. Rows are dealt to ``groups`` tasks as JSON and no state is kept.
    """
    timed = df.select(
        F.to_json(F.struct(*df.columns)).alias("row"), F.col(ts).cast("timestamp").alias("ts")
    ).withWatermark("ts", watermark)
    # Windows begin at the epoch, as Spark's do.
    width = df.sparkSession.sql(f"SELECT unix_millis(timestamp_seconds(0) + INTERVAL '{window}')").first()[0]
    until = F.floor(F.unix_millis("ts") / width) * width + width
    ends = timed.select("row", F.coalesce(until, F.lit(-1)).alias("until"), F.pmod(F.xxhash64("row"), F.lit(groups)).alias("group"))
    out = ends.groupBy("group").transformWithStateInPandas(
        statefulProcessor=_processor(), outputStructType="row string, late boolean", outputMode="append", timeMode="EventTime"
    )
    label = F.when(F.col("late"), "late").otherwise("on_time").alias(name)
    return out.select(F.from_json("row", df.schema).alias("row"), label).select("row.*", name)
