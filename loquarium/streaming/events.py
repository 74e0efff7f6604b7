"""Event streams: the same transformations for batch and stream, watermarked, with stateful operators in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def read_stream(spark: SparkSession, folder: str, files_per_trigger: int = 4) -> DataFrame:
    """events under a folder as a stream, ts with the session's time zone."""
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_trigger).option("pathGlobFilter", "*.parquet").parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(start, event_type, n, total) by tumbling window."""
    e = events.withWatermark("ts", late) if events.isStreaming else events
    return e.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sliding(events: DataFrame, width: str = "2 hours", slide: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    e = events.withWatermark("ts", late) if events.isStreaming else events
    return e.groupBy(F.window("ts", width, slide).alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "n")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """(user_id, start, end, n): events of a user that are less than gap apart."""
    e = events.withWatermark("ts", late) if events.isStreaming else events
    return e.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def deduplicated(events: DataFrame, late: str = "10 minutes") -> DataFrame:
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"]) if events.isStreaming else events.dropDuplicates(["event_id"])


def hysteresis_stream(events: DataFrame, onset: float, offset: float) -> DataFrame:
    """(user_id, event_id, state): the two-threshold state carried for each user across micro-batches."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        on = state.get[0] if state.exists else 0
        rows = pd.concat(list(batches)).sort_values(["ts", "event_id"])
        out = []
        for v in rows["value"]:
            on = 1 if v > onset else 0 if v < offset else on
            out.append(on)
        state.update((on,))
        yield pd.DataFrame({"user_id": key[0], "event_id": rows["event_id"], "state": out})

    return events.groupBy("user_id").applyInPandasWithState(run, "user_id long, event_id long, state int", "on int", "append", GroupStateTimeout.NoTimeout)


def collapse_stream(events: DataFrame) -> DataFrame:
    """(user_id, event_id, event_type): events whose type differs from the user's one before."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        rows = pd.concat(list(batches)).sort_values(["ts", "event_id"])
        keep = []
        for kind in rows["event_type"]:
            keep.append(kind != last)
            last = kind
        state.update((last,))
        yield pd.DataFrame({"user_id": key[0], "event_id": rows["event_id"], "event_type": rows["event_type"]})[keep]

    return events.groupBy("user_id").applyInPandasWithState(run, "user_id long, event_id long, event_type string", "last string", "append", GroupStateTimeout.NoTimeout)


def run_available(stream: DataFrame, name: str, mode: str, checkpoint: str) -> DataFrame:
    """Runs a stream over what is there now into an in-memory table (for tests and small results)."""
    stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.table(name)
