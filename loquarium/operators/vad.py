"""Speech activity from frame probabilities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loquarium.operators.intervals import islands, runs


def hysteresis(df: DataFrame, keys: list[str], order: list[str], p: Column, onset: float, offset: float) -> DataFrame:
    """Adds state: 1 from a value over onset on, until one under offset."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("state", F.coalesce(F.last(F.when(p > onset, 1).when(p < offset, 0), ignorenulls=True).over(w), F.lit(0)))


def binarize(df: DataFrame, keys: list[str], frame: str, p: Column, length: float, onset: float, offset: float, pad_onset: float = 0.0, pad_offset: float = 0.0) -> DataFrame:
    """(keys, s, e): padded, merged segments of state 1."""
    on = runs(hysteresis(df, keys, [frame], p, onset, offset), keys, [frame], "state").where("state = 1")
    found = on.groupBy(*keys, "run").agg((F.min(frame) * length).alias("s"), ((F.max(frame) + 1) * length).alias("e")).drop("run")
    return islands(found.withColumns({"s": F.greatest(F.col("s") - pad_onset, F.lit(0.0)), "e": F.col("e") + pad_offset}), keys)


def smooth(df: DataFrame, keys: list[str], order: list[str], p: str, back: int, ahead: int, how: str = "mean") -> DataFrame:
    """Adds smoothed: mean or median over neighbouring frames."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-back, ahead)
    if how == "mean":
        return df.withColumn("smoothed", F.avg(p).over(w))
    x = F.sort_array(F.collect_list(p).over(w))  # median() takes no frame
    n = F.size("_x")
    middle = (F.get("_x", ((n - 1) / 2).cast("int")) + F.get("_x", (n / 2).cast("int"))) / 2.0
    return df.withColumn("_x", x).withColumn("smoothed", F.when(n > 0, middle)).drop("_x")


def scaled_thresholds(df: DataFrame, keys: list[str], p: str, onset: float, offset: float, how: str = "relative") -> DataFrame:
    """(keys, onset, offset) scaled to each key's range: min to max, or first to 99th percentile (nearest rank)."""
    if how == "absolute":
        low, high = F.lit(0.0), F.lit(1.0)
    elif how == "relative":
        low, high = F.min(p), F.max(p)
    else:
        low, high = (F.expr(f"percentile_disc({q}) within group (order by {p})") for q in (0.01, 0.99))
    return df.groupBy(*keys).agg(low.alias("_l"), high.alias("_h")).select(*keys, *[(F.col("_l") + x * (F.col("_h") - F.col("_l"))).alias(n) for x, n in ((onset, "onset"), (offset, "offset"))])


def stream_status(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Adds status: single, start, next or end by a row's neighbours in its key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    first, last = F.lag(order[0]).over(w).isNull(), F.lead(order[0]).over(w).isNull()
    return df.withColumn("status", F.when(first & last, "single").when(first, "start").when(last, "end").otherwise("next"))


def overlapping_windows(df: DataFrame, keys: list[str], frame: str, p: str, window: int, shift: int, how: str = "mean") -> DataFrame:
    """(keys, t, smoothed): each frame's value averaged over the windows that hold it (window ``frame`` starts at frame * shift)."""
    wide = df.select(*keys, F.col(p), F.explode(F.sequence(F.col(frame) * shift, F.col(frame) * shift + window - 1)).alias("t"))
    return wide.groupBy(*keys, "t").agg((F.avg(p) if how == "mean" else F.median(p)).alias("smoothed"))


def resample_labels(df: DataFrame, keys: list[str], frame: str, label: str, ratio: float) -> DataFrame:
    """(keys, frame, label): labels at another frame rate; ratio > 1 takes the maximum of a group, below 1 repeats."""
    if ratio >= 1:
        return df.groupBy(*keys, F.floor(F.col(frame) / ratio).cast("int").alias("frame")).agg(F.max(label).alias("label"))
    times = round(1 / ratio)
    return df.select(*keys, F.explode(F.sequence(F.col(frame) * times, F.col(frame) * times + times - 1)).alias("frame"), F.col(label).alias("label"))
