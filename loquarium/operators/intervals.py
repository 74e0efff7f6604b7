"""Interval algebra: islands, gaps, overlaps, clipping, windows, frames; range and as-of joins by equi-keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(df: DataFrame, keys: list[str], start: str = "s", end: str = "e", touching: str = "merge") -> DataFrame:
    """(keys, s, e): intervals merged where they overlap (or touch); containment is respected by a running maximum of ends."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.col(start) > before if touching == "merge" else F.col(start) >= before
    marked = df.withColumn("_new", F.coalesce(new.cast("int"), F.lit(1))).withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "_island").agg(F.min(start).alias("s"), F.max(end).alias("e")).drop("_island")


def islands_adjacent(df: DataFrame, keys: list[str], start: str = "s", end: str = "e") -> DataFrame:
    """The variant that looks at the previous interval's own end only, so containment can split an island."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    marked = df.withColumn("_new", F.coalesce((F.col(start) > F.lag(end).over(w)).cast("int"), F.lit(1))).withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "_island").agg(F.min(start).alias("s"), F.max_by(end, F.struct(F.col(start), F.col(end))).alias("e")).drop("_island")


def merge_float(df: DataFrame, keys: list[str], start: str = "s", end: str = "e", decimals: int = 5, margin: int = 2) -> DataFrame:
    """Merging on integers: starts move by margin units first, so intervals that touch by less stay apart."""
    unit = 10**decimals
    whole = df.select(*keys, (F.round(F.col(start) * unit).cast("long") + margin).alias("s"), F.round(F.col(end) * unit).cast("long").alias("e")).where("s <= e")
    return islands(whole, keys).select(*keys, ((F.col("s") - margin) / unit).alias("s"), (F.col("e") / unit).alias("e"))


def overlaps(df: DataFrame, keys: list[str], start: str = "s", end: str = "e") -> DataFrame:
    """(keys, s, e): where an interval overlaps what came before it."""
    w = Window.partitionBy(*keys).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    before = df.withColumn("_before", F.max(end).over(w))
    return before.where(F.col("_before") > F.col(start)).select(*keys, F.col(start).alias("s"), F.least("_before", end).alias("e"))


def gaps(df: DataFrame, keys: list[str], origin: float | None = None, tail: str | None = None) -> DataFrame:
    """(keys, s, e): what islands leave uncovered, from origin on, up to a column's value where one is named."""
    merged = islands(df, keys)
    w = Window.partitionBy(*keys).orderBy("s")
    previous = F.lag("e").over(w) if origin is None else F.lag("e", 1, origin).over(w)
    out = merged.withColumn("_p", previous).where("_p < s").select(*keys, F.col("_p").alias("s"), F.col("s").alias("e"))
    if tail:
        ends = df.groupBy(*keys).agg(F.max("e").alias("_p"), F.max(tail).alias("_t"))
        out = out.unionByName(ends.where("_t > _p").select(*keys, F.col("_p").alias("s"), F.col("_t").alias("e")))
    return out


def clip(df: DataFrame, low: Column, high: Column, start: str = "s", end: str = "e") -> DataFrame:
    """Intervals that strictly overlap (low, high), cut to it."""
    return df.where((F.col(end) > low) & (F.col(start) < high)).withColumns({start: F.greatest(F.col(start), low), end: F.least(F.col(end), high)})


def fill_short_gaps(df: DataFrame, keys: list[str], least_gap: float, least_length: float, lengths_first: bool = True) -> DataFrame:
    """Drops short intervals and fills short gaps, in either order."""

    def fill(x: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy("s")
        new = F.coalesce((F.col("s") - F.lag("e").over(w) >= least_gap).cast("int"), F.lit(1))
        x = x.withColumn("_n", new).withColumn("_i", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        return x.groupBy(*keys, "_i").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("_i")

    long_enough = lambda x: x.where(F.col("e") - F.col("s") >= least_length)
    merged = islands(df, keys)
    return fill(long_enough(merged)) if lengths_first else long_enough(fill(merged))


def runs(df: DataFrame, keys: list[str], order: list[str], label: str) -> DataFrame:
    """Adds run: the number of a row's run of equal labels within its key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    new = (~F.col(label).eqNullSafe(F.lag(label).over(w)) | (F.row_number().over(w) == 1)).cast("int")
    return df.withColumn("_new", new).withColumn("run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def subsegments(df: DataFrame, start: Column, duration: Column, window: float, shift: float, least: float = 0.05) -> DataFrame:
    """Adds sub, s, dur: sliding windows over each row's interval; the last is cut at its end."""
    n = F.when(duration < window, F.lit(1)).otherwise(F.ceil((duration - window) / shift) + 1).cast("int")
    out = df.withColumn("sub", F.explode(F.sequence(F.lit(0), n - 1))).withColumn("s", start + F.col("sub") * shift)
    return out.withColumn("dur", F.least(F.lit(window), start + duration - F.col("s"))).where(F.col("dur") > least)


def frame_labels(df: DataFrame, keys: list[str], total: Column, frame: float) -> DataFrame:
    """(keys, frame, label): 1 for frames from int(s / frame) up to before int(e / frame) of any interval; total is each key's length."""
    n = df.groupBy(*keys).agg(F.floor(F.max(total) / frame).cast("int").alias("n")).where("n > 0")
    spans = df.select(*keys, F.greatest(F.floor(F.col("s") / frame), F.lit(0)).cast("int").alias("s"), F.floor(F.col("e") / frame).cast("int").alias("e")).where("s < e")
    w = Window.partitionBy(*keys).orderBy("s")
    both = n.join(islands(spans, keys), keys, "left").withColumns({"from": F.coalesce(F.lag("e").over(w), F.lit(0)), "last": F.lead("s").over(w).isNull()})
    # Runs of frames off, on, and off again behind the last interval; no frame is joined with anything.
    part = lambda a, b, y: F.struct(a.alias("a"), F.least(b, F.col("n")).alias("b"), F.lit(y).alias("label"))
    runs_ = F.array(part(F.col("from"), F.coalesce("s", "n"), 0), part(F.col("s"), F.col("e"), 1), part(F.when(F.col("last"), F.col("e")), F.col("n"), 0))
    found = both.select(*keys, F.explode(runs_).alias("r")).where("r.a < r.b")
    return found.select(*keys, F.explode(F.sequence(F.col("r.a"), F.col("r.b") - 1)).alias("frame"), "r.label")


def frames_to_segments(df: DataFrame, keys: list[str], frame: str, label: str, length: float) -> DataFrame:
    """(keys, s, e) of runs of positive frames; e is the end of the last frame."""
    found = runs(df, keys, [frame], label).where(F.col(label) > 0)
    return found.groupBy(*keys, "run").agg((F.min(frame) * length).alias("s"), ((F.max(frame) + 1) * length).alias("e")).drop("run")


def range_join(points: DataFrame, spans: DataFrame, keys: list[str], at: str, start: str, end: str, width: float) -> DataFrame:
    """points with each span of the same keys where start <= at < end, by an equi-join on bins of a width.

    A span is copied to each bin that it touches, so width should be about the spans' length.
    """
    left = points.withColumn("_bin", F.floor(F.col(at) / width))
    right = spans.where(F.col(end) > F.col(start)).withColumn("_bin", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))))
    return left.join(right, [*keys, "_bin"]).where((F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))).drop("_bin")


def overlap_join(a: DataFrame, b: DataFrame, keys: list[str], width: float) -> DataFrame:
    """Pairs of (s, e) in a and (s2, e2) in b of the same keys that overlap strictly, with what they share.

    Both are copied to their bins; a pair is kept only in the bin of the later start, so it comes once.
    """
    bins = lambda s, e: F.explode(F.sequence(F.floor(F.col(s) / width), F.floor(F.col(e) / width)))
    pairs = a.where("e > s").withColumn("_bin", bins("s", "e")).join(b.where("e2 > s2").withColumn("_bin", bins("s2", "e2")), [*keys, "_bin"])
    once = F.col("_bin") == F.floor(F.greatest("s", "s2") / width)
    return pairs.where(once & (F.col("e") > F.col("s2")) & (F.col("s") < F.col("e2"))).drop("_bin").withColumns({"os": F.greatest("s", "s2"), "oe": F.least("e", "e2")})


def as_of(left: DataFrame, right: DataFrame, keys: list[str], at: str, values: list[str]) -> DataFrame:
    """left with the values of the latest right row at or before it: one union and one window, no range join."""
    cols = [*keys, at]
    both = left.withColumns({f"_{v}": F.lit(None).cast(dict(right.dtypes)[v]) for v in values}).withColumn("_right", F.lit(0)).unionByName(
        right.select(*cols, *[F.col(v).alias(f"_{v}") for v in values]).withColumn("_right", F.lit(1)), allowMissingColumns=True
    )
    w = Window.partitionBy(*keys).orderBy(F.col(at), F.col("_right").desc()).rowsBetween(Window.unboundedPreceding, 0)
    for v in values:
        both = both.withColumn(v, F.last(F.when(F.col("_right") == 1, F.struct(F.col(f"_{v}").alias("x"))), ignorenulls=True).over(w)["x"])
    return both.where("_right = 0").drop("_right", *[f"_{v}" for v in values])
