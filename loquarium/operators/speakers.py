"""Words and turns, speech detection errors, and set operations on intervals."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def anchor(start: Column, end: Column, where: str = "start", offset: float = 0.0) -> Column:
    """The point that places a word: its start, end or mid."""
    return {"start": start, "end": end, "mid": (start + end) / 2}[where] + offset


def assign_words(words: DataFrame, turns: DataFrame, keys: list[str], at: str, order: str) -> DataFrame:
    """words with speaker: that of the first turn (s, e, speaker) which ends at the word's anchor or later, else of the last turn.

    Turns and words meet in one sorted pass over their union, without a range join.
    """
    w = words.withColumns({"_t": F.col(at), "_k": F.lit(0), "_row": F.struct(*words.columns), "_who": F.lit(None).cast("string")}).select(*keys, "_t", "_k", "_row", "_who")
    t = turns.select(*keys, F.col("e").alias("_t"), F.lit(1).alias("_k"), F.lit(None).cast(w.schema["_row"].dataType).alias("_row"), F.col("speaker").alias("_who"))
    span = Window.partitionBy(*keys).orderBy("_t", "_k", "_who")
    both = w.unionByName(t).withColumn("_next", F.first("_who", ignorenulls=True).over(span.rowsBetween(0, Window.unboundedFollowing)))
    both = both.withColumn("_last", F.last("_who", ignorenulls=True).over(span.rowsBetween(Window.unboundedPreceding, 0)))
    return both.where("_k = 0").select("_row.*", F.coalesce("_next", "_last").alias("speaker"))


def assign_words_in_order(words: DataFrame, turns: DataFrame, keys: list[str], at: str, order: str) -> DataFrame:
    """The compatible variant: words in order, and at most one turn further on at each word that lies behind the current turn's end."""
    schema = T.StructType([*words.schema.fields, T.StructField("speaker", T.StringType())])

    def run(_, w: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        t = t.sort_values(["s", "e"], kind="stable")
        ends, who = t["e"].tolist(), t["speaker"].tolist()
        w, now, out = w.sort_values(order, kind="stable"), 0, []
        for x in w[at]:
            if ends and x > ends[now]:
                now = min(now + 1, len(ends) - 1)
            out.append(who[now] if who else None)
        return w.assign(speaker=out)

    return words.groupBy(*keys).cogroup(turns.groupBy(*keys)).applyInPandas(run, schema)


def detection_errors(ref: DataFrame, hyp: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, false_alarm, missed, speech, error): time that only the hypothesis, or only the reference, has as speech, over the time of speech."""
    edges = [x.select(*keys, F.col(c).alias("t"), F.lit(d * r).alias("r"), F.lit(d * (1 - r)).alias("h")) for r, x in ((1, ref), (0, hyp)) for c, d in (("s", 1), ("e", -1))]
    steps = edges[0].unionByName(edges[1]).unionByName(edges[2]).unionByName(edges[3]).groupBy(*keys, "t").agg(F.sum("r").alias("r"), F.sum("h").alias("h"))
    w = Window.partitionBy(*keys).orderBy("t")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    parts = steps.select(*keys, (F.lead("t").over(w) - F.col("t")).alias("d"), (F.sum("r").over(run) > 0).alias("r"), (F.sum("h").over(run) > 0).alias("h")).where("d is not null")
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("d"))), F.lit(0)).cast("double")
    out = parts.groupBy(*keys).agg(total(F.col("h") & ~F.col("r")).alias("false_alarm"), total(F.col("r") & ~F.col("h")).alias("missed"), total(F.col("r")).alias("speech"))
    return out.withColumn("error", F.when(F.col("speech") > 0, (F.col("false_alarm") + F.col("missed")) / F.col("speech")))


def without_intervals(df: DataFrame, gone: DataFrame, on: list[str]) -> DataFrame:
    """Intervals but for those that the other list has exactly so."""
    return df.join(gone.select(*on).distinct(), on, "left_anti")


def split_overlaps(df: DataFrame, keys: list[str]) -> DataFrame:
    """Neighbours that overlap meet halfway between the one's end and the next one's start; the others stay."""
    w = Window.partitionBy(*keys).orderBy("s", "e")
    before, after = F.lag("e").over(w), F.lead("s").over(w)
    found = df.withColumns({"_s": F.when(before > F.col("s"), (before + F.col("s")) / 2).otherwise(F.col("s")), "_e": F.when(after < F.col("e"), (after + F.col("e")) / 2).otherwise(F.col("e"))})
    return found.drop("s", "e").withColumnsRenamed({"_s": "s", "_e": "e"})


def with_predictions(ref: DataFrame, pred: DataFrame, key: str, column: str) -> DataFrame:
    """The reference rows with a column of the predictions by key; "" where there is none."""
    return ref.join(pred.select(key, column), key, "left").withColumn(column, F.coalesce(column, F.lit("")))


def result_table(der: DataFrame, wer: DataFrame, key: str = "uniq_id", total: str = "total") -> DataFrame:
    """Error rates of diarisation and words side by side, as text; "-" for what is missing, without the row of the total."""
    names = [c for c in wer.columns if c != key]
    out = der.where(F.col(key) != total).join(wer, key, "left")
    return out.select(*[F.col(c) if c == key else F.coalesce(F.col(c).cast("string"), F.lit("-")).alias(c) for c in (*der.columns, *names)])
