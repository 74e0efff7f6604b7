"""Calibration curves, ensemble confidence, adaptation scores, vocabulary comparison and cut statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loquarium.functions import edit
from loquarium.operators.curation import running_totals


def average_precision(df: DataFrame, score: Column, positive: Column) -> DataFrame:
    """ap: the sum of precision at each distinct score times the recall gained there, from the highest score down."""
    per = df.groupBy((-score).alias("p")).agg(F.count_if(positive).alias("pos"), F.count("*").alias("n"))
    run = running_totals(per, "p", ["pos", "n"])
    precision = (F.col("before_pos") + F.col("pos")) / (F.col("before_n") + F.col("n"))
    return run.agg((F.sum(precision * F.col("pos")) / F.sum("pos")).alias("ap"))


def auc_pr(df: DataFrame, score: str, correct: str) -> DataFrame:
    """auc: area under precision and recall of the correct rows."""
    return average_precision(df, F.col(score), F.col(correct) == 1).withColumnRenamed("ap", "auc")


def auc_nt(df: DataFrame, score: str, correct: str) -> DataFrame:
    """auc: the same of the incorrect rows, by the score's complement."""
    return average_precision(df, 1 - F.col(score), F.col(correct) != 1).withColumnRenamed("ap", "auc")


def auc_yc(df: DataFrame, score: str, correct: str, bins: int = 100) -> DataFrame:
    """(auc, std, most) of |share of incorrect rows below a threshold - share of correct ones| over thresholds 0 to 1; zeroes where one class is missing."""
    s = F.col(score)
    low = F.floor(s * bins)
    first = F.when(low / bins > s, low).when((low + 1) / bins > s, low + 1).otherwise(low + 2)  # the first threshold above the score
    per = df.groupBy(first.alias("k")).agg(F.count_if(F.col(correct) == 1).alias("pos"), F.count_if(F.col(correct) != 1).alias("neg"))  # at most bins + 2 rows
    grid = df.sparkSession.range(bins + 1).select(F.col("id").alias("k"), F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("neg"))
    both = per.unionByName(grid).groupBy("k").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    run = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    below = both.select("k", *[F.sum(c).over(run).alias(c) for c in ("pos", "neg")], *[F.sum(c).over(Window.partitionBy()).alias(f"all_{c}") for c in ("pos", "neg")]).where(F.col("k") <= bins)
    y = F.when((F.col("all_pos") > 0) & (F.col("all_neg") > 0), F.abs(F.col("neg") / F.col("all_neg") - F.col("pos") / F.col("all_pos"))).otherwise(F.lit(0.0))
    return below.agg(F.avg(y).alias("auc"), F.stddev_pop(y).alias("std"), F.max(y).alias("most"))


def best_confidence(df: DataFrame, combination: list[str], label: str, predicted: str) -> DataFrame:
    """(combination, score): the way to compute confidence by which the mean over classes of the share of rows given to their class is greatest (the least combination on ties)."""
    per = df.groupBy(*combination, label).agg(F.avg((F.col(label) == F.col(predicted)).cast("double")).alias("_share"))
    means = per.groupBy(*combination).agg(F.avg("_share").alias("score"))
    return means.orderBy(F.desc("score"), *combination).limit(1)


def adaptation_scores(df: DataFrame, original_wer: str, adapted_wer: str, baseline_original: float, baseline_adapted: Column, most: float) -> DataFrame:
    """Adds original_scale (1 without degradation, 0 from most on), adapt_werr (relative error reduction, 0 at least) and their product, rounded to 4 places."""
    scale = (most - F.least(F.lit(most), F.abs(F.col(original_wer) - baseline_original))) / most
    reduced = F.greatest(baseline_adapted - F.col(adapted_wer), F.lit(0.0)) / baseline_adapted
    return df.select("*", F.round(scale, 4).alias("original_scale"), F.round(reduced, 4).alias("adapt_werr"), F.round(scale * reduced, 4).alias("score"))


def best_by_dataset(df: DataFrame, config: list[str], dataset: str, score: str, lowest: bool = False) -> DataFrame:
    """(dataset, config, score): the best configuration of each dataset, and one over all datasets by the mean score (dataset null)."""
    order = F.asc("_s") if lowest else F.desc("_s")
    per = df.groupBy(dataset, *config).agg(F.avg(score).alias("_s")).unionByName(df.groupBy(*config).agg(F.avg(score).alias("_s")).withColumn(dataset, F.lit(None).cast(df.schema[dataset].dataType)))
    first = per.withColumn("_n", F.row_number().over(Window.partitionBy(dataset).orderBy(order, *config)))
    return first.where("_n = 1").select(dataset, *config, F.col("_s").alias(score))


def compare_vocabularies(a: DataFrame, b: DataFrame) -> DataFrame:
    """(word, count, accuracy_a, accuracy_b, gain, weight) of words (word, count, accuracy) that both models met; weight is one over the count."""
    other = b.select("word", F.col("accuracy").alias("accuracy_b"))
    both = a.select("word", "count", F.col("accuracy").alias("accuracy_a")).join(other, "word")
    return both.select("*", (F.col("accuracy_b") - F.col("accuracy_a")).alias("gain"), (1 / F.col("count")).alias("weight"))


def cut_statistics(segments: DataFrame, keys: list[str], threshold: float, longest: float, least_gap: float = 0.01) -> DataFrame:
    """(keys, high, low, too_long, deleted) seconds of aligned segments (s, e, score): those at or above the threshold, below it, of more than the longest duration, and gaps between segments."""
    d = F.col("e") - F.col("s")
    gap = F.col("s") - F.coalesce(F.lag("e").over(Window.partitionBy(*keys).orderBy("s", "e")), F.lit(0))
    total = lambda c, v=d: F.coalesce(F.sum(F.when(c, v)), F.lit(0)).cast("double")
    fits = d <= longest
    return segments.withColumn("_gap", gap).groupBy(*keys).agg(
        total(fits & (F.col("score") >= threshold)).alias("high"), total(fits & (F.col("score") < threshold)).alias("low"), total(~fits).alias("too_long"), total(F.col("_gap") > least_gap, F.col("_gap")).alias("deleted")
    )


def sample_scores(ref: Column, hyp: Column) -> list[Column]:
    """Word and character error rates of a row in per cent, to 2 places."""
    return [F.round(edit.wer(ref, hyp) * 100, 2).alias("wer"), F.round(edit.cer(ref, hyp) * 100, 2).alias("cer")]
