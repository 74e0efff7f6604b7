"""Corpus and label statistics."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loquarium.functions.edit import tokens


def vocabulary(df: DataFrame, text: str) -> DataFrame:
    return df.select(F.explode(tokens(F.col(text))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def alphabet(df: DataFrame, text: str) -> DataFrame:
    """(char, n): characters other than line ends."""
    return df.select(F.explode(F.split(F.regexp_replace(F.col(text), r"[\r\n]", ""), "")).alias("char")).where("char <> ''").groupBy("char").agg(F.count("*").alias("n"))


def out_of_vocabulary(words: DataFrame, known: DataFrame) -> DataFrame:
    """words (word, ...) with oov."""
    return words.join(known.select("word").distinct().withColumn("_k", F.lit(True)), "word", "left").withColumn("oov", F.col("_k").isNull()).drop("_k")


def rates(text: Column, seconds: Column) -> dict[str, Column]:
    """Words, characters, and both by second."""
    n, c = F.size(tokens(text)), F.length(text)
    return {"num_words": n, "num_chars": c, "word_rate": n / seconds, "char_rate": c / seconds}


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """(bin, n) over equal widths between the least and greatest value; two passes, no sort."""
    ends = df.agg(F.min(value).alias("_a"), F.max(value).alias("_b"))
    b = F.least(F.floor((F.col(value) - F.col("_a")) / ((F.col("_b") - F.col("_a")) / bins)), F.lit(bins - 1)).cast("int")
    return df.join(F.broadcast(ends)).where(F.col(value).isNotNull()).groupBy(F.coalesce(b, F.lit(0)).alias("bin")).agg(F.count("*").alias("n"))


def label_stats(df: DataFrame, label: str) -> DataFrame:
    """(label, n, share); the greatest label is that of the table's maximum."""
    per = df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    return per.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def multi_label_stats(df: DataFrame, labels: str) -> DataFrame:
    """(pos, negative, positive) by place in an array of 0 and 1."""
    return df.select(F.posexplode(labels).alias("pos", "v")).groupBy("pos").agg(F.count_if(F.col("v") == 0).alias("negative"), F.count_if(F.col("v") == 1).alias("positive"))


def frequency_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, weight): total / (number of labels * count)."""
    per = df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    w = Window.partitionBy()
    return per.select("label", (F.sum("n").over(w) / (F.count("*").over(w) * F.col("n"))).alias("weight"))


def length_stats(df: DataFrame, value: str) -> DataFrame:
    p = lambda q: F.percentile(value, q)
    return df.agg(F.min(value).alias("min"), F.max(value).alias("max"), F.avg(value).alias("mean"), p(0.5).alias("median"), p(0.75).alias("p75"), p(0.99).alias("p99"))


def group_and_overall(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, n, mean, std) by key and over all (key null); zeros and nulls are left out."""
    return df.where(F.col(value) != 0).rollup(key).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))


def speaker_map(df: DataFrame, speaker: str) -> DataFrame:
    """(speaker, idx): dense numbers from 0 in string order; the window is over distinct names."""
    names = df.select(F.col(speaker).cast("string").alias("speaker")).distinct()
    return names.withColumn("idx", F.row_number().over(Window.orderBy("speaker")) - 1)


def metadata_rates(df: DataFrame, target: str, tokens_col: str, rates_cols: list[str], slots: list[tuple] | None = None) -> DataFrame:
    """(slot, tokens, rates): token-weighted rates by value, or by the first slot that matches: (low, high) half-open or a list of values."""
    if slots:
        slot = F.lit(None).cast("string")
        for i in reversed(range(len(slots))):
            test = F.col(target).isin(list(slots[i])) if isinstance(slots[i], list) else (F.col(target) >= slots[i][0]) & (F.col(target) < slots[i][1])
            slot = F.when(test, F.lit(str(i))).otherwise(slot)
    else:
        slot = F.col(target).cast("string")
    t = F.col(tokens_col)
    return df.withColumn("slot", slot).where("slot is not null").groupBy("slot").agg(F.sum(t).alias("tokens"), *[(F.sum(t * F.col(r)) / F.sum(t)).alias(r) for r in rates_cols])


def top_configs(df: DataFrame, category: str, config: list[str], key: str, k: int, ascending: bool = True) -> DataFrame:
    """(category, config, key, rank): mean by configuration, the best k of each category."""
    mean = df.groupBy(category, *config).agg(F.avg(key).alias(key))
    order = F.col(key).asc() if ascending else F.col(key).desc()
    return mean.withColumn("rank", F.row_number().over(Window.partitionBy(category).orderBy(order, *config))).where(F.col("rank") <= k)


def grid_best(grid: DataFrame, score: str, maximise: bool = True) -> DataFrame:
    """The first row of a parameter grid (column idx) with the best score."""
    pick = F.max_by(F.struct("*"), F.struct(F.col(score), -F.col("idx"))) if maximise else F.min_by(F.struct("*"), F.struct(F.col(score), F.col("idx")))
    return grid.agg(pick.alias("b")).select("b.*")


def matched(a: list, b: list) -> list[int]:
    """1 for each element of a in a matching block: the longest common run (the first in a, then in b), and so on to both sides of it."""
    if a == b:
        return [1] * len(a)
    hit, where = [0] * len(a), {}
    for j, y in enumerate(b):
        where.setdefault(y, []).append(j)
    todo = [(0, len(a), 0, len(b))]
    while todo:
        low, high, left, right = todo.pop()
        most, at, to, runs = 0, low, left, {}
        for i in range(low, high):
            new = {}
            for j in where.get(a[i], ()):
                if left <= j < right:
                    n = new[j] = runs.get(j - 1, 0) + 1
                    if n > most:
                        most, at, to = n, i - n + 1, j - n + 1
            runs = new
        if most:
            hit[at : at + most] = [1] * most
            todo += [x for x in ((low, at, left, to), (at + most, high, to + most, right)) if x[0] < x[1] and x[2] < x[3]]
    return hit


def word_accuracy(df: DataFrame, ref: str, hyp: str) -> DataFrame:
    """(word, n, matched, accuracy) of reference words that matching blocks pair with the hypothesis; words are counted where they are matched."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n, hits = Counter(), Counter()
            for r, h in zip(batch["r"].fillna(""), batch["h"].fillna("")):
                words = r.split()
                n.update(words)
                hits.update(w for w, x in zip(words, matched(words, h.split())) if x)
            yield pd.DataFrame({"word": list(n), "n": list(n.values()), "matched": [hits[w] for w in n]}).astype({"n": "int64", "matched": "int64"})

    counts = df.select(F.col(ref).alias("r"), F.col(hyp).alias("h")).mapInPandas(run, "word string, n long, matched long")
    return counts.groupBy("word").agg(F.sum("n").alias("n"), F.sum("matched").alias("matched")).withColumn("accuracy", F.col("matched") / F.col("n"))


def recommend_lengths(df: DataFrame, text: str) -> DataFrame:
    """(n, p995, mean, std): nearest-rank 99.5th percentile, mean and population deviation of character lengths."""
    n = F.length(text)
    return df.agg(F.count("*").alias("n"), F.expr(f"percentile_disc(0.995) within group (order by length({text}))").alias("p995"), F.avg(n).alias("mean"), F.stddev_pop(n).alias("std"))


def session_report(intervals: DataFrame, key: str) -> DataFrame:
    """(key, speech, silence, silence_ratio, overlap, overlap_ratio) of a session from 0 to its last end."""
    from loquarium.operators.intervals import islands, overlaps

    merged = islands(intervals, [key]).groupBy(key).agg(F.sum(F.col("e") - F.col("s")).alias("speech"), F.max("e").alias("_end"))
    shared = overlaps(intervals, [key]).groupBy(key).agg(F.sum(F.col("e") - F.col("s")).alias("overlap"))
    out = merged.join(shared, key, "left").fillna(0.0, ["overlap"]).withColumn("silence", F.greatest(F.col("_end") - F.col("speech"), F.lit(0.0)))
    return out.select(key, "speech", "silence", (F.col("silence") / F.col("_end")).alias("silence_ratio"), "overlap", (F.col("overlap") / F.col("speech")).alias("overlap_ratio"))
