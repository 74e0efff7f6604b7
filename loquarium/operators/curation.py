"""Deduplicating rows, splitting, sharding, sampling, mixing, packing, templates, threads."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def scramble(key: Column) -> Column:
    """A fixed pseudo-random order of whole numbers that any engine can compute."""
    return F.pmod(key * F.lit(2654435761), F.lit(4294967296))


def drop_duplicates(df: DataFrame, by: list[str], order: str) -> DataFrame:
    """The first row of each group by order: a partial aggregate, so a frequent group is no large task."""
    firsts = df.groupBy(*by).agg(F.min(order).alias(order))
    return df.join(firsts, [*by, order], "left_semi") if not _nullable(df, by) else df.alias("a").join(firsts.alias("b"), [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*by, order]], "left_semi")


def _nullable(df: DataFrame, by: list[str]) -> bool:
    return any(df.schema[c].nullable for c in by)


def min_count(df: DataFrame, label: str, least: int) -> DataFrame:
    """Rows of labels that occur often enough."""
    return df.join(df.groupBy(label).count().where(F.col("count") >= least).select(label), label, "left_semi")


def common_suffix(df: DataFrame, text: str) -> DataFrame:
    """(suffix): the longest suffix of all texts, which is that of the least and greatest reversed text."""
    ends = df.agg(F.min(F.reverse(text)).alias("a"), F.max(F.reverse(text)).alias("b"))
    n = F.least(F.length("a"), F.length("b"))
    same = F.filter(F.sequence(F.lit(0), n), lambda i: F.substring("a", F.lit(1), i) == F.substring("b", F.lit(1), i))
    return ends.select(F.reverse(F.substring("a", F.lit(1), F.array_max(same))).alias("suffix"))


def most_common(df: DataFrame, value: str, k: int = 5) -> DataFrame:
    """(value, n, share) of the k most common values; ties by value."""
    total = df.agg(F.count("*").alias("_t"))
    per = df.groupBy(F.col(value).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(k)
    return per.join(F.broadcast(total)).select("value", "n", (F.col("n") / F.col("_t")).alias("share"))


def ranked(df: DataFrame, by: Column, tie: str, out: str = "rn") -> DataFrame:
    """Adds a dense global rank without one task for all: rows are range-partitioned, ranked there, and shifted by the ranks before.

    The partitions' sizes (a row for each partition) are the only thing collected.
    """
    part = df.withColumn("_by", by).repartitionByRange("_by", tie).withColumn("_p", F.spark_partition_id())
    part = part.persist()
    counts = {r["_p"]: r["count"] for r in part.groupBy("_p").count().collect()}
    before, at = {}, 0
    for p in sorted(counts):
        before[p], at = at, at + counts[p]
    shift = F.create_map(*[F.lit(x) for p, b in before.items() for x in (p, b)]) if before else F.create_map().cast("map<int,int>")
    local = F.row_number().over(Window.partitionBy("_p").orderBy("_by", tie))
    return part.withColumn(out, (local + F.try_element_at(shift, F.col("_p"))).cast("long")).drop("_by", "_p")


def running_totals(df: DataFrame, by: str, values: list[str]) -> DataFrame:
    """Adds before_<value>: the sum of a whole-number column over all rows ordered before (by is distinct).

    Like ranked: range partitions, local sums, and a shift for each partition.
    """
    part = df.repartitionByRange(by).withColumn("_p", F.spark_partition_id()).persist()
    totals = {r["_p"]: [r[f"_{v}"] or 0 for v in values] for r in part.groupBy("_p").agg(*[F.sum(v).alias(f"_{v}") for v in values]).collect()}
    w = Window.partitionBy("_p").orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    out = part
    for i, v in enumerate(values):
        at, pairs = 0, []
        for p in sorted(totals):
            pairs += [F.lit(p), F.lit(int(at)).cast("long")]
            at += totals[p][i]
        shift = F.create_map(*pairs) if pairs else F.create_map().cast("map<int,bigint>")
        out = out.withColumn(f"before_{v}", F.coalesce(F.sum(v).over(w), F.lit(0)) + F.try_element_at(shift, F.col("_p")))
    return out.drop("_p")


def shards(df: DataFrame, key: str, n: int) -> DataFrame:
    """Adds shard and place: seeded order, n equal shards, the remainder left out."""
    total = df.count()
    size = total // n
    r = ranked(df, scramble(F.col(key)), key)
    return r.where(F.col("rn") <= size * n).withColumns({"shard": F.floor((F.col("rn") - 1) / size).cast("int"), "place": ((F.col("rn") - 1) % size).cast("int")}).drop("rn")


def split(df: DataFrame, key: str, share: float) -> DataFrame:
    """Adds fold: validation for the first share of a seeded order, else train."""
    n = int(df.count() * share)
    return ranked(df, scramble(F.col(key)), key).withColumn("fold", F.when(F.col("rn") <= n, "validation").otherwise("train")).drop("rn")


def stratified_split(df: DataFrame, label: str, key: str, share: float) -> DataFrame:
    """Adds fold with the share taken in every label.

    Only keys and labels are ranked; whole rows are joined to their fold.
    """
    w = Window.partitionBy(label)
    rn = F.row_number().over(w.orderBy(scramble(F.col(key)), key))
    marked = df.select(key, label).withColumns({"_rn": rn, "_n": F.count("*").over(w)})
    return df.join(marked.select(key, F.when(F.col("_rn") <= F.floor(F.col("_n") * share), "validation").otherwise("train").alias("fold")), key)


def duration_buckets(value: Column, low: float, high: float, n: int) -> Column:
    """Bucket 0 to n - 1 of equal widths, the last closed; null outside."""
    return F.when((value >= low) & (value <= high), F.least(F.floor((value - low) / ((high - low) / n)), F.lit(n - 1)).cast("int"))


def longest_first_buckets(sizes: list[tuple[str, int]], n: int) -> list[tuple[str, int, int]]:
    """(name, size, bucket): largest first to the least loaded bucket (lowest number on ties)."""
    heap, out = [(0, b) for b in range(n)], []
    for name, size in sorted(sizes, key=lambda x: -x[1]):
        load, b = heapq.heappop(heap)
        out.append((name, size, b))
        heapq.heappush(heap, (load + size, b))
    return out


def balanced_buckets(df: DataFrame, key: str, size: str, n: int) -> DataFrame:
    """(key, size, bucket): greedy longest-first over a file list, which is small (one row a file); one task does it."""
    kind = dict(df.dtypes)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values([size, key], ascending=[False, True], kind="stable")
        return pd.DataFrame(longest_first_buckets(list(zip(group[key], group[size])), n), columns=[key, size, "bucket"])

    return df.select(key, size, F.lit(1).alias("_all")).groupBy("_all").applyInPandas(run, f"`{key}` {kind[key]}, `{size}` {kind[size]}, bucket int")


def format_size(n: Column) -> Column:
    shown = lambda p: F.bround(n / 1024.0**p, 1)  # ties to even, as printf does
    out = F.format_string("%.1f PB", shown(5))
    for unit, power in reversed(list(zip(("B", "KB", "MB", "GB", "TB"), range(5)))):
        out = F.when(n < 1024.0 ** (power + 1), F.format_string(f"%.1f {unit}", shown(power))).otherwise(out)
    return out


def round_robin(df: DataFrame, source: str, order: str) -> DataFrame:
    """Adds rn: a row's number in its source; in the order of (rn, source) sources take turns until each is used up (records.interleaved numbers that order)."""
    rn = F.row_number().over(Window.partitionBy(source).orderBy(order))
    return df.withColumn("rn", rn)


def temperature_weights(df: DataFrame, source: str, temperature: float) -> DataFrame:
    """(source, n, p): p proportional to n ** (1 / temperature)."""
    per = df.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n"))
    w = F.pow(F.col("n").cast("double"), F.lit(1 / temperature))
    return per.withColumn("p", w / F.sum(w).over(Window.partitionBy()))


def blend(weights: list[float], steps: int) -> list[tuple[int, int, int]]:
    """(step, source, how-manieth of it): at each step the source furthest behind its weight (the lowest on ties)."""
    taken, out = [0] * len(weights), []
    total = sum(weights)
    for i in range(steps):
        behind = [w / total * max(i, 1) - t for w, t in zip(weights, taken)]
        k = behind.index(max(behind))
        out.append((i, k, taken[k]))
        taken[k] += 1
    return out


def fixed_windows(df: DataFrame, key: str, length: str, seq: int) -> DataFrame:
    """(key, window, from, to): documents laid end to end, cut to windows of seq tokens with one token of overlap.

    Document starts are running totals over range partitions, so no task holds all rows.
    """
    placed = running_totals(df.select(key, length), key, [length]).withColumn("at", F.col(f"before_{length}")).where(F.col(length) > 0)
    windows = F.sequence(F.floor(F.greatest(F.col("at") - 1, F.lit(0)) / seq), F.floor((F.col("at") + F.col(length) - 1) / seq))
    out = placed.select(key, "at", length, F.explode(windows).alias("window"))
    low, high = F.greatest(F.col("at"), F.col("window") * seq), F.least(F.col("at") + F.col(length), (F.col("window") + 1) * seq + 1)
    return out.select(key, "window", (low - F.col("at")).alias("begin"), (high - F.col("at")).alias("end")).where("end > begin")


def template(df: DataFrame, fields: dict[str, str], pattern: str) -> Column:
    """A pattern with ``{name}`` filled from columns, one after another."""
    out = F.lit(pattern)
    for name, column in fields.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(F.col(column).cast("string"), F.lit("")))
    return out


def threads(spark, nodes: DataFrame, node: str, parent: str, text: str) -> DataFrame:
    """(leaf, path): every path from a root (null parent) to a leaf, texts joined by blank lines, by a recursive query.

    Paths are grown from roots; each step joins on the parent.
    """
    nodes.select(F.col(node).alias("id"), F.col(parent).alias("up"), F.col(text).alias("t")).createOrReplaceTempView("_thread_nodes")
    return spark.sql(
        """with recursive p(id, path, depth) as (
             select id, array(t), 1 from _thread_nodes where up is null
             union all select n.id, array_append(p.path, n.t), p.depth + 1 from _thread_nodes n join p on n.up = p.id)
           select p.id leaf, path, depth from p left anti join _thread_nodes n on n.up = p.id"""
    )


def stitched(df: DataFrame, keys: list[str], order: str, text: str) -> DataFrame:
    """(keys, text): texts of consecutive rows joined by blanks."""
    parts = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    return df.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda p: p["t"]), " ").alias("text"))


def code_switched(df: DataFrame, language: str, key: str, seconds: str, least: float, most: float, seed: int = 0) -> DataFrame:
    """(key, sample, place): utterances of all languages in a seeded order, chained to samples of least to most seconds.

    Ordering is by a hash, in as many independent chains as there are partitions.
    """
    kinds = dict(df.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, sample, place, total = TaskContext.get().partitionId(), 0, 0, 0.0
        for batch in batches:
            rows = []
            for k, s in zip(batch[key], batch[seconds]):
                if s > most:
                    continue
                if total >= least or total + s > most:
                    sample, place, total = sample + 1, 0, 0.0
                rows.append((k, (part << 40) + sample, place))
                place, total = place + 1, total + s
            yield pd.DataFrame(rows, columns=[key, "sample", "place"])

    ordered = df.repartition(F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(64))).sortWithinPartitions(F.xxhash64(key, F.lit(seed + 1)))
    return ordered.select(key, seconds).mapInPandas(run, f"`{key}` {kinds[key]}, sample long, place int")
