"""Records for training: sampling, sentence blocks, filters on turns and masks, prompt templates, subtitles and token case."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def subsample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows that a seeded hash of the key chooses."""
    return df.withColumn("_h", F.xxhash64(F.lit(seed), key)).orderBy("_h", key).limit(n).drop("_h")


def sentence_blocks(df: DataFrame, doc: str, order: str, tokens: str, target: int, longest: int = 512) -> DataFrame:
    """(doc, block, first, last, tokens): consecutive sentences grouped until they reach the target.

    A block has two sentences at least and never leaves a single one behind it; documents of one
    sentence, and those with a sentence longer than longest, have none.
    """
    sentences = df.where(F.col(tokens) > 0).groupBy(doc).agg(F.sort_array(F.collect_list(F.struct(F.col(order).cast("long").alias("i"), F.col(tokens).cast("long").alias("n")))).alias("s"))
    sentences = sentences.where(F.size("s") > 1).where(~F.exists("s", lambda x: x["n"] > longest))
    block = "struct<first:bigint,last:bigint,tokens:bigint>"
    start = F.struct(F.array().cast(f"array<{block}>").alias("done"), F.lit(None).cast("long").alias("first"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("sum"), F.lit(0).cast("long").alias("seen"))

    def step(a: Column, x: Column) -> Column:
        first, n, total, seen = F.coalesce(a["first"], x["i"]), a["n"] + 1, a["sum"] + x["n"], a["seen"] + 1
        left = F.size("s") - seen
        closes = ((total >= target) & (left > 1) & (n >= 2)) | (left == 0)
        one = F.array(F.struct(first.alias("first"), x["i"].alias("last"), total.alias("tokens")))
        zero = F.lit(0).cast("long")
        return F.struct(
            F.when(closes, F.concat(a["done"], one)).otherwise(a["done"]).alias("done"), F.when(~closes, first).alias("first"), F.when(closes, zero).otherwise(n).alias("n"), F.when(closes, zero).otherwise(total).alias("sum"), seen.alias("seen")
        )

    return sentences.select(doc, F.posexplode(F.aggregate("s", start, step, lambda a: a["done"])).alias("block", "b")).select(doc, "block", "b.*")


def with_turns(df: DataFrame, turns: str, least: int = 2) -> DataFrame:
    """Threads of several turns."""
    return df.where(F.size(turns) >= least)


def unmasked(df: DataFrame, mask: str, length: int) -> DataFrame:
    """Records with something to learn among their first positions; a null mask has nothing."""
    return df.where(F.coalesce(F.exists(F.slice(mask, 1, length), lambda x: x != 0), F.lit(False)))


def only_fields(df: DataFrame, names: list[str]) -> DataFrame:
    """The named columns, in the table's order; a name that is not there is an error."""
    if missing := [n for n in names if n not in df.columns]:
        raise ValueError(f"no such columns: {', '.join(missing)}")
    return df.select(*[c for c in df.columns if c in names])


def template_fields(pattern: str, columns: list[str] | None = None) -> list[str]:
    """Names in braces of a pattern, in order; with columns given, one that is none of them is an error."""
    names = re.findall(r"\{([^{}]*)\}", pattern)
    if columns is not None and (unknown := [n for n in names if n not in columns]):
        raise ValueError(f"the pattern names no columns: {', '.join(unknown)}")
    return names


def interleaved(df: DataFrame, source: str, rn: str, out: str = "step") -> DataFrame:
    """Adds out: the place of a row, its rn-th of a source, where sources take turns until each is used up."""
    sizes = df.groupBy(source).agg(F.max(rn).alias("_n")).groupBy().agg(F.collect_list(F.struct(F.col(source).alias("s"), F.col("_n").alias("n"))).alias("_sizes"))  # a row a source
    before = lambda x: F.least(x["n"], F.col(rn) - 1) + F.when((x["s"] < F.col(source)) & (x["n"] >= F.col(rn)), 1).otherwise(0)
    return df.join(F.broadcast(sizes)).withColumn(out, F.aggregate("_sizes", F.lit(0).cast("long"), lambda a, x: a + before(x))).drop("_sizes")


def restored_case(text: Column, tokens: Column, blank: str = "▁") -> Column:
    """Tokens of a lower-cased text with the text's own letters; a token that is not what the text has there stays."""

    def one(own: str | None, parts) -> list | None:
        if parts is None:
            return None
        at, out = 0, []
        for t in parts:
            own = None if t is None else own  # from there on no place is known
            if own is None:
                out.append(t)
                continue
            marked, core = t.startswith(blank), t.replace(blank, "")
            at += marked and at > 0
            here = own[at : at + len(core)]
            out.append((blank if marked else "") + here if here.lower() == core else t)
            at += len(core)
        return out

    def run(texts: pd.Series, parts: pd.Series) -> pd.Series:
        return pd.Series([one(x, p) for x, p in zip(texts, parts)], dtype=object)

    return F.pandas_udf(run, "array<string>")(text, tokens)


def packed_lines(words: Column, most: int) -> Column:
    """Words put into lines of at most so many characters, each as full as it gets; a longer word is a line of its own."""

    def step(a: Column, w: Column) -> Column:
        longer = F.concat_ws(" ", F.element_at(a, -1), w)
        return F.when((F.size(a) > 0) & (F.length(longer) <= most), F.concat(F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))), F.array(longer))).otherwise(F.concat(a, F.array(w)))

    return F.aggregate(words, F.array().cast("array<string>"), step)
