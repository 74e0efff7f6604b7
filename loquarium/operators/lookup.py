"""N-gram indexes, candidate search, nearest neighbours."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loquarium.functions.edit import tokens


#: Queries and items that meet in one task, at most about.
QUERY_BLOCK, ITEM_CHUNK = 1024, 16_384
#: Queries whose products are held at once.
SLICE = 64


def ngrams(items: Column, n: int) -> Column:
    """Arrays of n neighbours, none for shorter input."""
    return F.when(F.size(items) >= n, F.transform(F.sequence(F.lit(1), F.size(items) - n + 1), lambda i: F.slice(items, i, F.lit(n)))).otherwise(F.array().cast("array<array<string>>"))


def ngram_counts(df: DataFrame, text: str, n: int, pad: bool = True) -> DataFrame:
    """(history, word, n) of word n-grams, padded with sentence marks."""
    words = F.concat(F.array_repeat(F.lit("<s>"), n - 1), tokens(F.col(text)), F.array(F.lit("</s>"))) if pad else tokens(F.col(text))
    grams = df.select(words.alias("w")).select(F.explode(ngrams(F.col("w"), n)).alias("g"))  # words by themselves first, not anew for each n-gram
    return grams.groupBy(F.array_join(F.slice("g", 1, n - 1), " ").alias("history"), F.element_at("g", n).alias("word")).agg(F.count("*").alias("n"))


def backoff_probabilities(counts: DataFrame, discount: float = 1.0) -> DataFrame:
    """(history, word, p, backoff): absolute discounting; backoff is the mass left to the shorter history."""
    per = counts.groupBy("history").agg(F.sum("n").alias("total"), F.count("*").alias("types"))
    return counts.join(per, "history").select("history", "word", ((F.col("n") - discount) / F.col("total")).alias("p"), (discount * F.col("types") / F.col("total")).alias("backoff"))


def prune(counts: DataFrame, least: int) -> DataFrame:
    """n-grams that occur often enough."""
    return counts.where(F.col("n") >= least)


def word_windows(df: DataFrame, text: str, width: int = 16, shift: int = 8) -> DataFrame:
    """(fragment): distinct windows of words; a shorter text is one."""
    w = F.col("w")
    n = F.when(F.size(w) <= width, F.lit(0)).otherwise(F.ceil((F.size(w) - width) / shift)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), n), lambda i: F.array_join(F.slice(w, i * shift + 1, F.lit(width)), " "))
    return df.select(tokens(F.col(text)).alias("w")).where(F.size("w") > 0).select(F.explode(cut).alias("fragment")).distinct()


def _char_ngrams(letters: Column, n: int) -> Column:
    """Distinct runs of n letters, from an array of letters."""
    at = F.sequence(F.lit(0), F.size(letters) - n)
    return F.array_distinct(F.when(F.size(letters) >= n, F.transform(at, lambda i: F.concat(*[F.get(letters, i + k) for k in range(n)]))))


def phrase_index(phrases: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """(ngram, phrase, begin, size): character n-grams of each phrase with their place."""
    t = F.lower(F.col(text))
    at = F.when(F.length(t) >= n, F.sequence(F.lit(1), F.length(t) - n + 1))
    return phrases.select(F.col(key).alias("phrase"), t.alias("t"), F.explode(at).alias("i")).select(F.substring("t", F.col("i"), F.lit(n)).alias("ngram"), "phrase", (F.col("i") - 1).alias("begin"), F.lit(n).alias("size"))


def candidates(index: DataFrame, phrases: DataFrame, docs: DataFrame, key: str, text: str, n: int, k: int = 10, least: float = 0.8) -> DataFrame:
    """(key, phrase, hits, coverage, rank): phrases most of whose n-grams occur in a text.

    Distinct n-grams on both sides meet in an equi-join; ties by phrase.
    """
    grams = docs.select(F.col(key), F.split(F.lower(F.col(text)), "").alias("_letters")).select(key, F.explode(_char_ngrams(F.col("_letters"), n)).alias("ngram"))
    sizes = index.groupBy("phrase").agg(F.countDistinct("ngram").alias("total"))
    hits = grams.join(index.select("ngram", "phrase").distinct(), "ngram").groupBy(key, "phrase").agg(F.count("*").alias("hits"))
    scored = hits.join(sizes, "phrase").withColumn("coverage", F.col("hits") / F.col("total")).where(F.col("coverage") >= least)
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("coverage"), "phrase"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).select(key, "phrase", "hits", "coverage", "rank")


def best_window(hits: DataFrame, keys: list[str], at: str, width: int) -> DataFrame:
    """(keys, begin, hits): the place where most hits fall into a moving window."""
    w = Window.partitionBy(*keys).orderBy(at).rangeBetween(0, width - 1)
    per = hits.withColumn("_n", F.count("*").over(w))
    return per.groupBy(*keys).agg(F.max_by(at, F.struct(F.col("_n"), -F.col(at))).alias("begin"), F.max("_n").alias("hits"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def knn(queries: DataFrame, items: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """(query, item, score, rank) of the k greatest dot products, exact, ties by item; queries is a stated set against all rows.

    Blocks of queries meet chunks of items, both of bounded size, in a matrix product; a task returns
    at most k items for each of its queries.  Rows with a null key or vector take no part.
    """
    side = lambda df, name: df.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.lit(name).alias("side"))
    q, x = side(queries, 0), side(items, 1)
    blocks, chunks = max(1, -(-q.count() // QUERY_BLOCK)), max(1, -(-x.count() // ITEM_CHUNK))
    place = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    both = q.withColumns({"block": place(blocks), "chunk": F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))}).unionByName(x.withColumns({"block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))), "chunk": place(chunks)}))

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        a, b = group[group["side"] == 0], group[group["side"] == 1].sort_values("id")
        if not len(a) or not len(b):
            return pd.DataFrame({"query": [], "item": [], "score": []}).astype({"query": "i8", "item": "i8", "score": "f8"})
        ids, own = b["id"].to_numpy("i8"), a["id"].to_numpy("i8")
        left, right, out = np.array(a["v"].tolist()), np.array(b["v"].tolist()).T, []
        for at in range(0, len(own), SLICE):
            some = own[at : at + SLICE]
            scores = left[at : at + SLICE] @ right
            scores[some[:, None] == ids] = -np.inf
            least = np.partition(scores, -k, axis=1)[:, -k, None] if k < len(ids) else -np.inf
            row, col = np.nonzero((scores >= least) & (scores > -np.inf))  # the k greatest and what equals the last of them
            found = scores[row, col]
            order = np.lexsort((col, -found, row))
            row, col, found = row[order], col[order], found[order]
            first = np.arange(len(row)) - np.searchsorted(row, row) < k
            out.append(pd.DataFrame({"query": some[row[first]], "item": ids[col[first]], "score": found[first]}))
        return pd.concat(out)

    scored = both.groupBy("block", "chunk").applyInPandas(meet, "query long, item long, score double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "item"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k)


def drop_same_document(neighbours: DataFrame, owner: DataFrame, query: str, item: str) -> DataFrame:
    """Neighbours whose chunk is not of the query's own document; owner is (chunk, doc)."""
    q, i = (owner.select(F.col("chunk").alias(c), F.col("doc").alias(f"_{c}")) for c in (query, item))
    return neighbours.join(q, query).join(i, item).where(F.col(f"_{query}") != F.col(f"_{item}")).drop(f"_{query}", f"_{item}")
