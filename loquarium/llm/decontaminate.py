"""Benchmark decontamination by winnowing, in DataFrame functions alone.

Every ``GRAM`` consecutive words are a hashed gram; a window of ``WINDOW`` words holds
``WINDOW - GRAM + 1`` of them, and of each window the least (all of equal least ones) is kept.  Kept
grams, with their place and the words around, are the fingerprints of a text: about two in five
words.  A window that a document shares with an item has the same least gram at the same place in
both, so joining fingerprints by gram misses none.  A hit is extended word by word to both sides, as
far as a window with this gram can reach, and counts where it then covers a window.  Items shorter
than a window are one window of their own length; there every gram (of that length) is kept.  Words
are compared by 64-bit hashes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loquarium.llm.common import lower_ascii, plan_broadcast, written

WINDOW, GRAM = 8, 5
#: Words on either side of a gram that a window with it can hold.
REACH = WINDOW - GRAM
#: Rows of item fingerprints up to which they are broadcast (about 200 bytes each); beyond, the join is shuffled.
BROADCAST_PRINTS = 500_000
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_PRINT = "array<struct<at:int,len:int,gram:bigint,near:array<bigint>>>"


def words(text: Column) -> Column:
    """Words of the lower-cased text; none for null."""
    return F.coalesce(F.regexp_extract_all(lower_ascii(text), F.lit(_WORD), F.lit(0)), F.array().cast("array<string>"))


def _hashes(w: Column) -> Column:
    return F.transform(w, lambda x: F.xxhash64(x))


def _grams(h: Column, n: int) -> Column:
    """Hashes of all n consecutive words, by place; null for texts of fewer."""
    return F.when(F.size(h) >= n, F.transform(F.sequence(F.lit(0), F.size(h) - n), lambda i: F.xxhash64(F.lit(n), *[F.get(h, i + k) for k in range(n)])))


def _least(g: Column) -> Column:
    """The least gram of every window, by the window's place; null for texts without a whole window."""
    return F.when(F.size(g) > REACH, F.transform(F.sequence(F.lit(0), F.size(g) - 1 - REACH), lambda i: F.least(*[F.get(g, i + k) for k in range(REACH + 1)])))


def _kept(g: Column, least: Column) -> Column:
    """Places of grams that are the least of some window: equal to the greatest of the least grams of the windows that hold them."""
    some = F.filter(F.sequence(F.lit(0), F.size(g) - 1), lambda p: F.get(g, p) == F.greatest(*[F.get(least, p - k) for k in range(REACH + 1)]))
    return F.when(least.isNotNull(), some)


def _prints(t: DataFrame, lengths: list[int], own: bool) -> Column:
    """(_PRINT) fingerprints of texts with columns h, g, least: for windows of these lengths; own: for a window as long as the text only, where the text is short."""
    h, g = F.col("h"), F.col("g")
    around = lambda p: F.transform(F.sequence(p - REACH, p + GRAM + REACH - 1), lambda i: F.get(h, i))  # noqa: E731 - null beyond the text
    parts = []
    for n in lengths:
        if n == WINDOW:
            parts.append(F.transform(_kept(g, F.col("least")), lambda p: F.struct(p.alias("at"), F.lit(WINDOW).alias("len"), F.get(g, p).alias("gram"), around(p).alias("near"))))
        else:
            all_ = F.transform(_grams(h, n), lambda x, p: F.struct(p.alias("at"), F.lit(n).alias("len"), x.alias("gram"), F.slice(h, p + 1, F.lit(n)).alias("near")))  # noqa: B023
            parts.append(F.when(F.size(h) == n, all_) if own else all_)
    return F.concat(*[F.coalesce(x.cast(_PRINT), F.array().cast(_PRINT)) for x in parts]) if parts else F.array().cast(_PRINT)


def _hashed(df: DataFrame, text: str, *keep: Column) -> DataFrame:
    t = df.select(*keep, _hashes(words(F.col(f"`{text}`"))).alias("h"))
    return t.withColumn("g", _grams(F.col("h"), GRAM)).withColumn("least", _least(F.col("g")))


def item_prints(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(len, gram, near, items): each distinct fingerprint with the ids of the items that hold it."""
    t = _hashed(items, text, F.col(f"`{item_id}`").cast("string").alias("item"))
    found = t.select("item", F.explode(_prints(t, list(range(1, WINDOW + 1)), own=True)).alias("p")).select("item", "p.len", "p.gram", "p.near")
    return found.groupBy("len", "gram", "near").agg(F.collect_set("item").alias("items"))


def _extended(near: Column, other: Column) -> tuple[Column, Column]:
    """How many words agree to the left and to the right of a gram whose own words agree."""
    same = lambda k: F.coalesce(F.get(near, F.lit(k)) == F.get(other, F.lit(k)), F.lit(False))
    run = lambda ks: reduce(lambda rest, k: F.when(same(k), rest + 1).otherwise(F.lit(0)), reversed(ks), F.lit(0))
    return run(list(range(REACH - 1, -1, -1))), run(list(range(REACH + GRAM, REACH + GRAM + REACH)))


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_words, n_hit, n_items, items (sorted as strings), spans (at, end).

    A row is a document by itself, whatever its doc_id: null and repeated ones are never put together.
    Null and empty texts have no words and hit nothing; null item texts hold no window; a null item_id
    never counts as an item (its windows still hit words); rows of one item_id are one item.  Other
    columns, whatever their names, are ignored.  A document lists all items that its windows hold, so
    a window of very many items makes long rows.
    """
    known = written(item_prints(items, item_id, item_text), "item-prints")
    counted = known.groupBy("len").count().collect()  # at most WINDOW rows
    lengths, total = sorted(r["len"] for r in counted), sum(r["count"] for r in counted)
    d = _hashed(docs, text, F.monotonically_increasing_id().alias("row"), F.col(f"`{doc_id}`").alias("doc_id"))
    # A document always has one row, with its word count, whatever its fingerprints are.
    first = F.array(F.struct(F.lit(-1).alias("at"), F.lit(0).alias("len"), F.lit(None).cast("long").alias("gram"), F.lit(None).cast("array<bigint>").alias("near"))).cast(_PRINT)
    w = d.select("row", "doc_id", F.size("h").cast("long").alias("n"), F.explode(F.concat(first, _prints(d, lengths, own=False))).alias("p")).select("row", "doc_id", "n", "p.*")
    hit = w.join(plan_broadcast(known.withColumnRenamed("near", "theirs"), total, BROADCAST_PRINTS), ["gram", "len"], "left")
    left, right = _extended(F.col("near"), F.col("theirs"))
    short = F.col("len") < WINDOW
    agrees = F.when(short, F.col("near") == F.col("theirs")).otherwise((F.slice("near", REACH + 1, GRAM) == F.slice("theirs", REACH + 1, GRAM)) & (left + right >= REACH))
    span = F.when(short, F.struct("at", (F.col("at") + F.col("len")).alias("end"))).otherwise(F.struct((F.col("at") - left).alias("at"), (F.col("at") + GRAM + right).alias("end")))
    hit = (
        hit.where((F.col("at") < 0) | (F.col("items").isNotNull() & agrees))
        .groupBy("row")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.max("n").alias("n_words"),
            F.array_sort(F.collect_set(F.when(F.col("at") >= 0, span))).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
    )
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    grown = lambda a, x: F.struct(F.greatest(a["end"], x["end"]).alias("end"), (a["n"] + F.greatest(x["end"] - F.greatest(a["end"], x["at"]), F.lit(0))).alias("n"))
    return hit.select("doc_id", "n_words", F.aggregate("hits", zero, grown, lambda a: a["n"]).alias("n_hit"), F.size("items").cast("long").alias("n_items"), "items", F.col("hits").alias("spans"))
