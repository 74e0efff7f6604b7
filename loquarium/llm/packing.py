"""Best-fit packing of documents into token sequences in bulk-synchronous rounds.

The state is two tables: pieces that have no place yet (number, length) and bins with their gaps.  A
round does this:

* a gap is offered as slots, as many as pieces of the largest remaining length fit into it (one at
  least); a sequence's gap is at first its whole length;
* pieces and slots are range-sorted by size together; each task sweeps its range upwards, and a slot
  takes the largest piece below it that no slot has taken (best fit: a piece's slot is the successor
  of its length among the slots that larger pieces leave).  Taking the last one is matching brackets,
  so a sweep is a prefix sum and a stable sort of nesting depths;
* what a range can't match is carried upwards: from the number of slots and pieces that each range has
  left over (one row a range) follows which ranks of pieces of which range meet which ranks of slots;
  conflicts between pieces for one slot are settled by these ranks, largest piece first;
* gaps are updated: a bin's slots are summed, and what is left of its gap stays in one part.

Rounds are repeated until no piece is left.  At first there are as many bins as the total length or the
pieces of more than half a sequence need; where the largest remaining piece is longer than all gaps,
the pieces that fit nowhere get as many new ones by the same rule.  Pieces of a whole sequence need no
round.  A round places the largest pieces of all bins, so the number of rounds does not grow with the
corpus but with the number of pieces in a sequence, and slower than that.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loquarium.llm.common import new_path, removed, small_batches, tidied, written
from loquarium.llm.tokens import encoder, forget

PIECES = "pid long, doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
SWEPT = "bin long, gap long, slot int, pid long, length long, part int, nth long"
#: Rows of a task are numbered from its partition's number times this on.
_EACH = 1 << 40


def pieces(docs: DataFrame, tokenizer: str, drops_space: bool, end_id: int, capacity: int, with_ids: bool, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(PIECES) of every document: whole where it fits, else cut every ``capacity`` ids; null text has the end id alone."""
    small_batches(docs.sparkSession)

    @tidied
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, number = encoder(tokenizer, drops_space), TaskContext.get().partitionId() * _EACH
        for batch in batches:
            keys, rows = [], []
            for key, raw in zip(batch["id"], enc.encode(batch["t"].tolist())):
                ids = np.append(np.frombuffer(raw, enc.dtype).astype("<u4"), np.uint32(end_id))
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity].tobytes()
                    keys.append(key)
                    rows.append((number, k, at, len(part) // 4, zlib.crc32(part), part if with_ids else None))
                    number += 1
            out = pd.DataFrame(rows, columns=["pid", "piece", "start", "length", "ids_crc32", "ids"])
            out.insert(1, "doc_id", pd.array(pd.Series(keys, dtype="object").where(lambda s: s.notna(), None), dtype="Int64") if len(keys) else pd.array([], dtype="Int64"))
            yield out
        forget()

    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("t")).mapInPandas(cut, PIECES)


def brackets(is_slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions of slots, positions of the pieces they take) in a row of pieces and slots by size; a slot takes the last piece before it that is free."""
    depth = np.cumsum(np.where(is_slot, -1, 1))
    level = depth + is_slot  # the level that a piece opens and its slot closes
    order = np.argsort(level, kind="stable")
    pair = np.flatnonzero((level[order[1:]] == level[order[:-1]]) & is_slot[order[1:]] & ~is_slot[order[:-1]])
    return order[pair + 1], order[pair]


@tidied
def _sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(SWEPT) of a range: every slot, with its piece or its number (from the smallest) among those left over; and the pieces left over, numbered from the largest."""
    rows = pd.concat(list(batches) or [pd.DataFrame(columns=["size", "kind", "key", "gap", "slot"])], ignore_index=True)  # numbers of one range
    size, kind, key, gap, slot = (rows[c].to_numpy("i8") for c in ("size", "kind", "key", "gap", "slot"))
    is_slot = kind == 1
    at, piece = brackets(is_slot)
    taken = np.full(len(size), -1)
    taken[at] = piece
    used = np.zeros(len(size), bool)
    used[piece] = True
    slots, over = np.flatnonzero(is_slot), np.flatnonzero(~is_slot & ~used)[::-1]
    mine, free = taken[slots], taken[slots] < 0
    whole = lambda values, missing: pd.array(values, "Int64") if missing is None else pd.arrays.IntegerArray(values.astype("i8"), missing)
    part = TaskContext.get().partitionId()
    yield pd.DataFrame({"bin": key[slots], "gap": gap[slots], "slot": slot[slots], "pid": whole(key[mine], free), "length": whole(size[mine], free), "part": whole(np.full(len(slots), part), ~free), "nth": whole(np.cumsum(free) - 1, ~free)})
    missing = np.ones(len(over), bool)
    yield pd.DataFrame({"bin": whole(over, missing), "gap": whole(over, missing), "slot": whole(over, missing), "pid": key[over], "length": size[over], "part": np.full(len(over), part), "nth": np.arange(len(over))})


def carried(counts: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Which ranks left over meet, from (part, slots, pieces) in ascending order: runs (part, first rank, length, first match) of slots and of pieces, sorted.

    At most two runs a part; a part's slots take pieces of lower parts, the nearest part's largest first.
    """
    stack: list[list[int]] = []  # (part, pieces taken, pieces left)
    slots, pieces_, match = [], [], 0
    for part, n_slots, n_pieces in counts:
        rank = 0
        while rank < n_slots and stack:
            top = stack[-1]
            n = min(n_slots - rank, top[2])
            slots.append((part, rank, n, match))
            pieces_.append((top[0], top[1], n, match))
            rank, match, top[1], top[2] = rank + n, match + n, top[1] + n, top[2] - n
            if not top[2]:
                stack.pop()
        if n_pieces:
            stack.append([part, 0, n_pieces])
    return tuple(np.array(sorted(x), "i8").reshape(-1, 4) for x in (slots, pieces_))


def _matched(swept: DataFrame) -> DataFrame:
    """The rows left over of a sweep, with the match (null: none) that they take part in."""
    left = swept.where("part is not null")
    counts = left.groupBy("part").agg(F.count("bin").alias("slots"), F.count("pid").alias("pieces")).orderBy("part").collect()  # a row a range
    runs = carried([(r["part"], r["slots"], r["pieces"]) for r in counts])
    keys = [r[:, 0] * _EACH + r[:, 1] for r in runs]

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            match = np.full(len(batch), -1)
            for k, own in enumerate((batch["bin"].notna().to_numpy(), batch["bin"].isna().to_numpy())):
                key = batch["part"].to_numpy("i8")[own] * _EACH + batch["nth"].to_numpy("i8")[own]
                at = np.searchsorted(keys[k], key, side="right") - 1
                found = np.full(len(key), -1)
                if len(runs[k]):
                    inside = (at >= 0) & (key - keys[k][at] < runs[k][at, 2])
                    found[inside] = (runs[k][at, 3] + key - keys[k][at])[inside]
                match[own] = found
            yield pd.DataFrame({c: batch[c].astype("Int64") for c in ("bin", "gap", "slot", "pid", "length")} | {"match": pd.arrays.IntegerArray(match, match < 0)})

    return left.mapInPandas(number, "bin long, gap long, slot int, pid long, length long, match long")


def pack(found: DataFrame, capacity: int) -> DataFrame:
    """Adds sequence_id and offset to a written table of pieces; equal pieces count each by itself."""
    spark = found.sparkSession
    left = found.where(F.col("length") < capacity).select("pid", "length")
    gaps = spark.createDataFrame([], "bin long, gap long")
    placed: list[str] = []
    old: list[str] = []
    bins, most_gap = 0, 0

    def kept(df: DataFrame, label: str) -> DataFrame:
        old.append(path := new_path(spark, label))
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    while True:
        n, least, most = left.agg(F.count("*"), F.min("length"), F.max("length")).first()
        if not n:
            break
        if most > most_gap:
            total, halves = left.where(F.col("length") > most_gap).agg(F.sum("length"), F.count_if(F.col("length") > capacity // 2)).first()
            more = max(-(-total // capacity), halves)
            gaps = gaps.unionAll(spark.range(bins, bins + more).select(F.col("id").alias("bin"), F.lit(capacity).cast("long").alias("gap")))
            bins += more
        # What is smaller than the least piece is smaller than all that come later.
        number = F.greatest(F.expr(f"gap div {most}"), F.lit(1))
        slots = gaps.where(F.col("gap") >= least).select("bin", "gap", number.alias("m")).select("bin", "gap", "m", F.explode(F.sequence(F.lit(0), F.col("m").cast("int") - 1)).alias("slot"))
        size = F.when(F.col("slot") == F.col("m") - 1, F.col("gap") - F.expr("gap div m") * F.col("slot")).otherwise(F.expr("gap div m"))
        items = slots.select(size.cast("long").alias("size"), F.lit(1).alias("kind"), F.col("bin").alias("key"), "gap", "slot")
        items = items.unionByName(left.select(F.col("length").alias("size"), F.lit(0).alias("kind"), F.col("pid").alias("key"), F.lit(0).cast("long").alias("gap"), F.lit(0).alias("slot")))
        order = ["size", "kind", "key", "slot"]
        swept = kept(items.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(_sweep, SWEPT), "packing-swept")
        matched = kept(_matched(swept), "packing-matched")
        late = matched.where("bin is not null").drop("pid", "length").join(matched.where("bin is null and match is not null").select("match", "pid", "length"), "match", "left")
        names = ["bin", "gap", "slot", "pid", "length"]
        slots = swept.where("part is null").select(*names).unionByName(late.select(*names))
        before = Window.partitionBy("bin").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)  # a bin's slots of one round
        slots = slots.select("bin", "gap", "pid", "length", (capacity - F.col("gap") + F.coalesce(F.sum("length").over(before), F.lit(0))).alias("offset"))
        placed.append(path := new_path(spark, "packing-round"))
        slots.write.parquet(path)
        now = spark.read.schema(slots.schema).parquet(path)
        past, old = old, []
        gaps = kept(now.groupBy("bin").agg((F.max("gap") - F.coalesce(F.sum("length"), F.lit(0))).alias("gap")).where("gap > 0"), "packing-gaps")
        left = kept(matched.where("bin is null and match is null").select("pid", "length"), "packing-left")
        most_gap = gaps.agg(F.max("gap")).first()[0] or 0
        for path in past:
            removed(spark, path)
    whole = found.where(F.col("length") == capacity).withColumns({"sequence_id": -1 - F.col("pid"), "offset": F.lit(0).cast("long")})
    if placed:
        places = spark.read.schema(slots.schema).parquet(*placed).where("pid is not null").select("pid", F.col("bin").alias("sequence_id"), "offset")
        whole = whole.unionByName(found.where(F.col("length") < capacity).join(places, "pid"))
    return whole.drop("pid")


def best_fit_packing(docs: DataFrame, tokenizer: str, drops_space: bool, end_id: int, capacity: int = 4096, with_ids: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset, and ids where asked for) of every piece.

    Every row is a document of its own, whatever its doc_id (null and repeated ones are kept as they
    are); null and empty texts are the end id alone.  Ids are those of the library by default: the
    string of a special token inside a text is that token.  Ties between equal pieces are settled by
    their place in the input.  Other columns of docs, whatever their names, are ignored.  An empty
    table gives no rows.
    """
    found = written(pieces(docs, tokenizer, drops_space, end_id, capacity, with_ids, doc_id, text), "pieces")
    return pack(found if with_ids else found.drop("ids"), capacity)
