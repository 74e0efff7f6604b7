"""Token counts of flat, unindexed token files by a separator scan.

The files hold nothing but ids; a document ends with the end-of-document id.  Files are cut into
blocks of equal size wherever documents lie; each block is searched for separators with one vector
operation, and a prefix scan over the blocks' summaries (separators so far, last separator) stitches
the documents that cross block boundaries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loquarium.llm.common import new_path, partitions, plan_broadcast, small_batches, tidied, written
from loquarium.llm.files import new_file, open_output, read_range
from loquarium.llm.tokens import encoder

BLOCK_BYTES = 4 << 20
#: Files up to which the table of their places is broadcast (16 bytes a row); beyond, the join is shuffled.
BROADCAST_FILES = 1_000_000
FILES = "part int, path string, n_bytes long, width int"


def write_flat(docs: DataFrame, folder: str, tokenizer: str, drops_space: bool, end_id: int, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(files, members): one flat file for each input partition, in its order, and which doc_id is its how-manieth document.

    Texts are not moved: a file is as large as the ids of one input split.  The string of a special
    token inside a text is ordinary text, so that a text never holds the separator.
    """
    small_batches(docs.sparkSession)

    @tidied
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, part, out, size, at, path = encoder(tokenizer, drops_space, specials=False), TaskContext.get().partitionId(), None, 0, 0, ""
        end = np.array([end_id], enc.dtype).tobytes()
        for batch in batches:
            if out is None:
                path = new_file(folder, ".ids")
                out = open_output(path)
            for ids in enc.encode(batch["t"].tolist()):
                out.write(ids + end)
                size += len(ids) + len(end)
            yield pd.DataFrame({"part": part, "nth": np.arange(at, at + len(batch)), "doc_id": batch["id"], "path": None, "n_bytes": 0, "width": 0})
            at += len(batch)
        if out is not None:
            out.close()
            yield pd.DataFrame({"part": [part], "nth": [-1], "doc_id": pd.array([pd.NA], dtype="Int64"), "path": [path], "n_bytes": [size], "width": [enc.dtype.itemsize]})

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("t"))
    both = written(rows.mapInPandas(write, "part int, nth long, doc_id long, path string, n_bytes long, width int"), "flat-files")
    return both.where("nth < 0").select("part", "path", "n_bytes", "width"), both.where("nth >= 0").select("part", "nth", "doc_id")


def scan(files: DataFrame, end_id: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(part, nth, start, n_tokens, ended): every document of every file, start counting ids from the first file on.

    n_tokens leaves out the separator.  Ids after a file's last separator are a document with ended
    false; an empty file has none.
    """

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                ids = np.frombuffer(read_range(r.path, r.at, r.size), f"<u{r.width}")
                found = np.flatnonzero(ids == end_id).astype("i8") + r.at // r.width
                yield pd.DataFrame({"part": [r.part], "block": [r.block], "found": [found]})

    blocks = files.where("n_bytes > 0").select("part", "path", "width", "n_bytes", F.explode(F.sequence(F.lit(0), F.floor((F.col("n_bytes") - 1) / block_bytes).cast("int"))).alias("block"))
    blocks = blocks.select("part", "path", "width", "block", (F.col("block").cast("long") * block_bytes).alias("at"), F.least(F.lit(block_bytes).cast("long"), F.col("n_bytes") - F.col("block").cast("long") * block_bytes).alias("size"))
    found = blocks.repartition(partitions(files.sparkSession), "part", "block").mapInPandas(search, "part int, block int, found array<long>")
    before = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = found.select("part", "found", F.coalesce(F.sum(F.size("found").cast("long")).over(before), F.lit(0)).alias("n"), F.coalesce(F.max(F.array_max("found")).over(before), F.lit(-1)).alias("last"))
    at = F.sequence(F.lit(0), F.size("found") - 1)
    one = lambda i: F.struct((F.col("n") + i).alias("nth"), F.when(i > 0, F.get("found", i - 1)).otherwise(F.col("last")).alias("prev"), F.get("found", i).alias("sep"))
    docs = carried.where(F.size("found") > 0).select("part", F.explode(F.transform(at, one)).alias("d")).select("part", "d.nth", (F.col("d.prev") + 1).alias("at"), (F.col("d.sep") - F.col("d.prev") - 1).alias("n_tokens"), F.lit(True).alias("ended"))
    tail = carried.groupBy("part").agg(F.sum(F.size("found").cast("long")).alias("nth"), F.coalesce(F.max(F.array_max("found")), F.lit(-1)).alias("sep"))
    ids = files.select("part", F.expr("n_bytes div width").alias("ids"))
    open_end = tail.join(ids, "part").where("sep + 1 < ids").select("part", "nth", (F.col("sep") + 1).alias("at"), (F.col("ids") - F.col("sep") - 1).alias("n_tokens"), F.lit(False).alias("ended"))
    base = ids.select("part", F.coalesce(F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))  # a row for each file
    return docs.unionByName(open_end).join(plan_broadcast(base, files.count(), BROADCAST_FILES), "part").select("part", "nth", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ended")


def token_counts(spark: SparkSession, docs: DataFrame, tokenizer: str, drops_space: bool, end_id: int) -> DataFrame:
    """(doc_id, start, n_tokens): writes the documents as flat token files and counts them by scanning for separators."""
    files, members = write_flat(docs, new_path(spark, "flat-tokens"), tokenizer, drops_space, end_id)
    counted = written(scan(files, end_id), "token-counts")
    return members.join(counted, ["part", "nth"], "left").select("doc_id", "start", "n_tokens")
