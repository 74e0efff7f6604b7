"""Line deduplication by content-defined chunks of lines, at two scales.

A rolling hash over the hashes of the last ``ROLL`` lines chooses the lines that end a chunk, so a
boundary depends on those lines alone and equal passages are cut alike wherever they stand (a chunk
without a boundary is cut after ``MOST`` lines).  A chunk that crosses an edge of a repeated passage
matches nothing, so each two lines that follow each other but for blank ones are a piece of a second,
overlapping scale: a repeated passage of two lines or more loses all of them, wherever boundaries lie
and however short it is.  What has a 96-bit hash that occurs more than once anywhere is a repeat of
its first occurrence (least doc_id, text hash, place); pieces that follow each other in both places
are one run.  Runs are compared with their first occurrence byte by byte before they are removed.  A
line whose neighbours differ stays, and of each distinct line one copy at least.

Only hashes and places are exchanged by hash; of a hot chunk one row a task takes part in finding its
first occurrence, and the join that tells its copies has the written first occurrences on its other
side, so that AQE can split it.  Texts are moved once, if a run concerns them.  For the comparison
each distinct body of a run counts once a task, whatever its copies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loquarium.llm.common import small_batches, tidied, written

#: Lines under the rolling hash; one in ``ONE_IN`` lines ends a chunk; chunks end after ``MOST`` lines at the latest.
ROLL, ONE_IN, MOST = 2, 4, 16
#: A removable chunk has this many lines and characters at least (shorter ones may be blank lines; pairs have no such bound).
LEAST_LINES, LEAST_CHARS = 2, 100
#: Bits of the map of documents that a join concerns (2 MB).
SLOTS = 1 << 24
_MASK = (1 << 64) - 1
_PLACE = "id long, tag long, line int, n int"
_RUN = _PLACE + ", first_id long, first_tag long, first_line int"
_FIRST = ["first_id", "first_tag", "first_line", "n"]


def chunks(lines: list[str]) -> list[tuple[int, int]]:
    """(first line, number of lines) of each chunk."""
    digests = [int.from_bytes(hashlib.blake2b(x.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") for x in lines]
    out, first = [], 0
    for i in range(len(lines)):
        rolled = 0
        for d in digests[max(0, i - ROLL + 1) : i + 1]:
            rolled = (rolled * 0x9E3779B97F4A7C15 + d) & _MASK
        if i + 1 - first >= MOST or (rolled ^ rolled >> 32) % ONE_IN == 0:
            out.append((first, i + 1 - first))
            first = i + 1
    if first < len(lines):
        out.append((first, len(lines) - first))
    return out


def _candidates(text: str | None) -> Iterator[tuple[int, int, str]]:
    """(first line, lines, text) of the removable chunks and pairs of a text, in their order."""
    lines = (text or "").split("\n")
    full = [i for i, x in enumerate(lines) if x.strip()]
    pairs = {(a, b + 1 - a) for a, b in zip(full, full[1:])}
    large = {(first, n) for first, n in chunks(lines) if n >= LEAST_LINES and sum(map(len, lines[first : first + n])) + n - 1 >= LEAST_CHARS}
    for first, n in sorted(pairs | large):
        yield first, n, "\n".join(lines[first : first + n])


@tidied
def _hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for key, tag, text in zip(batch["id"], batch["tag"], batch["t"]):
            for first, n, body in _candidates(text):
                digest = hashlib.blake2b(body.encode("utf-8", "surrogatepass"), digest_size=12).digest()
                rows.append((key, tag, first, n, int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)))
        yield pd.DataFrame(rows, columns=["id", "tag", "line", "n", "h1", "h2"])


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Repeats of a document that overlap or meet, and do so where they occur first, as one."""
    for batch in batches:
        rows = []
        for key, tag, marks in zip(batch["id"], batch["tag"], batch["marks"]):
            last = None
            for m in marks:  # sorted by first_id, first_tag, shift, line
                if last and (last[4], last[5]) == (m["first_id"], m["first_tag"]) and last[2] - last[6] == m["shift"] and m["line"] <= last[2] + last[3]:
                    last[3] = max(last[3], m["line"] + m["n"] - last[2])
                else:
                    rows.append(last := [key, tag, m["line"], m["n"], m["first_id"], m["first_tag"], m["line"] - m["shift"]])
        yield pd.DataFrame(rows, columns=["id", "tag", "line", "n", "first_id", "first_tag", "first_line"])


@tidied
def _bodies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for key, tag, text, marks in zip(batch["id"], batch["tag"], batch["t"], batch["marks"]):
            lines = text.split("\n")
            rows += [(key, tag, m["line"], m["n"], m["first_id"], m["first_tag"], m["first_line"], "\n".join(lines[m["line"] : m["line"] + m["n"]])) for m in marks]
        yield pd.DataFrame(rows, columns=["id", "tag", "line", "n", "first_id", "first_tag", "first_line", "body"])


def _flagged(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs with _maybe: false only where (id, tag) is surely not among those of ids.

    A bitmap of fixed size (SLOTS bits in rows of 64) tells; it is broadcast whatever the corpus, and
    rows it clears need not be moved for a join.
    """
    slot = F.pmod(F.xxhash64("id", "tag"), F.lit(SLOTS))
    words = ids.select(slot.alias("s")).groupBy(F.expr("s div 64").alias("_word")).agg(F.expr("bit_or(shiftleft(1L, cast(s % 64 as int)))").alias("_mask"))
    d = docs.withColumn("_slot", slot).withColumn("_word", F.expr("_slot div 64"))
    bit = F.expr("(shiftright(_mask, cast(_slot % 64 as int)) & 1L) = 1L")
    return d.join(F.broadcast(words), "_word", "left").withColumn("_maybe", F.coalesce(bit, F.lit(False))).drop("_word", "_slot", "_mask")


def repeated_runs(docs: DataFrame) -> DataFrame:
    """(_RUN) of the runs of lines of docs (id, tag, t) whose hashes occur before; they may overlap."""
    found = written(docs.mapInPandas(_hashes, _PLACE + ", h1 long, h2 int"), "line-chunks")
    dup = found.groupBy("h1", "h2").agg(F.count("*").alias("times"), F.min(F.struct("id", "tag", "line")).alias("first")).where("times > 1")
    dup = written(dup.select("h1", "h2", *[F.col(f"first.{c}").alias(f"first_{c}") for c in ("id", "tag", "line")]), "line-firsts")
    mark = F.struct("first_id", "first_tag", (F.col("line") - F.col("first_line")).alias("shift"), "line", "n")
    copies = found.join(dup.hint("merge"), ["h1", "h2"]).where("id <> first_id or tag <> first_tag or line <> first_line")  # both sides grow with the corpus
    marks = copies.groupBy("id", "tag").agg(F.sort_array(F.collect_set(mark)).alias("marks"))  # of one document
    return written(marks.mapInPandas(_runs, _RUN), "line-runs")


def _differing(affected: DataFrame) -> DataFrame | None:
    """(_RUN) of the runs whose bytes are not those of their first occurrence; None where there are none."""
    bodies = affected.where("marks is not null").select("id", "tag", "t", "marks").mapInPandas(_bodies, _RUN + ", body string")
    variants = bodies.select(*_FIRST, "body").distinct()  # once a task for each body, before the exchange
    clash = written(variants.groupBy(*_FIRST).count().where("count > 1").select(*_FIRST), "line-clashes")
    if not clash.take(1):
        return None
    bodies = bodies.join(clash, _FIRST, "left_semi")
    first = bodies.where("id = first_id and tag = first_tag and line = first_line").groupBy(*_FIRST).agg(F.any_value("body").alias("kept"))
    return written(bodies.join(first, _FIRST).where("body <> kept").select("id", "tag", "line", "n").distinct(), "line-differing")


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns of docs, the text without repeated runs of lines, and lines_removed (long).

    Null and empty texts stay as they are, and so do rows without doc_id.  Rows are told apart by
    doc_id and text: of rows that share a doc_id with different texts each counts by itself; rows
    equal in both lose the same lines, and repeats between them do not count.  Any column names may
    stand in docs; lines_removed is replaced.  A text from which all lines go is empty.
    """
    small_batches(docs.sparkSession)
    names = [c for c in docs.columns if c != "lines_removed"]
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("t")).withColumn("tag", F.xxhash64("t"))
    runs = repeated_runs(d.where("id is not null and t is not null").select("id", "tag", "t"))
    firsts = runs.select(*[F.col(f"first_{c}").alias(c) for c in ("id", "tag", "line")], "n", "first_id", "first_tag", "first_line").distinct()
    mark = F.struct("line", "n", "first_id", "first_tag", "first_line")
    marks = written(runs.unionByName(firsts).groupBy("id", "tag").agg(F.collect_set(mark).alias("marks")), "line-marks")
    flagged = _flagged(d, marks)
    affected = written(flagged.where("_maybe").select("row", "id", "tag").join(marks.hint("merge"), ["id", "tag"], "left"), "line-affected").withColumn("t", F.col("row").getField(text))
    own = F.filter("marks", lambda m: (m["first_id"] != F.col("id")) | (m["first_tag"] != F.col("tag")) | (m["first_line"] != m["line"]))
    cut = affected.select("row", "id", "tag", "t", F.transform(own, lambda m: F.struct(m["line"].alias("line"), m["n"].alias("n"))).alias("cuts"))
    if (differing := _differing(affected)) is not None:
        stay = differing.groupBy("id", "tag").agg(F.collect_set(F.struct("line", "n")).alias("stay"))
        cut = cut.join(stay, ["id", "tag"], "left").withColumn("cuts", F.when(F.col("stay").isNull(), F.col("cuts")).otherwise(F.array_except("cuts", "stay"))).drop("stay")

    @F.pandas_udf("t string, n long")
    def rebuilt(texts: pd.Series, cuts: pd.Series) -> pd.DataFrame:
        rows = []
        for body, some in zip(texts, cuts):
            gone = {i for c in (() if some is None else some) for i in range(c["line"], c["line"] + c["n"])}
            rows.append(("\n".join(x for i, x in enumerate(body.split("\n")) if i not in gone) if gone else body, len(gone)))
        return pd.DataFrame(rows, columns=["t", "n"])

    done = cut.select("row", rebuilt.asNondeterministic()("t", "cuts").alias("new"))  # else filters on its columns would call it again
    done = done.select(*[(F.col("new.t") if c == text else F.col("row").getField(c)).alias(c) for c in names], F.col("new.n").alias("lines_removed"))
    rest = flagged.where("not _maybe").select(*[F.col("row").getField(c).alias(c) for c in names], F.lit(0).cast("long").alias("lines_removed"))
    return done.unionByName(rest)
