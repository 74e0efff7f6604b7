"""Substring deduplication by sliding spans of sentences.

Every run of consecutive sentences that is long enough (``enough``) is a span; spans are joined
globally by hash, and sentences covered by any span that is not the first of its kind (least doc_id,
then place) are removed.  Of the runs, the shortest from each sentence on and the shortest up to each
sentence are hashed: a run that occurs before has all of its parts occur before, and these cover it,
so they remove what all runs together would.  Long sentences, and text without sentence ends, are cut
at words that the words before them choose, so equal passages are cut alike at any offset.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loquarium.llm.common import small_batches, tidied

#: A span has at least so many sentences and words.
SENTENCES, WORDS = 2, 25
#: A sentence of more than ``PIECE`` words is cut after a word that its hash with the word before chooses, one in ``ONE_IN``, and after PIECE words at the latest.
PIECE, ONE_IN = 25, 8
#: Characters that count as a word at least, for scripts without blanks.
LETTERS = 8
#: Spans that a task settles among themselves before it sends them.
SETTLED = 500_000
#: A sentence ends after one of these (with closing quotes or brackets) and white space, after full-width ones in any case, or at a line end.
_END = re.compile(r"(?<=[.!?…])[\"'”’)\]]*\s+|(?<=[。！？])[」』”’）]*\s*|\n+")
_WORD = re.compile(r"\S+")


def _cuts(words: list[re.Match]) -> Iterator[list[re.Match]]:
    """The pieces of an over-long sentence."""
    first, before = 0, ""
    for i, m in enumerate(words):
        word = m.group()
        if i + 1 - first >= PIECE or zlib.crc32(f"{before} {word}".encode("utf-8", "surrogatepass")) % ONE_IN == 0:
            yield words[first : i + 1]
            first = i + 1
        before = word
    if first < len(words):
        yield words[first:]


def sentences(text: str) -> list[tuple[int, int, int]]:
    """(begin, end, words) of each sentence; together with what follows them up to the next they make up the text."""
    out, at = [], 0
    for m in [*_END.finditer(text), None]:
        end = m.start() if m else len(text)
        stop = m.end() if m else len(text)
        words = list(_WORD.finditer(text, at, end))
        for some in _cuts(words) if len(words) > PIECE else [words] if words else ():
            begin, last = some[0].start(), some[-1].end()
            out.append((begin, last, max(len(some), (last - begin) // LETTERS)))
        at = stop
    return out


def spans(text: str, parts: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, bytes]]:
    """(first sentence, number, digest) of the shortest sufficient run from each sentence on, and of that up to each sentence."""
    digests = [hashlib.blake2b(" ".join(text[a:b].split()).encode("utf-8", "surrogatepass"), digest_size=16).digest() for a, b, _ in parts]
    before = [0, *accumulate(n for _, _, n in parts)]
    enough = lambda i, j: j - i >= SENTENCES and before[j] - before[i] >= WORDS
    runs, j = set(), 0
    for i in range(len(parts)):
        while j < len(parts) and not enough(i, j):
            j += 1
        if enough(i, j):
            runs.add((i, j))
    i = 0
    for j in range(1, len(parts) + 1):
        while enough(i + 1, j):
            i += 1
        if enough(i, j):
            runs.add((i, j))
    for i, j in sorted(runs):
        yield i, j - i, hashlib.blake2b(b"".join(digests[i:j]), digest_size=16).digest()


@tidied
def _spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Spans with their hash (96 bits) and whether an earlier one of the same hash is among the SETTLED spans of the task around it."""
    kept: list[list] = [[], [], [], [], []]

    def settled() -> pd.DataFrame:
        out = pd.DataFrame(dict(zip(["id", "at", "n", "h1", "h2"], [np.array(x, "i8") for x in kept]))).sort_values(["id", "at"], kind="stable")
        for x in kept:
            x.clear()
        first = out.groupby(["h1", "h2"], sort=False)
        out["again"] = (first["id"].transform("first") != out["id"]) | (first["at"].transform("first") != out["at"])
        out.loc[out["again"], "h1"] = out["id"]  # known already: dealt by document, not by hash
        return out

    for batch in batches:
        for key, text in zip(batch["id"], batch["t"]):
            for i, n, d in spans(text, sentences(text)):
                for x, value in zip(kept, (key, i, n, int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:12], "little", signed=True))):
                    x.append(value)
            if len(kept[0]) >= SETTLED:
                yield settled()
    yield settled()


def without(text: str, drop: set[int]) -> str:
    """The text without some sentences and the white space after them."""
    parts, out = sentences(text), []
    if not parts:
        return text
    out.append(text[: parts[0][0]])
    for k, (a, _, _) in enumerate(parts):
        if k not in drop:
            out.append(text[a : parts[k + 1][0] if k + 1 < len(parts) else len(text)])
    return "".join(out).rstrip() if len(parts) - 1 in drop else "".join(out)


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, at, n): spans that repeat an earlier one; rows without doc_id or text have none.

    A task settles repeats among SETTLED spans at a time and sends one of a hash at most, so a passage in
    a third of all documents comes to its task once in so many spans, and is read there in order, not held.
    """
    small_batches(docs.sparkSession)
    d = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("t")).where("id is not null and t is not null")
    found = d.mapInPandas(_spans, "id long, at int, n int, h1 long, h2 int, again boolean")
    first = F.first(F.struct("id", "at")).over(Window.partitionBy("h1", "h2", "again").orderBy("id", "at"))
    return found.withColumn("first", first).where(F.col("again") | (F.struct("id", "at") > F.col("first"))).select("id", "at", "n")


def substring_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, n_sentences, n_removed) of every row: the text left after removing repeated spans.

    Null texts stay null and empty ones empty; rows without doc_id keep their text.  Equal rows of one
    doc_id are not repeats of each other; the same sentences go from both, as from rows of one doc_id
    with other texts.  Other columns, whatever their names, are ignored.
    """
    cuts = repeated_spans(docs, doc_id, text).groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list(F.sequence("at", F.col("at") + F.col("n") - 1)))).alias("cut"))

    @tidied
    def rebuild(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for body, cut in zip(batch["text"], batch["cut"]):
                if body is None:
                    rows.append((None, 0, 0))
                    continue
                drop = set() if cut is None else set(cut)
                rows.append((without(body, drop) if drop else body, len(sentences(body)), len(drop)))
            out = pd.DataFrame(rows, columns=["text", "n_sentences", "n_removed"])
            out.insert(0, "doc_id", batch["id"].to_numpy())
            yield out

    d = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text")).join(cuts, "id", "left")
    return d.mapInPandas(rebuild, "doc_id long, text string, n_sentences long, n_removed long")
