"""Language identification with interpolated Kneser-Ney character models.

A model holds, for each order, the sorted 64-bit hashes of the n-grams and of the contexts seen in
any language, with a row of log-probabilities (or back-off weights) by language.  A text's language is
that of the least cross-entropy per character; a text whose least cross-entropy lies far above what
held-back training texts of that language show is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loquarium.llm.common import give_back, small_batches, tidied
from loquarium.llm.shingles import mix

ORDER = 4
#: The classifier is fitted on at most so many rows of each language (least hashes of the id); one in HELD of them calibrates rejection.
SAMPLE_ROWS, HELD = 1500, 5
#: Rejected: cross-entropy over the calibration median by so many median deviations, plus a term for short texts.
DEVIATIONS, SHORT = 50.0, 6.0
#: Characters scored at once.
SLICE = 100_000
UNDETERMINED = "und"
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)], bool))
    return _letters[0]


def codes(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(which text, n-gram code of ORDER characters, number of letters by text) in slices of whole texts.

    Letters are lower-cased, anything else between letters is one blank; a text starts with blanks.
    A code has 16 bits a character, the last character lowest.
    """
    at = 0
    while at < len(texts):
        first, size, some = at, 0, []
        while at < len(texts) and (not some or size < SLICE):
            some.append((texts[at] or "").lower())
            size += len(some[-1])
            at += 1
        points = np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), "<u4")
        owner = np.repeat(np.arange(first, at), [len(x) for x in some])
        letter = _is_letter()[points]
        start = np.ones(len(points), bool)
        start[1:] = owner[1:] != owner[:-1]
        keep = letter.copy()
        keep[1:] |= letter[:-1] & ~start[1:]
        point, own, start = np.where(letter, points, 0x20)[keep].astype(np.uint64) & np.uint64(0xFFFF), owner[keep], None
        code = point.copy()
        for back in range(1, ORDER):
            earlier = np.full(len(point), 0x20, np.uint64)
            if back < len(point):
                earlier[back:] = np.where(own[back:] == own[:-back], point[:-back], np.uint64(0x20))
            code |= earlier << np.uint64(16 * back)
        yield own, code, np.bincount(owner[letter], minlength=at)[first:at]


def _tail(code: np.ndarray, n: int) -> np.ndarray:
    return code & np.uint64((1 << 16 * n) - 1)


class SortedHashes:
    """Rows by 64-bit hash: a sorted array, entered by the hash's leading bits."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray):
        hashed = mix(keys + np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(hashed)
        self.hashes, self.rows = hashed[order], rows[order].astype(np.float32)
        self.shift = np.uint64(64 - max(1, (2 * len(keys)).bit_length()))
        self.starts = np.searchsorted(self.hashes >> self.shift, np.arange((1 << (64 - int(self.shift))) + 1, dtype=np.uint64))
        self.most = int(np.diff(self.starts).max(initial=0))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row numbers; -1 where a key is not known."""
        hashed = mix(keys + np.uint64(0x9E3779B97F4A7C15))
        at, out = self.starts[(hashed >> self.shift).astype(np.int64)], np.full(len(keys), -1)
        todo = np.arange(len(keys))
        for _ in range(self.most):
            todo = todo[at[todo] < len(self.hashes)]
            got = self.hashes[at[todo]]
            same = got == hashed[todo]
            out[todo[same]] = at[todo[same]]
            todo = todo[got < hashed[todo]]
            at[todo] += 1
        return out


class KneserNey:
    """Interpolated Kneser-Ney models of several languages, from (code, language, count) of ORDER-grams."""

    def __init__(self, languages: list[str], code: np.ndarray, language: np.ndarray, count: np.ndarray):
        self.languages, self.median, self.deviation = languages, np.zeros(len(languages)), np.ones(len(languages))
        width = len(languages)
        tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        keys, inverse = np.unique(code, return_inverse=True)
        counts = np.zeros((len(keys), width))
        np.add.at(counts, (inverse, language), count)
        for n in range(ORDER, 0, -1):
            tables[n] = (keys, counts)
            if n > 1:  # below the highest order: in how many contexts, not how often
                shorter, inverse = np.unique(_tail(keys, n - 1), return_inverse=True)
                kinds = np.zeros((len(shorter), width))
                np.add.at(kinds, inverse, (counts > 0).astype(float))
                keys, counts = shorter, kinds
        self.grams: dict[int, SortedHashes] = {}
        self.backoff: dict[int, SortedHashes] = {}
        keys, counts = tables[1]
        total, kinds, cut = counts.sum(axis=0), (counts > 0).sum(axis=0), self._discount(counts)
        even = 1.0 / (len(keys) + 1)
        self.unknown = np.log(np.maximum(cut * kinds, 1e-9) / np.maximum(total, 1e-9) * even).astype(np.float32)
        lower = (np.maximum(counts - cut, 0) + cut * kinds * even) / np.maximum(total, 1e-9)
        lower = np.maximum(lower, 1e-12)
        self.grams[1] = SortedHashes(keys, np.log(lower))
        for n in range(2, ORDER + 1):
            below = tables[n - 1][0]
            keys, counts = tables[n]
            contexts, inverse = np.unique(keys >> np.uint64(16), return_inverse=True)
            total, kinds, cut = np.zeros((len(contexts), width)), np.zeros((len(contexts), width)), self._discount(counts)
            np.add.at(total, inverse, counts)
            np.add.at(kinds, inverse, (counts > 0).astype(float))
            rest = np.where(total > 0, cut * kinds / np.maximum(total, 1), 1.0)
            own = np.maximum(counts - cut, 0) / np.maximum(total, 1)[inverse]
            lower = own + rest[inverse] * lower[np.searchsorted(below, _tail(keys, n - 1))]
            self.grams[n] = SortedHashes(keys, np.log(lower))
            self.backoff[n] = SortedHashes(contexts, np.log(rest))

    @staticmethod
    def _discount(counts: np.ndarray) -> np.ndarray:
        once, twice = (counts == 1).sum(axis=0), (counts == 2).sum(axis=0)
        return np.clip(np.where(once > 0, once / np.maximum(once + 2 * twice, 1), 0.5), 0.1, 0.95)

    def log_probabilities(self, code: np.ndarray) -> np.ndarray:
        """Natural logarithms by character (rows) and language."""
        out = np.zeros((len(code), len(self.languages)), np.float32)
        todo = np.arange(len(code))
        for n in range(ORDER, 0, -1):
            key = _tail(code[todo], n)
            row = self.grams[n].find(key)
            hit = row >= 0
            out[todo[hit]] += self.grams[n].rows[row[hit]]
            todo, key = todo[~hit], key[~hit]
            if n == 1:
                out[todo] += self.unknown
            elif len(todo):
                row = self.backoff[n].find(key >> np.uint64(16))
                known = row >= 0
                out[todo[known]] += self.backoff[n].rows[row[known]]
            if not len(todo):
                break
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cross-entropy per character by text and language, scored characters, letters)."""
        total = np.zeros((len(texts), len(self.languages)))
        n, letters, done = np.zeros(len(texts), np.int64), [], 0
        for own, code, count in codes(texts):
            letters.append(count)
            if len(own):
                starts = np.flatnonzero(np.diff(own, prepend=-1))
                total[own[starts]] -= np.add.reduceat(self.log_probabilities(code), starts, axis=0, dtype=np.float64)
                n[own[starts]] = np.diff(np.append(starts, len(own)))
        return total / np.maximum(n, 1)[:, None], n, np.concatenate(letters) if letters else np.zeros(0, np.int64)

    def calibrate(self, entropy: np.ndarray, language: np.ndarray, n: np.ndarray) -> None:
        """Median and median deviation of cross-entropy, by language, over held-back texts of some length."""
        for k in range(len(self.languages)):
            own = entropy[(language == k) & (n >= 100), k]
            if len(own):
                self.median[k] = np.median(own)
                self.deviation[k] = max(0.02, np.median(np.abs(own - self.median[k])))
            else:
                self.median[k] = np.inf

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        """lang_pred, score, cross_entropy, rejected of each text."""
        entropy, n, letters = self.entropies(texts)
        if not self.languages:
            return pd.DataFrame({"lang_pred": [UNDETERMINED] * len(texts), "score": 0.0, "cross_entropy": np.nan, "rejected": True})
        best = entropy.argmin(axis=1)
        least = entropy[np.arange(len(texts)), best]
        score = 1 / np.exp(-(entropy - least[:, None]) * np.minimum(n, 100)[:, None]).sum(axis=1)
        none = letters == 0
        limit = self.median[best] + DEVIATIONS * self.deviation[best] + SHORT / np.sqrt(np.maximum(n, 1))
        names = np.array([*self.languages, UNDETERMINED], dtype=object)
        return pd.DataFrame({"lang_pred": names[np.where(none, len(self.languages), best)], "score": np.where(none, 0.0, score), "cross_entropy": np.where(none, np.nan, least), "rejected": none | (least > limit)})


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> KneserNey:
    """A model of the languages in docs; rows with a null id, text or language teach nothing."""
    d = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t"), F.col(lang).alias("l")).where("id is not null and t is not null and l is not null")
    key = F.xxhash64("id", F.lit(7))
    # Twice the bound are drawn by hash before they are ranked, so a frequent language is no large task.
    share = d.groupBy("l").agg(F.least(F.lit(1.0), 2 * SAMPLE_ROWS / F.count("*")).alias("share"))  # a row for each language
    drawn = d.select("id", "l", key.alias("k")).join(F.broadcast(share), "l").where(F.pmod("k", F.lit(1 << 30)) < F.col("share") * (1 << 30))
    chosen = drawn.withColumn("r", F.row_number().over(Window.partitionBy("l").orderBy("k", "id"))).where(F.col("r") <= SAMPLE_ROWS)
    chosen = chosen.select("id", "l", (F.pmod("r", F.lit(HELD)) == 0).alias("held")).distinct()
    rows = d.join(F.broadcast(chosen), ["id", "l"])  # at most SAMPLE_ROWS a language

    small_batches(docs.sparkSession)

    @tidied
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.reset_index(drop=True)
            for name, own in batch[~batch["held"]].groupby("l"):
                for _, code, _ in codes(own["t"].tolist()):
                    values, n = np.unique(code, return_counts=True)
                    yield pd.DataFrame({"l": name, "code": values.view("i8"), "n": n})

    counted = rows.mapInPandas(count, "l string, code long, n long").groupBy("l", "code").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counted["l"].unique())
    index = {x: i for i, x in enumerate(languages)}
    model = KneserNey(languages, counted["code"].to_numpy("i8").view("u8"), counted["l"].map(index).to_numpy("i8"), counted["n"].to_numpy("f8"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @tidied
    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = batch[batch["held"] & batch["l"].isin(index)]
            entropy, n, _ = shared.value.entropies(own["t"].tolist())
            k = own["l"].map(index).to_numpy("i8")
            yield pd.DataFrame({"k": k, "e": entropy[np.arange(len(own)), k] if len(own) else np.zeros(0), "n": n})

    if languages:
        found = rows.mapInPandas(measure, "k int, e double, n long").toPandas()
        entropy = np.full((len(found), len(languages)), np.inf)
        entropy[np.arange(len(found)), found["k"].to_numpy("i8")] = found["e"]
        model.calibrate(entropy, found["k"].to_numpy("i8"), found["n"].to_numpy("i8"))
    shared.unpersist()
    return model


def identify(docs: DataFrame, model: KneserNey, text: str = "text") -> DataFrame:
    """docs with lang_pred, score, cross_entropy and rejected (columns of these names are replaced).

    Every whole text is scored, in slices of SLICE characters.  Rows are scored each by itself, so
    null and repeated ids make no difference; docs may have any other columns.  Null texts and texts without letters are ``und`` with score 0 and rejected.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    new = ["lang_pred", "score", "cross_entropy", "rejected"]

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for some in texts:
            yield shared.value.predict(some.tolist())
        give_back()

    small_batches(docs.sparkSession)
    udf = F.pandas_udf(run, "lang_pred string, score double, cross_entropy double, rejected boolean").asNondeterministic()  # else filters on its columns would call it again
    names = [c for c in docs.columns if c not in new]
    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), udf(F.col(f"`{text}`")).alias("found"))
    return found.select(*[F.col("row").getField(c).alias(c) for c in names], *[F.col("found").getField(c).alias(c) for c in new])


def held_out(doc_id: str = "doc_id"):
    """Whether the third of the documents that never teaches holds this one; false for null."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def teaching(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    return docs.where(F.crc32(F.col(doc_id).cast("string")) % 3 != 1)
