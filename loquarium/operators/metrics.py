"""Error rates, punctuation, answers, calibration, diarization."""

from __future__ import annotations

import itertools
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loquarium.functions import edit
from loquarium.functions.text import normalise_answer
from loquarium.operators.curation import running_totals


#: Cells of speakers by parts of a timeline that are worked out together, at most about.
CELLS = 4_000_000


def error_rate(df: DataFrame, ref: str, hyp: str, by: list[str] | None = None, chars: bool = False) -> DataFrame:
    """(by, errors, length, rate, ins_rate, del_rate, sub_rate): an empty corpus of reference tokens has an infinite rate."""
    counted = df.select(*(by or []), (edit.char_operations if chars else edit.word_operations)(F.col(ref), F.col(hyp)).alias("o"))
    out = (counted.groupBy(*by) if by else counted).agg(
        *[F.sum(f"o.{k}").alias(k) for k in ("subs", "ins", "dels")], F.sum(F.col("o.hits") + F.col("o.subs") + F.col("o.dels")).alias("length")
    )
    rate = lambda c: F.when(F.col("length") == 0, F.lit(float("inf"))).otherwise(c / F.col("length"))
    all_errors = F.col("subs") + F.col("ins") + F.col("dels")
    return out.select(*(by or []), all_errors.alias("errors"), "length", rate(all_errors).alias("rate"), rate(F.col("ins")).alias("ins_rate"), rate(F.col("dels")).alias("del_rate"), rate(F.col("subs")).alias("sub_rate"))


def per_utterance(df: DataFrame, ref: str, hyp: str, chars: bool = False) -> DataFrame:
    """Adds errors, length, rate; no reference tokens: 0 for an empty hypothesis, else infinite."""
    r, h = F.coalesce(ref, F.lit("")), F.coalesce(hyp, F.lit(""))
    errors, length = (edit.char_errors(r, h), F.length(r)) if chars else (edit.word_distance(r, h), F.size(edit.tokens(r)))
    out = df.withColumns({"errors": errors, "length": length})
    return out.withColumn("rate", F.when(F.col("length") > 0, F.col("errors") / F.col("length")).when(F.col("errors") == 0, F.lit(0.0)).otherwise(F.lit(float("inf"))))


def edge_cer(ref: Column, hyp: Column, n: int = 5) -> tuple[Column, Column]:
    """Character errors in per cent of the first and of the last n characters."""
    return F.levenshtein(F.substring(ref, 1, n), F.substring(hyp, 1, n)) / n * 100, F.levenshtein(F.right(ref, F.lit(n)), F.right(hyp, F.lit(n))) / n * 100


def length_gap(ref: Column, hyp: Column) -> Column:
    """|words - words| over the reference's words."""
    a, b = F.size(edit.tokens(ref)), F.size(edit.tokens(hyp))
    return F.abs(a - b) / F.greatest(a, F.lit(1e-9))


_PIECES = re.compile(r"[\w']+|[^\w\s]")


def _marked(text: str | None, marks: str) -> list[int]:
    """A text's words (0) and marks (their place from 1 on)."""
    return [marks.index(x) + 1 if x in marks else 0 for x in _PIECES.findall(text or "") if x in marks or x[0].isalnum() or x[0] in "_'"]


def many_punctuation_operations(refs: list, hyps: list, marks: str) -> np.ndarray:
    """(pairs, marks, 4): correct, substituted, inserted and deleted marks; words are masked so that only marks and their places count.

    Pairs of about the same lengths take their steps together; of each cell only its way back is kept.
    """
    a, b = ([_marked(x, marks) for x in side] for side in (refs, hyps))
    la, lb = (np.array([len(x) for x in side], np.int64) for side in (a, b))
    out = np.zeros((len(a), len(marks) + 1, 4), np.int64)
    order = np.lexsort((-lb, -la))
    while len(order):
        n, m = int(la[order[0]]), int(lb[order[:1024]].max())
        now, order = np.split(order, [min(1024, max(1, 4 * CELLS // ((n + 1) * (m + 1))))])
        k, i, j = len(now), la[now], lb[now]
        x, y = np.full((k, n), -1, np.int16), np.full((k, m), -2, np.int16)
        for row, p in enumerate(now.tolist()):
            x[row, : len(a[p])], y[row, : len(b[p])] = a[p], b[p]
        back = np.full((n + 1, k, m + 1), 2, np.int8)  # 0 both, 1 a mark of hyp alone, 2 one of ref alone
        back[0] = 1
        steps = np.arange(m + 1, dtype=np.int32)
        above = np.tile(steps, (k, 1))
        for r in range(1, n + 1):
            one = x[:, r - 1, None]
            cost = np.where(one == y, 0, np.where((one > 0) & (y > 0), 1, 2))  # a mark never replaces a word
            new = np.empty_like(above)
            new[:, 0] = r
            both = above[:, :-1] + cost
            np.minimum(both, above[:, 1:] + 1, out=new[:, 1:])
            new = np.minimum.accumulate(new - steps, axis=1) + steps
            back[r, :, 1:] = np.where((new[:, 1:] == both) & (cost < 2), 0, np.where(new[:, 1:] == new[:, :-1] + 1, 1, 2))
            above = new
        at = np.flatnonzero((i > 0) | (j > 0))
        while len(at):
            way, r, c = back[i[at], at, j[at]], i[at] - 1, j[at] - 1
            mark = np.where(way == 1, y[at, c], x[at, r]) if n and m else (x[at, r] if n else y[at, c])
            np.add.at(out, (now[at], mark, np.where(way == 0, np.where(x[at, r] == y[at, c], 0, 1) if n and m else 0, way + 1)), 1)
            i[at] -= way != 1
            j[at] -= way != 2
            at = at[(i[at] > 0) | (j[at] > 0)]
    return out[:, 1:]


def punctuation_operations(ref: str, hyp: str, marks: str) -> dict[str, list[int]]:
    """many_punctuation_operations of one pair, by mark."""
    return dict(zip(marks, many_punctuation_operations([ref], [hyp], marks)[0].tolist()))


def punctuation_error_rate(df: DataFrame, ref: str, hyp: str, marks: str = ".,!?") -> DataFrame:
    """(mark, correct, subs, ins, dels, rates) for each mark and for all of them (mark ``all``)."""

    def run(refs: pd.Series, hyps: pd.Series) -> pd.Series:
        return pd.Series([[(k, *v) for k, v in zip(marks, one)] for one in many_punctuation_operations(refs.tolist(), hyps.tolist(), marks).tolist()])

    udf = F.pandas_udf(run, "array<struct<mark:string,correct:int,subs:int,ins:int,dels:int>>")
    rows = df.select(F.explode(udf(F.col(ref), F.col(hyp))).alias("m")).select("m.*")
    out = rows.cube("mark").agg(*[F.sum(c).alias(c) for c in ("correct", "subs", "ins", "dels")]).withColumn("mark", F.coalesce("mark", F.lit("all")))
    total = F.col("correct") + F.col("subs") + F.col("ins") + F.col("dels")
    rate = lambda c: F.when(total > 0, c / total).otherwise(F.lit(0.0))
    return out.withColumns({**{f"{c}_rate": rate(F.col(c)) for c in ("correct", "subs", "ins", "dels")}, "error_rate": rate(F.col("subs") + F.col("ins") + F.col("dels"))})


#: White space of edit.tokens: (?U)\s of the JVM.
_WORDS = re.compile("[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def _words(text: str | None) -> list[str]:
    return _WORDS.findall(text) if text else []


def _best_f1(preds: pd.Series, refs: pd.Series) -> pd.Series:
    out = []
    for p, some in zip(preds, refs):
        a, found = _words(p), None
        held = Counter(a)
        for r in () if some is None else map(_words, some):
            shared = sum(min(n, held[t]) for t, n in Counter(r).items() if t in held) if a and r else 0
            f1 = shared * 2.0 / (len(a) + len(r)) if a and r else float(len(a) == len(r))
            found = f1 if found is None else max(found, f1)
        out.append(found)
    return pd.Series(out, dtype="Float64")


def answer_scores(df: DataFrame, pred: str, refs: str) -> DataFrame:
    """Adds exact and f1 (0 to 1): the best over an array of references, bags of normalised words."""
    # Columns of their own: lambdas would normalise again for each word.
    d = df.withColumns({"_pn": normalise_answer(F.col(pred)), "_rn": F.transform(F.col(refs), normalise_answer)})
    exact = F.array_max(F.transform("_rn", lambda r: (r == F.col("_pn")).cast("int")))
    return d.withColumns({"exact": exact, "f1": F.pandas_udf(_best_f1, "double")("_pn", "_rn")}).drop("_pn", "_rn")


#: Predictions and common references that meet in one task, and shared words that are counted together, at most about.
ANSWERS, REFERENCES, SHARED = 4096, 4096, 4_000_000


def _occurrences(texts: list[list[str]], names: dict, new: bool) -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, number of the word with its how-manieth occurrence there) of all words; without new, only of words in names."""
    of, what = [], []
    for i, words in enumerate(texts):
        seen: dict = {}
        for t in words:
            seen[t] = n = seen.get(t, 0) + 1
            k = names.setdefault((t, n), len(names)) if new else names.get((t, n))
            if k is not None:
                of.append(i)
                what.append(k)
    return np.array(of, np.int64), np.array(what, np.int64)


def _greatest_f1(preds: list[list[str]], refs: list[list[str]]) -> np.ndarray:
    """Of each prediction the best f1 over common references: lists of a word's references are counted, no pair is looked at by itself."""
    names: dict = {}
    ref, word = _occurrences(refs, names, True)
    ref = ref[np.argsort(word, kind="stable")]
    ends = np.cumsum(np.bincount(word, minlength=len(names)))
    sizes = np.array([len(x) for x in refs])
    of, what = _occurrences(preds, names, False)
    mine = np.array([len(x) for x in preds])
    out = np.where((mine == 0) & (sizes == 0).any(), 1.0, 0.0)
    many = np.bincount(word, minlength=len(names))[what]  # references to count for every word of a prediction
    per = np.zeros(len(preds) + 1, np.int64)
    np.cumsum(np.bincount(of, weights=many, minlength=len(preds)).astype(np.int64), out=per[1:])
    place, a = np.searchsorted(of, np.arange(len(preds) + 1)), 0
    while a < len(preds):
        b = max(a + 1, min(int(np.searchsorted(per, per[a] + SHARED, "right")) - 1, a + max(1, SHARED // len(refs))))
        some = slice(place[a], place[b])
        n = many[some]
        at = np.repeat(ends[what[some]] - n - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        shared = np.bincount(np.repeat(of[some] - a, n) * len(refs) + ref[at], minlength=(b - a) * len(refs)).reshape(b - a, len(refs))
        f1 = np.where(shared > 0, shared * 2.0 / np.maximum(mine[a:b, None] + sizes, 1), 0.0)
        out[a:b] = np.maximum(out[a:b], f1.max(axis=1))
        a = b
    return out


def common_answer_scores(df: DataFrame, key: list[str], pred: str, refs: DataFrame, text: str) -> DataFrame:
    """(key, exact, f1) as by answer_scores, each prediction against all rows of refs.

    Blocks of predictions meet chunks of references, both of bounded size.
    """
    n, m = max(1, -(-df.count() // ANSWERS)), max(1, -(-refs.count() // REFERENCES))
    place = lambda of, k: F.pmod(F.xxhash64(*of), F.lit(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    p = df.select(*key, normalise_answer(F.col(pred)).alias("_pn")).withColumn("_block", place(key, n))
    r = refs.select(normalise_answer(F.col(text)).alias("_rn")).where("_rn is not null").distinct().withColumn("_chunk", place(["_rn"], m))
    kinds = dict(df.dtypes)

    def meet(preds: pd.DataFrame, some: pd.DataFrame) -> pd.DataFrame:
        found = preds[key].copy()
        texts = set(some["_rn"])
        found["exact"] = pd.Series([None if x is None else int(x in texts) for x in preds["_pn"]], index=preds.index, dtype="Int32") if texts else pd.Series(pd.NA, index=preds.index, dtype="Int32")
        found["f1"] = pd.Series(_greatest_f1([_words(x) for x in preds["_pn"]], [_words(x) for x in some["_rn"]]) if texts else None, index=preds.index, dtype="Float64")
        return found

    a, b = p.withColumn("_chunk", every(m)).groupBy("_block", "_chunk"), r.withColumn("_block", every(n)).groupBy("_block", "_chunk")
    met = a.cogroup(b).applyInPandas(meet, ", ".join(f"`{k}` {kinds[k]}" for k in key) + ", exact int, f1 double")
    return met.groupBy(*key).agg(F.max("exact").alias("exact"), F.max("f1").alias("f1"))


def _lcs(a: list, b: list) -> int:
    """Length of the longest common subsequence, a row of the table in one number: its bits are the places of b that don't raise it."""
    where: dict = {}
    for j, y in enumerate(b):
        where[y] = where.get(y, 0) | 1 << j
    every = (1 << len(b)) - 1
    row = every
    for x in a:
        if seen := where.get(x, 0) & row:
            row = (row + seen | row - seen) & every
    return len(b) - row.bit_count()


def _shared(a: list, b: list) -> int:
    """Size of the common part of two bags."""
    left, n = Counter(b), 0
    for x in a:
        if left.get(x, 0):
            left[x] -= 1
            n += 1
    return n


@F.pandas_udf(T.StructType([T.StructField(n, T.DoubleType()) for n in ("rouge1", "rouge2", "rougeL")]))
def rouge(preds: pd.Series, refs: pd.Series) -> pd.DataFrame:
    """F-measures against the reference with the best ROUGE-1."""

    def score(p: list, r: list) -> tuple[float, float, float]:
        f = lambda s, x, y: 2 * s / (x + y) if s else 0.0
        x, y = list(zip(p, p[1:])), list(zip(r, r[1:]))
        return f(_shared(p, r), len(p), len(r)), f(_shared(x, y), len(x), len(y)), f(_lcs(p, r), len(p), len(r))

    cut = lambda t: re.findall(r"[a-z0-9]+", (t or "").lower())
    rows = [max((score(cut(p), cut(x)) for x in r), default=(0.0, 0.0, 0.0)) for p, r in zip(preds, refs)]
    return pd.DataFrame(rows, columns=["rouge1", "rouge2", "rougeL"])


def expected_calibration_error(df: DataFrame, score: str, correct: str, bins: int = 10) -> DataFrame:
    """ece over equal-width bins of the score."""
    b = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1))
    per = df.groupBy(b.alias("bin")).agg(F.count("*").alias("n"), F.avg(score).alias("conf"), F.avg(F.col(correct).cast("double")).alias("acc"))
    return per.agg((F.sum(F.col("n") * F.abs(F.col("conf") - F.col("acc"))) / F.sum("n")).alias("ece"))


def normalized_cross_entropy(df: DataFrame, score: str, correct: str) -> DataFrame:
    """nce; minus infinity where only one class is present."""
    c, p = F.col(correct).cast("double"), F.greatest(F.least(F.col(score), F.lit(1 - 1e-10)), F.lit(1e-10))
    sums = df.agg(F.count("*").alias("n"), F.sum(c).alias("k"), F.sum(F.when(F.col(correct) == 1, F.ln(p)).otherwise(F.ln(1 - p))).alias("l"))
    base = -(F.col("k") * F.ln(F.col("k") / F.col("n")) + (F.col("n") - F.col("k")) * F.ln(1 - F.col("k") / F.col("n")))
    return sums.select(F.when((F.col("k") == 0) | (F.col("k") == F.col("n")), F.lit(float("-inf"))).otherwise((base + F.col("l")) / base).alias("nce"))


def auc_roc(df: DataFrame, score: str, correct: str) -> DataFrame:
    """Area under the ROC curve; ties count half.

    Equal scores are one row first; the running sum is over range partitions.
    """
    per = df.groupBy(F.col(score).alias("p")).agg(F.sum(F.when(F.col(correct) == 1, 1).otherwise(0)).alias("pos"), F.sum(F.when(F.col(correct) == 1, 0).otherwise(1)).alias("neg"))
    return running_totals(per, "p", ["neg"]).withColumn("b", F.col("before_neg")).agg((F.sum(F.col("pos") * (F.col("b") + F.col("neg") * 0.5)) / (F.sum("pos") * F.sum("neg"))).alias("auc"))


def best_threshold(df: DataFrame, by: str, gain: str, start: Column) -> DataFrame:
    """(threshold, best): the value of by up to which the running sum of gain, from start on, is greatest (the first on ties)."""
    per = df.groupBy(F.col(by).alias("threshold")).agg(F.sum(gain).alias("g"))
    run = running_totals(per, "threshold", ["g"]).withColumn("best", F.col("before_g") + F.col("g") + start)
    return run.agg(F.max_by("threshold", F.struct(F.col("best"), -F.col("threshold"))).alias("threshold"), F.max("best").alias("best"))


def cp_wer(df: DataFrame, session: str, speaker: str, ref: str, hyp: str) -> DataFrame:
    """(session, cpwer): words of each speaker concatenated in order; the least error over assignments of hypothesis to reference speakers.

    Rows: session, ord, speaker, text columns of both sides (one of them may be null); all pairs of a batch of sessions are compared together.
    """
    lines = lambda c: F.transform(F.sort_array(F.collect_list(F.when(F.col(c).isNotNull(), F.struct(F.col("ord").alias("o"), F.col(c).alias("t"))))), lambda x: x["t"])
    per = df.groupBy(session, speaker).agg(lines(ref).alias("_r"), lines(hyp).alias("_h"))
    said = lambda c: F.collect_list(F.when(F.col(speaker).isNotNull() & (F.size(c) > 0), F.array_join(c, " ")))
    sides = per.groupBy(session).agg(said("_r").alias("_r"), said("_h").alias("_h"))
    d = sides.select(session, F.pandas_udf(_least_errors, "struct<errors:long,words:long>")("_r", "_h").alias("_x")).select(session, "_x.*")
    return d.withColumn("cpwer", F.when(F.col("words") > 0, F.col("errors") / F.col("words")).otherwise(F.lit(float("inf"))))


def _least_errors(refs: pd.Series, hyps: pd.Series) -> pd.DataFrame:
    sides = [([x.split() for x in r], [x.split() for x in h]) for r, h in zip(refs, hyps)]
    sizes = [max(len(r), len(h)) for r, h in sides]
    filled = [(r + [[]] * (n - len(r)), h + [[]] * (n - len(h))) for (r, h), n in zip(sides, sizes)]
    found = edit.distances([x for r, h in filled for x in r for _ in h], [y for r, h in filled for _ in r for y in h]).tolist()
    out, at = [], 0
    for (r, _), n in zip(sides, sizes):
        out.append((least_assignment([found[at + i * n : at + (i + 1) * n] for i in range(n)]), sum(map(len, r))))
        at += n * n
    return pd.DataFrame(out, columns=["errors", "words"])


def least_assignment(cost: list[list[int]]) -> int:
    """The least sum of one entry in each row and column: by permutations for a few speakers, else by dynamic programming over sets."""
    n = len(cost)
    if n <= 3:
        return min((sum(cost[i][p[i]] for i in range(n)) for p in itertools.permutations(range(n))), default=0)
    best = {0: 0}
    for row in cost:
        new: dict[int, int] = {}
        for used, c in best.items():
            for j in range(n):
                if not used >> j & 1:
                    k = used | 1 << j
                    new[k] = min(new.get(k, 1 << 60), c + row[j])
        best = new
    return min(best.values())


def diarization_error(df: DataFrame, session: str, collar: float = 0.0) -> DataFrame:
    """(session, total, miss, false_alarm, confusion, der) from rows (session, side 'ref'|'hyp', speaker, s, e).

    The timeline is cut at every boundary and swept once, part by part; speakers are matched so that they
    share most time.  Parts within collar of a reference boundary do not count.
    """

    def run(group: pa.Table) -> pa.Table:
        side, speaker = group["side"].to_pylist(), group["speaker"].to_pylist()
        s, e = (group[c].to_numpy().astype(float) for c in ("s", "e"))
        rows: dict = {"ref": {}, "hyp": {}}
        for i, (x, y) in enumerate(zip(side, speaker)):
            rows[x].setdefault(y, []).append(i)
        own = [i for x in rows["ref"].values() for i in x]
        edges = np.sort(np.concatenate([s[own], e[own]]))
        edges = edges[~np.isnan(edges)]
        cuts = np.unique(np.concatenate([s[~np.isnan(s)], e[~np.isnan(e)], edges - collar, edges + collar]))
        # Starts and ends of every speaker's intervals, each sorted: how many of them lie before a cut says whether one is open there.
        turns = [[(np.sort(s[i]), np.sort(e[i])) for x in rows[k].values() for i in [np.array(x)[e[x] > s[x]]]] for k in ("ref", "hyp")]
        n = max(*map(len, turns), 1)
        shared, sums, step = np.zeros((n, n)), np.zeros(4), max(1, CELLS // (2 * n))
        for at in range(0, len(cuts) - 1, step):
            some = cuts[at : at + step + 1]
            begin, d = some[:-1], np.diff(some)
            if collar > 0 and len(edges):
                mid, k = begin + d / 2, np.searchsorted(edges, begin + d / 2)
                near = np.minimum(np.abs(mid - edges[np.maximum(k - 1, 0)]), np.abs(mid - edges[np.minimum(k, len(edges) - 1)]))
                d = np.where(near < collar, 0.0, d)
            r, h = (np.array([np.searchsorted(a, begin, "right") > np.searchsorted(b, begin, "right") for a, b in side]).reshape(len(side), len(begin)) for side in turns)
            shared[: len(r), : len(h)] += (r * d) @ h.T
            nr, nh = r.sum(axis=0), h.sum(axis=0)
            sums += [(d * x).sum() for x in (nr, np.maximum(0, nr - nh), np.maximum(0, nh - nr), np.minimum(nr, nh))]
        scale = 10**6
        together = -least_assignment((-np.round(shared * scale)).astype(int).tolist()) / scale
        total, miss, false, both = sums.tolist()
        confusion = max(0.0, both - together)
        found = {"total": total, "miss": miss, "false_alarm": false, "confusion": confusion, "der": (miss + false + confusion) / total if total else float("inf")}
        return pa.table({session: group[session][:1]} | {k: [v] for k, v in found.items()})

    kind = dict(df.dtypes)[session]
    return df.select(session, "side", "speaker", "s", "e").groupBy(session).applyInArrow(run, f"`{session}` {kind}, total double, miss double, false_alarm double, confusion double, der double")


def running_rates(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Adds running average, maximum and sum of a session's values in order."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({"run_avg": F.avg(value).over(w), "run_max": F.max(value).over(w), "run_sum": F.sum(value).over(w)})
