"""Edit distances and error rates as columns; Arrow UDFs work out many pairs at once by bit-parallel rows."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def tokens(text: Column) -> Column:
    """White-space tokens; none for null or blank."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"(?U)\s+"), lambda t: t != "")


#: Bytes of the tables of pairs that are worked out together, at most about, and pairs at most.
BYTES, PAIRS = 32_000_000, 4096
_ALL, _ONE = np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(1)


def _numbered(a: list, b: list) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
    """Two lists of texts or of token lists as ((numbers laid end to end, lengths), ...), and how many numbers there are."""
    lengths = [np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b)]
    if isinstance(a[0], str):
        flat = np.frombuffer("".join(chain(a, b)).encode("utf-32-le", "surrogatepass"), "<u4")
        seen = np.zeros(int(flat.max(initial=0)) + 1, bool)
        seen[flat] = True
        flat, n = (np.cumsum(seen, dtype=np.int32) - 1)[flat], int(seen.sum())
    else:
        names: dict = {}
        flat = np.array([names.setdefault(t, len(names)) for x in chain(a, b) for t in x], np.int32)
        n = len(names)
    cut = int(lengths[0].sum())
    return [(flat[:cut], lengths[0]), (flat[cut:], lengths[1])], n


def _grid(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, pad: int) -> np.ndarray:
    """(pairs, places) of numbers, filled up with pad."""
    at = np.arange(int(lengths.max(initial=0)))
    grid = np.full((len(starts), len(at)), pad, np.int32)
    inside = at < lengths[:, None]
    grid[inside] = flat[(starts[:, None] + at)[inside]]
    return grid


def _matches(a: np.ndarray, b: np.ndarray, words: int, n: int) -> Iterator[list[np.ndarray]]:
    """For each place of b (words arrays over pairs): bit i says whether a's i-th element is the one there."""
    k, places = a.shape
    if k * n * words * 8 <= BYTES:
        table, base = np.zeros((words, k * (n + 1)), np.uint64), np.arange(k) * (n + 1)
        for i in range(places):
            table[i >> 6][base + a[:, i]] |= _ONE << np.uint64(i & 63)
        at = (base + b.T).astype(np.int64)
        for j in range(b.shape[1]):
            yield [x.take(at[j]) for x in table]
    else:
        bits = np.zeros((k, words * 8), np.uint8)
        for j in range(b.shape[1]):
            bits[:, : -(-places // 8)] = np.packbits(a == b[:, j, None], axis=1, bitorder="little")
            yield list(np.ascontiguousarray(bits.view("<u8").T))


def _swept(a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray, n: int, keep: bool) -> tuple[np.ndarray, tuple | None]:
    """Distances of pairs in falling order of lb, by Myers' and Hyyro's bit vectors in words of 64.

    A word's bits are the steps up and down between neighbouring rows of a column.  keep: besides, the
    columns' steps down and to the right: (rises, falls) of rows for places 0.., of columns for places 1...
    """
    k, words = len(la), max(1, -(-a.shape[1] // 64))
    up, down = np.full((words, k), _ALL), np.zeros((words, k), np.uint64)
    shape = (b.shape[1], words, k)
    kept = tuple(np.zeros(shape, np.uint64) for _ in range(4)) if keep else None
    open_ = np.searchsorted(-lb, -np.arange(b.shape[1]), "left")  # pairs that have a place j
    for j, matches in enumerate(_matches(a, b, words, n)):
        m = int(open_[j])
        if kept:
            kept[0][j], kept[1][j] = up, down
        right, left = _ONE, np.uint64(0)
        for w in range(words):
            eq, pv, mv = matches[w][:m], up[w, :m], down[w, :m]
            xv = eq | mv
            if w:
                eq = eq | left
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph, mh = mv | ~(xh | pv), pv & xh
            if kept:
                kept[2][j, w, :m], kept[3][j, w, :m] = ph, mh
            carry = (ph >> np.uint64(63), mh >> np.uint64(63)) if w + 1 < words else None
            ph, mh = (ph << _ONE) | right, (mh << _ONE) | left
            np.bitwise_or(mh, ~(xv | ph), out=pv)
            np.bitwise_and(ph, xv, out=mv)
            if carry:
                right, left = carry
    found = lb.copy()
    for w in range(words):
        inside = np.clip(la - 64 * w, 0, 64)
        mask = np.where(inside == 64, _ALL, (_ONE << np.minimum(inside, 63).astype(np.uint64)) - _ONE)
        found += np.bitwise_count(up[w] & mask).astype(np.int64) - np.bitwise_count(down[w] & mask)
    return found, kept


def _blocks(a: list, b: list, some: list[int], keep: bool) -> Iterator[tuple]:
    """(places in a, a, lengths, b, lengths, distances, kept) of pairs of about the same lengths, of a bounded size together."""
    (fa, la), (fb, lb) = (sides := _numbered([a[i] for i in some], [b[i] for i in some]))[0]
    sa, sb = np.cumsum(la) - la, np.cumsum(lb) - lb
    order, index = np.lexsort((-la, -lb)), np.array(some)
    while len(order):
        words = -(-int(la[order[:PAIRS]].max()) // 64) or 1
        wide = int(lb[order[0]])
        each = words * (256 + 4 * 64 + (32 * wide if keep else 0)) + 12 * wide
        now, order = np.split(order, [min(PAIRS, max(1, BYTES // each))])
        x, y = _grid(fa, sa[now], la[now], sides[1]), _grid(fb, sb[now], lb[now], sides[1])
        yield index[now], x, la[now], y, lb[now], *_swept(x, la[now], y, lb[now], sides[1], keep)


def distances(a: list, b: list) -> np.ndarray:
    """Levenshtein distances of many pairs of texts, or of token lists."""
    out = np.zeros(len(a), np.int64)
    if some := [i for i, (x, y) in enumerate(zip(a, b)) if x != y]:
        for now, _, _, _, _, found, _ in _blocks(a, b, some, False):
            out[now] = found
    return out


def many_operations(refs: list, hyps: list) -> np.ndarray:
    """(hits, substitutions, insertions, deletions) of one best alignment of each pair; ties prefer substitution, then insertion, then deletion."""
    out = np.zeros((len(refs), 4), np.int64)
    out[:, 0] = [len(x) for x in refs]
    some = [i for i, (x, y) in enumerate(zip(refs, hyps)) if x != y]
    for now, a, la, b, lb, _, (up, down, right, left) in _blocks(refs, hyps, some, True) if some else ():
        counts, i, j, at = np.zeros((len(now), 4), np.int64), la.copy(), lb.copy(), np.flatnonzero((la > 0) & (lb > 0))
        while len(at):
            r, c = i[at] - 1, j[at] - 1
            w, bit = r >> 6, (r & 63).astype(np.uint64)
            step = lambda plus, minus: (plus[c, w, at] >> bit & _ONE).astype(np.int8) - (minus[c, w, at] >> bit & _ONE).astype(np.int8)
            same, across = a[at, r] == b[at, c], step(right, left)
            both = same | (across + step(up, down) == 1)
            one = np.where(same, 0, np.where(both, 1, np.where(across == 1, 2, 3)))
            counts[at, one] += 1
            i[at] -= one != 2
            j[at] -= one != 3
            at = at[(i[at] > 0) & (j[at] > 0)]
        counts[:, 2] += j
        counts[:, 3] += i
        out[now] = counts
    return out


def operations(ref: list, hyp: list) -> tuple[int, int, int, int]:
    """many_operations of one pair."""
    return tuple(many_operations([ref], [hyp])[0].tolist())


@F.pandas_udf(T.IntegerType())
def _text_distance(refs: pd.Series, hyps: pd.Series) -> pd.Series:
    out = pd.Series(distances(refs.fillna("").tolist(), hyps.fillna("").tolist()), dtype="Int32")
    return out.mask(refs.isna() | hyps.isna())


@F.pandas_udf(T.IntegerType())
def _word_distance(refs: pd.Series, hyps: pd.Series) -> pd.Series:
    return pd.Series(distances([x.split() if x else [] for x in refs], [x.split() if x else [] for x in hyps]))


@F.pandas_udf(T.IntegerType())
def _array_distance(refs: pd.Series, hyps: pd.Series) -> pd.Series:
    return pd.Series(distances([[] if x is None else list(x) for x in refs], [[] if x is None else list(x) for x in hyps]))


def token_distance(ref: Column, hyp: Column) -> Column:
    """Levenshtein distance of two token arrays."""
    return _array_distance(ref, hyp)


def word_distance(ref: Column, hyp: Column) -> Column:
    """The same of the white-space tokens of two texts."""
    return _word_distance(ref, hyp)


def char_errors(ref: Column, hyp: Column) -> Column:
    """Levenshtein distance of two texts."""
    return _text_distance(ref, hyp)


def cer(ref: Column, hyp: Column) -> Column:
    """Character errors over reference characters; an empty reference counts as one character."""
    return char_errors(ref, hyp) / F.greatest(F.length(ref), F.lit(1))


def wer(ref: Column, hyp: Column) -> Column:
    """Word errors over reference words; an empty reference counts as one word."""
    return word_distance(ref, hyp) / F.greatest(F.size(tokens(ref)), F.lit(1))


_OPERATIONS = T.StructType([T.StructField(n, T.IntegerType()) for n in ("hits", "subs", "ins", "dels")])


def _operations_udf(split):
    def run(refs: pd.Series, hyps: pd.Series) -> pd.DataFrame:
        found = many_operations([split(x) for x in refs.fillna("")], [split(x) for x in hyps.fillna("")])
        return pd.DataFrame(found, columns=["hits", "subs", "ins", "dels"])

    return F.pandas_udf(run, _OPERATIONS)


word_operations = _operations_udf(str.split)
char_operations = _operations_udf(str)
