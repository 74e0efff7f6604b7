"""Replacing phrases in text by weighted, non-overlapping choice; aligning strings by n-gram costs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def choose(replacements: list[tuple[int, int, str, float]], least: float = 0.5, penalty: float = 0.0) -> list[tuple[int, int, str, float]]:
    """(begin, end, text, weight) that stay: of two that overlap, the heavier, from left to right; weights lose penalty for each character of difference in length."""
    scored = [(b, e, t, w - penalty * abs(len(t) - (e - b))) for b, e, t, w in replacements]
    out: list[tuple[int, int, str, float]] = []
    for r in sorted((x for x in scored if x[3] > least), key=lambda x: (x[0], -x[3], x[1])):
        if out and r[0] < out[-1][1]:
            if r[3] > out[-1][3]:
                out[-1] = r
            continue
        out.append(r)
    return out


def apply(text: str, replacements: list[tuple[int, int, str, float]]) -> str:
    """Applied from the end, so earlier places stay valid."""
    for b, e, t, _ in sorted(replacements, reverse=True):
        text = text[:b] + t + text[e:]
    return text


REPLACEMENTS = T.ArrayType(T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("text", T.StringType()), T.StructField("weight", T.DoubleType())]))


@F.pandas_udf(T.StringType())
def substitute(texts: pd.Series, replacements: pd.Series) -> pd.Series:
    """texts with their array<struct<begin, end, text, weight>> applied."""
    pick = lambda rs: choose([(r["begin"], r["end"], r["text"], r["weight"]) for r in (rs if rs is not None else [])])
    return pd.Series([None if t is None else apply(t, pick(rs)) for t, rs in zip(texts, replacements)])


def align(a: list[str], b: list[str], cost: dict[tuple[str, str], float], most: int = 3, missing: float = 10.0) -> tuple[float, list[tuple[str, str]]]:
    """The cheapest way to read a as b in pairs of up to ``most`` symbols each; unknown single pairs cost ``missing`` (0 if equal)."""
    inf = float("inf")
    best = [[(inf, None)] * (len(b) + 1) for _ in range(len(a) + 1)]
    best[0][0] = (0.0, None)
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            if best[i][j][0] == inf:
                continue
            for x in range(0, min(most, len(a) - i) + 1):
                for y in range(0, min(most, len(b) - j) + 1):
                    if not x and not y:
                        continue
                    left, right = " ".join(a[i : i + x]), " ".join(b[j : j + y])
                    c = cost.get((left, right), 0.0 if left == right and x == 1 else missing if x + y <= 2 else inf)
                    if (new := best[i][j][0] + c) < best[i + x][j + y][0]:
                        best[i + x][j + y] = (new, (i, j, left, right))
    out, i, j = [], len(a), len(b)
    while best[i][j][1]:
        i, j, left, right = best[i][j][1]
        out.append((left, right))
    return best[len(a)][len(b)][0], out[::-1]
