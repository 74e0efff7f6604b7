"""Language choice from ranked predictions, as one expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SUPPORTED = ["ca", "es", "eu", "gl"]
#: Substrings that mark Catalan.
CATALAN = [" l'", " d'", "ç", " ny", "això", "qüestió"]


def choose(predictions: Column, primary: Column | None = None, delta: float = 0.2, low: float = 0.6, least: float = 0.25) -> Column:
    """struct(lang, conf) from array<struct<lang, conf>> ordered by confidence; ordered rules, first match wins."""
    lang = lambda i: F.get(predictions, F.lit(i))["lang"]
    conf = lambda i: F.get(predictions, F.lit(i))["conf"]
    l1, c1, l2, c2 = lang(0), conf(0), lang(1), conf(1)
    made = lambda a, c: F.struct(a.alias("lang"), c.alias("conf"))
    first, second = made(l1, c1), made(l2, c2)
    is_primary = (lambda x: F.coalesce(primary == x, F.lit(False))) if primary is not None else lambda x: F.lit(False)
    mine = F.get(F.filter(predictions, lambda p: p["lang"] == primary), F.lit(0)) if primary is not None else F.lit(None).cast("struct<lang:string,conf:double>")
    pair = lambda a, b: (l1 == a) & (l2 == b)
    near = c1 - c2 <= delta
    rules = [
        (F.size(predictions) == 0, made(F.lit("unknown"), F.lit(0.0))),
        (~l1.isin(SUPPORTED) & (c1 < 0.5) & mine.isNotNull() & (primary.isin(SUPPORTED) if primary is not None else F.lit(False)), made(mine["lang"], mine["conf"])),
        (l1 == "eu", first),
        (pair("es", "eu") & near, second),
        (l1 == "gl", first),
        (pair("pt", "gl") & near, second),
        (is_primary("gl") & pair("pt", "gl") & (c2 >= least), second),
        (pair("es", "gl") & near, second),
        (is_primary("gl") & pair("es", "gl") & (c1 < low), second),
        (l1 == "ca", first),
        (pair("es", "ca") & near, second),
    ]
    out = first
    for test, value in reversed(rules):
        out = F.when(F.coalesce(test, F.lit(False)), value).otherwise(out)
    return out


def looks_catalan(text: Column) -> Column:
    low = F.lower(text)
    out = F.lit(False)
    for mark in CATALAN:
        out = out | low.contains(mark)
    return out


def choose_for_text(text: Column, predictions: Column, primary: Column | None = None, compat: bool = False) -> Column:
    """choose, but text with Catalan marks is ca with its predicted confidence.

    compat looks for that confidence from the second prediction on, so that ca on top gets 0.01.
    """
    where = F.slice(predictions, 2, 1000) if compat else predictions
    conf = F.coalesce(F.get(F.filter(where, lambda p: p["lang"] == "ca"), F.lit(0))["conf"], F.lit(0.01))
    return F.when(looks_catalan(text), F.struct(F.lit("ca").alias("lang"), conf.alias("conf"))).otherwise(choose(predictions, primary))


def printed(predictions: Column) -> Column:
    return F.array_join(F.transform(predictions, lambda p: F.format_string("%s=%.2f", p["lang"], p["conf"])), ", ")
