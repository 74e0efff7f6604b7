"""Column coders: table columns as fixed-width digit tokens, and character parsers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def int_digits(value: Column, low: int, base: int, length: int) -> Column:
    """Digits, highest first, of value - low; null becomes an array of -1."""
    digits = F.array(*[F.floor((value - low) / base**k) % base for k in reversed(range(length))])
    return F.when(value.isNull(), F.array_repeat(F.lit(-1).cast("long"), length)).otherwise(digits.cast("array<long>"))


def int_from_digits(digits: Column, low: int, base: int) -> Column:
    return F.when(F.get(digits, F.lit(0)) < 0, F.lit(None)).otherwise(F.aggregate(digits, F.lit(0).cast("long"), lambda a, d: a * base + d) + low)


def float_digits(value: Column, low: float, step: float, base: int, length: int) -> Column:
    """Digits of the nearest step above low."""
    return int_digits(F.round((value - low) / step).cast("long"), 0, base, length)


def category_codes(df: DataFrame, column: str) -> DataFrame:
    """(value, code): distinct values in string order, dense from 0."""
    return df.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("value")).distinct().withColumn("code", F.row_number().over(Window.orderBy("value")) - 1)


def encode_rows(df: DataFrame, coders: dict[str, Column], delimiter: str = ",") -> Column:
    """A row as text: each column's digits by blanks, columns by a delimiter."""
    return F.array_join(F.array(*[F.array_join(c.cast("array<string>"), " ") for c in coders.values()]), delimiter)


def char_ids(text: Column, alphabet: str, unknown: int | None = None, lower: bool = True) -> Column:
    """Ids of characters by their place in an alphabet; others become unknown or are dropped."""
    t = F.trim(F.lower(text) if lower else text)
    ids = F.transform(F.filter(F.split(t, ""), lambda c: c != ""), lambda c: F.position(c, F.lit(alphabet)) - 1)
    return F.filter(ids, lambda i: i >= 0) if unknown is None else F.transform(ids, lambda i: F.when(i < 0, F.lit(unknown)).otherwise(i))


def from_char_ids(ids: Column, alphabet: str) -> Column:
    return F.array_join(F.transform(ids, lambda i: F.substring(F.lit(alphabet), i + 1, F.lit(1))), "")
