"""Row filters that keep every rejected row with its reason: kept + rejects = input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def within(value: Column, low: float | None, high: float | None, bounds: str) -> Column:
    """bounds: ``(]``, ``[]``, ``[)`` or ``()``; a missing end is open."""
    lower = F.lit(True) if low is None else value >= low if bounds[0] == "[" else value > low
    upper = F.lit(True) if high is None else value <= high if bounds[1] == "]" else value < high
    return lower & upper


def duration_reason(start: Column, end: Column, low: float, high: float, bounds: str = "(]") -> Column:
    """Null where a segment stays: times are missing or its duration is within bounds."""
    d = end - start
    return F.when(start.isNull() | end.isNull() | within(d, low, high, bounds), F.lit(None)).when(~within(d, low, None, bounds), F.lit("duration_below_minimum")).otherwise(F.lit("duration_above_maximum"))


def with_reason(df: DataFrame, *tests: tuple[str, Column]) -> DataFrame:
    """Adds reason: that of the first test that holds, null where none does."""
    reason = F.lit(None).cast("string")
    for name, test in reversed(tests):
        reason = F.when(F.coalesce(test, F.lit(False)), F.lit(name)).otherwise(reason)
    return df.withColumn("reason", reason)


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, rejects) by the reason column."""
    return df.where(F.col("reason").isNull()).drop("reason"), df.where(F.col("reason").isNotNull())


def language_gate(df: DataFrame, predicted: str, confidence: str, expected: str, supported: list[str], least: float = 0.30) -> DataFrame:
    """reason by three tests in order: unsupported, mismatch, low confidence."""
    return with_reason(
        df,
        ("unsupported_language", ~F.col(predicted).isin(supported)),
        ("language_mismatch", F.col(predicted) != F.col(expected)),
        ("language_confidence_below_threshold", F.col(confidence) < least),
    )


def quality_gate(cer: Column, wer: Column, length_gap: Column, edge: Column, duration: Column, max_cer=30.0, max_wer=75.0, max_gap=0.3, max_edge=60.0, low=1.0, high=-1.0) -> Column:
    keep = (cer <= max_cer) & (wer <= max_wer) & (length_gap <= max_gap) & (edge <= max_edge) & (duration > low)
    return keep if high == -1 else keep & (duration < high)


def length_ratio(a: Column, b: Column, least: int = 1, most: int = 512, ratio: float = 1.3) -> Column:
    """Whether two token counts are each within bounds and not too unequal."""
    return a.between(least, most) & b.between(least, most) & (a <= b * ratio) & (b <= a * ratio)


def parse_filter(text: str) -> Column:
    """The explorer's mini-language: terms joined by `` && ``, operators >= <= < > != = contains."""
    out = F.lit(True)
    for term in text.split(" && "):
        name, op, value = next(((a, o, b) for o in (">=", "<=", "<", ">", "!=", "=", "contains") if o in term for a, _, b in [term.partition(o)]), (None, None, None))
        if op is None:
            raise ValueError(f"no operator in {term!r}")
        name, value = name.strip().strip("{}"), value.strip()
        quoted = len(value) > 1 and value[0] == value[-1] and value[0] in "\"'"
        if op == "contains":
            out &= F.col(name).cast("string").contains(value[1:-1] if quoted else value)
            continue
        v = F.lit(value[1:-1]) if quoted else F.lit(float(value))
        c = F.col(name)
        out &= {">=": c >= v, "<=": c <= v, "<": c < v, ">": c > v, "!=": c != v, "=": c == v}[op]
    return out


def page(df: DataFrame, where: str | None, by: str, ascending: bool = True, number: int = 0, size: int = 10) -> DataFrame:
    """One page of a filtered, sorted table."""
    df = df.where(parse_filter(where)) if where else df
    return df.orderBy(F.col(by).asc() if ascending else F.col(by).desc()).offset(number * size).limit(size)
