"""English text for speech: numbers, times, money, ordinals and abbreviations in words, ASCII, lower case."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed values.
ONES = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
SCALES = ["", "thousand", "million", "billion", "trillion"]
IRREGULAR = {"one": "first", "two": "second", "three": "third", "five": "fifth", "eight": "eighth", "nine": "ninth", "twelve": "twelfth"}
ABBREVIATIONS = {"mr": "mister", "mrs": "misess", "dr": "doctor", "st": "saint", "jr": "junior", "gen": "general", "capt": "captain", "rev": "reverend", "sgt": "sergeant", "col": "colonel", "ltd": "limited", "co": "company"}
MONEY = {"$": ("dollar", "cent"), "€": ("euro", "cent"), "£": ("pound", "penny")}
_SHORT = re.compile(r"\b(" + "|".join(ABBREVIATIONS) + r")\.", re.I)


def cardinal(n: int) -> str:
    if n < 20:
        return ONES[n]
    if n < 100:
        return TENS[n // 10 - 2] + (f"-{ONES[n % 10]}" if n % 10 else "")
    if n < 1000:
        return f"{ONES[n // 100]} hundred" + (f" {cardinal(n % 100)}" if n % 100 else "")
    if n >= 10**15:
        return " ".join(ONES[int(d)] for d in str(n))
    parts, scale = [], 0
    while n:
        n, low = divmod(n, 1000)
        if low:
            parts.append(f"{cardinal(low)} {SCALES[scale]}".strip())
        scale += 1
    return " ".join(reversed(parts))


def ordinal(n: int) -> str:
    head, _, last = re.match(r"(.*?)([ -]?)([a-z]+)$", cardinal(n)).groups()
    sep = cardinal(n)[len(head) : len(cardinal(n)) - len(last)]
    word = IRREGULAR.get(last) or (last[:-1] + "ieth" if last.endswith("y") else last + "th")
    return head + sep + word


def _money(m: re.Match) -> str:
    whole, cents = int(m[2].replace(",", "")), int((m[3] or "0").ljust(2, "0")[:2])
    big, small = MONEY[m[1]]
    many = lambda n, w: f"{cardinal(n)} {w if n == 1 else 'pence' if w == 'penny' else w + 's'}"
    return " ".join([many(whole, big)] * (whole > 0 or not cents) + [many(cents, small)] * (cents > 0))


def _time(m: re.Match) -> str:
    hour, minute = int(m[1]), int(m[2])
    return f"{cardinal(hour)} " + ("o'clock" if minute == 0 else f"oh {cardinal(minute)}" if minute < 10 else cardinal(minute))


def clean(text: str) -> str:
    text = re.sub(r"([$€£])\s?(\d[\d,]*)(?:\.(\d{1,2}))?", _money, text)
    text = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode().lower()
    text = _SHORT.sub(lambda m: ABBREVIATIONS[m[1].lower()], text)
    text = re.sub(r"\b(\d{1,2}):(\d{2})\b", _time, text)
    text = re.sub(r"\b(\d+)(?:st|nd|rd|th)\b", lambda m: ordinal(int(m[1])), text)
    text = re.sub(r"(?<=\d),(?=\d{3})", "", text)
    text = re.sub(r"(\d+)\.(\d+)", lambda m: f"{cardinal(int(m[1]))} point " + " ".join(ONES[int(d)] for d in m[2]), text)
    text = re.sub(r"\d+", lambda m: cardinal(int(m[0])), text)
    text = re.sub(r"&", " and ", text)
    text = re.sub(r"[^a-z' -]", " ", text)
    return re.sub(r"\s+", " ", text).strip()


@F.pandas_udf(T.StringType())
def clean_english(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else clean(t))


def vocabulary_only(text: Column, alphabet: str) -> Column:
    """Characters outside an alphabet become blanks; single blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, f"[^{alphabet}]", " "), r"\s+", " "))
