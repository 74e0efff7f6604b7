"""Text normalisation as columns; a UDF only where token expansion needs state."""

from __future__ import annotations

import ast
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loquarium.functions import words


def squeeze(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))


def normalise(x: Column) -> Column:
    """Lower case, no punctuation (Unicode), single blanks."""
    return squeeze(F.regexp_replace(F.lower(x), r"(?U)[^\w\s]", ""))


def basic_normalize(x: Column) -> Column:
    """The fallback for languages without an expander: marks become blanks, lower case, single blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(x), r"[,;:?¿«»\-¡!@*{}\[\]=/\\&#…\.]", " "), r"\s+", " "))


def clean_apostrophes(x: Column) -> Column:
    """Typographic apostrophes inside words become plain; plain ones at a word's edge become quotes."""
    x = F.regexp_replace(x, r"(?U)(?<=\w)’(?=\w)", "'")
    x = F.regexp_replace(x, r"(?U)(?<!\w)'(?=\w)", "‘")
    return F.regexp_replace(x, r"(?U)(?<=\w)'(?!\w)", "’")


def clean_numbers(x: Column, point: str = "punto", comma: str = "coma") -> Column:
    """Thousands dots go; a dot before a word character or a comma between digits is spelled out."""
    x = F.regexp_replace(x, r"(?<=\d)\.(?=\d{3})", "")
    x = F.regexp_replace(x, r"(?U)(?<=\d)\.(?=\w)", f" {point} ")
    return F.regexp_replace(x, r"(?<=\d),(?=\d)", f" {comma} ")


def replace_chars(x: Column, names: dict[str, str]) -> Column:
    """Every listed character becomes its name between blanks; the text is cut at these in one pass."""
    signs = f"[{_class(''.join(names))}]"
    named = F.create_map(*[F.lit(y) for char, name in names.items() for y in (char, f" {name} ")])
    return F.array_join(F.transform(F.split(x, f"(?<={signs})|(?={signs})"), lambda p: F.coalesce(F.try_element_at(named, p), p)), "")


#: Abbreviations that lose their dot before splitting, the letters of the normaliser, and other characters that it keeps.
ABBREVIATIONS = ["sr.", "sra.", "srs.", "dr.", "dra.", "srta.", "mss.", "ms.", "mr.", "st.", "sta.", "km.", "m.", "s.", "kg.", "vs.", "num.", "núm."]
LETTERS = "abcdefghijklmnopqrstuvwxyzàèìòùáéíóúäëïöüñçâêîôû"
WORD_MARKS, NUMERIC, SENTENCE_ENDS, PUNCTUATION = "'’· -@", "0123456789%+-º", ".?!:…", ",()¡¿\"«»'’;"
ACCEPTED, ACCEPTED_MARKS = "abcdefghijklmnopqrstuvwxyzàèìòùáéíóúäëïöüñçâêîôûæãẽĩõũ'· -", ",()¡¿\"«»';.?!:…"


def _class(chars: str) -> str:
    """The inside of a character class."""
    return re.sub(r"([\\\]\[^&-])", r"\\\1", "".join(dict.fromkeys(chars)))


def remove_abbreviation_dots(x: Column) -> Column:
    """Words, between blanks, that are exactly a listed abbreviation lose their dot."""
    return F.array_join(F.transform(F.split(x, " "), lambda t: F.when(t.isin(ABBREVIATIONS), F.substring(t, F.lit(1), F.length(t) - 1)).otherwise(t)), " ")


def remove_bad_cases(x: Column, punctuation: bool = False) -> Column:
    """Marks where they don't belong.

    Dots before whole groups of three digits go.  Hyphens and middle dots stay between letters, else
    are blanks; so do apostrophes, which with punctuation stay next to one letter too; a typographic
    apostrophe beside no letter is a blank without punctuation.  Commas stay between digits, else go,
    but for punctuation.  # goes; apostrophes, hyphens and middle dots at the ends are cut, in this order.
    """
    a = f"[{_class(LETTERS)}]"
    x = F.regexp_replace(x, r"(?<=\d)\.(?=\d{3}($|\.))", "")
    x = F.regexp_replace(x, rf"(?iu)(?<!{a})[-·]|[-·](?!{a})", " ")
    x = F.regexp_replace(x, rf"(?iu)(?<!{a})'(?!{a})" if punctuation else rf"(?iu)(?<!{a})'|'(?!{a})", " ")
    if not punctuation:
        x = F.regexp_replace(x, rf"(?iu)(?<!{a})’|’(?!{a})", " ")
        x = F.regexp_replace(x, r"(?U)(?<!\p{N}),|,(?!\p{N})", "")
    x = F.replace(x, F.lit("#"), F.lit(""))
    for mark in "'-·":
        x = F.regexp_replace(x, rf"^[{_class(mark)}]+|[{_class(mark)}]+$", "")
    return x


def valid_chars(lang: str) -> str:
    """All characters that remove_chars keeps (letters in small only); languages but Catalan have the Spanish signs."""
    signs = "ca" if lang == "ca" else "es"
    return LETTERS + WORD_MARKS + NUMERIC + SENTENCE_ENDS + "".join(words.symbols(signs))


def remove_chars(x: Column, punctuation: bool = False, lang: str = "ca") -> Column:
    """What separates lines or parts becomes a dot; marks where they don't belong and characters that are not valid go; abbreviations lose their dot."""
    x = F.replace(x, F.lit("\n"), F.lit("."))
    for sep in (" - ", " · ", "|"):
        x = F.replace(x, F.lit(sep), F.lit("."))
    keep = valid_chars(lang) + (PUNCTUATION if punctuation else "")
    return remove_abbreviation_dots(F.regexp_replace(remove_bad_cases(x, punctuation), rf"(?iu)[^{_class(keep)}]", " "))


def normalise_row(x: Column, lang: str, mark: str = "|") -> Column:
    """A transcript row: cleaned, split into sentences, each sentence normalised in full, joined by mark; blank sentences are empty."""
    parts = F.split(split_sentences(remove_chars(x, False, lang), "\u0001"), "\u0001")
    n = F.regexp_replace(clean_text(F.array_join(parts, "\ue000"), lang, parts="\ue000"), r"\s*\ue000\s*", mark)
    return n


def split_sentences(x: Column, mark: str = "|") -> Column:
    """Sentences joined by mark: cut at . ? ! : … and line ends, not at a dot between digit and word character."""
    x = F.regexp_replace(x, r"(?<=\d)\.(?=\w)", "\u0001")
    parts = F.transform(F.split(x, r"[.?!:…\n]"), lambda t: F.trim(F.replace(t, F.lit("\u0001"), F.lit("."))))
    return F.array_join(F.filter(parts, lambda t: t != ""), mark)


def normalise_answer(x: Column) -> Column:
    """Question-answering form: lower case, no ASCII punctuation, no English articles, single blanks."""
    x = F.regexp_replace(F.lower(x), r"[!\"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~]", "")
    return F.trim(F.regexp_replace(F.regexp_replace(x, r"\b(a|an|the)\b", " "), r"\s+", " "))


def punctuation(x: Column, separate: bool = True, remove: bool = False, marks: str = r".,?!") -> Column:
    """Sets marks apart from words, or removes them; lower case and single blanks."""
    chars = "[" + re.escape(marks) + "]"
    x = F.regexp_replace(x, chars, "" if remove else " $0 ") if separate or remove else x
    return F.trim(F.regexp_replace(F.lower(x), r"\s{2,}", " "))


def hms_seconds(x: Column) -> Column:
    """Seconds of H:M:S, or of a plain number."""
    p = F.split(x, ":")
    return F.when(F.size(p) == 3, F.get(p, F.lit(0)).cast("double") * 3600 + F.get(p, F.lit(1)).cast("double") * 60 + F.get(p, F.lit(2)).cast("double")).otherwise(x.try_cast("double"))


def seconds_hms(x: Column) -> Column:
    """HH:MM:SS of whole seconds (cut, not rounded)."""
    s = F.floor(x)
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)


def seconds_ass(x: Column) -> Column:
    """Subtitle time H:MM:SS.cc."""
    c = F.round(x * 100).cast("long")
    return F.format_string("%d:%02d:%02d.%02d", F.floor(c / 360000), F.floor(c / 6000) % 60, F.floor(c / 100) % 60, c % 100)


def file_label(x: Column) -> Column:
    """A name safe for files: other runs of characters become one hyphen."""
    return F.regexp_replace(x, r"[^A-Za-z0-9_.-]+", "-")


def singleton_array_text(x: Column) -> Column:
    """The text in a one-element JSON array; else the text without two characters at each end; other texts unchanged."""
    inner = F.get(F.from_json(x, "array<string>"), F.lit(0))
    looks = F.startswith(F.trim(x), F.lit("[")) & F.endswith(F.trim(x), F.lit("]"))
    return F.when(looks, F.coalesce(inner, F.substring(F.trim(x), F.lit(3), F.greatest(F.length(F.trim(x)) - 4, F.lit(0))))).otherwise(x)


@F.pandas_udf(T.StringType())
def clean_prediction(texts: pd.Series) -> pd.Series:
    """A printed Python list of strings becomes its items joined by blanks; anything else is trimmed."""

    def one(x):
        if x is None:
            return None
        s = x.strip()
        if s.startswith("["):
            try:
                items = ast.literal_eval(s)
                if isinstance(items, list) and all(isinstance(i, str) for i in items):
                    return " ".join(items).strip()
            except (ValueError, SyntaxError):
                pass
        return s

    return texts.map(one)


def number_words(lang: str):
    """UDF: whole numbers in digits become words, left to right by token (never inside another number)."""

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else re.sub(r"\d+", lambda m: words.cardinal(int(m[0]), lang), t))

    return F.pandas_udf(run, T.StringType())


def expand_tokens(lang: str):
    """UDF: ordinals, roman numerals, abbreviations and initialisms are spelled out, token by token."""

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else words.expand(t, lang))

    return F.pandas_udf(run, T.StringType())


def clean_text(x: Column, lang: str, keep_punctuation: bool = False, keep_case: bool = False, parts: str = "") -> Column:
    """Full normaliser: symbols, apostrophes, expansion, numbers, accepted characters, single blanks.

    ca and es have an expander; eu and gl use basic_normalize by ``|`` parts; other languages raise.
    parts: a character that is kept, as it separates texts that are normalised together.
    """
    if lang in ("eu", "gl"):
        x = F.array_join(F.transform(F.split(x, r"\|"), basic_normalize), "|")
        parts += "|"
    elif lang in ("ca", "es"):
        if parts:
            x = F.replace(x, F.lit(parts), F.lit(f" {parts} "))
        x = replace_chars(x, words.symbols(lang))
        x = clean_apostrophes(x)
        x = expand_tokens(lang)(x)
        x = clean_numbers(x, *words.POINT_COMMA[lang])
        x = number_words(lang)(x)
    else:
        raise ValueError(f"no normaliser for {lang}")
    x = x if keep_case else F.lower(x)
    return squeeze(F.regexp_replace(x, rf"(?iu)[^{_class(ACCEPTED + parts + (ACCEPTED_MARKS if keep_punctuation else ''))}]", " "))


def enrichment_text(x: Column, lang: str) -> Column:
    """clean_text where a language has it, else basic_normalize."""
    return clean_text(x, lang) if lang in ("ca", "es", "eu", "gl") else basic_normalize(x)


def clean_alignment_text(df: DataFrame, text: str, out: str, lang: str, key: str) -> DataFrame:
    """Adds out: clean_text by ``|`` parts of a text column, empty parts dropped; key names the row."""
    parts = df.select(F.col(key).alias("_key"), F.posexplode(F.split(F.col(text), r"\|")).alias("_at", "_part")).withColumn("_part", clean_text(F.col("_part"), lang)).where(F.col("_part") != "")
    joined = parts.groupBy("_key").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_at", "_part"))), lambda p: p["_part"]), "|").alias(out))
    return df.join(joined, F.col(key) == F.col("_key"), "left").drop("_key").withColumn(out, F.coalesce(out, F.lit("")))
