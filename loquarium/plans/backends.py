"""The model boundary: what recognisers, language identifiers and punctuators must offer, and deterministic stand-ins."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loquarium.sources.manifests import first_segments


class Recogniser(Protocol):
    """Made once in each Python worker; transcribes a batch."""

    def transcribe(self, paths: list[str]) -> list[str]: ...


class Punctuator(Protocol):
    def punctuate(self, texts: list[str]) -> list[str]: ...


class LanguageIdentifier(Protocol):
    def predict(self, texts: list[str], k: int) -> list[list[tuple[str, float]]]: ...


class EchoRecogniser:
    """Returns the file's stem, for tests."""

    def transcribe(self, paths: list[str]) -> list[str]:
        return [p.rpartition("/")[2].rpartition(".")[0].replace("_", " ") for p in paths]


class CapitalPunctuator:
    """A capital first and a full stop last, for tests."""

    def punctuate(self, texts: list[str]) -> list[str]:
        return [t[:1].upper() + t[1:] + "." for t in texts]


class MarkerIdentifier:
    """Counts common function words, for tests."""

    WORDS = {"ca": {"el", "la", "i", "que", "amb", "això", "és"}, "es": {"el", "la", "y", "que", "con", "eso", "es"}, "eu": {"eta", "da", "du", "ez", "bat"}, "gl": {"o", "a", "e", "que", "con", "é", "non"}}

    def predict(self, texts: list[str], k: int) -> list[list[tuple[str, float]]]:
        out = []
        for t in texts:
            w = t.lower().split()
            hits = {lang: sum(x in known for x in w) + 1e-3 for lang, known in self.WORDS.items()}
            total = sum(hits.values())
            out.append(sorted(((lang, h / total) for lang, h in hits.items()), key=lambda p: (-p[1], p[0]))[:k])
        return out


def load(name: str):
    """A backend class named ``module:Class``."""
    from importlib import import_module

    module, _, attribute = name.partition(":")
    return getattr(import_module(module), attribute)


def prediction_text(out) -> str:
    """The text in whatever a recogniser returns: a string, a mapping, an object with text, a list of these, or nothing."""
    while isinstance(out, (list, tuple)):
        if not out:
            return ""
        out = out[0]
    text = out.get("text") if isinstance(out, dict) else out if isinstance(out, str) else getattr(out, "text", None)
    return "" if text is None else str(text).replace("’", "'")


def in_batches(make, call, size: int, empty):
    """An iterator function over series: a backend made once, batches of a size, and a failing batch retried item by item."""

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        backend = make()
        for part in parts:
            items, out = part.tolist(), []
            for at in range(0, len(items), size):
                some = items[at : at + size]
                try:
                    got = call(backend, some)
                    if len(got) != len(some):
                        raise ValueError("a backend returned another number of results")
                except Exception:
                    got = []
                    for x in some:
                        try:
                            got.append(call(backend, [x])[0])
                        except Exception:
                            got.append(empty)
                out += got
            yield pd.Series(out)

    return run


def transcribe(segments: DataFrame, model: str, make, path: str = "segment_path", batch: int = 16) -> DataFrame:
    """(keys, model, pred_text): null paths give empty texts; a failing item gives an empty text."""
    udf = F.pandas_udf(in_batches(make, lambda b, x: [prediction_text(t) if p is not None else "" for p, t in zip(x, b.transcribe([p or "" for p in x]))], batch, ""), "string")
    return segments.select("input_id", "block_id", "seg_idx", F.lit(model).alias("model"), udf(F.col(path)).alias("pred_text"))


def pending(segments: DataFrame, hyps: DataFrame | None, model: str, overwrite: bool = False) -> DataFrame:
    """Segments without a non-empty prediction of a model yet."""
    if hyps is None or overwrite:
        return segments
    done = hyps.where((F.col("model") == model) & (F.coalesce(F.trim("pred_text"), F.lit("")) != "")).select("input_id", "block_id", "seg_idx")
    return segments.join(done, ["input_id", "block_id", "seg_idx"], "left_anti")


def enrich(segments: DataFrame, hyps: DataFrame | None, registry: list[tuple[str, str, object]], limit: int | None = None, overwrite: bool = False) -> DataFrame:
    """Predictions of further models for the first segments of each document (all without a limit); what is there already is kept, unless overwritten."""
    return sweep(first_segments(segments, ["input_id"], ["block_id", "seg_idx"], limit), registry, hyps, overwrite)


def sweep(segments: DataFrame, registry: list[tuple[str, str, object]], hyps: DataFrame | None = None, overwrite: bool = False) -> DataFrame:
    """All models of each segment's language, one model after another; what is there already is kept."""
    out = hyps
    for lang, model, make in registry:
        new = transcribe(pending(segments.where(F.col("language") == lang), hyps, model, overwrite), model, make)
        if out is not None and overwrite:
            out = out.join(new.select("input_id", "block_id", "seg_idx", "model"), ["input_id", "block_id", "seg_idx", "model"], "left_anti")
        out = new if out is None else out.unionByName(new, allowMissingColumns=True)
    return out


def punctuate(merged: DataFrame, make, text: str = "rover_text", batch: int = 8) -> DataFrame:
    """Adds text_punctuated; blank texts stay blank."""
    udf = F.pandas_udf(in_batches(make, lambda b, x: [p if (t or "").strip() else "" for t, p in zip(x, b.punctuate([t or "" for t in x]))], batch, ""), "string")
    return merged.withColumn("text_punctuated", udf(F.col(text)))


def identify(df: DataFrame, make, text: str, k: int = 3) -> DataFrame:
    """Adds predictions: array<struct<lang, conf>>, best first."""
    udf = F.pandas_udf(in_batches(make, lambda b, x: b.predict([t or "" for t in x], k), 256, []), "array<struct<lang:string,conf:double>>")
    return df.withColumn("predictions", udf(F.col(text)))


def input_text(df: DataFrame, hyps: DataFrame, keys: list[str]) -> DataFrame:
    """Adds text_normalized: the merged text, else the first model's non-blank prediction."""
    first = hyps.where(F.trim("pred_text") != "").groupBy(*keys).agg(F.min_by("pred_text", "model").alias("_p"))
    return df.join(first, keys, "left").withColumn("text_normalized", F.coalesce(F.when(F.trim("rover_text") != "", F.trim("rover_text")), F.trim("_p"))).drop("_p")
