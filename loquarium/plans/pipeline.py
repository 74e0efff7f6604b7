"""From aligned words to merged, scored, punctuated segments: one plan, rejects kept with their reason.

Stages: blocks -> segments (least duration) -> language gate -> duration range -> hypotheses -> merge
-> scores -> punctuation.  Every stage is a column or aggregate; models sit behind ``backends``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loquarium.functions import text as T
from loquarium.operators import filters, lid, rover
from loquarium.plans import backends

KEYS = ["input_id", "block_id", "seg_idx"]


@dataclass
class Settings:
    lang: str = "ca"
    languages: list[str] = field(default_factory=lambda: list(lid.SUPPORTED))
    least_segment: float = 0.25
    least_confidence: float = 0.30
    min_duration: float = 2.0
    max_duration: float = 30.0
    strategy: str = "centroid"
    normalise: bool = True

    def __post_init__(self):
        if self.min_duration < 0 or self.max_duration <= self.min_duration:
            raise ValueError("durations must satisfy 0 <= min < max")
        if self.strategy not in ("centroid", "vote"):
            raise ValueError(f"no strategy {self.strategy}")


@dataclass
class Result:
    segments: DataFrame
    hypotheses: DataFrame
    merged: DataFrame
    scores: DataFrame
    rejects: DataFrame


def _rejected(df: DataFrame, stage: str) -> DataFrame:
    return df.select("input_id", "block_id", F.lit(stage).alias("stage"), "reason", "start", "end", F.col("normalized_text").alias("text"))


def block_reasons(blocks: DataFrame, audio: DataFrame) -> DataFrame:
    """Adds reason to metadata blocks: audio missing, times not ascending, or a blank text."""
    known = audio.select("audio_filepath").distinct().withColumn("_known", F.lit(True))
    d = blocks.join(known, "audio_filepath", "left")
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    return filters.with_reason(
        d,
        ("missing_source_audio", F.col("_known").isNull()),
        ("invalid_times", T.hms_seconds(F.col("start")) >= T.hms_seconds(F.col("end"))),
        ("blank_normalized_text", blank("normalized_text")),
        ("blank_original_text", blank("original_text")),
    ).drop("_known")


def kept_blocks(blocks: DataFrame, audio: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(blocks, rejects) by block_reasons; an input that keeps none of its blocks is an error."""
    kept, rejects = filters.split(block_reasons(blocks, audio))
    if bad := blocks.select("input_id").distinct().join(kept.select("input_id"), "input_id", "left_anti").limit(5).collect():
        raise ValueError(f"no valid block is left of {[r[0] for r in bad]}")
    return kept, rejects


def segments_from_units(units: DataFrame, least: float) -> DataFrame:
    """(keys, start, end, normalized_text, reason) of aligned units (input_id, block_id, start, end, text)."""
    from pyspark.sql import Window

    d = units.select("input_id", "block_id", "start", "end", F.col("text").alias("normalized_text")).withColumn("seg_idx", F.row_number().over(Window.partitionBy("input_id", "block_id").orderBy("start", "end")) - 1)
    return filters.with_reason(d, ("duration_below_minimum", F.col("end") - F.col("start") < least))


def gate(segments: DataFrame, settings: Settings, identifier) -> DataFrame:
    """Adds language, language_confidence and reason."""
    d = backends.identify(segments, identifier, "normalized_text")
    d = d.withColumn("_c", lid.choose(F.col("predictions"), F.lit(settings.lang))).withColumns({"language": F.col("_c.lang"), "language_confidence": F.col("_c.conf"), "_expected": F.lit(settings.lang)})
    return filters.language_gate(d, "language", "language_confidence", "_expected", settings.languages, settings.least_confidence).drop("_c", "_expected", "predictions")


def clip_path(base):
    """Name of a segment's clip."""
    return F.concat(base, F.lit("_"), F.col("start").cast("string"), F.lit("_"), F.col("end").cast("string"), F.lit(".wav"))


def run(units: DataFrame, settings: Settings, registry: list[tuple[str, str, object]], identifier, punctuator) -> Result:
    """units: (input_id, block_id, start, end, text).  kept + rejects = units."""
    kept, r1 = filters.split(segments_from_units(units, settings.least_segment))
    kept, r2 = filters.split(gate(kept, settings, identifier))
    kept = kept.withColumn("reason", filters.duration_reason(F.col("start"), F.col("end"), settings.min_duration, settings.max_duration))
    kept, r3 = filters.split(kept)
    segments = kept.withColumn("segment_path", clip_path(F.col("block_id")))
    hyps = backends.sweep(segments, registry)
    norm = T.normalise(T.clean_prediction(F.col("pred_text"))) if settings.normalise else T.clean_prediction(F.col("pred_text"))
    hyps = hyps.withColumn("norm_text", norm)
    merged = segments.join(rover.merge(hyps, KEYS, "model", "norm_text", settings.strategy), KEYS, "left")
    merged = backends.punctuate(backends.input_text(merged, hyps, KEYS), punctuator, "text_normalized")
    ref = T.normalise(F.col("normalized_text")) if settings.normalise else F.col("normalized_text")
    refs = segments.select(*KEYS, ref.alias("ref"))
    each = hyps.join(refs, KEYS).select(F.col("model").alias("system"), "ref", F.col("norm_text").alias("hyp"))
    both = each.unionByName(merged.join(refs, KEYS).where("rover_text is not null").select(F.lit("rover").alias("system"), "ref", F.col("rover_text").alias("hyp")))
    scores = rover.corpus_scores(rover.segment_scores(both, "ref", "hyp"), ["system"])
    rejects = _rejected(r1, "segmentation").unionByName(_rejected(r2, "language")).unionByName(_rejected(r3, "duration"))
    return Result(segments, hyps, merged, scores, rejects)
