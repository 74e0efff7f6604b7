"""Resolving, joining and checking manifests, shards and model registries; cutting clips out of audio."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loquarium.sources.readers import stem


def preferred_transcript(ids: DataFrame, marked: DataFrame, plain: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((input_id, path), rejects): the marked transcript of each input, else the plain one; inputs with neither are rejects."""
    found = ids.select("input_id").join(marked.select("input_id", F.col("path").alias("_marked")), "input_id", "left").join(plain.select("input_id", F.col("path").alias("_plain")), "input_id", "left")
    found = found.select("input_id", F.coalesce("_marked", "_plain").alias("path"))
    return found.where("path is not null"), found.where("path is null").select("input_id", F.lit("missing_transcript").alias("reason"))


def resolve_paths(df: DataFrame, path: str, folders: list[Column], listing: DataFrame, out: str = "resolved", checked: bool = True) -> DataFrame:
    """Adds out: an absolute path as it is; a relative one where the listing (column path) has it, by itself or under the first of the folders.

    What no folder has stays as it is, or with checked false is taken to lie under the last folder.
    """
    known = listing.select(F.col("path").alias("_known")).distinct()
    p, found = F.col(path), df
    tries = [p, *[F.concat_ws("/", f, p) for f in folders]]
    for k, full in enumerate(tries):
        found = found.withColumn(f"_try{k}", full).join(known.withColumnRenamed("_known", f"_hit{k}"), F.col(f"_try{k}") == F.col(f"_hit{k}"), "left")
    last = p if checked else F.col(f"_try{len(tries) - 1}")
    value = F.when(p.startswith("/"), p).otherwise(F.coalesce(*[F.col(f"_hit{k}") for k in range(len(tries))], last))
    return found.withColumn(out, value).drop(*[f"_{x}{k}" for k in range(len(tries)) for x in ("try", "hit")])


def select_models(registry: list[dict], langs: Iterable[str], names: list[str] | None = None) -> list[dict]:
    """Models (dicts with lang, name, enabled) of some languages, once a name (the last one counts): those enabled, or those named, in the order named."""
    by_name = {m["name"]: m for lang in langs for m in registry if m["lang"] == lang}
    if names is None:
        return [m for m in by_name.values() if m.get("enabled", True)]
    if unknown := [n for n in names if n not in by_name]:
        raise ValueError(f"unknown models: {', '.join(unknown)}")
    return [by_name[n] for n in names]


def require_language(lang: Column, supported: list[str]) -> Column:
    """The language; a missing or unsupported one stops the job."""
    return F.when(lang.isin(supported), lang).otherwise(F.raise_error(F.concat(F.lit("language is missing or not supported: "), F.coalesce(lang, F.lit("none")))).cast("string"))


def lines_with_key(raw: DataFrame, key: str, line: str = "raw") -> DataFrame:
    """(any_line, all_lines): whether a key stands in any, and in all, of the JSON lines."""
    there = F.array_contains(F.json_object_keys(line), key)
    return raw.agg(F.coalesce(F.bool_or(there), F.lit(False)).alias("any_line"), F.coalesce(F.bool_and(there), F.lit(True)).alias("all_lines"))


def lines_between(lines: DataFrame, first: int, last: int, line: str = "line", text: str = "text") -> DataFrame:
    """Numbered lines of an inclusive range; byte order mark gone, blanks squeezed, ellipsis as three dots."""
    clean = F.regexp_replace(F.replace(F.replace(text, F.lit("﻿"), F.lit("")), F.lit("…"), F.lit("...")), r"\s+", " ")
    return lines.where(F.col(line).between(first, last)).withColumn(text, F.trim(clean))


def matched(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join of two lists that must have the same keys; an unmatched key is an error."""
    one = left.select(key).join(right.select(key), key, "left_anti").unionByName(right.select(key).join(left.select(key), key, "left_anti"))
    if bad := one.limit(5).collect():
        raise ValueError(f"keys on one side only: {[r[0] for r in bad]}")
    return left.join(right, key)


def by_stem(paths: DataFrame, path: str = "path") -> DataFrame:
    """(uniq_id, path): paths by file name without ending; a name that occurs twice is an error."""
    found = paths.select(stem(F.col(path)).alias("uniq_id"), F.col(path).alias("path"))
    if bad := found.groupBy("uniq_id").count().where("count > 1").limit(5).collect():
        raise ValueError(f"file names that are not unique: {[r[0] for r in bad]}")
    return found


def create_manifest(audio: DataFrame, texts: DataFrame, rttm: DataFrame, ctm: DataFrame) -> DataFrame:
    """(uniq_id, audio_filepath, text, num_speakers, rttm_filepath, ctm_filepath) of audio files (uniq_id, path).

    texts has (uniq_id, line, text), of which the first line counts and "-" stands for none; rttm has
    (uniq_id, path, label) with labels "start end speaker", whose distinct speakers are counted; ctm has
    (uniq_id, path).
    """
    first = texts.groupBy("uniq_id").agg(F.min_by("text", "line").alias("_text"))
    spoken = rttm.groupBy("uniq_id").agg(F.min("path").alias("rttm_filepath"), F.countDistinct(F.element_at(F.split("label", " "), -1)).alias("num_speakers"))
    out = audio.select("uniq_id", F.col("path").alias("audio_filepath")).join(first, "uniq_id", "left").join(spoken, "uniq_id", "left").join(ctm.select("uniq_id", F.col("path").alias("ctm_filepath")), "uniq_id", "left")
    return out.select("uniq_id", "audio_filepath", F.coalesce("_text", F.lit("-")).alias("text"), "num_speakers", "rttm_filepath", "ctm_filepath")


def path_labels(paths: DataFrame, level: int, path: str = "path") -> DataFrame:
    """Adds label: one component of a path, counted from 0, or from the end below 0."""
    return paths.withColumn("label", F.element_at(F.split(path, "/"), level if level < 0 else level + 1))


def rttm_label(start: Column, duration: Column, speaker: Column) -> Column:
    """"start end speaker", rounded to milliseconds."""
    return F.concat_ws(" ", F.round(start, 3).cast("string"), F.round(start + duration, 3).cast("string"), speaker)


def label_rttm(label: Column, uniq_id: Column) -> Column:
    """The RTTM line of a label."""
    p = F.split(label, " ")
    start, end = F.get(p, F.lit(0)).cast("double"), F.get(p, F.lit(1)).cast("double")
    return F.format_string("SPEAKER %s 1   %.3f   %.3f <NA> <NA> %s <NA> <NA>", uniq_id, start, end - start, F.get(p, F.lit(2)))


def delimited(lines: DataFrame, columns: dict[str, int], sep: str = ",", text: str = "value") -> DataFrame:
    """Columns by place of lines split at every separator; quotes mean nothing."""
    return lines.select("*", *[F.get(F.split(text, re.escape(sep), -1), F.lit(i)).alias(name) for name, i in columns.items()])


def expand_braces(pattern: str) -> Iterator[str]:
    """Paths of a pattern with {a,b} or {1..10} (also in other brackets, or between _OP_ and _CL_); zeros in front are kept."""
    for mark, brace in {"(": "{", "[": "{", "<": "{", "_OP_": "{", ")": "}", "]": "}", ">": "}", "_CL_": "}"}.items():
        pattern = pattern.replace(mark, brace)
    parts = []
    for k, piece in enumerate(re.split(r"\{([^{}]*)\}", pattern)):
        ends = piece.split("..") if k % 2 else []
        if len(ends) == 2 and all(re.fullmatch(r"-?\d+", x) for x in ends):
            a, b = map(int, ends)
            width = max(map(len, ends)) if any(x.lstrip("-").startswith("0") and len(x) > 1 for x in ends) else 0
            parts.append([str(i).zfill(width) for i in range(a, b + (1 if b >= a else -1), 1 if b >= a else -1)])
        else:
            parts.append(piece.split(",") if k % 2 and "," in piece else ["{" + piece + "}"] if k % 2 else [piece])
    yield from map("".join, product(*parts))


def scatter(paths: list[str], world: int, rank: int, replicate: bool = False) -> list[str]:
    """One worker's shards: a block of equal size each (what is left over goes to nobody), or all of them."""
    each = len(paths) // world
    return list(paths) if replicate or world <= 1 else paths[each * rank : each * (rank + 1)]


def members_in(members: DataFrame, manifest: DataFrame, key: str = "file_id") -> DataFrame:
    """Members of shards that the manifest lists."""
    return members.join(manifest.select(key).distinct(), key, "left_semi")


def member_segments(members: DataFrame, manifest: DataFrame, key: str = "file_id") -> DataFrame:
    """Each member once for each of its segments in the manifest."""
    return members.join(manifest, key)


def batches(df: DataFrame, keys: list[str], order: list[str], size: int) -> DataFrame:
    """Adds batch: the number of a row's batch of so many rows within its bucket."""
    return df.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1) / size))


def chained(df: DataFrame, source: str, seed: int) -> DataFrame:
    """Adds turn: the place of a row's source in a permutation of the sources that the seed chooses."""
    order = df.select(source).distinct().withColumn("_h", F.xxhash64(F.lit(seed), source))  # a row a source
    return df.join(order.select(source, F.row_number().over(Window.orderBy("_h", source)).alias("turn")), source)


def first_segments(df: DataFrame, keys: list[str], order: list[str], most: int | None) -> DataFrame:
    """The first segments of each document; all where no number is given."""
    if most is None:
        return df
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= most).drop("_n")


def with_extra_model(rows: DataFrame, lang: str, model: str) -> DataFrame:
    """Rows (segment, lang, model) with one more model for segments of one language, which replaces rows it has already."""
    extra = rows.where(F.col("lang") == lang).drop("model").distinct().withColumn("model", F.lit(model))
    return rows.where((F.col("lang") != lang) | (F.col("model") != model)).unionByName(extra)


def sources_of(segments: DataFrame, source: str = "source") -> DataFrame:
    """(source, n, start, end) of the segments cut out of each source."""
    return segments.groupBy(source).agg(F.count("*").alias("n"), F.min("start").alias("start"), F.max("end").alias("end"))


def _little(n: Column, size: int) -> Column:
    h = F.lpad(F.hex(n.cast("long")), size * 2, "0")
    return F.unhex(F.concat(*[F.substring(h, 2 * (size - k) - 1, 2) for k in range(size)]))


def wav_header(n_bytes: Column, rate: Column, channels: Column) -> Column:
    """The 44 bytes before 16-bit samples."""
    text = lambda x: F.lit(x.encode())
    one = F.lit(1)
    return F.concat(text("RIFF"), _little(n_bytes + 36, 4), text("WAVEfmt "), _little(F.lit(16), 4), _little(one, 2), _little(channels, 2), _little(rate, 4), _little(rate * channels * 2, 4), _little(channels * 2, 2), _little(F.lit(16), 2), text("data"), _little(n_bytes, 4))


def cut_clips(segments: DataFrame, sources: DataFrame, existing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((segment_path, wav), rejects) of segments (source, start, end, segment_path) of 16-bit audio (source, rate, channels, samples).

    Frames from round(start x rate) to round(end x rate); clips whose path exists already (column
    segment_path) are left out; empty ones, and those of a missing source, are rejects.
    """
    todo = segments.join(existing.select("segment_path"), "segment_path", "left_anti").join(sources, "source", "left")
    frame = lambda t: F.round(F.col(t) * F.col("rate")).cast("long")
    width = F.col("channels") * 2
    cut = todo.withColumn("_clip", F.substring("samples", (frame("start") * width + 1).cast("int"), ((frame("end") - frame("start")) * width).cast("int")))
    reason = F.when(F.col("samples").isNull(), "missing_source_audio").when(F.octet_length("_clip") == 0, "empty_clip")
    cut = cut.withColumn("reason", reason)
    wav = F.concat(wav_header(F.octet_length("_clip"), F.col("rate"), F.col("channels")), F.col("_clip"))
    return cut.where("reason is null").select("segment_path", wav.alias("wav")), cut.where("reason is not null").select("segment_path", "reason")


def cleaned_name(path: Column) -> Column:
    """Where the cleaned form of a file goes: its name with _splitted_and_clean before the ending."""
    return F.regexp_replace(path, r"^(.*?)(\.[^./]*)?$", "$1_splitted_and_clean$2")
