"""Sinks: every write makes a new version in a folder and leaves its input alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_transcripts(df: DataFrame, folder: str) -> None:
    """wav_path, text, normalized_text; tab, everything quoted, no header, a folder for each input."""
    df.select("input_id", "wav_path", "text", "normalized_text").write.partitionBy("input_id").option("sep", "\t").option("quoteAll", True).option("escape", '"').csv(folder)


def write_manifest(df: DataFrame, folder: str) -> None:
    """JSON lines; absent values are left out."""
    df.write.option("ignoreNullFields", True).json(folder)


def write_metadata(df: DataFrame, folder: str) -> None:
    fields = ["audio_filepath", "normalized_text", "original_text", "start", "end"]
    df.select("input_id", F.to_json(F.array(F.struct(*fields))).alias("value")).write.partitionBy("input_id").text(folder)


def write_rejects(df: DataFrame, folder: str) -> None:
    df.withColumn("generated_at", F.current_timestamp()).write.json(folder)


def rejects_by_reason(df: DataFrame) -> DataFrame:
    return df.groupBy("reason").agg(F.count("*").alias("n"))


def write_rttm(df: DataFrame, folder: str) -> None:
    df.select(rttm_line().alias("value")).write.text(folder)


def rttm_line():
    return F.format_string("SPEAKER %s 1   %.3f   %.3f <NA> <NA> %s <NA> <NA>", F.col("file_id"), F.col("start"), F.col("end") - F.col("start"), F.col("speaker"))


def write_ctm(lines: DataFrame, folder: str) -> None:
    lines.select(F.col("line").alias("value")).write.text(folder)


def nested_documents(segments: DataFrame, hyps: DataFrame) -> DataFrame:
    """(input_id, value): one JSON document for each input with dynamic keys for each model."""
    models = hyps.groupBy("input_id", "block_id", "seg_idx").agg(
        F.map_from_entries(F.flatten(F.collect_list(F.array(F.struct(F.concat(F.lit("pred_text_"), "model").alias("k"), F.col("pred_text").alias("v")), F.struct(F.concat(F.lit("norm_text_"), "model").alias("k"), F.col("norm_text").alias("v")))))).alias("h")
    )
    keys = ["input_id", "block_id", "seg_idx"]
    plain = [c for c in segments.columns if c not in keys]
    as_map = F.from_json(F.to_json(F.struct(*plain)), "map<string,string>")
    empty = F.create_map().cast("map<string,string>")
    s = segments.join(models, keys, "left").select(*keys, F.map_concat(as_map, F.coalesce(F.map_filter("h", lambda k, v: v.isNotNull()), empty)).alias("m"))
    results = s.groupBy("input_id", "block_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("seg_idx", F.to_json("m").alias("j")))), lambda x: x["j"]).alias("r"))
    block = F.concat(F.lit('{"input_id":'), F.to_json(F.struct(F.col("input_id").alias("x"))).substr(F.lit(6), F.length(F.to_json(F.struct(F.col("input_id").alias("x")))) - 6), F.lit(',"results":['), F.array_join("r", ","), F.lit("]}"))
    named = results.select("input_id", "block_id", F.concat(F.lit('"'), F.regexp_replace("block_id", '(["\\\\])', "\\\\$1"), F.lit('":'), block).alias("j"))
    return named.groupBy("input_id").agg(F.concat(F.lit("{"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block_id", "j"))), lambda x: x["j"]), ","), F.lit("}")).alias("value"))


def wide_hypotheses(segments: DataFrame, hyps: DataFrame, models: list[str]) -> DataFrame:
    """segment_path, normalized_text, one column for each model, rover_text; for CSV."""
    keys = ["input_id", "block_id", "seg_idx"]
    wide = hyps.groupBy(*keys).pivot("model", models).agg(F.first("norm_text"))
    return segments.join(wide, keys, "left").select("segment_path", "normalized_text", *models, "rover_text")


def write_buckets(df: DataFrame, name: str, bucket: str, folder: str) -> None:
    df.select(F.col(name).cast("string").alias("value"), bucket).write.partitionBy(bucket).text(folder)


def clean_log(text: DataFrame, column: str) -> DataFrame:
    """Captured process output by line, without progress lines."""
    lines = F.filter(F.split(F.regexp_replace(column, "\r", "\n"), "\n"), lambda x: (F.trim(x) != "") & ~x.rlike(r"^\s*(Transcribing|Sample):"))
    return text.withColumn(column, F.array_join(lines, "\n"))
