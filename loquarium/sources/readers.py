"""Sources: transcript tables, alignments, interval files, manifests, nested documents, audio headers."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEGMENT = "struct<start:double,end:double,normalized_text:string,language:string,language_confidence:double,segment_path:string,rover_text:string,text_normalized:string,text_punctuated:string>"


def stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)


def read_transcripts(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of two-column files with an optional header: the last of one or two filled lines.

    Files with another number of filled lines are rejects.
    """
    lines = spark.read.text(paths, wholetext=True).select(F.input_file_name().alias("path"), F.posexplode(F.split("value", r"\r?\n")).alias("line", "value"))
    lines = lines.where(F.trim(F.regexp_replace("value", "\t", " ")) != "")
    per = lines.groupBy("path").agg(F.count("*").alias("n"), F.max_by("value", "line").alias("value"))
    parts = F.split("value", "\t", -1)
    plain = lambda c: F.regexp_replace(F.regexp_replace(c, r'^"|"$', ""), '""', '"')
    row = per.select(stem(F.col("path")).alias("input_id"), "n", plain(F.get(parts, F.lit(0))).alias("wav_path"), plain(F.get(parts, F.lit(1))).alias("text"), plain(F.get(parts, F.lit(2))).alias("normalized_text"))
    good = F.col("n").isin(1, 2)
    return row.where(good).drop("n"), row.where(~good).select("input_id", F.lit("unexpected_row_count").alias("reason"), F.col("n").cast("string").alias("details"))


def valid_inputs(audio: DataFrame, transcripts: DataFrame) -> DataFrame:
    return audio.select("input_id").intersect(transcripts.select("input_id"))


def missing_inputs(audio: DataFrame, transcripts: DataFrame) -> DataFrame:
    """(input_id, reason) of inputs with one side only."""
    a, t = audio.select("input_id").distinct(), transcripts.select("input_id").distinct()
    return a.join(t, "input_id", "left_anti").withColumn("reason", F.lit("missing_transcript")).unionByName(t.join(a, "input_id", "left_anti").withColumn("reason", F.lit("missing_source_audio")))


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """(input_id) of the lines that are not blank; a list without any is an error."""
    ids = spark.read.text(path).select(F.trim("value").alias("input_id")).where("input_id <> ''")
    if not ids.take(1):
        raise ValueError(f"{path} names no inputs")
    return ids


def read_ctm(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(block_id, file, channel, start, duration, end, text); ``<space>`` is a blank."""
    schema = "file string, channel int, start double, duration double, text string"
    df = spark.read.csv(paths, sep=" ", schema=schema, quote="", recursiveFileLookup=True).withColumn("block_id", stem(F.input_file_name()))
    return df.withColumns({"text": F.replace("text", F.lit("<space>"), F.lit(" ")), "end": F.col("start") + F.col("duration")})


def read_rttm(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file_id, start, end, speaker)."""
    p = F.split(F.trim("value"), r"\s+")
    at = lambda i: F.get(p, F.lit(i))
    df = spark.read.text(paths).where(at(0) == "SPEAKER")
    return df.select(at(1).alias("file_id"), at(3).cast("double").alias("start"), (at(3).cast("double") + at(4).cast("double")).alias("end"), at(7).alias("speaker"))


def read_frames(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file_id, frame_idx, p) of files with one number a line."""
    df = spark.read.text(paths, wholetext=True).select(stem(F.input_file_name()).alias("file_id"), F.posexplode(F.split(F.regexp_replace("value", r"^\s+|\s+$", ""), r"\s+")).alias("frame_idx", "p"))
    return df.where("p <> ''").withColumn("p", F.col("p").cast("double"))


def read_manifest(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """JSON lines with known keys as columns: aliases resolved, text falls back to normalized_text and then "", the whole line kept in raw.

    duration and an audio path are mandatory; rows without them carry an error.
    """
    schema = "audio_filepath string, audio_filename string, video_filepath string, duration double, offset double, text string, normalized_text string, pred_text string, speaker string, lang string, label string"
    df = spark.read.text(paths).where("trim(value) <> ''").select("value", F.from_json("value", schema).alias("j"))
    out = df.select(
        F.coalesce("j.audio_filepath", "j.audio_filename", "j.video_filepath").alias("audio_filepath"), "j.duration", F.coalesce("j.offset", F.lit(0.0)).alias("offset"),
        F.coalesce("j.text", "j.normalized_text", F.lit("")).alias("text"), "j.pred_text", "j.speaker", "j.lang", "j.label", F.col("value").alias("raw"),
    )
    return out.withColumn("error", F.when(F.col("audio_filepath").isNull(), "no audio").when(F.col("duration").isNull(), "no duration"))


def read_metadata(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Blocks of JSON arrays; a text that is a list of pairs is its second members joined by blanks."""
    raw = spark.read.text(paths, wholetext=True).select(stem(F.input_file_name()).alias("input_id"), F.posexplode(F.from_json("value", "array<string>")).alias("block", "v"))
    pairs = F.array_join(F.transform(F.from_json(F.get_json_object("v", "$.normalized_text"), "array<array<string>>"), lambda p: F.get(p, F.lit(1))), " ")
    get = lambda k: F.get_json_object("v", f"$.{k}")
    return raw.select("input_id", "block", get("audio_filepath").alias("audio_filepath"), F.coalesce(pairs, get("normalized_text")).alias("normalized_text"), get("original_text").alias("original_text"), get("start").alias("start"), get("end").alias("end"))


def read_documents(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(segments, hypotheses) of nested documents {block: {input_id, results: [segment]}}; dynamic pred_text_* and norm_text_* keys become rows."""
    blocks = spark.read.text(paths, wholetext=True).select(F.explode(F.from_json("value", "map<string,string>")).alias("block_id", "b"))
    blocks = blocks.select("block_id", F.get_json_object("b", "$.input_id").alias("input_id"), F.from_json(F.get_json_object("b", "$.results"), "array<string>").alias("r")).where("r is not null")
    rows = blocks.select("input_id", "block_id", F.posexplode("r").alias("seg_idx", "s"))
    segments = rows.select("input_id", "block_id", "seg_idx", F.from_json("s", SEGMENT).alias("j")).select("input_id", "block_id", "seg_idx", "j.*")
    keys = rows.select("input_id", "block_id", "seg_idx", F.explode(F.from_json("s", "map<string,string>")).alias("k", "v")).where("k rlike '^(pred|norm)_text_'")
    hyps = keys.withColumn("model", F.regexp_replace("k", "^(pred|norm)_text_", "")).groupBy("input_id", "block_id", "seg_idx", "model")
    value = lambda p: F.max(F.when(F.startswith("k", F.lit(p)), F.col("v")))
    return segments, hyps.agg(value("pred").alias("pred_text"), value("norm").alias("norm_text"))


@F.pandas_udf(T.StructType([T.StructField(n, t) for n, t in (("channels", T.IntegerType()), ("rate", T.IntegerType()), ("bits", T.IntegerType()), ("frames", T.LongType()), ("duration", T.DoubleType()))]))
def wav_header(contents: pd.Series) -> pd.DataFrame:
    """Header fields of RIFF files; nulls where there is no such header."""

    def one(raw: bytes):
        if raw is None or raw[:4] != b"RIFF" or raw[8:12] != b"WAVE":
            return (None,) * 5
        at, fmt = 12, None
        while at + 8 <= len(raw):
            name, size = raw[at : at + 4], int.from_bytes(raw[at + 4 : at + 8], "little")
            if name == b"fmt ":
                fmt = struct.unpack_from("<HHIIHH", raw, at + 8)
            elif name == b"data" and fmt:
                frames = size // max(1, fmt[4])
                return fmt[1], fmt[2], fmt[5], frames, frames / fmt[2]
            at += 8 + size + size % 2
        return (None,) * 5

    out = pd.DataFrame([one(x) for x in contents], columns=["channels", "rate", "bits", "frames", "duration"])
    return out.astype({"channels": "Int32", "rate": "Int32", "bits": "Int32", "frames": "Int64"})


def read_wav(spark: SparkSession, paths: str | list[str], header_bytes: int = 65_536) -> DataFrame:
    """(input_id, path, channels, rate, bits, frames, duration); only the first bytes of a file, where the header lies, go to Python."""
    df = spark.read.format("binaryFile").load(paths)
    return df.select(stem(F.col("path")).alias("input_id"), "path", wav_header(F.substring("content", 1, header_bytes)).alias("h")).select("input_id", "path", "h.*")


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, name, size) of a folder's own files that are no transcripts."""
    df = spark.read.format("binaryFile").load(folder).select("path", F.col("length").alias("size"))
    return df.where(~F.endswith("path", F.lit(".tsv"))).withColumn("name", stem(F.col("path")))


def kaldi(segments: DataFrame, wav: DataFrame, text: DataFrame, speakers: DataFrame | None = None, genders: DataFrame | None = None) -> DataFrame:
    """Segments with their audio and text (inner), and speaker and gender where known (left)."""
    out = segments.join(wav, "wav_label").join(text, "label").withColumn("duration", F.round(F.col("end") - F.col("offset"), 3))
    for extra in (speakers, genders):
        out = out.join(extra, "label", "left") if extra is not None else out
    return out.drop("end")


def load_prompts(spark: SparkSession, path: str) -> DataFrame:
    """A prompt table by its suffix: all strings, nulls empty."""
    kind = path.rpartition(".")[2]
    if kind in ("jsonl", "json"):
        df = spark.read.json(path, multiLine=kind == "json", primitivesAsString=True)
    elif kind in ("csv", "tsv"):
        df = spark.read.csv(path, header=True, sep="\t" if kind == "tsv" else ",")
    elif kind == "xlsx":
        df = spark.createDataFrame(pd.read_excel(path, dtype=str))
    else:
        raise ValueError(f"no reader for {kind}")
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns]).fillna("")


def lines_numbered(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(file, line, value): line numbers within each file."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(F.split(F.regexp_replace("value", r"\r?\n$", ""), r"\r?\n")).alias("line", key))


def intersect_lines(parts: DataFrame, part: str, line: str, text: str) -> DataFrame:
    """Lines that all versions of a part agree on."""
    w = Window.partitionBy(part, line)
    same = F.min(text).over(w).eqNullSafe(F.max(text).over(w))
    return parts.withColumn("_same", same).where("_same").groupBy(part, line).agg(F.min(text).alias(text))
