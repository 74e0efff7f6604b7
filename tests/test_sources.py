"""Readers, writers, the transcript pipeline and streams."""

import json
import struct
import time

import pytest
from pyspark.sql import functions as F

from loquarium.plans import backends, pipeline
from loquarium.sources import readers, writers
from loquarium.streaming import events

DATA = "/root/testdata/sf0.001"


def test_transcripts(spark, tmp_path):
    for name, body in {"one": "a.wav\thello\n", "two": "wav_path\ttext\nb.wav\tbye\n", "three": "a\tb\nc\td\ne\tf\n", "none": "\n"}.items():
        (tmp_path / f"{name}.tsv").write_text(body)
    rows, rejects = readers.read_transcripts(spark, str(tmp_path))
    assert {r["input_id"]: r["text"] for r in rows.collect()} == {"one": "hello", "two": "bye"}
    assert [r["input_id"] for r in rejects.collect()] == ["three"]
    writers.write_transcripts(rows.withColumn("normalized_text", F.upper("text")), str(tmp_path / "out"))
    back = "".join(p.read_text() for p in (tmp_path / "out").rglob("*.csv"))
    assert '"a.wav"\t"hello"\t"HELLO"' in back


def test_ctm_rttm_frames(spark, tmp_path):
    (tmp_path / "b.ctm").write_text("f 1 0.50 0.25 a<space>b\n")
    (tmp_path / "x.rttm").write_text("SPEAKER f 1   1.000   2.500 <NA> <NA> spk <NA> <NA>\n")
    (tmp_path / "p.frame").write_text("0.1\n0.9\n")
    assert [(r["block_id"], r["text"], r["end"]) for r in readers.read_ctm(spark, str(tmp_path / "b.ctm")).collect()] == [("b", "a b", 0.75)]
    r = readers.read_rttm(spark, str(tmp_path / "x.rttm"))
    assert [tuple(x) for x in r.collect()] == [("f", 1.0, 3.5, "spk")]
    assert r.select(writers.rttm_line().alias("l")).first()["l"] == "SPEAKER f 1   1.000   2.500 <NA> <NA> spk <NA> <NA>"
    assert [(x["frame_idx"], x["p"]) for x in readers.read_frames(spark, str(tmp_path / "p.frame")).collect()] == [(0, 0.1), (1, 0.9)]


def test_manifest(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"audio_filename": "a.wav", "duration": 1.5, "normalized_text": "t", "extra": 1}\n{"duration": 2}\n{"audio_filepath": "b"}\n')
    rows = readers.read_manifest(spark, str(tmp_path / "m.json")).collect()
    assert [(r["audio_filepath"], r["text"], r["error"]) for r in rows] == [("a.wav", "t", None), (None, "", "no audio"), ("b", "", "no duration")]


def test_documents_round_trip(spark, tmp_path):
    doc = {"blk": {"input_id": "x", "results": [{"start": 0.0, "end": 3.5, "normalized_text": "a b", "language": "ca", "language_confidence": 0.9, "segment_path": "p.wav", "pred_text_m1": "A b", "norm_text_m1": "a b", "pred_text_m2": "a"}]}}
    (tmp_path / "d.json").write_text(json.dumps(doc))
    segments, hyps = readers.read_documents(spark, str(tmp_path / "d.json"))
    assert {(r["model"], r["pred_text"], r["norm_text"]) for r in hyps.collect()} == {("m1", "A b", "a b"), ("m2", "a", None)}
    back = json.loads(writers.nested_documents(segments, hyps).first()["value"])
    r = back["blk"]["results"][0]
    assert back["blk"]["input_id"] == "x" and r["norm_text_m1"] == "a b" and r["pred_text_m2"] == "a" and float(r["end"]) == 3.5
    assert writers.wide_hypotheses(segments, hyps, ["m1", "m2"]).columns == ["segment_path", "normalized_text", "m1", "m2", "rover_text"]


def test_metadata(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps([{"audio_filepath": "a", "normalized_text": [["_x", "u"], ["_y", "v"]], "original_text": "o", "start": "00:00:00", "end": "00:00:09"}]))
    r = readers.read_metadata(spark, str(tmp_path / "m.json")).first()
    assert r["normalized_text"] == "u v" and r["end"] == "00:00:09"
    blocks = readers.read_metadata(spark, str(tmp_path / "m.json")).select("audio_filepath", "normalized_text", "original_text", "start", "end")
    audio = spark.createDataFrame([("b",)], "audio_filepath string")
    assert pipeline.block_reasons(blocks, audio).first()["reason"] == "missing_source_audio"


def test_wav(spark, tmp_path):
    data = b"\0\0" * 16000
    (tmp_path / "a.wav").write_bytes(b"RIFF" + struct.pack("<I", 36 + len(data)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, 16000, 32000, 2, 16) + b"data" + struct.pack("<I", len(data)) + data)
    (tmp_path / "b.wav").write_bytes(b"junk")
    rows = {r["input_id"]: (r["rate"], r["duration"]) for r in readers.read_wav(spark, str(tmp_path)).collect()}
    assert rows == {"a": (16000, 1.0), "b": (None, None)}


def test_pipeline_accounts_for_all_rows(spark):
    rows = [("x", "b1", 0.0, 5.0, "el gat i la gata que"), ("x", "b1", 5.0, 5.1, "la"), ("x", "b1", 6.0, 7.0, "el i que amb"), ("x", "b2", 0.0, 40.0, "el i la que"), ("x", "b2", 41.0, 45.0, "zzz")]
    units = spark.createDataFrame(rows, "input_id string, block_id string, start double, end double, text string")
    s = pipeline.Settings(lang="ca")
    out = pipeline.run(units, s, [("ca", "m1", backends.EchoRecogniser), ("ca", "m2", backends.EchoRecogniser)], backends.MarkerIdentifier, backends.CapitalPunctuator)
    assert out.segments.count() + out.rejects.count() == len(rows)
    assert {r["reason"] for r in out.rejects.collect()} >= {"duration_below_minimum", "duration_above_maximum"}
    m = out.merged.first()
    assert m["rover_text"] and m["text_punctuated"].endswith(".")
    assert {r["system"] for r in out.scores.collect()} == {"m1", "m2", "rover"}
    with pytest.raises(ValueError):
        pipeline.Settings(min_duration=5, max_duration=1)


def test_failing_backend_gives_empty_text(spark):
    class Bad:
        def transcribe(self, paths):
            if any("bad" in p for p in paths):
                raise RuntimeError("no")
            return paths

    df = spark.createDataFrame([("x", "b", 0, "ok"), ("x", "b", 1, "bad")], "input_id string, block_id string, seg_idx int, segment_path string")
    assert {r["seg_idx"]: r["pred_text"] for r in backends.transcribe(df, "m", Bad).collect()} == {0: "ok", 1: ""}


def test_streams_equal_batch(spark, tmp_path):
    folder = str(tmp_path / "in")
    batch = spark.read.parquet(f"{DATA}/events.parquet")
    parts = [(None, "2024-01-05"), ("2024-01-05", "2024-01-12"), ("2024-01-12", None)]
    for a, b in parts:  # one file after another, so that the stream takes them in order
        some = batch.where(F.col("ts") >= F.lit(a).cast("timestamp_ntz")) if a else batch
        (some.where(F.col("ts") < F.lit(b).cast("timestamp_ntz")) if b else some).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1)
    batch = batch.withColumn("ts", F.col("ts").cast("timestamp"))
    stream = lambda: events.read_stream(spark, folder, 1)
    key = lambda df: sorted(tuple(r) for r in df.collect())
    got = events.run_available(events.tumbling(stream(), late="365 days").select("start", "event_type", "n"), "t1", "complete", str(tmp_path / "c1"))
    assert key(got) == key(events.tumbling(batch).select("start", "event_type", "n"))
    got = events.run_available(events.hysteresis_stream(stream(), 30.0, 5.0), "t2", "append", str(tmp_path / "c2"))
    from loquarium.operators import vad

    want = vad.hysteresis(batch, ["user_id"], ["ts", "event_id"], F.col("value"), 30.0, 5.0).select("user_id", "event_id", "state")
    assert key(got) == key(want)
