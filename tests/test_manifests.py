"""Manifests, clips, models, speakers and records: golden inputs and errors."""

import io
import wave

import pandas as pd
import pytest
from pyspark.sql import functions as F

from loquarium.operators import records, scores, speakers
from loquarium.__main__ import main
from loquarium.plans import backends, pipeline
from loquarium.sources import manifests, readers


def test_braces_and_scatter():
    assert list(manifests.expand_braces("a_{0..2}.tar")) == ["a_0.tar", "a_1.tar", "a_2.tar"]
    assert list(manifests.expand_braces("b_OP_08..10_CL_/{x,y}")) == ["b08/x", "b08/y", "b09/x", "b09/y", "b10/x", "b10/y"]
    assert list(manifests.expand_braces("plain")) == ["plain"]
    paths = [f"s{i}" for i in range(7)]
    assert manifests.scatter(paths, 3, 1) == ["s2", "s3"] and manifests.scatter(paths, 3, 1, replicate=True) == paths and manifests.scatter(paths, 1, 0) == paths


def test_models():
    registry = [{"lang": "ca", "name": "a", "v": 1}, {"lang": "es", "name": "a", "v": 2}, {"lang": "es", "name": "b", "enabled": False}, {"lang": "gl", "name": "c"}]
    assert [m["v"] for m in manifests.select_models(registry, ["ca", "es"])] == [2]
    assert [m["name"] for m in manifests.select_models(registry, ["ca", "es"], ["b", "a"])] == ["b", "a"]
    with pytest.raises(ValueError, match="c"):
        manifests.select_models(registry, ["ca"], ["c"])


def test_required_language(spark):
    df = spark.createDataFrame([("ca",), (None,)], "lang string")
    assert df.where("lang is not null").select(manifests.require_language(F.col("lang"), ["ca"])).first()[0] == "ca"
    with pytest.raises(Exception, match="not supported"):
        df.select(manifests.require_language(F.col("lang"), ["ca"])).collect()


def test_matched_and_stems(spark):
    a, b = (spark.createDataFrame([(x,) for x in v], "id long") for v in ([1, 2], [2, 3]))
    with pytest.raises(ValueError, match="one side"):
        manifests.matched(a, b, "id")
    assert manifests.matched(a, a, "id").count() == 2
    paths = spark.createDataFrame([("x/a.wav",), ("y/b.wav",), ("z/a.flac",)], "path string")
    with pytest.raises(ValueError, match="unique"):
        manifests.by_stem(paths)
    assert sorted(r["uniq_id"] for r in manifests.by_stem(paths.limit(2)).collect()) == ["a", "b"]


def test_lines(spark):
    lines = spark.createDataFrame([(0, "x"), (1, "﻿a …  b"), (2, " c ")], "line int, text string")
    assert [r["text"] for r in manifests.lines_between(lines, 1, 2).orderBy("line").collect()] == ["a ... b", "c"]
    cut = manifests.delimited(spark.createDataFrame([('a,"b,c"',)], "value string"), {"one": 0, "two": 1, "four": 3})
    assert tuple(cut.first())[1:] == ("a", '"b', None)
    assert spark.createDataFrame([("d/a.b.txt",)], "p string").select(manifests.cleaned_name(F.col("p"))).first()[0] == "d/a.b_splitted_and_clean.txt"


def test_clips(spark):
    samples = b"".join(i.to_bytes(2, "little") for i in range(100))
    sources = spark.createDataFrame([("a", 10, 1, bytearray(samples))], "source string, rate int, channels int, samples binary")
    segments = spark.createDataFrame([("a", 1.0, 2.04, "p1"), ("a", 3.0, 3.0, "p2"), ("b", 0.0, 1.0, "p3"), ("a", 0.0, 1.0, "p4"), ("a", 9.5, 99.0, "p5")], "source string, start double, end double, segment_path string")
    clips, rejects = manifests.cut_clips(segments, sources, spark.createDataFrame([("p4",)], "segment_path string"))
    got = {r["segment_path"]: bytes(r["wav"]) for r in clips.collect()}
    assert set(got) == {"p1", "p5"} and {tuple(r) for r in rejects.collect()} == {("p2", "empty_clip"), ("p3", "missing_source_audio")}
    with wave.open(io.BytesIO(got["p1"])) as w:
        assert (w.getnframes(), w.getframerate(), w.getnchannels(), w.getsampwidth()) == (10, 10, 1, 2) and w.readframes(10) == samples[20:40]
    with wave.open(io.BytesIO(got["p5"])) as w:
        assert w.readframes(99) == samples[190:]


def test_words_to_turns(spark):
    words = spark.createDataFrame([(1, i, a, b) for i, (a, b) in enumerate([(0.0, 0.1), (4.3, 4.5), (4.4, 4.6), (9.0, 9.2), (30.0, 31.0)])], "k int, i int, s double, e double").withColumn("at", speakers.anchor(F.col("s"), F.col("e")))
    turns = spark.createDataFrame([(1, 0.0, 4.375, "b"), (1, 4.375, 5.0, "a"), (1, 5.0, 9.0, "c"), (1, 9.0, 12.0, "d")], "k int, s double, e double, speaker string")
    near = {r["i"]: r["speaker"] for r in speakers.assign_words(words, turns, ["k"], "at", "i").collect()}
    assert near == {0: "b", 1: "b", 2: "a", 3: "c", 4: "d"}
    step = {r["i"]: r["speaker"] for r in speakers.assign_words_in_order(words.where("i <> 3"), turns, ["k"], "at", "i").collect()}
    assert step == {0: "b", 1: "b", 2: "a", 4: "c"}  # one turn further on, though two lie behind


def test_detection_and_stamps(spark):
    make = lambda rows: spark.createDataFrame(rows, "k int, s double, e double")
    r = speakers.detection_errors(make([(1, 0.0, 4.0), (1, 3.0, 6.0)]), make([(1, 5.0, 8.0)]), ["k"]).first()
    assert (r["false_alarm"], r["missed"], r["speech"], r["error"]) == (2.0, 5.0, 6.0, 7 / 6)
    got = sorted(tuple(x) for x in speakers.split_overlaps(make([(1, 0.0, 4.0), (1, 2.0, 6.0), (1, 7.0, 8.0)]), ["k"]).collect())
    assert got == [(1, 0.0, 3.0), (1, 3.0, 6.0), (1, 7.0, 8.0)]


def test_average_precision(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1)], "p double, y int")
    assert scores.auc_pr(df, "p", "y").first()[0] == pytest.approx(0.8333333333)
    assert scores.auc_yc(df.where("y = 1"), "p", "y").first()["auc"] == 0.0
    assert scores.auc_yc(df, "p", "y").first()["most"] == 0.5


def test_records(spark):
    assert records.template_fields("{q} and {a}") == ["q", "a"]
    with pytest.raises(ValueError, match="b"):
        records.template_fields("{b}", ["a"])
    df = spark.createDataFrame([(1, [0, 0, 1]), (2, [0, 1, 0]), (3, None)], "k int, m array<int>")
    assert [r["k"] for r in records.unmasked(df, "m", 2).collect()] == [2]
    assert records.only_fields(df, ["m"]).columns == ["m"]
    with pytest.raises(ValueError, match="z"):
        records.only_fields(df, ["z"])
    one = records.subsample(spark.range(100), "id", 7, 3)
    assert one.count() == 7 and one.collect() == records.subsample(spark.range(100).repartition(5), "id", 7, 3).collect()
    words = spark.createDataFrame([(["aa", "bbb", "c", "longest", "d"],)], "w array<string>")
    assert words.select(records.packed_lines(F.col("w"), 6)).first()[0] == ["aa bbb", "c", "longest", "d"]
    case = spark.createDataFrame([("Hello BIG World", ["▁he", "llo", "▁big", "▁w", "<unk>"])], "t string, k array<string>")
    assert case.select(records.restored_case(F.col("t"), F.col("k"))).first()[0] == ["▁He", "llo", "▁BIG", "▁W", "<unk>"]


def test_interleaving(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 1), ("c", 1), ("c", 2)], "s string, rn long")
    got = sorted((r["step"], r["s"], r["rn"]) for r in records.interleaved(df, "s", "rn").collect())
    assert [x[:2] for x in got] == list(enumerate("abcaca"))
    assert pd.Series([x[0] for x in got]).is_unique


def test_prediction_text():
    class Out:
        text = "d’ara"

    assert [backends.prediction_text(x) for x in ("a", {"text": "b"}, [{"text": "c"}], Out(), None, [], {}, ("e", "f"))] == ["a", "b", "c", "d'ara", "", "", "", "e"]


def test_command_line(spark, tmp_path):
    units = [("a", "b1", i * 3.0, i * 3.0 + 2.5, "el gat que és amb la casa") for i in range(4)] + [("c", "b2", 0.0, 0.1, "curt")]
    spark.createDataFrame(units, "input_id string, block_id string, start double, end double, text string").write.json(f"{tmp_path}/units")
    (tmp_path / "ids").write_text("a\n\n c \n")
    b = "loquarium.plans.backends"
    main(["pipeline", f"{tmp_path}/units", "-o", f"{tmp_path}/out", "--lang", "ca", "--model", f"m1={b}:EchoRecogniser", "--model", f"m2={b}:EchoRecogniser", "--identifier", f"{b}:MarkerIdentifier", "--punctuator", f"{b}:CapitalPunctuator", "--input-id-file", f"{tmp_path}/ids"])
    assert spark.read.json(f"{tmp_path}/out/merged").count() == 4 and spark.read.json(f"{tmp_path}/out/rejects").first()["reason"] == "duration_below_minimum"
    (tmp_path / "text").mkdir()
    (tmp_path / "text" / "x.txt").write_text("El Dr. té 16 anys!\n")
    main(["clean", f"{tmp_path}/text", "-o", f"{tmp_path}/clean", "--lang", "ca"])
    row = spark.read.text(f"{tmp_path}/clean").first()
    assert row["value"] == "el doctor té setze anys" and row["file"] == "x_splitted_and_clean"
    (tmp_path / "none").write_text(" \n")
    with pytest.raises(ValueError, match="no inputs"):
        readers.read_id_list(spark, f"{tmp_path}/none")


def test_kept_blocks(spark):
    blocks = spark.createDataFrame([("a", "b", "x.wav", "0", "1", "t", "t"), ("a", "c", "x.wav", "2", "1", "t", "t"), ("d", "e", "y.wav", "0", "1", "t", "t")], "input_id string, block_id string, audio_filepath string, start string, end string, normalized_text string, original_text string")
    audio = spark.createDataFrame([("x.wav",)], "audio_filepath string")
    kept, rejects = pipeline.kept_blocks(blocks.where("input_id = 'a'"), audio)
    assert [r["block_id"] for r in kept.collect()] == ["b"] and [r["reason"] for r in rejects.collect()] == ["invalid_times"]
    with pytest.raises(ValueError, match="d"):
        pipeline.kept_blocks(blocks, audio)
