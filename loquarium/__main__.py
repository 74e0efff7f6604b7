"""python -m loquarium: the transcript pipeline and its steps, scores, buckets, normalisers and filters.

Models are named ``name=module:Class`` (see plans.backends for what the classes must offer).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from loquarium.functions import text as T
from loquarium.operators import curation, filters, rover
from loquarium.plans import backends, pipeline
from loquarium.sources import manifests, readers, writers


def _models(named: list[str], langs: list[str]) -> list[tuple[str, str, object]]:
    """(language, model, class) of name=module:Class arguments, for every language."""
    pairs = [x.partition("=")[::2] for x in named]
    return [(lang, name, backends.load(place)) for name, place in pairs for lang in langs]


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="loquarium")
    sub = p.add_subparsers(dest="what", required=True)
    m = sub.add_parser("rover-merge", help="merge and score nested documents")
    m.add_argument("input")
    m.add_argument("-o", "--out", required=True)
    m.add_argument("--langs", nargs="*", default=["ca", "es", "eu", "gl"])
    m.add_argument("--fields", nargs="*", help="models; all by default")
    m.add_argument("--norm", action="store_true")
    m.add_argument("--strategy", choices=["centroid", "vote"], default="centroid")
    m.add_argument("--csv", action="store_true")
    s = sub.add_parser("split", help="balance a folder's files over buckets")
    s.add_argument("folder")
    s.add_argument("-n", type=int, required=True)
    s.add_argument("-o", "--out", required=True)
    n = sub.add_parser("normalize-tsv", help="sentence-split and normalise transcripts")
    n.add_argument("input")
    n.add_argument("-o", "--out", required=True)
    n.add_argument("--lang", required=True)
    d = sub.add_parser("duration-filter", help="segments within a duration range, and the rejects")
    d.add_argument("input")
    d.add_argument("-o", "--out", required=True)
    d.add_argument("--min-duration", type=float, default=2.0)
    d.add_argument("--max-duration", type=float, default=30.0)
    w = sub.add_parser("pipeline", help="aligned words to merged, scored and punctuated segments")
    w.add_argument("units", help="JSON lines: input_id, block_id, start, end, text")
    w.add_argument("-o", "--out", required=True)
    w.add_argument("--lang", required=True)
    w.add_argument("--model", action="append", default=[], help="name=module:Class, once for each")
    w.add_argument("--identifier", required=True, help="module:Class")
    w.add_argument("--punctuator", required=True, help="module:Class")
    w.add_argument("--input-id")
    w.add_argument("--input-id-file")
    w.add_argument("--strategy", choices=["centroid", "vote"], default="centroid")
    e = sub.add_parser("enrich", help="predictions of further models")
    e.add_argument("input")
    e.add_argument("-o", "--out", required=True)
    e.add_argument("--langs", nargs="*", default=["ca", "es", "eu", "gl"])
    e.add_argument("--model", action="append", required=True)
    e.add_argument("--limit", type=int)
    e.add_argument("--overwrite", action="store_true")
    u = sub.add_parser("punctuate", help="punctuate merged texts")
    u.add_argument("input")
    u.add_argument("-o", "--out", required=True)
    u.add_argument("--punctuator", required=True)
    u.add_argument("--langs", nargs="*", default=["ca", "es", "eu", "gl"])
    c = sub.add_parser("clean", help="normalise the lines of text files in full")
    c.add_argument("input")
    c.add_argument("-o", "--out", required=True)
    c.add_argument("--lang", required=True)
    c.add_argument("--punctuation", action="store_true")
    c.add_argument("--case", action="store_true")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("loquarium").getOrCreate()
    if a.what == "rover-merge":
        segments, hyps = readers.read_documents(spark, a.input)
        segments = segments.where(F.col("language").isin(a.langs)).drop("rover_text")
        hyps = hyps.where(F.col("model").isin(a.fields)) if a.fields else hyps
        keys = ["input_id", "block_id", "seg_idx"]
        norm = T.normalise if a.norm else lambda c: c
        hyps = hyps.withColumn("hyp", norm(T.clean_prediction(F.col("norm_text"))))
        merged = segments.join(rover.merge(hyps, keys, "model", "hyp", a.strategy), keys, "left")
        scored = rover.segment_scores(merged.where("rover_text is not null").withColumn("ref", norm(F.col("normalized_text"))), "ref", "rover_text")
        rover.corpus_scores(scored, []).write.mode("error").json(f"{a.out}/scores")
        merged.write.mode("error").json(f"{a.out}/merged")
        if a.csv:
            models = a.fields or sorted(r["model"] for r in hyps.select("model").distinct().collect())
            writers.wide_hypotheses(merged, hyps, models).write.option("header", True).csv(f"{a.out}/csv")
    elif a.what == "split":
        files = readers.list_files(spark, a.folder)
        writers.write_buckets(curation.balanced_buckets(files.select("name", "size"), "name", "size", a.n), "name", "bucket", a.out)
    elif a.what == "normalize-tsv":
        rows, _ = readers.read_transcripts(spark, a.input)
        out = rows.withColumn("normalized_text", T.normalise_row(F.col("text"), a.lang))
        writers.write_transcripts(out, a.out)
    elif a.what == "pipeline":
        units = spark.read.schema("input_id string, block_id string, start double, end double, text string").json(a.units)
        if a.input_id_file:
            units = manifests.members_in(units, readers.read_id_list(spark, a.input_id_file), "input_id")
        if a.input_id:
            units = units.where(F.col("input_id") == a.input_id)
        out = pipeline.run(units, pipeline.Settings(lang=a.lang, strategy=a.strategy), _models(a.model, [a.lang]), backends.load(a.identifier), backends.load(a.punctuator))
        for name in ("segments", "hypotheses", "merged", "scores", "rejects"):
            getattr(out, name).write.mode("error").json(f"{a.out}/{name}")
    elif a.what == "enrich":
        segments, hyps = readers.read_documents(spark, a.input)
        backends.enrich(segments, hyps.select("input_id", "block_id", "seg_idx", "model", "pred_text"), _models(a.model, a.langs), a.limit, a.overwrite).write.mode("error").json(a.out)
    elif a.what == "punctuate":
        segments, _ = readers.read_documents(spark, a.input)
        checked = segments.withColumn("language", manifests.require_language(F.col("language"), a.langs))
        backends.punctuate(checked, backends.load(a.punctuator)).write.mode("error").json(a.out)
    elif a.what == "clean":
        lines = spark.read.text(a.input).select(manifests.cleaned_name(F.input_file_name()).alias("path"), T.clean_text(F.col("value"), a.lang, a.punctuation, a.case).alias("value"))
        lines.select(readers.stem(F.col("path")).alias("file"), "value").write.partitionBy("file").mode("error").text(a.out)
    else:
        segments, _ = readers.read_documents(spark, a.input)
        kept, rejects = filters.split(segments.withColumn("reason", filters.duration_reason(F.col("start"), F.col("end"), a.min_duration, a.max_duration)))
        kept.write.json(f"{a.out}/kept")
        writers.write_rejects(rejects, f"{a.out}/rejects")


if __name__ == "__main__":
    main()
