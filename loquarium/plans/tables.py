"""How the driver's tables stand in for transcripts, hypotheses and intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Letters of an utterance; whole texts are cut into so long ones.
UTTERANCE = 60


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents; a table of fewer files than there are cores is dealt out, as one row group is one task else."""
    d, cores = table(spark, sf_dir, "documents"), spark.sparkContext.defaultParallelism
    return d.repartition(cores, "doc_id") if len(d.inputFiles()) < cores else d


#: Rows in an Arrow batch of whole texts; Spark's own 10 000 can be hundreds of megabytes.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batches to BATCH_ROWS rows, for UDFs that get whole texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, lang, ref): ASCII letters and blanks of whole texts, in utterances of UTTERANCE letters; doc_id numbers them (a hundred thousand a document)."""
    whole = F.regexp_replace(F.lower("text"), "[^a-z ]", "")
    cut = F.when(F.length("t") > 0, F.regexp_extract_all("t", F.lit(f".{{1,{UTTERANCE}}}"), F.lit(0))).otherwise(F.array("t"))  # one pass over a text
    parts = texts(spark, sf_dir).select("doc_id", "lang", whole.alias("t")).select("doc_id", "lang", F.posexplode(cut).alias("i", "ref"))
    return parts.select((F.col("doc_id") * 100_000 + F.col("i")).alias("doc_id"), "lang", "ref")


def whole_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of whole texts, for queries without SQL."""
    return texts(spark, sf_dir).select("doc_id", "lang", F.regexp_replace(F.lower("text"), "[^a-z ]", "").alias("ref"))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, ref, systems): utterances with array<struct<i, model, hyp>> of four systems, the first without errors."""
    r = F.col("ref")
    systems = [r, F.replace(r, F.lit("e"), F.lit("a")), F.substring(r, 1, 55), F.translate(r, "ion", "oni")]
    rows = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(f"h{i}").alias("model"), h.alias("hyp")) for i, h in enumerate(systems)])
    return references(spark, sf_dir).select("doc_id", "ref", rows.alias("systems"))


def hypotheses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, ref, i, model, hyp): segments with a row for each system."""
    return segments(spark, sf_dir).select("doc_id", "ref", F.explode("systems").alias("x")).select("doc_id", "ref", "x.*")


REF_SQL = """w as (select doc_id, lang, regexp_replace(lower(text), '[^a-z ]', '', 'g') t from documents), u as (select *, unnest(range(0, greatest(coalesce(length(t), 1) - 1, 0) // 60 + 1)) i from w),
d as (select doc_id * 100000 + i doc_id, lang, substring(t, cast(i * 60 + 1 as bigint), 60) ref from u)"""
HYP_SQL = (
    REF_SQL
    + """, h as (select doc_id, ref, 0 i, 'h0' model, ref hyp from d union all select doc_id, ref, 1, 'h1', replace(ref, 'e', 'a') from d
union all select doc_id, ref, 2, 'h2', substring(ref, 1, 55) from d union all select doc_id, ref, 3, 'h3', translate(ref, 'ion', 'oni') from d)"""
)


def word_errors_sql(ref: str, hyp: str) -> str:
    """Token edit distance in SQL: tokens renamed to single bytes (short texts only)."""
    names = f"list_distinct(list_concat({tokens_sql(ref)}, {tokens_sql(hyp)}))"
    renamed = lambda x: f"array_to_string(list_transform({tokens_sql(x)}, lambda t: chr(cast(32 + list_position({names}, t) as integer))), '')"
    return f"levenshtein({renamed(ref)}, {renamed(hyp)})"


def tokens_sql(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda t: t <> '')"


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, event_id, event_type, s, e, cents): events as intervals in whole seconds."""
    s = F.unix_timestamp(F.col("ts").cast("timestamp"))
    cents = F.round(F.col("value") * 100).cast("long")
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", s.alias("s"), cents.alias("cents"))
    return e.select("*", (F.col("s") + F.expr("cents div 2")).alias("e"))


SPAN_SQL = """i as (select user_id, event_id, event_type, cast(floor(epoch(ts)) as bigint) s, cast(round(value * 100) as bigint) cents from events),
iv as (select *, s + cents // 2 e from i)"""
