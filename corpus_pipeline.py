"""A training-data pipeline over ``documents``: language, line dedup, near duplicates, decontamination, packing.

Each stage works on all rows that its predecessor kept; all but the last return the columns of
documents.  Nothing is cut, sampled or capped on the way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loquarium.llm.common import new_path, table, written
from loquarium.llm.decontaminate import decontaminate
from loquarium.llm.jaccard_join import BROADCAST_IDS, jaccard_join
from loquarium.llm.language_id import identify, teaching, train
from loquarium.llm.line_dedup import line_dedup
from loquarium.llm.packing import best_fit_packing
from loquarium.llm.queries import tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs but for those whose doc_id is in ids; null doc_ids stay."""
    few = written(ids.where("doc_id is not null").select("doc_id").distinct(), "dropped")
    return docs.join(F.broadcast(few) if few.count() <= BROADCAST_IDS else few, "doc_id", "left_anti").select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the language models reject: null texts, texts without letters, and texts unlike any language learned."""
    model = train(teaching(docs))
    return identify(docs.select(*COLUMNS), model).where(~F.col("rejected")).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated multi-line chunks; documents of which nothing is left go, and n_chars follows the text."""
    out = line_dedup(docs.select(*COLUMNS))
    changed = F.col("lines_removed") > 0
    out = out.where(~changed | (F.trim("text") != "")).withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least doc_id of each group of near duplicates."""
    members, _ = jaccard_join(docs, percent=80, n=5)
    return _without(docs, members.where("doc_id <> component_id"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold windows of two benchmark items or more."""
    return _without(docs, decontaminate(docs, table(spark, sf_dir, "benchmark")).where("n_items >= 2"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 4096 tokens."""
    return best_fit_packing(docs, tokenizer("word_bpe_49k.json"), drops_space=True, end_id=1, capacity=4096)


STAGES = [("language_id", language_id), ("line_dedup", lines), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("packing", packing)]
#: Language identification and content-defined chunks can't be expressed in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(path := new_path(spark, "pipeline"))
            docs = spark.read.parquet(path)
    return docs
