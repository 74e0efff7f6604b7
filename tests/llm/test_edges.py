"""Every operator and pipeline stage with nulls, empties, a very long text, ties, repeated rows, empty tables and clashing names."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from loquarium.llm import decontaminate, jaccard_join, language_id, line_dedup, packing, sentence_spans, token_counts, token_store, vector_join, warc  # noqa: E402

CLASHES = "id t tag row n h g w p at gram near items least known hits spans page _page _digest digest body cut cuts marks new found _found _slot _word _mask _maybe held k l r size kind key pid slot gap piece start length part nth base path block bin h1 h2 class_id component v ok rep links chunk side doc_id2".split()
WORDS = [f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}" for i in range(100)]
SPACED = "byte_bpe_50k.json"


def prose(seed, n):
    rng = np.random.default_rng(seed)
    w = [WORDS[i] for i in rng.integers(0, 100, n)]
    return " ".join(x + ("." if i % 9 == 8 else "\n" if i % 23 == 22 else "") for i, x in enumerate(w))


A, B = prose(1, 120), prose(2, 130)
LONG = "\n".join(prose(100 + i, 400) for i in range(700))  # above a megabyte
assert len(LONG) > 1 << 20
ROWS = [(None, A), (None, A), (1, A), (1, B), (2, A), (2, A), (3, None), (4, ""), (5, " \n\t\n "), (6, LONG), (7, "!!! ???"), (8, A + " x <|endoftext|> y")]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    return df.select("*", *[F.lit(1).alias(c) for c in CLASHES])


def sizes(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_decontamination(spark, docs):
    words = A.translate({ord(c): " " for c in ".\n"}).split()
    items = [(1, " ".join(words[5:20])), (None, " ".join(words[40:60])), (2, None), (3, ""), (4, " ".join(words[30:33])), (4, " ".join(words[30:33]))]
    items = spark.createDataFrame(items, "item_id long, text string").select("*", *[F.lit(1).alias(c) for c in CLASHES])
    got = sizes(decontaminate.decontaminate(docs, items), "doc_id", "n_items", "n_hit", "n_words")
    assert len(got) == len(ROWS)  # a row each, however doc_ids repeat
    assert sum(r[1:3] == (2, 38) and r[0] in (None, 1, 2, 8) for r in got) == 6 and sum(r[1] > 0 for r in got if r[0] not in (6, 1)) == 5
    assert {r[3] for r in got if r[0] in (3, 4, 5, 7)} == {0}


def test_warc(spark):
    body = "b" * 200
    rows = [(None, "u", body), (3, None, body), (3, "u", body), (5, "u", body), (5, "u", body + "c"), (6, "u", None), (6, "u", ""), (None, "u", "z" * 300), (None, "u", "z" * 300), (9, "u", "é\n" * 900_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").select("*", *[F.lit(1).alias(c) for c in CLASHES])
    got = sizes(warc.warc_round_trip(spark, pages), "page_id", "payload_bytes", "record_type", "refers_to")
    want = [(None, 200, "revisit", 3), (3, 200, "response", None), (3, 200, "response", None), (5, 200, "revisit", 3), (5, 201, "response", None)]
    want += [(6, 0, "response", None), (6, 0, "response", None), (None, 300, "response", None), (None, 300, "response", None), (9, 2_700_000, "response", None)]
    assert got == sorted(want, key=repr)


def test_language(spark, docs):
    d = docs.withColumn("lang", F.when(F.col("doc_id") != 2, F.lit("xx")))
    model = language_id.train(d)
    got = sizes(language_id.identify(d, model), "doc_id", "lang_pred")
    assert len(got) == len(ROWS) and {r[1] for r in got if r[0] in (3, 4, 5, 7)} == {"und"} and {r[1] for r in got if r[0] in (1, 2, 6, None)} == {"xx"}
    assert set(docs.columns) <= set(language_id.identify(d, model).columns)


def test_beyond_the_basic_plane():
    own, code, letters = next(language_id.codes(["𝔞𝔟", "ab"]))
    assert letters.tolist() == [2, 2] and len(code) == 4  # two characters of one low half count as one


@pytest.mark.parametrize("op", ["counts", "store"])
def test_token_files(spark, docs, op):
    make, end = (token_counts.token_counts, 50256) if op == "counts" else (token_store.token_store, 2)
    got = make(spark, docs, public_tokenizers.path(SPACED), False, end)
    rows = sizes(got, "start", "n_tokens", "doc_id")
    at = 0
    for start, n, _ in sorted(rows, key=lambda r: r[0]):
        assert start == at
        at += n + (op == "counts")
    assert sorted((r[2] for r in rows), key=repr) == sorted((k for k, _ in ROWS), key=repr)
    assert len({r[1] for r in rows if r[2] == 2}) == 1 and {r[1] for r in rows if r[2] in (3, 4)} == {0 if op == "counts" else 1}


def test_substring_dedup(docs):
    got = sizes(sentence_spans.substring_dedup(docs), "doc_id", "n_removed", "text")
    assert len(got) == len(ROWS) and [r[2] for r in got if r[0] is None] == [A, A]
    assert all(r[1] > 10 for r in got if r[0] in (2, 8)) and [r[2] for r in got if r[0] in (3, 4, 5, 7)] == [None, "", " \n\t\n ", "!!! ???"]


def test_line_dedup(docs):
    out = line_dedup.line_dedup(docs.withColumn("lines_removed", F.lit("replaced")))
    got = sizes(out, "doc_id", "lines_removed", "text")
    lines = A.count("\n") + 1
    assert len(got) == len(ROWS) and set(out.columns) == {*docs.columns, "lines_removed"}
    assert sizes(out, *CLASHES) == [(1,) * len(CLASHES)] * len(ROWS)
    assert sorted(r[1] for r in got if r[0] in (None, 1, 6)) == [0] * 5  # rows without id stay; the first copy is that of doc 1
    assert [(r[1], r[2]) for r in got if r[0] == 2] == [(lines, "")] * 2 and [r[1] for r in got if r[0] == 8] == [lines - 1]
    assert [r[2] for r in got if r[0] in (3, 4, 5, 7)] == [None, "", " \n\t\n ", "!!! ???"]


def test_line_dedup_compares_bytes(spark):
    """Runs that count as repeats by their hash but have other bytes are told, and only these."""
    affected = spark.createDataFrame([(1, 0, "a\nb", [(0, 2, 1, 0, 0)]), (2, 0, "c\nd", [(0, 2, 1, 0, 0)]), (3, 0, "a\nb", [(0, 2, 1, 0, 0)])], "id long, tag long, t string, marks array<struct<line:int,n:int,first_id:long,first_tag:long,first_line:int>>")
    assert [tuple(r) for r in line_dedup._differing(affected).collect()] == [(2, 0, 0, 2)]
    assert line_dedup._differing(affected.where("id <> 2")) is None


def test_jaccard_join(docs):
    got = sizes(jaccard_join.jaccard_join(docs)[0], "doc_id", "n_shingles", "component_id")
    n = len(A.split()) - 4
    assert len(got) == len(ROWS) and [r[1:] for r in got if r[0] is None] == [(n, None)] * 2
    assert [r[1:] for r in got if r[0] == 2] == [(n, 1)] * 2 and [r[2] for r in got if r[0] == 8] == [1]
    assert [r[1:] for r in got if r[0] in (3, 4, 5)] == [(0, 3), (0, 4), (0, 5)]


def test_packing(docs):
    out = packing.best_fit_packing(docs, public_tokenizers.path("word_bpe_49k.json"), True, 1)
    got = sizes(out, "sequence_id", "offset", "length", "doc_id")
    assert sum(r[3] is None for r in got) == 2 and sum(r[3] in (3, 4, 5) for r in got) == 3 and {r[2] for r in got if r[3] in (3, 4, 5)} == {1}
    ends = {}
    for s, offset, length, _ in sorted(got, key=lambda r: (r[0], r[1])):
        assert offset == ends.get(s, 0)
        ends[s] = offset + length
    assert max(ends.values()) <= 4096


def test_vector_join(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=6)
    rows = [(None, v.tolist()), (1, (2 * v).tolist()), (1, (2 * v).tolist()), (2, v.tolist()), (3, None), (4, [0.0] * 6), (5, [None] + v.tolist()[1:]), (None, (7 * rng.normal(size=6)).tolist())] + [(10 + i, (v * (i + 1)).tolist()) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("*", *[F.lit(1).alias(c) for c in CLASHES])
    got = sizes(vector_join.vector_join(df), "vec_id", "n_links", "component_id", "kept")
    assert len(got) == len(rows) and {r[1:] for r in got if r[0] in (3, 4, 5)} == {(0, 3, True), (0, 4, True), (0, 5, True)}
    assert {r[1:3] for r in got if r[0] in (1, 2) or (r[0] or 0) >= 10} == {(33, 1)}  # the copy without id counts as a link


def test_empty_tables(spark, docs):
    none, byte, word = docs.limit(0), public_tokenizers.path(SPACED), public_tokenizers.path("word_bpe_49k.json")
    assert token_counts.token_counts(spark, none, byte, False, 50256).count() == 0 and packing.best_fit_packing(none, word, True, 1).count() == 0


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("edges")
    rows = [(k, t, "xx", "s", len(t or "")) for k, t in ROWS] + [(100 + i, prose(50 + i, 150), "xx", "s", 900) for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, " ".join(re.findall("[a-z]+", B)[:20])), (2, " ".join(re.findall("[a-z]+", B)[30:50])), (None, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d)


def test_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    out = {name: stage(spark, docs, tables) for name, stage in corpus_pipeline.STAGES}
    left = {name: sorted((r["doc_id"] for r in df.select("doc_id").collect()), key=repr) for name, df in out.items()}
    every = [k for k, _ in ROWS] + list(range(100, 120))
    assert left["language_id"] == sorted((k for k in every if k not in (3, 4, 5, 7)), key=repr)  # nothing to tell a language by
    assert left["line_dedup"] == sorted((k for k in every if k != 2), key=repr)  # both rows of 2 hold nothing new
    assert left["near_duplicates"] == sorted((k for k in every if k not in (2, 8)), key=repr)
    assert left["decontamination"] == sorted((k for k in every if k != 1), key=repr)  # by doc_id, so both rows of 1
    assert set(left["packing"]) == set(every)
    for name, df in list(out.items())[:-1]:
        assert df.columns == corpus_pipeline.COLUMNS
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), tables).count() == 0
