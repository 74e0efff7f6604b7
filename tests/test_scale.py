"""Operators on many or long rows: same results, in time and memory that follow the input."""

import difflib
import time

import duckdb
import numpy as np
from pyspark.sql import functions as F

from loquarium.functions import edit
from loquarium.operators import align, lookup, metrics, records, rover, stats


def within(seconds, run):
    began = time.monotonic()
    out = run()
    assert time.monotonic() - began < seconds
    return out


def test_long_session_is_swept_once(spark):
    n = 8000
    ref = spark.range(n).select(F.lit(1).alias("session"), F.lit("ref").alias("side"), F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("speaker"), (F.col("id") * 4.0).alias("s"), (F.col("id") * 4.0 + 5).alias("e"))
    hyp = ref.withColumns({"side": F.lit("hyp"), "speaker": F.lower("speaker"), "s": F.col("s") + 1})
    r = within(30, lambda: metrics.diarization_error(ref.unionByName(hyp), "session").first())
    assert (r["total"], r["miss"], r["false_alarm"], r["confusion"]) == (5.0 * n, 1.0 * n, 0, 0) and r["der"] == 0.2
    few = spark.createDataFrame([(1, "ref", "A", 0.0, 10.0), (1, "hyp", "a", 1.0, 10.0)], "session int, side string, speaker string, s double, e double")
    c = metrics.diarization_error(few, "session", 0.5).first()
    assert (c["total"], c["miss"], c["false_alarm"], c["confusion"]) == (9.0, 0.5, 0, 0)


def test_operations_of_many_and_long_pairs():
    def plain(ref, hyp):
        rows = [list(range(len(hyp) + 1))]
        for i, x in enumerate(ref, 1):
            row = [i]
            for j, y in enumerate(hyp):
                row.append(min(rows[-1][j] + (x != y), row[-1] + 1, rows[-1][j + 1] + 1))
            rows.append(row)
        i, j, out = len(ref), len(hyp), [0, 0, 0, 0]
        while i or j:
            differs = i and j and ref[i - 1] != hyp[j - 1]
            if i and j and rows[i][j] == rows[i - 1][j - 1] + differs:
                out[1 if differs else 0] += 1
                i, j = i - 1, j - 1
            elif j and rows[i][j] == rows[i][j - 1] + 1:
                out[2], j = out[2] + 1, j - 1
            else:
                out[3], i = out[3] + 1, i - 1
        return tuple(out)

    rng = np.random.default_rng(5)
    make = lambda n: [[str(x) for x in rng.choice(list("abcd"), rng.integers(0, top))] for top in (3, 14, 70, 150) for _ in range(n)]
    a, b = make(12), make(12)
    assert [tuple(x) for x in edit.many_operations(a, b).tolist()] == [plain(x, y) for x, y in zip(a, b)]
    assert edit.distances(a, b).tolist() == [sum(plain(x, y)[1:]) for x, y in zip(a, b)]
    many = [["".join(rng.choice(list("abc"), 3)) for _ in range(11)] for _ in range(20_000)]
    found = within(20, lambda: edit.many_operations(many, many[1:] + many[:1]))  # a table a pair in Python took 80 us and more each
    assert found.sum(axis=1).min() >= 11 and len(found) == 20_000


def test_rover_takes_hypotheses_with_their_segment(spark):
    rows = [(1, [(2, "c", "abcd"), (0, "a", "abce"), (1, "b", "zzzz")]), (2, [(0, "a", ""), (1, "b", None)]), (3, [(0, "a", "x y"), (1, "b", "x z"), (2, "c", "w z")])]
    wide = spark.createDataFrame(rows, "k int, systems array<struct<i:int,model:string,hyp:string>>")
    long = wide.select("k", F.explode("systems").alias("x")).select("k", "x.*")
    for strategy, first in (("centroid", "abce"), ("vote", "abce")):
        found = rover.merge_systems(wide, ["k"], "systems", "i", "hyp", strategy)
        assert {r["k"]: r["rover_text"] for r in found.collect()} == {r["k"]: r["rover_text"] for r in rover.merge(long, ["k"], "i", "hyp", strategy).collect()}
        assert found.where("k = 1").first()["rover_text"] == first and "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_silences_agree_with_sql_beyond_the_total(spark, tmp_path):
    from loquarium.plans import texts

    rows = [(i, i % 3, "click") for i in (0, 1, 2, 40, 99_999, 100_000, 100_020, 250_000)]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    assert sorted(map(tuple, texts.insert_silences(spark, str(tmp_path)).collect())) == sorted(con.execute(texts.SILENCES_SQL).fetchall())


def test_answers_against_many_common_references(spark, tmp_path):
    from loquarium.plans import scoring

    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(60)]
    make = lambda n: [" ".join(rng.choice(words, rng.integers(0, 12))) for _ in range(n)]
    refs, preds = make(40) + [None, "The w1", ""], make(30) + ["w1 the", None, ""]
    rows = spark.createDataFrame([(i, p, refs) for i, p in enumerate(preds)], "i int, p string, refs array<string>")
    common = metrics.common_answer_scores(rows, ["i"], "p", spark.createDataFrame([(x,) for x in refs], "t string"), "t")
    wanted = {r["i"]: (r["exact"], r["f1"]) for r in metrics.answer_scores(rows, "p", "refs").collect()}
    assert {r["i"]: (r["exact"], r["f1"]) for r in common.collect()} == wanted and wanted[30] == (1, 1.0)
    turns = [(k, t, ("user", "assistant")[t % 2], " ".join(rng.choice(words, 150))) for k in range(1500) for t in range(2)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    spark.createDataFrame([(i, x) for i, x in enumerate(make(300))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert within(60, lambda: scoring.metric_max_over_refs(spark, str(tmp_path)).first())["n"] == 1500  # 450 000 pairs, word by word by lambdas before


def test_punctuation_of_many_turns():
    rng = np.random.default_rng(7)
    make = lambda: "".join(rng.choice(["ab ", "c' ", ", ", ". ", "! ", "? ", "; "], 120))
    refs = [make() for _ in range(500)]
    hyps = [x.replace(",", ".") for x in refs]
    found = within(20, lambda: metrics.many_punctuation_operations(refs + ["a, b", ""], hyps + ["a b.", "?"], ".,!?"))
    commas, stops = (sum(x.count(c) for x in refs) for c in ",.")
    assert found[:-2].sum(axis=(0, 2)).sum() >= commas + stops and found[:-2, 1, 1:].sum() >= commas - found[:-2, 1, 0].sum()
    assert found[-2].tolist() == [[0, 0, 1, 0], [0, 0, 0, 1], [0] * 4, [0] * 4] and found[-1, 3].tolist() == [0, 0, 1, 0]


def test_viterbi_paths_of_many_lengths_agree_with_brute_force():
    rng = np.random.default_rng(4)
    some = []
    for _ in range(60):
        lp = np.log(rng.dirichlet(np.ones(3), rng.integers(1, 8)))
        some.append((lp, align.with_blanks(rng.integers(1, 3, rng.integers(0, 4)).tolist(), 0)))

    def best(lp, s):
        paths = [(x,) for x in range(min(2, len(s)))]
        for _ in lp[1:]:
            paths = [(*p, p[-1] + d) for p in paths for d in (0, 1, 2) if p[-1] + d < len(s) and (d < 2 or (s[p[-1] + 2] != 0 and s[p[-1] + 2] != s[p[-1]]))]
        paths = [p for p in paths if p[-1] >= len(s) - 2]
        return max((sum(lp[t, s[x]] for t, x in enumerate(p)) for p in paths), default=None)

    for (lp, s), path in zip(some, align.viterbi_many(some, 0)):
        assert (best(lp, s) is None) == (path is None)
        assert path is None or abs(sum(lp[t, s[x]] for t, x in enumerate(path)) - best(lp, s)) < 1e-4


def test_viterbi_align_moves_no_scores(spark, tmp_path):
    from loquarium.plans import sessions

    rows = [(k, "en", "abc de fgh " * 40 + "x" * k) for k in range(60)]
    spark.createDataFrame(rows, "doc_id long, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = sessions.viterbi_align(spark, str(tmp_path))
    assert all(r["last_frame"] % 3 == 2 and r["states"] * 3 == (r["last_frame"] + 1) * 2 for r in found.collect())
    assert "array<array" not in found._jdf.queryExecution().executedPlan().toString() and "HashAggregate" not in found._jdf.queryExecution().executedPlan().toString()


def test_buffers_are_folded_together(spark):
    rng = np.random.default_rng(6)
    rows = [(k, [[str(x) for x in rng.choice(list("abcde"), rng.integers(0, 7))] for _ in range(rng.integers(0, 9))]) for k in range(300)]
    rows += [(300, [[f"w{i + j}" for j in range(10)] for i in range(0, 6000, 6)])]
    wanted = {}
    for k, parts in rows:
        out = []
        for x in parts:
            out = align.merge_overlap(out, x, 4)
        wanted[k] = out
    df = spark.createDataFrame(rows, "k int, parts array<array<string>>")
    found = align.stitch_arrays(df, ["k"], "parts", 4)
    assert {r["k"]: r["tokens"] for r in found.collect()} == wanted and "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    long = df.select("k", F.posexplode("parts").alias("i", "t"))
    assert {r["k"]: r["t"] for r in align.stitch_buffers(long, ["k"], "i", "t", 4).collect()} == {k: wanted[k] for k, parts in rows if parts}


def test_word_blocks_and_sequences_agree_with_plain_ones():
    rng = np.random.default_rng(8)
    for _ in range(300):
        a, b = (list(rng.choice(list("abcdef"), rng.integers(0, 14))) for _ in range(2))
        hit = [0] * len(a)
        for m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks():
            hit[m.a : m.a + m.size] = [1] * m.size
        assert stats.matched(a, b) == hit
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b):
                last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
        assert metrics._lcs(a, b) == row[-1] and metrics._shared(a, b) == sum(min(a.count(x), b.count(x)) for x in set(a))
    long = [str(x) for x in rng.integers(0, 50, 6000)]
    assert within(10, lambda: metrics._lcs(long, long[1:] + ["x"])) == 5999


def test_sessions_are_compared_together(spark):
    rows = [(k, o, s, f"a{o} b c", None) for k in range(300) for o, s in enumerate("ABAB" * 30)] + [(k, o, s, None, f"a{o} b x") for k in range(300) for o, s in enumerate("1212" * 30)]
    df = spark.createDataFrame([*rows, (300, 0, "A", "a", None), (301, 0, "1", None, "a")], "session int, ord int, speaker string, ref string, hyp string")
    found = {r["session"]: (r["errors"], r["words"], r["cpwer"]) for r in within(60, lambda: metrics.cp_wer(df, "session", "speaker", "ref", "hyp").collect())}
    assert found[0] == found[299] == (120, 360, 120 / 360) and found[300] == (1, 1, 1.0) and found[301] == (1, 0, float("inf"))


def test_nearest_in_slices(spark, monkeypatch):
    monkeypatch.setattr(lookup, "SLICE", 7)
    rng = np.random.default_rng(9)
    v = rng.integers(-2, 3, (150, 3)).astype(float)  # many equal products
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    found = sorted((r["query"], r["rank"], r["item"]) for r in lookup.knn(df.where("id % 5 = 0"), df, "id", "v", 4).collect())
    assert found == [(q, n, i) for q in range(0, 150, 5) for n, i in enumerate(sorted((i for i in range(150) if i != q), key=lambda i: (-(v[q] @ v[i]), i))[:4], 1)]


def test_case_of_long_texts_is_restored_in_one_pass(spark):
    words = ["Wort", "ÉÀ", "ok", "X" * 30] * 12_000
    rows = [(" ".join(words), ["▁" + w.lower() for w in words]), ("Ab", ["▁a", "b", "▁c"]), (None, ["▁a"]), ("A", None), ("A B", ["▁a", None, "▁b"])]
    found = spark.createDataFrame(rows, "t string, p array<string>").select(records.restored_case(F.col("t"), F.col("p")).alias("x"))
    long, *rest = within(40, lambda: [r["x"] for r in found.collect()])
    assert long == ["▁" + w for w in words]
    assert rest == [["▁A", "b", "▁c"], ["▁a"], None, ["▁A", None, "▁b"]]


def test_plain_words_are_not_expanded_one_by_one():
    from loquarium.functions import words

    words._expanded.cache_clear()
    assert words.expand("etc plain wörter dr IV UE", "es") == "etcétera plain wörter doctor quarto UE" and words._expanded.cache_info().misses == 4


def test_signs_are_named_in_one_pass(spark):
    from loquarium.functions import text, words

    rows = [("a€b µ^]-\\ x",), ("plain text",), (None,), ("",), ("𝜆²",), ("€€",)]
    df = spark.createDataFrame(rows, "t string").select(text.replace_chars(F.col("t"), words.symbols("es")).alias("x"))
    assert [r["x"] for r in df.collect()] == ["a euros b  micro ^]-\\ x", "plain text", None, "", " Lambda  al cuadrado ", " euros  euros "]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("replace(") == 0
