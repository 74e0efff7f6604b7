"""Golden cases of the reference's operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loquarium.functions import edit, words
from loquarium.functions import text as T
from loquarium.operators import align, curation, filters, intervals, lid, lookup, metrics, rover, stats, tabular, vad


def col(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(fn(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "hyp, ref, want",
    [("cat", "cot", 1.0), ("GPU", "G P U", 1.0), ("G P U", "GPU", 3.0), ("ducati motorcycle", "motorcycle", 1.0), ("ducati motorcycle", "ducuti motorcycle", 0.5), ("a B c", "a b c", 1 / 3)],
)
def test_wer(spark, hyp, ref, want):
    row = spark.createDataFrame([(ref, hyp)], "r string, h string").select(edit.wer(F.col("r"), F.col("h")).alias("w")).first()
    assert row["w"] == pytest.approx(want)


def test_wer_detail(spark):
    one = lambda r, h, **k: metrics.error_rate(spark.createDataFrame([(r, h)], "r string, h string"), "r", "h", **k).first()
    d = one("GPU", "G P U")
    assert (d["rate"], d["length"], d["ins_rate"], d["del_rate"], d["sub_rate"]) == (3.0, 1, 2.0, 0.0, 1.0)
    d = one("", "cat")
    assert d["rate"] == float("inf") and d["length"] == 0 and d["ins_rate"] == float("inf")
    d = one("ducuti motorcycle", "", chars=True)
    assert (d["rate"], d["length"], d["del_rate"]) == (1.0, 17, 1.0)
    d = metrics.error_rate(spark.createDataFrame([("", "cat"), ("gpu", "")], "r string, h string"), "r", "h").first()
    assert (d["rate"], d["length"], d["ins_rate"], d["del_rate"]) == (2.0, 1, 1.0, 1.0)


def test_per_utterance(spark):
    d = metrics.per_utterance(spark.createDataFrame([("ducati motorcycle", "ducuti motorcycle"), ("GPU", "G P U"), ("", "x"), ("", "")], "r string, h string"), "r", "h").collect()
    assert [r["rate"] for r in d] == [0.5, 3.0, float("inf"), 0.0]
    assert col(spark, "això", lambda x: F.levenshtein(x, F.lit("aixo")), "string") == 1


def test_token_distance_matches_plain(spark):
    rng = np.random.default_rng(3)
    rows = [(" ".join(rng.choice(list("abcd"), rng.integers(0, 9))), " ".join(rng.choice(list("abcd"), rng.integers(0, 9)))) for _ in range(60)]
    got = spark.createDataFrame(rows, "a string, b string").select(edit.token_distance(edit.tokens(F.col("a")), edit.tokens(F.col("b"))).alias("d")).collect()
    assert [r["d"] for r in got] == [sum(edit.operations(a.split(), b.split())[1:]) for a, b in rows]


def test_punctuation_error_rate(spark):
    df = spark.createDataFrame([("Hi, dear! Nice to see you. What's", "Hi dear! Nice to see you! What's?")], "r string, h string")
    r = metrics.punctuation_error_rate(df, "r", "h").where("mark = 'all'").first()
    assert [r[f"{k}_rate"] for k in ("correct", "dels", "ins", "subs")] == [0.25] * 4 and r["error_rate"] == 0.75


@pytest.mark.parametrize(
    "strategy, hyps, want",
    [
        ("centroid", ["a b c", "a b c", "x"], "a b c"),
        ("centroid", ["abcd", "abce", "zzzz"], "abcd"),
        ("vote", ["the cat", "the dog sat", "a cat"], "the cat sat"),
        ("vote", ["x", "y"], "x"),
        ("centroid", ["a"], "a"),
        ("centroid", ["", "b"], "b"),
        ("vote", [""], None),
    ],
)
def test_rover(spark, strategy, hyps, want):
    df = spark.createDataFrame([(1, i, h) for i, h in enumerate(hyps)], "k int, i int, h string")
    assert rover.merge(df, ["k"], "i", "h", strategy).first()["rover_text"] == want


def spans(spark, rows):
    return spark.createDataFrame([(1, float(a), float(b)) for a, b in rows], "k int, s double, e double")


def got(df):
    return sorted((r["s"], r["e"]) for r in df.collect())


@pytest.mark.parametrize(
    "rows, want",
    [
        ([(1, 4), (2, 6), (8, 10), (15, 18)], [(1, 6), (8, 10), (15, 18)]),
        ([(15, 18), (8, 10), (1, 3), (2, 6)], [(1, 6), (8, 10), (15, 18)]),
        ([(6, 8), (0, 9), (2, 4), (4, 7)], [(0, 9)]),
        ([(0, 10), (1, 2), (3, 4)], [(0, 10)]),
        ([(0.25, 1.7), (1.5, 3), (2.8, 5), (5.5, 10)], [(0.25, 5), (5.5, 10)]),
    ],
)
def test_islands(spark, rows, want):
    merged = intervals.islands(spans(spark, rows), ["k"])
    assert got(merged) == want
    assert got(intervals.islands(merged, ["k"])) == want


def test_island_variants(spark):
    assert got(intervals.islands_adjacent(spans(spark, [(0, 10), (1, 2), (3, 4)]), ["k"])) == [(0, 2), (3, 4)]
    touching = spans(spark, [(0, 1), (1, 2)])
    assert got(intervals.merge_float(touching, ["k"], margin=0)) == [(0, 2)]
    assert got(intervals.merge_float(touching, ["k"], margin=2)) == [(0, 1), (1, 2)]
    assert got(intervals.islands(touching, ["k"], touching="split")) == [(0, 1), (1, 2)]


def test_overlaps_and_gaps(spark):
    df = spans(spark, [(0, 2), (1, 3)])
    assert got(intervals.islands(df, ["k"])) == [(0, 3)] and got(intervals.overlaps(df, ["k"])) == [(1, 2)]
    assert got(intervals.gaps(spans(spark, [(1, 3)]), ["k"], origin=0.0)) == [(0, 1)]
    assert got(intervals.clip(spans(spark, [(0, 2), (3, 4)]), F.lit(1.0), F.lit(3.0))) == [(1, 2)]


def test_range_join_is_the_theta_join(spark):
    rng = np.random.default_rng(5)
    p = [(int(rng.integers(0, 3)), i, float(rng.uniform(0, 50))) for i in range(80)]
    s = [(int(rng.integers(0, 3)), i, float(a), float(a + rng.exponential(4))) for i, a in enumerate(rng.uniform(0, 50, 40))]
    pd_, sd = spark.createDataFrame(p, "k int, p int, at double"), spark.createDataFrame(s, "k int, i int, s double, e double")
    got_ = {(r["p"], r["i"]) for r in intervals.range_join(pd_, sd, ["k"], "at", "s", "e", 3.0).collect()}
    assert got_ == {(b, j) for a, b, t in p for c, j, x, y in s if a == c and x <= t < y}
    other = sd.select("k", F.col("i").alias("j"), F.col("s").alias("s2"), F.col("e").alias("e2"))
    rows = intervals.overlap_join(sd, other, ["k"], 3.0).collect()
    assert sorted((r["i"], r["j"]) for r in rows) == sorted((i, j) for a, i, x, y in s for c, j, u, v in s if a == c and y > u and x < v)


def test_subsegments(spark):
    rows = intervals.subsegments(spark.range(1), F.lit(0.0), F.lit(4.0), 1.5, 0.75).orderBy("s").collect()
    assert [r["s"] for r in rows] == [0, 0.75, 1.5, 2.25, 3.0] and rows[-1]["dur"] == 1.0


def test_frames_round_trip(spark):
    df = spark.createDataFrame([(1, 0.0, 2.0, 3.0)], "k int, s double, e double, total double")
    frames = intervals.frame_labels(df, ["k"], F.col("total"), 0.02)
    assert frames.count() == 150 and frames.agg(F.sum("label")).first()[0] == 100
    assert [(round(a, 6), round(b, 6)) for a, b in got(intervals.frames_to_segments(frames, ["k"], "frame", "label", 0.02))] == [(0, 2)]


@pytest.mark.parametrize("bounds, want", [("(]", [2.01, 30]), ("[]", [2, 2.01, 30]), ("[)", [2, 2.01])])
def test_duration_bounds(spark, bounds, want):
    df = spark.createDataFrame([(x,) for x in (2.0, 2.01, 30.0, 30.01)], "d double")
    assert sorted(r["d"] for r in df.where(filters.within(F.col("d"), 2, 30, bounds)).collect()) == want


def test_reasons_split_all_rows(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.0, 10.0), (0.0, 40.0), (None, 3.0)], "start double, end double")
    kept, rejects = filters.split(df.withColumn("reason", filters.duration_reason(F.col("start"), F.col("end"), 2, 30)))
    assert kept.count() == 2 and {r["reason"] for r in rejects.collect()} == {"duration_below_minimum", "duration_above_maximum"}


@pytest.mark.parametrize(
    "preds, primary, want",
    [
        ([], None, ("unknown", 0.0)),
        ([("es", 0.5), ("eu", 0.35)], None, ("eu", 0.35)),
        ([("es", 0.7), ("eu", 0.35)], None, ("es", 0.7)),
        ([("pt", 0.6), ("gl", 0.3)], "gl", ("gl", 0.3)),
        ([("pt", 0.6), ("gl", 0.3)], None, ("pt", 0.6)),
        ([("es", 0.55), ("gl", 0.2)], "gl", ("gl", 0.2)),
        ([("fr", 0.4), ("ca", 0.1)], "ca", ("ca", 0.1)),
        ([("es", 0.45), ("ca", 0.3)], None, ("ca", 0.3)),
    ],
)
def test_language_ladder(spark, preds, primary, want):
    df = spark.createDataFrame([(preds, primary)], "p array<struct<lang:string,conf:double>>, q string")
    r = df.select(lid.choose(F.col("p"), F.col("q") if primary else None).alias("c")).first()["c"]
    assert tuple(r) == want


def test_catalan_marks(spark):
    df = spark.createDataFrame([("això és", [("ca", 0.9), ("es", 0.1)])], "t string, p array<struct<lang:string,conf:double>>")
    assert df.select(lid.choose_for_text(F.col("t"), F.col("p")).alias("c")).first()["c"]["conf"] == 0.9
    assert df.select(lid.choose_for_text(F.col("t"), F.col("p"), compat=True).alias("c")).first()["c"]["conf"] == 0.01


@pytest.mark.parametrize(
    "lang, text, parts",
    [
        ("ca", "El 16 de gener", ["setze"]), ("ca", "farà 30 anys", ["trenta"]), ("ca", "3,14 metres", ["tres", "coma"]), ("ca", "50€", ["cinquanta", "euros"]), ("ca", "50%", ["per cent"]),
        ("ca", "α β γ", ["alfa", "beta", "gamma"]), ("ca", "1º", ["primer"]), ("ca", "120 km", ["quilòmetres"]), ("es", "18 provincias", ["dieciocho"]), ("es", "50 personas", ["cincuenta"]),
        ("es", "1º lugar", ["primero"]), ("es", "50%", ["por ciento"]), ("es", "120 km", ["quilómetros"]),
    ],
)
def test_clean_text(spark, lang, text, parts):
    out = col(spark, text, lambda x: T.clean_text(x, lang))
    assert all(p in out for p in parts), out
    assert out == out.lower() and not set("!?,") & set(out)


@pytest.mark.parametrize("lang", ["ca", "es", "eu", "gl"])
def test_clean_text_has_no_marks(spark, lang):
    out = col(spark, "Kaixo, MUNDUA! Zer moduz?", lambda x: T.clean_text(x, lang))
    assert out == out.lower() and not set("!?,") & set(out)


def test_unknown_language():
    with pytest.raises(ValueError):
        T.clean_text(F, "xx")


@pytest.mark.parametrize("n, es, ca", [(0, "cero", "zero"), (21, "veintiuno", "vint-i-u"), (35, "treinta y cinco", "trenta-cinc"), (100, "cien", "cent"), (1000, "mil", "mil"), (2024, "dos mil veinticuatro", "dos mil vint-i-quatre"), (1_000_000, "un millón", "un milió")])
def test_cardinals(n, es, ca):
    assert words.cardinal(n, "es") == es and words.cardinal(n, "ca") == ca


def test_numbers_do_not_corrupt_each_other(spark):
    assert col(spark, "9 y 19", T.number_words("es")) == "nueve y diecinueve"


def test_roman_and_initials():
    assert words.roman_numerals("es")["xiv"] == "catorce" and words.roman_numerals("ca")["xxi"] == "vint-i-un" and "x" not in words.roman_numerals("es")
    assert words.initials("BBC", "es") == "be be ce" and words.initials("UNESCO", "es") == "UNESCO" and words.initials("WWF", "ca") == "ve doble ve doble efa"


@pytest.mark.parametrize(
    "lang, text, want",
    [
        ("es", "el Dr. (XIV, y la BBC", "el doctor. (catorce, y la be be ce"), ("es", "Sra., etc.", "señora., etcétera."), ("ca", "d'en Pere-Joan", "d'en Pere-Joan"), ("es", "10km 5kg", "10 quilómetros 5 quilogramos"),
        ("ca", "l'ONU i el XXI", "l'ONU i el vint-i-un"), ("es", "PSOE", "pe soe"), ("es", "«A»", "«A»"), ("es", "", ""),
    ],
)
def test_expand(lang, text, want):
    assert words.expand(text, lang) == want


@pytest.mark.parametrize(
    "text, plain, marked",
    [
        ("fa 1.000.000", "fa 1000000", "fa 1000000"), ("sud-est - o -est", "sud-est   o  est", "sud-est   o  est"), ("col·legi ·a", "col·legi  a", "col·legi  a"), ("l'home 'dit' d'", "l'home  dit  d ", "l'home 'dit' d"),
        ("1,5 i, dos", "1,5 i dos", "1,5 i, dos"), ("a#b", "ab", "ab"), ("-ai-", " ai ", " ai "),
    ],
)
def test_bad_cases(spark, text, plain, marked):
    assert col(spark, text, T.remove_bad_cases) == plain
    assert col(spark, text, lambda x: T.remove_bad_cases(x, True)) == marked


def test_row_normaliser(spark):
    assert col(spark, "El sr. Pere té 16 anys\nFi - ja està · sí|no! 3,14", lambda x: T.normalise_row(x, "ca")) == "el senyor pere té setze anys|fi|ja està|sí|no|tres catorze"
    assert col(spark, "Kaixo, mundua! Zer moduz?", lambda x: T.normalise_row(x, "eu", "#")) == "kaixo mundua#zer moduz"
    assert col(spark, " .!? ", lambda x: T.normalise_row(x, "es")) == ""
    assert set("äñ°€π") <= set(T.valid_chars("es")) and col(spark, "Ñandú §¶ 5€ Π", lambda x: T.remove_chars(x, False, "es")) == "Ñandú    5€ Π"


def test_split_and_answers(spark):
    assert col(spark, "Hola. Què tal? Fi\nv1.2 ok", T.split_sentences) == "Hola|Què tal|Fi|v1.2 ok"
    assert col(spark, "The  cat, a dog!", T.normalise_answer) == "cat dog"
    assert col(spark, "01:02:03", T.hms_seconds) == 3723.0 and col(spark, "4.5", T.hms_seconds) == 4.5
    assert col(spark, '["x y"]', T.singleton_array_text) == "x y" and col(spark, "plain", T.singleton_array_text) == "plain"
    assert col(spark, "['a', 'b']", T.clean_prediction) == "a b" and col(spark, "['a'", T.clean_prediction) == "['a'"


def test_alignment_parts(spark):
    df = spark.createDataFrame([(1, "Un gat!|...|dos gossos"), (2, "")], "k int, t string")
    rows = {r["k"]: r["o"] for r in T.clean_alignment_text(df, "t", "o", "ca", "k").collect()}
    assert rows == {1: "un gat|dos gossos", 2: ""}


def test_answer_scores(spark):
    r = metrics.answer_scores(spark.createDataFrame([("the cat sat", ["a cat", "dog"])], "p string, r array<string>"), "p", "r").first()
    assert r["exact"] == 0 and r["f1"] == pytest.approx(2 / 3)


def test_unit_times(spark):
    states = [1, 1, 3, 3, 4, 5, 7, 7, 9, 10, 11, 12, 13, 15, 17, 17, 19, 21, 23, 23]
    path = spark.createDataFrame([(1, t, s) for t, s in enumerate(states)], "k int, t int, s int")
    units = spark.createDataFrame([(1, 1, 5), (1, 7, 17), (1, 2, 2)], "k int, s_start int, s_end int")
    rows = {r["s_start"]: (r["t_start"], r["t_end"]) for r in align.unit_times(path, units, ["k"], 0.04).collect()}
    assert rows[1] == (0, pytest.approx(6 * 0.04)) and rows[7] == (pytest.approx(6 * 0.04), pytest.approx(16 * 0.04)) and rows[2] == (-1, -1)


def test_viterbi():
    blank, frames = 0, 6
    lp = np.full((frames, 3), -10.0)
    for t, k in enumerate([0, 1, 1, 0, 2, 0]):
        lp[t, k] = -0.01
    assert align.viterbi(lp, align.with_blanks([1, 2], blank), blank) == [0, 1, 1, 2, 3, 4]
    assert align.viterbi(lp[:2], align.with_blanks([1, 1], blank), blank) is None


def test_buffers_and_silence(spark):
    assert align.merge_overlap(list("abcde"), list("cdefg"), 4) == list("abcdefg")
    u = spark.createDataFrame([(1, "a", 0.5, 1.0), (1, "b", 1.05, 2.0), (1, "c", 3.0, 4.0)], "k int, text string, s double, e double").withColumn("total", F.lit(5.0))
    rows = align.insert_silences(u, ["k"], "text", "s", "e", "total").orderBy("s").collect()
    assert [(r["text"], r["s"], r["e"]) for r in rows] == [("", 0, 0.5), ("a", 0.5, 1.05), ("b", 1.05, 2), ("", 2, 3), ("c", 3, 4), ("", 4, 5)]


def test_punctuated(spark):
    rows = [(1, "hel", 0, 3, "C"), (1, "lo", 3, 5, "x"), (1, "world", 6, 11, "P")]
    df = spark.createDataFrame(rows, "k int, tok string, s int, e int, l string")
    assert align.punctuated(df, ["k"], "tok", "s", "e", "l", {"C": (",", "upper"), "P": (".", "same")}).first()["text"] == "Hello, world."


def test_curation(spark):
    assert curation.longest_first_buckets([("a", 5), ("b", 4), ("c", 3)], 2) == [("a", 5, 0), ("b", 4, 1), ("c", 3, 1)]
    assert [k for _, k, _ in curation.blend([0.5, 0.25, 0.25], 8)].count(0) == 4
    df = spark.createDataFrame([(1, "xab"), (2, "yab"), (3, "ab")], "i int, t string")
    assert curation.common_suffix(df, "t").first()["suffix"] == "ab"
    r = curation.ranked(spark.range(100).withColumn("v", (F.col("id") * 37) % 100), F.col("v"), "id").orderBy("rn").collect()
    assert [x["rn"] for x in r] == list(range(1, 101)) and [x["v"] for x in r] == list(range(100))


def test_filter_language(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "name string, v double")
    assert df.where(filters.parse_filter('name != "a" && v >= 1.5')).count() == 1 and df.where(filters.parse_filter("name contains a")).count() == 1
    with pytest.raises(ValueError):
        filters.parse_filter("name a")


def test_tabular(spark):
    assert col(spark, 257, lambda x: tabular.int_digits(x, 0, 16, 3), "long") == [1, 0, 1]
    assert col(spark, 257, lambda x: tabular.int_from_digits(tabular.int_digits(x, 0, 16, 3), 0, 16), "long") == 257
    assert col(spark, "abz!", lambda x: tabular.char_ids(x, "abz")) == [0, 1, 2]


def test_diarization(spark):
    rows = [(1, "ref", "A", 0.0, 10.0), (1, "ref", "B", 10.0, 20.0), (1, "hyp", "x", 0.0, 12.0), (1, "hyp", "y", 12.0, 20.0)]
    r = metrics.diarization_error(spark.createDataFrame(rows, "session int, side string, speaker string, s double, e double"), "session").first()
    assert r["total"] == 20 and r["confusion"] == pytest.approx(2) and r["der"] == pytest.approx(0.1)
    t = [(1, 0, "A", "a b", None), (1, 1, "B", "c d", None), (1, 0, "1", None, "c d"), (1, 1, "2", None, "a x")]
    assert metrics.cp_wer(spark.createDataFrame(t, "session int, ord int, speaker string, ref string, hyp string"), "session", "speaker", "ref", "hyp").first()["cpwer"] == 0.25


def test_assignment_agrees():
    rng = np.random.default_rng(0)
    import itertools

    c = rng.integers(0, 20, (5, 5)).tolist()
    assert metrics.least_assignment(c) == min(sum(c[i][p[i]] for i in range(5)) for p in itertools.permutations(range(5)))


def test_vad(spark):
    p = [0.1, 0.9, 0.6, 0.5, 0.2, 0.1, 0.8]
    df = spark.createDataFrame([(1, i, x) for i, x in enumerate(p)], "k int, f int, p double")
    assert [r["state"] for r in vad.hysteresis(df, ["k"], ["f"], F.col("p"), 0.7, 0.3).orderBy("f").collect()] == [0, 1, 1, 1, 0, 0, 1]
    assert got(vad.binarize(df, ["k"], "f", F.col("p"), 1.0, 0.7, 0.3)) == [(1, 4), (6, 7)]
    assert [r["label"] for r in vad.resample_labels(df.select("k", "f", (F.col("p") > 0.5).cast("int").alias("l")), ["k"], "f", "l", 2).orderBy("frame").collect()] == [1, 1, 0, 1]


def test_stats_and_lookup(spark):
    df = spark.createDataFrame([("a b a",), ("b c",)], "t string")
    assert {r["word"]: r["n"] for r in stats.vocabulary(df, "t").collect()} == {"a": 2, "b": 2, "c": 1}
    acc = {r["word"]: r["accuracy"] for r in stats.word_accuracy(spark.createDataFrame([("a b c", "a x c")], "r string, h string"), "r", "h").collect()}
    assert acc == {"a": 1.0, "b": 0.0, "c": 1.0}
    hits = spark.createDataFrame([(1, p) for p in (1, 2, 3, 50, 51)], "k int, p int")
    assert tuple(lookup.best_window(hits, ["k"], "p", 4).first()) == (1, 1, 3)
    assert metrics.rouge is not None
    r = spark.createDataFrame([("the cat", ["the cat sat", "dog"])], "p string, r array<string>").select(metrics.rouge("p", "r").alias("x")).first()["x"]
    assert r["rouge1"] == pytest.approx(0.8) and r["rougeL"] == pytest.approx(0.8)


def test_english_and_phrases(spark):
    from loquarium.functions import english, phrases

    assert english.clean("Dr. Smith paid $3.50 at 10:05 on the 21st, 1,200 times & 2.5") == "doctor smith paid three dollars fifty cents at ten oh five on the twenty-first one thousand two hundred times and two point five"
    assert [english.ordinal(n) for n in (1, 12, 20, 105)] == ["first", "twelfth", "twentieth", "one hundred fifth"]
    df = spark.createDataFrame([("aa bb cc", [(0, 2, "x", 0.9), (1, 4, "y", 0.6), (6, 8, "zz", 0.7), (3, 5, "q", 0.1)])], "t string, r array<struct<begin:int,end:int,text:string,weight:double>>")
    assert df.select(phrases.substitute("t", "r").alias("y")).first()["y"] == "x bb zz"
    cost, pairs = phrases.align(list("abc"), list("axc"), {("b", "x"): 1.0})
    assert cost == 1.0 and pairs == [("a", "a"), ("b", "x"), ("c", "c")]


def test_transcript_pipeline_takes_every_sentence(spark, tmp_path):
    from loquarium.plans import sessions

    texts = [". ".join(f"frase {i} del texto numero {k} con palabras de sobra para durar" for i in range(n)) for k, n in enumerate((3, 5, 6, 40))]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert sum(r["count"] for r in sessions.transcript_pipeline(spark, str(tmp_path)).collect()) == 54


def test_answers_and_cp_wer_take_whole_turns(spark, tmp_path):
    from loquarium.plans import scoring, sessions

    long = " ".join(f"palabra{i}" for i in range(40))
    turns = [(1, 0, "user", long + " uno"), (1, 1, "assistant", long + " dos"), (1, 2, "user", "x"), (1, 3, "assistant", long + " tres")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    spark.createDataFrame([(0, "otra"), (5, long + " tres")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r["turn"]: (r["exact"], r["f1"]) for r in scoring.qa_f1_em(spark, str(tmp_path)).collect()}
    assert got == {1: (0, pytest.approx(40 / 41)), 3: (0, 0.0)}
    best = scoring.metric_max_over_refs(spark, str(tmp_path)).first()
    assert (best["n"], best["exact"], best["f1"]) == (2, 1, pytest.approx((40 / 41 + 1) * 50, abs=1e-5))
    assert sessions.cp_wer(spark, str(tmp_path)).first()["words"] == 41 * 3 + 1


def test_stitch_buffers_takes_whole_texts(spark, tmp_path):
    from loquarium.plans import sessions

    rows = [(k, "en", " ".join("w" + chr(97 + i // 26) + chr(97 + i % 26) for i in range(n))) for k, n in ((1, 301), (2, 16), (3, 1))]
    spark.createDataFrame(rows, "doc_id long, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r["doc_id"]: r["n"] for r in sessions.stitch_buffers(spark, str(tmp_path)).collect()} == {1: 301, 2: 16}


def test_distances_of_many_pairs():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    rng = np.random.default_rng(3)
    make = lambda: "".join(rng.choice(list("abé😀 "), rng.integers(0, 14)))
    a, b = ([make() for _ in range(400)] for _ in range(2))
    assert edit.distances(a, b).tolist() == [plain(x, y) for x, y in zip(a, b)]
    assert edit.distances([], []).tolist() == []


def test_operation_counts():
    assert edit.operations("a b c d".split(), "a x c e d".split()) == (3, 1, 1, 0)
    assert edit.operations([], ["a"]) == (0, 0, 1, 0) and edit.operations(["a", "b"], []) == (0, 0, 0, 2) and edit.operations(["a"], ["a"]) == (1, 0, 0, 0)
