"""Operators of the llm subpackage against brute force, and their edge cases."""

import hashlib
import re
import zlib
from collections import defaultdict
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from loquarium.llm import jaccard_join as jj  # noqa: E402
from loquarium.llm import language_id, line_dedup, packing, sentence_spans, shingles, token_counts, token_store, tokens, vector_join, warc  # noqa: E402
from loquarium.llm.common import connected_components, shared_dir  # noqa: E402
from loquarium.llm.decontaminate import decontaminate  # noqa: E402

DOC = "doc_id long, text string, extra string"
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def docs(spark, texts, start=0):
    return spark.createDataFrame([(i + start, t, "x") for i, t in enumerate(texts)], DOC)


@pytest.fixture(scope="module")
def word():
    rng = np.random.default_rng(11)
    names = ["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(2, 7))) for _ in range(400)]
    return lambda n: [names[i] for i in rng.integers(0, len(names), n)]


# --- decontamination


def brute_decontaminate(texts, items):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    windows = defaultdict(set)
    for key, t in items:
        w = cut(t)
        for i in range(max(1, len(w) - 7) if w else 0):
            windows[tuple(w[i : i + 8])].add(str(key))
    out = []
    for t in texts:
        w, hit, found = cut(t), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i : i + n])) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[k]
        out.append((len(w), len(hit), sorted(found)))
    return out


def test_decontamination(spark, word):
    a, b, c = word(20), word(9), word(3)
    items = [(10, " ".join(a)), (2, " ".join(b)), (7, " ".join(c)), (8, None), (9, ""), (3, " ".join(b)), (11, "the the the the the the the the the the")]
    texts = [" ".join(word(30) + a[4:15] + word(5)), " ".join(word(5) + a[:7] + word(9)), "X, ".join(b).upper(), " ".join(c), " ".join(c + b + c), None, "", "!!", " ".join(["The"] * 30), " ".join(word(4000) + a + b), " ".join(a + b) + "."]
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], list(r["items"])) for r in decontaminate(docs(spark, texts), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = brute_decontaminate(texts, items)
    assert [got[i] for i in range(len(texts))] == want


def test_decontamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[:4] for r in decontaminate(docs(spark, ["a b"]), none).collect()] == [(0, 2, 0, 0)]
    assert decontaminate(docs(spark, []), none).count() == 0


def test_decontamination_is_native(spark):
    plan = decontaminate(docs(spark, ["a"]), spark.createDataFrame([(1, "a b")], "item_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


# --- WARC


def test_warc(spark):
    big, small = "é" * 60, "x" * 50
    rows = [(3, "http://a b", big), (1, "u", big), (2, None, big), (4, "u", small), (5, "u", small), (6, "u", None), (7, "u", "WARC/1.1\r\n\r\n" * 20), (8, "u", "y" * 400_000), (9, "u", "y" * 400_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    got = {r["page_id"]: r for r in warc.warc_round_trip(spark, pages).collect()}
    assert len(got) == len(rows)
    for key, _, html in rows:
        raw = (html or "").encode()
        assert got[key]["payload_bytes"] == len(raw) and got[key]["payload_digest"] == hashlib.sha256(raw).hexdigest()
    assert {k: r["refers_to"] for k, r in got.items() if r["record_type"] == "revisit"} == {2: 1, 3: 1, 9: 8}
    assert warc.warc_round_trip(spark, pages.limit(0)).count() == 0


def test_warc_random_access(tmp_path):
    w = warc.BundleWriter(f"{tmp_path}/x.warc.zst")
    for i in range(300):
        w.add(i, warc.record(i, f"http://x/{i}", "h" * (i * 20), hashlib.sha256(b"h" * (i * 20)).hexdigest(), i * 20, None))
    places = w.close()
    table = warc.seek_table(w.path)
    assert len(table) > 1 and {p[3] for p in places} == {t[0] for t in table}
    for key, path, _, at, packed, offset, size in places[::37]:
        headers, block = warc.read_record(path, at, packed, offset, size)
        assert headers["WARC-Record-ID"] == f"<urn:page:{key}>" and block.partition(b"\r\n\r\n")[2] == b"h" * (key * 20)
    import zstandard

    with open(w.path, "rb") as f:  # any zstandard reader reads the frames and skips the table
        assert zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read(9)[:8] == b"WARC/1.1"


# --- language


def test_language(spark):
    rng = np.random.default_rng(2)
    syll = {"aa": ["ka", "lo", "mi"], "bb": ["zu", "pre", "on"]}
    make = lambda k, n: " ".join("".join(rng.choice(syll[k], 3)) for _ in range(n))
    rows = [(i, make(k, 80), k) for i, k in enumerate(["aa", "bb"] * 60)] + [(500, None, "aa"), (501, "123 !!", "bb"), (502, make("aa", 5), None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    model = language_id.train(language_id.teaching(d))
    assert model.languages == ["aa", "bb"]
    out = {r["doc_id"]: r for r in language_id.identify(d.withColumn("held", language_id.held_out()), model).collect()}
    assert all(out[i]["lang_pred"] == k for i, _, k in rows[:120]) and out[502]["lang_pred"] == "aa"
    assert out[500]["lang_pred"] == out[501]["lang_pred"] == "und" and out[500]["rejected"] and out[501]["score"] == 0.0
    assert all(0 <= r["score"] <= 1 for r in out.values()) and not any(out[i]["rejected"] for i in range(120))
    assert all(r["held"] == (zlib.crc32(str(k).encode()) % 3 == 1) for k, r in out.items())
    odd = model.predict(["ж" * 300, "qwx" * 200])
    assert odd["rejected"].all()
    assert language_id.identify(d.limit(0), model).count() == 0
    empty = language_id.train(d.limit(0))
    assert empty.predict(["abc"])["lang_pred"].tolist() == ["und"]


def plain_kneser_ney(texts, order):
    """Interpolated Kneser-Ney over strings with dictionaries: a function of a context and a character, and the characters seen."""
    pad = " " * (order - 1)
    counts = {order: defaultdict(int)}
    for t in texts:
        t = pad + t
        for i in range(len(t) - order + 1):
            counts[order][t[i : i + order]] += 1
    for n in range(order - 1, 0, -1):  # in how many contexts
        counts[n] = defaultdict(int)
        for gram in counts[n + 1]:
            counts[n][gram[1:]] += 1

    def cut(n):
        once, twice = (sum(v == k for v in counts[n].values()) for k in (1, 2))
        return min(max(once / max(once + 2 * twice, 1) if once else 0.5, 0.1), 0.95)

    def p(gram):
        n = len(gram)
        own = {g: v for g, v in counts[n].items() if g[:-1] == gram[:-1]}
        below = 1 / (len(counts[1]) + 1) if n == 1 else p(gram[1:])
        if not own:
            return below
        return (max(own.get(gram, 0) - cut(n), 0) + cut(n) * len(own) * below) / sum(own.values())

    return p, sorted(counts[1])


def test_kneser_ney_against_dictionaries():
    texts = ["abracadabra banana bandana", "cabana abba cad", "barn dance"]
    counts = defaultdict(int)
    for own, code, _ in language_id.codes(texts):
        for c in code:
            counts[int(c)] += 1
    keys = np.array(list(counts), np.uint64)
    m = language_id.KneserNey(["x"], keys, np.zeros(len(keys), int), np.array(list(counts.values()), float))
    p, letters = plain_kneser_ney(texts, language_id.ORDER)
    grams = ["".join(x) for x in np.random.default_rng(3).choice([*letters, "q"], (300, language_id.ORDER))] + ["bana", "anan", "   a", "ab q"]
    code = np.array([sum(ord(c) << 16 * (len(g) - 1 - i) for i, c in enumerate(g)) for g in grams], np.uint64)
    want = [p(g) for g in grams]
    assert np.allclose(np.exp(m.log_probabilities(code))[:, 0], want, rtol=1e-4)
    for context in ("ban", "aba", "zzz", "  a"):  # and one character not seen
        assert abs(sum(p(context + c) for c in [*letters, "q"]) - 1) < 1e-9


# --- tokens


@pytest.mark.parametrize("name, drops", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_chunk_encoder(name, drops):
    import random

    rng = random.Random(1)
    letters = "ab Éé ,.!'\n\t  ½²–—😀ǅİ́ﬁ9 12's'll\x1c\x85　ΑΣς"
    from tokenizers import Tokenizer

    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    texts += ["", None, "<|endoftext|> a", "x <|endoftext|> y", "x<|startoftext|>\ny <|EndOfText|>", "a <| b"]
    for specials in (True, False):
        e, t = tokens.ChunkEncoder(public_tokenizers.path(name), drops, specials), Tokenizer.from_file(public_tokenizers.path(name))
        t.encode_special_tokens = not specials  # the library's default, and special strings as ordinary text
        for x, raw in zip(texts, e.encode(texts)):
            assert np.frombuffer(raw, e.dtype).tolist() == (t.encode(x, add_special_tokens=False).ids if x else [])


@pytest.mark.parametrize("name, drops", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_chunks_at_line_breaks(name, drops):
    import random

    from tokenizers import Tokenizer

    rng = random.Random(2)
    bits = [" ab", " ab", "cd.", "\n", "\n", "\n\n", "\n\n\n", " \n", "\0", "'s", "’", "é", "!", " 12"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 12))) for _ in range(5000)]
    e, t = tokens.ChunkEncoder(public_tokenizers.path(name), drops), Tokenizer.from_file(public_tokenizers.path(name))
    e.most_chunks = e.most_pieces = 3  # emptied within texts
    for x, raw in zip(texts, e.encode(texts)):
        assert np.frombuffer(raw, e.dtype).tolist() == t.encode(x, add_special_tokens=False).ids
    e = tokens.ChunkEncoder(public_tokenizers.path(name), drops)
    e.encode(["One two.\nThree two.\n\nFour two.\nFive two."])
    # No two words across a line break are an entry of their own, and a word is held once.
    words = {"one", "two.", "three", "four", "five", ""} if drops else {"One", " two.", "\n", "Three", "Four", "Five", " two", ".", ""}
    assert set(e.chunks) == words


class Counted:
    """A library's model that notes what it is asked for."""

    def __init__(self, model):
        self.model, self.asked = model, []

    def tokenize(self, piece):
        self.asked.append(piece)
        return self.model.tokenize(piece)


def test_words_are_encoded_once_without_white_space():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    e, t = tokens.ChunkEncoder(path, True), Tokenizer.from_file(path)
    e.encode(["One one. One, (two) two 'three'"])
    assert [*e.chunks, *e.pieces].count("one") == 1  # as a chunk, not as a piece besides
    # Words that come back in every text are the model's once, however often the caches fill between.
    e = tokens.ChunkEncoder(path, True)
    e.most_chunks, e.most_pieces = 40, 10
    e.model = Counted(e.model)
    rare = ["".join(chr(97 + int(d)) for d in str(10_000 + k)) for k in range(600)]
    texts = [f"Common words. {' '.join(rare[k : k + 10])}, common again" for k in range(0, 600, 10)]
    for x, raw in zip(texts, e.encode(texts)):
        assert np.frombuffer(raw, e.dtype).tolist() == t.encode(x, add_special_tokens=False).ids
    assert all(e.model.asked.count(x) == 1 for x in ("common", "again", *rare))
    assert len(e.chunks) <= 40 and len(e.older) <= 40 and len(e.pieces) <= 10


def test_vocabulary_stays_with_the_worker():
    path = public_tokenizers.path("word_bpe_49k.json")
    e = tokens.encoder(path, True)
    want = e.encode(["One two. Two"])
    tokens.forget()
    assert tokens.encoder(path, True) is e and not (e.chunks or e.older or e.pieces) and e.encode(["One two. Two"]) == want


TEXTS = ["Hello there, world.", None, "", "Hello there, world.", "a\n\nb  c\td", "é" * 3000, "word " * 9000, "x <|endoftext|> y"]


def expected(name, end, specials=True):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = not specials
    return [np.array(t.encode(x or "", add_special_tokens=False).ids + [end], "<u4") for x in TEXTS]


def test_token_store(spark, tmp_path):
    want = expected("byte_bpe_50k.json", 2)
    d = docs(spark, TEXTS, 5).unionByName(spark.createDataFrame([(None, "no id", "x")], DOC))
    manifest = token_store.write_store(d, f"file://{tmp_path}/s", public_tokenizers.path("byte_bpe_50k.json"), False, 2)
    rows = sorted(token_store.read_store(manifest).collect(), key=lambda r: r["start"])
    assert rows[0]["doc_id"] is None
    at = rows[0]["n_tokens"]
    for r, w in zip(rows[1:], want):
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(w), zlib.crc32(w.tobytes()))
        at += len(w)
    found = [s.find(9) for s in map(token_store.Shard, [m["path"] for m in manifest.collect()])]
    assert [x.tolist() for x in found if x is not None] == [want[4].tolist()]
    assert token_store.token_store(spark, d.limit(0), public_tokenizers.path("byte_bpe_50k.json"), False, 2).count() == 0


def test_token_counts(spark, tmp_path):
    want = {i: len(w) - 1 for i, w in enumerate(expected("byte_bpe_50k.json", 50256, specials=False))}
    got = token_counts.token_counts(spark, docs(spark, TEXTS), public_tokenizers.path("byte_bpe_50k.json"), False, 50256).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == want
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"] + 1


@pytest.mark.parametrize("block", [2, 6, 64])
def test_separator_scan_over_blocks(spark, tmp_path, block):
    ids = [[9, 7, 9, 9, 1, 2, 3, 9, 5, 5], [9], [], [4, 4]]
    rows = []
    for k, x in enumerate(ids):
        (tmp_path / f"{k}.ids").write_bytes(np.array(x, "<u2").tobytes())
        rows.append((k, f"file://{tmp_path}/{k}.ids", len(x) * 2, 2))
    got = sorted(tuple(r) for r in token_counts.scan(spark.createDataFrame(rows, token_counts.FILES), 9, block).collect())
    assert got == [(0, 0, 0, 0, True), (0, 1, 1, 1, True), (0, 2, 3, 0, True), (0, 3, 4, 3, True), (0, 4, 8, 2, False), (1, 0, 10, 0, True), (3, 0, 11, 2, False)]


# --- packing


def test_packing(spark):
    want = expected("word_bpe_49k.json", 1)
    d = docs(spark, TEXTS)
    rows = packing.best_fit_packing(d, public_tokenizers.path("word_bpe_49k.json"), True, 1, capacity=4096).collect()
    bins = defaultdict(list)
    for r in rows:
        piece = want[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["start"] == 4096 * r["piece"] and r["length"] == len(piece) and r["ids_crc32"] == zlib.crc32(piece.tobytes())
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sum(r["length"] for r in rows) == sum(map(len, want))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 4096
    assert packing.best_fit_packing(d.limit(0), public_tokenizers.path("word_bpe_49k.json"), True, 1).count() == 0


def best_fit_decreasing(sizes, capacity):
    gaps = []  # one piece after another
    for x in sorted(sizes, reverse=True):
        fit = [g for g in gaps if g >= x]
        if fit:
            gaps.remove(min(fit))
        gaps.append((min(fit) if fit else capacity) - x)
    return len(gaps)


def test_brackets_are_a_sweep_with_a_stack():
    rng = np.random.default_rng(5)
    for n in [0, 1, 2, *range(3, 60)]:
        is_slot = rng.random(n) < 0.5
        stack, want = [], []
        for i, x in enumerate(is_slot):
            if not x:
                stack.append(i)
            elif stack:
                want.append((i, stack.pop()))
        assert sorted(zip(*map(np.ndarray.tolist, packing.brackets(is_slot)))) == want


def test_carried_ranks_are_the_whole_sweep():
    rng = np.random.default_rng(6)
    for _ in range(40):
        is_slot = rng.random(60) < 0.5
        whole = set(zip(*map(np.ndarray.tolist, packing.brackets(is_slot))))
        cuts = [0, *np.sort(rng.integers(0, 61, 4)).tolist(), 60]
        counts, slots, pieces, got = [], {}, {}, set()
        for part, (a, b) in enumerate(zip(cuts, cuts[1:])):
            at, piece = packing.brackets(is_slot[a:b])
            got |= {(int(x) + a, int(y) + a) for x, y in zip(at, piece)}
            free = [i + a for i in range(b - a) if is_slot[a + i] and i not in at]
            over = [i + a for i in range(b - a) if not is_slot[a + i] and i not in piece][::-1]
            counts.append((part, len(free), len(over)))
            slots |= {(part, k): i for k, i in enumerate(free)}
            pieces |= {(part, k): i for k, i in enumerate(over)}
        by_match = [{}, {}]
        for side, (runs, names) in enumerate(zip(packing.carried(counts), (slots, pieces))):
            assert len(runs) <= 2 * len(counts)
            for part, rank, n, match in runs.tolist():
                by_match[side] |= {match + k: names[part, rank + k] for k in range(n)}
        assert by_match[0].keys() == by_match[1].keys()
        assert got | {(by_match[0][m], by_match[1][m]) for m in by_match[0]} == whole


@pytest.mark.parametrize("kind", ["mixed", "hot", "halves"])
def test_packing_rounds(spark, kind):
    rng = np.random.default_rng(4)
    sizes = {"mixed": rng.integers(1, 101, 300), "hot": np.where(rng.random(300) < 0.4, 30, rng.integers(1, 60, 300)), "halves": np.full(61, 51)}[kind]
    rows = [(k, None if k % 50 == 0 else k // 3, 0, 0, int(n), 7) for k, n in enumerate(sizes)]
    found = spark.createDataFrame(rows, "pid long, doc_id long, piece int, start long, length long, ids_crc32 long")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # several ranges, however few rows
    try:
        out = packing.pack(found, 100).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sorted(r["length"] for r in out) == sorted(sizes.tolist())
    bins = defaultdict(list)
    for r in out:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 100
    assert len(bins) <= 1.03 * best_fit_decreasing(sizes.tolist(), 100) + 1


# --- sentences and lines


def plain_sentences(text):
    """Places of sentences by a scan of characters; no sentence here is longer than a cut."""
    out, first = [], 0
    for i, c in enumerate(text):
        if c == "\n" or c.isspace() and i and text[i - 1] in ".!?":
            out.append((first, i))
            first = i + 1
    out.append((first, len(text)))
    return [(a, b) for a, b in out if text[a:b].strip()]


def brute_spans(texts):
    """Every run of two sentences or more and 25 words or more, whatever its length."""
    first, drop = {}, defaultdict(set)
    for k, t in enumerate(texts):
        parts = [t[a:b].split() for a, b in plain_sentences(t or "")]
        for i in range(len(parts)):
            for j in range(i + 2, len(parts) + 1):
                if sum(map(len, parts[i:j])) >= 25:
                    key = tuple(tuple(x) for x in parts[i:j])
                    if first.setdefault(key, (k, i)) != (k, i):
                        drop[k] |= set(range(i, j))
    return drop


def test_substring_dedup(spark, word):
    line = lambda n: " ".join(word(n)).capitalize() + "."
    passage = " ".join(line(12) for _ in range(5))
    long_one = " ".join(word(60))  # without sentence ends: cut where its words say
    own = [" ".join(line(11) for _ in range(3)) for _ in range(8)]
    texts = [own[0] + " " + passage + " " + own[1], own[2] + "\n" + passage + "\n" + own[3], passage, " ".join(word(7)) + " " + long_one, " ".join(word(12)) + " " + long_one + " " + own[6], None, "", "Short. One.", "Short. One.", own[7]]
    got = {r["doc_id"]: r for r in sentence_spans.substring_dedup(docs(spark, texts)).collect()}
    drop = brute_spans([t if k not in (3, 4) else None for k, t in enumerate(texts)])
    assert {k: r["n_removed"] for k, r in got.items() if r["n_removed"] and k != 4} == {k: len(v) for k, v in drop.items()}
    assert got[0]["text"] == texts[0] and passage not in got[1]["text"] and own[2] in got[1]["text"] and own[3] in got[1]["text"]
    assert got[2]["text"] == "" and long_one in got[3]["text"] and len(set(long_one.split()) & set(got[4]["text"].split())) < 45 and own[6] in got[4]["text"]
    assert got[5]["text"] is None and got[6]["text"] == "" and got[8]["text"] == "Short. One." and got[9]["text"] == texts[9]
    assert sentence_spans.substring_dedup(docs(spark, [])).count() == 0


def plain_repeats(texts):
    """By text: the lines of any two neighbouring lines, blank ones between them apart, that stand the same way before."""
    first, out = {}, defaultdict(set)
    for k, t in enumerate(texts):
        lines = (t or "").split("\n")
        i = None
        for j, x in enumerate(lines):
            if not x.strip():
                continue
            if i is not None and first.setdefault("\n".join(lines[i : j + 1]), (k, i)) != (k, i):
                out[k] |= set(range(i, j + 1))
            i = j
    return out


def test_line_dedup(spark, word):
    line = lambda: " ".join(word(12))
    block = [line() for _ in range(14)]
    texts = ["\n".join([line() for _ in range(3)] + block + [line()]), "\n".join([line()] + block + [line() for _ in range(4)]), None, "", "one line", "\n".join(block), "\n".join(block), "\n\n\n\n\n\n"]
    got = {r["doc_id"]: r for r in line_dedup.line_dedup(docs(spark, texts)).collect()}
    want = plain_repeats(texts)
    assert want[1] and len(want[6]) >= len(block) - 2
    assert {k: r["lines_removed"] for k, r in got.items() if r["lines_removed"]} == {k: len(v) for k, v in want.items()}
    for k, t in enumerate(texts):
        assert got[k]["text"] == (t if k not in want else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in want[k])) and got[k]["extra"] == "x"
    assert line_dedup.line_dedup(docs(spark, [])).count() == 0


def test_line_dedup_of_short_passages(spark, word):
    line = lambda n=12: " ".join(word(n))
    passages = [[line() for _ in range(n)] for n in (2, 2, 2, 3, 3, 4, 5, 8)] + [["Ab.", "Cd."], [line(), "", " ", line()]]
    lone = line()
    texts = ["\n".join([line()] + p + [lone, line()]) for p in passages] + ["\n".join([line()] + p + [lone, line(), ""]) for p in passages] + ["\n".join([line(), "", line(), ""]) for _ in range(3)]
    got = {r["doc_id"]: r for r in line_dedup.line_dedup(docs(spark, texts)).collect()}
    k = len(passages)
    for i, t in enumerate(texts):
        lines = t.split("\n")  # the line after a passage goes too, as both stand in the first text
        gone = len(passages[i - k]) + 1 if k <= i < 2 * k else 0
        assert got[i]["lines_removed"] == gone and got[i]["text"] == "\n".join(lines[:1] + lines[1 + gone :] if gone else lines)


# --- Jaccard


def brute_components(texts, n=5):
    sets = {}
    for k, t in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets[k] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in sets}


@pytest.mark.parametrize("all_pairs", [1, 8])
def test_jaccard_join(spark, word, monkeypatch, all_pairs):
    monkeypatch.setattr(jj, "ALL_PAIRS", all_pairs)
    rng = np.random.default_rng(8)
    texts = [None, "", "a", "A", "a b", "a b c d e", "a b  c\td e", " ".join(word(6000))]
    for n in (6, 9, 14, 25, 60, 200):
        base = word(n)
        for _ in range(12):
            t = list(base)
            for _ in range(int(rng.integers(0, 3))):
                t[int(rng.integers(0, n))] = word(1)[0]
            texts.append(" ".join(t + word(int(rng.integers(0, 2)))))
    shared = word(60)
    texts += [" ".join(word(40) + shared + word(40)) for _ in range(25)]
    members, links = jj.jaccard_join(docs(spark, texts))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in members.collect()}
    assert got == brute_components(texts)
    assert jj.jaccard_join(docs(spark, []))[0].count() == 0


@pytest.mark.parametrize("blank", [3, 12])
def test_jaccard_join_links_no_wordless_texts(spark, word, blank):
    base = " ".join(word(30))
    texts = ["", " ", "\n\t "] * blank + [None, None, base, base + " ", base + " more"]
    members, links = jj.jaccard_join(docs(spark, texts))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in members.collect()}
    k = 3 * blank + 2
    assert got == {i: (0, i) for i in range(k)} | {k: (26, k), k + 1: (26, k), k + 2: (27, k)}
    assert links.count() == 1
    twice = docs(spark, ["", base]).unionAll(docs(spark, ["", " ".join(word(30))])).withColumn("doc_id", F.when(F.col("text") == base, 0).otherwise(F.col("doc_id")))
    assert all(r["component_id"] == r["doc_id"] for r in jj.jaccard_join(twice)[0].collect())


def test_signatures_miss_no_similar_sets():
    rng = np.random.default_rng(1)
    bands = jj.Bands(80)
    for n in [*range(1, 40), 77, 150, 800]:
        for _ in range(15):
            a = rng.integers(0, 1 << 62, n).astype(np.uint64)
            most = int(n * 0.2 / 1.8 * 2)
            drop = int(rng.integers(0, most + 1)) if most else 0
            b = np.unique(np.concatenate((a[drop:], rng.integers(0, 1 << 62, max(0, most - drop)).astype(np.uint64))))
            a = np.unique(a)
            if 100 * len(np.intersect1d(a, b)) < 80 * len(np.union1d(a, b)):
                continue
            owner, sig = jj.sign([a, b], bands)
            assert set(sig[owner == 0]) & set(sig[owner == 1]), n


def test_sketch_bounds_difference():
    rng = np.random.default_rng(2)
    for n in (1, 5, 100, 900):
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        b = np.unique(np.concatenate((a[n // 3 :], rng.integers(0, 1 << 62, n // 2).astype(np.uint64))))
        x, y = jj.sketch(a), jj.sketch(b)
        w = min(len(x), len(y))
        assert np.bitwise_count(jj.fold(x, w) ^ jj.fold(y, w)).sum() <= len(np.setxor1d(a, b))


def test_shingles_do_not_depend_on_neighbours():
    texts = ["A b C d e f", "x", "", None, "a\x0bb c d e f", "é b c d e"]
    together = list(shingles.shingle_sets(texts))
    assert all((a == next(shingles.shingle_sets([t]))).all() for a, t in zip(together, texts))
    assert (together[0] == together[4]).all() and len(together[0]) == 2 and len(together[1]) == 1 and len(together[2]) == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (5, 5), (None, 3), (200, 100)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b", "test").collect()))
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 200: 100}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b", "test").count() == 0


# --- vectors


def brute_vectors(vectors, t=0.9):
    ok = {k: np.array(v, float) for k, v in vectors if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    links = {k: [j for j in ok if j != k and len(ok[j]) == len(ok[k]) and ok[k] @ ok[j] / np.linalg.norm(ok[k]) / np.linalg.norm(ok[j]) >= t] if k in ok else [] for k, _ in vectors}
    out = {}
    for k, _ in vectors:
        seen, todo = {k}, [k]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[k] = (len(links[k]), min(seen), min(seen) == k)
    return out


@pytest.mark.parametrize("chunk", [16, 16_384])
def test_vector_join(spark, monkeypatch, chunk):
    monkeypatch.setattr(vector_join, "CHUNK", chunk)
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=24).tolist()) for i in range(60)]
    for k in range(8):
        base = np.array(rows[k][1])
        rows += [(100 + 10 * k + j, (base * rng.uniform(0.5, 3) + rng.normal(size=24) * 0.45 * np.linalg.norm(base) / 5).tolist()) for j in range(7)]
    rows += [(300, rows[3][1]), (301, rows[3][1]), (302, None), (303, [0.0] * 24), (304, [float("nan")] + [1.0] * 23), (305, [1.0, None]), (306, []), (307, [1.0, 2.0]), (308, [2.0, 4.0]), (309, [float("inf")] * 24)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("label", F.lit(1))
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vector_join.vector_join(df).collect()}
    assert got == brute_vectors(rows)
    assert vector_join.vector_join(df.limit(0)).count() == 0


def test_vector_join_disk(spark, monkeypatch):
    """What is shuffled and what lies in the shared folder follow the input, also where every chunk meets every other."""
    monkeypatch.setattr(vector_join, "CHUNK", 128)
    rng = np.random.default_rng(8)
    v = rng.normal(size=(4000, 64)).astype("f4")
    v[3000:] = v[:1000] + rng.normal(size=(1000, 64)).astype("f4") * 0.1
    df = spark.createDataFrame(list(enumerate(v.tolist())), "vec_id long, embedding array<float>")
    bus, store = spark.sparkContext._jsc.sc().listenerBus(), spark.sparkContext._jsc.sc().statusStore()

    def shuffled() -> int:
        bus.waitUntilEmpty()
        return store.executorSummary("driver").totalShuffleWrite()

    folder = Path(urlparse(shared_dir(spark)).path)
    lying = lambda: sum(p.stat().st_size for p in folder.rglob("*") if p.is_file())
    before = shuffled(), lying()
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vector_join.vector_join(df).collect()}
    after = shuffled(), lying()
    assert after[0] - before[0] + after[1] - before[1] < 4 * v.nbytes, (before, after, v.nbytes)
    unit = v.astype("f8") / np.linalg.norm(v.astype("f8"), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    assert {k: x[0] for k, x in got.items()} == dict(enumerate((near.sum(axis=1) - 1).tolist()))
    assert all(x[1] == min(k, *np.flatnonzero(near[k]).tolist()) for k, x in got.items())  # no chains here


@pytest.mark.parametrize("dense", [0.0, 2.0])
def test_vector_join_slabs(spark, monkeypatch, dense):
    """Slabs that are compared at once, and pair by pair, over several leaves, chunks and copies; squares that overflow or vanish."""
    monkeypatch.setattr(vector_join, "DENSE", dense)
    for k, x in {"CHUNK": 32, "ROWS": 8, "COLUMNS": 16, "PAIRS": 50, "RUN": 4096, "SAMPLE": 64}.items():
        monkeypatch.setattr(vector_join, k, x)
    rng = np.random.default_rng(9)
    hot = rng.normal(size=16)
    v = np.concatenate([rng.normal(size=(120, 16)), hot + rng.normal(size=(120, 16)) * 0.25, np.cumsum(rng.normal(size=(60, 16)) * 0.3, axis=0) + 2])
    v = np.concatenate([v, v[100:160], v[130:140] * 2.0**600, v[5:9] * 2.0**-700])
    order = rng.permutation(len(v))
    rows = list(zip(range(len(v)), v[order].tolist()))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vector_join.vector_join(df).collect()}
    scaled = [(k, (np.array(x) / np.abs(x).max()).tolist()) for k, x in rows]
    assert got == brute_vectors(scaled)
