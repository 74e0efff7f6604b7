"""The pipeline against a plain version of each stage, on documents with planted cases."""

import importlib.util
import sys
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
sys.path.insert(0, str(Path(__file__).parents[2]))

import corpus_pipeline  # noqa: E402
from loquarium.llm import language_id  # noqa: E402

spec = importlib.util.spec_from_file_location("ops_tests", Path(__file__).parent / "test_ops.py")
ops = importlib.util.module_from_spec(spec)
spec.loader.exec_module(ops)


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = np.random.default_rng(9)
    syllables = ["ka", "lo", "mi", "re", "tu", "san", "per", "ol", "gi", "ne"]
    word = lambda: "".join(rng.choice(syllables, rng.integers(1, 4)))
    sentence = lambda n=12: " ".join(word() for _ in range(n)).capitalize() + "."
    body = lambda n=8: "\n".join(sentence() for _ in range(n))
    items = [sentence(15) for _ in range(6)]
    texts = [body() for _ in range(60)]
    texts += [texts[3], texts[4].replace("\n", " "), " ".join(texts[5].replace("\n", " ").split()[:-1] + ["changed."]), None, "", "123 456", "ж" * 400]
    block = body(10)
    texts += [body(2) + "\n" + block + "\n" + body(1), body(1) + "\n" + block + "\n" + body(3)]
    texts += [sentence() + " " + items[0] + " " + sentence() + " " + items[1], sentence() + items[2] + sentence(), body(3)]
    rows = [(i, t, "xx" if i % 9 else None, f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, items


def test_stages(spark, sf_dir):
    folder, rows, items = sf_dir
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if k < 4:
            assert out.columns == corpus_pipeline.COLUMNS
            out.write.parquet(path := f"{folder}/stage{k}")
            docs = spark.read.parquet(path)
            seen[name] = {r["doc_id"]: r for r in docs.collect()}
        else:
            seen[name] = out.collect()
    kept = {r[0]: r[1] for r in rows}
    model = language_id.train(language_id.teaching(spark.read.parquet(f"{folder}/documents.parquet")))
    gone = {r[0] for r, x in zip(rows, model.predict([r[1] for r in rows])["rejected"]) if x}
    assert gone == {63, 64, 65, 66}
    kept = {k: t for k, t in kept.items() if k not in gone}
    assert set(seen["language_id"]) == set(kept)
    cut = defaultdict(set, {list(kept)[i]: v for i, v in ops.plain_repeats(list(kept.values())).items()})
    assert cut[60] and cut[68]
    kept = {k: t if k not in cut or not cut[k] else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in cut[k]) for k, t in kept.items()}
    kept = {k: t for k, t in kept.items() if not cut[k] or t.strip(" ")}
    got = seen["line_dedup"]
    assert {k: r["text"] for k, r in got.items()} == kept and all(r["n_chars"] == len(r["text"]) for r in got.values())
    names = list(kept)
    component = ops.brute_components([kept[k] for k in names])
    kept = {k: kept[k] for i, k in enumerate(names) if component[i][1] == i}
    assert 61 not in kept and 62 not in kept and set(seen["near_duplicates"]) == set(kept)
    leaks = ops.brute_decontaminate([kept[k] for k in kept], list(enumerate(items)))
    kept = {k: t for (k, t), x in zip(kept.items(), leaks) if len(x[2]) < 2}
    assert 69 not in kept and 70 in kept and set(seen["decontamination"]) == set(kept)
    assert {r["doc_id"] for r in seen["packing"]} == set(kept)
    at = defaultdict(int)
    for r in sorted(seen["packing"], key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at[r["sequence_id"]]
        at[r["sequence_id"]] += r["length"]
    assert max(at.values()) <= 4096
    run = corpus_pipeline.run(spark, folder)
    assert {(r["doc_id"], r["piece"], r["ids_crc32"]) for r in run.collect()} == {(r["doc_id"], r["piece"], r["ids_crc32"]) for r in seen["packing"]}
