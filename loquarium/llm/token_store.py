"""Token-id files with a shared zstandard dictionary: every document compressed by itself.

A shard holds one frame for each document, in ascending doc_id order, and a footer index:

    b"LQTOK1\\0\\0" | sha256 of the dictionary (32 bytes) | frames | index | index offset u64 | documents u64 | b"LQTOK1\\0\\0"

The index has, for each document, doc_id i64, has_id u8, n_tokens u64, frame offset u64, frame size
u32.  A frame is the document's ids as little-endian unsigned integers of the vocabulary's width.
The dictionary is trained on the id arrays of a bounded sample of documents and lies beside the
shards under its hash.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loquarium.llm.common import drawn, new_path, partitions, small_batches, tidied, written
from loquarium.llm.files import new_file, open_input, open_output
from loquarium.llm.tokens import encoder

MAGIC = b"LQTOK1\0\0"
#: The dictionary is fitted on so many documents of at most so many characters; all documents are encoded.
SAMPLE_DOCS, SAMPLE_CHARS, DICTIONARY_BYTES = 1000, 16_000, 64_000
#: Shards are closed at about this size.
SHARD_BYTES = 256 << 20
_INDEX = np.dtype([("doc_id", "<i8"), ("has_id", "u1"), ("n", "<u8"), ("at", "<u8"), ("size", "<u4")])
MANIFEST = "part int, seq int, path string, n_docs long, n_tokens long, n_bytes long"


def train_dictionary(docs: DataFrame, tokenizer: str, drops_space: bool, end_id: int, doc_id: str = "doc_id", text: str = "text") -> bytes:
    """Dictionary bytes from a bounded sample (least hashes of doc_id); empty where the sample is too small to train on."""
    import zstandard

    some = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t"))
    texts = [r["t"] for r in drawn(some.where(F.length("t").between(1, SAMPLE_CHARS)), F.xxhash64("id"), docs.count(), SAMPLE_DOCS).collect()]
    enc = encoder(tokenizer, drops_space)
    end = np.array([end_id], enc.dtype).tobytes()
    ids = [x + end for x in enc.encode(texts)]
    if sum(map(len, ids)) < 8 * DICTIONARY_BYTES or len(ids) < 64:
        return b"".join(ids)[:DICTIONARY_BYTES] if sum(map(len, ids)) > 64 else b""
    return zstandard.train_dictionary(DICTIONARY_BYTES, ids, level=3).as_bytes()


def _dictionary(raw: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(raw) if raw else None


def write_store(docs: DataFrame, folder: str, tokenizer: str, drops_space: bool, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes every document; returns the manifest (MANIFEST), whose order by (part, seq) is that of doc_id.

    Null text counts as empty; null doc_ids come first; equal rows are each written.
    """
    raw = train_dictionary(docs, tokenizer, drops_space, end_id, doc_id, text)
    digest = hashlib.sha256(raw).digest()
    with open_output(new_file(folder, "").rpartition("/")[0] + f"/{digest.hex()}.zdict") as f:
        f.write(raw)

    small_batches(docs.sparkSession)

    @tidied
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        enc, part, seq = encoder(tokenizer, drops_space), TaskContext.get().partitionId(), 0
        shared = _dictionary(raw)
        if shared:
            shared.precompute_compress(level=3)
        squeeze = zstandard.ZstdCompressor(level=3, dict_data=shared) if shared else zstandard.ZstdCompressor(level=3)
        end = np.array([end_id], enc.dtype).tobytes()
        out, index, at, path = None, [], 0, ""

        def close() -> pd.DataFrame:
            table = np.array(index, _INDEX)
            out.write(table.tobytes() + at.to_bytes(8, "little") + len(index).to_bytes(8, "little") + MAGIC)
            out.close()
            return pd.DataFrame([(part, seq, path, len(index), int(table["n"].sum()), at)], columns=["part", "seq", "path", "n_docs", "n_tokens", "n_bytes"])

        for batch in batches:
            for key, known, text in zip(batch["k"], batch["known"], batch["t"]):
                if out is None:
                    path = new_file(folder, ".lqt")
                    out, index, at = open_output(path), [], 40
                    out.write(MAGIC + digest)
                ids = enc.encode([text])[0] + end
                frame = squeeze.compress(ids)
                out.write(frame)
                index.append((int(key), known, len(ids) // enc.dtype.itemsize, at, len(frame)))
                at += len(frame)
                if at >= SHARD_BYTES:
                    yield close()
                    out, seq = None, seq + 1
        if out is not None:
            yield close()

    n = partitions(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("t")).repartitionByRange(n, F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first())
    rows = rows.select(F.coalesce("id", F.lit(0)).alias("k"), F.col("id").isNotNull().cast("int").alias("known"), "t")
    return written(rows.mapInPandas(write, MANIFEST), "token-manifest")


class Shard:
    """Random access to one shard file."""

    def __init__(self, path: str):
        self.f = open_input(path)
        size = self.f.size()
        self.f.seek(size - 24)
        tail = self.f.read(24)
        if tail[16:] != MAGIC:
            raise ValueError(f"{path} is not a token shard")
        at, n = int.from_bytes(tail[:8], "little"), int.from_bytes(tail[8:16], "little")
        self.f.seek(0)
        head = self.f.read(40)
        with open_input(f"{path.rpartition('/')[0]}/{head[8:40].hex()}.zdict") as d:
            raw = d.read()
        if hashlib.sha256(raw).digest() != head[8:40]:
            raise ValueError(f"the dictionary of {path} does not have its hash")
        import zstandard

        shared = _dictionary(raw)
        self.plain = zstandard.ZstdDecompressor(dict_data=shared) if shared else zstandard.ZstdDecompressor()
        self.f.seek(at)
        self.index = np.frombuffer(self.f.read(n * _INDEX.itemsize), _INDEX)

    def ids(self, k: int) -> np.ndarray:
        """The k-th document's ids, reading nothing but its frame."""
        e = self.index[k]
        self.f.seek(int(e["at"]))
        raw = self.plain.decompress(self.f.read(int(e["size"])))
        return np.frombuffer(raw, f"<u{len(raw) // int(e['n'])}").astype("<u4")

    def find(self, doc_id: int) -> np.ndarray | None:
        """A document's ids by its doc_id (binary search in the index), or None."""
        known = self.index[self.index["has_id"] == 1]
        k = int(np.searchsorted(known["doc_id"], doc_id))
        if k == len(known) or known["doc_id"][k] != doc_id:
            return None
        return self.ids(k + len(self.index) - len(known))

    def close(self) -> None:
        self.f.close()


def read_store(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32), read back from the shards; start counts the ids of all documents before."""
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))  # a row for each shard

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, base in zip(batch["path"], batch["base"]):
                shard = Shard(path)
                n = shard.index["n"].astype("i8")
                keys = pd.array(shard.index["doc_id"], dtype="Int64")
                keys[shard.index["has_id"] == 0] = pd.NA
                crc = [zlib.crc32(shard.ids(k).tobytes()) for k in range(len(n))]
                shard.close()
                yield pd.DataFrame({"doc_id": keys, "start": base + np.cumsum(n) - n, "n_tokens": n, "ids_crc32": np.array(crc, "i8")})

    return shards.select("path", "base").repartition(partitions(manifest.sparkSession), "path").mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_store(spark: SparkSession, docs: DataFrame, tokenizer: str, drops_space: bool, end_id: int) -> DataFrame:
    """Writes the documents as token shards in the shared folder and reads them back."""
    return read_store(write_store(docs, new_path(spark, "token-store"), tokenizer, drops_space, end_id))
