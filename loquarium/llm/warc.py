"""WARC archives as seekable zstandard bundles.

A bundle is a row of independent zstandard frames, each with a group of WARC/1.1 records, and then a
skippable frame with the seek table of the public seekable format (compressed and decompressed size
of each frame).  The map from record id to (bundle, frame, offset in the frame, size) is kept as a
table.  Among records of equal payload that is large enough, the one with the least page id is the
response; the others are revisits without a body.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loquarium.llm.common import new_path, partitions, small_batches, tidied, written
from loquarium.llm.files import new_file, open_input, open_output, read_range

#: Payloads of fewer bytes are always kept whole.
LEAST_REVISIT = 100
FRAME_BYTES, BUNDLE_BYTES = 256 << 10, 128 << 20
#: Rows of a page_id and a digest up to which they are broadcast (about 100 bytes each).
BROADCAST_ROWS = 500_000
#: Fixed values of the public seekable format.
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
INDEX = "page_id long, bundle string, frame int, frame_at long, frame_size long, offset int, size int"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def plan_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, html, digest, n_bytes, refers_to): html is null for revisits.

    Null html is an empty payload.  A page is told by its page_id and digest: rows that repeat the
    least page_id of a payload are responses too, and rows of one page_id with other payloads count by
    themselves.  A null page_id never is the one referred to; payloads that only pages without id
    share are all responses.  Other columns are ignored.

    Bodies never move by digest, so a payload that a third of all pages share is no large task: first
    only (digest, page_id) is aggregated, with partial sums; then pages without html learn whom they
    repeat, in a join with written firsts that AQE can split; and the pages that are none of these
    revisits keep their html, by a broadcast of the revisits' keys if their count allows it, else by a
    join on page_id and digest.
    """
    p = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"), F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("html"))
    p = p.withColumn("digest", F.sha2(F.encode("html", "UTF-8"), 256)).withColumn("n_bytes", F.octet_length("html").cast("long"))
    large = F.col("n_bytes") >= LEAST_REVISIT
    first = p.where(large).groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 and refers_to is not null")
    first = written(first.select("digest", "refers_to"), "warc-firsts")
    lean = p.where(large).select("page_id", "url", "digest", "n_bytes")
    again = lean.join(_few(first), "digest").where(~F.col("refers_to").eqNullSafe(F.col("page_id")))
    again = written(again.select("page_id", "url", F.lit(None).cast("string").alias("html"), "digest", "n_bytes", "refers_to"), "warc-revisits")
    keys = again.select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest")).distinct()
    whole = p.join(_few(keys), F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest")), "left_anti")
    return whole.withColumn("refers_to", F.lit(None).cast("long")).unionByName(again)


def _few(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows.hint("merge")


def record(page_id: int | None, url: str | None, html: str | None, digest: str, n_bytes: int, refers_to: int | None) -> bytes:
    """One WARC record; a revisit keeps the HTTP header, which tells its payload's length."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = http if revisit else http + (html or "").encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {''.join((url or '').split())}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines[3:3] = [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record in a decompressed frame or part of one."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *rest = data[at:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in rest)
        size = int(headers["Content-Length"])
        yield headers, data[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


class BundleWriter:
    """One bundle: add records, then close it; places tells where each record lies."""

    def __init__(self, path: str):
        import zstandard

        self.path, self.out, self.squeeze = path, open_output(path), zstandard.ZstdCompressor(level=3, write_content_size=True)
        self.table, self.places, self.pending, self.at = [], [], [], 0
        self.size = 0

    def add(self, key: int | None, raw: bytes) -> None:
        self.pending.append((key, self.size, len(raw), raw))
        self.size += len(raw)
        if self.size >= FRAME_BYTES:
            self.flush()

    def flush(self) -> None:
        if not self.pending:
            return
        frame = self.squeeze.compress(b"".join(x[3] for x in self.pending))
        self.out.write(frame)
        self.places += [(k, self.path, len(self.table), self.at, len(frame), offset, size) for k, offset, size, _ in self.pending]
        self.table.append((len(frame), self.size))
        self.at, self.pending, self.size = self.at + len(frame), [], 0

    def close(self) -> list[tuple]:
        self.flush()
        entries = b"".join(struct.pack("<II", *x) for x in self.table)
        foot = struct.pack("<IBI", len(self.table), 0, _SEEKABLE)
        self.out.write(struct.pack("<II", _SKIPPABLE, len(entries) + len(foot)) + entries + foot)
        self.out.close()
        return self.places


def seek_table(path: str) -> list[tuple[int, int, int]]:
    """(offset, compressed size, decompressed size) of each frame, from the footer alone."""
    with open_input(path) as f:
        size = f.size()
        f.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", f.read(9))
        if magic != _SEEKABLE:
            raise ValueError(f"{path} has no seek table")
        each = 12 if flags & 0x80 else 8
        f.seek(size - 9 - n * each)
        raw = f.read(n * each)
    out, at = [], 0
    for k in range(n):
        packed, plain = struct.unpack_from("<II", raw, k * each)
        out.append((at, packed, plain))
        at += packed
    return out


def read_frame(path: str, at: int, packed: int) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(read_range(path, at, packed))


def read_record(path: str, frame_at: int, frame_size: int, offset: int, size: int) -> tuple[dict[str, str], bytes]:
    """One record by its place in the index, reading its frame alone."""
    return next(parse_records(read_frame(path, frame_at, frame_size)[offset : offset + size]))


def write_warc(pages: DataFrame, folder: str) -> DataFrame:
    """Writes a record for every page; returns the index (INDEX) as a written table."""

    small_batches(pages.sparkSession)

    @tidied
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, bundle, total = [x.split()[0] for x in INDEX.split(", ")], None, 0
        for batch in batches:
            none = lambda c: [None if pd.isna(v) else int(v) for v in batch[c]]
            for key, url, html, digest, n, refers in zip(none("page_id"), batch["url"], batch["html"], batch["digest"], batch["n_bytes"], none("refers_to")):
                bundle = bundle or BundleWriter(new_file(folder, ".warc.zst"))
                raw = record(key, url, html, digest, int(n), refers)
                bundle.add(key, raw)
                total += len(raw)
                if bundle.at >= BUNDLE_BYTES:
                    yield pd.DataFrame(bundle.close(), columns=names).astype({"page_id": "Int64"})
                    bundle = None
        if bundle:
            yield pd.DataFrame(bundle.close(), columns=names).astype({"page_id": "Int64"})

    return written(plan_records(pages).mapInPandas(write, INDEX), "warc-index")


def _facts(headers: dict[str, str], block: bytes, bundle: str) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of a record; a damaged response is an error."""
    ident = lambda x: int(y) if (y := x.removeprefix("<urn:page:").rstrip(">")) else None
    head, _, body = block.partition(b"\r\n\r\n")
    n, digest = int(head.rpartition(b"Content-Length: ")[2]), headers["WARC-Payload-Digest"].removeprefix("sha256:")
    if headers["WARC-Type"] == "response" and (len(body) != n or hashlib.sha256(body).hexdigest() != digest):
        raise ValueError(f"{headers['WARC-Record-ID']} in {bundle} is damaged")
    return ident(headers["WARC-Record-ID"]), n, digest, headers["WARC-Type"], ident(headers["WARC-Refers-To"]) if "WARC-Refers-To" in headers else None


def read_warc(index: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the records that rows of an index (INDEX) place.

    A frame is decompressed once for all records asked of it; its place must be one of the bundle's
    seek table, and a record's id that of its row.  So one page, or all, are read alike.
    """

    @tidied
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables: dict[str, set[tuple[int, int]]] = {}
        frame, data = None, b""
        for batch in batches:
            rows = []
            for key, bundle, at, packed, offset, size in zip(batch["page_id"], batch["bundle"], batch["frame_at"], batch["frame_size"], batch["offset"], batch["size"]):
                if bundle not in tables:
                    tables[bundle] = {x[:2] for x in seek_table(bundle)}
                if (at, packed) not in tables[bundle]:
                    raise ValueError(f"{bundle} has no frame at byte {at}")
                if frame != (bundle, at):
                    frame, data = (bundle, at), read_frame(bundle, int(at), int(packed))
                found = _facts(*next(parse_records(data[offset : offset + size])), bundle)
                if found[0] != (None if pd.isna(key) else key):
                    raise ValueError(f"the record at byte {offset} of frame {at} of {bundle} is not page {key}")
                rows.append(found)
            yield pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]).astype({"page_id": "Int64", "refers_to": "Int64"})

    n = partitions(index.sparkSession)
    dealt = index.select(*[x.split()[0] for x in INDEX.split(", ")]).repartition(n, "bundle", "frame_at").sortWithinPartitions("bundle", "frame_at", "offset")
    return dealt.mapInPandas(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def warc_round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Writes the pages as seekable bundles in the shared folder and reads every record back by its place in the index."""
    return read_warc(write_warc(pages, new_path(spark, "warc")))
