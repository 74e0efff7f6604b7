"""N-gram Jaccard join by PartEnum signatures: exact, with components instead of all pairs.

Sets are put in size bands whose bounds grow by 1/threshold, so similar sets lie in the same or in
neighbouring bands; each set signs for its own and the next band.  Two sets of a band's sizes that
are similar enough differ in at most k elements.  The domain is dealt by hash into N1 > k / (K2 + 1)
first-level partitions, each into N2 second-level ones: some first-level partition holds at most K2 of
the differences, so N2 - K2 of its second-level partitions agree.  A signature is one of the subsets
of N2 - K2 second-level partitions of a first-level one (where k = 0, the whole set).

Agreement in partitions that are empty in both says nothing.  A first-level partition is poor for a
set if a subset of it is empty; N1 - floor(k / (K2 + 1)) first-level partitions at least have an
agreeing subset, so as long as a set has fewer poor ones than that, its non-empty subsets are enough,
and those of a similar set too.  A set that has more signs for another dealing of the domain besides,
and in the last resort for its empty subsets: no pair is lost.  Spare first-level partitions (one in
``SPARE``) make that rare.

Copies (equal sets) are one class first.  Signatures travel packed by bucket; a bucket's task sorts
them and emits pairs.  A signature that more than ``ALL_PAIRS`` classes share is crowded: it gives a
star around its least class, and does so in the batch where it is signed already, so that of a
signature of a third of all classes a bucket gets one entry a batch.  After verification and
components, only members of crowded signatures that are still in different components are compared
with each other, in blocks of at most ``CROWD_ROWS`` members and in one task for each pair of blocks,
by a parity sketch whose bit differences bound the set difference from below.  Every emitted pair is
verified exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loquarium.llm.common import connected_components, give_back, partitions, small_batches, tidied, written
from loquarium.llm.shingles import mix, shingle_sets

#: Up to so many classes that share a signature are compared pair by pair at once.
ALL_PAIRS = 8
#: Dealings of the domain before empty partitions sign too.
LEVELS = 6
#: N2 and K2: second-level partitions of a first-level one, and how many of them may differ; one first-level partition in SPARE is to spare.
N2, K2, SPARE = 3, 1, 8
SUBSETS = list(combinations(range(N2), N2 - K2))
#: Signatures that one bucket holds, about; and classes signed together.
BUCKET_SIGNATURES, BATCH_DOCS = 400_000, 400
#: Members of a crowded signature in one block; two blocks meet in one task.
CROWD_ROWS = 2048
#: Rows of ids up to which an id list is broadcast (16 bytes a row); beyond, the join is shuffled.
BROADCAST_IDS = 2_000_000
PACKED = "bucket int, docs binary, counts binary, sigs binary"


class Bands:
    """Size bands and what they allow for a threshold of percent / 100."""

    def __init__(self, percent: int):
        self.percent, self.upper = percent, [0]

    def of(self, size: int) -> int:
        while self.upper[-1] < size:
            self.upper.append((self.upper[-1] + 1) * 100 // self.percent)
        return int(np.searchsorted(self.upper, size))

    def most(self, a, b):
        """The largest set difference that two similar sets of these sizes can have."""
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def parts(self, band: int) -> tuple[int, int]:
        """(k, N1) for sets signing for a band."""
        while band >= len(self.upper):
            self.of(self.upper[-1] + 1)
        k = int(self.most(self.upper[band], self.upper[band]))
        least = k // (K2 + 1) + 1
        return k, least + least // SPARE


def sign(sets: list[np.ndarray], bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """(which set, signature) of all signatures of non-empty sets."""
    owners, signatures = [], []
    for step in (0, 1):
        todo, level = np.arange(len(sets)), 0
        while len(todo):
            mine = [sets[i] for i in todo]
            band = np.array([bands.of(len(x)) + step for x in mine])
            k, n = np.array([bands.parts(int(b)) for b in band]).T
            base = np.cumsum(n) - n
            doc = np.repeat(np.arange(len(mine)), [len(x) for x in mine])
            values = mix(np.concatenate(mine) + np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64)))
            cell = base[doc] * N2 + ((values >> np.uint64(32)) * (n * N2)[doc].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
            total = int(n.sum())
            sums, counts = np.zeros(total * N2, np.uint64), np.bincount(cell, minlength=total * N2).reshape(-1, N2)
            np.add.at(sums, cell, mix(values))
            sums = sums.reshape(-1, N2)
            owner = np.repeat(np.arange(len(mine)), n)
            part = np.arange(total) - base[owner]
            tag = mix(((band[owner].astype(np.uint64) << np.uint64(8)) + np.uint64(level)) * np.uint64(0xD6E8FEB86659FD93) + part.astype(np.uint64))
            some = k[owner] > 0
            poor = some & ((counts == 0).sum(axis=1) >= N2 - K2)
            open_ = np.add.reduceat(poor.astype(np.int64), base) >= n - k // (K2 + 1)
            for name, (subset, chosen) in enumerate([*((list(x), some) for x in SUBSETS), (list(range(N2)), ~some)]):
                number, value = counts[:, subset].sum(axis=1), sums[:, subset].sum(axis=1, dtype=np.uint64)
                full = chosen & (number > 0 if level + 1 < LEVELS else (number > 0) | open_[owner])
                owners.append(todo[owner[full]])
                signatures.append(mix(value + number.astype(np.uint64) * np.uint64(0xA24BAED4963EE407) ^ tag + np.uint64((name + 1) * 0x9FB21C651E98DF25 % (1 << 64)))[full])
            todo, level = (todo[open_], level + 1) if level + 1 < LEVELS else (todo[:0], level)
    return (np.concatenate(owners), np.concatenate(signatures)) if owners else (np.zeros(0, np.int64), np.zeros(0, np.uint64))


def sketch(elements: np.ndarray) -> np.ndarray:
    """Parities of the numbers of elements in a power of two of cells, packed into 64-bit words."""
    bits = 1 << max(6, min(16, (2 * len(elements) - 1).bit_length() if len(elements) else 6))
    odd = np.bincount((mix(elements ^ np.uint64(0x2545F4914F6CDD1D)) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def fold(words: np.ndarray, n: int) -> np.ndarray:
    """A sketch (or rows of them) folded to n words; parities of joined cells."""
    while words.shape[-1] > n:
        half = words.shape[-1] // 2
        words = words[..., :half] ^ words[..., half:]
    return words


def _few(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def describe(docs: DataFrame, n: int) -> DataFrame:
    """(id, size, h1, h2) of each row's set; h1 and h2 make a 128-bit hash of the set."""

    @tidied
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(len(s), int(mix(s).sum(dtype=np.uint64).view(np.int64)), int(mix(s ^ np.uint64(0xC2B2AE3D27D4EB4F)).sum(dtype=np.uint64).view(np.int64))) for s in shingle_sets(batch["t"].tolist(), n)]
            out = pd.DataFrame(rows, columns=["size", "h1", "h2"])
            out.insert(0, "id", batch["id"].to_numpy())
            yield out

    return docs.mapInPandas(run, "id long, size long, h1 long, h2 long")


def _pack(docs: DataFrame, n: int, percent: int, buckets: int) -> DataFrame:
    """(PACKED) signatures of docs (id, t) by bucket.

    A signature that more than ALL_PAIRS sets of a batch share is sent once, by the least of them, with
    its document marked by a negative count; the others are in a row of a bucket below 0: their ids,
    the least of theirs and the signatures.
    """

    @tidied
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bands = Bands(percent)
        for batch in batches:
            for at in range(0, len(batch), BATCH_DOCS):
                some = batch.iloc[at : at + BATCH_DOCS]
                sets = list(shingle_sets(some["t"].tolist(), n))
                full = [i for i, x in enumerate(sets) if len(x)]  # empty sets link with nothing
                ids = some["id"].to_numpy("i8")[full]
                owner, sig = sign([sets[i] for i in full], bands)
                order = np.lexsort((ids[owner], sig))
                owner, sig = owner[order], sig[order]
                starts = np.flatnonzero(np.concatenate((np.ones(min(len(sig), 1), bool), sig[1:] != sig[:-1])))
                size = np.diff(np.append(starts, len(sig)))
                run_of = np.repeat(np.arange(len(size)), size)
                first = np.zeros(len(sig), bool)
                first[starts] = True
                hot = size[run_of] > ALL_PAIRS
                rows = []
                if (rest := np.flatnonzero(hot & ~first)).size:
                    least = ids[owner[starts[run_of[rest]]]]
                    rows.append((-1 - int(sig[rest[0]] % np.uint64(buckets)), ids[owner[rest]].tobytes(), least.tobytes(), _name(sig[rest], buckets).tobytes()))
                keep = first | ~hot
                owner, sig, hot = owner[keep], sig[keep], hot[keep]
                bucket = _bucket(sig, buckets)
                order = np.lexsort((owner, hot, bucket))
                owner, sig, bucket, hot = owner[order], sig[order], bucket[order], hot[order]
                cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
                for a, b in zip(cuts, [*cuts[1:], len(bucket)]):
                    new = np.flatnonzero(np.concatenate(([True], (owner[a + 1 : b] != owner[a : b - 1]) | (hot[a + 1 : b] != hot[a : b - 1]))))
                    count = np.diff(np.append(new, b - a)) * np.where(hot[a:b][new], -1, 1)
                    six = sig[a:b].view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
                    rows.append((int(bucket[a]), ids[owner[a:b][new]].tobytes(), count.astype("<i4").tobytes(), six))
                yield pd.DataFrame(rows, columns=["bucket", "docs", "counts", "sigs"])

    return docs.mapInPandas(run, PACKED)


def _bucket(sig: np.ndarray, buckets: int) -> np.ndarray:
    return (sig >> np.uint64(48)).astype(np.int64) * buckets >> 16


def _name(sig: np.ndarray, buckets: int) -> np.ndarray:
    """A signature as buckets know it: the bucket's number and the low 48 bits."""
    return (_bucket(sig, buckets).astype(np.uint64) << np.uint64(48) | sig & np.uint64((1 << 48) - 1)).view("i8")


def _runs(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row numbers of members, ends of runs, signature of each run, whether a member of it stands for several) of those that two or more share; rows number the bucket's documents."""
    count = np.concatenate([np.frombuffer(x, "<i4") for x in group["counts"]])
    six = np.frombuffer(b"".join(group["sigs"]), np.uint8).reshape(-1, 6)
    sig = np.zeros((len(six), 8), np.uint8)
    sig[:, :6] = six
    sig = sig.view(np.uint64).ravel()
    owner, several = np.repeat(np.arange(len(count)), np.abs(count)), np.repeat(count < 0, np.abs(count))
    order = np.argsort(sig, kind="stable")
    sig, owner, several = sig[order], owner[order], several[order]
    new = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
    size = np.diff(np.append(new, len(sig)))
    crowd = np.logical_or.reduceat(several, new)
    shared = (size >= 2) | crowd
    return owner[np.repeat(shared, size)], np.cumsum(size[shared]), sig[new[shared]], crowd[shared]


def candidates(packed: DataFrame) -> DataFrame:
    """(a, b, null) candidate pairs, a < b; and (a, least, g) for each member of a signature g that more than ALL_PAIRS share, with the least member that it was paired with."""

    def table(pairs: np.ndarray, crowd: np.ndarray) -> pd.DataFrame:
        pairs = np.unique(pairs, axis=0)
        pairs = pairs[pairs[:, 0] < pairs[:, 1]]
        both = pd.DataFrame(np.concatenate((np.column_stack((pairs, np.zeros(len(pairs), "i8"))), crowd)), columns=["a", "b", "g"])
        return both.assign(g=pd.arrays.IntegerArray(both["g"].to_numpy(), np.arange(len(both)) < len(pairs)))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        if group["bucket"].iloc[0] < 0:  # members of what is crowded in a batch, with the batch's least one
            member, least, name = (np.concatenate([np.frombuffer(x, "<i8") for x in group[c]]) for c in ("docs", "counts", "sigs"))
            return table(np.stack((least, member), 1), np.stack((member, least, name), 1))
        ids = np.concatenate([np.frombuffer(x, "<i8") for x in group["docs"]])
        owner, ends, sig, crowd = _runs(group)
        if not len(ends):
            return table(np.zeros((0, 2), "i8"), np.zeros((0, 3), "i8"))
        doc = ids[owner]
        starts = np.append(0, ends[:-1])
        size = ends - starts
        run_of = np.repeat(np.arange(len(size)), size)
        crowd = (crowd | (size > ALL_PAIRS))[run_of]
        least = np.minimum.reduceat(doc, starts)[run_of]
        pairs = []
        for gap in range(1, ALL_PAIRS):
            at = np.flatnonzero((run_of[gap:] == run_of[:-gap]) & ~crowd[gap:])
            pairs.append(np.stack((np.minimum(doc[at], doc[at + gap]), np.maximum(doc[at], doc[at + gap])), 1))
        large = np.flatnonzero(crowd)
        pairs.append(np.stack((least[large], doc[large]), 1))
        name = (np.uint64(group["bucket"].iloc[0]) << np.uint64(48) | sig).view("i8")[run_of[large]]
        out = table(np.concatenate(pairs), np.stack((doc[large], least[large], name), 1))
        del group, ids, owner, doc, pairs
        give_back()
        return out

    return packed.groupBy("bucket").applyInPandas(run, "a long, b long, g long")


def unsettled(crowd: DataFrame, parts: DataFrame) -> DataFrame:
    """(g, a, comp) of all members of the crowded signatures (a, b, g) that some component does not hold as a whole.

    A signature is whole where each member is in the component of the least one that it was paired
    with.  These pairs are far fewer than memberships, so they are looked up, and memberships only of
    signatures that are not whole.
    """
    star = crowd.where("a <> b").select("a", "b").distinct()
    side = lambda x: parts.select(F.col("node").alias(x), F.col("component").alias(f"c{x}"))
    apart = star.join(side("a"), "a", "left").join(side("b"), "b", "left").where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
    apart = written(apart, "jaccard-apart")
    mixed = written(crowd.join(apart, ["a", "b"], "left_semi").select("g").distinct(), "jaccard-mixed")
    members = crowd.join(mixed, "g", "left_semi").select("g", "a").distinct()
    return members.join(side("a"), "a", "left").select("g", "a", F.coalesce("ca", "a").alias("comp"))


def cross_candidates(members: DataFrame, percent: int, tasks: int) -> DataFrame:
    """(a, b) pairs of members (g, a, comp, size, bits) of one signature in different components whose sketches allow similarity.

    A signature's members are dealt into blocks of about CROWD_ROWS; each two blocks (and each block by
    itself) are compared in a group of their own, whatever the signature's crowd.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        bands, out = Bands(percent), []
        for _, group in rows.groupby(["g", "x", "y"], sort=False):
            ids, comps, sizes, own = (group[c].to_numpy("i8") for c in ("a", "comp", "size", "block"))
            drawn = [np.frombuffer(x, np.uint64) for x in group["bits"]]
            width = min(map(len, drawn))
            bits = np.stack([fold(x, width) for x in drawn])
            alone = group["x"].iloc[0] == group["y"].iloc[0]
            for x in range(len(ids) - 1):
                y = np.flatnonzero((comps[x + 1 :] != comps[x]) & (alone | (own[x + 1 :] != own[x]))) + x + 1
                y = y[np.bitwise_count(bits[y] ^ bits[x]).sum(axis=1, dtype=np.int64) <= bands.most(sizes[y], sizes[x])]
                if len(y):
                    out.append(np.stack((np.full(len(y), ids[x]), ids[y]), 1))
        pairs = np.unique(np.sort(np.concatenate(out), axis=1), axis=0) if out else np.zeros((0, 2), "i8")
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    blocks = members.groupBy("g").agg(F.ceil(F.count("*") / CROWD_ROWS).cast("int").alias("blocks"))
    dealt = members.join(blocks, "g").withColumn("block", F.pmod(F.xxhash64("a"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.select("g", "a", "comp", "size", "bits", "block", other.alias("o")).select("*", F.least("block", "o").alias("x"), F.greatest("block", "o").alias("y"))
    return dealt.withColumn("task", F.pmod(F.xxhash64("g", "x", "y"), F.lit(tasks))).groupBy("task").applyInPandas(run, "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(links, sketches): the distinct pairs (a, b) whose sets are similar; sizes and sketches (id, size, bits) rule most out, then sets are intersected."""
    pairs = written(pairs.where("a < b").distinct(), "jaccard-pairs")

    @tidied
    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = list(shingle_sets(batch["t"].tolist(), n))
            yield pd.DataFrame({"id": batch["id"], "size": [len(s) for s in sets], "bits": [sketch(s).tobytes() for s in sets]})

    @tidied
    def collect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "elements": [s.tobytes() for s in shingle_sets(batch["t"].tolist(), n)]})

    @tidied
    def rule_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bands = Bands(percent)
        for batch in batches:
            most = bands.most(batch["size_a"].to_numpy(), batch["size_b"].to_numpy())
            keep = []
            for x, y, k in zip(batch["bits_a"], batch["bits_b"], most):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                w = min(len(x), len(y))
                keep.append(int(np.bitwise_count(fold(x, w) ^ fold(y, w)).sum()) <= k)
            yield batch.loc[keep, ["a", "b"]]

    @tidied
    def intersect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["elements_a"], batch["elements_b"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.concatenate((x, y))
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(shared > 0 and 100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.loc[keep, ["a", "b"]]

    def chosen(p: DataFrame) -> DataFrame:
        ids = p.select(F.col("a").alias("id")).unionAll(p.select("b")).distinct()
        return docs.join(_few(ids), "id", "left_semi").select("id", "t")

    def sided(p: DataFrame, what: DataFrame) -> DataFrame:
        for side in "ba":  # a, the least of a star, last: its rows are not moved again with both sides
            p = p.join(what.select(F.col("id").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in what.columns if c != "id"]), side)
        return p

    drawn = written(chosen(pairs).mapInPandas(draw, "id long, size long, bits binary"), "jaccard-sketches")
    left = written(sided(pairs, drawn).mapInPandas(rule_out, "a long, b long"), "jaccard-left")
    sets = written(chosen(left).mapInPandas(collect, "id long, elements binary"), "jaccard-sets")
    return written(sided(left, sets).mapInPandas(intersect, "a long, b long"), "jaccard-links"), drawn


def jaccard_join(docs: DataFrame, percent: int = 80, n: int = 5, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(members, links): every row's doc_id, n_shingles, class_id, component_id; and links (a, b) between classes.

    class_id is the least doc_id with the same set.  Links join the components' classes but need not
    be all similar pairs.  Rows without words have class and component of their own.  Rows that share
    a doc_id count as one document for components; a null doc_id links with nothing.
    """
    spark = docs.sparkSession
    small_batches(spark)
    d = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("t"))
    described = written(d.transform(lambda x: describe(x, n)), "jaccard-sets")
    usable = described.where("size > 0 and id is not null")
    classes = usable.groupBy("h1", "h2", "size").agg(F.min("id").alias("class_id"), F.count("*").alias("rows"))
    reps = written(classes, "jaccard-classes")
    total = reps.agg(F.sum("size")).first()[0] or 0
    buckets = min(1 << 16, max(partitions(spark), math.ceil(0.75 * total / BUCKET_SIGNATURES)))
    # Rows of a class beyond its least are left out; they are listed, not the classes, as they are the fewer in most corpora.
    spare = written(usable.join(reps.where("rows > 1"), ["h1", "h2", "size"]).where("id <> class_id").groupBy("id").agg(F.min("class_id").alias("class_id")), "jaccard-copies")
    single = d.where("id is not null and t is not null").join(_few(spare.select("id")), "id", "left_anti")
    found = written(candidates(_pack(single, n, percent, buckets)), "jaccard-candidates")
    links, drawn = verified(found.where("g is null").select("a", "b"), single, n, percent)
    parts = written(connected_components(links, "a", "b", "jaccard"), "jaccard-components")
    # Signatures of many classes gave a star each: what is still in different components is compared, sketch by sketch.
    crowd = written(unsettled(found.where("g is not null"), parts), "jaccard-crowd")
    if rows := crowd.count():
        seen = crowd.join(drawn.withColumnRenamed("id", "a"), "a")
        more = cross_candidates(seen, percent, max(partitions(spark), math.ceil(rows / (8 * CROWD_ROWS)))).distinct().join(links, ["a", "b"], "left_anti")
        more = written(more, "jaccard-more")
        if more.take(1):
            links = written(links.unionByName(verified(more, single, n, percent)[0]), "jaccard-links")
            parts = written(connected_components(links, "a", "b", "jaccard"), "jaccard-components")
    members = described.join(spare, "id", "left").withColumn("class_id", F.coalesce("class_id", "id"))
    members = members.join(parts.withColumnRenamed("node", "class_id"), "class_id", "left")
    return members.select(F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"), "class_id", F.coalesce("component", "class_id").alias("component_id")), links
