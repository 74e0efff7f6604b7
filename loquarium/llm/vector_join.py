"""Embedding near-duplicates by a subspace pigeonhole join: exact links by cosine.

Unit vectors are rotated (principal axes of a bounded sample) and dealt into ``BLOCKS`` blocks of few
dimensions, neighbouring axes to different blocks.  Vectors of cosine >= t differ by at most
2(1 - t) in squared length, so in some block by at most that over the number of blocks.  A k-d tree cuts
the space into leaves, which lie in the shared folder as one file each, every vector once; leaves are
read in chunks of bounded size.  Pairs of leaves whose boxes are near enough meet, chunk by chunk: a
join of boxes gives tiles of such pairs, and the task of a tile reads its chunks from the files, so what
is written does not grow with the number of meetings.  Two chunks are compared in vector operations
in each block in which their boxes are within its share; of the pairs within budget in any of them
the cosine of the vectors as they are given decides, where single precision leaves that open.  Two
vectors meet once, so every link counts once.  A task returns for each vector its number of links and the least vector of
its component there, never the pairs.  Copies are one class.

The work is that of the pairs of chunks whose boxes are near: vectors that lie in few places of the
space are compared with their surroundings alone, vectors that fill it evenly with most others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from loquarium.llm.common import connected_components, drawn, new_path, removed, tidied, written
from loquarium.llm.files import new_file, open_output, read_range

BLOCKS = 4
#: Vectors in a chunk, at most (fewer of more than 64 dimensions); rows, columns and candidate pairs handled at once in a task.
CHUNK, ROWS, COLUMNS, PAIRS = 16_384, 256, 1024, 200_000
#: Leaves on a side of a tile at most, and tasks that compare tiles.
SIDE, TASKS = 8, 4096
#: Bytes of vectors that a task sorts by leaf at once.
RUN = 32 << 20
#: The rotation and the k-d tree are fitted on so many vectors; all vectors are joined.
SAMPLE = 8192
#: Part of a slab's pairs beyond which they are not compared one by one but all at once.
DENSE = 1 / 32


class Space:
    """Rotation, blocks and k-d tree for one number of dimensions."""

    def __init__(self, sample: np.ndarray, count: int, threshold: float):
        self.dims = sample.shape[1]
        self.blocks = min(BLOCKS, self.dims)
        self.chunk = max(1, min(CHUNK, CHUNK * 64 // self.dims))
        #: Most by which sums in single precision are off for squared distances and cosines of unit vectors.
        self.slack = 2.4e-7 * (self.dims + 4)
        self.total = 2 * (1 - threshold) + self.slack
        self.budget = 2 * (1 - threshold) / self.blocks + self.slack
        centred = sample - sample.mean(axis=0)
        axes = np.linalg.eigh(centred.T @ centred)[1][:, ::-1]
        order = np.concatenate([np.arange(b, self.dims, self.blocks) for b in range(self.blocks)])
        self.rotation = np.ascontiguousarray(axes[:, order])
        widths = [len(range(b, self.dims, self.blocks)) for b in range(self.blocks)]
        self.cuts = [0, *np.cumsum(widths).tolist()]
        depth = max(0, min(math.ceil(math.log2(max(1, count / self.chunk))), int(math.log2(max(1, len(sample) / 8)))))
        self.tree = self._tree(sample @ self.rotation, depth)

    def _tree(self, points: np.ndarray, depth: int):
        """Nested (axis, cut, low, high); a leaf is None."""
        if not depth or len(points) < 2:
            return None
        axis = int(np.argmax(points.max(axis=0) - points.min(axis=0)))
        cut = float(np.median(points[:, axis]))
        low = points[:, axis] < cut
        return (axis, cut, self._tree(points[low], depth - 1), self._tree(points[~low], depth - 1))

    def turn(self, vectors: np.ndarray) -> np.ndarray:
        """Unit vectors, rotated."""
        return _unit(vectors) @ self.rotation

    def part(self, turned: np.ndarray, block: int) -> np.ndarray:
        return turned[:, self.cuts[block] : self.cuts[block + 1]]

    def leaves(self, turned: np.ndarray) -> np.ndarray:
        out = np.zeros(len(turned), np.int64)

        def walk(node, rows: np.ndarray, name: int) -> None:
            if node is None or not len(rows):
                out[rows] = name
                return
            low = turned[rows, node[0]] < node[1]
            walk(node[2], rows[low], 2 * name)
            walk(node[3], rows[~low], 2 * name + 1)

        walk(self.tree, np.arange(len(turned)), 1)
        return out


def _matrix(column: pd.Series, dims: int) -> np.ndarray:
    return np.array(column.tolist(), np.float64).reshape(len(column), dims)


def _length(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors * vectors).sum(axis=1))


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """In double precision, each times a power of two that keeps squares from overflow and from vanishing; cosines stay."""
    return np.ldexp(vectors.astype("f8"), -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = _scaled(vectors)
    return vectors / _length(vectors)[:, None]


def _record(dims: int, kind: str) -> np.dtype:
    """How a class lies in the files; vectors keep the precision in which they are given."""
    return np.dtype([("id", "<i8"), ("n", "<i8"), ("v", "<f4" if kind == "float" else "<f8", (dims,))])


def _runs(reps: DataFrame, space: Space, record: np.dtype, folder: str) -> DataFrame:
    """(leaf, file, begin, n, low, high): stretches of files in which the classes (id, n, v) lie sorted by leaf, with their boxes."""

    def run(rows: np.ndarray) -> pd.DataFrame:
        leaf = np.concatenate([space.leaves(space.turn(rows["v"][k : k + space.chunk])) for k in range(0, len(rows), space.chunk)])
        order = np.argsort(leaf, kind="stable")
        rows, leaf = rows[order], leaf[order]
        file = new_file(folder, ".run")
        with open_output(file) as f:
            f.write(memoryview(rows).cast("B"))
        found = []
        for name, at, n in zip(*np.unique(leaf, return_index=True, return_counts=True)):
            low, high = np.full(space.dims, np.inf), np.full(space.dims, -np.inf)
            for k in range(at, at + n, space.chunk):
                turned = space.turn(rows["v"][k : min(k + space.chunk, at + n)])
                low, high = np.minimum(low, turned.min(axis=0)), np.maximum(high, turned.max(axis=0))
            found.append((int(name), file, int(at), int(n), low.tolist(), high.tolist()))
        return pd.DataFrame(found, columns=["leaf", "file", "begin", "n", "low", "high"])

    @tidied
    def sort(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            rows = np.empty(len(batch), record)
            rows["id"], rows["n"], rows["v"] = batch["id"], batch["n"], _matrix(batch["v"], space.dims)
            held.append(rows)
            size += rows.nbytes
            if size >= RUN:
                yield run(np.concatenate(held))
                held, size = [], 0
        if size:
            yield run(np.concatenate(held))

    return reps.mapInPandas(sort, "leaf long, file string, begin long, n long, low array<double>, high array<double>")


def _leaves(runs: DataFrame, space: Space, record: np.dtype, folder: str) -> DataFrame:
    """(leaf, file, n, chunks, low, high): the stretches of each leaf, copied into a file of its own."""

    def merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        file = new_file(folder, ".leaf")
        with open_output(file) as out:
            for source, begin, n in zip(group["file"], group["begin"], group["n"]):
                for k in range(begin, begin + n, space.chunk):
                    out.write(read_range(source, k * record.itemsize, min(space.chunk, begin + n - k) * record.itemsize))
        total = int(group["n"].sum())
        low, high = np.min(group["low"].tolist(), axis=0), np.max(group["high"].tolist(), axis=0)
        return pd.DataFrame({"leaf": [key[0]], "file": [file], "n": [total], "chunks": [math.ceil(total / space.chunk)], "low": [low.tolist()], "high": [high.tolist()]})

    return runs.groupBy("leaf").applyInPandas(merge, "leaf long, file string, n long, chunks int, low array<double>, high array<double>")


def _meetings(leaves: DataFrame, budget: float, side: int) -> DataFrame:
    """(p, q, x, y, pairs): tiles of pairs of leaves whose boxes are near, for chunk x of the first and chunk y of the second.

    The leaves are no more than the sample gives, whatever the table, so they are broadcast.
    """
    a, b = (leaves.select(*[F.col(c).alias(f"{c}_{k}") for c in ("leaf", "file", "n", "chunks", "low", "high")]) for k in "ab")
    gap = F.zip_with(F.zip_with("low_a", "high_b", lambda x, y: x - y), F.zip_with("low_b", "high_a", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0)))
    near = a.join(F.broadcast(b), F.col("leaf_a") <= F.col("leaf_b")).where(F.aggregate(gap, F.lit(0.0), lambda s, x: s + x * x) <= budget)
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    pair = F.struct(*[f"{c}_{k}" for k in "ab" for c in ("leaf", "file", "n", "chunks")])
    pairs = near.select("*", upto("chunks_a").alias("x")).select("*", upto("chunks_b").alias("y")).where("leaf_a < leaf_b or x <= y")
    p, q = (F.floor(F.col(f"leaf_{k}") / side).alias(c) for k, c in zip("ab", "pq"))
    return pairs.groupBy(p, q, "x", "y").agg(F.collect_list(pair).alias("pairs"))


class _Groups:
    """Components of a task's links, over row numbers."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, x: np.ndarray, y: np.ndarray) -> None:
        while True:
            a, b = self.label[x], self.label[y]
            if not (differ := a != b).any():
                return
            x, y, a, b = x[differ], y[differ], a[differ], b[differ]
            np.minimum.at(self.label, np.maximum(a, b), np.minimum(a, b))
            while (self.label != (up := self.label[self.label])).any():
                self.label = up


class _Chunk:
    """A chunk of a leaf's file: ids, numbers of copies, vectors as given, and turned with their boxes."""

    def __init__(self, space: Space, record: np.dtype, file: str, n: int, chunks: int, number: int):
        begin, end = n * number // chunks, n * (number + 1) // chunks
        rows = np.frombuffer(read_range(file, begin * record.itemsize, (end - begin) * record.itemsize), record)
        self.ids, self.n, self.given = rows["id"].copy(), rows["n"].copy(), rows["v"].copy()
        turned = space.turn(self.given)
        self.low, self.high, self.turned = turned.min(axis=0), turned.max(axis=0), turned.astype("f4")


class _Tally:
    """Links and components of a task's vectors, which are numbered as they come."""

    def __init__(self):
        self.parts, self.links, self.groups = [], np.zeros(0, "i8"), _Groups(0)

    def take(self, ids: np.ndarray) -> int:
        start = len(self.links)
        self.parts.append(ids)
        self.links = np.append(self.links, np.zeros(len(ids), "i8"))
        self.groups.label = np.append(self.groups.label, np.arange(start, len(self.links)))
        return start

    def pairs(self, i: np.ndarray, j: np.ndarray, n: np.ndarray, m: np.ndarray) -> None:
        """Links of vectors i, which stand for n each, and j, which stand for m."""
        np.add.at(self.links, i, m)
        np.add.at(self.links, j, n)
        self.groups.link(i, j)

    def slab(self, at: int, to: int, linked: np.ndarray, n: np.ndarray, m: np.ndarray) -> None:
        """Links of the vectors from ``at`` on with those from ``to`` on, as a matrix."""
        rows, columns = slice(at, at + len(n)), slice(to, to + len(m))
        self.links[rows] += (linked @ m.astype("f8")).astype("i8")
        self.links[columns] += (n.astype("f8") @ linked).astype("i8")
        i, j = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
        self.groups.link(at + i, to + linked[i].argmax(axis=1))
        self.groups.link(at + linked[:, j].argmax(axis=0), to + j)
        while len(found := np.flatnonzero(linked & (self.groups.label[rows, None] != self.groups.label[columns]))):
            i, j = np.divmod(found[:PAIRS], linked.shape[1])
            self.groups.link(at + i, to + j)

    def result(self) -> pa.RecordBatch:
        ids, has = np.concatenate(self.parts), self.links > 0
        least = np.full(len(ids), np.iinfo("i8").max)
        np.minimum.at(least, self.groups.label, ids)
        return pa.record_batch({"id": ids[has], "links": self.links[has], "root": least[self.groups.label[has]]})


def _compare(space: Space, left: _Chunk, right: _Chunk, threshold: float, tally: _Tally, at: int, to: int) -> None:
    """Tallies the links of two chunks, or of one with itself."""
    gap = np.maximum(np.maximum(left.low - right.high, right.low - left.high), 0)[None, :]
    one = lambda x: np.ones((len(x), 1), "f4")
    square = lambda x: (x * x).sum(axis=1, keepdims=True)
    sides = []
    for block in range(space.blocks):
        if (space.part(gap, block) ** 2).sum() <= space.budget:
            a, b = space.part(left.turned, block), space.part(right.turned, block)
            sides.append((np.hstack([-2 * a, square(a), one(a)]), np.ascontiguousarray(np.hstack([b, one(b), square(b)]).T)))
    limit = np.float32(space.budget + space.slack)
    distance, near, within = np.empty(ROWS * COLUMNS, "f4"), np.empty(ROWS * COLUMNS, bool), np.empty(ROWS * COLUMNS, bool)

    def verified(found: np.ndarray, r: int, c: int, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for k in range(0, len(found), PAIRS):
            i, j = np.divmod(found[k : k + PAIRS], width)
            i, j = i + r, j + c
            if left is right:
                i, j = i[i < j], j[i < j]
            a, b = _scaled(left.given[i]), _scaled(right.given[j])
            linked = (a * b).sum(axis=1) / (_length(a) * _length(b)) >= threshold
            yield i[linked], j[linked]

    for r in range(0, len(left.ids), ROWS):
        for c in range(r // COLUMNS * COLUMNS if left is right else 0, len(right.ids), COLUMNS):
            rows, columns = slice(r, min(r + ROWS, len(left.ids))), slice(c, min(c + COLUMNS, len(right.ids)))
            height, width = rows.stop - r, columns.stop - c
            d, close, some = (x[: height * width].reshape(height, width) for x in (distance, near, within))
            some[:] = False
            for a, b in sides:
                np.matmul(a[rows], b[:, columns], out=d)
                np.logical_or(some, np.less_equal(d, limit, out=close), out=some)
            if not (n := np.count_nonzero(some)):
                continue
            if n > DENSE * some.size:
                np.matmul(left.turned[rows], right.turned[columns].T, out=d)
                np.greater_equal(d, threshold + space.slack, out=close)
                np.greater_equal(d, threshold - space.slack, out=some)
                some &= ~close
                if left is right:
                    close &= np.arange(r, rows.stop)[:, None] < np.arange(c, columns.stop)
                tally.slab(at + r, to + c, close, left.n[rows], right.n[columns])
            for i, j in verified(np.flatnonzero(some), r, c, width):
                tally.pairs(at + i, to + j, left.n[i], right.n[j])


def _links(leaves: DataFrame, space: Space, record: np.dtype, threshold: float) -> DataFrame:
    """(id, links, root) of the classes in the leaves, partly counted: sums of links and edges to roots are whole."""

    def tile(x: int, y: int, pairs: list[dict]) -> pa.RecordBatch:
        tally, starts, firsts, last = _Tally(), {}, {}, None

        def chunk(pair: dict, side: str, number: int) -> _Chunk:
            found = _Chunk(space, record, pair[f"file_{side}"], pair[f"n_{side}"], pair[f"chunks_{side}"], number)
            if (key := (pair[f"leaf_{side}"], number)) not in starts:
                starts[key] = tally.take(found.ids)
            return found

        for pair in sorted(pairs, key=lambda pair: pair["leaf_b"]):
            one, two = (pair["leaf_a"], x), (pair["leaf_b"], y)
            if one not in firsts:
                firsts[one] = chunk(pair, "a", x)
            if last is None or last[0] != two:
                last = two, firsts[two] if two in firsts else chunk(pair, "b", y)
            right = firsts[one] if one == two else last[1]
            _compare(space, firsts[one], right, threshold, tally, starts[one], starts[two])
        return tally.result()

    @tidied
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield tile(row["x"], row["y"], row["pairs"])

    meetings = written(_meetings(leaves, space.total, max(1, min(SIDE, leaves.count() // 16))), "vector-meetings")
    tasks = max(1, min(meetings.count(), TASKS))
    return meetings.repartitionByRange(tasks, "p", "q", "x", "y").mapInArrow(meet, "id long, links long, root long")


def vector_join(vectors: DataFrame, threshold: float = 0.9, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do
    vectors of different lengths.  Equal rows are vectors of their own, also where they share a
    vec_id.  A null vec_id counts as a link of its copies but has no component, and a vector that only
    rows without vec_id hold links with nothing but these.  Other columns are ignored.
    """
    given = vectors.select(F.col(f"`{embedding}`")).schema[0].dataType
    kind = "float" if isinstance(given, ArrayType) and isinstance(given.elementType, FloatType) else "double"
    v = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{embedding}`").cast(f"array<{kind}>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    v = v.withColumn("ok", F.coalesce(fine & F.col("v").isNotNull(), F.lit(False)))
    v = v.withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(1), "v")})
    classes = written(v.where("ok").groupBy("h1", "h2").agg(F.min("id").alias("id"), F.count("*").alias("n"), F.any_value("v").alias("v")), "vector-classes")
    heads = written(classes.select("h1", "h2", F.col("id").alias("rep"), "n"), "vector-heads")
    usable, spark = classes.where("id is not null"), classes.sparkSession
    sizes = {r["d"]: r["count"] for r in usable.groupBy(F.size("v").alias("d")).count().collect()}
    sorted_, found = [], None
    for dims, count in sizes.items():
        own = usable.where(F.size("v") == dims).select("id", "n", "v")
        some = _matrix(drawn(own, F.xxhash64("id"), count, SAMPLE).toPandas()["v"], dims)
        space, record, folder = Space(_unit(some), count, threshold), _record(dims, kind), new_path(spark, "vector-runs")
        sorted_.append((space, record, folder, written(_runs(own, space, record, folder), "vector-stretches")))
    for path in {f.rpartition("/")[0] for f in classes.inputFiles()[:1]}:
        removed(spark, path)  # the vectors lie in the runs now
    for space, record, folder, runs in sorted_:
        files = new_path(spark, "vector-leaves")
        leaves = written(_leaves(runs, space, record, files), "vector-boxes")
        removed(spark, folder)
        part = written(_links(leaves, space, record, threshold), "vector-links")
        removed(spark, files)
        found = part if found is None else found.unionByName(part)
    known = v.where("ok").select("id", "h1", "h2").join(heads, ["h1", "h2"], "left")  # heads are written: AQE can split a hot one
    members = known.select("id", "rep", "n").unionByName(v.where("not ok").select("id", F.lit(None).cast("long").alias("rep"), F.lit(None).cast("long").alias("n")))
    if found is None:
        links, parts = members.sparkSession.createDataFrame([], "rep long, links long"), members.sparkSession.createDataFrame([], "rep long, component long")
    else:
        links = written(found.groupBy(F.col("id").alias("rep")).agg(F.sum("links").alias("links")), "vector-counts")
        parts = written(connected_components(found.select("id", "root"), "id", "root", "vectors").withColumnRenamed("node", "rep"), "vector-components")
    linked = members.where("rep is not null").join(links, "rep", "left").join(parts, "rep", "left")
    out = linked.unionByName(members.where("rep is null").withColumns({"links": F.lit(None).cast("long"), "component": F.lit(None).cast("long")}))
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "rep", "id"))
    out = out.select(F.col("id").alias("vec_id"), (F.coalesce(F.col("n") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))).alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
