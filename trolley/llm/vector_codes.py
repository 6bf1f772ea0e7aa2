"""Product quantisation of vectors: Lloyd's rounds over cover trees.

Vectors become integers and are cut into equal parts; each part position has a codebook
of a few entries. Every chunk of vectors gets one cover tree for each part position,
built once and written. A node is a run of points in tree order whose first point is its
centre, with the distance to the farthest one; running sums over that order give the sum
of any node. In a round a node goes whole to the entry nearest to its centre if, by the
triangle inequality, no other entry can be nearest to any of its points; else its children
are looked at, and at the leaves the points themselves, in exact integers.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm._common import written

SCALE = 4096
#: Vectors of a chunk, points of a leaf, children of a node at most (what is left over goes to the nearest one).
CHUNK, LEAF, CHILDREN = 4096, 16, 64
#: Tasks that add up the sums of all tasks.
ADDERS = 8
#: Labels whose sums are broadcast; beyond them the join is salted.
MOST_LABELS, SALTS = 100_000, 16
#: Products and sums of squares stay exact in doubles and in longs below these.
EXACT, LONG = 2.0**52, 2**63 - 1


@dataclass
class CoverTree:
    """``points`` in tree order, ``place`` of each in its chunk; per node: start, end, radius, first child, children."""

    points: np.ndarray
    place: np.ndarray
    start: np.ndarray
    end: np.ndarray
    radius: np.ndarray
    child: np.ndarray
    children: np.ndarray


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All numbers of the runs that begin at ``starts``."""
    before = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) + np.repeat(starts - before, counts)


def build_tree(points: np.ndarray, leaf: int = LEAF) -> CoverTree:
    """Level by level: a node's points are dealt to centres that lie more than half its radius apart.

    The first centre is the node's own. All nodes of a level are split side by side.
    """
    real = points.astype(np.float64)
    order = np.arange(len(points))
    levels, start, end = [], np.array([0]), np.array([len(points)])
    made = 1
    while len(start):
        own = np.repeat(np.arange(len(start)), end - start)
        here = real[order[_ranges(start, end - start)]]
        far = np.sqrt(((here - real[order[start]][own]) ** 2).sum(axis=1))
        radius = np.maximum.reduceat(far, np.cumsum(end - start) - (end - start)) if len(own) else np.zeros(len(start))
        split = (end - start > leaf) & (radius > 0)
        children = np.zeros(len(start), dtype=np.int64)
        at = np.flatnonzero(split)
        at_places = _ranges(start[at], (end - start)[at])
        owner = np.repeat(np.arange(len(at)), (end - start)[at])
        there, half = real[order[at_places]], (radius[at] / 2) ** 2
        group, nearest = np.full(len(owner), -1), np.full(len(owner), np.inf)
        near_group, free = np.zeros(len(owner), dtype=np.int64), np.arange(len(owner))
        centre = np.zeros(len(at), dtype=np.int64)
        for sweep in range(CHILDREN):
            if not len(free):
                break
            of = owner[free]
            first = np.append(True, of[1:] != of[:-1])
            centre[of[first]] = free[first]
            d = ((there[free] - there[centre[of]]) ** 2).sum(axis=1)
            closer = d < nearest[free]
            nearest[free[closer]], near_group[free[closer]] = d[closer], sweep
            inside = d <= half[of]
            group[free[inside]] = sweep
            free = free[~inside]
        group[free] = near_group[free]
        moved = np.lexsort((group, owner))
        order[at_places] = order[at_places[moved]]
        keys = owner[moved] * CHILDREN + group[moved]
        begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=np.int64)
        children[at] = np.bincount(owner[moved][begins], minlength=len(at))
        child = made + np.cumsum(children) - children
        levels.append((start, end, radius, child, children))
        made += len(begins)
        stops = np.append(begins[1:], len(keys))
        start, end = at_places[begins], at_places[stops - 1] + 1 if len(begins) else begins
    return CoverTree(points[order], order, *(np.concatenate(x) for x in zip(*levels, strict=True)))


def _squares(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of points (rows) to entries (columns)."""
    if points.dtype == object or book.dtype == object:
        return np.array([[sum((int(x) - int(y)) ** 2 for x, y in zip(p, c, strict=True)) for c in book] for p in points], dtype=object).reshape(len(points), len(book))
    most = max(int(np.abs(points).max(initial=0)), int(np.abs(book).max(initial=0)))
    kind = np.float64 if 4.0 * most**2 * max(1, points.shape[1]) < EXACT else np.int64
    p, c = points.astype(kind), book.astype(kind)
    out = (p**2).sum(axis=1)[:, None] - 2 * (p @ c.T) + (c**2).sum(axis=1)
    return out.astype(np.int64)


def assign(tree: CoverTree, book: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(starts, ends, entries): runs of points in tree order and the nearest entry, the lower index if tied."""
    _, first = np.unique(np.array([",".join(map(str, c)) for c in book]), return_index=True)
    first = np.sort(first)  # of equal entries the lowest index always wins
    own = book[first]
    if tree.points.dtype == object or own.dtype == object:
        n = np.arange(len(tree.points))
        yield n, n + 1, first[_squares(tree.points, own).argmin(axis=1)] if len(n) else n
        return
    front = np.zeros(1 if len(tree.points) else 0, dtype=np.int64)
    exact = []
    while len(front):
        squares = _squares(tree.points[tree.start[front]], own)
        best = squares.argmin(axis=1)
        far = np.sqrt(squares.astype(np.float64))
        near = far[np.arange(len(front)), best]
        far[np.arange(len(front)), best] = np.inf
        second, radius = far.min(axis=1), tree.radius[front]
        settled = (radius == 0) | (second - near > 2 * radius * (1 + 1e-9) + 1e-9 * (near + 1))
        yield tree.start[front[settled]], tree.end[front[settled]], first[best[settled]]
        open_ = front[~settled]
        leaf = tree.children[open_] == 0
        exact.append(open_[leaf])
        front = _ranges(tree.child[open_[~leaf]], tree.children[open_[~leaf]])
    left = np.concatenate(exact) if exact else front
    at = _ranges(tree.start[left], tree.end[left] - tree.start[left])
    if len(at):
        yield at, at + 1, first[_squares(tree.points[at], own).argmin(axis=1)]


def entry_sums(tree: CoverTree, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, counts) of the points nearest to each entry, as Python's integers."""
    kind = object if tree.points.dtype == object else np.int64
    running = np.concatenate((np.zeros((1, tree.points.shape[1]), dtype=kind), np.cumsum(tree.points.astype(kind), axis=0)))
    sums, counts = np.zeros(book.shape, dtype=kind), np.zeros(len(book), dtype=np.int64)
    for start, end, entry in assign(tree, book):
        np.add.at(sums, entry, running[end] - running[start])
        np.add.at(counts, entry, end - start)
    return sums.astype(object), counts.astype(object)


def _narrow(values: np.ndarray) -> np.ndarray:
    """Whole doubles in the smallest integer type in which sums of squares stay exact, else as Python's integers."""
    most = np.abs(values).max(initial=0.0)
    if most < 2**15:
        return values.astype(np.int16)
    if most < 2**26 and values.shape[1] < 2**8:
        return values.astype(np.int32)
    return np.array([[int(x) for x in row] for row in values], dtype=object).reshape(values.shape)


def _cuts(dim: int, parts: int) -> list[int]:
    return [dim * i // parts for i in range(parts + 1)]


def _chunks(dim: int, parts: int, chunk: int, leaf: int):
    """Rows (ids, labels, trees) of up to ``chunk`` consecutive vectors."""
    cuts = _cuts(dim, parts)

    def build(batches):
        held: list[pa.RecordBatch] = []

        def flush():
            rows = pa.Table.from_batches(held).combine_chunks()
            ids, labels, lists = (c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in rows.columns)
            whole = np.floor(lists.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), dim) * SCALE)
            trees = [build_tree(_narrow(whole[:, a:b]), leaf) for a, b in zip(cuts, cuts[1:], strict=False)]
            one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
            return pa.RecordBatch.from_arrays([one(ids), one(labels), pa.array([pickle.dumps(trees, protocol=5)], pa.binary())], ["ids", "labels", "trees"])

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                room = chunk - sum(x.num_rows for x in held)
                held.append(batch.slice(at, room))
                at += held[-1].num_rows
                if sum(x.num_rows for x in held) == chunk:
                    yield flush()
                    held.clear()
        if held:
            yield flush()

    return build


def _added(totals: list | None, more: list) -> list:
    return more if totals is None else [(a + c, b + d) for (a, b), (c, d) in zip(totals, more, strict=True)]


def _sums(books: list[np.ndarray]):
    def run(batches):
        totals = None
        for batch in batches:
            for packed in batch.column(0):
                totals = _added(totals, [entry_sums(t, b) for t, b in zip(pickle.loads(packed.as_py()), books, strict=True)])
        if totals is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(totals)], pa.binary())], ["sums"])

    return run


def _add(batches):
    totals = None
    for batch in batches:
        for packed in batch.column(0):
            totals = _added(totals, pickle.loads(packed.as_py()))
    if totals is not None:
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(totals)], pa.binary())], ["sums"])


def _book(values: np.ndarray) -> np.ndarray:
    """Entries as longs where the arithmetic of ``_squares`` allows, else as Python's integers."""
    small = all(abs(int(x)) < 2**26 for x in values.reshape(-1)) and values.shape[1] < 2**8
    return values.astype(np.int64) if small else values


def _coded(books: list[np.ndarray], label_type):
    def run(batches):
        for batch in batches:
            for k, packed in enumerate(batch.column(2)):
                trees = pickle.loads(packed.as_py())
                n = len(trees[0].points)
                codes, errors = np.zeros((n, len(books)), dtype=np.int64), np.zeros(n, dtype=object)
                for j, (tree, book) in enumerate(zip(trees, books, strict=True)):
                    own = np.zeros(n, dtype=np.int64)
                    for start, end, entry in assign(tree, book):
                        own[_ranges(start, end - start)] = np.repeat(entry, end - start)
                    wide = object if tree.points.dtype == object or book.dtype == object else np.int64
                    apart = tree.points.astype(wide) - book.astype(wide)[own]
                    codes[tree.place, j] = own
                    errors[tree.place] += (apart**2).sum(axis=1).astype(object)
                hexed = np.array([f"{i:02x}" for i in range(256)])[codes]
                rows = [
                    batch.column(0)[k].values, batch.column(1)[k].values,
                    pa.array(["".join(row) for row in hexed]), pa.array([min(int(x), LONG) for x in errors], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(rows, ["vec_id", "label", "code", "error"])

    return run


def _digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for book in books for row in book for x in row).encode()).hexdigest()


def compress_vectors(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, chunk: int = CHUNK, leaf: int = LEAF) -> DataFrame:
    """vec_id, code, error, label, codebooks_sha256 of every vector; at most 256 entries.

    ``vectors`` has vec_id, embedding and label (any type that can be a key; other columns
    take no part). Rows whose vector is null or holds null or non-finite components (also
    after scaling) are dropped; so are those of another dimension than the first row's by
    vec_id, then vector. Codebooks start with the first ``entries`` rows in that order, null
    ids last, fewer if there are fewer. A dimension that ``parts`` does not divide is cut as
    evenly as it goes, an empty vector has empty parts. Repeated rows count each. Errors
    beyond a long are held at its limit. Without vectors there are no rows.

    A round is one job over the written trees; its tasks send one packed table of sums each,
    which ``ADDERS`` tasks add up, so the driver gets that many tables of
    ``entries`` x (dimension + parts) numbers.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits an entry")
    wide = F.col("embedding").cast("array<double>")
    odd = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x * SCALE) == float("inf")))
    kept = vectors.select(F.col("vec_id").cast("long"), F.col("label"), wide.alias("embedding")).filter(wide.isNotNull() & ~odd)
    seeds = kept.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(entries).collect()
    label_type = vectors.schema["label"].dataType.simpleString()
    shape = f"vec_id long, label {label_type}, code string, error long"
    if not seeds:
        return vectors.sparkSession.createDataFrame([], shape).withColumn("codebooks_sha256", F.lit(None).cast("string"))
    dim = len(seeds[0]["embedding"])
    if any(len(r["embedding"]) != dim for r in seeds):
        seeds = kept.filter(F.size("embedding") == dim).orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(entries).collect()
    start = np.array([[int(x) for x in np.floor(np.array(r["embedding"]) * SCALE)] for r in seeds], dtype=object).reshape(len(seeds), dim)
    cuts = _cuts(dim, parts)
    books = [_book(start[:, a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
    rows = kept.filter(F.size("embedding") == dim).select("vec_id", "label", "embedding")
    trees = written(rows.mapInArrow(_chunks(dim, parts, chunk, leaf), f"ids array<long>, labels array<{label_type}>, trees binary"), "trees")
    for _ in range(rounds):
        sums = trees.select("trees").mapInArrow(_sums(books), "sums binary").repartition(ADDERS).mapInArrow(_add, "sums binary")
        totals = None
        for row in sums.collect():
            totals = _added(totals, pickle.loads(row["sums"]))
        books = [
            _book(np.array([[int(x) // int(n) for x in s] if n else [int(x) for x in old] for s, n, old in zip(*got, book, strict=True)], dtype=object).reshape(book.shape))
            for got, book in zip(totals, books, strict=True)
        ]
    return trees.mapInArrow(_coded(books, label_type), shape).withColumn("codebooks_sha256", F.lit(_digest(books)))


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Adds label_error, the error summed over equal labels (nulls together), held at the limits of a long."""
    coded = written(coded, "coded")
    least = lambda c: F.least(c, F.lit(LONG).cast("decimal(38,0)")).cast("long")
    totals = coded.groupBy(F.col("label").alias("_label")).agg(least(F.sum(F.col("error").cast("decimal(38,0)"))).alias("label_error"))
    totals = written(totals, "labels")
    same = F.col("label").eqNullSafe(F.col("_label"))
    if totals.count() <= MOST_LABELS:
        return coded.join(F.broadcast(totals), same).drop("_label")
    salted = coded.withColumn("_salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    totals = totals.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(totals, same & (F.col("_salt") == F.col("_s"))).drop("_label", "_salt", "_s")
