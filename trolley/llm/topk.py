"""Exact inner-product search: vectors by descending length, pruned by residual bounds.

Components become the integers floor(1024 x). Candidates are dealt into blocks of
falling norm; queries into blocks of bounded size and like needs. A query block meets
the candidate blocks whose longest vector can still reach its lowest floor, each once.
A rotation (the eigenvectors of the Gram matrix, which are the right singular vectors of
the data) puts most of a vector's length into its first coordinates: the partial product of those plus the product of the residual lengths
bounds the score (Cauchy-Schwarz), and only pairs whose bound reaches the query's
k-th best so far get their exact integer product.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trolley.llm._common import written

SCALE = 1024
BLOCK = 8192
QUERIES = 1024
STEP = 512
#: Query blocks whose needs are broadcast, 24 bytes each.
MOST_NEEDS = 1_000_000
#: The longest candidates, which every query meets first.
SEEDS = 2048
#: Vectors that the rotation is fitted to, at most about, and the tasks that add up their products.
SAMPLE, GRAM_TASKS = 200_000, 8
#: Products of integers stay exact in doubles below this.
EXACT = 2.0**52
LONG = 2**63 - 1


def _integers(batches):
    for batch in batches:
        lists = batch.column(1)
        offsets = lists.offsets.to_numpy()
        flat = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
        ids, dims, norms, packed = [], [], [], []
        for i, vec_id in enumerate(batch.column(0).to_pylist()):
            own = flat[offsets[i] : offsets[i + 1]]
            if vec_id is None or not lists[i].is_valid or not np.isfinite(own).all():
                continue
            own = np.floor(own * SCALE)
            if not np.isfinite(own).all():
                continue
            ids.append(vec_id)
            dims.append(len(own))
            norms.append(float(np.linalg.norm(own)))
            packed.append(own.tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(norms, pa.float64()), pa.array(packed, pa.binary())],
            ["vec_id", "dim", "norm", "vec"],
        )


def _gram(dim: int):
    def gram(batches):
        total = np.zeros((dim, dim))
        for batch in batches:
            rows = [np.frombuffer(x) for x in batch.column(0).to_pylist()]
            if rows:
                own = np.stack(rows)
                own = own / np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-300)
                total += own.T @ own
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["gram"])

    return gram


def _rotation(base: DataFrame) -> dict[int, np.ndarray]:
    """Eigenvectors for the commonest dimension; any orthogonal matrix keeps the bounds valid.

    They are fitted to about ``SAMPLE`` vectors, drawn by a hash of their ids, in
    ``GRAM_TASKS`` tasks, each of which sends one packed matrix.
    """
    common = base.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if common is None or not 1 < common["dim"] <= 2048:
        return {}
    dim, parts = common["dim"], 1_000_000
    share = min(parts, -(-SAMPLE * parts // common["count"]))
    drawn = base.filter((F.col("dim") == dim) & (F.pmod(F.xxhash64("vec_id"), F.lit(parts)) < share))
    gram = np.zeros((dim, dim))
    for row in drawn.select("vec").repartition(GRAM_TASKS).mapInArrow(_gram(dim), "gram binary").toLocalIterator():
        gram += np.frombuffer(row["gram"]).reshape(dim, dim)
    _, vectors = np.linalg.eigh((gram + gram.T) / 2)
    return {dim: np.ascontiguousarray(vectors[:, ::-1])}


def _blocks(batches):
    """Consecutive vectors of one dimension, ``BLOCK`` at most, as one row with the largest norm."""
    for batch in batches:
        ids, dims, norms = (batch.column(i).to_numpy() for i in range(3))
        vecs = batch.column(3).to_pylist()
        out = [[], [], [], []]
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            for k in range(0, len(at), BLOCK):
                own = at[k : k + BLOCK]
                row = int(dim), float(norms[own].max()), ids[own].astype("<i8").tobytes(), b"".join(vecs[i] for i in own)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
        kinds = pa.int32(), pa.float64(), pa.binary(), pa.binary()
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, kind) for x, kind in zip(out, kinds, strict=True)], ["dim", "longest", "ids", "vecs"]
        )


def _products(q: np.ndarray, c: np.ndarray, limit: float) -> np.ndarray:
    """Exact products of the rows of ``q`` with those of ``c``."""
    if limit < EXACT:
        return (q @ c.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in c]
    out = np.empty((len(q), len(c)), dtype=np.int64)
    for i, row in enumerate(q):
        own = [int(x) for x in row]
        out[i] = [max(-LONG, min(LONG, sum(map(int.__mul__, own, x)))) for x in whole]
    return out


def search_block(q_ids, q, floor, c_ids, c, k: int, rotation: np.ndarray | None):
    """Rows (query, candidate, score): each query's k best of one block.

    ``floor`` is a score that k other candidates are known to reach (or -inf). What
    ties with the k-th best is kept if its id is smaller.
    """
    best: list[list[tuple[int, int]]] = [[] for _ in q_ids]
    floor = np.array(floor, dtype=np.float64)
    order = np.lexsort((c_ids, -np.linalg.norm(c, axis=1)))
    c_ids, c = c_ids[order], c[order]
    q_norm, c_norm = np.linalg.norm(q, axis=1), np.linalg.norm(c, axis=1)
    head = max(1, q.shape[1] // 4)
    rq, rc = (q, c) if rotation is None else (q @ rotation, c @ rotation)
    q_rest, c_rest = np.linalg.norm(rq[:, head:], axis=1), np.linalg.norm(rc[:, head:], axis=1)
    slack = 1e-9
    for at in range(0, len(c), STEP):
        stop = min(at + STEP, len(c))
        room = q_norm * c_norm[at] * slack + 1e-6
        live = np.flatnonzero(q_norm * c_norm[at] + room >= floor)
        if not len(live):
            break
        bound = rq[live, :head] @ rc[at:stop, :head].T + np.outer(q_rest[live], c_rest[at:stop]) + room[live, None]
        open_ = bound >= floor[live, None]
        rows = np.flatnonzero(open_.any(axis=1))
        if not len(rows):
            continue
        columns = np.flatnonzero(open_[rows].any(axis=0))
        limit = float(q_norm[live[rows]].max() * c_norm[at])
        scores = _products(q[live[rows]], c[at:stop][columns], limit)
        own_ids = c_ids[at:stop][columns]
        for r, i in enumerate(live[rows]):
            keep = np.flatnonzero(open_[rows[r], columns] & (scores[r] >= floor[i]) & (own_ids != q_ids[i]))
            if not len(keep):
                continue
            if len(keep) > k:
                keep = keep[np.lexsort((own_ids[keep], -scores[r, keep]))[:k]]
            both = best[i] + [(-int(scores[r, x]), int(own_ids[x])) for x in keep]
            best[i] = sorted(both)[:k]
            if len(best[i]) == k:
                floor[i] = max(floor[i], -best[i][-1][0])
    for i, own in enumerate(best):
        for score, c_id in own:
            yield int(q_ids[i]), c_id, -score


def _search(k: int, rotations: dict[int, np.ndarray]):
    def search(batches):
        for batch in batches:
            out = [[], [], []]
            for dim, ids, vecs, queries in zip(*(batch.column(i) for i in range(4)), strict=True):
                dim, queries = dim.as_py(), queries.as_py()
                c = np.frombuffer(vecs.as_py()).reshape(-1, dim) if dim else np.zeros((len(ids.as_py()) // 8, 0))
                q = np.stack([np.frombuffer(x["vec"]) for x in queries])
                floor = [-np.inf if x["floor"] is None else x["floor"] for x in queries]
                q_ids = np.array([x["vec_id"] for x in queries])
                got = search_block(q_ids, q, floor, np.frombuffer(ids.as_py(), "<i8"), c, k, rotations.get(dim))
                for row in got:
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["query_id", "vec_id", "score"])

    return search


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of every query.

    Both tables have vec_id and embedding. Null ids and vectors that are null or hold
    null or non-finite components take no part; vectors meet those of their own
    dimension. Candidates of the query's own id are left out, ties go to the smaller
    id, repeated candidates count each, repeated queries once. Scores beyond a long are
    held at its limits. Without queries or candidates there are no rows.
    """
    columns = "vec_id long, dim int, norm double, vec binary"
    base = written(vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(_integers, columns), "vectors")
    asked = (
        queries.select(F.col("vec_id").cast("long"), "embedding")
        .mapInArrow(_integers, columns)
        .dropDuplicates(["vec_id", "vec"])
    )
    asked = written(asked, "queries")
    rotations = _rotation(base)
    n, m = base.count(), asked.count()
    shape = "dim int, longest double, ids binary, vecs binary"
    falling = [F.desc("norm"), F.asc("vec_id")]
    blocks = written(
        base.repartitionByRange(max(1, -(-n // BLOCK)), *falling)
        .sortWithinPartitions(*falling)
        .mapInArrow(_blocks, shape)
        .withColumn("block", F.monotonically_increasing_id()),
        "blocks",
    )
    groups = max(1, -(-m // QUERIES))
    found_rows = "query_id long, vec_id long, score long"

    def packed(asked: DataFrame) -> DataFrame:
        """Query blocks of up to about ``QUERIES``, with the norm below which no candidate serves any of their queries."""
        return asked.groupBy("qb", "dim").agg(
            F.collect_list(F.struct("vec_id", "vec", "floor")).alias("queries"),
            F.min(F.coalesce("need", F.lit(0.0))).alias("need"),
        )

    # The longest candidates give every query a floor: a score that k of them reach.
    longest = F.broadcast(base.orderBy(*falling).limit(SEEDS).mapInArrow(_blocks, shape))
    unknown = F.lit(None).cast("double")
    spread = asked.withColumn("qb", F.pmod(F.xxhash64("vec_id"), F.lit(groups))).withColumns({"floor": unknown, "need": unknown})
    seeds = packed(spread).join(longest, "dim").select("dim", "ids", "vecs", "queries").mapInArrow(_search(k, rotations), found_rows)
    floors = seeds.groupBy(F.col("query_id").alias("vec_id")).agg(
        F.when(F.count("*") >= k, F.min("score").cast("double")).alias("floor")
    )
    # By Cauchy-Schwarz a candidate needs a norm of floor / |query|, less what rounding may take.
    need = F.when((F.col("floor") > 0) & (F.col("norm") > 0), F.col("floor") / F.col("norm") * (1 - 1e-9) - 1e-6)
    told = asked.join(floors, "vec_id", "left").withColumn("need", F.coalesce(need, F.lit(0.0)))
    # Queries of like needs share a block, so blocks of short candidates are passed over by whole query blocks.
    told = told.repartitionByRange(groups, "need", "vec_id").withColumn("qb", F.spark_partition_id())
    packs = written(packed(told), "packs")
    # One row of three numbers for each query block: few enough to send out, unless there are a thousand million queries.
    needs = packs.select("qb", "need", F.col("dim").alias("q_dim"))
    needs = F.broadcast(needs) if groups <= MOST_NEEDS else needs
    reached = (F.col("dim") == F.col("q_dim")) & (F.col("longest") >= F.col("need"))
    pairs = blocks.select("block", "dim", "longest").join(needs, reached).select("block", "dim", "qb")
    met = pairs.join(blocks.drop("dim", "longest"), "block").join(packs.drop("need"), ["qb", "dim"])
    found = met.select("dim", "ids", "vecs", "queries").mapInArrow(_search(k, rotations), found_rows)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int"), "vec_id", "score")
    )
