"""Bound-certified best-fit packing of documents into fixed-length token sequences.

Documents are tokenised once; from then on only lengths travel. Pieces are dealt
to partitions of a few thousand, each packed by best-fit decreasing and certified
by a lower bound from dual-feasible functions. Partitions whose bin count exceeds
their bound (a gap) exchange pieces: their unfilled bins are pooled, a few
partitions at a time, and packed again; the better packing is kept, so a round
never adds a sequence. Neither the driver nor a task ever holds more than one pool.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm._common import written
from trolley.llm.tokens import default_vocabulary, encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", part long, bin long, offset long, bins long, lower_bound long"


def token_pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = 2048) -> DataFrame:
    """One row per piece of at most ``capacity`` ids (a document's ids, then id 0).

    Null text counts as empty and yields the single id 0. Of a longer document the
    first piece takes the remainder and all others are full.
    """
    path = vocabulary or default_vocabulary()

    def cut(batches):
        encode, _ = encoder(path)
        for batch in batches:
            doc, piece, start, length, crc = [], [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "")
                ids.append(0)
                data = np.array(ids, dtype="<u4")
                n, at = len(data), 0
                step = n - (-(-n // capacity) - 1) * capacity
                k = 0
                while at < n:
                    doc.append(doc_id)
                    piece.append(k)
                    start.append(at)
                    length.append(step)
                    crc.append(zlib.crc32(data[at : at + step].tobytes()))
                    at, k, step = at + step, k + 1, capacity
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc, pa.int64()),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def lower_bound(lengths, capacity: int) -> int:
    """Bins that no packing of ``lengths`` can do without.

    The best of the volume bound, the threshold family (items above capacity - t
    count whole, those below t not at all) and the rounding family
    u_k(x) = floor((k + 1) x) / k; all are dual feasible.
    """
    sizes = np.asarray(lengths, dtype=np.int64)
    if not len(sizes):
        return 0
    count = np.bincount(sizes, minlength=capacity + 1)
    size = np.arange(capacity + 1)
    volume = np.concatenate(([0], np.cumsum(count * size)))
    number = np.concatenate(([0], np.cumsum(count)))
    best = -(-int(volume[-1]) // capacity)
    half = capacity // 2
    t = np.arange(0, half + 1)
    large = number[-1] - number[capacity - t + 1]
    middle = number[capacity - t + 1] - number[half + 1]
    free = middle * capacity - (volume[capacity - t + 1] - volume[half + 1])
    small = volume[half + 1] - volume[t]
    best = max(best, int((large + middle + np.maximum(0, -(-(small - free) // capacity))).max()))
    for k in range(1, 33):
        whole = (k + 1) * size % capacity == 0
        value = np.where(whole, size * k, (k + 1) * size // capacity * capacity)
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset, bins) of each item; ties in order of arrival.

    Open bins stand by the room they have left, and a bit mask of the rooms in use
    finds the tightest fit in one step.
    """
    order = np.argsort(-np.asarray(lengths, dtype=np.int64), kind="stable")
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, bins = 0, 0
    to, offset = np.zeros(len(order), dtype=np.int64), np.zeros(len(order), dtype=np.int64)
    for i, n in zip(order.tolist(), np.asarray(lengths)[order].tolist(), strict=True):
        fits = mask >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            chosen = rooms[room].pop()
            if not rooms[room]:
                mask ^= 1 << room
        else:
            room, chosen = capacity, bins
            bins += 1
        to[i], offset[i] = chosen, capacity - room
        left = room - n
        if left:
            rooms[left].append(chosen)
            mask |= 1 << left
    return to, offset, bins


def _pack_part(capacity: int):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece", "start", "ids_crc32"], kind="stable")
        to, offset, bins = best_fit_decreasing(pdf["length"].to_numpy(), capacity)
        return pdf.assign(bin=to, offset=offset, bins=bins, lower_bound=lower_bound(pdf["length"], capacity))

    return pack


def _exchange(capacity: int):
    def again(pdf: pd.DataFrame) -> pd.DataFrame:
        """Pack the pool of several partitions; keep the result only if it needs fewer bins."""
        pdf = pdf.sort_values(["doc_id", "piece", "start", "ids_crc32"], kind="stable")
        before = int(pdf.groupby(["part", "bin"]).ngroups)
        to, offset, bins = best_fit_decreasing(pdf["length"].to_numpy(), capacity)
        bound = lower_bound(pdf["length"], capacity)
        if bins < before:
            pdf = pdf.assign(part=pdf["pool"], bin=to, offset=offset)
        return pdf.assign(bins=min(bins, before), lower_bound=bound).drop(columns=["pool"])

    return again


def pack_pieces(
    pieces: DataFrame, capacity: int = 2048, part_rows: int = 2500, rounds: int = 2, pool_parts: int = 4
) -> DataFrame:
    """Place every piece: adds ``sequence_id`` and ``offset``.

    ``pieces`` must be a written table: it is read more than once. Full pieces are
    sequences of their own. Columns ``bins`` and ``lower_bound`` certify the
    partition (or pool) a piece was packed in last. Empty input gives no rows.
    """
    spark = pieces.sparkSession
    own = ["doc_id", "piece", "start", "length", "ids_crc32"]
    full = pieces.filter(F.col("length") == capacity)
    rest = pieces.filter(F.col("length") < capacity)
    parts = max(1, -(-rest.count() // part_rows))
    packed = (
        rest.withColumn("part", F.pmod(F.xxhash64(*own), F.lit(parts)).cast("long"))
        .groupBy("part")
        .applyInPandas(_pack_part(capacity), PACKED)
    )
    settled = []
    for k in range(1, rounds + 1):
        packed = written(packed, f"packed{k}")
        fill = packed.groupBy("part", "bin").agg(F.sum("length").alias("fill"))
        loose = packed.join(fill, ["part", "bin"]).withColumn(
            "loose", (F.col("bins") > F.col("lower_bound")) & (F.col("fill") < capacity)
        )
        settled.append(loose.filter(~F.col("loose")).select(*packed.columns))
        pools = max(1, parts // pool_parts**k)
        packed = (
            loose.filter("loose")
            .withColumn("pool", -(F.lit(k * 2**32) + F.pmod(F.xxhash64("part", F.lit(k)), F.lit(pools))) - 1)
            .select(*packed.columns, "pool")
            .groupBy("pool")
            .applyInPandas(_exchange(capacity), PACKED)
        )
    for done in settled:
        packed = packed.unionByName(done)
    placed = packed.select(
        *own, (F.col("part") * F.lit(2**20) + F.col("bin")).alias("sequence_id"), "offset", "bins", "lower_bound"
    )
    alone = full.select(
        *own,
        (F.lit(2**61) + F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.lit(1).cast("long").alias("bins"),
        F.lit(1).cast("long").alias("lower_bound"),
    )
    return placed.unionByName(alone)


def pack_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = 2048) -> DataFrame:
    """Tokenise and pack ``docs``: every id of every document is in exactly one sequence."""
    return pack_pieces(written(token_pieces(docs, vocabulary, capacity), "pieces"), capacity)
