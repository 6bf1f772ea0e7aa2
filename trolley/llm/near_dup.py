"""Near-duplicate classes with ProbMinHash, banding and exact verification.

Elements are five-word shingles weighted by 1 + ln(count). Each element's points of a
Poisson process fall on random registers; a register keeps the element whose point
comes first, and an element stops as soon as its next point is later than the latest
register (early termination). Two signatures agree in a register with the probability
Jaccard similarity of the texts. A link needs an exact Jaccard of the shingle sets of 0.8
or more, and counts can make the probability Jaccard of such texts as low as one likes;
so a text that repeats a shingle has the bands of unit weights besides those of its
counts. Texts that agree in a whole band of registers are candidates if two bits of each
register of unit weights agree as often as the least similarity makes likely.

Within a bucket no pairs are listed. Its members are first compared with two leaders, the
ones whose buckets are fullest, and links unite components. The members of buckets that
are still mixed are dealt into buckets of longer bands of a finer signature. There, the
members outside a bucket's largest component become leaders, so many at a time, until what
is left of the bucket is in one component. Every pair that shares a short and a long band
is thus compared or known to be in one class. What is compared grows as leaders times
members of a long band's bucket; only pairs that pass the sketches become rows. A bucket of
many members is dealt over several tasks, each with all its leaders.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.llm._common import written
from trolley.llm.decontamination import FOLD
from trolley.operators.components import SALTS, connected_components

WORDS = 5
LEAST = 0.8
BANDS, ROWS = 25, 5
REGISTERS = BANDS * ROWS
#: Most registers in which two texts' two-bit sketches of unit weights may differ: 0.8 alike differ in 19 of 125, and 40 is five deviations away.
MOST_APART = 40
SKETCH = ("s0", "s1", "s2", "s3")
#: Buckets that the first leaders leave mixed are dealt anew by longer bands of a finer signature: a pair at 0.8 shares none of 64
#: bands of eight registers with probability 8e-6, one at 0.4 shares some with probability 0.04.
FINE_REGISTERS, FINE_BANDS, FINE_ROWS = 1024, 64, 8
#: Of the finer sketch's registers 0.8 alike differ in 154, and 199 is four deviations away.
FINE_APART = 199
FINE = tuple(f"f{i}" for i in range(2 * FINE_REGISTERS // 64))
#: Leaders of a bucket in each round: of the short bands, then of the longer ones; the last number serves all later rounds.
LEADERS = (2, 16, 4096)
#: A bucket is dealt over one task more for each so many members.
SPLIT = 4096
#: Bits of the bitmap of ids whose texts are read again: 2 to 32 MB, 16 bits for each of up to 16 million; of more, ids are joined.
BITMAP_BITS = (1 << 24, 1 << 28)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]), 1 << 14)
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers


def word_hashes(text: str) -> np.ndarray:
    """64-bit polynomial hashes of the words (A-Z lower-cased; letters, digits and all non-ASCII)."""
    data = np.frombuffer(text.encode().translate(FOLD), dtype=np.uint8)
    inside = np.empty(len(data) + 2, dtype=bool)
    inside[0] = inside[-1] = False
    np.not_equal(data, 32, out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    powers, inverses = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data * powers[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64))


def shingles(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes, counts); a text of one to four words is one shingle."""
    words = word_hashes(text) if text else np.zeros(0, np.uint64)
    if not len(words):
        return words, np.zeros(0, np.int64)
    n = min(WORDS, len(words))
    total = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        total = total * np.uint64(0xD6E8FEB86659FD93) + words[i : len(words) - n + 1 + i]
    return np.unique(mix(total), return_counts=True)


def prob_min_hash(elements: np.ndarray, weights: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """The element of each register.

    Arrivals are drawn a block of steps at a time for all elements still running;
    they depend on element and step only.
    """
    first = np.full(registers, np.inf)
    owner = np.zeros(registers, np.uint64)
    now = np.zeros(len(elements))
    step = 0
    while len(elements):
        steps = max(1, -(-4 * registers // len(elements)))
        draws = mix(elements[:, None] + np.arange(step + 1, step + 1 + steps, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
        gaps = -np.log(((draws >> np.uint64(32)).astype(np.float64) + 0.5) / 2**32)
        times = np.cumsum(gaps, axis=1) / weights[:, None] + now[:, None]
        place = ((draws & np.uint64(0xFFFFFFFF)) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
        open_ = times < first.max()
        at, which, who = times[open_], place[open_], np.nonzero(open_)[0]
        order = np.argsort(-at, kind="stable")
        best, best_owner = np.full(registers, np.inf), np.zeros(registers, np.uint64)
        best[which[order]] = at[order]
        best_owner[which[order]] = elements[who[order]]
        better = best < first
        first[better], owner[better] = best[better], best_owner[better]
        now = times[:, -1]
        going = now < first.max()
        elements, weights, now = elements[going], weights[going], now[going]
        step += steps
    return owner


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    rows = signature.reshape(bands, -1)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(rows.shape[1]):
        key = mix(key * np.uint64(0xD6E8FEB86659FD93) + rows[:, i])
    return key.astype(np.int64)


def sketch(signature: np.ndarray) -> np.ndarray:
    """Two bits of every register as longs, first all of one bit, then all of the other.

    The bits are hashed from the element and the register, so two elements that share the
    bits of one register need not share those of another, however few elements a text has.
    """
    bits = mix(signature ^ mix(np.arange(1, len(signature) + 1, dtype=np.uint64)))
    planes = [np.packbits(((bits >> np.uint64(i)) & np.uint64(1)).astype(np.uint8)) for i in (0, 1)]
    return np.concatenate([np.pad(x, (0, -len(x) % 16)) for x in planes]).view(np.int64)


def _sign(batches):
    for batch in batches:
        sizes, keys, sketches = [], [], []
        for text in batch.column(2):
            elements, counts = shingles(text.as_py())
            sizes.append(len(elements))
            if len(elements):
                signature = prob_min_hash(elements, np.ones(len(elements)))
                own = band_keys(signature)
                if counts.max() > 1:
                    own = np.union1d(own, band_keys(prob_min_hash(elements, 1 + np.log(counts))))
                keys.append(own.tolist())
                sketches.append(sketch(signature))
            else:
                keys.append([])
                sketches.append(np.zeros(4, np.int64))
        planes = np.array(sketches, dtype=np.int64).reshape(-1, 4)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(sizes, pa.int32()),
                pa.array(keys, pa.list_(pa.int64())),
                *(pa.array(np.ascontiguousarray(planes[:, i])) for i in range(4)),
            ],
            ["doc_id", "digest", "size", "keys", *SKETCH],
        )


def _id_bitmap(nodes: DataFrame, bits: int) -> np.ndarray:
    """Bits of the hashed ids, or-ed together by Spark in rows of 4 KB; at most 32 MB come back, in one job."""
    spot = F.pmod(F.xxhash64("node"), F.lit(bits))
    rows = (
        nodes.select(spot.alias("spot"))
        .groupBy(F.bitmap_bucket_number("spot").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits"))
        .collect()
    )
    size = 4096
    out = np.zeros((bits // (8 * size) + 2) * size, np.uint8)
    for row in rows:
        out[row["bucket"] * size : (row["bucket"] + 1) * size] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return out


def _shingle_sets(bitmap=None):
    def sets(batches):
        for batch in batches:
            if bitmap is not None:
                bucket, bit = batch.column(2).to_numpy(), batch.column(3).to_numpy()
                byte = bitmap.value[bucket * 4096 + bit // 8]
                batch = batch.filter(pa.array((byte >> (bit % 8).astype(np.uint8)) & 1 == 1, pa.bool_()))
            own = [shingles(text.as_py())[0].tobytes() for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.binary())], ["node", "set"])

    return sets


def _crowded_sets(plain: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, set) of the documents that share a bucket, at least.

    The texts are read once more. A bitmap of the ids spares shuffling them; what it lets
    through besides does no harm. Of more ids than it has room for, ids and texts are joined.
    """
    number = nodes.count()
    bits = max(BITMAP_BITS[0], 1 << (16 * number).bit_length())
    texts = plain.filter("doc_id is not null")
    if bits > BITMAP_BITS[1]:
        own = texts.join(nodes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi").select("doc_id", "text")
        return written(own.mapInArrow(_shingle_sets(), "node long, set binary"), "sets")
    bitmap = plain.sparkSession.sparkContext.broadcast(_id_bitmap(nodes, bits))
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    texts = texts.select("doc_id", "text", F.bitmap_bucket_number(spot).alias("bucket"), F.bitmap_bit_position(spot).alias("bit"))
    out = written(texts.mapInArrow(_shingle_sets(bitmap), "node long, set binary"), "sets")
    bitmap.destroy()
    return out


_FINE_COLUMNS = "node long, size int, keys array<long>, " + ", ".join(f"{c} long" for c in FINE)


def _fine_sketches(batches):
    for batch in batches:
        rows, keys, sizes = [], [], []
        for data in batch.column(1):
            elements = np.frombuffer(data.as_py(), np.uint64)
            signature = prob_min_hash(elements, np.ones(len(elements)), FINE_REGISTERS)
            rows.append(sketch(signature))
            keys.append(band_keys(signature[: FINE_BANDS * FINE_ROWS], FINE_BANDS).tolist())
            sizes.append(len(elements))
        planes = np.array(rows, dtype=np.int64).reshape(-1, len(FINE))
        columns = [pa.array(np.ascontiguousarray(planes[:, i])) for i in range(len(FINE))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int32()), pa.array(keys, pa.list_(pa.int64())), *columns],
            ["node", "size", "keys", *FINE],
        )


def _compare(batches):
    for batch in batches:
        keep = []
        for a, b in zip(batch.column(2), batch.column(3), strict=True):
            a, b = np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)
            both = np.concatenate((a, b))
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            keep.append(common >= LEAST * (len(both) - common) - 1e-9)
        yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])


def _verify(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Of the pairs (a, b) whose shingle sets reach the least similarity, the components (a, b) that they unite."""
    own = lambda c: sets.select(F.col("node").alias(c), F.col("set").alias(f"set_{c}"))
    return (
        pairs.join(own("a"), "a")
        .join(own("b"), "b")
        .select(F.col("of_a").alias("a"), F.col("of_b").alias("b"), "set_a", "set_b")
        .mapInArrow(_compare, "a long, b long")
    )


def _all_parts(rows: DataFrame) -> DataFrame:
    """A row of each bucket for each part that the bucket's members are dealt over."""
    return rows.withColumn("salt", F.explode(F.expr(f"sequence(0, n div {SPLIT})")))


def _own_part(members: DataFrame) -> DataFrame:
    return members.withColumn("salt", F.expr(f"pmod(xxhash64(node, 1), 1 + n div {SPLIT})"))


def _crowded(nodes: DataFrame) -> DataFrame:
    """(node, popularity, held): the keys that several of ``nodes`` (node, keys) hold, with the number of their holders."""
    held = nodes.select("node", F.explode("keys").alias("key"))
    counts = held.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    return (
        held.join(counts, "key")
        .groupBy("node")
        .agg(F.sum("n").alias("popularity"), F.collect_list(F.struct("key", "n")).alias("held"))
    )


def _buckets(crowded: DataFrame) -> DataFrame:
    """A row for each of the keys of ``crowded`` (node, popularity, held, component)."""
    return crowded.select("node", "popularity", "component", F.explode("held").alias("x")).select(
        "x.key", "node", "x.n", "popularity", "component", F.lit(None).cast("long").alias("main")
    )


def _mixed(members: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component, each with its bucket's largest one as ``main``."""
    groups = members.groupBy("key", "component").agg(F.count("*").alias("held"), F.max("n").alias("n"))
    main = groups.groupBy("key").agg(
        F.count("*").alias("parts"), F.max("n").alias("n"), F.max(F.struct("held", "component")).alias("main")
    )
    main = _all_parts(main.filter("parts > 1").select("key", "n", F.col("main.component").alias("main"))).drop("n")
    return _own_part(members.drop("main")).join(main, ["key", "salt"]).select("key", "node", "n", "popularity", "component", "main")


def _leaders(members: DataFrame, most: int) -> DataFrame:
    """Members of each bucket from outside its largest component: all of a bucket of up to ``most``, else so many, the fullest-bucketed first."""
    slot = F.when(F.col("n") <= most, F.col("node")).otherwise(F.pmod(F.xxhash64("node"), F.lit(most)))
    salted = members.filter("main is null or component <> main").withColumn("own", slot)
    best = salted.groupBy("key", "own").agg(
        F.max(F.struct("popularity", (-F.col("node")).alias("order"), "component", "n")).alias("best")
    )
    return best.select(
        "key", (-F.col("best.order")).alias("leader"), F.col("best.component").alias("own"), F.col("best.n").alias("n")
    )


def _candidates(members: DataFrame, leaders: DataFrame, sketches: DataFrame, most_apart: int) -> DataFrame:
    """(a, b, of_a, of_b), a above b, with their components: members and leaders of one bucket not of one class that may be alike.

    Copies share most of their buckets. A member and a leader make a row in one only, that
    with the smallest of the keys that the leader leads and the member has.
    """
    own_keys = members.groupBy("node").agg(F.collect_set("key").alias("keys"))
    led = leaders.groupBy("leader").agg(F.collect_set("key").alias("led"))
    planes = [c for c in sketches.columns if c not in ("node", "size")]
    told = [F.col("node").alias("leader"), F.col("size").alias("l_size"), *[F.col(c).alias(f"l_{c}") for c in planes]]
    apart = [F.col(c).bitwiseXOR(F.col(f"l_{c}")) for c in planes]
    half = len(planes) // 2
    far = reduce(Column.__add__, [F.bit_count(x.bitwiseOR(y)) for x, y in zip(apart[:half], apart[half:], strict=True)])
    near = F.least("size", "l_size") >= LEAST * F.greatest("size", "l_size") - 1e-9
    m = _own_part(members).select(F.col("key").alias("m_key"), F.col("salt").alias("m_salt"), "node", "component")
    m = m.join(sketches.join(own_keys, "node"), "node")
    on = (
        (F.col("m_key") == F.col("key"))
        & (F.col("m_salt") == F.col("salt"))
        & (F.col("node") != F.col("leader"))
        & (F.col("component") != F.col("own"))
        & near
        & (far <= most_apart)
        & (F.col("key") == F.array_min(F.array_intersect("keys", "led")))
    )
    met = m.join(_all_parts(leaders.join(sketches.select(*told).join(led, "leader"), "leader")), on)
    pair = [(F.col("node"), F.col("component")), (F.col("leader"), F.col("own"))]
    ends = [F.struct(node.alias("node"), part.alias("of")) for node, part in pair]
    met = met.select(F.greatest(*ends).alias("a"), F.least(*ends).alias("b"))
    return met.select(F.col("a.node").alias("a"), F.col("b.node").alias("b"), F.col("a.of").alias("of_a"), F.col("b.of").alias("of_b")).distinct()


def duplicate_classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id: one row per row of ``docs``; a class is named by its smallest doc_id.

    Rows of one id count as one document. Equal non-empty texts are one class whatever
    they hold; null and empty texts and rows without an id (class null) link to
    nothing. A text without words has no shingles and is linked to equal texts only.
    """
    plain = docs.select(F.col("doc_id").cast("long"), "text")
    digest = F.when(F.length("text") > 0, F.unhex(F.sha2("text", 256)))
    base = written(
        plain.select("doc_id", digest.alias("digest"), "text").mapInArrow(
            _sign, "doc_id long, digest binary, size int, keys array<long>, s0 long, s1 long, s2 long, s3 long"
        ),
        "signatures",
    )
    known = base.filter("doc_id is not null and digest is not null")
    same = written(known.groupBy("digest").agg(F.min("doc_id").alias("node")), "texts")
    own = known.join(same, "digest").select("doc_id", "node")
    alike = own.filter("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    nodes = known.join(same, (known["digest"] == same["digest"]) & (known["doc_id"] == same["node"])).select(
        "node", "size", "keys", *SKETCH
    )
    crowded = written(_crowded(nodes), "crowded")
    members = _buckets(crowded.withColumn("component", F.col("node")))
    sketches = written(nodes.drop("keys").join(crowded, "node", "left_semi").dropDuplicates(["node"]), "sketches")
    sets = _crowded_sets(plain, crowded.select("node"))
    most_apart = MOST_APART
    for k in count():
        if members.isEmpty():
            break
        leaders = written(_leaders(members, LEADERS[min(k, len(LEADERS) - 1)]), f"leaders{k}")
        pairs = written(_candidates(members, leaders, sketches, most_apart), f"pairs{k}")
        united = connected_components(_verify(sets, pairs), written)
        some = not united.isEmpty()
        if some:
            alike = alike.unionByName(united.select(F.col("node").alias("a"), F.col("component").alias("b")))
        if k:
            rest = members.join(leaders.select("key", F.col("leader").alias("node")), ["key", "node"], "left_anti")
        else:
            left = written(_mixed(_united(members, united)).select("node").distinct(), "left")
            tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            fine = sets.join(left, "node").select("node", "set").repartition(tasks, "node")
            fine = fine.mapInArrow(_fine_sketches, _FINE_COLUMNS)
            fine = written(fine.dropDuplicates(["node"]), "fine")
            sketches, most_apart = fine.drop("keys"), FINE_APART
            rest = _buckets(_crowded(fine).withColumn("component", F.col("node")))
        members = written(_mixed(written(_united(rest, united) if some else rest, f"rest{k}")), f"members{k}")
    classes = connected_components(alike, written)
    return (
        base.select("doc_id")
        .join(classes, F.col("doc_id") == F.col("node"), "left")
        .select("doc_id", F.coalesce("component", "doc_id").alias("class_id"))
    )


def _united(members: DataFrame, united: DataFrame) -> DataFrame:
    """``members`` with their components replaced by those of ``united`` (node, component), which names components as nodes.

    The members of one component are dealt over several tasks.
    """
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    now = united.select(F.col("node").alias("component"), F.col("component").alias("now"), salts)
    own = members.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    return own.join(now, ["component", "salt"], "left").withColumn("component", F.coalesce("now", "component")).drop("salt", "now")


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class: the one whose id names it. Rows without an id stay.

    Of rows that share an id one stays; texts are compared by id only where ids repeat.
    """
    dropped = duplicate_classes(docs).filter("doc_id <> class_id").select("doc_id").distinct()
    named = docs.filter("doc_id is not null")
    kept = named.join(dropped, "doc_id", "left_anti").select(*docs.columns)
    if not named.groupBy("doc_id").count().filter("count > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id"])
    return kept.unionByName(docs.filter("doc_id is null"))
