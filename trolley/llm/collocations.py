"""Word phrases that occur together more often than their parts, from a weighted de Bruijn graph.

Nodes are phrases of three words, edges phrases of four. Tasks count the edges of their
texts, join edges over nodes that have one way in and one way out of equal weight to
paths, and send paths; their edges are added up by Spark. Where a phrase is not followed by
a longer one, as at the end of a piece, a correction is sent: a node's count is the flow
out of it plus its corrections, and in the same way the counts of two words and of one follow.

Most neighbouring words are rare together. A first pass counts words and pairs in buckets of
a fixed number, a second one three words whose pairs may be frequent; what lies in a bucket
below the least count cannot be part of any phrase that is asked for, so text is cut
there too. Rare words are sent as one sum. Corrections keep all counts that are asked for
exact, and a full bucket costs work, never rows.

Only a language's best phrases are asked for, and most frequent phrases score far too low. A
score is a count over a sum of counts, and all are sums over groups: a phrase that reaches a
score over all texts reaches it in one group at least. So groups mark what reaches a floor there,
with its parts, and only what is marked, or is around it, is counted. Where ``k`` phrases of a
language reach the floor, they are its best; other languages are counted without a floor.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trolley.llm._common import written

#: Words of the longest phrase.
LONGEST = 4
#: A score of 1.
WHOLE = 2_000_000
#: Parts of a group that are ranked before the group is.
RANKED_PARTS = 64
#: Where pieces end.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_BYTES = bytes(46 if b in PIECE_ENDS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))


@dataclass(frozen=True)
class Sizes:
    """Words counted together in a task; bytes of text cut into words at once; buckets of pairs (as a power of
    two: their bits, 32 MB for each of two passes, are broadcast) and ranges they are added up in. None of them changes a result."""

    group: int = 1 << 21
    slice: int = 1 << 22
    bucket_bits: int = 28
    range_bits: int = 8


class _Numbers(dict):
    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def _word_numbers(text: str, numbers: _Numbers, size: int) -> list[np.ndarray]:
    """Numbers of the words in order, 0 where a piece ends and at the end."""
    data = text.encode().translate(_BYTES)
    out, at = [], 0
    while at < len(data):
        stop = at + size
        if stop < len(data):
            ends = [x for x in (data.find(b" ", stop), data.find(b".", stop)) if x >= 0]
            stop = min(ends, default=len(data))
        words = data[at:stop].replace(b".", b" . ").split()
        out.append(np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words)))
        at = stop
    return [*out, np.zeros(1, dtype=np.int64)]


class _Bits:
    """Bits that are sent, and lie on disks, compressed."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def __reduce__(self):
        return _unzipped, (zlib.compress(self.bits.tobytes(), 1),)


def _unzipped(data: bytes) -> _Bits:
    return _Bits(np.frombuffer(zlib.decompress(data), dtype=np.uint8))


def _hit(bits: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    return (bits[bucket >> 3] >> (7 - (bucket & 7)).astype(np.uint8)) & 1 > 0


def _next(mask: np.ndarray) -> np.ndarray:
    return np.append(mask[1:], False)


class _Group:
    """Words of consecutive documents: numbers, the language's number of each, and what they stand for."""

    def __init__(self, sizes: Sizes):
        self.sizes = sizes
        self.numbers, self.langs = _Numbers({b".": 0}), _Numbers()
        self.parts: list[np.ndarray] = []
        self.of: list[tuple[int, int]] = []
        self.size = 0

    def add(self, lang: str, text: str) -> None:
        got = _word_numbers(text, self.numbers, self.sizes.slice)
        self.parts += got
        n = sum(map(len, got))
        self.of.append((self.langs[lang], n))
        self.size += n

    def close(self) -> None:
        self.word = np.concatenate(self.parts)
        self.lang = np.repeat(*(np.array(x) for x in zip(*self.of, strict=True)))
        self.words = list(self.numbers)
        self.lang_names = list(self.langs)
        self.hashed = np.array([xxhash.xxh3_64_intdigest(w) for w in self.words], dtype=np.uint64)
        self.seeds = np.array([xxhash.xxh3_64_intdigest(x, 1) for x in self.lang_names], dtype=np.uint64)

    def _mixed(self, lang: np.ndarray, first: np.ndarray, second: np.ndarray | int) -> np.ndarray:
        """The bucket of two hashes in a language."""
        own, other = self.hashed[first], second if isinstance(second, np.ndarray) else np.uint64(second)
        mixed = (own * np.uint64(0x9E3779B97F4A7C15) + self.seeds[lang]) ^ (other >> np.uint64(7))
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + other
        mixed *= np.uint64(0x94D049BB133111EB)
        return (mixed >> np.uint64(64 - self.sizes.bucket_bits)).astype(np.int64)

    def buckets(self) -> np.ndarray:
        """The bucket of each word with the next, or -1 at the end of a piece."""
        both = (self.word[:-1] > 0) & (self.word[1:] > 0)
        return np.append(np.where(both, self._mixed(self.lang[:-1], self.word[:-1], self.hashed[self.word[1:]]), -1), -1)

    def word_buckets(self, lang: np.ndarray, word: np.ndarray) -> np.ndarray:
        return self._mixed(lang, word, 1)

    def triple_buckets(self, at: np.ndarray) -> np.ndarray:
        second = self.hashed[self.word[at + 1]] * np.uint64(0xFF51AFD7ED558CCD) + (self.hashed[self.word[at + 2]] >> np.uint64(3))
        return self._mixed(self.lang[at], self.word[at], second)

    def phrase_buckets(self, at: np.ndarray, n: int) -> np.ndarray:
        """The bucket of the ``n`` words from each place on."""
        if n == 1:
            return self.word_buckets(self.lang[at], self.word[at])
        if n == 2:
            return self._mixed(self.lang[at], self.word[at], self.hashed[self.word[at + 1]])
        if n == 3:
            return self.triple_buckets(at)
        second = self.hashed[self.word[at + 1]] * np.uint64(0xC4CEB9FE1A85EC53) + (self.hashed[self.word[at + 2]] >> np.uint64(3))
        second = (second ^ (second >> np.uint64(31))) * np.uint64(0xFF51AFD7ED558CCD) + (self.hashed[self.word[at + 3]] >> np.uint64(5))
        return self._mixed(self.lang[at], self.word[at], second)

    def frequent(self, pairs: np.ndarray, triples: np.ndarray) -> list[np.ndarray]:
        """Whether a word, two, three and four words that may be frequent begin at each place; words all count."""
        joined = self.joined(pairs)
        tripled = joined & _next(joined)
        at = np.flatnonzero(tripled)
        tripled[at] = _hit(triples, self.triple_buckets(at))
        return [self.word > 0, joined, tripled, tripled & _next(tripled)]

    def counted(self, pairs: np.ndarray, triples: np.ndarray, marked: np.ndarray | None) -> list[np.ndarray]:
        """Whether a phrase of one to four words that is to be counted begins at each place: a frequent one or,
        with marks, a marked one and what lies around marked ones of two words and more."""
        out = self.frequent(pairs, triples)
        at = np.flatnonzero(out[0])
        out[0][at] = _hit(pairs if marked is None else marked, self.phrase_buckets(at, 1))
        around = np.zeros(len(self.word), dtype=bool)
        for n in range(2, LONGEST + 1) if marked is not None else ():
            around |= _next(around)
            at = np.flatnonzero(out[n - 1])
            own = around.copy()
            own[at] |= _hit(marked, self.phrase_buckets(at, n))
            out[n - 1] &= own
            around |= out[n - 1]
        return out

    def marks(self, pairs: np.ndarray, triples: np.ndarray, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the phrases of two to four words whose cuts' inequalities for ``floor``, added up, hold in
        this group, and of their parts."""
        here = self.frequent(pairs, triples)
        f, number, reach = [], None, []
        for n, own in enumerate(here, 1):
            at = np.flatnonzero(own)
            if n == 1:
                key = self.lang[at] * len(self.words) + self.word[at]
            else:
                key = number[at] * (number.max(initial=0) + 1) + number[at + 1]
            _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
            number, count = np.zeros(len(own), dtype=np.int64), np.zeros(len(own), dtype=np.int64)
            number[at], count[at] = inverse, times[inverse]
            f.append(count)
            parts = sum((f[i - 1][at] + f[n - i - 1][at + i] for i in range(1, n)), np.zeros(len(at), dtype=np.int64))
            won = np.zeros(len(own), dtype=bool)
            won[at] = (WHOLE * (n - 1) * count[at] >= floor * parts) if n > 1 else False
            reach.append(won)
        for n in range(LONGEST - 1, 0, -1):
            reach[n - 1] |= reach[n] | np.append(False, reach[n][:-1])
        bucket = np.unique(np.concatenate([self.phrase_buckets(np.flatnonzero(own), n) for n, own in enumerate(reach, 1)]))
        return bucket, np.ones(len(bucket), dtype=np.int64)

    def joined(self, pairs: np.ndarray) -> np.ndarray:
        """Whether each word and the next may be a frequent pair."""
        bucket = self.buckets()
        out = bucket >= 0
        out[out] = _hit(pairs, bucket[out])
        return out

    def bucket_counts(self, pairs: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """(bucket, occurrences) of pairs and words, or of three words whose pairs may be frequent."""
        if pairs is not None:
            joined = self.joined(pairs)
            return np.unique(self.triple_buckets(np.flatnonzero(joined[:-1] & joined[1:])), return_counts=True)
        pairs, n_pairs = np.unique((b := self.buckets())[b >= 0], return_counts=True)
        key = (self.lang * len(self.words) + self.word)[self.word > 0]
        words, n_words = np.unique(key, return_counts=True)
        bucket = np.concatenate((pairs, self.word_buckets(words // len(self.words), words % len(self.words))))
        order = np.argsort(bucket, kind="stable")
        bucket, n = bucket[order], np.concatenate((n_pairs, n_words))[order]
        starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else bucket
        return bucket[starts], np.add.reduceat(n, starts) if len(starts) else n

    def phrases(self, at: np.ndarray, n: int | np.ndarray) -> list[str]:
        """The ``n`` words from each place on, joined by blanks."""
        words, ids = self.words, self.word
        n = np.broadcast_to(n, len(at))
        return [b" ".join([words[x] for x in ids[a : a + k].tolist()]).decode() for a, k in zip(at.tolist(), n.tolist(), strict=True)]


def _groups(batches, sizes: Sizes) -> Iterator[_Group]:
    """A text longer than a group has a group of its own."""
    group = _Group(sizes)
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = text.as_py() or ""
            if group.size and (group.size >= sizes.group or len(text) > sizes.group):
                group.close()
                yield group
                group = _Group(sizes)
            group.add(lang, text)
    if group.size:
        group.close()
        yield group


def _packed(rising: np.ndarray) -> bytes:
    """Rising numbers by their differences, first all lowest bytes, then the next ones."""
    apart = np.diff(rising, prepend=0).astype("<u4")
    return zlib.compress(np.ascontiguousarray(apart.view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64))


def _count_buckets(least: int, sizes: Sizes, of_group):
    within = sizes.bucket_bits - sizes.range_bits

    def count(batches):
        for group in _groups(batches, sizes):
            bucket, n = of_group(group)
            cuts = np.searchsorted(bucket, np.arange((1 << sizes.range_bits) + 1) << within)
            low, n = bucket & ((1 << within) - 1), np.minimum(n, least).astype("<u2")
            rows = [(r, _packed(low[a:b]), zlib.compress(n[a:b].tobytes(), 1)) for r, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if a < b]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)], ["range", "low", "n"])

    return count


def _add_buckets(least: int, sizes: Sizes):
    """Bits of the buckets of each range that reach ``least``; counts stop there. Rows come range by range."""
    size = 1 << (sizes.bucket_bits - sizes.range_bits)

    def packed(of: int, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([of], pa.int32()), pa.array([np.packbits(counts >= least).tobytes()])], ["range", "bits"])

    def add(batches):
        of, counts = -1, np.zeros(0, dtype=np.uint16)
        for batch in batches:
            for r, low, n in zip(*(batch.column(i) for i in range(3)), strict=True):
                if r.as_py() != of:
                    if of >= 0:
                        yield packed(of, counts)
                    of, counts = r.as_py(), np.zeros(size, dtype=np.uint16)
                at = _unpacked(low.as_py())
                counts[at] = np.minimum(counts[at].astype(np.uint32) + np.frombuffer(zlib.decompress(n.as_py()), dtype="<u2"), least)
        if of >= 0:
            yield packed(of, counts)

    return add


def _frequent_buckets(texts: DataFrame, least: int, sizes: Sizes, of_group) -> _Bits:
    """A bit for each bucket of ``least`` occurrences by what ``of_group`` finds in groups; 32 MB whatever the input."""
    counted = texts.mapInArrow(_count_buckets(least, sizes, of_group), "range int, low binary, n binary")
    rows = counted.repartition("range").sortWithinPartitions("range").mapInArrow(_add_buckets(least, sizes), "range int, bits binary")
    size = 1 << (sizes.bucket_bits - sizes.range_bits - 3)
    bits = np.zeros((1 << sizes.range_bits, size), dtype=np.uint8)
    for row in rows.toLocalIterator():
        bits[row["range"]] = np.frombuffer(row["bits"], dtype=np.uint8)
    return _Bits(bits.reshape(-1))


def _paths(group: _Group, tripled: np.ndarray, edges: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, words, weight) of the compacted paths of the group's graph.

    ``tripled``: whether a node, three words that may be frequent, begins at a word; ``edges``:
    whether an edge to be counted does, all between two nodes if not given. Edges that follow each other over a node with one way in and one out, with equal weights and
    side by side at the first place where they occur, make one path: its words stand in
    the text from that place on.
    """
    word, none = group.word, np.zeros(0, dtype=np.int64)
    at = np.flatnonzero(tripled & _next(tripled) if edges is None else edges)
    if not len(at):
        return none, none, none
    pair_at = np.unique(np.concatenate((at, at + 1, at + 2)))
    vocabulary = len(group.words)
    pair_key = (group.lang[pair_at] * vocabulary + word[pair_at]) * vocabulary + word[pair_at + 1]
    pairs, inverse = np.unique(pair_key, return_inverse=True)
    pair = np.full(len(word) + 2, -1)
    pair[pair_at] = inverse
    _, first, weight = np.unique(pair[at] * len(pairs) + pair[at + 2], return_index=True, return_counts=True)
    place = at[first]
    order = np.argsort(place)
    place, weight = place[order], weight[order]
    head, tail = pair[place] * len(pairs) + pair[place + 1], pair[place + 1] * len(pairs) + pair[place + 2]
    _, node = np.unique(np.concatenate((head, tail)), return_inverse=True)
    head, tail = node[: len(place)], node[len(place) :]
    out, into = np.bincount(head, minlength=node.max() + 1), np.bincount(tail, minlength=node.max() + 1)
    linked = (place[1:] == place[:-1] + 1) & (weight[1:] == weight[:-1]) & (out[tail[:-1]] == 1) & (into[tail[:-1]] == 1)
    begins = np.flatnonzero(np.append(True, ~linked))
    edges = np.diff(np.append(begins, len(place)))
    return place[begins], edges + LONGEST - 1, weight[begins]


def _ends(group: _Group, counted: list[np.ndarray]) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """(places, words, weights) of phrases of one to three words that no longer one follows from the same place."""
    word, vocabulary = group.word, len(group.words)
    one, two, three, four = counted
    for n, here in ((1, (word > 0) & ~two & ~three & ~four), (2, two & ~three & ~four), (3, three & ~four)):
        at = np.flatnonzero(here)
        key = group.lang[at]
        for i in range(n):
            if i == 2:
                key = np.unique(key, return_inverse=True)[1]
            key = key * vocabulary + word[at + i]
        _, first, weight = np.unique(key, return_index=True, return_counts=True)
        yield at[first], n, weight


def _flows(pair_bits, triple_bits, marked_bits, sizes: Sizes):
    """Rows (lang, words, edge, weight): paths of the graph, and corrections; all words not counted together are ''."""

    def flows(batches):
        for group in _groups(batches, sizes):
            counted = group.counted(pair_bits.value.bits, triple_bits.value.bits, marked_bits and marked_bits.value.bits)
            for at, n, weight, edge in [(*_paths(group, counted[2], counted[3]), True), *[(*e, False) for e in _ends(group, counted)]]:
                if not edge and n == 1:
                    often = counted[0][at]
                    rest = np.bincount(group.lang[at[~often]], weight[~often], minlength=len(group.lang_names)).astype(np.int64)
                    rows = [group.lang_names, [""] * len(rest), [False] * len(rest), rest]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows], ["lang", "words", "edge", "weight"])
                    at, weight = at[often], weight[often]
                for a in range(0, len(at), 1 << 16):
                    own, size = at[a : a + (1 << 16)], n[a : a + (1 << 16)] if edge else n
                    langs = [group.lang_names[i] for i in group.lang[own].tolist()]
                    columns = [pa.array(langs, pa.string()), pa.array(group.phrases(own, size)), pa.array([edge] * len(own)), pa.array(weight[a : a + (1 << 16)])]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "words", "edge", "weight"])

    return flows


def _only_counted(pair_bits, triple_bits, marked_bits, sizes: Sizes):
    """Keeps rows (lang, phrase, size, f) of phrases counted for themselves, not only where a longer one begins with them."""

    def only(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            group = _Group(sizes)
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                group.add(lang, phrase)
            group.close()
            begins = np.cumsum([0, *[n for _, n in group.of[:-1]]])
            counted = np.stack(group.counted(pair_bits.value.bits, triple_bits.value.bits, marked_bits.value.bits))
            yield batch.filter(pa.array(counted[batch.column(2).to_numpy() - 1, begins]))

    return only


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")


def _frequent(texts: DataFrame, least: int, sizes: Sizes) -> tuple:
    """Broadcast bits of pairs and words, and of three words, that may be frequent."""
    sc = texts.sparkSession.sparkContext
    pairs = sc.broadcast(_frequent_buckets(texts, least, sizes, lambda group: group.bucket_counts(None)))
    return pairs, sc.broadcast(_frequent_buckets(texts, least, sizes, lambda group: group.bucket_counts(pairs.value.bits)))


def _counts(texts: DataFrame, bits: tuple, marked, least: int, sizes: Sizes) -> tuple[DataFrame, DataFrame]:
    """As ``phrase_counts``; with marks only of phrases that are marked or around marked ones."""
    flows = written(texts.mapInArrow(_flows(*bits, marked, sizes), "lang string, words string, edge boolean, weight long"), "flows")
    words = F.split("words", " ", -1)
    starts = F.sequence(F.lit(1), F.size(words) - (LONGEST - 1))
    edges = flows.filter("edge").select("lang", F.explode(F.transform(starts, lambda i: F.array_join(F.slice(words, i, LONGEST), " "))).alias("phrase"), F.col("weight").alias("f"))
    total = lambda df: df.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    counts = [written(total(edges), "edges")]
    ends = flows.filter(~F.col("edge")).select("lang", F.col("words").alias("phrase"), F.size(words).alias("size"), F.col("weight").alias("f"))
    for size in range(LONGEST - 1, 0, -1):
        flow = counts[-1].select("lang", F.substring_index("phrase", " ", size).alias("phrase"), "f")
        counts.append(written(total(flow.unionByName(ends.filter(F.col("size") == size).drop("size"))), f"counts{size}"))
    found = [c.filter((F.col("f") >= least) & (F.col("phrase") != "")).select("lang", "phrase", F.lit(LONGEST - i).alias("size"), "f") for i, c in enumerate(counts)]
    every = found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])
    if marked is not None:
        every = every.mapInArrow(_only_counted(*bits, marked, sizes), every.schema)
    return every, counts[-1].groupBy("lang").agg(F.sum("f").alias("n")).filter("n > 0")


def phrase_counts(docs: DataFrame, least: int = 30, sizes: Sizes = Sizes()) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, size, f) of all phrases of one to four words with f >= least, (lang, n) of all words;
    no row for a language without words).

    ``docs`` has text and lang; texts are lower-cased in A to Z, null text counts as empty and
    null lang as ``und``. Counts are exact and take in overlaps. Text is read three times
    and not shuffled.
    """
    texts = _texts(docs)
    return _counts(texts, _frequent(texts, least, sizes), None, least, sizes)


def _sub(phrase: Column, start: int, n: int) -> Column:
    return F.array_join(F.slice(F.split(phrase, " ", -1), start, n), " ")


def _long(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def collocations(
    docs: DataFrame, least: int = 30, inside: int = 80, k: int = 2000, sizes: Sizes = Sizes(), floors: tuple[int, ...] = (62_500,)
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``k`` best phrases of two to four words.

    a is the phrase's count, l and r those of its parts at the cut that scores lowest (the
    first one if tied), score floor(2,000,000 a / (l + r)), n all words of the language. A
    phrase stands back for any longer one around it with at least ``inside`` percent of its
    count. Order: score, a, phrase. Numbers are exact beyond 64 bits where they are products.
    Empty tables, and languages without such a phrase, have no rows; repeated rows count each.

    Falling scores in ``floors`` are tried first: a language with ``k`` phrases that reach one
    is done, any other is counted again, in the end whole. They change the work, not the result.
    """
    texts = left = _texts(docs)
    sc = docs.sparkSession.sparkContext
    bits = _frequent(texts, least, sizes)
    found = []
    for floor in (*floors, None):
        marked = None
        if floor is not None:
            marked = sc.broadcast(_frequent_buckets(left, 1, sizes, lambda group, floor=floor: group.marks(bits[0].value.bits, bits[1].value.bits, floor)))
        best = _best(*_counts(left, bits, marked, least, sizes), inside, k)
        if floor is None:
            found.append(best)
            break
        best = written(best, "best")
        done = best.filter((F.col("rank") == k) & (F.col("score") >= floor)).select("lang")
        found.append(best.join(F.broadcast(done), "lang", "left_semi"))
        left = left.join(F.broadcast(done), "lang", "left_anti")
        if left.select("lang").isEmpty():
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _best(counts: DataFrame, totals: DataFrame, inside: int, k: int) -> DataFrame:
    """Each language's ``k`` best phrases of those whose parts are all counted.

    Joins are by (lang, phrase) and one side has each key once, so adaptive execution can
    split the rows of a very frequent word; the best are ranked in parts before a language
    meets in one task.
    """
    counts = written(counts, "counts")
    candidates = counts.filter("size > 1")
    parts = [
        F.struct(_sub(F.col("phrase"), i, n).alias("part"), F.lit(size).alias("of"))
        for size in (3, 4) for n in range(2, size) for i in range(1, size - n + 2)
    ]
    longer = candidates.filter("size > 2").select("lang", F.explode(F.filter(F.array(*parts), lambda p: p["of"] == F.col("size"))).alias("p"), "f")
    longer = longer.groupBy("lang", F.col("p.part").alias("phrase")).agg(F.max("f").alias("f_longer"))
    hidden = _long(F.col("f_longer")) * 100 >= _long(F.col("f")) * inside
    kept = candidates.join(longer, ["lang", "phrase"], "left").filter(~F.coalesce(hidden, F.lit(False)))
    cuts = F.transform(
        F.sequence(F.lit(1), F.col("size") - 1),
        lambda i: F.struct(
            i.alias("at"),
            F.array_join(F.slice(F.split("phrase", " ", -1), F.lit(1), i), " ").alias("first"),
            F.array_join(F.slice(F.split("phrase", " ", -1), i + 1, F.col("size") - i), " ").alias("rest"),
        ),
    )
    cut = kept.select("lang", "phrase", F.col("f").alias("a"), F.explode(cuts).alias("c")).select("lang", "phrase", "a", "c.*")
    part = lambda name, f: counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cut = cut.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    score = F.expr(f"cast({WHOLE} as decimal(38,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + r)")
    scored = cut.withColumn("score", score).groupBy("lang", "phrase").agg(F.min_by(F.struct("a", "l", "r", "score"), F.struct("score", "at")).alias("m"), F.count("*").alias("cuts"))
    scored = scored.filter(F.col("cuts") == F.size(F.split("phrase", " ", -1)) - 1).select("lang", "phrase", "m.*")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = scored.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(RANKED_PARTS)))
    best = salted.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).filter(F.col("_r") <= k)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= k)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
