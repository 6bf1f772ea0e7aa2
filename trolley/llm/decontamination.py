"""Benchmark decontamination with one Aho-Corasick automaton.

The benchmark's windows of ten words are the automaton's patterns. A text is
lower-cased (A-Z) and reduced to words in one pass over its bytes; that keeps byte
offsets, so hit words map back to the original text. The text is scanned once.
The automaton is bounded: a benchmark above ``max_chars`` is scanned for in shards of
that size and the hits of a document are united afterwards.
"""

from __future__ import annotations

from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.sources.shared import written

WINDOW = 10
#: Characters of one automaton, which takes some 110 bytes of a worker's memory for each: 440 MB.
MAX_CHARS = 4_000_000
#: Lower-cases A-Z, keeps digits, letters and all bytes of non-ASCII characters, blanks the rest.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
HITS = "_row long, doc_id long, n_words long, hit array<long>, spans array<long>, items array<string>"


def fold_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


class Shard:
    """Items of a benchmark, whose automaton each Python worker builds once.

    Patterns are sequences of word numbers: of ten words a window has ten nodes, whatever
    the words' lengths.
    """

    def __init__(self, items: list[tuple[str | None, str]]):
        self.items = items
        self.machine = None

    def __getstate__(self):
        return {"items": self.items, "machine": None}

    def built(self) -> Shard:
        if self.machine is not None:
            return self
        import ahocorasick

        self.number: dict[bytes, int] = {}
        self.shortest = WINDOW
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for item_id, text in self.items:
            own = tuple(self.number.setdefault(w, len(self.number) + 1) for w in fold_words(text))
            self.shortest = min(self.shortest, len(own) or WINDOW)
            for i in range(max(1, len(own) - WINDOW + 1) if own else 0):
                window = own[i : i + WINDOW]
                held = self.machine.get(window, None)
                if held is None:
                    held = (len(window), [])
                    self.machine.add_word(window, held)
                if item_id is not None and item_id not in held[1]:
                    held[1].append(item_id)
        if len(self.machine):
            self.machine.make_automaton()
        return self

    def hits(self, words: list[bytes]):
        """(number of the last word, (words, items)) of each window in a text.

        Only runs of words of the benchmark that are as long as its shortest window are
        passed to the automaton: no window lies outside them.
        """
        if not len(self.machine):
            return
        own = np.fromiter(map(self.number.get, words, repeat(0)), dtype=np.int64, count=len(words))
        gaps = np.flatnonzero(own == 0)
        starts, ends = np.append(0, gaps + 1), np.append(gaps, len(own))
        for k in np.flatnonzero(ends - starts >= self.shortest):
            start = int(starts[k])
            for last, found in self.machine.iter(tuple(own[start : ends[k]].tolist())):
                yield start + last, found


def _scan(shard):
    def scan(batches):
        machine = shard.value.built()
        for batch in batches:
            rows, ids = batch.column(0), batch.column(1)
            n_words, hits, spans, found = [], [], [], []
            for text in batch.column(2):
                data = (text.as_py() or "").encode().translate(FOLD)
                words = data.split()
                n_words.append(len(words))
                hit = None
                held: set[str] = set()
                for last, (n, own) in machine.hits(words):
                    if hit is None:
                        hit = np.zeros(len(words), dtype=bool)
                    hit[last - n + 1 : last + 1] = True
                    held.update(own)
                at = np.zeros(0, np.int64) if hit is None else np.flatnonzero(hit)
                hits.append(at.tolist())
                spans.append(_original(data, at) if len(at) else [])
                found.append(sorted(held))
            yield pa.RecordBatch.from_arrays(
                [
                    rows,
                    ids,
                    pa.array(n_words, pa.int64()),
                    pa.array(hits, pa.list_(pa.int64())),
                    pa.array(spans, pa.list_(pa.int64())),
                    pa.array(found, pa.list_(pa.string())),
                ],
                ["_row", "doc_id", "n_words", "hit", "spans", "items"],
            )

    return scan


def _original(data: bytes, words: np.ndarray) -> list[int]:
    """start, end, start, end... in code points of the original text of runs of hit ``words``."""
    byte = np.frombuffer(data, dtype=np.uint8)
    inside = np.concatenate(([False], byte != 32, [False]))
    starts, ends = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(~inside[1:] & inside[:-1])
    letter = np.concatenate(([0], np.cumsum((byte & 0xC0) != 0x80)))
    breaks = np.flatnonzero(np.diff(words) > 1)
    first, last = words[np.r_[0, breaks + 1]], words[np.r_[breaks, len(words) - 1]]
    return np.stack([letter[starts[first]], letter[ends[last]]], axis=1).ravel().tolist()


def _shards(benchmark: DataFrame, max_chars: int):
    """Broadcasts of shards, each of about ``max_chars`` characters at most; one at a time passes the driver."""
    context = benchmark.sparkSession.sparkContext
    items = benchmark.filter("text is not null").select(F.col("item_id").cast("string"), "text")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = -(-chars // max_chars) or 1
    for k in range(shards):
        own = items.filter(F.pmod(F.xxhash64("text"), F.lit(shards)) == k) if shards > 1 else items
        yield context.broadcast(Shard([tuple(r) for r in own.toLocalIterator()])), k == shards - 1


def find_contamination(docs: DataFrame, benchmark: DataFrame, max_chars: int = MAX_CHARS) -> DataFrame:
    """One row per document row: _row, doc_id, n_words, hit word numbers, spans, items.

    ``spans`` holds start and end of each run of hit words in the original text.
    Null text has no words; null benchmark texts no windows; item ids are compared
    as strings. Repeated documents and items are each counted on their own. Of a
    benchmark above ``max_chars`` characters the shards are scanned for one after the
    other, each one's hits written before the next is sent out.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col("doc_id").cast("long"), "text"
    )
    parts = []
    for shard, last in _shards(benchmark, max_chars):
        own = rows.mapInArrow(_scan(shard), HITS)
        if not last:
            own = written(own, "hits")
            shard.destroy()
        parts.append(own)
    found = reduce(DataFrame.unionByName, parts)
    if len(parts) > 1:
        merged = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
        found = found.groupBy("_row", "doc_id", "n_words").agg(
            merged("hit"), F.flatten(F.collect_list("spans")).alias("spans"), merged("items")
        )
    return found


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return find_contamination(docs, benchmark).select(
        "doc_id",
        "n_words",
        F.size("hit").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("hit") > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, max_chars: int = MAX_CHARS) -> DataFrame:
    """``docs`` without the rows that hold a benchmark window; all columns as they are.

    The automaton runs inside the scan of the documents: nothing is shuffled, and
    rows without an id are judged like others. Shards follow one another as in
    ``find_contamination``.
    """
    at = docs.columns.index("text")

    def keep(shard):
        def clean(batches):
            machine = shard.value.built()
            for batch in batches:
                mask = [next(machine.hits(fold_words(text.as_py())), None) is None for text in batch.column(at)]
                yield batch.filter(pa.array(mask, pa.bool_()))

        return clean

    for shard, last in _shards(benchmark, max_chars):
        docs = docs.mapInArrow(keep(shard), docs.schema)
        if not last:
            docs = written(docs, "clean")
            shard.destroy()
    return docs
