"""Token counts of fields or sections, from one encoding of the whole document.

A document is encoded once. Byte-level BPE loses nothing, so the running sum of
token byte lengths gives every token's span in the original text, and the spans
are joined with the section intervals by binary search where they are made: only
counts leave the task. A token that crosses a boundary goes whole to the section
that holds most of its bytes, the earlier one if they tie.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.llm.tokens import default_vocabulary, encoder

COUNTS = "doc_id long, section int, start long, end long, n_tokens long, n_crossing long"


def _byte_offsets(data: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Byte offsets of code-point offsets in UTF-8 ``data``."""
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    return np.append(starts, len(data))[np.minimum(cuts, len(starts))]


def count_spans(sizes: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, crossing tokens) of each interval between ``cuts`` (byte offsets)."""
    n = len(cuts) - 1
    ends = np.cumsum(sizes)
    starts = ends - sizes
    first = np.searchsorted(cuts, starts, side="right") - 1
    last = np.searchsorted(cuts, ends - 1, side="right") - 1
    first, last = np.minimum(first, n - 1), np.minimum(last, n - 1)
    crossing = np.zeros(n, dtype=np.int64)
    for i in np.flatnonzero(first != last):
        a, b = int(first[i]), int(last[i])
        edges = np.clip(cuts[a : b + 2], starts[i], ends[i])
        first[i] = a + int(np.argmax(np.diff(edges)))
        crossing[first[i]] += 1
    return np.bincount(first, minlength=n), crossing


def line_cuts(data: np.ndarray) -> np.ndarray:
    """Byte offsets at which the lines of UTF-8 ``data`` begin, and its end; a line keeps its newline."""
    return np.concatenate(([0], np.flatnonzero(data == 10) + 1, [len(data)]))


def attribute_tokens(docs: DataFrame, vocabulary: str | None = None, cuts: str | None = None) -> DataFrame:
    """A row for each section of each document.

    ``docs`` has doc_id and text. ``cuts`` names a column with an increasing array of
    code-point offsets from 0; section i lies between cuts i and i + 1. Nulls in it are
    passed over, offsets beyond the text moved to its end; where it is null the text is one
    section. Without ``cuts``, lines are the sections. Null text counts as empty: one
    section, no tokens. Token counts of a document's sections add up to its tokens.
    Repeated rows are counted each.
    """
    path = vocabulary or default_vocabulary()

    def count(batches):
        encode, sizes = encoder(path)
        for batch in batches:
            out = [[], [], [], [], [], []]
            for k, doc_id in enumerate(batch.column(0).to_pylist()):
                text = batch.column(1)[k].as_py() or ""
                data = np.frombuffer(text.encode(), dtype=np.uint8)
                if cuts is None:
                    at = line_cuts(data)
                    places = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[at]
                else:
                    given = [x for x in batch.column(2)[k].as_py() or (0, len(text)) if x is not None]
                    places = np.clip(np.asarray(given or [0], dtype=np.int64), 0, len(text))
                    places = np.append(places, len(text)) if len(places) < 2 else places
                    places[-1] = len(text)
                    at = _byte_offsets(data, places)
                n = len(at) - 1
                tokens = sizes[np.array(encode(text), dtype=np.int64)] if text else np.zeros(0, np.int64)
                got, crossing = count_spans(tokens, at) if text else ([0] * n, [0] * n)
                for column, values in zip(
                    out,
                    ([doc_id] * n, range(n), places[:-1].tolist(), places[1:].tolist(), got, crossing),
                    strict=True,
                ):
                    column.extend(values)
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(out, kinds, strict=True)],
                ["doc_id", "section", "start", "end", "n_tokens", "n_crossing"],
            )

    given = [] if cuts is None else [F.col(cuts).cast("array<long>")]
    return docs.select(F.col("doc_id").cast("long"), "text", *given).mapInArrow(count, COUNTS)


def joined_fields(docs: DataFrame, fields: list[str], separator: str = "\n") -> DataFrame:
    """doc_id, text, cuts: the fields of a row as one document, each but the last with the separator behind it.

    Fields are cast to strings; null counts as empty. Section i of the attribution is field i.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields]
    parts = [F.concat(p, F.lit(separator)) for p in parts[:-1]] + parts[-1:]
    ends = [reduce(Column.__add__, [F.length(p) for p in parts[: i + 1]]) for i in range(len(parts))]
    cuts = F.array(F.lit(0), *ends).cast("array<long>")
    return docs.select("doc_id", F.concat(*parts).alias("text"), cuts.alias("cuts"))


def section_intervals(docs: DataFrame, sections: DataFrame) -> DataFrame:
    """doc_id, text, cuts: offsets from a table (doc_id, end) of section ends.

    Ends outside the text are moved to its end; a last section closes the text.
    """
    ends = sections.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.col("end").cast("long"))).alias("ends"))
    size = F.length(F.coalesce("text", F.lit(""))).cast("long")
    inner = F.filter(F.coalesce("ends", F.array().cast("array<long>")), lambda x: (x > 0) & (x < size))
    return (
        docs.select("doc_id", "text")
        .join(ends, "doc_id", "left")
        .select("doc_id", "text", F.concat(F.array(F.lit(0).cast("long")), inner, F.array(size)).alias("cuts"))
    )
