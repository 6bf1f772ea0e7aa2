"""License scan: MinHash bands over overlapping windows, then exact shingle containment.

Templates of similar length share a window size, so that a window covering an
occurrence is at most half as long again as the template. Each template and window has
``BANDS`` MinHash values, each a band of its own: with one row a band, a window that
holds the template is retrieved with probability 1 - (1 - J)^BANDS. A covering window
that holds four fifths of the template's shingles has a J of 0.39 or more, so that is
above 1 - 2e-7. A window and a template can agree in a
band only on a shingle that both hold, so windows without any template shingle are
passed over without hashing them; this loses no retrieval. Retrieved templates are
verified by the exact share of their shingles in the window.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.decontamination import FOLD
from trolley.llm.license_texts import TEMPLATES
from trolley.llm.near_dup import mix, word_hashes

WORDS = 5
LEAST = 0.8
BANDS = 32
FOUND = "doc_id long, n_matches long, licenses string, spans string"
_SEEDS = mix(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def run_shingles(words: np.ndarray) -> np.ndarray:
    """Hash of the five words from each place of a text; none for fewer words."""
    if len(words) < WORDS:
        return words[:0]
    total = np.full(len(words) - WORDS + 1, WORDS, np.uint64)
    for i in range(WORDS):
        total = total * np.uint64(0xD6E8FEB86659FD93) + words[i : len(words) - WORDS + 1 + i]
    return mix(total)


def min_hashes(windows: np.ndarray) -> np.ndarray:
    """(windows, BANDS) values of (windows, shingles) hashes."""
    return np.stack([mix(windows ^ seed).min(axis=1) for seed in _SEEDS], axis=1)


class Library:
    """Templates with their shingles, grouped by window size."""

    def __init__(self, templates: dict[str, str]):
        self.names = sorted(templates)
        runs = [run_shingles(word_hashes(templates[n])) for n in self.names]
        short = [n for n, r in zip(self.names, runs, strict=True) if not len(r)]
        if short:
            raise ValueError(f"templates need five words: {short}")
        self.sets = [np.unique(r) for r in runs]
        self.sizes = [len(r) + WORDS - 1 for r in runs]
        self.all = np.unique(np.concatenate(self.sets)) if runs else np.zeros(0, np.uint64)
        self.filter = np.zeros(1 << 16, dtype=bool)
        self.filter[(self.all & np.uint64(0xFFFF)).astype(np.int64)] = True
        self.groups: dict[int, list[int]] = {}
        for i, size in enumerate(self.sizes):
            # The size itself below 8, else the least of 8, 12, 16, 24, 32, 48, ... that holds the template.
            width = size if size < 8 else next(w for k in range(64) for w in (8 << k, 12 << k) if w >= size)
            self.groups.setdefault(width, []).append(i)
        self.hashes = [min_hashes(s[None, :])[0] for s in self.sets]

    def matches(self, text: str) -> list[tuple[str, int, int]]:
        """(name, first word, last word) of verified matches, the best window of each run of windows."""
        words = word_hashes(text)
        own = run_shingles(words)
        at = np.flatnonzero(self.filter[(own & np.uint64(0xFFFF)).astype(np.int64)])
        at = at[np.isin(own[at], self.all, assume_unique=False)] if len(at) else at
        if not len(at):
            return []
        out = []
        for width, members in self.groups.items():
            stride = max(1, width // 8)
            reach = width + stride - WORDS + 1
            first = np.maximum(0, at - reach + 1)
            lows = -(-first // stride)
            starts = np.unique(np.concatenate([np.arange(a, b + 1) for a, b in zip(lows, at // stride, strict=True)]))
            starts = starts * stride
            for k in range(0, len(starts), 256):
                part = starts[k : k + 256]
                cells = np.minimum(part[:, None] + np.arange(reach), len(own) - 1)
                cells = np.maximum(cells, 0)
                values = min_hashes(own[cells])
                for i in members:
                    for w in np.flatnonzero((values == self.hashes[i]).any(axis=1)):
                        inside = np.unique(cells[w])
                        held = inside[np.isin(own[inside], self.sets[i])]
                        # Only first occurrences count for the span: a second copy may begin in the window.
                        _, once = np.unique(own[held], return_index=True)
                        share = len(once) / len(self.sets[i])
                        if share >= LEAST - 1e-9:
                            held = held[once]
                            out.append((self.names[i], int(held.min()), int(held.max()) + WORDS, share))
        best: list[tuple[str, int, int, float]] = []
        for m in sorted(set(out), key=lambda m: (m[0], m[1], -m[3], m[2])):
            if best and best[-1][0] == m[0] and m[1] < best[-1][2]:
                if (m[3], -(m[2] - m[1])) > (best[-1][3], -(best[-1][2] - best[-1][1])):
                    best[-1] = m
            else:
                best.append(m)
        return [m[:3] for m in best]


@lru_cache(maxsize=4)
def _library(templates: tuple[tuple[str, str], ...]) -> Library:
    return Library(dict(templates))


def word_offsets(text: str) -> list[tuple[int, int]]:
    """Start and end in code points of every word."""
    data = np.frombuffer(text.encode().translate(FOLD), dtype=np.uint8)
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    inside = np.concatenate(([False], data != 32, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    letter = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    return list(zip(letter[edges[::2]].tolist(), letter[edges[1::2]].tolist(), strict=True))


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, n_matches, licenses, spans: one row per document row, over the whole text.

    ``licenses`` joins the distinct names found in order, ``spans`` every match as
    name:start:end in code points of the text. Null, empty and wordless texts have no
    match. Templates are a bounded parameter (about a thousand notices at most) and
    need five words each; an empty set matches nothing.
    """
    own = tuple(sorted((TEMPLATES if templates is None else templates).items()))

    def scan(batches):
        library = _library(own)
        for batch in batches:
            numbers, names, spans = [], [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                found = library.matches(text)
                numbers.append(len(found))
                names.append(",".join(sorted({n for n, _, _ in found})))
                if found:
                    words = word_offsets(text)
                    spans.append(",".join(f"{n}:{words[a][0]}:{words[b - 1][1]}" for n, a, b in found))
                else:
                    spans.append("")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(numbers, pa.int64()), pa.array(names, pa.string()), pa.array(spans, pa.string())],
                ["doc_id", "n_matches", "licenses", "spans"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, FOUND)
