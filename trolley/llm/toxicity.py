"""Toxicity with a bidirectional gated recurrent network and attention pooling.

A word enters as its own vector (of words seen often enough in training) next to the
coordinatewise maximum of its character n-grams' vectors. Both directions run over windows of words,
attention pools their states, and a logistic unit scores the window. All overlapping
windows of a text are scored; the text takes the highest, calibrated on training
documents. The network is written and trained in numpy.

Labels say that a document is toxic, not where. Training therefore alternates: the
highest-scoring window of each toxic document is its example, and clean documents
give random windows and those that score highest.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.decontamination import FOLD
from trolley.llm.fitting import apart, fit_in_task

WINDOW, STRIDE = 48, 24
NGRAMS = 1 << 15
CHAR_DIM = WORD_DIM = 8
HIDDEN = 12
#: Windows that run through the network at once.
BATCH = 512
SCORED = "doc_id long, held_out boolean, score double, predicted int, n_windows long"


def split_words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(FOLD).split()


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def windows_of(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, start) of the windows that cover texts of so many words; none for no words."""
    number = np.where(lengths > 0, 1 + np.maximum(0, -(-(lengths - WINDOW) // STRIDE)), 0)
    doc = np.repeat(np.arange(len(lengths)), number)
    first = np.concatenate(([0], np.cumsum(number)[:-1])) if len(number) else number
    return doc, (np.arange(len(doc)) - np.repeat(first, number)) * STRIDE


def ngram_lists(words: list[bytes], part: int = 8192) -> tuple[np.ndarray, np.ndarray]:
    """(hashed byte 3- to 5-grams, word by word, with their edges; n-grams of each word), some words at a time."""
    parts = [_ngrams(words[i : i + part]) for i in range(0, max(1, len(words)), part)]
    return np.concatenate([g for g, _ in parts]), np.concatenate([n for _, n in parts])


def _ngrams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    padded = np.array([len(w) + 2 for w in words], dtype=np.int64)
    data = np.frombuffer(b"".join(b" " + w + b" " for w in words), dtype=np.uint8).astype(np.int64)
    owner = np.repeat(np.arange(len(words)), padded)
    left = np.repeat(np.cumsum(padded), padded) - np.arange(len(data))
    grams, owners, own = [], [], data
    for n in range(2, 6):
        own = own[:-1] * 419 + data[n - 1 :]
        if n > 2:
            inside = left[: len(own)] >= n
            grams.append(((own[inside] * 2654435761 >> 9) % NGRAMS).astype(np.int32))
            owners.append(owner[: len(own)][inside])
    owner = np.concatenate(owners)
    return np.concatenate(grams)[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))


def lower_odds(dirty, clean, n_dirty: int, n_clean: int):
    """Log odds of being in a toxic document, less what chance may add; 0 where that is all."""
    dirty, clean = np.asarray(dirty) + 0.5, np.asarray(clean) + 0.5
    odds = np.log(dirty / (n_dirty + 1)) - np.log(clean / (n_clean + 1))
    return np.clip(odds - 1.64 * np.sqrt(1 / dirty + 1 / clean), 0, 4).astype(np.float32)


@dataclass
class Network:
    vocabulary: dict[bytes, int]
    p: dict[str, np.ndarray]
    scale: float = 1.0
    shift: float = 0.0

    @staticmethod
    def fresh(vocabulary: dict[bytes, int], rng) -> Network:
        def normal(*shape):
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        p = {
            "words": (rng.standard_normal((len(vocabulary) + 1, WORD_DIM)) * 0.1).astype(np.float32),
            "chars": (rng.standard_normal((NGRAMS, CHAR_DIM)) * 0.1).astype(np.float32),
            "input": normal(WORD_DIM + CHAR_DIM, 6 * HIDDEN),
            "bias": np.zeros(6 * HIDDEN, np.float32),
            "ahead": normal(HIDDEN, 3 * HIDDEN),
            "back": normal(HIDDEN, 3 * HIDDEN),
            "attend": normal(2 * HIDDEN),
            "out": normal(2 * HIDDEN),
            "base": np.array([-1.0], np.float32),
        }
        return Network(vocabulary, p)

    def embed(self, words: list[bytes]) -> np.ndarray:
        """Input vectors of distinct words."""
        unknown = len(self.vocabulary)
        own = self.p["words"][[self.vocabulary.get(w, unknown) for w in words]]
        grams, sizes = ngram_lists(words)
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        return np.concatenate((own, np.maximum.reduceat(self.p["chars"][grams], starts, axis=0)), axis=1)

    def project(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.p["input"] + self.p["bias"]

    def run(self, gates: np.ndarray, mask: np.ndarray, u: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States (time, batch, hidden) of one direction; ``gates`` is (time, batch, 3 hidden)."""
        steps, batch, _ = gates.shape
        h = np.zeros((batch, HIDDEN), np.float32)
        states = np.empty((steps, batch, HIDDEN), np.float32)
        for t in range(steps):
            a = h @ u
            rz = gates[t, :, : 2 * HIDDEN] + a[:, : 2 * HIDDEN]
            np.negative(rz, out=rz)
            np.minimum(rz, 30, out=rz)
            np.exp(rz, out=rz)
            rz += 1
            np.reciprocal(rz, out=rz)
            r, z = rz[:, :HIDDEN], rz[:, HIDDEN:]
            inner = a[:, 2 * HIDDEN :]
            n = np.tanh(gates[t, :, 2 * HIDDEN :] + r * inner)
            new = n + z * (h - n)
            if keep is not None:
                keep.append((h, r, z, n, inner))
            h = np.where(mask[t][:, None], new, h)
            states[t] = h
        return states

    def forward(self, gates: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Window logits from (time, batch, 6 hidden) gates and a (time, batch) mask."""
        kept_a, kept_b = ([], []) if keep is not None else (None, None)
        ahead = self.run(gates[:, :, : 3 * HIDDEN], mask, self.p["ahead"], kept_a)
        back = self.run(gates[::-1, :, 3 * HIDDEN :], mask[::-1], self.p["back"], kept_b)[::-1]
        states = np.concatenate((ahead, back), axis=2)
        weight = np.where(mask, states @ self.p["attend"], -1e9)
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tb,tbh->bh", weight, states)
        if keep is not None:
            keep.update(ahead=kept_a, back=kept_b, states=states, weight=weight, pooled=pooled)
        return pooled @ self.p["out"] + self.p["base"][0]

    def back_run(self, d_states, mask, u, kept):
        """Gradients of one direction: (gates, u)."""
        steps, batch, _ = d_states.shape
        d_gates = np.zeros((steps, batch, 3 * HIDDEN), np.float32)
        d_u, d_h = np.zeros_like(u), np.zeros((batch, HIDDEN), np.float32)
        for t in range(steps - 1, -1, -1):
            h, r, z, n, inner = kept[t]
            m = mask[t][:, None]
            d_h = d_h + d_states[t]
            d_new = d_h * m
            d_n = d_new * (1 - z) * (1 - n * n)
            d_z = d_new * (h - n) * z * (1 - z)
            d_r = d_n * inner * r * (1 - r)
            d_gates[t] = np.concatenate((d_r, d_z, d_n), axis=1)
            d_a = np.concatenate((d_r, d_z, d_n * r), axis=1)
            d_u += h.T @ d_a
            d_h = d_h * ~m + d_new * z + d_a @ u.T
        return d_gates, d_u

    def gradients(self, gates, mask, target, weight):
        keep: dict = {}
        logit = self.forward(gates, mask, keep)
        d_logit = ((sigmoid(logit) - target) * weight / len(target)).astype(np.float32)
        states, attention = keep["states"], keep["weight"]
        g = {"out": keep["pooled"].T @ d_logit, "base": np.array([d_logit.sum()], np.float32)}
        d_pooled = d_logit[:, None] * self.p["out"]
        d_states = attention[:, :, None] * d_pooled
        d_weight = np.einsum("tbh,bh->tb", states, d_pooled)
        d_score = attention * (d_weight - (attention * d_weight).sum(axis=0))
        g["attend"] = np.einsum("tb,tbh->h", d_score, states)
        d_states += d_score[:, :, None] * self.p["attend"]
        ga, g["ahead"] = self.back_run(d_states[:, :, :HIDDEN], mask, self.p["ahead"], keep["ahead"])
        gb, g["back"] = self.back_run(d_states[::-1, :, HIDDEN:], mask[::-1], self.p["back"], keep["back"])
        return logit, np.concatenate((ga, gb[::-1]), axis=2), g


class Table(dict):
    """Word -> row; an unseen word gets the next row and waits in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        row = self[word] = len(self)
        self.new.append(word)
        return row


class Scorer:
    """Scores texts in groups; gate inputs of distinct words are kept up to ``most`` words."""

    def __init__(self, net: Network, most: int = 60_000, group: int = 50_000):
        self.net, self.most, self.group = net, most, group
        self.table, self.rows = Table(), np.zeros((0, 6 * HIDDEN), np.float32)

    def logits(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, start, logit) of every window of the tokenised texts."""
        if len(self.table) > self.most:
            self.table, self.rows = Table(), np.zeros((0, 6 * HIDDEN), np.float32)
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        row = self.table.__getitem__
        ids = np.fromiter((row(w) for t in texts for w in t), dtype=np.int64, count=int(lengths.sum()))
        if self.table.new:
            own = self.net.project(self.net.embed(self.table.new))
            self.rows = np.concatenate((self.rows, own))
            self.table.new.clear()
        doc, start = windows_of(lengths)
        offset = np.concatenate(([0], np.cumsum(lengths)))[:-1] if len(lengths) else lengths
        out = np.empty(len(doc), np.float32)
        span = np.arange(WINDOW)[:, None]
        for at in range(0, len(doc), BATCH):
            d, s = doc[at : at + BATCH], start[at : at + BATCH]
            mask = s + span < lengths[d]
            place = np.where(mask, offset[d] + s + span, 0)
            out[at : at + BATCH] = self.net.forward(self.rows[ids[place]], mask)
        return doc, start, out

    def scores(self, texts) -> tuple[list[float], list[int]]:
        """(score, windows) of each text, whatever their number and length."""
        empty = self.net.p["base"][0]
        scores, windows, group, size = [], [], [], 0

        def flush():
            doc, _, logit = self.logits(group)
            best = np.full(len(group), -np.inf)
            np.maximum.at(best, doc, logit)
            best[np.isinf(best)] = empty
            scores.extend(sigmoid(self.net.scale * best + self.net.shift).tolist())
            windows.extend(np.bincount(doc, minlength=len(group)).tolist())

        for text in texts:
            words = split_words(text)
            group.append(words)
            size += len(words)
            if size > self.group:
                flush()
                group, size = [], 0
        if group:
            flush()
        return scores, windows


def train(texts: list[str], toxic: list[int], steps: int = 400, batch: int = 128, seed: int = 11) -> Network:
    """Fit the network in a fixed number of steps, whatever the sample's size; a constant without both labels."""
    rng = np.random.default_rng(seed)
    table = Table()
    row = table.__getitem__
    raw = [np.fromiter(map(row, split_words(t)), dtype=np.int32) for t in texts]
    y = np.array(toxic, dtype=np.int64)
    # Words are numbered in their own order, so the numbers do not depend on the order of the texts.
    words = sorted(table)
    rank = np.empty(len(words), np.int32)
    rank[[table[w] for w in words]] = np.arange(len(words), dtype=np.int32)
    ids = [rank[own] for own in raw]
    del raw, table
    full = np.array([len(d) > 0 for d in ids], dtype=bool)
    bad, good = np.flatnonzero((y == 1) & full), np.flatnonzero((y == 0) & full)
    seen = np.zeros((len(words), 2), np.int64)
    for label, own in zip(y, ids, strict=True):
        seen[np.unique(own), label] += 1
    common = np.flatnonzero(seen.sum(axis=1) >= 3)
    net = Network.fresh({words[i]: n for n, i in enumerate(common)}, rng)
    if not len(bad) or not len(good):
        net.p["out"][:] = 0
        net.p["base"][0] = 4.0 if len(bad) else -4.0
        return net
    vocab_row = np.full(len(words), len(common))
    vocab_row[common] = np.arange(len(common))
    grams, sizes = ngram_lists(words)
    first = np.concatenate(([0], np.cumsum(sizes)))
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.p.items()}

    def adam(name, g, t, rate, rows=None):
        m, v = moments[name]
        at = slice(None) if rows is None else rows
        m[at] = 0.9 * m[at] + 0.1 * g
        v[at] = 0.99 * v[at] + 0.01 * g * g
        net.p[name][at] -= rate * m[at] / (np.sqrt(v[at]) + 1e-6)

    def spelt(i):
        return [words[w] for w in ids[i]]

    def best_windows(which):
        """The start and the logit of the highest-scoring window of each document."""
        scorer, starts, logits = Scorer(net), [], []
        for at in range(0, len(which), 100):
            doc, start, logit = scorer.logits([spelt(i) for i in which[at : at + 100]])
            order = np.lexsort((logit, doc))
            last = np.flatnonzero(np.append(np.diff(doc[order]) > 0, True))
            starts.append(start[order[last]])
            logits.append(logit[order[last]])
        return np.concatenate(starts), np.concatenate(logits)

    # One coordinate of words and n-grams starts as their log odds; they also give the first examples.
    lead = lower_odds(seen[:, 1], seen[:, 0], len(bad), len(good))
    net.p["words"][: len(common), 0] = lead[common]
    counts = np.zeros((2, NGRAMS))
    for label, own in zip(y, ids, strict=True):
        unique = np.unique(own)
        if len(unique):
            counts[label][np.unique(grams[np.concatenate([np.arange(first[u], first[u + 1]) for u in unique])])] += 1
    net.p["chars"][:, 0] = gram_odds = lower_odds(counts[1], counts[0], len(bad), len(good))
    lead = np.maximum(lead, np.maximum.reduceat(gram_odds[grams], first[:-1]))
    # Toxic documents without any telling word or n-gram are left out: their labels say nothing that can be learnt.
    told = np.array([lead[ids[i]].max() >= 1 for i in bad])
    if told.any():
        bad = bad[told]
    bad_at = np.array([max(0, int(np.argmax(lead[ids[i]])) - WINDOW // 2) for i in bad])
    hard, hard_at = good[:0], good[:0]
    for step in range(steps):
        if step and step % 100 == 0:
            bad_at, _ = best_windows(bad)
            hard = rng.choice(good, min(len(good), 1000), replace=False)
            hard_at, logit = best_windows(hard)
            worst = np.argsort(-logit, kind="stable")[: len(hard) // 4]
            hard, hard_at = hard[worst], hard_at[worst]
        k = rng.integers(0, len(bad), batch // 2)
        rows = [(bad[i], bad_at[i]) for i in k]
        if len(hard):
            rows += [(hard[i], hard_at[i]) for i in rng.integers(0, len(hard), batch // 4)]
        for i in rng.choice(good, batch - len(rows)):
            rows.append((i, int(rng.integers(0, max(1, len(ids[i]) - WINDOW // 2)))))
        own = np.full((WINDOW, batch), -1, dtype=np.int64)
        for b, (i, s) in enumerate(rows):
            part = ids[i][s : s + WINDOW]
            own[: len(part), b] = part
        mask = own >= 0
        target = (np.arange(batch) < batch // 2).astype(np.float32)
        unique, inverse = np.unique(np.where(mask, own, own[mask][0]), return_inverse=True)
        inverse = inverse.reshape(own.shape)
        hidden = rng.random(len(unique)) < 0.1
        row = np.where(hidden, len(common), vocab_row[unique])
        repeat = sizes[unique]
        gram = grams[np.concatenate([np.arange(first[u], first[u + 1]) for u in unique])]
        begin = np.concatenate(([0], np.cumsum(repeat)[:-1]))
        own_chars = net.p["chars"][gram]
        chars = np.maximum.reduceat(own_chars, begin, axis=0)
        winner = own_chars == np.repeat(chars, repeat, axis=0)
        vectors = np.concatenate((net.p["words"][row], chars), axis=1)
        gates = net.project(vectors)[inverse]
        _, d_gates, g = net.gradients(gates, mask, target, np.ones(batch, np.float32))
        d_row = np.zeros((len(unique), 6 * HIDDEN), np.float32)
        np.add.at(d_row, inverse.ravel(), d_gates.reshape(-1, 6 * HIDDEN))
        g["input"], g["bias"] = vectors.T @ d_row, d_row.sum(axis=0)
        d_vector = d_row @ net.p["input"].T
        rate = 0.01 * (1 - step / steps) + 0.0005
        for name, value in g.items():
            adam(name, value, step, rate)
        touched, back = np.unique(row, return_inverse=True)
        total = np.zeros((len(touched), WORD_DIM), np.float32)
        np.add.at(total, back, d_vector[:, :WORD_DIM])
        adam("words", total + 1e-5 * net.p["words"][touched], step, rate, touched)
        touched, back = np.unique(gram, return_inverse=True)
        total = np.zeros((len(touched), CHAR_DIM), np.float32)
        np.add.at(total, back, np.repeat(d_vector[:, WORD_DIM:], repeat, axis=0) * winner)
        adam("chars", total + 1e-5 * net.p["chars"][touched], step, rate, touched)
    _, best = best_windows(np.concatenate((bad, good)))
    calibrate(net, best, np.r_[np.ones(len(bad)), np.zeros(len(good))])
    return net


def calibrate(net: Network, best: np.ndarray, y: np.ndarray, rounds: int = 200) -> None:
    """Fit scale and shift of the highest window logits ``best`` to the labels."""
    weight = 1 / len(y)
    a, c = 1.0, 0.0
    for _ in range(rounds):
        pull = weight * (sigmoid(a * best + c) - y)
        a -= 0.2 * (float((pull * best).sum()) + 0.01 * (a - 1))
        c -= 0.2 * float(pull.sum())
    net.scale, net.shift = max(a, 0.1), c


#: Training documents of each label without which nothing is dropped.
LEAST_EXAMPLES = 8


def training_rows(docs: DataFrame, labels: DataFrame, most: int = 1500, longest: int = 20_000) -> DataFrame:
    """doc_id, text, toxic: at most ``most`` documents of each label outside the held-out fold, of at most ``longest`` characters.

    The labels are drawn first, by a hash; only those ids (their number is bounded)
    are sent to the scan of the documents, which is not shuffled. Of documents that
    share an id one counts.
    """
    own = (
        labels.filter("doc_id is not null and toxic in (0, 1) and crc32(cast(doc_id as string)) % 5 <> 0")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").alias("toxic"))
    )
    drawn = None
    for label in (0, 1):
        part = own.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        drawn = part if drawn is None else drawn.unionByName(part)
    texts = docs.select(F.col("doc_id").cast("long"), "text").filter(F.length("text") <= longest)
    return texts.join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def fitted(docs: DataFrame, labels: DataFrame) -> Network:
    """The network trained on the sample of ``training_rows``, inside a task."""

    def fit(rows):
        rows.sort(key=lambda r: r["doc_id"])
        learn = lambda: train([r["text"] for r in rows], [r["toxic"] for r in rows])
        net = apart(learn) if rows else learn()
        net.examples = min(sum(r["toxic"] == label for r in rows) for label in (0, 1))
        return net

    return fit_in_task(training_rows(docs, labels), fit)


def score_toxicity(docs: DataFrame, labels: DataFrame | None = None, net: Network | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted, n_windows for every whole text.

    Give ``labels`` (doc_id, toxic) to train, or a trained network. Null and empty
    texts have no windows and score as the network's base. A null id is not held out
    and nothing is learnt from it. Without labels of both kinds the score is constant.
    """
    if net is None:
        net = fitted(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def score(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            scores, windows = scorer.scores(t.as_py() for t in batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                    pa.array(windows, pa.int64()),
                ],
                ["doc_id", "held_out", "score", "predicted", "n_windows"],
            )

    held_out = F.coalesce(F.expr("crc32(cast(doc_id as string)) % 5 = 0"), F.lit(False))
    return docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), "text").mapInArrow(score, SCORED)


def drop_toxic(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score ``least`` or more; scored inside the scan.

    With fewer than ``LEAST_EXAMPLES`` training documents of either label nothing is known
    about what is toxic, and all rows stay. Null and empty texts score as the network's
    base does.
    """
    net = fitted(docs, labels)
    if net.examples < LEAST_EXAMPLES:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(net)
    at = docs.columns.index("text")

    def clean(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            scores, _ = scorer.scores(t.as_py() for t in batch.column(at))
            yield batch.filter(pa.array([s < least for s in scores], pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)
