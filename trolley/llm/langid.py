"""Language identification with error-correcting output codes.

Every language has a codeword. For each bit of the code a binary classifier over
hashed byte n-grams predicts whether the text's language has that bit set, and the
codeword of the smallest weighted loss wins. A text whose two best codewords are
close is flagged as ambiguous.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1 << 13
#: Learning rows of each language at least, however many languages there are.
LEAST_EACH = 20
PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean"
#: Every byte of a non-letter ASCII character becomes a blank.
LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def codewords(classes: int, extra: int = 15, seed: int = 5) -> np.ndarray:
    """A row of +1/-1 for each class: the exhaustive code up to five classes, else a random one.

    All rows and all columns differ, no column is constant; the random code has
    ``extra`` bits for each doubling of the classes.
    """
    if classes <= 1:
        return np.ones((classes, 1))
    if classes <= 5:
        masks = np.arange(1, 2 ** (classes - 1))
        return np.where((masks[None, :] << 1 >> np.arange(classes)[:, None]) & 1, 1.0, -1.0)
    rng, bits = np.random.default_rng(seed), int(extra * np.ceil(np.log2(classes)))
    while True:
        code = rng.choice([-1.0, 1.0], size=(classes, bits))
        code = code[:, np.abs(code.sum(axis=0)) < classes]
        if len({tuple(row) for row in code}) == classes:
            return code


def ngram_counts(text: str) -> np.ndarray:
    """Hashed counts of the byte 1- to 4-grams of the whole text, case and punctuation folded."""
    data = np.frombuffer((" " + text.lower() + " ").encode().translate(LETTERS), dtype=np.uint8).astype(np.int64)
    counts = np.bincount(data, minlength=BUCKETS)
    gram = data
    for n, factor in ((2, 263), (3, 911), (4, 3571)):
        gram = gram[:-1] * factor + data[n - 1 :]
        if not len(gram):
            break
        counts += np.bincount((gram * 2654435761 >> 11) % BUCKETS, minlength=BUCKETS)
    return counts


def _scaled(counts: np.ndarray) -> np.ndarray:
    x = np.sqrt(counts, dtype=np.float32)
    return x / max(float(np.linalg.norm(x)), 1e-9)


@dataclass
class CodeModel:
    classes: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def predict(self, text: str) -> tuple[str, float, bool]:
        """(language, share of its codeword in the weighted likelihood, ambiguous)."""
        margin = _scaled(ngram_counts(text)) @ self.weights + self.bias
        loss = np.logaddexp(0, -self.code * margin) @ self.trust
        share = np.exp(loss.min() - loss)
        share /= share.sum()
        best = int(np.argmin(loss))
        return self.classes[best], float(share[best]), bool(share[best] < 0.6)


def train(texts: list[str], langs: list[str], epochs: int = 60, seed: int = 3) -> CodeModel | None:
    """Logistic regression for each bit; a bit's trust is its accuracy on the sample. None without classes."""
    classes = sorted(set(langs))
    if not classes:
        return None
    code = codewords(len(classes))
    bits = code.shape[1]
    model = CodeModel(classes, code, np.zeros((BUCKETS, bits), np.float32), np.zeros(bits, np.float32), np.ones(bits))
    if len(classes) == 1:
        return model
    x = np.stack([_scaled(ngram_counts(t)) for t in texts])
    number = {c: i for i, c in enumerate(classes)}
    y = np.array([number[c] for c in langs])
    target = code[y].astype(np.float32)
    share = np.bincount(y, minlength=len(classes))[y]
    weight = (len(y) / len(classes) / share).astype(np.float32)[:, None]
    rng = np.random.default_rng(seed)
    for epoch in range(epochs):
        rate = 20.0 / (1 + epoch / 10)
        for at in np.array_split(rng.permutation(len(y)), max(1, len(y) // 100)):
            margin = x[at] @ model.weights + model.bias
            pull = weight[at] * target[at] / (1 + np.exp(np.clip(target[at] * margin, -30, 30)))
            model.weights += rate * (x[at].T @ pull / len(at)) - rate * 1e-5 * model.weights
            model.bias += rate * 0.1 * pull.mean(axis=0)
    right = (np.sign(x @ model.weights + model.bias) == target).mean(axis=0)
    model.trust = np.maximum(right - 0.5, 0.01) * 2
    return model


def training_rows(docs: DataFrame, most: int = 2000, longest: int = 20_000) -> list:
    """Labelled learning rows of every language outside the fold, the first by a hash of their ids.

    The sample has ``most`` / languages rows of each language, 20 at least, whatever the
    layout of the files; rows of one id count once. A text over ``longest`` characters is
    learnt from by its start.
    """
    own = docs.filter(
        "doc_id is not null and lang is not null and length(text) > 0 and crc32(cast(doc_id as string)) % 4 <> 2"
    ).select(F.col("doc_id").cast("long"), F.substring("text", 1, longest).alias("text"), "lang")
    sizes = own.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n")).collect()
    if not sizes:
        return []
    each = max(LEAST_EACH, most // len(sizes))
    # Far more ids fall below the bound than are wanted, so the ones wanted are always among them.
    bounds = [(r["lang"], int(1_000_000 * min(1.0, (1.5 * each + 50) / max(r["n"], 1))) + 1) for r in sizes]
    spark = docs.sparkSession
    drawn = own.join(F.broadcast(spark.createDataFrame(bounds, "lang string, bound int")), "lang").withColumn(
        "place", F.xxhash64("doc_id", F.lit(17))
    )
    drawn = drawn.filter(F.pmod("place", F.lit(1_000_000)) < F.col("bound"))
    once = drawn.groupBy("lang", "doc_id").agg(F.min("text").alias("text"), F.first("place").alias("place"))
    order = Window.partitionBy("lang").orderBy(F.pmod("place", F.lit(1_000_000)), "place", "doc_id")
    first = once.withColumn("number", F.row_number().over(order)).filter(F.col("number") <= each)
    return sorted(first.select("doc_id", "text", "lang", "place").collect(), key=lambda r: (r["place"], r["doc_id"], r["lang"]))


def identify_languages(docs: DataFrame, model: CodeModel | None = None, most: int = 2000) -> DataFrame:
    """Predict the language of every whole text.

    The model learns from text and lang of rows outside the held-out fold, a sample of
    every language there (see ``training_rows``); a fitted one can be given. Text that is null or has no
    letter is ``und`` with score 1; with no learnt language every text is ``und`` with
    score 0. A null id is never held out. Repeated rows are predicted alike.
    """
    if model is None:
        rows = training_rows(docs, most)
        model = train([r["text"] for r in rows], [r["lang"] for r in rows])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches):
        fitted = shared.value
        for batch in batches:
            out = [[], [], []]
            for text in batch.column(2):
                text = text.as_py()
                if text is None or not any(map(str.isalpha, text)):
                    got = ("und", 1.0, False)
                elif fitted is None:
                    got = ("und", 0.0, True)
                else:
                    got = fitted.predict(text)
                for column, value in zip(out, got, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(out[0], pa.string()),
                    pa.array(out[1], pa.float64()),
                    pa.array(out[2], pa.bool_()),
                ],
                ["doc_id", "held_out", "lang_pred", "score", "ambiguous"],
            )

    held_out = F.coalesce(F.expr("crc32(cast(doc_id as string)) % 4 = 2"), F.lit(False))
    return docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), "text").mapInArrow(predict, PREDICTED)
