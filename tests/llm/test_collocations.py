"""Phrases of a weighted de Bruijn graph against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from trolley.llm import collocations as C

SHAPE = "doc_id long, text string, lang string, phrase string, f int, weight string"


def plain(rows, least, inside=80, k=2000):
    f = {}
    for _, text, lang in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = [w for w in re.split("[ \t]+", piece) if w]
            for n in range(1, 5):
                f.setdefault(lang or "und", Counter()).update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, own in f.items():
        n = sum(v for p, v in own.items() if len(p) == 1)
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        hidden = set()
        for p, a in candidates.items():
            for size in range(2, len(p)):
                hidden |= {q for i in range(len(p) - size + 1) if 100 * a >= inside * own[q := p[i : i + size]]}
        scored = []
        for p, a in candidates.items():
            if p not in hidden:
                score, at = min((2_000_000 * a // (own[p[:i]] + own[p[i:]]), i) for i in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), own[p[:at]], own[p[at:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:k], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(out)


def texts(seed, n):
    random.seed(seed)
    words = ["ab", "Ab", "cd", "é", "x y", "e-f", "gh", "ii", "\x1c"] + [f"w{i}" for i in range(12)]
    ends = [" ", " ", " ", " ", "\t ", ", ", ".", "\n", " . "]
    phrase = "new york stock exchange opens late today"
    for i in range(n):
        body = "".join(random.choice(words) + random.choice(ends) for _ in range(random.randint(0, 60)))
        yield i, random.choice([body, phrase + " " + body, phrase + ". " + body + phrase, None, ""]), random.choice(["a", "b", None, "und"])


def found(spark, rows, **more):
    table = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SHAPE)
    return sorted(tuple(r) for r in C.collocations(table, **more).collect())


@pytest.mark.parametrize("sizes", [C.Sizes(), C.Sizes(90, 40), C.Sizes(300, 64, 6, 3)])
def test_phrases_equal_plain_counting(spark, sizes):
    """Also with small groups, texts cut in slices, and so few buckets that all of them are full."""
    rows = [*texts(sizes.group, 250), *texts(sizes.group, 20)]
    got = found(spark, rows, least=6, sizes=sizes)
    assert len(got) > 20 and got == plain(rows, 6)


def test_counts_of_repeated_words_cuts_and_limits(spark):
    rows = [(1, "a a a a a a. a a", "x"), (2, "b c " * 40, "x"), (3, "p q r s t u v. " * 33, None), (4, "q r. " * 9, None)]
    assert found(spark, rows, least=2) == plain(rows, 2)
    assert found(spark, rows, least=30) == plain(rows, 30)
    assert found(spark, rows, least=2, k=1) == plain(rows, 2, k=1)


def test_paths_are_compacted():
    group = C._Group(C.Sizes())
    for _ in range(5):
        group.add("x", "one two three four five six seven")
    group.add("x", "zero two three four")
    group.close()
    joined = group.buckets() >= 0
    place, n, weight = C._paths(group, np.append(joined[:-1] & joined[1:], False))
    assert list(zip(group.phrases(place, n), weight.tolist(), strict=True)) == [
        ("one two three four", 5), ("two three four five six seven", 5), ("zero two three four", 1),
    ]


def test_odd_rows_and_empty_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, None, None), (1, "", "x"), (2, " \t.,", "x"), (3, "one", None)]) == []
    long = [(1, "the same words again " * 50_000, "x")]
    assert found(spark, long) == plain(long, 30)


@pytest.mark.parametrize("sizes,k,floors", [
    (C.Sizes(90, 40, 16, 3), 3, (400_000,)), (C.Sizes(300, 64, 6, 3), 12, (900_000, 150_000)), (C.Sizes(90, 40, 16, 3), 2000, (1,)),
])
def test_floors_change_no_result(spark, sizes, k, floors):
    """Floors that all, some or no languages reach, with phrases inside longer ones on both sides of them."""
    rows = [*texts(k, 250), *texts(k, 20), *[(i, "one of the most. of the most " * (i % 5), "b") for i in range(60)]]
    want = plain(rows, 6, k=k)
    assert len(want) > 8
    assert found(spark, rows, least=6, k=k, sizes=sizes, floors=floors) == want


def test_phrases_below_the_floor_are_not_sent(spark, monkeypatch):
    """Frequent pairs of frequent words score low; their counts do not leave the tasks where better ones are enough."""
    random.seed(7)
    common = [f"c{i}" for i in range(40)]
    rows = [(i, " ".join(random.choices(common, k=400)) + f". far{i % 20} off{i % 20}", "x") for i in range(400)]
    sent, write = [], C.written

    def recorded(df, name):
        out = write(df, name)
        if name == "flows":
            sent.append(out.count())
        return out

    monkeypatch.setattr(C, "written", recorded)
    sizes = C.Sizes(group=4_000, bucket_bits=16, range_bits=3)
    want = plain(rows, 20, k=20)
    assert found(spark, rows, least=20, k=20, sizes=sizes, floors=(500_000,)) == want
    few = sum(sent)
    sent.clear()
    assert found(spark, rows, least=20, k=20, sizes=sizes, floors=()) == want
    assert 20 * few < sum(sent)
