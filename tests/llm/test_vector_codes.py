"""Product quantisation against Lloyd's rounds by brute force."""

import hashlib
import random

import numpy as np
import pytest

from trolley.llm import vector_codes as V

SHAPE = "vec_id long, embedding array<double>, label int, code string, error int"


def plain(rows, parts=8, entries=16, rounds=6):
    """[(vec_id, code, error, label)] and the digest, with Python's integers only."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dim = len(kept[0][1])
    kept = [(r[0], [int(np.floor(x * 4096)) for x in r[1]], r[2]) for r in kept if len(r[1]) == dim]
    cut = [dim * i // parts for i in range(parts + 1)]
    part = lambda v, j: v[cut[j] : cut[j + 1]]
    books = [[part(r[1], j) for r in kept[:entries]] for j in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def nearest(v, book):
        return min((far(v, c), i) for i, c in enumerate(book))

    for _ in range(rounds):
        new = []
        for j, book in enumerate(books):
            own = [[] for _ in book]
            for r in kept:
                own[nearest(part(r[1], j), book)[1]].append(part(r[1], j))
            new.append([[sum(x) // len(x) for x in zip(*g, strict=True)] if g else c for g, c in zip(own, book, strict=True)])
        books = new
    out = []
    for r in kept:
        got = [nearest(part(r[1], j), b) for j, b in enumerate(books)]
        out.append((r[0], "".join(f"{i:02x}" for _, i in got), min(sum(d for d, _ in got), V.LONG), r[2]))
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return out, digest


def compared(spark, rows, **more):
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SHAPE)
    got = V.with_label_errors(V.compress_vectors(table, **more)).collect()
    expected, digest = plain(rows)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted([(r["vec_id"], r["code"], r["error"], r["label"]) for r in got], key=key) == sorted(expected, key=key)
    assert {r["codebooks_sha256"] for r in got} == {digest}
    for r in got:
        assert r["label_error"] == min(sum(e for _, _, e, label in expected if label == r["label"]), V.LONG)


@pytest.mark.parametrize("seed", [1, 2])
def test_codes_equal_plain_rounds(spark, seed):
    random.seed(seed)
    hot = [random.gauss(0, 0.2) for _ in range(16)]
    rows = [(i, hot if i % 3 == 0 else [random.choice([0.1, -0.2, random.gauss(0, 0.2)]) for _ in range(16)], random.choice([None, 1, 2])) for i in range(240)]
    rows += [(5, rows[5][1], None), (None, rows[7][1], 3), (900, None, 1), (901, [None] * 16, 1), (902, [float("nan")] * 16, 1), (903, [float("inf")] * 16, 2), (904, [1.0], 1)]
    compared(spark, rows, chunk=50, leaf=3)


def test_large_components_few_rows_and_odd_dimensions(spark):
    compared(spark, [(i, [float(x) * 1e30 * (-1) ** i for x in range(11)], i % 2) for i in range(20)])
    compared(spark, [(i, [float(i * i % 7), -1.5, 1e6 * i], 1) for i in range(5)])
    compared(spark, [(i, [], 1) for i in range(3)])


def test_empty_tables(spark):
    for rows in ([], [(1, None, 1, "x", 1)]):
        got = V.with_label_errors(V.compress_vectors(spark.createDataFrame(rows, SHAPE)))
        assert got.collect() == [] and "codebooks_sha256" in got.columns


def test_many_labels_go_the_salted_way(spark, monkeypatch):
    monkeypatch.setattr(V, "MOST_LABELS", 2)
    compared(spark, [(i, [i / 7, 1 / (i + 1)], i % 5 or None) for i in range(60)])


def test_tree_covers_and_settles_whole_nodes():
    rng = np.random.default_rng(3)
    points = np.concatenate([rng.integers(-40, 40, (900, 4)) + c for c in ([0] * 4, [4000] * 4, [-4000, 0, 0, 0])]).astype(np.int16)
    tree = V.build_tree(points)
    assert sorted(tree.place.tolist()) == list(range(len(points))) and (tree.points == points[tree.place]).all()
    for a, b, r, child, n in zip(tree.start, tree.end, tree.radius, tree.child, tree.children, strict=True):
        far = np.linalg.norm(tree.points[a:b].astype(float) - tree.points[a], axis=1)
        assert far.max() <= r + 1e-9
        if n:
            assert tree.start[child] == a and tree.end[child + n - 1] == b
    book = np.array([[0] * 4, [4000] * 4, [-4000, 0, 0, 0], [0] * 4])
    runs = [(int(b - a), int(e)) for s in V.assign(tree, book) for a, b, e in zip(*s, strict=True)]
    assert sum(n for n, _ in runs) == len(points) and len(runs) < 40  # whole subtrees, not points
    assert {e for _, e in runs} == {0, 1, 2}  # of equal entries the lower
