"""Bucketed snapshots: what an update rewrites, and what readers see."""

import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from trolley.operators.history import upsert_snapshot
from trolley.sources import snapshots as S

SHAPE = "store string, external_id string, name string, price double, image_url string"
KEY = ["store", "external_id"]


def rows(spark, ids, price=1.0):
    data = [("s" if i is None or i % 2 else "t", None if i is None else str(i), f"n{i}", price, None) for i in ids]
    return spark.createDataFrame(data, SHAPE)


def values(df):
    return sorted(((r["external_id"], r["price"]) for r in df.collect()), key=str)


def folders(path):
    return {d: os.path.getmtime(d) for d in glob.glob(f"{path}/data/*/bucket=*")}


def test_an_increment_rewrites_its_buckets_only(spark):
    path = tempfile.mkdtemp(prefix="spark-") + "/snap"
    assert S.versions(spark, path) == []
    S.create_snapshot(rows(spark, range(2000)), path, KEY, 64)
    before = folders(path)
    new = rows(spark, [5, 6, 7, 5000], 2.0)
    assert S.update_snapshot(new, path, upsert_snapshot) == 1
    touched = {r[0] for r in new.select(S.bucket_of(KEY, 64)).collect()}
    after = folders(path)
    assert {k: v for k, v in after.items() if k in before} == before  # nothing old is touched
    assert {int(k.rpartition("=")[2]) for k in after.keys() - before.keys()} == touched and len(touched) <= 4
    want = {str(i): 1.0 for i in range(2000)} | {str(i): 2.0 for i in (5, 6, 7, 5000)}
    assert values(S.read_snapshot(spark, path)) == sorted(want.items())
    assert values(S.read_snapshot(spark, path, 0)) == sorted((str(i), 1.0) for i in range(2000))
    with pytest.raises(ValueError):
        S.read_snapshot(spark, path, 9)


def test_a_writer_that_dies_leaves_the_old_version(spark, monkeypatch):
    path = tempfile.mkdtemp(prefix="spark-") + "/snap"
    S.create_snapshot(rows(spark, range(50)), path, KEY, 8)
    commit = S._commit

    def dies(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(S, "_commit", dies)
    with pytest.raises(RuntimeError):
        S.update_snapshot(rows(spark, [1, 2], 3.0), path, upsert_snapshot)
    assert S.versions(spark, path) == [0] and values(S.read_snapshot(spark, path)) == sorted((str(i), 1.0) for i in range(50))
    monkeypatch.setattr(S, "_commit", commit)
    assert S.update_snapshot(rows(spark, [3], 4.0), path, upsert_snapshot) == 1
    got = dict(values(S.read_snapshot(spark, path)))
    assert got["1"] == 1.0 and got["3"] == 4.0 and len(got) == 50


def test_chain_of_updates_equals_the_plain_upsert(spark):
    path = tempfile.mkdtemp(prefix="spark-") + "/snap"
    plain = rows(spark, [None, *range(0, 120)])
    S.create_snapshot(plain, path, KEY, 16)
    for k in range(3):
        new = rows(spark, range(40 * k, 40 * k + 60, 7), 2.0 + k)
        plain = upsert_snapshot(plain, new)
        S.update_snapshot(new, path, upsert_snapshot)
        assert sorted(map(str, S.read_snapshot(spark, path).collect())) == sorted(map(str, plain.collect()))
    assert S.update_snapshot(rows(spark, []), path, upsert_snapshot) == 3


def test_deletes_and_empty_snapshots(spark):
    path = tempfile.mkdtemp(prefix="spark-") + "/snap"
    S.create_snapshot(rows(spark, []), path, KEY, 4)
    assert S.read_snapshot(spark, path).collect() == [] and S.read_snapshot(spark, path).columns == SHAPE.replace(" string", "").replace(" double", "").split(", ")
    S.update_snapshot(rows(spark, [1, 2]), path, upsert_snapshot)
    without = lambda old, gone: old.join(gone.select(*KEY), KEY, "left_anti")
    S.update_snapshot(rows(spark, [1]), path, without)
    assert values(S.read_snapshot(spark, path)) == [("2", 1.0)]
    S.update_snapshot(rows(spark, [2]), path, without)
    assert S.read_snapshot(spark, path).collect() == [] and values(S.read_snapshot(spark, path, 1)) == [("1", 1.0), ("2", 1.0)]
    with pytest.raises(ValueError):
        S.create_snapshot(rows(spark, [1]), path, KEY)
    with pytest.raises(ValueError):
        S.create_snapshot(rows(spark, [1]).withColumn("bucket", F.lit(1)), path + "x", KEY)
