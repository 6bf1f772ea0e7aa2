"""Observed counts of batch and stream runs, and the guard."""

import tempfile

import pytest
from pyspark.sql import functions as F

from trolley.operators.observed import Counters, RunStopped, stream_observed, write_observed
from trolley.operators.quality import run_summary

SHAPE = "store string, id int, reason string"
COUNTERS = Counters(("high", "low"), ("bad", "broken"), ("s", "t"))


def offers(spark, bad=1):
    rows = [("s", i, None) for i in range(40)] + [("t", i, "high") for i in range(5)] + [(None, 0, "low"), ("t", 9, None)]
    return spark.createDataFrame(rows + [("t", 100 + i, "bad") for i in range(bad)], SHAPE)


def place(name):
    return f"{tempfile.mkdtemp(prefix='spark-')}/{name}"


def test_counts_of_the_write_equal_a_second_scan(spark):
    path = place("out")
    counts = write_observed(offers(spark), path, COUNTERS)
    assert (counts["|found"], counts["|saved"], counts["|ignored_high"], counts["|ignored_low"], counts["|errors"]) == (48, 41, 5, 1, 1)
    scan = run_summary(offers(spark), "reason", ["high", "low"], ["bad", "broken"], ["store"]).filter("store is not null")
    columns = ["store", "found", "saved", "ignored_high", "ignored_low", "errors"]
    told = COUNTERS.summary(spark, counts)
    assert sorted(map(tuple, told.select(*columns).collect())) == sorted(map(tuple, scan.select(*columns).collect()))
    assert spark.read.parquet(path).count() == 41


def test_guard_stops_bad_and_empty_runs(spark):
    for rows, verdict in ((offers(spark, 9), "too_many_errors"), (offers(spark).limit(0), "empty")):
        with pytest.raises(RunStopped) as stop:
            write_observed(rows, place("out"), COUNTERS)
        assert stop.value.verdict == verdict


def landed(spark, parts):
    path = place("in")
    for rows in parts:
        rows.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(SHAPE).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_counts_equal_the_batch(spark):
    parts = [offers(spark, 0), offers(spark, 2)]
    out = place("out")
    counts = stream_observed(landed(spark, parts), out, place("cp"), COUNTERS)
    assert counts == write_observed(parts[0].unionByName(parts[1]), place("out"), COUNTERS)
    assert spark.read.parquet(out).count() == 82


def test_a_stream_is_stopped_by_the_guard(spark):
    slow = F.udf(lambda x: __import__("time").sleep(0.3) or x, "int")  # so that the guard sees a batch before the next ends
    parts = [offers(spark, 60), *[offers(spark, 0)] * 6]
    out = place("out")
    with pytest.raises(RunStopped) as stop:
        stream_observed(landed(spark, parts).withColumn("id", slow("id")), out, place("cp"), COUNTERS)
    assert stop.value.verdict == "too_many_errors" and spark.read.schema("store string, id int").parquet(out).count() < 7 * 41
