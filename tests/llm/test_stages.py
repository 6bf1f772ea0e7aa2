"""Every stage of the pipeline on odd rows and empty tables: the rows it returns, not only its columns."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from trolley.llm._common import table, written

SF = "/root/testdata/sf0.001"
SHAPE = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "many plain words in a very long text " * 8_000
PASSAGE = "a shared passage of plain words that stands in two of these odd rows and in nothing else at all"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (None, None, None, None, None), (1, "", "xx", "s", 0), (2, None, None, "s", None), (3, LONG, "xx", "s", len(LONG)),
        (4, PASSAGE, None, None, 3), (5, PASSAGE, "xx", "s", 3), (5, PASSAGE, "xx", "s", 3), (6, "call +351 912 345 678 or mail a.b@example.org", "xx", "s", 44),
    ]
    return written(spark.createDataFrame(rows, SHAPE), "odd")


def stage(spark, name, docs):
    return dict(corpus_pipeline.STAGES)[name](spark, docs, SF)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_of_an_empty_table(spark, name):
    empty = spark.createDataFrame([], SHAPE)
    got = stage(spark, name, empty)
    assert got.collect() == []
    assert name == "packing" or got.columns == empty.columns


def test_toxicity_keeps_clean_odd_rows(spark, odd):
    left = stage(spark, "toxicity", odd)
    assert left.columns == odd.columns
    assert sorted(map(str, left.collect())) == sorted(map(str, odd.collect()))


def test_near_duplicates_leave_one_row_of_a_class(spark, odd):
    rows = stage(spark, "near_duplicates", odd).collect()
    assert sum(r["text"] == PASSAGE for r in rows) == 1 and {r["doc_id"] for r in rows if r["text"] == PASSAGE} == {4}
    assert sum(r["text"] == LONG for r in rows) == 1 and sum(r["doc_id"] == 6 for r in rows) == 1


def test_decontamination_drops_rows_with_benchmark_windows_only(spark, odd):
    item = table(spark, SF, "benchmark").filter(F.size(F.split("text", " ")) > 12).orderBy("item_id").first()["text"]
    bad = spark.createDataFrame([(7, "before " + item + " after", "xx", "s", 1)], SHAPE)
    left = stage(spark, "decontamination", odd.unionByName(bad)).collect()
    assert sorted(map(str, left)) == sorted(map(str, odd.collect()))


def test_personal_data_is_masked_and_nothing_else(spark, odd):
    left = {r["doc_id"]: r for r in stage(spark, "personal_data", odd).filter("doc_id is not null").dropDuplicates(["doc_id"]).collect()}
    assert left[6]["text"] == "call [PHONE] or mail [EMAIL]" and left[6]["n_chars"] == len(left[6]["text"])
    assert left[3]["text"] == LONG and left[2]["text"] is None and left[1]["text"] == "" and left[4]["text"] == PASSAGE


def test_packing_holds_every_row(spark, odd):
    rows = stage(spark, "packing", odd).collect()
    assert len({(r["doc_id"], r["piece"]) for r in rows if r["doc_id"] == 3}) == -(-max(r["start"] + r["length"] for r in rows if r["doc_id"] == 3) // 2048)
    assert sum(r["doc_id"] == 5 for r in rows) == 2 and sum(r["doc_id"] is None for r in rows) == 1
    assert all(0 < r["length"] <= 2048 and r["offset"] + r["length"] <= 2048 for r in rows)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_sends_texts_in_small_batches(spark, name):
    setting = corpus_pipeline.BATCH_SETTING
    before = spark.conf.get(setting, None)
    texts = spark.range(0, 9000, 1, 1).selectExpr("id AS doc_id", "repeat('word ', 400) AS text", "'xx' AS lang", "'s' AS source", "2000L AS n_chars")

    def largest():
        def sizes(batches):
            yield from (pa.RecordBatch.from_arrays([pa.array([b.nbytes], pa.int64())], ["size"]) for b in batches)

        return max(r["size"] for r in texts.mapInArrow(sizes, "size long").collect())

    try:
        spark.conf.unset(setting)
        stage(spark, name, spark.createDataFrame([], SHAPE))
        assert largest() < 5 << 20
        spark.conf.set(setting, "1m")
        stage(spark, name, spark.createDataFrame([], SHAPE))
        assert spark.conf.get(setting) in ("1m", str(1 << 20))
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)
