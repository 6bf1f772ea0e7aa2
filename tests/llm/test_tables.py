"""WARC bundles, exact top-k and the pipeline against brute force."""

import hashlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from trolley.llm import topk, warc
from trolley.llm.queries import ORACLES, QUERIES
from trolley.sources.shared import shared_dir

SF = "/root/testdata/sf0.001"


def test_archive_round_trip_of_odd_pages(spark):
    body = "<p>" + "é" * 80
    rows = [(5, "u", body), (2, None, body), (2, "u2", body), (None, "u", body), (7, "a\r\nb", None), (8, "u", "short"), (9, "u", "short"), (1, "u", "x" * 700_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    got = sorted(warc.archive_round_trip(pages).collect(), key=lambda r: (r["page_id"] or 0, r["record_type"]))
    assert len(got) == len(rows)
    digest = hashlib.sha256(body.encode()).hexdigest()
    by = {}
    for r in got:
        by.setdefault(r["page_id"], []).append(r)
    assert all(r["record_type"] == "response" and r["refers_to"] is None for r in by[2])
    assert [(r["record_type"], r["refers_to"], r["payload_digest"], r["payload_bytes"]) for r in by[5] + by[None]] == [("revisit", 2, digest, 163)] * 2
    assert by[7][0]["payload_bytes"] == 0 and by[8][0]["record_type"] == by[9][0]["record_type"] == "response"
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_single_records_are_fetched_by_seek(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    folder = shared_dir(spark) + "/warc"
    manifest = warc.write_bundles(pages, folder, frame_bytes=20_000)
    assert manifest.select("bundle", "frame").distinct().count() > 2
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    ids = spark.createDataFrame([(i,) for i in sorted(html)[:10]], "page_id long")
    for r in warc.fetch_records(manifest, folder, ids).collect():
        assert r["record_type"] == "revisit" or r["payload"] == html[r["page_id"]]


def brute(vectors, queries, k=10):
    out = {}
    for q, v in queries:
        rows = sorted((-sum(int(a) * int(b) for a, b in zip(v, w, strict=True)), i) for i, w in vectors if i != q and len(w) == len(v))
        out[q] = [(i, -s) for s, i in rows[:k]]
    return out


@pytest.mark.parametrize("scale", [1.0, 1e12])
def test_top_k_equals_brute_force(spark, scale):
    rng = np.random.default_rng(7)
    values = (rng.standard_normal((400, 8)) * rng.exponential(1, (400, 1)) * scale).astype(np.float32)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(values)]
    rows += [(1000 + i, rows[3][1]) for i in range(30)]
    whole = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows]
    odd = [(2000, None), (2001, [None] * 8), (2100, [float("nan")] * 8), (None, rows[0][1]), (2200, [1.0, 2.0]), (2201, [1.0, 2.0]), (2300, [])]
    vectors = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("norm", F.lit(1))
    queries = vectors.filter("vec_id % 100 = 0")
    got = {}
    for r in topk.exact_top_k(vectors, queries).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    limit = 2**63 - 1
    want = brute(whole, [w for w in whole if w[0] % 100 == 0])
    want = {q: [(i, max(-limit, min(limit, s))) for i, s in r] for q, r in want.items()}
    if scale == 1.0:
        assert {q: r for q, r in got.items() if q < 2000} == want
        two = 1024 * 1024 * 5
        assert got[2200] == [(2201, two)] and 2000 not in got and 2100 not in got
    else:
        assert all([s for _, s in got[q]] == [s for _, s in want[q]] for q in want)
    assert topk.exact_top_k(vectors.limit(0), queries).count() == 0
    assert topk.exact_top_k(vectors, queries.limit(0)).count() == 0


def test_queries_equal_their_sql(spark):
    c = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "embeddings"):
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    shape = lambda rows: sorted(str(tuple(None if x is None else str(x) for x in r)) for r in rows)
    for name, sql in ORACLES.items():
        df = QUERIES[name](spark, SF)
        columns = sorted(df.columns)
        want = c.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()
        assert shape(df.select(*columns).collect()) == shape(want), name


def test_pipeline_keeps_columns_and_packs_what_is_left(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    df = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = df
        df = corpus_pipeline.written(stage(spark, df, SF), name)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert df.columns == docs.columns
            assert df.join(before, "doc_id", "left_anti").count() == 0
    assert df.select("doc_id").distinct().count() == before.count() > 100
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "packing"]
