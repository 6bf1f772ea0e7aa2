"""Keyed state of streams, as-of maxima and identities against their plain forms."""

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from trolley.operators import alerts, clustering, history, relational
from trolley.streaming import jobs

START = dt.datetime(2024, 1, 1)


def landing():
    base = tempfile.mkdtemp(prefix="spark-")
    return f"{base}/in", f"{base}/rows", f"{base}/checkpoint"


def land(spark, rows, path, shape=jobs.HISTORY):
    spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(path)


def expected_changes(rows, expiry):
    """By definition: per key, ordered by time and price (null first), the price in cents differs, was null, or the gap is long."""
    cents = lambda p: None if p is None else int(round(p * 100 + 1e-9))
    out, keys = [], {}
    for r in rows:
        keys.setdefault(r[:2], []).append(r)
    for own in keys.values():
        own.sort(key=lambda r: (r[2], r[3] is not None, r[3] or 0))
        prev = None
        for r in own:
            gone = prev is not None and r[2] - prev[2] > expiry
            if prev is None or gone or prev[3] is None or (r[3] is not None and cents(prev[3]) != cents(r[3])):
                out.append(r)
            prev = r
    return sorted(map(str, out))


def test_streamed_changes_equal_the_batch_over_restarts(spark):
    random.seed(5)
    path, out, checkpoint = landing()
    rows, at = [], START
    for _ in range(300):
        at += dt.timedelta(hours=random.choice([1, 5, 200]))
        rows.append((random.choice(["s", "t"]), random.choice(["1", "2", None]), at, random.choice([None, 1.0, 1.004, 1.01, 2.0])))
    rows.append(rows[-1])
    stream = lambda: jobs.price_changes(spark.readStream.schema(jobs.HISTORY).parquet(path), "4000 days", 30)
    for k in range(3):  # each part in another run of the stream
        land(spark, rows[100 * k : 100 * k + 100] if k < 2 else rows[200:], path)
        jobs.run_to_end(stream(), out, checkpoint)
    jobs.run_to_end(stream(), out, checkpoint)  # nothing new
    got = [tuple(r) for r in jobs.history_rows(spark, out).collect()]
    assert sorted(map(str, got)) == expected_changes(rows, dt.timedelta(days=30))
    assert jobs.late_rows(spark, out).count() == 0
    land(spark, [("s", "1", START, 9.0), ("s", "1", None, 9.0), ("new", "1", START, 9.0)], path)
    jobs.run_to_end(stream(), out, checkpoint)
    assert [tuple(r) for r in jobs.late_rows(spark, out).collect()] == [("s", "1", 2)]
    assert jobs.history_rows(spark, out).count() == len(got) + 1
    twin = history.change_only_history(spark.createDataFrame(rows, jobs.HISTORY), ["store", "id"], ["ts", "price"])
    assert twin.count() <= len(got)  # without delisting


def test_state_of_delisted_keys_goes(spark):
    path, out, checkpoint = landing()
    stream = lambda: jobs.price_changes(spark.readStream.schema(jobs.HISTORY).parquet(path), "1 day", 10)
    day = dt.timedelta(days=1)
    land(spark, [("s", "old", START, 1.0), ("s", "kept", START, 1.0)], path)
    jobs.run_to_end(stream(), out, checkpoint)
    assert {r["id"] for r in jobs.last_prices(spark, checkpoint).collect()} == {"old", "kept"}
    land(spark, [("s", "kept", START + 9 * day, 1.0), ("s", "other", START + 14 * day, 2.0)], path)
    jobs.run_to_end(stream(), out, checkpoint)
    assert {(r["id"], r["ts"], r["price"]) for r in jobs.last_prices(spark, checkpoint).collect()} == {
        ("kept", START + 9 * day, 1.0), ("other", START + 14 * day, 2.0),
    }
    land(spark, [("s", "old", START + 15 * day, 1.0), ("s", "kept", START + 15 * day, 1.0)], path)
    jobs.run_to_end(stream(), out, checkpoint)
    assert sorted((r["id"], r["ts"]) for r in jobs.history_rows(spark, out).collect()) == [
        ("kept", START), ("old", START), ("old", START + 15 * day), ("other", START + 14 * day),
    ]


def test_alerts_are_told_once(spark):
    path, out, checkpoint = landing()
    shape = "product_id long, price double"
    wanted = spark.createDataFrame(
        [(7, 1, 10.0, True), (8, 1, 10.0, True), (9, 1, 10.0, False), (5, 1, 10.0, True), (7, 2, None, True)],
        "user_id long, product_id long, target_price double, active boolean",
    )
    log = spark.createDataFrame(
        [(8, 1, "preco_alvo", 8.5), (5, 1, "preco_alvo", None)], "user_id long, product_id long, kind string, price_at_notification double"
    )
    stream = lambda: jobs.streamed_alerts(wanted, spark.readStream.schema(shape).parquet(path), log)
    told = []
    for prices in ([9.2, 9.0], [9.0], [8.0, 8.4], [9.9], [8.0]):
        land(spark, [(1, p) for p in prices], path, shape)
        jobs.run_to_end(stream(), out, checkpoint)
        rows = {(r["user_id"], r["current"]) for r in spark.read.parquet(out).collect()}
        told.append(rows - set().union(*told))
    assert told == [{(7, 9.0)}, set(), {(7, 8.0), (8, 8.0)}, set(), set()]
    assert all(r["message"].startswith("Preço-alvo atingido: ") for r in spark.read.parquet(out).collect())


@pytest.mark.parametrize("span", [1, 7, 366])
def test_highest_since_equals_brute_force(spark, span):
    random.seed(span)
    day = lambda n: START.date() + dt.timedelta(days=n)
    facts = [(random.choice([1, 1, 1, 2, 3, None]), day(random.randint(-40, 40)), random.choice([None, random.randint(1, 99)])) for _ in range(400)] + [(1, None, 500)]
    marks = [(random.choice([1, 2, 3, 4]), day(random.randint(-60, 60))) for _ in range(80)] + [(1, None), (None, day(0))]
    f = spark.createDataFrame(facts, "product_id long, day date, price int")
    m = spark.createDataFrame(marks, "product_id long, created_at date")
    got = {(r[0], r[1]): r[2] for r in relational.highest_since(m, f, "product_id", "created_at", "day", "price", span).filter("product_id is not null").collect()}
    expected = {}
    for p, since in marks:
        found = [v for q, d, v in facts if q == p and p is not None and since is not None and d is not None and d >= since and v is not None]
        if found:
            expected[p, since] = max(found)
    assert got == expected


def test_favourites_of_a_hot_product(spark):
    """A third of all marks and prices of one product: no task sorts more than its days, and no pair is built."""
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 700).cast("int"))
    product = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000)
    prices = spark.range(60_000).select(product.alias("product_id"), day.alias("day"), (100 + F.col("id") * 7 % 50).cast("double").alias("price"))
    marks = spark.range(30_000).select(F.col("id").alias("user_id"), product.alias("product_id"), day.alias("created_at"))
    now = prices.groupBy("product_id").agg(F.min("price").alias("current"))
    got = alerts.favourite_drops(marks, prices, now)
    pairs = marks.join(prices, "product_id").filter("day >= created_at").groupBy("user_id", "product_id").agg(F.max("price").alias("base")).join(now, "product_id")
    want = pairs.filter("(base - current) / base >= 0.1").select("user_id", "product_id", "current", "base")
    assert got.drop("kind").exceptAll(want).isEmpty() and got.count() == want.count() > 1000


def test_best_scored_and_images(spark):
    rows = spark.createDataFrame([("k", 1.0, "b"), ("k", 2.0, "c"), ("k", 2.0, "a"), ("k", None, "z"), ("n", None, "y")], "key string, score double, u string")
    assert sorted(tuple(r) for r in relational.best_scored(rows, ["key"], "score", ["u"]).collect()) == [("k", 2.0, "a"), ("n", None, "y")]
    products = spark.createDataFrame(
        [("Leite", "M", "https://cdn.lidl.pt/1", 0.5), ("leite ", "m", "https://cdn.aldi.pt/2", 0.9), ("Pão", None, "https://x.org/3", None), ("Sal", "", "/storage/4", 1.0), ("Mel", "", None, 1.0), ("Ovo", "", "https://cdn.lidl.pt/5", 1.0)],
        "name string, brand string, image_url string, match_score double",
    )
    from trolley.functions.text import store_of_url

    got = history.image_hotlinks(products, spark.createDataFrame([("ovo|",)], "key string"), store_of_url)
    assert sorted(tuple(r) for r in got.collect()) == [("leite|m", "aldi", "https://cdn.aldi.pt/2", "migrate"), ("pão|", "outro", "https://x.org/3", "unknown_host")]


def test_a_sourced_row_is_fused_with_its_older_twin(spark):
    clusters = spark.createDataFrame([("k1", "lidl::u1"), ("k2", "lidl::u2"), ("k3", "aldi::u3"), ("k3", "lidl::u4")], "cluster string, node string")
    records = spark.createDataFrame([("k1", "Leite", "M"), ("k2", "leite", "m"), ("k3", "Sal", None)], "cluster string, name string, brand string")
    sources = spark.createDataFrame([("p1", "lidl", "u1"), ("p9", "aldi", "u3"), ("p9", "lidl", "u1")], "product_id string, store string, url string")
    products = spark.createDataFrame(
        [("p1", "x", "", 5), ("p0", "LEITE ", "M", 1), ("p2", "leite", "m", 3), ("p9", "sal", "", 9), (None, None, None, 0)],
        "product_id string, name string, brand string, created_at int",
    )
    claims = clustering.claim_identities(clusters, records, sources, products)
    # p0, the oldest of the name, goes to the first cluster that asks; p9, listed in two clusters, to one.
    assert sorted(map(tuple, claims.collect())) == [("k1", "p0"), ("k1", "p1"), ("k1", "p9")]
    assert dict(map(tuple, clustering.fuse_identities(claims, products).collect())) == {"p0": "p0", "p1": "p0", "p9": "p0"}


def test_alerts_of_many_users_take_few_calls(spark, monkeypatch):
    """5,000 users watch one product with repeated prices, a null user and a null log entry among them: one state call a bucket."""
    calls = f"{tempfile.mkdtemp(prefix='spark-')}/calls"
    handle = jobs.TellOnce.handleInputRows

    class Counted(jobs.TellOnce):
        def handleInputRows(self, key, rows, timerValues):
            with open(calls, "a") as f:
                f.write("x")
            yield from handle(self, key, rows, timerValues)

    monkeypatch.setattr(jobs, "TellOnce", Counted)
    path, out, checkpoint = landing()
    user = F.when(F.col("id") > 0, F.col("id"))
    wanted = spark.range(5000).select(user.alias("user_id"), F.lit(1).alias("product_id"), F.lit(10.0).alias("target_price"), F.lit(True).alias("active"))
    log = spark.createDataFrame([(1, 1, None), (2, 1, 8.0), (None, 2, None), (3, None, 1.0)], "user_id long, product_id long, price_at_notification double").withColumn("kind", F.lit("preco_alvo"))
    for prices in ([9.0, 8.5, None, float("nan")], [8.0, 7.0]):
        land(spark, [(1, p) for p in prices] + [(None, 1.0)], path, "product_id long, price double")
        stream = jobs.streamed_alerts(wanted, spark.readStream.schema("product_id long, price double").parquet(path), log, buckets=8)
        jobs.run_to_end(stream, out, checkpoint)
    rows = spark.read.parquet(out).groupBy("user_id").agg(F.array_sort(F.collect_list("current")).alias("told"), F.max("base").alias("base")).collect()
    got = {r["user_id"]: r["told"] for r in rows}
    assert got == {u: [7.0] if u == 2 else [7.0, 8.5] for u in [None, *range(2, 5000)]} and {r["base"] for r in rows} == {10.0}
    assert len(open(calls).read()) <= 2 * 9
