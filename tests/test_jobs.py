"""Pages, history, alerts, search, quality and streams on small fixtures."""

import datetime as dt
import random
import tempfile

from pyspark.sql import functions as F

from trolley.functions.classify import classify_beverage
from trolley.operators import alerts, history, quality, relational, search
from trolley.sources import pages as P
from trolley.streaming import jobs


SF = "/root/testdata/sf0.001"


def page(body):
    crumbs = '<div class="breadcrumb"><a href="/">Home</a><a>Frescos</a><a>Iogurtes</a></div>'
    return f"<html>{crumbs}{body}</html>"


LD = '<script type="application/ld+json">{}</script>'


def test_product_pages_give_offer_or_first_reason(spark):
    offer = '{"@type":"Product","sku":"%s","name":"Iogurte","gtin13":"123","offers":{"price":"%s","availability":"%s"}}'
    pages = [
        "<html></html>",
        page(LD.format("{bad")),
        page(LD.format('{"@type":"Product","name":"x"}')),
        page(LD.format(offer % ("1", "1.0", "https://schema.org/OutOfStock"))),
        page(LD.format(offer % ("1", "0", "InStock"))),
        "<html>" + LD.format(offer % ("1", "1.5", "InStock")) + "</html>",
        page(LD.format(offer % ("1", "1.5", "https://schema.org/InStock"))),
    ]
    df = spark.createDataFrame([(i, "u", h) for i, h in enumerate(pages)], "page_id long, url string, html string")
    rows = P.product_offers(df).orderBy("page_id").collect()
    assert [r["reason"] for r in rows] == [
        "sem_ld_json",
        "erro_parse_json",
        "sem_dados_essenciais",
        "fora_de_stock",
        "preco_zero_ou_invalido",
        "sem_classificacao",
        None,
    ]
    assert (rows[6]["price"], rows[6]["barcode"], rows[6]["subcategory"]) == (1.5, "123", "iogurtes")


def test_other_page_shapes(spark):
    def frame(html, url="https://x/home/produtos/ovos/a/b-7.html"):
        return spark.createDataFrame([(1, url, html)], "page_id long, url string, html string")

    two = LD.format('{"@type":"BreadcrumbList","itemListElement":[{"position":2,"name":"Iogurtes"},{"position":1,"name":"F"}]}')
    two += LD.format('{"@type":"Product","sku":"9","name":"n","offers":{"price":"2.5"}}')
    row = P.multi_block_offers(frame(two)).first()
    assert (row["id"], row["price"], row["subcategory"]) == ("9", 2.5, "iogurtes")
    info = "{&quot;items&quot;:[{&quot;item_id&quot;:&quot;5&quot;,&quot;item_name&quot;:&quot;Ovos&quot;,&quot;price&quot;:3.0}]}"
    row = P.attribute_offers(frame(f'<div data-gtm-info="{info}"></div>')).first()
    assert (row["id"], row["price"], row["subcategory"]) == ("5", 3.0, "ovos")
    inner = '[{"key":"PRODUCT_DETAIL_GET","res":{"id":"3","name":"n","available":true,"price":{"value":4.0},"assets":[{"url":"a","primary":false},{"url":"b","primary":true}]}}]'
    import json

    outer = json.dumps({"props": {"pageProps": {"apiData": inner}}})
    row = P.double_encoded_offers(frame(f'<script id="__NEXT_DATA__" type="application/json">{outer}</script>')).first()
    assert (row["id"], row["image_url"]) == ("3", "b")
    doc = '{"id":"1","fullTitle":"t","category":"bebidas/agua","havingPrice":true,"price":{"price":1.0},"brand":{"name":"B","showBrand":false},"eans":["77"],"mainImageId":"m","images":{"m":"u"}}'
    row = P.nested_offers(spark.createDataFrame([(doc,)], "json string")).first()
    assert (row["brand"], row["barcode"], row["image_url"], row["subcategory"]) == (None, "77", "u", "agua")
    tile = """<div class="product " data-product-tile-impression="{&quot;id&quot;:&quot;1&quot;,&quot;name&quot;:&quot;n&quot;,&quot;price&quot;:1.5}"><a href="/a-1.html"></a><div class="pwc-tile--price-secondary">3,18 €/kg</div></div>"""
    rows = P.listing_offers(frame(tile + '<div class="product " data-product-tile-impression="{bad"></div>')).collect()
    assert [(r["id"], r["price"], r["price_per_unit"]) for r in rows] == [("1", 1.5, 3.18)]
    xml = spark.createDataFrame([("<loc>a-product.xml</loc><loc>b.xml</loc>",)], "xml string")
    assert P.product_sitemaps(P.sitemap_locations(xml)).collect()[0]["url"] == "a-product.xml"


def test_history_replay_is_idempotent(spark):
    rows = [("s", "1", 1, 1.99), ("s", "1", 2, 1.99), ("s", "1", 3, 2.0), ("s", "2", 1, None)]
    df = spark.createDataFrame(rows, "store string, id string, n int, price double")
    once = history.change_only_history(df, ["store", "id"], ["n"])
    assert sorted((r["id"], r["n"]) for r in once.collect()) == [("1", 1), ("1", 3), ("2", 1)]
    assert history.change_only_history(once, ["store", "id"], ["n"]).count() == once.count()
    last = relational.latest(once, ["store", "id"], ["n"])
    assert history.history_increment(last, df.filter("n = 3"), ["store", "id"]).count() == 0


def test_upsert_keeps_name_and_image(spark):
    shape = "store string, external_id string, name string, price double, image_url string"
    old = spark.createDataFrame([("s", "1", "old", 1.0, "i")], shape)
    new = spark.createDataFrame([("s", "1", "new", 2.0, None), ("s", "2", "n2", 3.0, None)], shape)
    got = {r["external_id"]: tuple(r)[2:] for r in history.upsert_snapshot(old, new).collect()}
    assert got == {"1": ("old", 2.0, "i"), "2": ("n2", 3.0, None)}


def test_maintenance(spark):
    p = spark.createDataFrame(
        [(1, "Vinho Tinto", "NESTLÉ", None, "bebidas", "continente"), (2, "x", None, "agua", "bebidas", "continente")],
        "product_id long, name string, brand string, subcategory string, category string, store string",
    )
    assert [r["new_brand"] for r in history.backfill_brands(p).collect()] == ["Nestlé"]
    filled = history.backfill_subcategory(p, classify_beverage, "continente", "bebidas").orderBy("product_id").collect()
    assert [r["subcategory"] for r in filled] == ["vinho", "agua"]
    approved = p.withColumn("confidence", F.lit("high")).withColumn("match_score", F.lit(None).cast("double"))
    rows, removed = history.reaudit_by_survivors(approved, p.filter("product_id = 2"), F.lit(True))
    assert [r["product_id"] for r in removed.collect()] == [1] and rows.first()["match_score"] == 0.0
    rows, removed = history.reaudit_by_ids(approved, spark.createDataFrame([(2,), (2,), (9,)], "product_id long"))
    assert removed.count() == 1


def test_alerts(spark):
    now = spark.createDataFrame([(1, 9.0), (2, 95.0)], "product_id long, current double")
    wanted = spark.createDataFrame(
        [(7, 1, 10.0, True), (7, 2, 97.0, True), (8, 1, 10.0, False), (9, 1, None, True)],
        "user_id long, product_id long, target_price double, active boolean",
    )
    due = alerts.target_alerts(wanted, now)
    assert [(r["user_id"], r["product_id"]) for r in due.collect()] == [(7, 1)]
    log = spark.createDataFrame([(7, 1, "preco_alvo", None)], "user_id long, product_id long, kind string, price_at_notification double")
    assert alerts.not_logged(due, log).count() == 0
    assert alerts.not_logged(due, log.fillna(9.5)).count() == 1
    assert alerts.with_message(due).first()["message"] == "Preço-alvo atingido: 9,00€"
    profiles = spark.sql("select 1L user_id, 't' push_token, named_struct('precoAlvo', true) prefs union all select 2L, null, named_struct('precoAlvo', true)")
    assert alerts.eligible_users(profiles, "precoAlvo").count() == 1
    day = dt.datetime(2024, 5, 1)
    baskets = spark.createDataFrame([(1, day, 10.0, 2.0), (1, day, 5.0, 0.0)], "user_id long, created_at timestamp, total double, savings double")
    none = spark.createDataFrame([], "user_id long, kind string, created_at timestamp")
    users = spark.createDataFrame([(1,), (2,)], "user_id long")
    rows = alerts.weekly_summary(users, baskets, none, F.lit(dt.datetime(2024, 5, 2))).collect()
    assert [r["message"] for r in rows] == ["Esta semana: 2 cestos, 15,00€, poupou 2,00€"]


def test_search_tiers_equal_brute_force(spark):
    rows = [
        ("1", "Leite", "Mimosa", "laticinios_ovos", "leite"),
        ("2", "Leite Gordo", "Mimosa", "laticinios_ovos", "leite"),
        ("3", "Gordo Pão de Leite", "", "padaria_pastelaria", "pao"),
        ("4", "Arroz", "Leite Bom", "x", None),
        ("5", "Leita", None, "x", None),
        ("6", "Parafuso", "Z", "x", None),
    ]
    products = spark.createDataFrame(rows, "id string, name string, brand string, category string, subcategory string")
    docs = search.search_documents(products)
    q = spark.createDataFrame([(1, "leite"), (2, "leite gordo"), (3, "de"), (4, "")], "query_id int, q string")
    got = {(r["query_id"], r["id"]): r["tier"] for r in search.search(docs, q).collect()}
    assert got[1, "1"] == 1 and got[1, "4"] == 2 and got[1, "2"] == 3 and got[1, "5"] == 5
    assert got[2, "2"] == 1 and got[2, "3"] == 4
    assert not any(k[0] == 4 or k[1] == "6" for k in got)
    terms = spark.createDataFrame([("yogurt",), ("arroz",)], "term string")
    assert [r["forms"] for r in search.expand_terms(terms).collect()] == [["iogurte", "yogurte", "yogurt"], ["arroz"]]
    s = search.suggestions(products, spark.createDataFrame([(1, "lei")], "query_id int, q string")).orderBy("place").collect()
    assert [r["label"] for r in s] == ["Leite Bom", "Leita", "Leite", "Leite Gordo"]


def test_search_asks_for_every_twentieth_row(spark):
    from trolley.plans import queries

    ids = [int(r["id"]) for r in queries.part_catalogue(spark, SF).select("id").collect()]
    got = {(r["query_id"], r["id"]): r["tier"] for r in queries.tiered_search(spark, SF).collect()}
    wanted = {i for i in ids if i % 20 == 0}
    assert wanted and {q for q, _ in got} == wanted
    assert all(got[i, str(i)] == 1 for i in wanted)


def test_quality(spark):
    df = spark.createDataFrame([(1, True), (2, False)], "id int, bad boolean")
    assert quality.run_guard(df, F.col("bad")).first()["verdict"] == "too_many_errors"
    assert quality.run_guard(df.limit(0), F.col("bad")).first()["verdict"] == "empty"
    s = spark.createDataFrame([(str(i),) for i in range(103)], "id string")
    assert relational.systematic_sample(s, [F.col("id").cast("int")], 10).count() == 10
    assert relational.systematic_sample(s.limit(0), ["id"], 10).count() == 0
    many = spark.range(0, 300_000, 1, 12).select(((F.col("id") * 7_919) % 300_000).alias("id"))
    drawn = sorted(r["id"] for r in relational.systematic_sample(many, ["id"], 1000).collect())
    assert drawn == list(range(0, 300_000, 300))
    urls = spark.createDataFrame([("https://a/x/1",), ("https://b/x",)], "url string")
    prefixes = spark.createDataFrame([("https://a/x",), ("https://a/x/1/2",)], "prefix string")
    assert relational.within_scope(urls, prefixes).count() == 1


def run(stream, name, mode="append"):
    q = (
        stream.writeStream.outputMode(mode).format("memory").queryName(name)
        .option("checkpointLocation", tempfile.mkdtemp(prefix="spark-")).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return stream.sparkSession.table(name)


def test_streamed_history_equals_batch(spark):
    t = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    rows = [("s", "1", t(1), 1.0), ("s", "1", t(2), 1.0), ("s", "1", t(3), 1.5), ("s", "2", t(1), 2.0), ("s", "1", t(4), 1.0)]
    rows += [("s", "3", t(1), None), ("s", "3", t(2), 0.12), ("s", "3", t(3), None), ("s", "3", t(4), 0.12), ("s", "3", t(5), 0.125)]
    path = tempfile.mkdtemp(prefix="spark-") + "/in"
    df = spark.createDataFrame(rows, jobs.HISTORY)
    df.coalesce(1).write.parquet(path)
    stream = spark.readStream.schema(jobs.HISTORY).parquet(path)
    base = tempfile.mkdtemp(prefix="spark-")
    jobs.run_to_end(jobs.price_changes(stream), f"{base}/rows", f"{base}/checkpoint")
    got = jobs.history_rows(spark, f"{base}/rows")
    want = history.change_only_history(df, ["store", "id"], ["ts"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.filter("id = '3'").count() == 4
    fresh = run(jobs.freshness(stream), "fresh_rows", "complete")
    assert fresh.first()["newest"] == t(5)
    first = run(jobs.first_in_run(stream), "first_rows")
    assert first.count() == 3
    spend = run(jobs.weekly_spend(df_stream(spark, path)), "spend_rows", "complete")
    assert spend.filter("user_id = 1").count() == 7


def test_merged_and_failed_rows_move(spark):
    products = spark.createDataFrame(
        [(1, "/storage/a.png"), (2, "http://x/b.png"), (3, "/storage/c.png"), (4, "/storage/d.png"), (5, None)], "product_id long, image_url string"
    )
    outcomes = spark.createDataFrame(
        [(1, 2, "merged"), (3, 4, "merged"), (5, None, "no_target")], "product_id long, target long, outcome string"
    )
    day = dt.date(2024, 1, 1)
    prices = spark.createDataFrame(
        [(1, "s", day, 1.0), (1, "t", day, 2.0), (2, "s", day, 3.0), (5, "s", day, 4.0)], "product_id long, store string, day date, price double"
    )
    kept, moved = history.apply_legacy_merge(products, prices, outcomes)
    assert {tuple(r) for r in kept.collect()} == {(2, "/storage/a.png"), (4, "/storage/d.png"), (5, None)}
    assert {(r["product_id"], r["store"], r["price"]) for r in moved.collect()} == {(2, "t", 2.0), (2, "s", 3.0), (5, "s", 4.0)}
    approved = spark.createDataFrame(
        [(1, "n", "", "c", 0.8), (2, "m", "", "c", 0.9)], "product_id long, name string, brand string, category string, match_score double"
    )
    judged = spark.createDataFrame([(1, "failed_auto"), (2, "failed_manual")], "product_id long, outcome string")
    review, gone = history.failed_moves(approved, judged)
    assert review.first()["status"] == "reaudit_pending" and [r[0] for r in gone.collect()] == [1]


def df_stream(spark, path):
    return spark.readStream.schema(jobs.HISTORY).parquet(path).select(
        F.col("id").cast("long").alias("user_id"), "ts", F.col("price").alias("amount")
    )


def test_reclassify_details_and_unit_price_audit(spark):
    from trolley.functions.classify import classify_breadcrumb

    p = spark.createDataFrame(
        [(1, "Chocolate Negro", "Fruta / Chocolates", "frutas_legumes", "fruta"), (2, "Maçã", "Fruta", "frutas_legumes", "fruta"), (3, "Chocolate", "?", "frutas_legumes", "fruta")],
        "id int, name string, breadcrumb string, category string, subcategory string",
    )
    rows = history.reclassify_suspects(p, "chocolate", lambda c: classify_breadcrumb(c, 2)).orderBy("id").collect()
    assert [(r["subcategory"], r["changed"]) for r in rows] == [("chocolates_doces", True), ("fruta", False), ("fruta", False)]
    key = "store_a string, store_b string, name_a string, name_b string, price_per_unit_a double, price_per_unit_b double"
    review = spark.createDataFrame([("a", "b", "x", "y", None, None), ("a", "b", "z", "y", 1.0, 2.0)], key)
    details = spark.createDataFrame([("a", "b", "x", "y", 3.0, 4.0, 1), ("a", "b", "x", "y", 5.0, 6.0, 2), ("a", "b", "z", "y", 9.0, 9.0, 1)], key + ", ordinal int")
    got = {r["name_a"]: (r["price_per_unit_a"], r["price_per_unit_b"]) for r in history.fill_review_details(review, details).collect()}
    assert got == {"x": (5.0, 6.0), "z": (1.0, 2.0)}
    approved = spark.createDataFrame([(1, "n", "", "high"), (2, "m", "", "manual"), (3, "q", "", "high")], "product_id int, name string, brand string, confidence string")
    side = "named_struct('id', '1', 'name', '{0}', 'brand', '', 'price_per_unit', {1}D)"
    matches = spark.sql(f"select {side.format('n', 1.0)} a, {side.format('n', 1.1)} b, 1.0D score union all select {side.format('m', 1.0)}, {side.format('m', 2.0)}, 1.0D")
    got = {r["product_id"]: r["outcome"] for r in history.reaudit_by_unit_price(approved, matches).collect()}
    assert got == {1: "ok", 2: "failed_manual", 3: "not_found"}


def test_every_query_is_registered_and_stable():
    import __spark_entry__ as entry

    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) >= 55
