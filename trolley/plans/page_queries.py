"""Queries of the page extractors, over pages put together from the parts; SQL states what each page holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.plans.registry import query
from trolley.sources import pages as P
from trolley.sources.catalogue import table

K = "p_partkey"
#: The last breadcrumb of a page by its number, and the class that is known for it.
CRUMBS = ("Iogurtes", "Arroz", "Cerveja", "Parafusos")
CLASS_SQL = """CASE p_partkey % 4 WHEN 0 THEN 'laticinios_ovos' WHEN 1 THEN 'mercearia_doce_salgada' WHEN 2 THEN 'bebidas' END AS category,
    CASE p_partkey % 4 WHEN 0 THEN 'iogurtes' WHEN 1 THEN 'massas_arroz' WHEN 2 THEN 'cerveja' END AS subcategory"""
PRICE_SQL = "p_partkey % 1000 + (p_partkey % 9 + 1) / 10.0"


def text(*parts: Column | str) -> Column:
    """Columns and literals side by side."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _parts(spark, sf_dir) -> DataFrame:
    k = F.col(K)
    crumb = F.element_at(F.array(*[F.lit(c) for c in CRUMBS]), (k % 4).cast("int") + 1)
    price = text(k % 1000, ".", k % 9 + 1)
    return table(spark, sf_dir, "part").select(K, k.alias("page_id"), "p_name", "p_brand", crumb.alias("crumb"), price.alias("price"))


def product_pages(spark, sf_dir) -> DataFrame:
    """A page for each part: by its number without JSON, with broken JSON, without sku, out of stock, without a price, and whole."""
    k = F.col(K)
    kind = k % 10
    sku = F.when(kind == 2, "").otherwise(text('"sku":"', k, '",'))
    brand = F.when(k % 2 == 1, text('"brand":{"@type":"Brand","name":"', F.col("p_brand"), '"},')).otherwise("")
    code = F.when(k % 3 == 0, text('"gtin13":"560', k, '",')).when(k % 3 == 1, text('"gtin14":"9', k, '","gtin8":"8', k, '",')).otherwise("")
    image = F.when(k % 5 == 0, text('"image":["https://i.example/', k, '.png","x"],')).when(k % 5 == 1, text('"image":"https://i.example/', k, '.png",')).otherwise("")
    value = (
        F.when(kind == 4, "0").when(kind == 5, '"abc"').when(kind == 6, text('"', F.replace("price", F.lit("."), F.lit(",")), '"'))
        .when(kind == 7, text('"', F.col("price"), '"')).otherwise(F.col("price"))
    )
    stock = F.when(kind == 3, "https://schema.org/OutOfStock").otherwise("https://schema.org/InStock")
    ld = text('{"@type":"Product",', sku, '"name":"', F.col("p_name"), '",', brand, code, image, '"offers":{"price":', value, ',"availability":"', stock, '"}}')
    ld = F.when(kind == 1, "{bad").otherwise(ld)
    block = F.when(kind == 0, "").otherwise(text('<script type="application/ld+json">', ld, "</script>"))
    marked = F.when(k % 5 == 2, text('<img class="a" itemprop="image" src="https://m.example/', k, '.jpg">')).otherwise("")
    crumbs = text('<div class="breadcrumb"><a href="/">Home</a>\n<a href="/l"> Loja </a><a><b>', F.col("crumb"), "</b></a></div>")
    html = text("<html>", crumbs, block, marked, "</html>")
    return _parts(spark, sf_dir).select("page_id", text("https://s.example/p-", k, ".html").alias("url"), html.alias("html"))


OFFERS_SQL = f"""
    SELECT p_partkey AS page_id, CASE WHEN ok AND kind <> 2 THEN CAST(p_partkey AS VARCHAR) END AS id, CASE WHEN ok THEN p_name END AS name,
        CASE WHEN ok AND p_partkey % 2 = 1 THEN p_brand END AS brand,
        CASE WHEN NOT ok OR kind = 5 THEN NULL WHEN kind = 4 THEN 0.0 ELSE CAST({PRICE_SQL} AS DOUBLE) END AS price,
        CASE WHEN NOT ok THEN NULL WHEN p_partkey % 3 = 0 THEN '560' || p_partkey WHEN p_partkey % 3 = 1 THEN '8' || p_partkey END AS barcode,
        CASE WHEN ok AND p_partkey % 5 < 2 THEN 'https://i.example/' || p_partkey || '.png'
            WHEN p_partkey % 5 = 2 THEN 'https://m.example/' || p_partkey || '.jpg' END AS image_url,
        category, subcategory,
        CASE kind WHEN 0 THEN 'sem_ld_json' WHEN 1 THEN 'erro_parse_json' WHEN 2 THEN 'sem_dados_essenciais' WHEN 3 THEN 'fora_de_stock'
            WHEN 4 THEN 'preco_zero_ou_invalido' WHEN 5 THEN 'preco_zero_ou_invalido'
            ELSE CASE WHEN subcategory IS NULL THEN 'sem_classificacao' END END AS reason
    FROM (SELECT *, p_partkey % 10 AS kind, p_partkey % 10 > 1 AS ok, {CLASS_SQL} FROM part)"""


@query(OFFERS_SQL)
def page_offers(spark, sf_dir):
    """An offer or the first reason against it for every product page."""
    return P.product_offers(product_pages(spark, sf_dir)).drop("url")


@query(f"SELECT * EXCLUDE (reason) FROM ({OFFERS_SQL}) WHERE reason IS NULL")
def streamed_page_offers(spark, sf_dir):
    """The same pages as arriving files, through the same extraction; offers only."""
    from trolley.sources.shared import shared_dir
    from trolley.streaming import jobs

    base = shared_dir(spark)
    pages = product_pages(spark, sf_dir)
    pages.write.parquet(f"{base}/landing")
    offers = jobs.landing_offers(spark, f"{base}/landing", pages.schema, P.product_offers)
    jobs.run_to_end(offers.filter("reason is null").drop("url", "reason"), f"{base}/offers", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/offers")


@query("SELECT coalesce(reason, '(vazio)') AS value, count(*) AS n FROM (" + OFFERS_SQL + ") GROUP BY ALL")
def offer_reasons(spark, sf_dir):
    from trolley.operators.relational import counts_by

    return counts_by(P.product_offers(product_pages(spark, sf_dir)), "reason")


@query(
    f"""SELECT p_partkey AS page_id, CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_brand AS brand, CAST({PRICE_SQL} AS DOUBLE) AS price,
        CASE p_partkey % 3 WHEN 0 THEN '560' || p_partkey WHEN 1 THEN '7' || p_partkey END AS barcode, {CLASS_SQL}
    FROM part WHERE p_partkey % 6 <> 0 AND p_partkey % 7 <> 0"""
)
def multi_block_pages(spark, sf_dir):
    """Pages with three JSON blocks, one broken; the breadcrumb's items stand in falling order. Every seventh price is no number."""
    k = F.col(K)
    code = F.when(k % 3 == 0, text('"gtin":"1","gtin13":"560', k, '",')).when(k % 3 == 1, text('"gtin12":"7', k, '",')).otherwise("")
    value = F.when(k % 7 == 0, '"none"').otherwise(F.col("price"))
    stock = F.when(k % 6 == 0, "OutOfStock").otherwise("InStock")
    product = text('{"@type":"Product","sku":"', k, '","name":"', F.col("p_name"), '",', code, '"brand":{"name":"', F.col("p_brand"), '"},"offers":{"price":', value, ',"availability":"https://schema.org/', stock, '"}}')
    crumbs = text('{"@type":"BreadcrumbList","itemListElement":[{"position":2,"item":{"name":"', F.col("crumb"), '"}},{"position":1,"name":"Loja"}]}')
    block = lambda x: text('<script type="application/ld+json">', x, "</script>")
    html = text("<html>", block(F.lit("{bad")), block(crumbs), block(product), "</html>")
    return P.multi_block_offers(_parts(spark, sf_dir).select("page_id", F.lit("u").alias("url"), html.alias("html"))).drop("url")


@query(
    f"""SELECT p_partkey AS page_id, CAST(p_partkey AS VARCHAR) AS id, p_name || ' & co' AS name, p_brand AS brand,
        CAST(CASE WHEN p_partkey % 2 = 0 THEN {PRICE_SQL} ELSE p_partkey % 50 END AS DOUBLE) AS price,
        CASE WHEN p_partkey % 3 <> 0 THEN 'laticinios_ovos' END AS category, CASE WHEN p_partkey % 3 <> 0 THEN 'ovos' END AS subcategory
    FROM part WHERE p_partkey % 2 = 0 OR p_partkey % 50 <> 0"""
)
def attribute_pages(spark, sf_dir):
    """Pages with escaped JSON in attributes, the first of them without an id; every other page shows its price itself."""
    k = F.col(K)
    info = text('{"items":[{"item_id":"', k, '","item_name":"', F.col("p_name"), ' & co","item_brand":"', F.col("p_brand"), '","price":', k % 50, "}]}")
    escaped = F.replace(F.replace(info, F.lit("&"), F.lit("&amp;")), F.lit('"'), F.lit("&quot;"))
    shown = F.when(k % 2 == 0, text('<span itemprop="price" content="', F.col("price"), '"></span>')).otherwise("")
    html = text('<div data-gtm-info="{&quot;items&quot;:[{}]}"></div><div data-gtm-info="', escaped, '"></div>', shown)
    url = text("https://s.example/home/produtos/", F.when(k % 3 == 0, "zzz").otherwise("ovos"), "/a/b-", k, ".html")
    return P.attribute_offers(_parts(spark, sf_dir).select("page_id", url.alias("url"), html.alias("html"))).drop("url")


@query(
    f"""SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS brand,
        CAST({PRICE_SQL} AS DOUBLE) AS price, CASE WHEN p_partkey % 3 = 0 THEN '77' || p_partkey END AS barcode,
        CASE WHEN p_partkey % 4 = 1 THEN 'https://i.example/' || p_partkey END AS image_url, 'bebidas' AS category, 'agua' AS subcategory
    FROM part WHERE p_partkey % 5 <> 0 AND p_partkey % 11 <> 0"""
)
def nested_documents(spark, sf_dir):
    """JSON documents: every fifth is unpriced, every eleventh has no number, images are looked up by id."""
    k = F.col(K)
    value = F.when(k % 11 == 0, "null").otherwise(F.col("price"))
    codes = F.when(k % 3 == 0, text('["77', k, '","2"]')).otherwise("[]")
    main = F.when(k % 4 == 1, "a").otherwise("z")
    doc = text('{"id":"', k, '","fullTitle":"', F.col("p_name"), '","category":"bebidas/agua","havingPrice":', (k % 5 != 0).cast("string"), ',"price":{"price":', value, '},"brand":{"name":"', F.col("p_brand"), '","showBrand":', (k % 2 == 0).cast("string"), '},"eans":', codes, ',"mainImageId":"', main, '","images":{"b":"x","a":"https://i.example/', k, '"}}')
    return P.nested_offers(_parts(spark, sf_dir).select(doc.alias("json")))


@query(
    f"""SELECT p_partkey AS page_id, CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_brand AS brand, CAST({PRICE_SQL} AS DOUBLE) AS price,
        CASE WHEN p_partkey % 3 = 0 THEN 'second' ELSE 'first' END AS image_url
    FROM part WHERE p_partkey % 6 <> 0"""
)
def double_encoded_pages(spark, sf_dir):
    """Pages whose data is JSON in a JSON string; every sixth product is not available, every third has a primary image."""
    k = F.col(K)
    inner = text('[{"key":"OTHER","res":{}},{"key":"PRODUCT_DETAIL_GET","res":{"id":"', k, '","name":"', F.col("p_name"), '","brandName":"', F.col("p_brand"), '","available":', (k % 6 != 0).cast("string"), ',"price":{"value":', F.col("price"), '},"assets":[{"url":"first","primary":false},{"url":"second","primary":', (k % 3 == 0).cast("string"), "}]}}]")
    escaped = F.replace(inner, F.lit('"'), F.lit('\\"'))
    html = text('<script id="__NEXT_DATA__" type="application/json">{"props":{"pageProps":{"apiData":"', escaped, '"}}}</script>')
    return P.double_encoded_offers(_parts(spark, sf_dir).select("page_id", html.alias("html")))


@query(
    f"""SELECT p_partkey // 5 AS page_id, CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_brand AS brand, CAST({PRICE_SQL} AS DOUBLE) AS price,
        'c' AS category, '/p-' || p_partkey || '.html' AS url, CASE WHEN p_partkey % 3 = 0 THEN '/i' || p_partkey || '.png' END AS image_url,
        CAST(p_partkey % 20 + 0.25 AS DOUBLE) AS price_per_unit
    FROM part WHERE p_partkey % 4 <> 0"""
)
def listing_tiles(spark, sf_dir):
    """Listing pages of up to five tiles; the JSON of every fourth tile is broken."""
    k = F.col(K)
    data = text('{"id":"', k, '","name":"', F.col("p_name"), '","brand":"', F.col("p_brand"), '","price":', F.col("price"), ',"category":"c"}')
    data = F.replace(F.when(k % 4 == 0, text("{", k)).otherwise(data), F.lit('"'), F.lit("&quot;"))
    image = F.when(k % 3 == 0, text('<img class="t" src="/i', k, '.png">')).otherwise("")
    unit = text('<div class="pwc-tile--price-secondary col">', k % 20, ",25&nbsp;&euro;/kg</div>")
    tile = text('<div class="product " data-product-tile-impression="', data, '"><a href="/p-', k, '.html"></a>', image, unit, "</div>")
    pages = _parts(spark, sf_dir).select(F.floor(k / 5).alias("page_id"), F.struct(K, tile.alias("tile")).alias("t")).groupBy("page_id")
    pages = pages.agg(F.array_join(F.transform(F.array_sort(F.collect_list("t")), lambda x: x["tile"]), "\n").alias("tiles"))
    return P.listing_offers(pages.select("page_id", text("<html>", F.col("tiles"), "</html>").alias("html")))


@query("""SELECT DISTINCT 'https://s.example/' || (p_partkey // 40) || '-product.xml' AS sitemap, 'https://s.example/p-' || p_partkey || '.html' AS url,
    CAST(p_partkey AS VARCHAR) AS id FROM part""")
def sitemap_pages(spark, sf_dir):
    """An index of sitemaps, of which the product ones are followed to the pages' addresses and numbers."""
    k = F.col(K)
    address = text("https://s.example/", F.floor(k / 40), "-product.xml")
    rows = _parts(spark, sf_dir).select(address.alias("sitemap"), text("<url><loc>https://s.example/p-", k, ".html</loc></url>").alias("entry"))
    maps = rows.groupBy("sitemap").agg(F.array_join(F.collect_list("entry"), "").alias("xml"))
    index = maps.select(text("<loc>", F.col("sitemap"), "</loc><loc>https://s.example/other-", F.col("sitemap"), ".txt</loc>").alias("xml"))
    wanted = P.product_sitemaps(P.sitemap_locations(index)).filter(~F.col("url").endswith(".txt")).select(F.col("url").alias("sitemap"))
    found = maps.join(wanted, "sitemap").select("sitemap", F.explode(F.regexp_extract_all("xml", F.lit("<loc>([^<]+)</loc>"), 1)).alias("url"))
    return found.select("sitemap", "url", P.id_from_url(F.col("url"), "continente").alias("id"))


@query(
    """SELECT p_partkey, store, CASE WHEN store = 'lidl' THEN 'p' || p_partkey ELSE CAST(p_partkey AS VARCHAR) END AS slugged,
        CAST(p_partkey AS VARCHAR) AS id
    FROM (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'continente' WHEN 1 THEN 'auchan' WHEN 2 THEN 'pingo-doce' ELSE 'lidl' END AS store FROM part)"""
)
def ids_from_addresses(spark, sf_dir):
    """The product number in the address of each store's form."""
    k = F.col(K)
    url = (
        F.when(k % 4 == 0, text("https://a.example/x-", k, ".html")).when(k % 4 == 1, text("https://a.example/x/", k, ".html"))
        .when(k % 4 == 2, text("https://a.example/y-", k, ".html")).otherwise(text("https://a.example/p/name/p", k))
    )
    stores = ("continente", "auchan", "pingo-doce", "lidl")
    rows = _parts(spark, sf_dir).select(K, url.alias("url"), F.element_at(F.array(*[F.lit(s) for s in stores]), (k % 4).cast("int") + 1).alias("store"))
    found = F.coalesce(*[F.when(F.col("store") == s, P.id_from_url(F.col("url"), s)) for s in stores])
    slugged = F.regexp_extract("url", r"[-/](p?[0-9]+)(?:\.html)?$", 1)
    return rows.select(K, "store", slugged.alias("slugged"), found.alias("id"))
