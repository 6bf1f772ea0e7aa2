"""Stored pages -> sitemap locations, ids, breadcrumbs and typed offers; no network.

JSON is parsed once a page into a VARIANT, and fields are taken from that by path; what does
not parse, or has another type, is null and shows as a reason or is left out, never an
error. The same functions serve tables and streams. Classifier rules run once for each
distinct breadcrumb of a table; in a stream they run on the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.functions.classify import classify_breadcrumb, classify_distinct, classify_url_path
from trolley.functions.text import html_text, html_unescape, parse_euro

#: Product number in a page's address, by store.
ID_PATTERNS = {
    "continente": r"-([0-9]+)\.html$",
    "auchan": r"/([0-9]+)\.html$",
    "pingo-doce": r"-([0-9]+)\.html$",
    "lidl": r"/p/[^/]+/p([0-9]+)",
}
LD_JSON = r'(?s)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>'


def sitemap_locations(pages: DataFrame, column: str = "xml") -> DataFrame:
    return pages.select(F.explode(F.regexp_extract_all(column, F.lit("<loc>([^<]+)</loc>"), 1)).alias("url"))


def product_sitemaps(locations: DataFrame, suffix: str = "-product.xml") -> DataFrame:
    """The product entries of a sitemap index; fails if there is none."""
    found = locations.filter(F.col("url").contains(suffix))
    if found.isEmpty():
        raise ValueError(f"the sitemap index has no {suffix} entry")
    return found


def id_from_url(url: Column, store: str) -> Column:
    found = F.regexp_extract(url, ID_PATTERNS[store], 1)
    return F.when(found != "", found)


def in_stock(availability: Column) -> Column:
    return availability.isNull() | (availability == "") | availability.rlike("(?i)InStock")


def listing_offers(pages: DataFrame) -> DataFrame:
    """Tiles of a listing page: JSON attribute, link, image, unit price; tiles with broken JSON are left out."""
    tile_start = '<div[^>]*class="product[ "]'
    tiles = pages.select("page_id", F.explode(F.split("html", f"(?={tile_start})")).alias("tile")).filter(
        F.col("tile").rlike(f"^{tile_start}")
    )
    attribute = "data-product-tile-impression="
    quoted = [F.regexp_extract("tile", f"{attribute}{q}([^{q}]*){q}", 1) for q in ("'", '"')]
    rows = tiles.withColumn("v", F.try_parse_json(html_unescape(F.coalesce(F.nullif(quoted[0], F.lit("")), quoted[1]))))
    rows = rows.select("page_id", "tile", *[_field(c, kind=kind).alias(c) for c, kind in (("id", "string"), ("name", "string"), ("brand", "string"), ("price", "double"), ("category", "string"))])
    return rows.filter("id is not null and name is not null").select(
        "page_id", "id", "name", "brand", "price", "category",
        F.nullif(F.regexp_extract("tile", r'href="([^"]+\.html)"', 1), F.lit("")).alias("url"),
        F.nullif(F.regexp_extract("tile", r'<img[^>]*src="([^"]+)"', 1), F.lit("")).alias("image_url"),
        parse_euro(html_text(F.regexp_extract("tile", r'(?s)class="pwc-tile--price-secondary[^>]*>(.*?)</div>', 1))).alias("price_per_unit"),
    )


def breadcrumb(html: Column, marker: str = "breadcrumb", reach: int = 6000) -> Column:
    """Names of the links behind ``marker``, white space collapsed, the home entry left out."""
    part = F.when(F.instr(html, F.lit(marker)) > 0, F.substring(html, F.instr(html, F.lit(marker)), F.lit(reach)))
    names = F.transform(F.regexp_extract_all(part, F.lit(r"(?s)<a[^>]*>(.*?)</a>"), 1), html_text)
    return F.filter(names, lambda n: (n != "") & ~F.lower(n).isin("home", "página inicial", "pagina inicial"))


def _ld_blocks(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(LD_JSON), 1)


def _field(path: str, v: str = "v", kind: str = "string") -> Column:
    return F.try_variant_get(v, f"$.{path}", kind)


def _barcode(v: str = "v") -> Column:
    return F.coalesce(*[_field(c, v) for c in ("gtin13", "gtin", "gtin12", "gtin8", "gtin14")])


def image_of(html: Column, v: str = "v") -> Column:
    """The image of the JSON (a string or the first of a list), else the page's marked image."""
    plain = _field("image", v)
    page = F.regexp_extract(html, r'<img[^>]*itemprop="?image"?[^>]*src="([^"]+)"', 1)
    return F.coalesce(_field("image[0]", v), F.when(~plain.startswith("["), plain), F.nullif(page, F.lit("")))


def _classified(rows: DataFrame, column: str, classify) -> DataFrame:
    """``rows`` with category and subcategory of ``column``, which goes."""
    if rows.isStreaming:
        return rows.withColumn("_c", classify(F.col(column))).select("*", "_c.*").drop("_c", column)
    return classify_distinct(rows, column, classify).drop(column)


def product_offers(pages: DataFrame, store: int = 1, marker: str = "breadcrumb") -> DataFrame:
    """One row per product page with its offer, or the first reason against it.

    Reasons, in order: sem_ld_json, erro_parse_json, sem_dados_essenciais, fora_de_stock,
    preco_zero_ou_invalido, sem_classificacao.
    """
    rows = pages.select("page_id", "url", "html", F.get(_ld_blocks(F.col("html")), 0).alias("raw"))
    rows = rows.select("*", F.try_parse_json("raw").alias("v"))
    rows = rows.select(
        "page_id", "url", F.col("raw").isNull().alias("_none"), F.col("v").isNull().alias("_broken"),
        _field("sku").alias("id"), _field("name").alias("name"), _field("brand.name").alias("brand"),
        F.replace(_field("offers.price"), F.lit(","), F.lit(".")).try_cast("double").alias("price"),
        _field("offers.availability").alias("_availability"), _barcode().alias("barcode"), image_of(F.col("html")).alias("image_url"),
        F.array_join(breadcrumb(F.col("html"), marker), " / ").alias("_crumbs"),
    )
    rows = _classified(rows, "_crumbs", lambda c: classify_breadcrumb(c, store))
    reason = (
        F.when(F.col("_none"), "sem_ld_json")
        .when(F.col("_broken"), "erro_parse_json")
        .when(F.col("id").isNull() | F.col("name").isNull(), "sem_dados_essenciais")
        .when(~in_stock(F.col("_availability")), "fora_de_stock")
        .when(F.col("price").isNull() | F.isnan("price") | (F.col("price") <= 0), "preco_zero_ou_invalido")
        .when(F.col("subcategory").isNull(), "sem_classificacao")
    )
    return rows.select("page_id", "url", "id", "name", "brand", "price", "barcode", "image_url", "category", "subcategory", reason.alias("reason"))


def multi_block_offers(pages: DataFrame, store: int = 2) -> DataFrame:
    """Pages with several JSON blocks: the Product block and the BreadcrumbList sorted by position."""
    blocks = F.transform(_ld_blocks(F.col("html")), F.try_parse_json)
    of = lambda name: F.get(F.filter("blocks", lambda b: F.try_variant_get(b, "$['@type']", "string") == name), 0)
    rows = pages.select("page_id", "url", blocks.alias("blocks")).select("page_id", "url", of("Product").alias("v"), of("BreadcrumbList").alias("l"))
    items = F.try_variant_get("l", "$.itemListElement", "array<struct<position:int, name:string, item:struct<name:string>>>")
    named = F.array_sort(F.transform(items, lambda x: F.struct(x["position"], F.coalesce(x["name"], x["item"]["name"]).alias("name"))))
    rows = rows.select(
        "page_id", "url", _field("sku").alias("id"), _field("name").alias("name"), _field("brand.name").alias("brand"),
        _field("offers.price").try_cast("double").alias("price"), _barcode().alias("barcode"),
        F.array_join(F.filter(F.transform(named, lambda x: x["name"]), lambda n: n.isNotNull()), " / ").alias("_crumbs"),
        _field("offers.availability").alias("_availability"),
    )
    rows = rows.filter(F.col("id").isNotNull() & in_stock(F.col("_availability")) & F.col("price").isNotNull() & ~F.isnan("price")).drop("_availability")
    return _classified(rows, "_crumbs", lambda c: classify_breadcrumb(c, store))


def attribute_offers(pages: DataFrame) -> DataFrame:
    """The first ``data-gtm-info`` whose first item has an id; price from the page, else from the item."""
    infos = F.transform(F.regexp_extract_all("html", F.lit(r'data-gtm-info="([^"]*)"'), 1), lambda x: F.try_parse_json(html_unescape(x)))
    first = F.get(F.filter("infos", lambda x: F.try_variant_get(x, "$.items[0].item_id", "string").isNotNull()), 0)
    page_price = F.regexp_extract("html", r'itemprop="price"[^>]*content="([0-9.]+)"', 1).try_cast("double")
    rows = pages.select("page_id", "url", "html", infos.alias("infos")).select("page_id", "url", "html", first.alias("v"))
    rows = rows.select(
        "page_id", "url", _field("items[0].item_id").alias("id"), _field("items[0].item_name").alias("name"),
        _field("items[0].item_brand").alias("brand"), F.coalesce(page_price, _field("items[0].price", kind="double")).alias("price"),
        F.col("url").alias("_url"),
    )
    return _classified(rows.filter("id is not null and price is not null and price <> 0"), "_url", classify_url_path)


def nested_offers(documents: DataFrame) -> DataFrame:
    """JSON documents (column ``json``): a price, the brand only where it is shown, the first EAN, image by id."""
    rows = documents.select(F.try_parse_json("json").alias("v"))
    images = F.try_variant_get("v", "$.images", "map<string, string>")
    rows = rows.select(
        _field("id").alias("id"), _field("fullTitle").alias("name"),
        F.when(_field("brand.showBrand", kind="boolean"), _field("brand.name")).alias("brand"),
        _field("price.price", kind="double").alias("price"), _field("eans[0]").alias("barcode"),
        F.try_element_at(images, _field("mainImageId")).alias("image_url"), _field("category").alias("_crumbs"),
        _field("havingPrice", kind="boolean").alias("_priced"),
    )
    return _classified(rows.filter("_priced and price is not null").drop("_priced"), "_crumbs", lambda c: classify_breadcrumb(c, 3))


def double_encoded_offers(pages: DataFrame) -> DataFrame:
    """__NEXT_DATA__ -> apiData (JSON in a string) -> the PRODUCT_DETAIL_GET entry; unavailable ones dropped."""
    outer = F.try_parse_json(F.regexp_extract("html", r'(?s)<script id="__NEXT_DATA__"[^>]*>(.*?)</script>', 1))
    rows = pages.select("page_id", outer.alias("o")).select("page_id", F.try_parse_json(_field("props.pageProps.apiData", "o")).alias("w"))
    entries = F.try_variant_get("w", "$", "array<variant>")
    rows = rows.select("page_id", F.get(F.filter(entries, lambda e: F.try_variant_get(e, "$.key", "string") == "PRODUCT_DETAIL_GET"), 0).alias("v"))
    assets = F.try_variant_get("v", "$.res.assets", "array<struct<url:string, primary:boolean>>")
    rows = rows.select(
        "page_id", _field("res.id").alias("id"), _field("res.name").alias("name"), _field("res.brandName").alias("brand"),
        _field("res.price.value", kind="double").alias("price"), _field("res.available", kind="boolean").alias("_available"), assets.alias("_assets"),
    )
    primary = F.get(F.filter("_assets", lambda a: a["primary"]), 0)["url"]
    return rows.filter("id is not null and coalesce(_available, true) and price is not null").select(
        "page_id", "id", "name", "brand", "price", F.coalesce(primary, F.get("_assets", 0)["url"]).alias("image_url")
    )
