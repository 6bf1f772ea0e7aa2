"""Catalogue tables: listings, the driver's stand-in catalogue, match-pair tables and seed lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.functions.classify import classify_seed_url

STORES = ("continente", "pingo-doce", "auchan", "lidl", "aldi")
#: The ordered store pairs that are compared.
PAIRS = (
    ("continente", "pingo-doce"),
    ("continente", "lidl"),
    ("pingo-doce", "lidl"),
    ("continente", "auchan"),
    ("pingo-doce", "auchan"),
    ("lidl", "auchan"),
    ("continente", "aldi"),
    ("pingo-doce", "aldi"),
    ("lidl", "aldi"),
    ("auchan", "aldi"),
)
OWN_NAMES = ("Continente", "Pingo Doce", "Auchan", "Milbona", "Aldi")
CATALOGUE = (
    "id string, store string, name string, brand string, category string, subcategory string, price double,"
    " price_per_unit double, url string, image_url string"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_index(index: Column, values) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def part_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store listings derived from ``part``: store and size from its keys, price in 20.0 to 119.9."""
    part = table(spark, sf_dir, "part")
    slot = F.col("p_partkey") % 5
    size = (F.col("p_size") % 6 + 1) * 125
    packed = (size == 500) & (F.col("p_partkey") % 2 == 1)
    label = F.when(packed, F.lit("4x125g")).otherwise(F.concat(size.cast("string"), F.lit("g")))
    own = F.col("p_brand").isin("Brand#1", "Brand#2")
    price = F.round(F.col("p_retailprice") - 880, 1)
    return part.select(
        F.col("p_partkey").cast("string").alias("id"),
        by_index(slot, STORES).alias("store"),
        F.concat_ws(" ", "p_name", F.lower("p_type"), label).alias("name"),
        F.when(own, by_index(slot, OWN_NAMES)).otherwise(F.col("p_brand")).alias("brand"),
        F.when(F.col("p_type") == "SMALL", "frutas_legumes")
        .when(F.col("p_type") == "MEDIUM", "bebidas")
        .otherwise("mercearia_doce_salgada")
        .alias("category"),
        F.when(F.col("p_type") == "MEDIUM", "agua").alias("subcategory"),
        price.alias("price"),
        F.round(price * 1000 / size, 2).alias("price_per_unit"),
        F.concat(F.lit("https://"), by_index(slot, STORES), F.lit(".example/p/"), F.col("p_partkey").cast("string"), F.lit(".html")).alias("url"),
        F.when(F.col("p_partkey") % 7 != 0, F.concat(F.lit("https://img.example/"), F.col("p_partkey").cast("string"), F.lit(".png"))).alias("image_url"),
    )


def store_pairs(spark: SparkSession, pairs=PAIRS) -> DataFrame:
    return spark.createDataFrame(
        [(a, b, i) for i, (a, b) in enumerate(pairs)], "store_a string, store_b string, pair_no int"
    )


def price_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price history derived from ``lineitem``: product, store, day, price."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("product_id"),
        by_index(F.col("l_suppkey") % 5, STORES).alias("store"),
        F.col("l_shipdate").cast("date").alias("day"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        (F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100 + 0.5) / 100).cast("decimal(12,2)").alias("price"),
    )


def catalogue_export(listings: DataFrame, products: DataFrame, store: str) -> DataFrame:
    """Listings of one store with their product's fields; a listing without a product keeps nulls."""
    return (
        listings.filter(F.col("store") == store)
        .join(products, "product_id", "left")
        .select(
            F.col("external_id").alias("id"), "name", "brand", "category", "subcategory",
            F.col("current_price").alias("price"), F.col("current_price_per_unit").alias("price_per_unit"), "url", "image_url",
        )
    )


def seed_list(urls: DataFrame) -> DataFrame:
    """(url, default_category) -> url, category, subcategory."""
    return urls.select("url", classify_seed_url(F.col("url"), F.col("default_category")).alias("c")).select("url", "c.*")


def write_match_pairs(matches: DataFrame, path: str) -> None:
    """One table for all pairs, a folder for each."""
    matches.write.mode("append").partitionBy("store_a", "store_b").parquet(path)


def read_match_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Tables and JSON files of pairs; the older files' sides are called pd and continente."""
    df = spark.read.json(path) if path.endswith((".json", ".jsonl")) else spark.read.parquet(path)
    for old, new in (("pd", "a"), ("continente", "b"), ("ownBrand", "own_brand")):
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    return df


def append_rows(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def table_probe(df: DataFrame, name: str, rows: int = 3) -> DataFrame:
    """name, rows, sample: the row count and a few rows as JSON, the smallest ones by their JSON."""
    text = F.to_json(F.struct(*df.columns))
    sample = df.select(text.alias("row")).orderBy("row").limit(rows).agg(F.array_sort(F.collect_list("row")).alias("sample"))
    return df.agg(F.count("*").alias("rows")).crossJoin(sample).select(F.lit(name).alias("name"), "rows", "sample")
