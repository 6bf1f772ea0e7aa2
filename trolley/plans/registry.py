"""Queries by name, with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

STORE = "CASE CAST({0} AS INTEGER) WHEN 0 THEN 'continente' WHEN 1 THEN 'pingo-doce' WHEN 2 THEN 'auchan' WHEN 3 THEN 'lidl' ELSE 'aldi' END"
OWN = "CASE CAST({0} AS INTEGER) WHEN 0 THEN 'Continente' WHEN 1 THEN 'Pingo Doce' WHEN 2 THEN 'Auchan' WHEN 3 THEN 'Milbona' ELSE 'Aldi' END"
#: The stand-in catalogue and price observations in SQL, as common table expressions.
CATALOGUE = f"""
    sized AS (SELECT *, (p_size % 6 + 1) * 125 AS grams FROM part),
    cat AS (
        SELECT CAST(p_partkey AS VARCHAR) AS id, {STORE.format('p_partkey % 5')} AS store,
            p_name || ' ' || lower(p_type) || ' ' ||
                CASE WHEN grams = 500 AND p_partkey % 2 = 1 THEN '4x125g' ELSE grams || 'g' END AS name,
            CASE WHEN p_brand IN ('Brand#1', 'Brand#2') THEN {OWN.format('p_partkey % 5')} ELSE p_brand END AS brand,
            CASE p_type WHEN 'SMALL' THEN 'frutas_legumes' WHEN 'MEDIUM' THEN 'bebidas' ELSE 'mercearia_doce_salgada' END
                AS category,
            CASE WHEN p_type = 'MEDIUM' THEN 'agua' END AS subcategory,
            round(p_retailprice - 880, 1) AS price,
            round(round(p_retailprice - 880, 1) * 1000 / grams, 2) AS price_per_unit,
            'https://' || {STORE.format('p_partkey % 5')} || '.example/p/' || p_partkey || '.html' AS url,
            CASE WHEN p_partkey % 7 <> 0 THEN 'https://img.example/' || p_partkey || '.png' END AS image_url,
            grams, p_brand IN ('Brand#1', 'Brand#2') AS own, p_partkey, p_name, p_type
        FROM sized)"""
PRICES = f"""
    prices AS (
        SELECT l_partkey AS product_id, {STORE.format('l_suppkey % 5')} AS store, CAST(l_shipdate AS DATE) AS day,
            l_orderkey AS order_id, l_linenumber AS line,
            CAST(floor(l_extendedprice / l_quantity * 100 + 0.5) / 100 AS DECIMAL(12, 2)) AS price
        FROM lineitem)"""
MATCHES = (
    CATALOGUE
    + """,
    pairs(store_a, store_b) AS (VALUES ('continente', 'pingo-doce'), ('continente', 'lidl'), ('pingo-doce', 'lidl'),
        ('continente', 'auchan'), ('pingo-doce', 'auchan'), ('lidl', 'auchan'), ('continente', 'aldi'),
        ('pingo-doce', 'aldi'), ('lidl', 'aldi'), ('auchan', 'aldi')),
    prep AS (
        SELECT *, list_distinct(string_split(p_name || ' ' || lower(p_type), ' ')) AS toks,
            CASE WHEN own THEN 'OWN' ELSE lower(brand) END AS block,
            CASE WHEN grams = 500 AND p_partkey % 2 = 1 THEN 4 ELSE 1 END AS packs
        FROM cat),
    cand AS (
        SELECT store_a, store_b, a.id AS id_a, b.id AS id_b, a.own AS own_brand, a.category AS category_a,
            b.category AS category_b, a.price AS price_a, b.price AS price_b, a.price_per_unit AS ppu_a,
            b.price_per_unit AS ppu_b, a.name AS name_a, b.name AS name_b, a.brand AS brand_a, b.brand AS brand_b,
            CASE WHEN a.category <> 'frutas_legumes' OR (NOT a.own AND a.block = b.block) THEN 0 ELSE 1 END AS source,
            len(list_intersect(a.toks, b.toks)) / CAST(len(list_distinct(list_concat(a.toks, b.toks))) AS DOUBLE)
                AS score
        FROM pairs JOIN prep a ON a.store = store_a JOIN prep b ON b.store = store_b
        WHERE a.grams = b.grams
            AND CASE WHEN a.category = 'frutas_legumes' THEN (NOT a.own AND a.block = b.block) OR a.category = b.category
                ELSE a.block = b.block END
            AND NOT ((a.category = 'frutas_legumes' OR b.category = 'frutas_legumes')
                AND NOT (a.block <> 'OWN' AND a.block = b.block)
                AND greatest(a.price_per_unit, b.price_per_unit) / least(a.price_per_unit, b.price_per_unit) - 1 > 0.15)
            AND NOT (coalesce(a.subcategory, b.subcategory, '') = 'agua' AND a.packs <> b.packs)),
    best AS (
        SELECT *, row_number() OVER (PARTITION BY store_a, store_b, id_a ORDER BY score DESC, source, id_b) AS r
        FROM cand WHERE score > 0),
    m AS (SELECT * REPLACE (round(score, 3) AS score) FROM best WHERE r = 1 AND score >= 0.45)"""
)


def query(sql: str | None = None, needs: str = ""):
    """Register the function under its name; ``needs`` are common table expressions that ``sql`` uses."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = f"WITH {needs} {sql}" if needs else sql
        return f

    return add
