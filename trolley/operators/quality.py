"""Data-quality rules and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.functions.classify import CATEGORY, SUBCATEGORIES
from trolley.functions.quantity import unit_price_ratio


def run_guard(results: DataFrame, failed: Column, most: float = 0.05) -> DataFrame:
    """attempted, errors, verdict: empty, too_many_errors or ok."""
    rows = results.agg(F.count("*").alias("attempted"), F.count_if(failed).alias("errors"))
    verdict = F.when(F.col("attempted") == 0, "empty").when(
        F.col("errors") > F.col("attempted") * most, "too_many_errors"
    )
    return rows.withColumn("verdict", verdict.otherwise("ok"))


def run_summary(rows: DataFrame, reason: str, ignored: list[str], failed: list[str], by: list[str]) -> DataFrame:
    """found, saved (no reason), ignored by cause, and errors (reasons of ``failed``), in one pass."""
    return rows.groupBy(*by).agg(
        F.count("*").alias("found"),
        F.count_if(F.col(reason).isNull()).alias("saved"),
        *[F.count_if(F.col(reason) == cause).alias(f"ignored_{cause}") for cause in ignored],
        F.count_if(F.col(reason).isin(*failed)).alias("errors"),
    )


def category_pairs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c, s) for s, c in CATEGORY.items()], "category string, subcategory string")


def category_violations(products: DataFrame) -> DataFrame:
    """Rows with an unknown category, or a subcategory that is not one of its category."""
    pairs = F.array(*[F.lit(f"{c}/{s}") for s, c in CATEGORY.items()])
    pair = F.concat_ws("/", "category", "subcategory")
    bad_category = F.coalesce(~F.col("category").isin(*SUBCATEGORIES), F.lit(True))
    bad_pair = F.col("subcategory").isNotNull() & ~F.array_contains(pairs, pair)
    return products.withColumn("rule", F.when(bad_category, "category").when(bad_pair, "pair")).filter("rule is not null")


def failed_rules(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(key, rule) of every rule that a row breaks; a rule that is null counts as broken."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(test, F.lit(False)), name) for name, test in rules.items()]))
    return df.select(key, F.explode(broken).alias("rule"))


def duplicate_keys(df: DataFrame, key: list) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def orphans(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    return facts.filter(F.col(key).isNotNull()).join(dimension.select(key), key, "left_anti")


def threshold_sweep(labelled: DataFrame, score: str, bad: Column, thresholds: list[float]) -> DataFrame:
    """Per threshold: the share of bad rows removed and of good rows lost, in percent, in one pass."""
    sums = [F.count_if(bad).alias("bad"), F.count_if(~bad).alias("good")]
    for i, t in enumerate(thresholds):
        sums += [
            F.count_if(bad & (F.col(score) < t)).alias(f"b{i}"),
            F.count_if(~bad & (F.col(score) < t)).alias(f"g{i}"),
        ]
    row = labelled.agg(*sums)
    each = F.explode(
        F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"b{i}").alias("b"), F.col(f"g{i}").alias("g")) for i, t in enumerate(thresholds)])
    )
    share = lambda n, total: F.round(F.try_divide(n * 100.0, total), 1)
    return row.select("bad", "good", each.alias("x")).select(
        "x.threshold", share(F.col("x.b"), F.col("bad")).alias("bad_removed"), share(F.col("x.g"), F.col("good")).alias("good_lost")
    )


def kind_matrix(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy(
        F.coalesce("a.qty.kind", F.lit("none")).alias("kind_a"), F.coalesce("b.qty.kind", F.lit("none")).alias("kind_b")
    ).agg(F.count("*").alias("n"))


def cluster_coverage(sources: DataFrame) -> DataFrame:
    stores = sources.groupBy("product_id").agg(F.count_distinct("store").alias("n_stores"))
    return stores.groupBy("n_stores").agg(F.count("*").alias("products"))


def price_outliers(pairs: DataFrame, listings: DataFrame, now: Column, least: float = 2.0, fresh_days: int = 14) -> DataFrame:
    """Pairs of one category whose prices are more than ``least`` apart, counted.

    By direction, category, where the dearer side's subcategory comes from
    (``subcategory_source``, ``(nenhuma)`` if null) and the age of its price: recent,
    old (more than ``fresh_days``) or unknown. ``listings`` has store, id,
    subcategory_source and updated_at, one row for each store and id.
    """
    a, b = F.col("a.price"), F.col("b.price")
    far = pairs.filter((F.col("a.category") == F.col("b.category")) & (unit_price_ratio(a, b) + 1 > least))
    dear = lambda x, y: F.when(a > b, x).otherwise(y)
    told = far.select(
        dear(F.lit("a_dearer"), F.lit("b_dearer")).alias("direction"), F.col("a.category").alias("category"),
        dear(F.col("store_a"), F.col("store_b")).alias("store"), dear(F.col("a.id"), F.col("b.id")).alias("id"),
    ).join(listings.select("store", "id", "subcategory_source", "updated_at"), ["store", "id"], "left")
    old = F.col("updated_at") < now - F.expr(f"INTERVAL {int(fresh_days)} DAYS")
    age = F.when(F.col("updated_at").isNull(), "unknown").when(old, "old").otherwise("recent")
    source = F.coalesce("subcategory_source", F.lit("(nenhuma)"))
    return told.groupBy("direction", "category", source.alias("subcategory_source"), age.alias("price_age")).agg(F.count("*").alias("n"))


def score_bands(pairs: DataFrame, width: int = 20) -> DataFrame:
    return pairs.groupBy((F.floor(F.col("score") * width) / width).alias("band")).agg(F.count("*").alias("n"))


def suspicious_prices(df: DataFrame, floor: float = 0.01, far: float = 10.0) -> DataFrame:
    """(id, label): missing, not_positive, floor_value, unit_price_far_above."""
    price, unit = F.col("price"), F.col("price_per_unit")
    label = (
        F.when(price.isNull(), "missing")
        .when(price <= 0, "not_positive")
        .when(price == floor, "floor_value")
        .when(unit > price * far, "unit_price_far_above")
    )
    return df.select("id", label.alias("label")).filter("label is not null")


def null_coverage(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"no_{c}") for c in columns])
