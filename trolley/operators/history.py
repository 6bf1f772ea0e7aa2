"""Snapshots, change-only price history and maintenance; every result is a new DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trolley.functions.quantity import extract_quantity, price_changed, unit_price_ratio
from trolley.functions.text import business_key, normalize_brand, strip_accents
from trolley.operators.relational import best_scored


#: Fixed value: what the address of a stored image holds.
STORED = "/storage/"


def upsert_snapshot(current: DataFrame, incoming: DataFrame, key=("store", "external_id")) -> DataFrame:
    """Insert or update: the name of a known row stays, the image changes only to a non-null one.

    Columns are those of ``current``; ``incoming`` has the same. Repeated incoming keys
    must have been removed (``first_seen``).
    """
    c, i = current.alias("c"), incoming.alias("i")
    on = [F.col(f"c.{k}").eqNullSafe(F.col(f"i.{k}")) for k in key]
    joined = c.join(i, on, "full_outer")
    known, new = F.col(f"c.{key[0]}").isNotNull(), F.col(f"i.{key[0]}").isNotNull()
    out = []
    for name in current.columns:
        old, own = F.col(f"c.{name}"), F.col(f"i.{name}")
        if name in key:
            out.append(F.coalesce(old, own).alias(name))
        elif name == "name":
            out.append(F.when(known, old).otherwise(own).alias(name))
        elif name in ("image_url", "barcode"):
            out.append(F.coalesce(own, old).alias(name))
        else:
            out.append(F.when(new, own).otherwise(old).alias(name))
    return joined.select(*out)


def change_only_history(observations: DataFrame, key: list[str], order: list[str], price: str = "price") -> DataFrame:
    """Observations whose price in cents differs from the one before, and the first of each key."""
    w = Window.partitionBy(*key).orderBy(*order)
    return observations.withColumn("_prev", F.lag(price).over(w)).filter(price_changed(F.col("_prev"), F.col(price))).drop("_prev")


def history_increment(last: DataFrame, incoming: DataFrame, key: list[str], price: str = "price") -> DataFrame:
    """Incoming rows that change the last known price of their key."""
    known = last.select(*key, F.col(price).alias("_prev"))
    return incoming.join(known, key, "left").filter(price_changed(F.col("_prev"), F.col(price))).drop("_prev")


def drop_barcode_conflicts(products: DataFrame) -> DataFrame:
    """Of rows with one barcode the oldest keeps it, the others lose the barcode only."""
    owner = (
        products.filter("barcode is not null")
        .groupBy("barcode")
        .agg(F.min_by("product_id", F.struct("created_at", "product_id")).alias("_owner"))
    )
    return (
        products.join(owner, "barcode", "left")
        .withColumn("barcode", F.when(F.col("_owner").eqNullSafe(F.col("product_id")), F.col("barcode")))
        .select(*products.columns)
    )


def stale_prices(prices: DataFrame, sources: DataFrame, stale_only: bool = False) -> DataFrame:
    """Prices to purge with their reason: the store left the cluster, or the product has no cluster."""
    clusters = sources.select("product_id").distinct()
    member = prices.join(clusters, "product_id", "left_semi")
    left = member.join(sources.select("product_id", "store").distinct(), ["product_id", "store"], "left_anti")
    out = left.withColumn("reason", F.lit("store_left"))
    if not stale_only:
        orphan = prices.join(clusters, "product_id", "left_anti").withColumn("reason", F.lit("no_cluster"))
        out = out.unionByName(orphan)
    return out


def purge(prices: DataFrame, stale: DataFrame) -> DataFrame:
    return prices.join(stale.select("product_id", "store").distinct(), ["product_id", "store"], "left_anti")


def legacy_outcomes(products: DataFrame, sources: DataFrame, prices: DataFrame) -> DataFrame:
    """(product_id, target, outcome) of products without a cluster.

    merged: one clustered product of the same name and brand covers its stores;
    ambiguous: several; coverage_lost: stores would be lost; no_target: none.
    """
    clustered = sources.select("product_id").distinct()
    keyed = products.withColumn("_key", business_key(F.col("name"), F.col("brand")))
    targets = keyed.join(clustered, "product_id", "left_semi").groupBy("_key").agg(
        F.count_distinct("product_id").alias("_n"), F.min("product_id").alias("target")
    )
    stores = prices.groupBy("product_id").agg(F.collect_set("store").alias("stores"))
    orphans = keyed.join(clustered, "product_id", "left_anti").select("product_id", "_key")
    own = orphans.join(targets, "_key", "left").join(stores, "product_id", "left")
    held = stores.select(F.col("product_id").alias("target"), F.col("stores").alias("held"))
    empty = F.array().cast("array<string>")
    lost = F.size(F.array_except(F.coalesce("stores", empty), F.coalesce("held", empty))) > 0
    outcome = (
        F.when(F.col("target").isNull(), "no_target")
        .when(F.col("_n") > 1, "ambiguous")
        .when(lost, "coverage_lost")
        .otherwise("merged")
    )
    return own.join(held, "target", "left").select(
        "product_id", F.when(F.col("_n") == 1, F.col("target")).alias("target"), outcome.alias("outcome")
    )


def apply_legacy_merge(products: DataFrame, prices: DataFrame, outcomes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(products, prices) after the merged outcomes: prices move to the target, and so does a stored image.

    A stored image moves unless the target has one; of several that of the smallest id does. A price that the
    target has already, with the same store and day, stays as it is and the moved one goes.
    """
    merged = outcomes.filter("outcome = 'merged'").select("product_id", "target")
    stored = F.coalesce(F.col("image_url").contains(STORED), F.lit(False))
    images = products.filter(stored).join(merged, "product_id")
    images = images.groupBy("target").agg(F.min_by("image_url", "product_id").alias("_image"))
    kept = products.join(merged, "product_id", "left_anti").join(
        images.withColumnRenamed("target", "product_id"), "product_id", "left"
    )
    kept = kept.withColumn("image_url", F.when(stored, F.col("image_url")).otherwise(F.coalesce("_image", "image_url"))).select(*products.columns)
    moved = prices.join(merged, "product_id").withColumn("_from", F.col("product_id")).withColumn("product_id", F.col("target"))
    own = prices.join(merged, "product_id", "left_anti")
    moved = moved.join(own.select("product_id", "store", "day"), ["product_id", "store", "day"], "left_anti")
    row = F.struct(*[F.col(c) for c in prices.columns])
    one = moved.groupBy("product_id", "store", "day").agg(F.min_by(row, "_from").alias("_row")).select("_row.*")
    return kept, own.unionByName(one)


def reaudit_by_survivors(approved: DataFrame, survivors: DataFrame, name_filter: Column) -> tuple[DataFrame, DataFrame]:
    """(review rows to re-audit, products to remove): high rows of the filter whose key no longer survives."""
    key = business_key(F.col("name"), F.col("brand")).alias("_key")
    alive = survivors.select(key).distinct()
    failed = approved.filter((F.col("confidence") == "high") & name_filter).select("*", key).join(alive, "_key", "left_anti")
    return move_to_review(failed.drop("_key"))


def move_to_review(failed: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = failed.select(
        F.lit("desconhecida").alias("store_a"), F.lit("desconhecida").alias("store_b"),
        F.coalesce("match_score", F.lit(0.0)).alias("match_score"), F.col("name").alias("name_a"),
        F.col("name").alias("name_b"), "brand", "category", F.lit("reaudit_pending").alias("status"),
    )
    return rows, failed.select("product_id")


def reaudit_by_ids(approved: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    return move_to_review(approved.join(ids.select("product_id").distinct(), "product_id", "left_semi"))


def reaudit_by_unit_price(approved: DataFrame, matches: DataFrame, most: float = 0.15) -> DataFrame:
    """product_id, outcome: not_found, ok, failed_auto or failed_manual by the best match of the same key."""
    key = business_key(F.col("name"), F.col("brand"))
    best = matches.groupBy(business_key(F.col("a.name"), F.col("a.brand")).alias("_key")).agg(
        F.max_by(
            unit_price_ratio(F.col("a.price_per_unit"), F.col("b.price_per_unit")), F.struct("score", F.col("b.id"))
        ).alias("ratio"),
        F.lit(True).alias("found"),
    )
    failed = F.coalesce(F.col("ratio") > most, F.lit(False))
    outcome = (
        F.when(F.col("found").isNull(), "not_found")
        .when(~failed, "ok")
        .when(F.col("confidence") == "manual", "failed_manual")
        .otherwise("failed_auto")
    )
    return approved.withColumn("_key", key).join(best, "_key", "left").select("product_id", outcome.alias("outcome"))


def failed_moves(approved: DataFrame, outcomes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(review rows, products to remove) of the outcomes failed_auto; approved by hand stays."""
    return reaudit_by_ids(approved, outcomes.filter("outcome = 'failed_auto'"))


def backfill_units(products: DataFrame) -> DataFrame:
    q = extract_quantity(F.col("name"))
    missing = F.col("quantity").isNull()
    return products.withColumns(
        {
            "quantity": F.when(missing, q["value"]).otherwise(F.col("quantity")),
            "quantity_unit": F.when(missing, q["unit"]).otherwise(F.col("quantity_unit")),
        }
    )


def backfill_brands(products: DataFrame) -> DataFrame:
    """Rows whose brand has another canonical spelling, with old and new."""
    new = normalize_brand(F.col("brand"))
    return products.select("*", new.alias("new_brand")).filter(F.col("brand").isNotNull() & (F.col("new_brand") != F.col("brand")))


def backfill_subcategory(products: DataFrame, classify, store: str, category: str) -> DataFrame:
    own = F.col("subcategory").isNull() & (F.col("store") == store) & (F.col("category") == category)
    return products.withColumn("subcategory", F.when(own, classify(F.col("name"))).otherwise(F.col("subcategory")))


def backfill_provenance(products: DataFrame, listings: DataFrame, key: str, named_store: str) -> DataFrame:
    """``subcategory_source`` where a subcategory has none: nome if ``named_store`` lists the product, else breadcrumb."""
    named = listings.filter(F.col("store") == named_store).select(key, F.lit(True).alias("_named")).distinct()
    new = F.when(F.col("_named"), "nome").otherwise("breadcrumb")
    old = F.col("subcategory_source")
    filled = F.when(F.col("subcategory").isNotNull() & old.isNull(), new).otherwise(old)
    return products.join(named, key, "left").withColumn("subcategory_source", filled).select(*products.columns)


def retire_category(products: DataFrame, old: str, new: str) -> DataFrame:
    return products.withColumn("category", F.when(F.col("category") == old, new).otherwise(F.col("category")))


def simple_pair_load(matches: DataFrame, day: str) -> DataFrame:
    """Brand matches only; two price rows each; category of the second side unless it has none."""
    m = matches.filter(~F.col("own_brand"))
    side = lambda s: F.struct(F.col(f"store_{s}").alias("store"), F.col(f"{s}.price").alias("price"))
    return m.select(
        F.sha2(business_key(F.col("a.name"), F.col("a.brand")), 256).alias("product_id"), F.col("a.name").alias("name"),
        F.coalesce("b.category", "a.category").alias("category"), F.explode(F.array(side("a"), side("b"))).alias("p"),
    ).select("product_id", "name", "category", "p.*", F.lit(day).cast("date").alias("day"))


def image_work_list(matches: DataFrame, stored: DataFrame, priority: tuple[str, ...]) -> DataFrame:
    """Per business key without a stored image: the image of the store of best priority, ties by score."""
    side = lambda s: F.struct(F.col(f"store_{s}").alias("store"), F.col(f"{s}.image_url").alias("image_url"))
    rows = matches.select(
        business_key(F.col("a.name"), F.col("a.brand")).alias("key"), "score", F.explode(F.array(side("a"), side("b"))).alias("i")
    ).filter("i.image_url is not null")
    place = F.array_position(F.array(*[F.lit(p) for p in priority]), F.col("i.store"))
    best = rows.groupBy("key").agg(F.min_by("i", F.struct(place.alias("p"), (-F.col("score")).alias("s"), F.col("i.image_url").alias("u"))).alias("i"))
    return best.select("key", "i.*").join(stored.select("key").distinct(), "key", "left_anti")


def image_hotlinks(products: DataFrame, migrated: DataFrame, store_of) -> DataFrame:
    """(key, store, image_url, outcome): the second phase, images that still point elsewhere.

    Products with an image that is not stored and whose business key is not in
    ``migrated`` (key): migrate where ``store_of`` the image's address knows the store, else
    unknown_host. Of several products of a key the one with the highest match_score counts,
    ties to the smallest address.
    """
    link = F.col("image_url").isNotNull() & ~F.col("image_url").contains(STORED)
    rows = products.filter(link).select(business_key(F.col("name"), F.col("brand")).alias("key"), "image_url", "match_score")
    rows = best_scored(rows.filter("key is not null"), ["key"], "match_score", ["image_url"])
    store = store_of(F.col("image_url"))
    left = rows.join(migrated.select("key").distinct(), "key", "left_anti")
    return left.select("key", store.alias("store"), "image_url", F.when(store == "outro", "unknown_host").otherwise("migrate").alias("outcome"))


def reclassify_suspects(products: DataFrame, suspect: str, classify) -> DataFrame:
    """Rows whose folded name matches ``suspect`` get the class of their breadcrumb, if there is one.

    Adds ``changed``; all rows stay.
    """
    odd = F.coalesce(strip_accents(F.lower("name")).rlike(suspect), F.lit(False))
    new = classify(F.col("breadcrumb"))
    use = odd & new["subcategory"].isNotNull()
    return products.select(
        *[c for c in products.columns if c not in ("category", "subcategory")],
        F.when(use, new["category"]).otherwise(F.col("category")).alias("category"),
        F.when(use, new["subcategory"]).otherwise(F.col("subcategory")).alias("subcategory"),
        (use & ~new["subcategory"].eqNullSafe(F.col("subcategory"))).alias("changed"),
    )


def fill_review_details(review: DataFrame, details: DataFrame) -> DataFrame:
    """Both unit prices from ``details`` by the review key, only where the first is null.

    Of repeated details the one with the highest ``ordinal`` wins.
    """
    key = ["store_a", "store_b", "name_a", "name_b"]
    last = details.groupBy(*key).agg(
        F.max_by(F.struct("price_per_unit_a", "price_per_unit_b"), F.struct("ordinal", "price_per_unit_a", "price_per_unit_b")).alias("_d")
    )
    joined = review.join(last, key, "left")
    empty = F.col("price_per_unit_a").isNull()
    for c in ("price_per_unit_b", "price_per_unit_a"):
        joined = joined.withColumn(c, F.when(empty, F.coalesce(f"_d.{c}", c)).otherwise(F.col(c)))
    return joined.select(*review.columns)
