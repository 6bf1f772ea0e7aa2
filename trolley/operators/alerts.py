"""Price-drop alerts, weekly summaries and feedback counters; delivery is not part of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.functions.quantity import drop_share, target_threshold, whole_percent
from trolley.functions.text import format_euro, plural_suffix
from trolley.operators.relational import highest_since, rolling_sums


def eligible_users(profiles: DataFrame, preference: str) -> DataFrame:
    return profiles.filter(F.col("push_token").isNotNull() & F.col(f"prefs.{preference}")).select("user_id", "push_token")


def current_prices(prices: DataFrame, current: str = "all_time_min") -> DataFrame:
    """(product_id, current): the least price over all history, or over each store's latest price."""
    if current == "all_time_min":
        return prices.groupBy("product_id").agg(F.min("price").alias("current"))
    newest = prices.groupBy("product_id", "store").agg(F.max_by("price", F.struct("day", "price")).alias("price"))
    return newest.groupBy("product_id").agg(F.min("price").alias("current"))


def target_alerts(alerts: DataFrame, now: DataFrame) -> DataFrame:
    """Active alerts whose target is above the current price by the threshold of the target's size."""
    target = F.col("target_price")
    rows = alerts.filter(F.col("active") & target.isNotNull()).join(now, "product_id")
    share = drop_share(target.cast("double"), F.col("current").cast("double"))
    return rows.filter((target > F.col("current")) & (share >= target_threshold(target))).select(
        "user_id", "product_id", F.lit("preco_alvo").alias("kind"), "current", F.col("target_price").alias("base")
    )


def favourite_drops(favourites: DataFrame, prices: DataFrame, now: DataFrame, least: float = 0.10) -> DataFrame:
    """Favourites whose current price is at least 10 % below the highest since they were marked.

    Of a product that a user has marked several times the first mark counts.
    """
    marks = favourites.groupBy("user_id", "product_id").agg(F.min("created_at").cast("date").alias("created_at"))
    base = highest_since(marks, prices, "product_id", "created_at", "day", "price").withColumnRenamed("price", "base")
    rows = marks.join(base.join(now, "product_id"), ["product_id", "created_at"])
    share = drop_share(F.col("base").cast("double"), F.col("current").cast("double"))
    return rows.filter(share >= least).select(
        "user_id", "product_id", F.lit("descida_favorito").alias("kind"), "current", "base"
    )


def not_logged(alerts: DataFrame, log: DataFrame) -> DataFrame:
    """Alerts whose logged price is above the current one, or that are not logged; a null logged price suppresses."""
    known = log.select("user_id", "product_id", "kind", F.coalesce("price_at_notification", F.lit(0)).alias("_p"), F.lit(True).alias("_k"))
    joined = alerts.join(known, ["user_id", "product_id", "kind"], "left")
    return joined.filter(F.col("_k").isNull() | (F.col("_p") > F.col("current"))).drop("_p", "_k")


def with_message(alerts: DataFrame) -> DataFrame:
    percent = whole_percent(drop_share(F.col("base").cast("double"), F.col("current").cast("double")))
    return alerts.withColumn(
        "message",
        F.when(
            F.col("kind") == "preco_alvo",
            F.concat(F.lit("Preço-alvo atingido: "), format_euro(F.col("current").cast("double"))),
        ).otherwise(F.concat(F.lit("Desceu "), percent.cast("string"), F.lit("%: agora "), format_euro(F.col("current").cast("double")))),
    )


def updated_log(log: DataFrame, alerts: DataFrame) -> DataFrame:
    """One row per (user, product, kind): the new alert's price replaces the logged one."""
    key = ["user_id", "product_id", "kind"]
    new = alerts.groupBy(*key).agg(F.min("current").alias("price_at_notification"))
    return log.select(*key, "price_at_notification").join(new, key, "left_anti").unionByName(new)


def weekly_summary(users: DataFrame, baskets: DataFrame, log: DataFrame, now: Column, days: int = 7, quiet_days: int = 6) -> DataFrame:
    """Spent, saved and baskets of the last week for users not told in the last days."""
    told = log.filter((F.col("kind") == "resumo_semanal") & (F.col("created_at") >= now - F.expr(f"INTERVAL {quiet_days} DAYS")))
    spent = rolling_sums(baskets, "user_id", "created_at", "total", now, days)
    saved = rolling_sums(baskets, "user_id", "created_at", "savings", now, days).select("user_id", F.col("spent").alias("saved"))
    rows = users.join(told.select("user_id").distinct(), "user_id", "left_anti").join(spent, "user_id").join(saved, "user_id")
    base = F.concat(
        F.lit("Esta semana: "), F.col("n").cast("string"), F.lit(" cesto"), plural_suffix(F.col("n")), F.lit(", "),
        format_euro(F.col("spent").cast("double")),
    )
    text = F.when(F.col("saved") > 0, F.concat(base, F.lit(", poupou "), format_euro(F.col("saved").cast("double")))).otherwise(base)
    return rows.withColumn("message", text)


def missing_searches(terms: DataFrame) -> DataFrame:
    return terms.groupBy(F.lower("term").alias("term")).agg(F.count("*").alias("times"), F.max("created_at").alias("last_at"))
