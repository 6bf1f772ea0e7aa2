"""Filters, dedupes, aggregates and set operations of the catalogue jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trolley.functions.text import token_hash
from trolley.sources.shared import written


def valid_price(df: DataFrame, floors: dict[str, float] | None = None, cap: float = 100.0) -> DataFrame:
    """Adds ``reason``: null for a valid price below ``cap`` and not below its store's floor."""
    price = F.col("price").cast("double")
    floor = F.lit(0.0)
    for store, least in (floors or {"pingo-doce": 0.05}).items():
        floor = F.when(F.col("store") == store, least).otherwise(floor)
    return df.withColumn(
        "reason",
        F.when(price.isNull() | F.isnan(price), "not_a_number").when(price >= cap, "too_high").when(price < floor, "too_low"),
    )


def within_scope(urls: DataFrame, prefixes: DataFrame) -> DataFrame:
    """URLs that start with a listed prefix: each path prefix of a URL is looked up by equality.

    ``prefixes`` has prefix, ending anywhere; matches are exact because every prefix of
    the URL whose length occurs in the table is tried.
    """
    lengths = F.broadcast(prefixes.select(F.length("prefix").alias("n")).distinct())
    tried = urls.select("url").distinct().join(lengths, F.length("url") >= F.col("n"))
    hit = tried.withColumn("prefix", F.expr("substring(url, 1, n)")).join(prefixes, "prefix", "left_semi")
    return urls.join(hit.select("url").distinct(), "url", "left_semi")


def first_seen(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """The first row of each key by ``order`` (which must be total)."""
    columns = [c for c in df.columns if c not in key]
    best = df.groupBy(*key).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("r"))
    return best.select(*key, "r.*").select(*df.columns)


def latest(df: DataFrame, key: list[str], order: list) -> DataFrame:
    columns = [c for c in df.columns if c not in key]
    best = df.groupBy(*key).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("r"))
    return best.select(*key, "r.*").select(*df.columns)


def not_known(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not known; rows without a key stay."""
    return df.join(known.select(key).filter(F.col(key).isNotNull()).distinct(), key, "left_anti")


def not_recent(df: DataFrame, known: DataFrame, key: str, now: Column, minutes: int = 90) -> DataFrame:
    recent = known.filter(F.col("updated_at") >= now - F.expr(f"INTERVAL {int(minutes)} MINUTES"))
    return not_known(df, recent, key)


def shard(df: DataFrame, key: str, shards: int, index: int) -> DataFrame:
    return df.filter(token_hash(F.col(key)) % shards == index)


def work_queue(df: DataFrame, updated: str, key: str, budget: int) -> DataFrame:
    """New items first, then the oldest: a top-k, not a sort of everything."""
    return df.orderBy(F.col(updated).asc_nulls_first(), F.col(key)).limit(budget)


def counts_by(df: DataFrame, column: str, missing: str = "(vazio)") -> DataFrame:
    value = F.coalesce(F.nullif(F.trim(F.col(column).cast("string")), F.lit("")), F.lit(missing))
    return df.groupBy(value.alias("value")).agg(F.count("*").alias("n"))


def with_percent(counts: DataFrame) -> DataFrame:
    """Adds the share of the total in percent, one decimal; the total is one aggregated row."""
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select(
        "value", "n", F.round(F.col("n") * 100.0 / F.col("total"), 1).alias("percent")
    )


def staleness(df: DataFrame, store: str, updated: str, now: Column) -> DataFrame:
    """Per store: rows, rows older than 7 and 14 days, the latter in percent, oldest and newest."""
    older = lambda days: F.count_if(F.col(updated) < now - F.expr(f"INTERVAL {days} DAYS"))
    return df.groupBy(store).agg(
        F.count("*").alias("total"),
        older(7).alias("older_7d"),
        older(14).alias("older_14d"),
        F.round(older(14) * 100.0 / F.count("*"), 1).alias("percent_14d"),
        F.min(updated).alias("oldest"),
        F.max(updated).alias("newest"),
    )


def systematic_sample(df: DataFrame, order: list, k: int) -> DataFrame:
    """Every floor(n / k)-th row (at least every one) in ``order``, k at most.

    Rows are numbered from per-partition counts of a range partitioning, so no task
    sees all rows. The sorted rows are written once: sizes and rows come from the same
    partitioning, whose bounds Spark would draw anew for each job.
    """
    n = df.count()
    step = max(1, n // k) if k else n + 1
    spark = df.sparkSession
    sorted_ = written(
        df.orderBy(*order).withColumn("_part", F.spark_partition_id()).withColumn("_mono", F.monotonically_increasing_id()),
        "numbered",
    )
    sizes = sorted_.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_mono").alias("_first"))
    before, offsets = 0, []
    for row in sorted(sizes.collect(), key=lambda r: r["_part"]):
        offsets.append((row["_part"], before - row["_first"]))
        before += row["_n"]
    shift = spark.createDataFrame(offsets, "_part int, _shift long")
    numbered = sorted_.join(F.broadcast(shift), "_part").withColumn("_no", F.col("_mono") + F.col("_shift"))
    picked = numbered.filter((F.col("_no") % step == 0) & (F.col("_no") < step * k))
    return picked.select(*df.columns)


def set_changes(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``key`` lost and gained between two results."""
    lost = old.select(*key).distinct().join(new, key, "left_anti").withColumn("change", F.lit("lost"))
    gained = new.select(*key).distinct().join(old, key, "left_anti").withColumn("change", F.lit("gained"))
    return lost.unionByName(gained)


def unambiguous(df: DataFrame, key: str, target: str) -> DataFrame:
    """(key, target) where a key has exactly one target."""
    return (
        df.groupBy(key)
        .agg(F.count_distinct(target).alias("_n"), F.min(target).alias(target))
        .filter("_n = 1")
        .select(key, target)
    )


def highest_since(
    marks: DataFrame, facts: DataFrame, key: str, since: str, day: str, value: str, span_days: int = 366
) -> DataFrame:
    """(key, since, value): for each distinct mark the highest ``value`` of its key from that day on.

    Marks without a day, and those that no fact follows, have no row. Facts become daily
    maxima before anything else, then marks and maxima of a key are put in one order and the
    maximum runs from the newest day backwards. A key's days are cut into spans of
    ``span_days``; the maxima of later spans are carried over, so a task sorts one span
    of a key, and what is computed is linear in marks and facts.
    """
    span = F.floor(F.datediff("_day", F.lit("1970-01-01").cast("date")) / span_days).alias("_span")
    daily = facts.select(F.col(key).alias("_key"), F.col(day).cast("date").alias("_day"), F.col(value).alias("_value"))
    daily = daily.filter("_day is not null and _value is not null").groupBy("_key", "_day").agg(F.max("_value").alias("_value"))
    asked = marks.select(F.col(key).alias("_key"), F.col(since).cast("date").alias("_day")).filter("_day is not null").distinct()
    points = daily.select("_key", "_day", span, "_value", F.lit(0).alias("_mark")).unionByName(
        asked.select("_key", "_day", span, F.lit(None).cast(daily.schema["_value"].dataType).alias("_value"), F.lit(1).alias("_mark"))
    )
    # Facts of a day come before its marks, which they count for.
    inside = Window.partitionBy("_key", "_span").orderBy(F.desc("_day"), "_mark").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = points.withColumn("_own", F.max("_value").over(inside)).filter("_mark = 1")
    later = Window.partitionBy("_key").orderBy(F.desc("_span")).rowsBetween(Window.unboundedPreceding, -1)
    spans = points.groupBy("_key", "_span").agg(F.max("_value").alias("_most")).withColumn("_later", F.max("_most").over(later))
    found = running.join(spans.filter("_later is not null").select("_key", "_span", "_later"), ["_key", "_span"], "left")
    best = F.greatest("_own", "_later").alias(value)
    return found.select(F.col("_key").alias(key), F.col("_day").alias(since), best).filter(F.col(value).isNotNull())


def fill_from(df: DataFrame, sources: list[DataFrame], key: str, column: str) -> DataFrame:
    """``column`` by key from the first source that has it; each source is made unique by key first."""
    own = F.col(column)
    for i, source in enumerate(sources):
        one = source.filter(F.col(column).isNotNull()).groupBy(key).agg(F.min(column).alias(f"_v{i}"))
        df = df.join(one, key, "left")
        own = F.coalesce(own, F.col(f"_v{i}"))
    return df.withColumn(column, own).drop(*[f"_v{i}" for i in range(len(sources))])


def rolling_sums(df: DataFrame, key: str, when: str, amount: str, now: Column, days: int = 7) -> DataFrame:
    recent = df.filter((F.col(when) > now - F.expr(f"INTERVAL {int(days)} DAYS")) & (F.col(when) <= now))
    return recent.groupBy(key).agg(F.sum(amount).alias("spent"), F.count("*").alias("n"))


def best_scored(df: DataFrame, key: list[str], score: str, order: list[str]) -> DataFrame:
    """The highest-scored row of each key, ties to the smallest ``order``, null scores last."""
    columns = [c for c in df.columns if c not in key]
    rising = F.struct(F.col(score).isNull(), -F.col(score), *order)
    best = df.groupBy(*key).agg(F.min_by(F.struct(*columns), rising).alias("_r"))
    return best.select(*key, "_r.*").select(*df.columns)


def missing_by(df: DataFrame, column: str, by: str) -> DataFrame:
    """Rows without ``column``, counted by another one."""
    return df.filter(F.col(column).isNull()).groupBy(by).agg(F.count("*").alias("n"))


def report_counts(reports: DataFrame, listing: str) -> DataFrame:
    """Reports by listing and status; a report without a status is pending."""
    return reports.groupBy(listing, F.coalesce("status", F.lit("pending")).alias("status")).agg(F.count("*").alias("n"))
