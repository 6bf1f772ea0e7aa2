"""The catalogue jobs over streams; each has a batch twin that gives the same rows.

What a job remembers of a key is Spark's own keyed state (RocksDB, changelogs in the
checkpoint folder), so a batch writes what it changes and nothing else; files are
written once by the sink's log, also when a batch is repeated. The state can be read as a
table (``last_prices``). ``keyed_state`` sets the provider that this needs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from trolley.operators.alerts import target_alerts, with_message

HISTORY = "store string, id string, ts timestamp, price double"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_US = 86_400_000_000
#: A task holds so many prices before it sends minima of them, in pieces of the second number.
HELD_ROWS, SENT_ROWS = 2_000_000, 10_000


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB; the session's setting is put back."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


def run_to_end(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Write what has arrived to Parquet files at ``path``; a later call with the same checkpoint goes on from there."""
    with keyed_state(stream.sparkSession):
        run = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        run.trigger(availableNow=True).start().awaitTermination()


def landing_offers(spark: SparkSession, path: str, schema, extract: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Offers of arriving page files through the batch extraction."""
    return extract(spark.readStream.schema(schema).parquet(path))


def first_in_run(stream: DataFrame, delay: str = "90 minutes") -> DataFrame:
    """The first row of each (store, id) within the delay."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["store", "id"])


class ChangeOnly(StatefulProcessor):
    """Rows of one (store, id) that change its price; the state is the last row, by time, then price."""

    def __init__(self, expiry_us: int):
        self.expiry = expiry_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at long, price double, cents long")

    def _timer(self, at: int) -> int:
        return (at + self.expiry) // 1000 + 1

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        own = pd.concat(list(rows), ignore_index=True)[["at", "price", "cents"]].astype({"at": "Int64", "price": "Float64", "cents": "Int64"})
        before = self.last.get() if self.last.exists() else None
        fresh = own["at"].notna() if before is None else (own["at"] >= before[0]).fillna(False)
        late = int((~fresh.astype(bool)).sum())
        own = own[fresh.astype(bool)].sort_values(["at", "price"], na_position="first", kind="stable")
        out = pd.DataFrame({"at": [None], "price": [None], "late": [late]}) if late else None
        if len(own):
            times, values = own["at"].to_numpy("int64"), own["cents"]
            missing = values.isna().to_numpy()
            number = values.fillna(0).to_numpy("int64")
            has = before is not None and before[2] is not None
            old_time = np.concatenate(([before[0] if before is not None else 0], times[:-1]))
            old_missing = np.concatenate(([not has], missing[:-1]))
            old = np.concatenate(([before[2] if has else 0], number[:-1]))
            gone = times - old_time > self.expiry
            gone[0] &= before is not None
            changed = old_missing | gone | (~missing & (number != old))
            kept = own[changed]
            if before is not None:
                self.handle.deleteTimer(self._timer(before[0]))
            end = own.iloc[-1]
            none = lambda x, kind: None if pd.isna(x) else kind(x)
            self.last.update((int(end["at"]), none(end["price"], float), none(end["cents"], int)))
            self.handle.registerTimer(self._timer(int(end["at"])))
            rows_out = pd.DataFrame({"at": kept["at"], "price": kept["price"], "late": None})
            out = rows_out if out is None else pd.concat([rows_out, out], ignore_index=True)
        if out is not None and len(out):
            yield pd.DataFrame(
                {
                    "store": [key[0]] * len(out), "id": [key[1]] * len(out), "at": out["at"].astype("Int64").to_numpy(),
                    "price": out["price"].astype("Float64").to_numpy(), "late": out["late"].astype("Int64").to_numpy(),
                }
            )

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """The key has been silent for so long that it is delisted: nothing is remembered of it."""
        self.last.clear()
        yield pd.DataFrame()

    def close(self) -> None:
        pass


def price_changes(stream: DataFrame, delay: str = "30 days", expiry_days: int = 400) -> DataFrame:
    """store, id, ts, price, late: rows of a stream that change the price of their (store, id) in cents, as in the batch twin.

    Within a key rows are ordered by time, then price (null first). A key silent for more than
    ``expiry_days`` counts as new when it comes back, and its state goes when the watermark
    (``delay`` behind the newest row) has passed that time. Rows without a time, and rows
    older than the key's last one of earlier batches, are dropped and counted: a row with
    ``late`` and no time or price says how many. Spark itself drops rows older than the
    watermark of the batch before. A task holds 24 bytes for each row that a key has in one
    micro-batch, which the source's trigger options bound.
    """
    cents = (F.col("price").cast("decimal(12,2)") * 100).cast("long")
    rows = stream.withWatermark("ts", delay).select("store", "id", "ts", F.unix_micros("ts").alias("at"), "price", cents.alias("cents"))
    out = rows.groupBy("store", "id").transformWithStateInPandas(
        ChangeOnly(expiry_days * DAY_US), "store string, id string, at long, price double, late long", "Append", "EventTime"
    )
    return out.select("store", "id", F.timestamp_micros("at").alias("ts"), "price", "late")


def history_rows(spark: SparkSession, path: str) -> DataFrame:
    """The changes that a ``price_changes`` stream has written."""
    return spark.read.schema(f"{HISTORY}, late long").parquet(path).filter("late is null").drop("late")


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """(store, id, n): rows dropped as late."""
    return spark.read.schema(f"{HISTORY}, late long").parquet(path).filter("late is not null").groupBy("store", "id").agg(F.sum("late").alias("n"))


def last_prices(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(store, id, ts, price): what the stream remembers, read from its state."""
    state = spark.read.format("statestore").option("stateVarName", "last").load(checkpoint)
    return state.select("key.store", "key.id", F.timestamp_micros("value.at").alias("ts"), "value.price")


def _least_prices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least price of each product of a task's rows; a product may come again where a task has very many."""
    held: list[pa.Table] = []
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        if sum(t.num_rows for t in held) >= HELD_ROWS:
            held = [_least(held)]
            if held[0].num_rows >= HELD_ROWS // 2:
                yield from held.pop().to_batches(SENT_ROWS)
    if held:
        yield from _least(held).to_batches(SENT_ROWS)


def _least(tables: list[pa.Table]) -> pa.Table:
    found = pa.concat_tables(tables).group_by("product_id").aggregate([("price", "min")])
    return found.select(["product_id", "price_min"]).rename_columns(["product_id", "price"])


def least_prices(prices: DataFrame) -> DataFrame:
    """(product_id, price) with the least price of each product in a micro-batch, without state; nulls are left out.

    Tasks send their own minima, so a product with very many prices makes few rows.
    """
    rows = prices.select("product_id", "price").filter("product_id is not null and price is not null")
    return rows.mapInArrow(_least_prices, rows.schema).repartition("product_id").mapInArrow(_least_prices, rows.schema)


class TellOnce(StatefulProcessor):
    """Alerts of one kind below the price last told, for one bucket of (user, product); the state are these prices.

    NaN suppresses for good. The users of a negative bucket are null.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.told = handle.getValueState("told", "users array<long>, products array<long>, prices array<double>")

    def _keep(self, told: dict[tuple[int, int], float]) -> None:
        self.told.update(([u for u, _ in told], [p for _, p in told], list(told.values())))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        best: dict[tuple[int, int], tuple[float, float]] = {}
        for part in rows:
            columns = (part[c].tolist() for c in ("user_id", "product_id", "current", "base"))
            for user, product, current, base in zip(*columns, strict=True):
                before = best.get((user, product))
                if before is None or (current, base) < before:
                    best[user, product] = (current, base)
        known = {}
        if self.told.exists():
            users, products, prices = self.told.get()
            known = dict(zip(zip(users, products, strict=True), prices, strict=True))
        fresh = {k: x for k, x in best.items() if k not in known or known[k] > x[0]}
        if fresh:
            self._keep(known | {k: x[0] for k, x in fresh.items()})
            yield pd.DataFrame(
                {
                    "user_id": pd.array([u if key[1] >= 0 else None for u, _ in fresh], "Int64"),
                    "product_id": [p for _, p in fresh], "kind": key[0],
                    "current": [x[0] for x in fresh.values()], "base": [x[1] for x in fresh.values()],
                }
            )

    def handleInitialState(self, key, initialState, timerValues) -> None:
        users, products, prices = (initialState[c].iloc[0] for c in ("users", "products", "prices"))
        self._keep({(int(u), int(p)): float(x) for u, p, x in zip(users, products, prices, strict=True)})

    def close(self) -> None:
        pass


def streamed_alerts(alerts: DataFrame, prices: DataFrame, log: DataFrame | None = None, buckets: int = 4096) -> DataFrame:
    """Target alerts of a stream of prices (product_id, price), each told again only below the price last told.

    ``log`` (user_id, product_id, kind, price_at_notification; one row each) is what has
    been told before the stream began; a null price there suppresses for good. In a
    micro-batch the least price of an alert counts, so the least price of each product is
    all that meets the alerts. What has been told lies in ``buckets`` groups of a kind, of
    which a micro-batch rewrites those that its alerts fall into; a checkpoint keeps its number.
    """
    due = target_alerts(alerts, least_prices(prices).withColumnRenamed("price", "current"))
    user, product = F.col("user_id").cast("long"), F.col("product_id").cast("long")
    place = F.pmod(F.xxhash64(user, product), F.lit(buckets)).cast("int")
    key = ["kind", F.when(user.isNull(), -1 - place).otherwise(place).alias("bucket")]
    pair = [F.coalesce(user, F.lit(0)).alias("user_id"), product.alias("product_id")]
    rows = due.select(*key, *pair, F.col("current").cast("double"), F.col("base").cast("double"))
    start = None
    if log is not None:
        price = F.coalesce(F.col("price_at_notification").cast("double"), F.lit(float("nan"))).alias("price")
        told = log.filter("product_id is not null").select(*key, *pair, price).groupBy("kind", "bucket").agg(F.collect_list(F.struct("user_id", "product_id", "price")).alias("x"))
        start = told.select("kind", "bucket", F.col("x.user_id").alias("users"), F.col("x.product_id").alias("products"), F.col("x.price").alias("prices")).groupBy("kind", "bucket")
    told = rows.groupBy("kind", "bucket").transformWithStateInPandas(
        TellOnce(), "user_id long, product_id long, kind string, current double, base double", "Append", "None", start
    )
    return with_message(told)


def weekly_spend(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """Spent and purchases per user over seven days, every day."""
    return (
        stream.withWatermark("ts", delay)
        .groupBy(F.window("ts", "7 days", "1 day"), "user_id")
        .agg(F.sum("amount").alias("spent"), F.count("*").alias("n"))
    )


def freshness(stream: DataFrame) -> DataFrame:
    return stream.groupBy("store").agg(F.max("ts").alias("newest"), F.count("*").alias("n"))
