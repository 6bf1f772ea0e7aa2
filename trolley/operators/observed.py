"""Counts of a run, taken by the write that produces its rows, and the guard that stops a bad run.

Metrics are Spark's observed metrics: they are added up in the tasks of the write itself,
so no second scan counts what was found, saved and ignored. In a stream every micro-batch
reports its own, and the guard judges their sum.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SUMMARY = "store string, found long, saved long"


class RunStopped(RuntimeError):
    """The guard's verdict, with what had been counted."""

    def __init__(self, verdict: str, counts: dict[str, int]):
        super().__init__(f"{verdict}: {counts}")
        self.verdict, self.counts = verdict, counts


@dataclass(frozen=True)
class Counters:
    """What is counted: reasons that are ignored, reasons that are errors, and the stores told apart (a fixed, short list)."""

    ignored: tuple[str, ...]
    errors: tuple[str, ...]
    stores: tuple[str, ...] = ()

    def metrics(self) -> list[Column]:
        """One aggregate for each store and figure; a null reason is a saved row."""
        reason, out = F.col("reason"), []
        for store in ("", *self.stores):
            own = F.lit(True) if store == "" else F.coalesce(F.col("store") == store, F.lit(False))
            out += [F.count_if(own).alias(f"{store}|found"), F.count_if(own & reason.isNull()).alias(f"{store}|saved")]
            out += [F.count_if(own & (reason == r)).alias(f"{store}|ignored_{r}") for r in self.ignored]
            out.append(F.count_if(own & reason.isin(*self.errors)).alias(f"{store}|errors"))
        return out

    def verdict(self, counts: dict[str, int], most: float = 0.05) -> str:
        found, errors = counts.get("|found", 0), counts.get("|errors", 0)
        return "empty" if not found else "too_many_errors" if errors > found * most else "ok"

    def summary(self, spark: SparkSession, counts: dict[str, int]) -> DataFrame:
        """A row for each store that had rows: found, saved, ignored by cause, errors."""
        names = ["found", "saved", *[f"ignored_{r}" for r in self.ignored], "errors"]
        rows = [(s, *[counts.get(f"{s}|{n}", 0) for n in names]) for s in self.stores if counts.get(f"{s}|found")]
        return spark.createDataFrame(rows, "store string, " + ", ".join(f"{n} long" for n in names))


def write_observed(rows: DataFrame, path: str, counters: Counters, most: float = 0.05) -> dict[str, int]:
    """Write the rows without a ``reason`` to ``path`` and return the counts of all, in one pass.

    Raises RunStopped after the write if there were no rows or more than ``most`` of
    them were errors; what was written is then not to be used.
    """
    seen = Observation()
    rows.observe(seen, *counters.metrics()).filter("reason is null").drop("reason").write.parquet(path)
    counts = seen.get
    verdict = counters.verdict(counts, most)
    if verdict != "ok":
        raise RunStopped(verdict, counts)
    return counts


def stream_observed(stream: DataFrame, path: str, checkpoint: str, counters: Counters, most: float = 0.05, least: int = 1) -> dict[str, int]:
    """The same for a stream, run to its end: counts over its micro-batches, stopped once the guard speaks.

    The guard judges the sum of the micro-batches so far, from ``least`` rows on; nothing
    arriving at all is ``empty``. Batches before the stop stay written.
    """
    named = stream.observe("run", *counters.metrics()).filter("reason is null").drop("reason")
    run = named.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    counts: dict[str, int] = {}
    done = -1
    while True:
        ended = run.awaitTermination(1)
        for progress in run.recentProgress:
            if progress["batchId"] > done and "run" in progress["observedMetrics"]:
                done = progress["batchId"]
                for name, n in progress["observedMetrics"]["run"].asDict().items():
                    counts[name] = counts.get(name, 0) + n
        verdict = counters.verdict(counts, most)
        if verdict == "too_many_errors" and counts["|found"] >= least:
            run.stop()
            raise RunStopped(verdict, counts)
        if ended:
            if verdict != "ok":
                raise RunStopped(verdict, counts)
            return counts
