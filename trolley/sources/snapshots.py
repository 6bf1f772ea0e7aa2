"""Keyed snapshots in hash buckets: an update rewrites the buckets that its keys touch, nothing else.

Rows lie in ``data/v<n>/bucket=<b>`` by a hash of their key. A manifest says for each
version which folder holds each bucket; it is one small file, put in place by one rename
after the data, so a reader sees the version before or the one after, also when a
writer dies between the two. Old versions stay readable. One writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFEST = "version long, bucket int, data long, buckets int, key array<string>, columns string"


def bucket_of(key: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions that can be read, oldest first; none where there is no snapshot."""
    try:
        found = _manifest(spark, path).select("version").distinct().collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(r["version"] for r in found)


def _entries(spark: SparkSession, path: str, version: int | None) -> list:
    """A row for each bucket (their number is a parameter of the snapshot) of one version."""
    known = versions(spark, path)
    if not known or (version is not None and version not in known):
        raise ValueError(f"no version {version} of {path}")
    return _manifest(spark, path).filter(F.col("version") == (known[-1] if version is None else version)).collect()


def _folders(spark: SparkSession, path: str, entries: list) -> DataFrame:
    schema = StructType.fromJson(json.loads(entries[0]["columns"]))
    folders = [f"{path}/data/v{e['data']}/bucket={e['bucket']}" for e in entries if e["data"] is not None]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def _write(rows: DataFrame, path: str, version: int, key: list[str], buckets: int) -> set[int]:
    """Write rows by bucket; the buckets that have any. A folder that a dead writer left is replaced."""
    folder = f"{path}/data/v{version}"
    laid = rows.withColumn("bucket", bucket_of(key, buckets)).hint("rebalance", "bucket")
    laid.write.mode("overwrite").partitionBy("bucket").parquet(folder)
    try:
        found = rows.sparkSession.read.parquet(folder).select(F.col("bucket").cast("int")).distinct().collect()
    except AnalysisException as empty:
        if empty.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            raise
        return set()
    return {r["bucket"] for r in found}


def _commit(spark: SparkSession, path: str, version: int, data: dict[int, int | None], key: list[str], columns: str) -> None:
    rows = [(version, b, d, len(data), key, columns) for b, d in sorted(data.items())]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")


def create_snapshot(rows: DataFrame, path: str, key: list[str], buckets: int = 256) -> int:
    """Version 0 of a new snapshot; keys are unique. More buckets make smaller updates and more files."""
    if "bucket" in rows.columns:
        raise ValueError("a column of the name bucket would clash with the layout")
    spark = rows.sparkSession
    if versions(spark, path):
        raise ValueError(f"{path} holds a snapshot")
    filled = _write(rows, path, 0, key, buckets)
    _commit(spark, path, 0, {b: 0 if b in filled else None for b in range(buckets)}, key, rows.schema.json())
    return 0


def read_snapshot(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a version, the newest if none is named; what is read does not change under later updates."""
    return _folders(spark, path, _entries(spark, path, version))


def update_snapshot(incoming: DataFrame, path: str, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
    """The version after ``merge`` (current rows, incoming rows), which sees the touched buckets only.

    ``merge`` works key by key: it returns rows of keys that one of its sides has, with the
    snapshot's columns; keys that it leaves out are deleted. ``incoming`` has the key's
    columns and is read twice. Without rows the version stays as it is.
    """
    spark = incoming.sparkSession
    entries = _entries(spark, path, None)
    first = entries[0]
    key, buckets, version = list(first["key"]), first["buckets"], first["version"] + 1
    touched = {r["b"] for r in incoming.select(bucket_of(key, buckets).alias("b")).distinct().collect()}
    if not touched:
        return first["version"]
    current = _folders(spark, path, [e for e in entries if e["bucket"] in touched])
    columns = StructType.fromJson(json.loads(first["columns"])).fieldNames()
    filled = _write(merge(current, incoming).select(*columns), path, version, key, buckets)
    data = {e["bucket"]: e["data"] for e in entries}
    data.update({b: version if b in filled else None for b in touched})
    _commit(spark, path, version, data, key, first["columns"])
    return version
