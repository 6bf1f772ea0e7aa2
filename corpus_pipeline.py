"""Corpus pipeline: five stages, each written and read again before the next.

Toxic documents go, one document of each near-duplicate class stays, documents with
benchmark windows go, personal data is masked in the text, and what is left is packed
into token sequences. Every stage works on all rows its predecessor kept.

Texts go to Python workers in batches of ``BATCH_BYTES``, whatever their number; the stages
set that in the session, unless it is set there already. No row depends on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trolley.llm._common import table, written
from trolley.llm.decontamination import decontaminate
from trolley.llm.near_dup import deduplicate
from trolley.llm.packing import pack_documents
from trolley.llm.pii import mask_personal_data
from trolley.llm.toxicity import drop_toxic

#: Spark's own bound, ten thousand rows, lets some 30 MB of texts meet, several times over in a worker and in its executor.
BATCH_BYTES = "4m"
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def in_small_batches(docs: DataFrame) -> DataFrame:
    conf = docs.sparkSession.conf
    if conf.get(BATCH_SETTING, None) is None:
        conf.set(BATCH_SETTING, BATCH_BYTES)
    return docs


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(in_small_batches(docs), table(spark, sf_dir, "labels"))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return deduplicate(in_small_batches(docs))


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(in_small_batches(docs), table(spark, sf_dir, "benchmark"))


def mask_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mask_personal_data(in_small_batches(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(in_small_batches(docs))


STAGES = [
    ("toxicity", remove_toxic),
    ("near_duplicates", remove_near_duplicates),
    ("decontamination", remove_contaminated),
    ("personal_data", mask_private),
    ("packing", pack),
]

#: The trained and hashed stages have no SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
