"""A table of the newest save of each key, kept by a stream of saves.

Under its path are ``log/batch=N``, what each batch brought, ``base-...``, all keys
as of some batch, and ``versions``, a row for each base that is whole. A batch
writes its own rows alone; every so many batches a new base is written and then
published by its row in ``versions``, so a crash at any point leaves a table that
reads right, and a batch that runs again writes the same. No state is kept by time:
a first save is never too late, and an older one of a key changes nothing.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessella.functions.session import remove

VERSION = "upto long, base string"


def _newest(rows: DataFrame, keys: list[str], time: str) -> DataFrame:
    """The newest row of each key; of several of one time the greatest in its other columns."""
    rest = [c for c in rows.columns if c not in (*keys, time)]
    best = F.max(F.struct(time, *rest)).alias("__s")
    return rows.groupBy(*keys).agg(best).select(*keys, *(F.col(f"__s.{c}").alias(c) for c in (time, *rest))).select(*rows.columns)


def _versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Published bases, the newest last; a row each compaction that is still kept."""
    try:
        return sorted(tuple(r) for r in spark.read.schema(VERSION).parquet(f"{path}/versions").collect())
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def read_saves(spark: SparkSession, path: str, schema, keys: list[str], time: str) -> DataFrame:
    """The newest save of each key: the newest base and what batches have brought since."""
    return _merged(spark, path, schema, keys, time, None)


def _merged(spark: SparkSession, path: str, schema, keys: list[str], time: str, upto: int | None) -> DataFrame:
    blank = spark.createDataFrame([], schema)
    columns, kind = blank.columns, blank.schema
    upto_base, base = (_versions(spark, path) or [(-1, None)])[-1]
    rows = spark.read.schema(kind).parquet(f"{path}/{base}") if base else blank
    try:
        log = spark.read.schema(kind.add("batch", "long")).parquet(f"{path}/log").where(F.col("batch") > upto_base)
        rows = rows.select(*columns).unionByName((log if upto is None else log.where(F.col("batch") <= upto)).select(*columns))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    return _newest(rows.select(*columns), keys, time)


def _compact(spark: SparkSession, path: str, schema, keys: list[str], time: str, number: int) -> None:
    """Write and publish a base of all up to a batch; then drop what only bases older than the last two need."""
    base = f"base-{number}-{uuid.uuid4().hex}"
    _merged(spark, path, schema, keys, time, number).write.parquet(f"{path}/{base}")
    _publish(spark, path, number, base)
    known = _versions(spark, path)
    if len(known) > 2:  # older ones went when later bases were published
        upto, name = known[-3]
        remove(spark, f"{path}/{name}")
        for n in range(known[-4][0] + 1 if len(known) > 3 else 0, upto + 1):
            remove(spark, f"{path}/log/batch={n}")


def _publish(spark: SparkSession, path: str, number: int, base: str) -> None:
    spark.createDataFrame([(number, base)], VERSION).coalesce(1).write.mode("append").parquet(f"{path}/versions")


def stream_upsert(stream: DataFrame, path: str, checkpoint: str, keys: list[str], time: str, every: int = 16) -> StreamingQuery:
    """Keep the newest save of each key under ``path``; ``read_saves`` reads it.

    Repeated and late saves change nothing newer. ``every`` so many batches all keys
    are written anew as one base, so a read merges few batches.
    """
    spark, schema = stream.sparkSession, stream.schema

    def apply(batch: DataFrame, number: int) -> None:
        _newest(batch, keys, time).write.mode("overwrite").parquet(f"{path}/log/batch={number}")
        if number % every == every - 1:
            _compact(spark, path, schema, keys, time, number)

    query = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
