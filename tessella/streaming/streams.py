"""Structured Streaming forms of skip-what-is-done and the processing log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stream_files(spark: SparkSession, path: str, schema, fmt: str = "parquet", per_batch: int | None = None) -> DataFrame:
    """Arriving files; with a checkpoint each is processed once, also over restarts."""
    reader = spark.readStream.schema(schema).format(fmt)
    return (reader.option("maxFilesPerTrigger", per_batch) if per_batch else reader).load(path)


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Write what is there now as Parquet and stop."""
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def parse_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """``time - message`` lines."""
    pattern = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) - (.*)$"
    return lines.where(F.col(column).rlike(pattern)).select(F.to_timestamp(F.regexp_extract(column, pattern, 1)).alias("ts"), F.regexp_extract(column, pattern, 2).alias("message"))


def log_counts(events: DataFrame, late: str = "10 minutes", width: str = "1 minute") -> DataFrame:
    """Events a window; durations of tasks whose end says how long they ``took``."""
    took = F.regexp_extract("message", r"took ([0-9.]+)", 1).try_cast("double")
    timed = events.withWatermark("ts", late) if events.isStreaming else events
    counts = timed.groupBy(F.window("ts", width).alias("w")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("message").startswith("START")).alias("starts"), F.round(F.sum(took), 6).alias("seconds"))
    return counts.select(F.col("w.start").alias("minute"), "n", "starts", "seconds")


def stream_log_counts(lines: DataFrame) -> DataFrame:
    return log_counts(parse_log(lines))
