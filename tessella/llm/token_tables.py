"""Token ids as Parquet list columns that allow selective reads.

Documents are ordered by id over all files. Token lists are dictionary-encoded
(the vocabulary is the dictionary), ids and places are delta-encoded, row groups
and pages are kept small and carry page indexes, so that a reader of a few
documents or of the metadata columns alone reads little else.

Defined cases: a null text is an empty one and has the end id alone; null ids
come first; equal ids are ordered by a hash of the text; equal rows are stored
one by one; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.llm.common import chunks, documents, fresh_path, id_text, small_batches
from tessella.llm.tokens import default_path, encoder

LAYOUT = {
    "compression": "zstd",
    "parquet.writer.version": "v2",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.enable.dictionary": "true",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#file_start": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}
SCHEMA = "doc_id long, part int, file_start long, n_tokens long, tokens array<int>"


def _encode(vocabulary: str, end_id: int):
    def run(batches):
        part, coder, so_far = TaskContext.get().partitionId(), encoder(vocabulary), 0
        for frame in chunks((b.to_pandas() for b in batches), "text"):
            ids, size = coder.encode_with_end(frame["text"].tolist(), end_id)
            running = so_far + np.cumsum(size)
            edges = np.append(0, np.cumsum(size)).astype(np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(edges), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(frame["doc_id"], pa.string()), pa.array(np.full(len(size), part, np.int32)), pa.array(running - size), pa.array(size), tokens],
                ["doc_id", "part", "file_start", "n_tokens", "tokens"],
            )
            so_far = int(running[-1])

    return run


def write_token_table(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = 0) -> None:
    """Write the ids of ``docs`` (doc_id, text) in ascending doc_id order."""
    small_batches(docs.sparkSession)
    keys = (F.col("doc_id"), F.col("__hash"), F.col("__row"))
    (
        docs.select(
            F.col("doc_id").cast("long"), F.col("text").cast("string"),
            F.xxhash64(F.col("text").cast("string")).alias("__hash"), F.monotonically_increasing_id().alias("__row"),
        )
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select(id_text(), "text")
        .mapInArrow(_encode(vocabulary or default_path(), end_id), SCHEMA.replace("doc_id long", "doc_id string"))
        .withColumn("doc_id", F.col("doc_id").cast("long"))
        .write.options(**LAYOUT)
        .parquet(path)
    )


def read_token_table(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, tokens."""
    stored = spark.read.schema(SCHEMA).parquet(path)
    totals = stored.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    starts = totals.select("part", before.alias("part_start"))
    if int(spark.conf.get("spark.sql.shuffle.partitions")) <= 100_000:  # parts, and so rows of starts, are no more
        starts = F.broadcast(starts)
    return stored.join(starts, "part").select("doc_id", (F.col("part_start") + F.col("file_start")).alias("start"), "n_tokens", "tokens")


def read_documents(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """doc_id, n_tokens and tokens of the documents with ids from ``first`` to ``last``.

    The bounds reach the scan, and since the table is ordered by id, row groups
    and pages outside them are skipped.
    """
    stored = spark.read.schema(SCHEMA).parquet(path)
    return stored.where(F.col("doc_id").between(first, last)).select("doc_id", "n_tokens", "tokens")


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and n_tokens; the token column is not read."""
    return spark.read.schema(SCHEMA).parquet(path).select("doc_id", "n_tokens")


def read_tokens(spark: SparkSession, path: str, start: int, length: int) -> DataFrame:
    """doc_id, start (as in ``read_token_table``) and the ids that lie in [start, start + length) of all ids.

    Parts whose ids lie elsewhere are told by one pass over two small columns;
    of the others, bounds on ``file_start`` reach the scan.
    """
    stored = spark.read.schema(SCHEMA).parquet(path)
    totals = stored.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    inside = totals.select("part", "size", before.alias("base")).where((F.col("base") < start + length) & (F.col("base") + F.col("size") > start))
    found = None
    for r in inside.collect():  # the parts that the range touches
        part = stored.where((F.col("part") == r["part"]) & (F.col("file_start") < start + length - r["base"]) & (F.col("file_start") + F.col("n_tokens") > start - r["base"]))
        part = part.withColumn("start", F.col("file_start") + r["base"])
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = stored.limit(0).withColumn("start", F.col("file_start"))
    skip = F.greatest(F.lit(start) - F.col("start"), F.lit(0)).cast("int")
    until = F.least(F.lit(start + length) - F.col("start"), F.col("n_tokens")).cast("int")
    return found.select("doc_id", (F.col("start") + skip).alias("start"), F.slice("tokens", skip + 1, until - skip).alias("tokens"))


def _crc(batches):
    for b in batches:
        lists = b.column("tokens")
        edges = lists.offsets.to_numpy()
        values = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
        sums = [zlib.crc32(values[a:z]) for a, z in zip(edges, edges[1:])]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("start"), b.column("n_tokens"), pa.array(sums, pa.int64())],
            ["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def op8_token_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents' ids, read the files back, and digest what they hold."""
    path = fresh_path(spark, "token-table")
    write_token_table(documents(spark, sf_dir), path)
    return read_token_table(spark, path).mapInArrow(_crc, "doc_id long, start long, n_tokens long, ids_crc32 long")
