"""Sharding by a Feistel permutation of global row numbers.

Rows get global numbers 0..n-1 in an order that their own values fix, however
the input is partitioned. A keyed Feistel network over a x b >= n permutes them;
numbers that leave 0..n-1 walk on through the permutation until they are back.
Shard and slot follow from the permuted number by arithmetic, and so the place
of any row can be computed, and shard sizes differ by one row at most.

Defined cases: a null text counts as no bytes; rows equal in all columns are
interchangeable and get one place each; nulls sort first; an empty table gives
an empty result; columns of map type can't be ordered and are refused by Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.llm.common import documents, text_of

ROUNDS = 6
#: Steps of the walk. A step stays outside with a probability below 1/sqrt(n), and at most
#: a*b - n + 1 steps are ever needed, so for n up to 1,600 this is a bound and beyond it
#: the chance to need more is under 10**-60; such a row would raise an error.
WALK = 40
#: Buckets of the numbering; their totals, one row each, are the only broadcast.
BUCKETS = 16_384
#: Equal rows that are written out of one record; more of them go in blocks to other tasks first.
COPIES = 100_000


def _permute(x: Column, a: Column, b: Column, key: int) -> Column:
    left, right = F.call_function("div", x, b), x % b
    for i in range(ROUNDS):
        if i % 2:
            right = (right + F.pmod(F.xxhash64(F.lit(key), F.lit(i), left), b)) % b
        else:
            left = (left + F.pmod(F.xxhash64(F.lit(key), F.lit(i), right), a)) % a
    return left * b + right


def feistel(x: Column, n: Column, key: int) -> Column:
    """The place of number ``x`` in a keyed permutation of 0..n-1 (64-bit columns)."""
    a = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    b = F.call_function("div", n + a - 1, a)
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)),
        _permute(x, a, b, key),
        lambda at, _: F.when(at < n, at).otherwise(_permute(at, a, b, key)),
    )
    # the rounds nest, so each is bound to a variable before the next step reads it
    return F.element_at(
        F.transform(
            F.array(walked),
            lambda at: F.when(at < n, at).otherwise(F.raise_error(F.lit("the cycle walk did not end")).cast("long")),
        ),
        1,
    )


def number_rows(df: DataFrame, name: str = "row_number", total: str = "n_rows") -> DataFrame:
    """Add global row numbers 0..n-1 and the row count, without a global sort.

    Equal rows are counted before they are shuffled, so a row repeated any
    number of times costs one record a task; they are written out in blocks of
    ``COPIES`` that are dealt to all tasks.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__copies"))
    groups = groups.withColumn("__bucket", F.pmod(F.xxhash64(*columns), F.lit(BUCKETS)).cast("int"))
    inside = Window.partitionBy("__bucket").orderBy(*columns)
    before = F.sum("__copies").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__copies")
    totals = groups.groupBy("__bucket").agg(F.sum("__copies").alias("__size"))
    ordered = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        "__bucket",
        (F.sum("__size").over(ordered) - F.col("__size")).alias("__offset"),
        F.sum("__size").over(everything).alias("__total"),
    )
    placed = groups.withColumn("__before", before).join(F.broadcast(offsets), "__bucket")
    first = F.col("__offset") + F.col("__before")
    step = F.lit(COPIES).cast("long")
    block = lambda k: F.struct((first + k * step).alias("first"), F.least(step, F.col("__copies") - k * step).alias("copies"))
    blocks = F.transform(F.sequence(F.lit(0).cast("long"), F.call_function("div", F.col("__copies") - 1, step)), block)
    dealt = placed.select(*columns, F.col("__total"), F.explode(blocks).alias("__block")).repartition(F.col("__block.first"))
    return dealt.select(
        *columns,
        F.explode(F.sequence(F.col("__block.first"), F.col("__block.first") + F.col("__block.copies") - 1)).alias(name),
        F.col("__total").alias(total),
    )


def shard(df: DataFrame, n_shards: int, key: int = 2024) -> DataFrame:
    """Add ``shard`` (0..n_shards-1) and ``slot`` (gapless from 0 in each shard)."""
    numbered = number_rows(df, "__row", "__n")
    placed = numbered.withColumn("__at", feistel(F.col("__row"), F.col("__n"), key))
    return placed.select(
        *(F.col(f"`{c}`") for c in df.columns),
        (F.col("__at") % n_shards).cast("int").alias("shard"),
        F.call_function("div", F.col("__at"), F.lit(n_shards).cast("long")).alias("slot"),
    )


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards; law ``rows``: counts at most one apart."""
    rows = documents(spark, sf_dir).select(
        "doc_id",
        (F.octet_length(text_of()) + 1).cast("long").alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"),
    )
    return shard(rows, 16).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
