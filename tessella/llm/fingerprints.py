"""Document fingerprints by winnowing, in SQL functions alone.

Units are words, runs of anything but ASCII white space; a longer run than
``UNIT`` code points is cut, so that text without spaces has units too. Every
``GRAM`` consecutive units have a rolling hash: unit hashes shifted by their
distance from the gram's end and added without carry, so that the next gram's
hash follows from this one by a shift and two terms. Of every ``WINDOW``
consecutive grams the smallest hash is kept, the rightmost one of equal ones,
with its place. So two texts that share ``GRAM + WINDOW - 1`` units in a row share
a kept hash, and its places tell where.

Places ride in the low bits of the number that is minimised, turned round, so that
one minimum settles ties too; the full hash is looked up for what is kept.

Defined cases: a null text is empty; a text without units has an empty
fingerprint; fewer units than a gram make one gram of them all, fewer grams than a
window one window; two empty fingerprints are alike (1), an empty one and another
are not (0); documents follow one another by id (nulls first), then by the 64-bit
hash of the text, then by the text, so rows equal in both follow each other; after
the last comes the first, and a single document is its own successor; an empty
table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.llm.common import documents, let, text_of

GRAM, WINDOW, UNIT = 5, 4, 32
#: Low bits that hold the place of a unit; texts have fewer than 2**31 bytes.
PLACE = 31
_PLACES = (1 << PLACE) - 1
#: Ranges of the order at most, and sampled keys a range; both only lay out the work, and
#: the sample's keys, two numbers each, are all that reaches the driver.
RANGES, KEYS_EACH = 16_384, 16

KIND = "array<struct<hash:bigint,at:int>>"


def _gram(units: Column, start: Column, size: int) -> Column:
    terms = [F.shiftleft(F.get(units, start + j), size - 1 - j) if j < size - 1 else F.get(units, start + j) for j in range(size)]
    return F.xxhash64(reduce(lambda a, b: a.bitwiseXOR(b), terms))


def gram_hashes(text: Column, gram: int = GRAM) -> Column:
    """Hashes of all grams of a text, in order."""
    units = F.transform(F.regexp_extract_all(text, F.lit(rf"[^\x20\x09-\x0D]{{1,{UNIT}}}"), F.lit(0)), lambda u: F.xxhash64(u))
    short = lambda u: F.array(F.xxhash64(F.aggregate(u, F.lit(0).cast("long"), lambda a, x: F.shiftleft(a, 1).bitwiseXOR(x))))
    return let(
        units,
        lambda u: F.when(F.size(u) >= gram, F.transform(F.sequence(F.lit(0), F.greatest(F.size(u) - gram, F.lit(0))), lambda i: _gram(u, i, gram)))
        .when(F.size(u) > 0, short(u))
        .otherwise(F.array().cast("array<bigint>")),
    )


def fingerprint(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """The winnowed fingerprint of a text: kept hashes with their places (numbers of first units), in order."""

    def winnow(grams: Column) -> Column:
        keyed = F.transform(grams, lambda h, i: h.bitwiseAND(F.lit(~_PLACES)).bitwiseOR(F.lit(_PLACES) - i))
        least = lambda k: F.transform(F.sequence(F.lit(0), F.greatest(F.size(k) - window, F.lit(0))), lambda i: F.least(*(F.get(k, i + j) for j in range(window))))
        kept = let(keyed, lambda k: F.when(F.size(k) >= window, F.array_distinct(least(k))).when(F.size(k) > 0, F.array(F.array_min(k))).otherwise(k))
        place = lambda k: (F.lit(_PLACES) - k.bitwiseAND(F.lit(_PLACES))).cast("int")
        return F.transform(kept, lambda k: F.struct(F.get(grams, place(k)).alias("hash"), place(k).alias("at")))

    return let(gram_hashes(text, gram), winnow).cast(KIND)


def as_text(print_: Column) -> Column:
    """A fingerprint as text: each hash in hexadecimal, a colon, its place; comma-joined."""
    return F.array_join(F.transform(print_, lambda p: F.concat(F.lower(F.hex(p["hash"])), F.lit(":"), p["at"].cast("string"))), ",")


def hashes(print_: Column) -> Column:
    return F.array_distinct(F.transform(print_, lambda p: p["hash"]))


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes over all hashes of two sets; two empty ones are alike."""
    both = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - both
    return F.when(every == 0, F.lit(1.0)).otherwise(both.cast("double") / every)


def edited(text: Column, following: Column) -> Column:
    """A text whose last half gives way to as many first code points of another text, or to all of them."""
    n = F.char_length(text)
    half = F.call_function("div", n, F.lit(2)).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def _bounds(keys: DataFrame, ranges: int) -> list[tuple]:
    """Keys that cut the order into about equal ranges, from a sample."""
    n = keys.count()
    if not n:
        return []
    found = keys.sample(min(1.0, ranges * KEYS_EACH / n), seed=11).limit(2 * RANGES * KEYS_EACH).collect()
    found = sorted({tuple(r) for r in found}, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    return found[:: max(1, len(found) // ranges)][1:]


def _range_of(bounds: Column, key: Column, n: int) -> Column:
    """How many of n rising bounds are not above the key, by halving steps."""
    steps = [1 << s for s in range(max(1, n.bit_length()) - 1, -1, -1)]
    halve = lambda low, step: F.when((low + step <= n) & (F.get(bounds, F.least(low + step, F.lit(n)) - 1) <= key), low + step).otherwise(low)
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), halve)


def in_ranges(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """doc_id, text and ``h`` in ranges of the order: columns ``range`` and ``guest``.

    The first document of a range is in the range before it too, as its guest, so
    every document's successor is in its own range. Texts are shuffled by the range
    alone, once, when a window follows.
    """
    spark = docs.sparkSession
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).withColumn("h", F.xxhash64("text"))
    ranges = min(RANGES, ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    kind = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("h", T.LongType())])
    cuts = _bounds(keyed.select("doc_id", "h"), ranges)
    table = spark.createDataFrame([(cuts,)], T.StructType([T.StructField("cuts", T.ArrayType(kind))]))
    key = F.struct("doc_id", "h")
    placed = keyed.join(F.broadcast(table)).withColumn("range", _range_of(F.col("cuts"), key, len(cuts))).drop("cuts")
    firsts = placed.groupBy("range").agg(F.min(key).alias("first"))
    order = Window.partitionBy(F.lit(0)).orderBy("range")  # a row a range
    last = F.max("range").over(Window.partitionBy(F.lit(0)))
    firsts = firsts.select("range", "first", F.coalesce(F.lag("range").over(order), last).alias("before"))
    here, there = F.struct("range", F.lit(0).alias("guest")), F.struct(F.col("before").alias("range"), F.lit(1).alias("guest"))
    spread = placed.join(F.broadcast(firsts), "range").withColumn("at", F.explode(F.when(key.eqNullSafe(F.col("first")), F.array(here, there)).otherwise(F.array(here))))
    return spread.select("doc_id", "text", "h", "at.range", "at.guest")


def with_edits(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, its edited text's and how alike they are, and how alike the next document's is."""
    order = Window.partitionBy("range").orderBy("guest", F.col("doc_id").asc_nulls_first(), "h", "text")
    rows = in_ranges(docs).withColumn("following", F.lead("text").over(order))
    rows = rows.withColumn("edited", edited(F.col("text"), F.coalesce("following", F.lit("")))).drop("following")
    rows = rows.withColumns({"print": fingerprint(F.col("text")), "edited_print": F.when(F.col("guest") == 0, fingerprint(F.col("edited")))})
    rows = rows.withColumn("own", hashes(F.col("print"))).withColumn("next", F.lead("own").over(order)).where("guest = 0")
    return rows.withColumns({"near_edited": likeness(F.col("own"), hashes(F.col("edited_print"))), "near_next": likeness(F.col("own"), F.col("next"))})


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return with_edits(documents(spark, sf_dir)).select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("print")).alias("fingerprint"), as_text(F.col("edited_print")).alias("edited_fingerprint"), "near_edited", "near_next",
    )
