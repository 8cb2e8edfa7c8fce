"""Hierarchical packing of documents into windows of several context sizes.

A document goes to the tier of the smallest window that holds it; of a longer
one, full windows of the longest tier are cut off first, and the rest goes to
its own tier. Documents are packed whole, block by block (some MB of text each):
the longest one that is left opens a window of its tier, and the gap behind it
takes shorter documents, so gaps of long windows are filled from shorter tiers:
first one or two or three that fill it exactly, else the longest that fits. Only
a gap that nothing fits is filled by the beginning of a document, whose rest goes
back to its tier. What a block has left in its last, open window joins the
others' leftovers in one stream, which is cut at the longest window; its end is
the only sequence with padding.

Step groups are balanced: the sequences of each tier are dealt to them in turn,
so that they differ by one sequence a tier at most, in tokens as in attention
work.

The ids are computed once and written to the shared folder with each document's
pieces; numbers over all blocks follow from the tasks' totals.

Defined cases: a null text is an empty one and has the end id alone; equal rows
are packed one by one; an empty table gives no pieces; other columns are not
read and may have any names.
"""

from __future__ import annotations

from bisect import bisect_right, insort

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.llm.common import chunks, documents, id_text, materialize, small_batches
from tessella.llm.tokens import default_path, encoder

#: Windows, the longest first; powers of two.
TIERS = (2048, 1024, 512, 256)
#: Tokens of a step group.
STEP_TOKENS = 2048 * 64
#: Characters of text in a block.
BLOCK = 4 << 20
#: Documents that are tried as the first of three that fill a gap.
TRIED = 12
#: Tasks up to which their totals, of a few numbers each, are broadcast.
BROADCAST_TASKS = 500_000


class Pool:
    """Fragments (document, start, length) that wait for a place, by length."""

    def __init__(self, longest: int):
        self.have = np.zeros(longest + 1, bool)
        self.by_length: list[list] = [[] for _ in range(longest + 1)]
        self.lengths: list[int] = []  # those that are there, rising

    def add(self, document: int, start: int, length: int) -> None:
        if not self.have[length]:
            self.have[length] = True
            insort(self.lengths, length)
        self.by_length[length].append((document, start))

    def take(self, length: int) -> tuple[int, int, int]:
        found = self.by_length[length].pop()
        if not self.by_length[length]:
            self.have[length] = False
            del self.lengths[bisect_right(self.lengths, length) - 1]
        return *found, length

    def longest(self, most: int) -> int:
        """The greatest length up to ``most``, or 0."""
        at = bisect_right(self.lengths, most)
        return self.lengths[at - 1] if at else 0

    def pair(self, total: int) -> int:
        """The greater length of two fragments that have ``total`` together, or 0."""
        low = np.flatnonzero(self.have[1 : total // 2 + 1] & self.have[total - 1 : total - total // 2 - 1 : -1]) + 1
        for a in low[::-1][:2].tolist():
            if 2 * a != total or len(self.by_length[a]) > 1:
                return total - a
        return 0

    def fill(self, gap: int) -> list[int]:
        """Lengths that fill the gap exactly, or the greatest that fits, or none."""
        if self.have[gap]:
            return [gap]
        if big := self.pair(gap):
            return [big, gap - big]
        at = bisect_right(self.lengths, gap)
        for first in self.lengths[max(0, at - TRIED) : at][::-1]:
            rest = gap - first
            if rest > 1 and (big := self.pair(rest)):
                if len(self.by_length[first]) >= 1 + [big, rest - big].count(first):
                    return [first, big, rest - big]
        return [self.lengths[at - 1]] if at else []


def pack_block(sizes: list[int], tiers: tuple[int, ...]) -> tuple[list[tuple[int, int, int, int, int, int]], list[int], int]:
    """Pieces (document, start, length, tier, window number in the tier, offset) of a block, and each tier's windows.

    Tier -1 is the leftover stream, whose offset is the place in it; its length comes last.
    """
    top, out, numbers = tiers[0], [], [0] * len(tiers)
    pool = Pool(top)
    for document, size in enumerate(sizes):
        for start in range(0, size - top + 1, top):
            out.append((document, start, top, 0, numbers[0], 0))
            numbers[0] += 1
        if size % top:
            pool.add(document, size - size % top, size % top)
    while pool.lengths:
        first = pool.take(pool.lengths[-1])
        tier = max(t for t, w in enumerate(tiers) if w >= first[2])
        inside, gap = [first], tiers[tier] - first[2]
        while gap and pool.lengths:
            for length in pool.fill(gap):
                inside.append(pool.take(length))
                gap -= length
            if gap and pool.lengths and pool.lengths[0] > gap:
                document, start, length = pool.take(pool.lengths[-1])  # the longest one, to which a cut matters least
                inside.append((document, start, gap))
                pool.add(document, start + gap, length - gap)
                gap = 0
        at = 0
        for document, start, length in inside:
            out.append((document, start, length, -1 if gap else tier, 0 if gap else numbers[tier], at))
            at += length
        if gap:
            return out, numbers, at
        numbers[tier] += 1
    return out, numbers, 0


def _tokenize(vocabulary: str, end_id: int, tiers: tuple[int, ...]):
    def run(frames):
        task, coder = TaskContext.get().partitionId(), encoder(vocabulary)
        numbers, left = [0] * len(tiers), 0
        for frame in chunks(frames, "text", BLOCK):
            ids, size = coder.encode_with_end(frame["text"].tolist(), end_id)
            pieces: list[list] = [[] for _ in size]
            found, more, rest = pack_block(size.tolist(), tiers)
            for document, start, length, tier, number, offset in found:
                pieces[document].append((start, length, tier, *((number + numbers[tier], offset) if tier >= 0 else (left + offset, 0))))
            left += rest
            numbers = [a + b for a, b in zip(numbers, more)]
            data, edges = ids.astype("<u4").tobytes(), [0, *(4 * np.cumsum(size)).tolist()]
            yield pd.DataFrame({
                "doc_id": frame["doc_id"], "task": task, "doc_tokens": size, "ids": [data[a:b] for a, b in zip(edges, edges[1:])],
                "pieces": [[dict(zip(("start", "length", "tier", "number", "offset"), x)) for x in p] for p in pieces],
            })

    return run


def pack(docs: DataFrame, vocabulary: str | None = None, end_id: int = 1, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row a piece: document, place in it, ids' bytes, sequence, place there, window, step."""
    tiers = tuple(sorted(tiers, reverse=True))
    if any(t & (t - 1) for t in tiers):
        raise ValueError("windows must be powers of two")
    small_batches(docs.sparkSession)
    stored = materialize(
        docs.select(id_text(), F.col("text").cast("string")).mapInPandas(
            _tokenize(vocabulary or default_path(), end_id, tiers),
            "doc_id string, task int, doc_tokens long, ids binary, pieces array<struct<start:long,length:long,tier:int,number:long,offset:long>>",
        ),
        "token-pieces",
    )
    # sequences of each tier, and tokens of leftovers, by task
    last = lambda t: F.max(F.aggregate("pieces", F.lit(0).cast("long"), lambda m, p: F.when(p["tier"] == t, F.greatest(m, p["number"] + 1)).otherwise(m)))
    left = F.sum(F.aggregate("pieces", F.lit(0).cast("long"), lambda s, p: F.when(p["tier"] == -1, s + p["length"]).otherwise(s)))
    totals = materialize(stored.groupBy("task").agg(*(last(t).alias(f"n{t}") for t in range(len(tiers))), left.alias("left"), F.sum("doc_tokens").alias("tokens")), "task-totals")
    summed = totals.agg(F.count(F.lit(1)).alias("tasks"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in totals.columns if c != "task")).first()
    sequences = [summed[f"n{t}"] for t in range(len(tiers))]
    first = [sum(sequences[:t]) for t in range(len(tiers))]  # the leftovers' sequences come last
    steps = max(1, round(summed["tokens"] / step_tokens))

    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("task", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"before_{c}") for c in totals.columns if c not in ("task", "tokens")))
    placed = stored.join(F.broadcast(offsets) if summed["tasks"] <= BROADCAST_TASKS else offsets, "task")
    pick = lambda values, t: F.element_at(F.array(*values), t + 1)
    div = lambda a, b: F.call_function("div", a, b)
    long = lambda x: F.lit(x).cast("long")
    top = long(tiers[0])

    def piece(start: Column, length: Column, sequence: Column, offset: Column, window: Column, number: Column) -> Column:
        named = {"start": start, "length": length, "sequence_id": sequence, "offset": offset, "window": window, "step_id": F.pmod(number, long(steps))}
        return F.struct(*(c.alias(n) for n, c in named.items()))

    def in_tier(p: Column) -> Column:
        n = pick([F.col(f"before_n{t}") for t in range(len(tiers))], p["tier"]) + p["number"]
        return piece(p["start"], p["length"], pick(map(long, first), p["tier"]) + n, p["offset"], pick(map(F.lit, tiers), p["tier"]), n)

    def in_stream(p: Column) -> Column:
        at = F.col("before_left") + p["number"]

        def cut(s: Column) -> Column:
            begin, end = F.greatest(s * top, at), F.least((s + 1) * top, at + p["length"])
            return piece(p["start"] + begin - at, end - begin, long(sum(sequences)) + s, begin - s * top, F.lit(tiers[0]), long(sequences[0]) + s)

        return F.transform(F.sequence(div(at, top), div(at + p["length"] - 1, top)), cut)

    every = F.flatten(F.transform("pieces", lambda p: F.when(p["tier"] >= 0, F.array(in_tier(p))).otherwise(in_stream(p))))
    ids = F.substring(F.col("ids"), (F.col("p.start") * 4 + 1).cast("int"), (F.col("p.length") * 4).cast("int")).alias("ids")
    return placed.select(F.col("doc_id").cast("long"), "doc_tokens", "ids", F.explode(every).alias("p")).select(
        "doc_id", "p.start", "p.length", "doc_tokens", "p.sequence_id", "p.offset", "p.window", "p.step_id", ids,
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens, as one digest a piece."""
    return digest(pack(documents(spark, sf_dir)))


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "window", "step_id",
    )
