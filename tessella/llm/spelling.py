"""Spelling variants by Bloom-guided neighbourhoods.

Words are counted; each word generates the words that one deletion or one replaced
code point would make of it, as 64-bit hashes that follow from its own by
arithmetic. A hash is probed in the blocked Bloom filter of the words of its
length; filters are sharded by length, and all that is broadcast at a time has a
fixed size: more shards, or slices of a large one, only make more passes. What a
filter lets through is shuffled, as pairs of hashes, to a join with the vocabulary,
and the words themselves decide (edit distance of 1), so filters and hashes never
make or lose a pair. Insertions are deletions seen from the other side, and a
replacement is generated from the word with the smaller code point.

A word's form is its most frequent near word if that is ``RATIO`` times as
frequent. Forms grow tenfold with each step, so chains have 19 steps at most; they
are followed by doubling.

Defined cases: a null text has no words; a null id is an empty text in the hash
that damages runs; ids and texts may repeat; words without near words have
n_near 0 and no form; an empty table gives an empty result; other columns don't
matter; runs may have any length.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.common import chunks, documents, id_text, materialize, mix, small_batches

LEAST_LETTERS, LEAST_COUNT, DAMAGE, RATIO = 7, 2, 31, 10
#: Distinct words that a counting task holds before it hands them on.
HELD = 200_000
#: Lengths from here on share a shard.
LONG = 48
#: Bits of a filter for a word, bits of a block, bits set for a word.
BITS_EACH, BLOCK, SET = 16, 512, 5
#: Bits of all filters that one pass broadcasts: 16 MB.
PASS_BITS = 1 << 27
#: Hashes of generated edits that a task holds at a time.
CELLS = 1 << 19

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def lowered(run: str) -> str:
    """A-Z alone in lower case."""
    return run.lower() if run.isascii() else run.translate(_ASCII_LOWER)


def damaged(doc_id: str, run: str) -> str:
    """The run without one code point, for about one of 31 pairs of a document and a run."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % DAMAGE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _count(frames):
    runs, held = re.compile(f"[A-Za-zÀ-ÿ]{{{LEAST_LETTERS},}}"), Counter()
    out = lambda: pd.DataFrame({"word": list(held), "n": list(held.values())})
    for frame in chunks(frames, "text"):
        ids = frame["doc_id"].fillna("")
        for doc, text in zip(ids, frame["text"]):
            own = Counter()
            for run, n in Counter(runs.findall(text)).items():
                own[lowered(run)] += n
            for run, n in own.items():
                word = damaged(doc, run)
                if len(word) >= LEAST_LETTERS:
                    held[word] += n
        if len(held) >= HELD:
            yield out()
            held = Counter()
    if held:
        yield out()


def _codes(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length).astype(np.uint64)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _sums(codes: np.ndarray) -> np.ndarray:
    """Before mixing: the sum of code points times powers, the length in the top of the first term."""
    return (codes * _powers(codes.shape[1])).sum(axis=1, dtype=np.uint64)


def _finish(sums: np.ndarray, length: int) -> np.ndarray:
    return mix(sums + np.uint64(length * 0xD6E8FEB86659FD93 % 2**64))


def word_keys(words: list[str]) -> np.ndarray:
    """64-bit keys of words of any lengths."""
    out, lengths = np.empty(len(words), np.uint64), np.array([len(w) for w in words], np.int64)
    with np.errstate(over="ignore"):
        for n in np.unique(lengths):
            at = np.flatnonzero(lengths == n)
            out[at] = _finish(_sums(_codes([words[i] for i in at], int(n))), int(n))
    return out


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n, key, length) of all words of at least two occurrences, written to the shared folder."""
    small_batches(docs.sparkSession)
    counted = docs.select(id_text(), "text").mapInPandas(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)

    def keyed(frames):
        for frame in frames:
            if not len(frame):
                continue
            words = frame["word"].tolist()
            yield pd.DataFrame({"word": words, "n": frame["n"].to_numpy(), "key": word_keys(words).view(np.int64)})

    return materialize(counted.mapInPandas(keyed, "word string, n long, key long").withColumn("length", F.least(F.char_length("word"), F.lit(LONG))), "words")


# --- filters ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Shard:
    """Words of a length, or a slice of them, in blocks from ``first`` on of a pass's bits."""

    length: int
    slice: int
    slices: int
    first: int
    blocks: int


def plan_passes(sizes: dict[int, int], most_bits: int = PASS_BITS) -> list[list[Shard]]:
    """Shards of every length, filled into passes of at most ``most_bits``."""
    passes: list[list[Shard]] = [[]]
    for length in sorted(sizes):
        bits = sizes[length] * BITS_EACH
        slices = -(-bits // most_bits)
        blocks = -(-bits // (slices * BLOCK))
        for s in range(slices):
            first = sum(x.blocks for x in passes[-1])
            if passes[-1] and ((first + blocks) * BLOCK > most_bits or passes[-1][-1].length == length):
                passes.append([])
                first = 0
            passes[-1].append(Shard(length, s, slices, first, blocks))
    return passes if passes[0] else []


def _places(keys: np.ndarray, shard: Shard, k: int, block: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The word of 64 bits and the bit that belong to the k-th hash of each key."""
    block = np.uint64(shard.first) + (mix(keys) >> np.uint64(32)) * np.uint64(shard.blocks) // np.uint64(1 << 32) if block is None else block
    spot = (keys >> np.uint64(9 * k)) & np.uint64(BLOCK - 1)
    return (block * np.uint64(BLOCK // 64) + (spot >> np.uint64(6))).astype(np.int64), spot & np.uint64(63)


def _in_slice(keys: np.ndarray, shard: Shard) -> np.ndarray:
    return (keys >> np.uint64(48)) % np.uint64(shard.slices) == shard.slice


def _filter(words: DataFrame, shards: list[Shard]) -> np.ndarray:
    """The bits of one pass; at most PASS_BITS / 64 numbers reach the driver."""
    of = {s.length: s for s in shards}

    def set_bits(frames):
        for frame in frames:
            slots, bits = [], []
            for length, part in frame.groupby("length"):
                keys = part["key"].to_numpy(np.int64).view(np.uint64)
                keys = keys[_in_slice(keys, of[length])]
                for k in range(SET):
                    slot, bit = _places(keys, of[length], k)
                    slots.append(slot)
                    bits.append(np.uint64(1) << bit)
            slot, bit = np.concatenate(slots), np.concatenate(bits)
            order = np.argsort(slot, kind="stable")
            slot, bit = slot[order], bit[order]
            first = np.flatnonzero(np.diff(slot, prepend=-1))
            if len(first):
                yield pd.DataFrame({"slot": slot[first], "bits": np.bitwise_or.reduceat(bit, first).view(np.int64)})

    rows = words.where(F.col("length").isin(list(of))).select("length", "key").mapInPandas(set_bits, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros((shards[-1].first + shards[-1].blocks) * (BLOCK // 64), np.uint64)
    out[rows["slot"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


def _passing(bits: np.ndarray, keys: np.ndarray, shard: Shard) -> np.ndarray:
    """Numbers of the keys that the filter lets through; a bit that is missing ends a key's probing."""
    at = np.arange(len(keys)) if shard.slices == 1 else np.flatnonzero(_in_slice(keys, shard))
    left = keys[at]
    block = np.uint64(shard.first) + (mix(left) >> np.uint64(32)) * np.uint64(shard.blocks) // np.uint64(1 << 32)
    for k in range(SET):
        slot, bit = _places(left, shard, k, block)
        hit = (bits[slot] >> bit) & np.uint64(1) != 0
        at, left, block = at[hit], left[hit], block[hit]
    return at


def _probe(bits_of, shards: list[Shard], alphabet: np.ndarray):
    """Pairs of keys (word, generated edit) that the filters let through."""
    of = {s.length: s for s in shards}

    def edits(codes: np.ndarray, length: int):
        """Row numbers and keys of all edits that may be words of this pass."""
        power, sums = _powers(length), _sums(codes)
        shorter, same = of.get(min(length - 1, LONG)), of.get(min(length, LONG))
        terms = codes * power
        if shorter:
            tail = np.zeros((len(codes), length), np.uint64)
            tail[:, :-1] = np.cumsum(terms[:, :0:-1], axis=1, dtype=np.uint64)[:, ::-1]  # of all that follows
            head = sums[:, None] - tail - terms
            # of equal neighbours only the first is deleted
            rows, at = np.nonzero(np.column_stack([np.ones(len(codes), bool), codes[:, 1:] != codes[:, :-1]]))
            yield shorter, rows, _finish(head[rows, at] + tail[rows, at] * _INVERSE, length - 1)
        if same:
            step = max(1, CELLS // (len(codes) * len(alphabet)))
            for p in range(0, length, step):
                old = codes[:, p : p + step, None]
                rows, at, letter = np.nonzero(alphabet[None, None, :] > old)
                new = (alphabet[letter] - old[rows, at, 0]) * power[p + at]
                yield same, rows, _finish(sums[rows] + new, length)

    def run(frames):
        bits = bits_of.value
        for frame in frames:
            with np.errstate(over="ignore"):
                words, own = frame["word"].to_numpy(object), frame["key"].to_numpy(np.int64)
                lengths = np.fromiter(map(len, words), np.int64, len(words))
                for length in np.unique(lengths):
                    at = np.flatnonzero(lengths == length)
                    many = max(1, CELLS // int(length * len(alphabet)))
                    for i in range(0, len(at), many):
                        part = at[i : i + many]
                        for shard, rows, keys in edits(_codes(words[part].tolist(), int(length)), int(length)):
                            found = _passing(bits, keys, shard)
                            if len(found):
                                yield pd.DataFrame({"key": own[part][rows[found]], "other": keys[found].view(np.int64)})

    return run


def near_pairs(words: DataFrame, most_bits: int = PASS_BITS) -> DataFrame:
    """(word, n, other, other_n), both ways, of all words that differ by one edit."""
    spark = words.sparkSession
    sizes = {r["length"]: r["count"] for r in words.groupBy("length").count().collect()}  # LONG rows at most
    letters = sorted(ord(r[0]) for r in words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").distinct().collect())  # 90 at most
    alphabet, found = np.array(letters, np.uint64), None
    dealt = words.select("word", "key").repartition("key")
    for shards in plan_passes(sizes, most_bits):
        bits = spark.sparkContext.broadcast(_filter(words, shards))
        new = materialize(dealt.mapInPandas(_probe(bits, shards, alphabet), "key long, other long"), "spelling-candidates")
        bits.unpersist()
        found = new if found is None else found.unionByName(new)
    if found is None:
        return words.select("word", "n", F.col("word").alias("other"), F.col("n").alias("other_n")).limit(0)
    there = words.select(F.col("key").alias("other"), F.col("word").alias("w2"), F.col("n").alias("n2"))
    pairs = found.join(there, "other").join(words.select("key", "word", "n"), "key").where(F.levenshtein("word", "w2", 1) == 1)
    ways = F.array(F.struct("word", "n", F.col("w2").alias("other"), F.col("n2").alias("other_n")), F.struct(F.col("w2").alias("word"), F.col("n2").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    return pairs.select(F.inline(ways))


def variants(docs: DataFrame, most_bits: int = PASS_BITS) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of all words."""
    words = count_words(docs)
    best = near_pairs(words, most_bits).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other").alias("other"))).alias("best"))
    formed = words.select("word", "n").join(best, "word", "left").withColumn("form_n", -F.col("best.m"))
    has = F.col("form_n") >= RATIO * F.col("n")
    formed = formed.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best.other")).alias("form"), F.when(has, F.col("form_n")).alias("form_n"))
    formed = materialize(formed, "forms")
    links = formed.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(5):  # 2**5 steps are more than the 19 that counts allow
        on = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = materialize(links.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        moved = links.where("moved").limit(1).count()
        links = links.drop("moved")
        if not moved:
            break
    return formed.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of the documents with their forms and roots."""
    return variants(documents(spark, sf_dir)).select("word", "form", "root", "n", "n_near", "form_n")


#: crc32 of a byte list: 256 remainders of the usual polynomial, found by eight steps each, then a step a byte.
CRC_TABLE = """crc AS MATERIALIZED (SELECT list(r ORDER BY b) AS t FROM (SELECT b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS r FROM range(256) s(b)))"""


def crc_of(value: str) -> str:
    """DuckDB SQL for the unsigned crc32 of a text's UTF-8 bytes; needs the table ``crc`` in scope."""
    pairs = f"list_transform(range(0, octet_length(encode({value}))), lambda i: CAST('0x' || substr(hex(encode({value})), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {pairs}), lambda a, b: xor(a >> 8, crc.t[(xor(a, b) & 255) + 1])), 4294967295)"


OP12_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY id, run),
hashed AS (SELECT id, run, n, {crc_of("id || ':' || run")} AS h FROM counted, crc),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed) WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cuts AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
holes AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM cuts),
pairs AS (
  SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM holes a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM holes a JOIN words b ON a.rest = b.word),
best AS (SELECT word, n, other, other_n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS r FROM pairs),
forms AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.other_n >= 10 * w.n THEN b.other END AS form, CASE WHEN b.other_n >= 10 * w.n THEN b.other_n END AS form_n FROM words w LEFT JOIN (SELECT * FROM best WHERE r = 1) b ON w.word = b.word),
walk AS (SELECT word, word AS at FROM forms UNION ALL SELECT k.word, f.form FROM walk k JOIN forms f ON f.word = k.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, k.at AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n FROM forms f JOIN walk k ON k.word = f.word JOIN forms e ON e.word = k.at WHERE e.form IS NULL
"""
