"""Benchmark decontamination by winnowing.

Texts are fingerprinted by the smallest hash of ``GRAM`` words in every ``WINNOW``
neighbouring ones, so any span of GRAM + WINNOW - 1 = ``SPAN`` words that two texts
share puts a common fingerprint into both. A document's fingerprints go through
a Bloom filter of the benchmark's (fixed size); at each that passes, the SPAN-word
windows around it are the candidate hits. These windows are joined with the
benchmark's windows, which extends a hit to all windows of a shared passage,
and their places are merged. Items of fewer words are windows of their own
length, and are looked for at each length that the benchmark has.

Defined cases: a null or empty text has no words, no hits and no items; null ids
are ids like others; equal rows get equal results; an item whose id is null is
not counted; an empty benchmark hits nothing; very long texts are read whole;
other columns are kept by ``drop_contaminated``, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import bloom
from tessella.llm.common import chunks, documents, id_text, materialize, small_batches, window_hashes, word_hashes

SPAN, GRAM = 10, 5
WINNOW = SPAN - GRAM + 1
#: Copies of each benchmark window in the join; a document's hits spread over them, so a
#: passage that very many documents share is no single key.
SALTS = 32


def winnow(grams: np.ndarray, counts: np.ndarray, window: int) -> np.ndarray:
    """Places (in ``grams``) of the last smallest gram in each window of each text."""
    if len(grams) < window:
        return np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(counts)), counts)
    starts = np.flatnonzero(owner[window - 1 :] == owner[: len(owner) - window + 1])
    best = starts
    for j in range(1, window):
        other = starts + j
        best = np.where(grams[other] <= grams[best], other, best)
    # texts with fewer grams than a window have none of SPAN words
    return np.unique(best)


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, length, window hash, fingerprint): windows of SPAN words, or of the item's own length.

    The fingerprint, for the filter, is a winnowed gram or a short item's window.
    """

    def run(frames):
        for frame in chunks(frames, "text"):
            words, counts = word_hashes(frame["text"].tolist(), alnum=True)
            ids = frame["item_id"].to_numpy()
            grams, n_grams = window_hashes(words, counts, GRAM)
            prints = grams[winnow(grams, n_grams, WINNOW)]
            yield pd.DataFrame({"item_id": None, "size": 0, "window": prints.view(np.int64)})
            for size in np.unique(np.minimum(counts[counts > 0], SPAN)):
                at = np.flatnonzero(np.minimum(counts, SPAN) == size)
                keep = np.repeat(np.minimum(counts, SPAN) == size, counts)
                found, n = window_hashes(words[keep], counts[at], int(size))
                yield pd.DataFrame({"item_id": np.repeat(ids[at], n), "size": int(size), "window": found.view(np.int64)})

    return benchmark.select(id_text("item_id"), F.col("text").cast("string")).mapInPandas(run, "item_id string, size int, window long").distinct()


def _candidates(prints: np.ndarray, short: list[int], short_filter: np.ndarray):
    """Each document's word count and the windows, by length and start, that may be the benchmark's."""

    def run(frames):
        for frame in chunks(frames, "text"):
            words, counts = word_hashes(frame["text"].tolist(), alnum=True)
            found = [[] for _ in counts]
            grams, n_grams = window_hashes(words, counts, GRAM)
            at = winnow(grams, n_grams, WINNOW)
            at = at[bloom.may_have(prints, grams[at])]
            if len(at):
                gram_first = np.cumsum(n_grams) - n_grams
                gram_owner = np.repeat(np.arange(len(counts)), n_grams)[at]
                local = at - gram_first[gram_owner]
                whole, n_whole = window_hashes(words, counts, SPAN)
                whole_first = np.cumsum(n_whole) - n_whole
                begin = np.unique((whole_first[gram_owner][:, None] + np.clip(local[:, None] - np.arange(WINNOW), 0, np.maximum(n_whole[gram_owner] - 1, 0)[:, None]))[n_whole[gram_owner] > 0])
                whole_owner = np.repeat(np.arange(len(counts)), n_whole)
                for i in begin:
                    o = whole_owner[i]
                    found[o].append((SPAN, int(i - whole_first[o]), int(whole[i].view(np.int64))))
            for size in short:
                windows, n = window_hashes(words, counts, size)
                hit = np.flatnonzero(bloom.may_have(short_filter, windows))
                if len(hit):
                    begin = np.cumsum(n) - n
                    window_owner = np.repeat(np.arange(len(counts)), n)
                    for i in hit:
                        o = window_owner[i]
                        found[o].append((size, int(i - begin[o]), int(windows[i].view(np.int64))))
            yield pd.DataFrame({
                "doc_id": frame["doc_id"], "text_hash": frame["text_hash"], "n_words": counts,
                "found": [[{"size": a, "start": b, "window": c} for a, b, c in x] for x in found],
            })

    return run


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row a distinct (doc_id, text): n_words, hit words, items; rows of docs join on the first two."""
    small_batches(docs.sparkSession)
    windows = materialize(item_windows(benchmark), "benchmark-windows")
    short = [r["size"] for r in windows.where(f"size between 1 and {SPAN - 1}").select("size").distinct().collect()]
    prints = bloom.build(windows.where("size = 0"), "window")
    short_filter = bloom.build(windows.where(f"size between 1 and {SPAN - 1}"), "window") if short else prints
    scanned = materialize(
        docs.select(id_text(), F.col("text").cast("string"), text_hash(F.col("text"))).mapInPandas(
            _candidates(prints, sorted(short), short_filter),
            "doc_id string, text_hash long, n_words long, found array<struct<size:int,start:int,window:long>>",
        ).withColumn("doc_id", F.col("doc_id").cast("long")),
        "candidate-windows",
    )
    salted = windows.where("size > 0 and item_id is not null").select("item_id", "size", "window", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    rows = (
        scanned.where(F.size("found") > 0)
        .select("doc_id", "text_hash", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(SALTS)).cast("int").alias("salt"), F.explode("found").alias("f"))
        .select("doc_id", "text_hash", "salt", "f.size", "f.start", "f.window")
        .distinct()
    )
    joined = rows.join(salted, ["size", "window", "salt"])
    places = F.sort_array(F.collect_set(F.struct("start", "size")))
    by_doc = joined.groupBy("doc_id", "text_hash").agg(places.alias("places"), F.array_sort(F.collect_set("item_id")).alias("items"))
    by_doc = by_doc.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"), "places", "items")
    base = scanned.select("doc_id", "text_hash", "n_words")
    return base.join(by_doc, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("text_hash") == F.col("__hash")), "left").select(
        "doc_id", "text_hash", "n_words",
        F.when(F.col("places").isNull(), F.lit(0)).otherwise(covered(F.col("places"))).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit(""))).alias("text_hash")


def covered(places: Column) -> Column:
    """Words inside spans (start, size), sorted by start."""
    step = lambda acc, s: F.struct(
        F.greatest(acc["until"], s["start"] + s["size"]).alias("until"),
        (acc["n"] + F.greatest(F.lit(0), s["start"] + s["size"] - F.greatest(acc["until"], s["start"]))).alias("n"),
    )
    return F.aggregate(places, F.struct(F.lit(0).alias("until"), F.lit(0).alias("n")), step, lambda acc: acc["n"])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a hit, with all their columns."""
    bad = hits(docs, benchmark).where("n_hit > 0").select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash")).distinct()
    clean = docs.join(bad, F.col("doc_id").cast("long").eqNullSafe(F.col("__doc")) & (text_hash(docs["text"]) == F.col("__hash")), "left_anti")
    return clean.select(*(F.col(f"`{c}`") for c in docs.columns))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that benchmark items share, and the items."""
    found = hits(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


OP7_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id,
    regexp_extract_all(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(ws), 10) AS k, array_to_string(ws[i : i + least(len(ws), 10) - 1], ' ') AS g
  FROM (SELECT item_id, ws, unnest(generate_series(1, len(ws) - least(len(ws), 10) + 1)) AS i FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT r, k, i, array_to_string(ws[i : i + k - 1], ' ') AS g
  FROM (SELECT r, k, ws, unnest(generate_series(1, len(ws) - k + 1)) AS i FROM d, sizes WHERE len(ws) >= k)),
hit AS (SELECT r, i, k, item_id FROM dw JOIN bw USING (k, g)),
words AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(generate_series(i, i + k - 1)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS s FROM hit) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
  sha256(coalesce(items.ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""
