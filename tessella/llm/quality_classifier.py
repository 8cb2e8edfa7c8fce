"""Quality by compression: which of two dictionaries makes a text smaller.

Zstandard dictionaries are trained on good and on bad labelled texts. A text is
compressed with each; the two sizes, each normalised by the text's bytes, and
the difference of their logarithms are the evidence. A logistic curve of second
degree in that evidence, fitted on labelled texts that no dictionary has seen,
turns it into a probability.

Only fitting sees a sample: at most ``SAMPLE`` labelled texts and ``SAMPLE_BYTES``
bytes of either class, those whose id hashes lowest; of an id with several texts
the first one in order counts. Every text is scored whole.

Defined cases: a null text is an empty one and is scored like any other; inputs
are clipped to the range met while fitting; null labels are not learned from;
if either class has fewer than ``LEAST`` texts, every score is the share of good
labels; equal rows get equal scores; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.llm.common import chunks, documents, id_text, small_batches, text_of

#: Labelled texts of a class at most, and bytes of one piece and of a dictionary.
SAMPLE, PIECE, DICTIONARY = 3000, 2000, 64 << 10
SAMPLE_BYTES = 32 << 20
LEAST = 20
#: Every third sampled text is for the curve, the others are for the dictionaries.
CURVE = 3


def _dictionary(texts: list[bytes]) -> bytes:
    pieces = [t[i : i + PIECE] for t in texts for i in range(0, len(t), PIECE)]
    while True:  # few or small pieces allow a small dictionary only
        size = DICTIONARY
        while size >= 1024:
            try:
                return zstandard.train_dictionary(size, pieces, level=3).as_bytes()
            except zstandard.ZstdError:
                size //= 2
        return b"".join(pieces)[-DICTIONARY:]


class Sizes:
    """Compressed sizes of texts under two dictionaries, as the curve's inputs."""

    def __init__(self, good: bytes, bad: bytes):
        make = lambda d: zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False)
        self.good, self.bad = make(good), make(bad)

    def inputs(self, texts: list[str]) -> np.ndarray:
        out = np.empty((len(texts), 2))
        for i, t in enumerate(texts):
            raw = t.encode("utf-8", "surrogatepass")
            n = len(raw) + 1
            good, bad = np.log(len(self.good.compress(raw)) / n), np.log(len(self.bad.compress(raw)) / n)
            out[i] = bad - good, good
        return out


@dataclass
class Model:
    good: bytes
    bad: bytes
    low: np.ndarray
    high: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def terms(self, x: np.ndarray) -> np.ndarray:
        x = np.clip(x, self.low, self.high)
        return np.column_stack([x, x * x, x[:, 0] * x[:, 1]])

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = np.column_stack([np.ones(len(x)), (self.terms(x) - self.mean) / self.scale]) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(rows: list[tuple[str, int]]) -> Model | float:
    """A model of (text, label) rows, or the share of good ones where a class is too small."""
    by_class = {k: [t for t, y in rows if y == k] for k in (0, 1)}
    if min(map(len, by_class.values())) < LEAST:
        return len(by_class[1]) / len(rows) if rows else 0.5
    dictionaries = {k: _dictionary([t.encode("utf-8", "surrogatepass") for i, t in enumerate(v) if i % CURVE]) for k, v in by_class.items()}
    curve = [(t, k) for k, v in by_class.items() for i, t in enumerate(v) if i % CURVE == 0]
    y = np.array([k for _, k in curve], float)
    x = Sizes(dictionaries[1], dictionaries[0]).inputs([t for t, _ in curve])
    model = Model(dictionaries[1], dictionaries[0], x.min(axis=0), x.max(axis=0), np.zeros(5), np.ones(5), np.zeros(6))
    terms = model.terms(x)
    model.mean, model.scale = terms.mean(axis=0), terms.std(axis=0) + 1e-9
    design = np.column_stack([np.ones(len(y)), (terms - model.mean) / model.scale])
    ridge = np.diag([0.0] + [0.05] * 5)
    loss = lambda w: np.logaddexp(0, -(2 * y - 1) * (design @ w)).sum() + w @ ridge @ w / 2
    for _ in range(60):  # Newton steps, halved until they help
        p = 1 / (1 + np.exp(-np.clip(design @ model.weights, -30, 30)))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + ridge + 1e-9 * np.eye(6), design.T @ (p - y) + ridge @ model.weights)
        size = 1.0
        while size > 1e-4 and loss(model.weights - size * step) > loss(model.weights):
            size /= 2
        model.weights = model.weights - size * step
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE) -> list[tuple[str, int]]:
    """(text, label) of the rows with the lowest id hashes, ``sample`` of a class at most."""
    usable = labels.where(learn & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("__id"), F.col("quality").cast("int").alias("__label")).distinct()
    place = F.xxhash64("__id", F.lit(5))
    chosen = [usable.where(F.col("__label") == k).orderBy(place, "__id").limit(sample) for k in (0, 1)]
    texts = docs.select(F.col("doc_id").cast("long").alias("__id"), text_of().alias("text")).join(F.broadcast(chosen[0].union(chosen[1])), "__id")
    texts = texts.groupBy("__id", "__label").agg(F.min("text").alias("text"))
    so_far = F.sum(F.octet_length("text")).over(Window.partitionBy("__label").orderBy(place, "__id"))  # of ``sample`` rows at most
    found = texts.withColumn("__bytes", so_far).where(F.col("__bytes") <= SAMPLE_BYTES).orderBy(place, "__id").select("text", "__label").collect()
    return [(r["text"], r["__label"]) for r in found]


def score(docs: DataFrame, model: Model | float) -> DataFrame:
    """doc_id and score of every row of ``docs`` (doc_id, text)."""

    def run(frames):
        sizes = None if isinstance(model, float) else Sizes(model.good, model.bad)
        for frame in chunks(frames, "text"):
            scores = model if sizes is None else model.probability(sizes.inputs(frame["text"].tolist()))
            yield pd.DataFrame({"doc_id": frame["doc_id"], "score": scores})

    small_batches(docs.sparkSession)
    return docs.select(id_text(), text_of().alias("text")).mapInPandas(run, "doc_id string, score double").withColumn("doc_id", F.col("doc_id").cast("long"))


def fold() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; labels of those with crc32(doc_id) mod 4 = 2 are held out."""
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(labelled_sample(docs, labels, fold() != 2))
    return score(docs, model).select("doc_id", (fold() == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
