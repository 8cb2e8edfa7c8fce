"""Deleted interpolation: an n-gram language model over the whole corpus.

A word's probability after the two words before it is
    a * c(g, h, w) / c(g, h) + b * c(h, w) / c(h) + c * c(w) / N + d / (V + 1)
with weights (a, b, c, d) that depend on how often the context was seen: contexts
are bucketed by the binary logarithm of the frequency of (g, h), or of h where
that pair is new, and each bucket's weights are learned by
expectation-maximisation on held-out counts, that is, on training documents
whose own counts are deleted from the estimates first.

Counting and look-up are two exchanges. Documents are dealt into parts of a few
MB. A part sends each of its distinct n-grams once, with its count, to the
n-gram's bucket; the bucket adds up and answers every part with the corpus
counts, in the order in which the part asked, so answers need no keys. Parts
then score their documents. N-grams travel as blocks of 64-bit hashes, one block
for a part and bucket; both numbers grow with the corpus, so a task holds about
the same amount at any size. Blocks grow with the square of the corpus up to
some hundred GB; as no block is empty, there are never more of them than parts
have distinct n-grams, so beyond that size they grow in proportion and an n-gram
costs about a row of its own, as in a plain count by key. Words have 64-bit hashes: the chance that any
two of V words share one is V * V / 2**65, 3e-8 for a million and 3e-4 for a
hundred million. Pairs and triples have 48 bits, which only the mixture sees:
of 10**9 distinct ones, 4 in a million meet another one's count.

Rows equal in id and text that would fill a part by themselves are counted
before they are dealt: one of them stands for all in its part, with their number
as its weight, and its score is written out in blocks that are dealt to all
tasks. So no number of repeated rows makes a large part.

Defined cases: a null or empty text is its end mark alone; a null doc_id counts
as the empty text where ids are hashed; equal rows get equal scores, one for each
row; an empty table gives an empty result; without training or held-out text the
weights fall back to equal ones; other columns are not read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.common import chunks, documents, id_text, materialize, mix, small_batches, text_of, word_hashes

#: Bytes of text in a part, and what a row counts in addition.
PART_BYTES = 8 << 20
ROW_BYTES = 64
#: Equal rows that are written out at a time.
COPIES = 100_000
END, START = np.uint64(0x3C79AC492BA7B653), np.uint64(0x1C69B3F74AC4AE35)
#: Context buckets: HALF for new pairs, by the word's frequency (0, then one a power of two), and as many for known ones.
HALF = 32
CONTEXTS = 2 * HALF
#: Halves of a binary logarithm by which probabilities of triples, pairs and words are told apart while weights are
#: learned: so many of each, and one that stands for zero. At most CONTEXTS * 33 * 41 * 49 cells reach the driver.
STEPS, FINE = 2, (32, 40, 48)
#: Bits of the hashes of words, pairs and triples.
BITS = {1: 64, 2: 48, 3: 48}
ROUNDS = 40


def _sequences(texts: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words with an end mark a text, their contexts, words and end mark of each text)."""
    hashes, counts = [], []
    for frame in chunks([texts.to_frame("text")], "text"):
        h, n = word_hashes(frame["text"].tolist())
        hashes.append(h)
        counts.append(n)
    words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    ends = np.cumsum(n)
    return np.insert(words, ends, END), np.insert(words, ends - n, START), n + 1


@dataclass
class Grams:
    """Distinct words, pairs and triples of a part, sorted, and where each token's are."""

    keys: dict[int, np.ndarray]  # by length
    at: dict[int, np.ndarray]
    before: np.ndarray  # of each token: place of the word before it; texts begin as often as they end
    pair_before: np.ndarray  # place of the pair before it, or -1 at a text's start
    lengths: np.ndarray

    @classmethod
    def of(cls, texts: pd.Series) -> Grams:
        tokens, before, lengths = _sequences(texts)
        keys, at = {}, {}
        keys[1], at[1] = np.unique(tokens, return_inverse=True)
        with np.errstate(over="ignore"):
            pair = mix(before * np.uint64(0x9E3779B97F4A7C15) + mix(tokens))
            first = np.cumsum(lengths) - lengths
            earlier = np.append(START, before[:-1])
            earlier[first] = START
            triple = mix(earlier * np.uint64(0xD1B54A32D192ED03) + pair)
        for k, x in ((2, pair), (3, triple)):
            keys[k], at[k] = np.unique(x >> np.uint64(64 - BITS[k]), return_inverse=True)
        pair_before = np.append(-1, at[2][:-1])
        pair_before[first] = -1
        word_before = np.append(0, at[1][:-1])
        word_before[first] = np.searchsorted(keys[1], END)
        return cls(keys, at, word_before, pair_before, lengths)

    def estimates(self, counts: dict[int, np.ndarray], tokens: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each token: the context's bucket, and the probabilities by triple, pair and word."""
        word, texts = counts[1][self.before], counts[1][np.searchsorted(self.keys[1], END)] if len(self.lengths) else 0
        pair = np.where(self.pair_before < 0, texts, counts[2][self.pair_before])
        share = lambda c, n: np.where(n > 0, c / np.maximum(n, 1), 0.0)
        p = np.stack([share(counts[3][self.at[3]], pair), share(counts[2][self.at[2]], word), counts[1][self.at[1]] / max(tokens, 1)], axis=1)
        log = lambda n: np.floor(np.log2(np.maximum(n, 1)))
        new = np.minimum(np.where(word > 0, 1 + log(word), 0), HALF - 1)
        return np.where(pair > 0, HALF + np.minimum(log(pair), HALF - 1), new).astype(np.int64), p


def _bucket_edges(keys: np.ndarray, bits: int, of: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that sorted keys of ``of`` bits fall into, and where each begins and ends."""
    bucket = (keys >> np.uint64(of - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    found, first = np.unique(bucket, return_index=True)
    return found, np.append(first, len(keys))


def _pack_keys(keys: np.ndarray) -> bytes:
    """Rising keys: the first one, and the steps between them in four bytes where they fit, else in eight."""
    steps = np.diff(keys)
    kind = "<u4" if not len(steps) or steps.max() < 2**32 else "<u8"
    return keys[:1].astype("<u8").tobytes() + kind[-1].encode() + steps.astype(kind).tobytes()


def _unpack_keys(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, f"<u{data[8:9].decode()}", offset=9).astype(np.uint64)
    with np.errstate(over="ignore"):
        return np.cumsum(np.append(np.frombuffer(data, "<u8", 1), steps), dtype=np.uint64)


def _pack(numbers: np.ndarray) -> bytes:
    return zlib.compress(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1).T).view("<u8").reshape(-1).astype(np.int64)


def _ask(bits: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        grams, train = Grams.of(frame["text"]), frame["train"].to_numpy(bool)
        weight = np.repeat(np.where(train, frame["copies"].to_numpy(), 0), grams.lengths)
        rows = []
        for kind, keys in grams.keys.items():
            counts = np.bincount(grams.at[kind], weight, len(keys)).astype(np.int64)
            found, edges = _bucket_edges(keys, bits, BITS[kind])
            for b, i, j in zip(found, edges, edges[1:]):
                rows.append((int(b), int(frame["part"].iat[0]), kind, _pack_keys(keys[i:j]), _pack(counts[i:j])))
        return pd.DataFrame(rows, columns=["bucket", "part", "kind", "keys", "counts"])

    return run


def _answer(first_held_out: int):
    """Corpus counts and held-out counts for every block; part -1 carries the bucket's totals."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        rows, totals = [], np.zeros(4, np.int64)
        for kind, blocks in frame.groupby("kind"):
            keys = [_unpack_keys(x) for x in blocks["keys"]]
            counts = [_unpack(x) for x in blocks["counts"]]
            held = np.repeat(blocks["part"].to_numpy() >= first_held_out, [len(k) for k in keys])
            distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
            every = np.concatenate(counts)
            total = np.bincount(at, every, len(distinct)).astype(np.int64)
            out = np.bincount(at, np.where(held, every, 0), len(distinct)).astype(np.int64)
            if kind == 1:
                totals = np.array([(total > 0).sum(), total.sum(), (total > out).sum(), out.sum()])
            ends = np.cumsum([len(k) for k in keys])
            for part, a, b in zip(blocks["part"], ends - [len(k) for k in keys], ends):
                deleted = _pack(out[at[a:b]]) if part >= first_held_out else None
                rows.append((int(part), int(frame["bucket"].iat[0]), int(kind), _pack(total[at[a:b]]), deleted))
        rows.append((-1, int(frame["bucket"].iat[0]), 0, totals.astype("<i8").tobytes(), None))
        return pd.DataFrame(rows, columns=["part", "bucket", "kind", "counts", "deleted"])

    return run


def _corpus_counts(answers: pd.DataFrame, column: str = "counts") -> dict[int, np.ndarray]:
    """Counts of a part's words, pairs and triples, in its order."""
    answers = answers.sort_values("bucket")
    return {k: np.concatenate([_unpack(x) for x in answers.loc[answers["kind"] == k, column]]) for k in BITS}


def _cells(bucket: np.ndarray, p: np.ndarray) -> np.ndarray:
    """One number for the bucket and the three probabilities' steps."""
    cell = bucket
    for k, fine in enumerate(FINE):
        with np.errstate(divide="ignore"):
            step = np.where(p[:, k] > 0, np.minimum(np.round(-np.log2(p[:, k]) * STEPS), fine - 1), fine)
        cell = cell * (fine + 1) + step.astype(np.int64)
    return cell


def _held_out(kept_tokens: int):
    """How often held-out tokens have which context bucket and probabilities."""

    def run(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return pd.DataFrame({"cell": [], "n": []})
        grams, every, own = Grams.of(docs["text"]), _corpus_counts(answers), _corpus_counts(answers, "deleted")
        cells = _cells(*grams.estimates({k: every[k] - own[k] for k in every}, kept_tokens))
        found, at = np.unique(cells, return_inverse=True)
        n = np.bincount(at, np.repeat(docs["copies"].to_numpy(), grams.lengths), len(found))
        return pd.DataFrame({"cell": found, "n": n.astype(np.int64)})

    return run


def learn_weights(cells: np.ndarray, n: np.ndarray, types: int) -> np.ndarray:
    """Weights (triple, pair, word, uniform) of each context bucket by expectation-maximisation."""
    p, rest = np.full((len(cells), 4), 1 / (types + 1)), cells
    for k in (2, 1, 0):
        step, rest = rest % (FINE[k] + 1), rest // (FINE[k] + 1)
        p[:, k] = np.where(step == FINE[k], 0, 2.0 ** (-step / STEPS))
    bucket = rest
    weights = np.full((CONTEXTS, 4), 1 / 4)
    seen = np.bincount(bucket, n, CONTEXTS) > 0
    for _ in range(ROUNDS):
        share = weights[bucket] * p
        share *= (n / share.sum(axis=1))[:, None]
        mass = np.stack([np.bincount(bucket, share[:, k], CONTEXTS) for k in range(4)], axis=1)
        mass = mass + 1e-3  # no weight becomes nothing
        weights[seen] = (mass / mass.sum(axis=1, keepdims=True))[seen]
    # buckets that held-out text never met take their lower neighbour's weights
    for k in range(1, CONTEXTS):
        if not seen[k] and k != HALF:
            weights[k] = weights[k - 1]
    # a new pair has no triples, and a new word no pairs either
    weights[:HALF, 0] = 0
    weights[0, 1] = 0
    return weights / weights.sum(axis=1, keepdims=True)


def _score(weights: np.ndarray, types: int, tokens: int):
    def run(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        columns = ["doc_id", "copies", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        if not len(docs):
            return pd.DataFrame(columns=columns)
        grams = Grams.of(docs["text"])
        counts = _corpus_counts(answers)
        words = counts[1]
        bucket, p = grams.estimates(counts, tokens)
        p = (weights[bucket, :3] * p).sum(axis=1) + weights[bucket, 3] / (types + 1)
        first = np.cumsum(grams.lengths) - grams.lengths
        add = lambda x: np.add.reduceat(x, first)
        return pd.DataFrame({
            "doc_id": docs["doc_id"], "copies": docs["copies"], "held_out": ~docs["train"].to_numpy(bool), "n_tokens": grams.lengths,
            "n_known": add((words > 0)[grams.at[1]].astype(np.int64)), "train_tokens": tokens,
            "base_score": add(np.log10((words + 1) / (tokens + types + 1))[grams.at[1]]), "score": add(np.log10(p)),
        })

    return run


def fold_copies(rows: DataFrame) -> tuple[DataFrame, bool]:
    """``rows`` with a column ``copies``, and whether any row stands for several.

    Only rows whose copies would fill a part are folded, so texts are shuffled
    for none of the others; where there are no such rows nothing else is done.
    """
    key = F.xxhash64("doc_id", "text")
    many = rows.groupBy(key.alias("key")).agg(F.sum(F.octet_length("text") + ROW_BYTES).alias("size"), F.count(F.lit(1)).alias("n"))
    many = materialize(many.where((F.col("n") > 1) & (F.col("size") > PART_BYTES)).select("key"), "repeated-keys")
    if many.isEmpty():
        return rows.withColumn("copies", F.lit(1).cast("long")), False
    keyed = rows.withColumn("key", key)
    folded = keyed.join(many, "key", "left_semi").groupBy("key", *rows.columns).agg(F.count(F.lit(1)).alias("copies"))
    folded = materialize(folded, "repeated-rows")
    return keyed.join(many, "key", "left_anti").withColumn("copies", F.lit(1).cast("long")).unionByName(folded).drop("key"), True


def unfold_copies(scored: DataFrame) -> DataFrame:
    """Each row as often as its ``copies`` say, block by block."""
    step = F.lit(COPIES).cast("long")
    blocks = F.sequence(F.lit(0).cast("long"), F.call_function("div", F.col("copies") - 1, step))
    dealt = scored.withColumn("block", F.explode(blocks)).repartition(F.xxhash64("doc_id", "score", "block"))
    in_block = F.sequence(F.lit(1).cast("long"), F.least(step, F.col("copies") - F.col("block") * step))
    return dealt.withColumn("copy", F.explode(in_block)).drop("block", "copy")


def score_documents(docs: DataFrame, train: Column, held_out: Column) -> DataFrame:
    """Score all ``docs`` (doc_id, text) by a model of those for which ``train`` holds.

    ``held_out``: the training documents whose counts are deleted while weights are learned.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"), train.alias("train"), (train & held_out).alias("held"))
    rows, repeated = fold_copies(rows)
    size = rows.groupBy("held").agg(F.sum(F.octet_length("text") + ROW_BYTES).alias("b")).collect()
    n_parts = {r["held"]: max(1, -(-(r["b"] or 0) // PART_BYTES)) for r in size}
    plain, held = n_parts.get(False, 1), n_parts.get(True, 1)
    bits = max(0, int(plain + held - 1).bit_length())
    dealt = F.xxhash64("doc_id", "text")  # of content alone: every pass deals alike
    parts = rows.withColumn("doc_id", id_text()).withColumn("part", F.when(F.col("held"), plain + F.pmod(dealt, F.lit(held))).otherwise(F.pmod(dealt, F.lit(plain))).cast("int"))

    asked = parts.groupBy("part").applyInPandas(_ask(bits), "bucket long, part int, kind int, keys binary, counts binary")
    answered = asked.groupBy("bucket").applyInPandas(_answer(plain), "part int, bucket long, kind int, counts binary, deleted binary")
    answers = materialize(answered, "ngram-counts")

    sums = answers.where("part = -1").select("counts").mapInPandas(_totals, "types long, tokens long, kept_types long, held_tokens long")
    types, tokens, kept_types, held_tokens = (x or 0 for x in sums.agg(*(F.sum(c) for c in sums.columns)).first())
    answers = answers.where("part >= 0")

    cells = parts.where("held").groupBy("part").cogroup(answers.where(F.col("part") >= plain).groupBy("part")).applyInPandas(_held_out(tokens - held_tokens), "cell long, n long")
    cells = cells.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()  # bounded, see FINE
    weights = learn_weights(cells["cell"].to_numpy(np.int64), cells["n"].to_numpy(np.float64), kept_types)
    schema = "doc_id string, copies long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    scored = parts.groupBy("part").cogroup(answers.groupBy("part")).applyInPandas(_score(weights, types, tokens), schema).withColumn("doc_id", F.col("doc_id").cast("long"))
    return (unfold_copies(scored) if repeated else scored).drop("copies")


def _totals(frames):
    for frame in frames:
        found = np.frombuffer(b"".join(frame["counts"]), "<i8").reshape(-1, 4)
        yield pd.DataFrame(found, columns=["types", "tokens", "kept_types", "held_tokens"])


def op4_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; those with crc32(doc_id) mod 7 = 2 are not learned from. ``mean_score`` is that of a token."""
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    scored = score_documents(documents(spark, sf_dir), fold % 7 != 2, F.call_function("div", fold, F.lit(7).cast("long")) % 8 == 0)
    return scored.withColumn("mean_score", F.col("score") / F.col("n_tokens"))
