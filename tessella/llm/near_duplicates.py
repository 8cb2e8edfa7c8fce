"""Near duplicates by BagMinHash signatures, banding and exact multiset overlap.

A text is the multiset of its 5-word shingles. Weight w of a shingle is the
interval [0, w), cut at 1, 2, 4, 8, ...; each piece carries a Poisson process
whose rate is its width, so heavy shingles cost the logarithm of their weight.
A point has a time, a register and a level in its piece and counts if the level
lies below w. A register keeps its earliest time; two texts agree in a register
with a probability equal to their weighted Jaccard similarity. Points are only
made up to a time by which all registers are filled, so most shingles cost one
draw.

Signatures are cut into bands. Texts that share a band are candidates, and a
candidate pair is a link if sum(min)/sum(max) of its multisets is at least the
threshold. A bucket is not expanded into all pairs: its members are compared
with its first one, and linked texts are merged into components. What then still
has candidates in different components goes through a second, exact search,
which finds every pair that may reach the threshold by the rare shingles that it
must share. So no link between components is lost, however large a bucket, and
copies cost one comparison each.

Defined cases: exact copies are one class, nulls and empty texts too form a
class of copies each (null is not empty); a text of one to four words is one
shingle; equal ids with different texts are different documents; an empty table
gives an empty result; a class is named by its smallest doc_id (null if all are
null) and has a key of its own, since ids may repeat; other columns are kept by
``keep_one``, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.llm import bloom
from tessella.llm.common import chunks, documents, materialize, mix, small_batches, window_hashes, word_hashes
from tessella.operators import graphs

SHINGLE = 5
THRESHOLD = 0.8
#: At similarity 0.8 a pair misses all bands with a probability of (1 - 0.8**5)**32 = 3e-6.
BANDS, ROWS = 32, 5
#: Texts that a task remembers having seen, so as not to repeat itself; repeats beyond them are told later.
SEEN = 50_000


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts and the shingles a text has; repeated ones repeat."""
    words, counts = word_hashes(texts)
    found, n = window_hashes(words, counts, SHINGLE)
    few = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if not len(few):
        return found, n
    first = np.cumsum(counts) - counts
    own = []
    with np.errstate(over="ignore"):
        for i in few:
            h = np.uint64(counts[i])
            for w in words[first[i] : first[i] + counts[i]]:
                h = mix(np.array([h], np.uint64) * np.uint64(0x9E3779B97F4A7C15) + w)[0]
            own.append(h)
    at = (np.cumsum(n) - n)[few]
    n = n.copy()
    n[few] = 1
    return np.insert(found, at, np.array(own, np.uint64)), n


def weighted(found: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle, weight), sorted."""
    owner = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((found, owner))
    owner, found = owner[order], found[order]
    new = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (found[1:] != found[:-1]))) if len(found) else np.zeros(0, int)
    return owner[new], found[new], np.diff(np.append(new, len(found)))


def _unit(x: np.ndarray) -> np.ndarray:
    """Uniform numbers in (0, 1] of hashes."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53


def signatures(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Earliest times by register (texts x size; NaN rows where a text has no words), and total weights."""
    owner, shingle, weight = weighted(*shingles(texts))
    total = np.bincount(owner, weight, len(texts)) if len(owner) else np.zeros(len(texts))
    times = np.full(len(texts) * size, np.inf)
    # pieces [0,1), [1,2), [2,4), ... that begin below the weight
    pieces = 1 + np.ceil(np.log2(np.maximum(weight, 1))).astype(int)
    of = np.repeat(np.arange(len(weight)), pieces)
    level = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    low = np.where(level == 0, 0, 2.0 ** (level - 1))
    width = np.where(level == 0, 1, 2.0 ** (level - 1))
    with np.errstate(over="ignore"):
        seed = mix(shingle[of] + (level.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03))
    doc, above = owner[of], weight[of]
    until = size * (np.log(size) + 5) / np.maximum(total, 1)
    open_docs = total > 0
    while open_docs.any():
        at = np.flatnonzero(open_docs[doc])
        clock = np.zeros(len(at))
        k = 0
        while len(at):
            k += 1
            with np.errstate(over="ignore"):
                draw = mix(seed[at] + np.uint64(k * 0x9E3779B97F4A7C15 % 2**64))
                second = mix(draw ^ np.uint64(0xA0761D6478BD642F))
            clock = clock - np.log(_unit(draw)) / width[at]
            go = clock <= until[doc[at]]
            at, clock, second = at[go], clock[go], second[go]
            inside = low[at] + _unit(mix(second)) * width[at] <= above[at]
            register = (second % np.uint64(size)).astype(np.int64)
            np.minimum.at(times, doc[at[inside]] * size + register[inside], clock[inside])
        open_docs &= ~np.isfinite(times.reshape(-1, size)).all(axis=1)
        until = np.where(open_docs, until * 4, until)
    return times.reshape(-1, size), total


def _band_keys(bands: int, rows: int):
    def run(frames):
        seen: set[bytes] = set()
        for frame in chunks(frames, "text", 1 << 20):
            frame = frame[~frame["node"].isin(seen)].drop_duplicates("node")
            if len(seen) > SEEN:
                seen.clear()
            seen.update(frame["node"])
            if not len(frame):
                continue
            times, total = signatures(frame["text"].tolist(), bands * rows)
            bits = times.view(np.uint64).reshape(-1, bands, rows)
            with np.errstate(over="ignore"):
                key = np.zeros(bits.shape[:2], np.uint64) + np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB)
                for r in range(rows):
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, r])
            have = total > 0
            yield pd.DataFrame({
                "bucket": key[have].reshape(-1).view(np.int64),
                "node": np.repeat(frame["node"].to_numpy()[have], bands),
                "weight": np.repeat(total[have].astype(np.int64), bands),
            })

    return run


def _packed_texts(words: np.ndarray):
    """Texts of the wanted nodes, compressed, each once a task. (Null and empty ones are never wanted.)"""

    def run(frames):
        seen: set[bytes] = set()
        for frame in frames:
            keys = np.array([int.from_bytes(x[:8], "little", signed=True) for x in frame["node"]], np.int64)
            keep = np.flatnonzero(bloom.may_have(words, keys)) if len(frame) else []
            rows = [(frame["node"].iat[i], frame["text"].iat[i]) for i in keep]
            rows = [(n, t) for n, t in dict(rows).items() if n not in seen]
            if len(seen) > SEEN:
                seen.clear()
            seen.update(n for n, _ in rows)
            yield pd.DataFrame({"node": [n for n, _ in rows], "packed": [zlib.compress(t.encode("utf-8", "surrogatepass"), 1) for _, t in rows]})

    return run


def _similar(threshold: float):
    def run(frames):
        for frame in frames:
            for a in range(0, len(frame), 64):
                part = frame.iloc[a : a + 64]
                texts = [zlib.decompress(x).decode("utf-8", "surrogatepass") for side in ("left_text", "right_text") for x in part[side]]
                owner, shingle, weight = weighted(*shingles(texts))
                n = len(part)
                pair, side = owner % n, owner // n
                order = np.lexsort((side, shingle, pair))
                pair, shingle, weight = pair[order], shingle[order], weight[order]
                both = np.flatnonzero((pair[1:] == pair[:-1]) & (shingle[1:] == shingle[:-1]))
                least = np.bincount(pair[both], np.minimum(weight[both], weight[both + 1]), n)
                most = np.bincount(pair, weight, n) - least
                good = np.flatnonzero(least >= threshold * most - 1e-9)
                yield part.iloc[good][["left", "right"]]

    return run


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of all linked nodes."""
    return graphs.components(links.select(F.col("left").alias("a"), F.col("right").alias("b")))


def linked_components(docs: DataFrame, threshold: float, bands: int, rows: int) -> DataFrame | None:
    """(node, comp) of the texts that have a link, or None if there is none."""
    nodes = docs.select("node", "text")
    # Joins read written tables on both sides, so that Spark may split a hot bucket's rows.
    banded = materialize(nodes.mapInPandas(_band_keys(bands, rows), "bucket long, node binary, weight long"), "bands")
    shared = materialize(banded.groupBy("bucket").count().where("count > 1").select("bucket"), "shared-buckets")
    members = materialize(banded.join(shared, "bucket", "left_semi").distinct().withColumn("comp", F.col("node")), "bucket-members")
    members = _mixed(members)
    if not members.limit(1).count():
        return None
    wanted = bloom.build(members.select("node").distinct().mapInPandas(_low_bits, "key long"), "key")
    packed = nodes.mapInPandas(_packed_texts(wanted), "node binary, packed binary")
    packed = materialize(packed.groupBy("node").agg(F.first("packed").alias("packed")), "texts")

    # every member with its bucket's first one
    first = members.groupBy("bucket").agg(F.min(F.struct("node", "weight")).alias("f"))
    first = materialize(first.select("bucket", F.col("f.node").alias("leader"), F.col("f.weight").alias("leader_weight")), "leaders")
    with_first = members.join(first, "bucket").where(
        (F.col("node") != F.col("leader")) & (F.col("weight") >= threshold * F.col("leader_weight")) & (F.col("leader_weight") >= threshold * F.col("weight"))
    )
    links = _verified(with_first.select(F.least("node", "leader").alias("left"), F.greatest("node", "leader").alias("right")).distinct(), packed, threshold)
    comps = components(links)

    # what a bucket leaves open: members other than the first one, of different components
    rest = members.select("bucket", "node").join(first.select("bucket", F.col("leader").alias("node")), ["bucket", "node"], "left_anti")
    rest = _mixed(_labelled(rest, comps))
    if rest.limit(1).count() and links.limit(1).count():
        # and with the open member that has most links, which texts near a common source most likely share
        degree = materialize(links.select(F.col("left").alias("node")).union(links.select("right")).groupBy("node").agg(F.count(F.lit(1)).alias("degree")), "degrees")
        ranked = rest.join(degree, "node", "left").groupBy("bucket").agg(F.max_by(F.struct("node", "comp"), F.struct(F.coalesce("degree", F.lit(0)).alias("d"), "node")).alias("h"))
        hubs = materialize(ranked.select("bucket", F.col("h.node").alias("hub"), F.col("h.comp").alias("hub_comp")), "hubs")
        with_hub = rest.join(hubs, "bucket").where(F.col("comp") != F.col("hub_comp"))
        links = links.union(_verified(with_hub.select(F.least("node", "hub").alias("left"), F.greatest("node", "hub").alias("right")).distinct(), packed, threshold))
        comps = components(links)
        rest = _labelled(rest.select("bucket", "node"), comps)
    left_open = materialize(_mixed(rest).select("node", "comp").distinct(), "open-nodes")
    if left_open.limit(1).count():
        prefix = _prefixes(left_open, packed, threshold)
        # one text of each component a token first: one link is enough for two components
        more = _verified(_prefix_pairs(prefix, threshold, one_each=True), packed, threshold)
        if more.limit(1).count():
            links = links.union(more)
            comps = components(links)
            prefix = prefix.drop("comp").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
            prefix = materialize(prefix, "prefixes")
        more = _verified(_prefix_pairs(prefix, threshold), packed, threshold)
        if more.limit(1).count():
            return components(links.union(more))
    return comps if comps.limit(1).count() else None


def _labelled(rows: DataFrame, comps: DataFrame) -> DataFrame:
    """Rows (bucket, node) with their component."""
    return materialize(rows.join(comps, "node", "left").select("bucket", "node", F.coalesce("comp", "node").alias("comp")), "labelled")


def _mixed(members: DataFrame) -> DataFrame:
    """Rows of buckets with members of more than one component."""
    groups = members.select("bucket", "comp").distinct()
    mixed = materialize(groups.groupBy("bucket").count().where("count > 1").select("bucket"), "mixed-buckets")
    return materialize(members.join(mixed, "bucket", "left_semi"), "mixed-members")


def _verified(pairs: DataFrame, packed: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose multisets overlap enough."""
    pairs = materialize(pairs, "pairs")
    compared = pairs.join(packed.select(F.col("node").alias("left"), F.col("packed").alias("left_text")), "left")
    compared = compared.join(packed.select(F.col("node").alias("right"), F.col("packed").alias("right_text")), "right")
    return materialize(compared.mapInPandas(_similar(threshold), "left binary, right binary"), "verified")


def _tokens(frames):
    """Shingles of each node, the n-th copy of a shingle as one of its own."""
    for frame in frames:
        for a in range(0, len(frame), 64):
            part = frame.iloc[a : a + 64]
            owner, shingle, weight = weighted(*shingles([zlib.decompress(x).decode("utf-8", "surrogatepass") for x in part["packed"]]))
            copy = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
            with np.errstate(over="ignore"):
                token = mix(np.repeat(shingle, weight) + copy.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            owner = np.repeat(owner, weight)
            size = np.bincount(owner, minlength=len(part))
            yield pd.DataFrame({"node": part["node"].to_numpy()[owner], "comp": part["comp"].to_numpy()[owner], "size": size[owner], "token": token.view(np.int64)})


def _prefixes(nodes: DataFrame, packed: DataFrame, threshold: float) -> DataFrame:
    """The early tokens of each node that other nodes have too, rare ones first, with their places."""
    tokens = materialize(packed.join(nodes, "node").mapInPandas(_tokens, "node binary, comp binary, size int, token long"), "tokens")
    spread = materialize(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1"), "token-texts")
    order = Window.partitionBy("node").orderBy("texts", "token")
    placed = tokens.join(spread, "token", "left").withColumn("texts", F.coalesce("texts", F.lit(1))).withColumn("place", F.row_number().over(order) - 1)
    early = F.col("place") <= F.col("size") - F.ceil(F.col("size") * threshold - 1e-9)
    return materialize(placed.where(early & (F.col("texts") > 1)).select("node", "comp", "size", "token", "place"), "prefixes")


def _prefix_pairs(prefix: DataFrame, threshold: float, one_each: bool = False) -> DataFrame:
    """All pairs of different components that may reach the threshold, without a comparison of each with each.

    Tokens are ordered by the texts that have them, rare ones first. Two texts
    that overlap enough have their first common token early in both, and as many
    tokens after it as the overlap asks for: an equi-join on early tokens with
    that condition finds every such pair. Texts that differ from a large group
    in many places begin with tokens of their own and so meet nothing of it.
    The component that has most texts of a token stands on one side only.
    ``one_each``: only the text of each component in which a token comes first.
    """
    if one_each:
        best = F.min(F.struct("place", "node", "size")).alias("f")
        prefix = materialize(prefix.groupBy("token", "comp").agg(best).select("token", "comp", "f.node", "f.size", "f.place"), "prefix-heads")
    shares = prefix.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("n"))
    largest = materialize(shares.groupBy("token").agg(F.max_by("comp", F.struct("n", "comp")).alias("largest"), F.count(F.lit(1)).alias("comps")).where("comps > 1").select("token", "largest"), "largest")
    few = materialize(prefix.join(largest, "token").where(F.col("comp") != F.col("largest")).drop("largest"), "few")
    other = prefix.select("token", *(F.col(c).alias(f"o_{c}") for c in ("node", "comp", "size", "place")))
    if one_each:  # with the largest component's text alone
        other = materialize(other.join(largest.select("token", F.col("largest").alias("o_comp")), ["token", "o_comp"]), "largest-heads")
    least = (F.col("size") + F.col("o_size")) * (threshold / (1 + threshold)) - 1e-6
    possible = F.least(F.col("size") - F.col("place"), F.col("o_size") - F.col("o_place")) >= least
    pairs = few.join(other, "token").where((F.col("comp") != F.col("o_comp")) & possible)
    return pairs.select(F.least("node", "o_node").alias("left"), F.greatest("node", "o_node").alias("right")).distinct()


def _low_bits(frames):
    for frame in frames:
        yield pd.DataFrame({"key": [int.from_bytes(x[:8], "little", signed=True) for x in frame["node"]]})


def node_of(text: Column) -> Column:
    """The 128-bit hash of a text; null has one of its own."""
    null = F.unhex(F.lit(hashlib.md5(b"\0null").hexdigest()))
    return F.coalesce(F.unhex(F.md5(text.cast("string"))), null)


def numbered(docs: DataFrame) -> DataFrame:
    """doc_id, node and a number of every row, stored: the number tells equal rows apart."""
    rows = docs.select(F.col("doc_id").cast("long"), node_of(F.col("text")).alias("node"), F.monotonically_increasing_id().alias("row"))
    return materialize(rows, "document-nodes")


def classes(docs: DataFrame, rows: DataFrame | None = None, threshold: float = THRESHOLD, bands: int = BANDS, per_band: int = ROWS) -> DataFrame:
    """One row a distinct text: node, first_id, class_key, class_id, class_size (documents), texts (distinct), and the class's head and head_row."""
    small_batches(docs.sparkSession)
    rows = numbered(docs) if rows is None else rows
    comps = linked_components(docs.select(F.col("text").cast("string"), node_of(F.col("text")).alias("node")), threshold, bands, per_band)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    copies = rows.groupBy("node").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("copies"))
    if comps is None:
        comps = rows.select("node", F.col("node").alias("comp")).limit(0)
    members = materialize(copies.join(comps, "node", "left").select("node", "first", "copies", F.coalesce("comp", "node").alias("class_key")), "members")
    whole = members.groupBy("class_key").agg(
        F.min("first")["doc_id"].alias("class_id"), F.sum("copies").alias("class_size"), F.count(F.lit(1)).alias("texts"),
        F.min_by("node", "first").alias("head"), F.min("first")["row"].alias("head_row"),
    )
    found = members.select("node", "class_key", F.col("first.doc_id").alias("first_id")).join(materialize(whole, "classes"), "class_key")
    return materialize(found.select("node", "first_id", "class_key", "class_id", "class_size", "texts", "head", "head_row"), "class-members")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class, with all its columns: the smallest doc_id, nulls last.

    Rows that are equal in doc_id and text are one document; of these the one stays
    whose columns (but maps) have the smallest hash.
    """
    heads = classes(docs, threshold=threshold).where("node = head").select(F.col("node").alias("__head"), F.col("first_id").alias("__id"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.withColumn("__node", node_of(F.col("text")))
    same = (F.col("__node") == F.col("__head")) & F.col("doc_id").cast("long").eqNullSafe(F.col("__id"))
    ordered = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    one = F.min_by(F.struct(*columns), F.xxhash64(*ordered)).alias("__row")
    return keyed.join(heads, same).groupBy("__head").agg(one).select(*(F.col("__row").getField(c).alias(c) for c in docs.columns))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class; ``kept`` holds for one row of each class."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    rows = numbered(docs)
    return rows.join(classes(docs, rows), "node").select("doc_id", "class_id", "class_size", "texts", (F.col("row") == F.col("head_row")).alias("kept"))
