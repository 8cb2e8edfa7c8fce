"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word patterns: space and \t \n \v \f \r.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

_own_dir: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local session may go without it; it then gets a temporary folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local[") and master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dir:
        _own_dir[app] = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
    return _own_dir[app]


def fresh_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    This cuts the lineage, survives lost executors and lets several branches
    read one computation.
    """
    spark = df.sparkSession
    path = fresh_path(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes that Spark hands to a Python worker at a time.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the batches of this session's Python stages by bytes; rows of texts are of very different lengths.

    Plans read the setting when they run, so it stays; a lower bound of the session's own is kept.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))) <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def id_text(name: str = "doc_id") -> Column:
    """An id for the way through pandas, which would make floats of a column of longs with nulls."""
    return F.col(name).cast("long").cast("string").alias(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# --- 64-bit hashes of words and word windows, vectorised over many texts ------------------

_MULT = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(int(_MULT), -1, 2**64))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: shifts and odd multiplications."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _MULT)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_LOWERED = _BYTES[_LOWER]

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_NOT_ALNUM = np.zeros(256, bool)
_NOT_ALNUM[:128] = True
for _a, _b in ((48, 58), (65, 91), (97, 123)):
    _NOT_ALNUM[_a:_b] = False

#: Bytes that are hashed at a time.
HASH_BLOCK = 1 << 19

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_MULT, _INV)):
            full = np.full(n, base, np.uint64)
            full[0] = 1
            with np.errstate(over="ignore"):
                _powers[k] = np.multiply.accumulate(full)
    return _powers[0][:n], _powers[1][:n]


def segment_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, values: np.ndarray = _BYTES) -> np.ndarray:
    """Hashes of the bytes from each start to its end, starts rising; ``values`` has a number for each byte.

    Block by block, so that memory doesn't follow the length of ``data``.
    """
    out = np.empty(len(start), np.uint64)
    edges = np.searchsorted(start, np.arange(0, len(data) + HASH_BLOCK, HASH_BLOCK))
    for i, j in zip(edges, edges[1:]):
        if i == j:
            continue
        low, high = int(start[i]), int(end[i:j].max())
        power, inverse = _power_table(high - low + 1)
        with np.errstate(over="ignore"):
            total = np.zeros(high - low + 1, np.uint64)
            np.cumsum(values[data[low:high]] * power[:-1], out=total[1:])
            out[i:j] = mix((total[end[i:j] - low] - total[start[i:j] - low]) * inverse[start[i:j] - low] + (end[i:j] - start[i:j]).astype(np.uint64))
    return out


def word_hashes(texts: list[str], alnum: bool = False, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, one after another, and the words a text has.

    ``alnum``: words are runs of ASCII letters, digits and non-ASCII characters;
    else runs of anything but ASCII white space. ``lower`` folds A-Z.
    """
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    joined = b" " + b" ".join(raw) + b" "
    data = np.frombuffer(joined, np.uint8)
    gap = (_NOT_ALNUM if alnum else _SPACE)[data]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    start, end = edge[0::2], edge[1::2]
    hashed = segment_hashes(data, start, end, _LOWERED if lower else _BYTES)
    ends = np.cumsum([len(r) + 1 for r in raw])
    counts = np.diff(np.searchsorted(start, ends, side="right"), prepend=0) if raw else np.zeros(0, np.int64)
    return hashed, counts


def window_hashes(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` words inside one text, and the windows a text has."""
    n = np.maximum(counts - size + 1, 0)
    if not n.sum():
        return np.zeros(0, np.uint64), n
    with np.errstate(over="ignore"):
        m = len(words) - size + 1
        rolled = np.zeros(m, np.uint64)
        factor = 1
        for j in range(size):
            rolled += words[j : j + m] * np.uint64(factor)
            factor = factor * int(_MULT) % 2**64
        rolled = mix(rolled + np.uint64(size))
    first = np.cumsum(counts) - counts
    at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return rolled[at], n


def chunks(frames, column: str, most_bytes: int = 2 << 20):
    """Cut pandas batches so that a cut has about ``most_bytes`` characters of text, one row at least."""
    for frame in frames:
        if not len(frame):
            continue
        frame[column] = frame[column].fillna("")
        at = np.cumsum(frame[column].str.len().to_numpy()) // most_bytes
        edges = [0, *(np.flatnonzero(np.diff(at)) + 1), len(frame)]
        for a, b in zip(edges, edges[1:]):
            yield frame.iloc[a:b]
