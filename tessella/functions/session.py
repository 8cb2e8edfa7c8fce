"""Sessions and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def session(name: str = "tessella", **conf: str) -> SparkSession:
    """A session with adaptive plans and UTC; further settings as keywords with ``__`` for dots."""
    builder = SparkSession.builder.appName(name).config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true").config("spark.sql.session.timeZone", "UTC")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch(spark: SparkSession, tag: str) -> str:
    """A fresh path in ``spark.checkpoint.dir``, or, in a local session without it, in a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        root = _local.setdefault(app, "file://" + tempfile.mkdtemp(prefix="spark-scratch-"))
    return f"{root.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage and survives lost executors."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that ``stored`` has returned and that nothing will read again."""
    for df in tables:
        if path := getattr(df, "_stored_at", None):
            remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder where the session's file systems have it; nothing there is fine."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
