"""Bindings of the library's logical tables to the driver's tables, and the query registry.

A binding is SQL that Spark and DuckDB both run, so a query and its SQL twin
start from the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

BINDINGS = {
    # points of sections; two coordinates within a section
    "pts": "SELECT ((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS id, l_suppkey % 8 AS prep, l_linenumber AS section, l_quantity * 20 AS x, l_extendedprice / 100 AS y, l_returnflag AS name FROM lineitem",
    "pts3": "SELECT ((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS id, l_suppkey % 8 AS prep, l_quantity AS x, l_extendedprice / 1000 AS y, l_discount * 100 AS z, l_partkey AS cell FROM lineitem",
    "truths": "SELECT ((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS id, l_suppkey % 16 AS prep, l_linenumber AS section, l_quantity * 20 AS x, l_extendedprice / 100 AS y FROM lineitem WHERE l_returnflag = 'A'",
    "preds": "SELECT ((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS id, l_suppkey % 16 AS prep, l_linenumber AS section, l_quantity * 20 AS x, l_extendedprice / 100 AS y FROM lineitem WHERE l_returnflag = 'R'",
    # relational metadata
    "animals": "SELECT c_custkey AS prep_id, c_mktsegment AS strain, c_acctbal > 0 AS active FROM customer",
    "histology": "SELECT c_custkey AS prep_id, CASE WHEN c_custkey % 2 = 0 THEN 'ASC' ELSE 'DESC' END AS side_sectioned_first, CASE WHEN c_custkey % 3 = 0 THEN 'DESC' ELSE 'ASC' END AS scene_order, CASE c_custkey % 3 WHEN 0 THEN 'coronal' WHEN 1 THEN 'horizontal' ELSE 'sagittal' END AS orientation FROM customer",
    "scans": "SELECT o_orderkey AS id, o_custkey AS prep_id, o_orderkey % 3 AS rescan_number, CAST(0.325 AS DOUBLE) AS resolution, CAST(20 AS DOUBLE) AS zresolution, o_orderkey % 4 AS rotation, CASE o_orderkey % 3 WHEN 0 THEN 'none' WHEN 1 THEN 'flip' ELSE 'flop' END AS flip FROM orders",
    "slides": "SELECT ((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS id, l_orderkey AS scan_run_id, l_linenumber % 4 AS slide_physical_id, CASE l_linestatus WHEN 'O' THEN 'Good' ELSE 'Bad' END AS slide_status, l_suppkey % 3 + 1 AS scenes, 'DK' || CAST(l_suppkey AS VARCHAR(20)) || '__slide' || CAST(l_linenumber AS VARCHAR(20)) || '.czi' AS file_name, l_returnflag <> 'R' AS active FROM lineitem",
    "tifs": "SELECT ((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS id, ((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS slide_id, l_partkey % 4 AS scene_index, l_partkey % 4 AS scene_number, l_suppkey % 3 + 1 AS channel, l_quantity * 1000 AS width, l_extendedprice / 4 AS height, l_extendedprice AS file_size, l_returnflag <> 'A' AS active FROM lineitem",
    "sessions": "SELECT o_orderkey AS id, o_custkey AS prep_id, o_orderkey % 5 AS user_id, o_orderkey % 40 AS brain_region_id, CASE o_orderkey % 3 WHEN 0 THEN 'STRUCTURE_COM' WHEN 1 THEN 'POLYGON_SEQUENCE' ELSE 'MARKED_CELL' END AS annotation_type, o_orderstatus <> 'F' AS active, o_orderdate AS created FROM orders",
    "centers": "SELECT ((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS id, l_orderkey AS session_id, l_quantity AS x, l_extendedprice / 1000 AS y, l_discount * 100 AS z, CASE WHEN l_returnflag = 'A' THEN 'COMPUTER' ELSE 'MANUAL' END AS source FROM lineitem",
    "brain_regions": "SELECT p_partkey AS id, 'R' || CAST(p_partkey AS VARCHAR(20)) || CASE p_partkey % 3 WHEN 0 THEN '_L' WHEN 1 THEN '_R' ELSE '' END AS abbreviation, p_name AS description, p_size > 5 AS active FROM part",
    "polygons": "SELECT ((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS id, l_orderkey AS session_id, l_suppkey % 4 AS section, l_linenumber AS point_order, l_quantity * 20 AS x, l_extendedprice / 100 AS y FROM lineitem",
    "centroids": "SELECT l_suppkey % 6 AS prep, 'R' || CAST(l_partkey % 9 AS VARCHAR(20)) || CASE l_partkey % 3 WHEN 0 THEN '_L' WHEN 1 THEN '_R' ELSE '' END AS abbr, avg(l_quantity) AS x, avg(l_extendedprice) / 1000 AS y, avg(l_discount) * 100 AS z FROM lineitem GROUP BY l_suppkey % 6, l_partkey % 9, CASE l_partkey % 3 WHEN 0 THEN '_L' WHEN 1 THEN '_R' ELSE '' END",
    # region tree: a root, regions, nations, customers
    "tree": "SELECT CAST(0 AS BIGINT) AS id, CAST(NULL AS BIGINT) AS parent_id, 'root' AS name UNION ALL SELECT CAST(1000 + r_regionkey AS BIGINT), CAST(0 AS BIGINT), r_name FROM region UNION ALL SELECT CAST(2000 + n_nationkey AS BIGINT), CAST(1000 + n_regionkey AS BIGINT), n_name FROM nation UNION ALL SELECT CAST(10000 + c_custkey AS BIGINT), CAST(2000 + c_nationkey AS BIGINT), c_name FROM customer",
    "tree_counts": "SELECT 10000 + o_custkey AS id, count(*) AS cells, CAST(floor(CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) / 100) AS BIGINT) AS voxels FROM orders GROUP BY 10000 + o_custkey",
    # sparse volumes and pixels; one axis follows the keys, so that volumes and images grow with the tables
    "vox": "SELECT p_size + 50 * CAST(floor(p_partkey / 2000) AS BIGINT) AS x, p_partkey % 50 AS y, p_partkey % 7 AS z, max(1 + p_partkey % 11) AS label FROM part GROUP BY 1, 2, 3",
    "brain_vox": "SELECT DISTINCT l_suppkey % 4 AS brain, CAST(l_quantity AS BIGINT) AS x, l_partkey % 20 AS y, l_orderkey % 6 + 6 * CAST(floor(l_orderkey / 20000) AS BIGINT) AS z, 1 AS v FROM lineitem",
    "pixels": "SELECT l_linenumber AS section, l_suppkey % 25 AS x, l_partkey % 25 + 25 * CAST(floor(l_partkey / 2000) AS BIGINT) AS y, max(CAST(l_quantity * 400 AS BIGINT)) AS value FROM lineitem GROUP BY 1, 2, 3",
    "mask": "SELECT DISTINCT l_linenumber AS section, l_suppkey % 25 AS x, l_partkey % 25 + 25 * CAST(floor(l_partkey / 2000) AS BIGINT) AS y FROM lineitem WHERE l_returnflag = 'A'",
    # detections and scores
    "scores": "SELECT ((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS id, l_suppkey % 30 AS model, l_quantity - 25 AS score FROM lineitem",
    "detections": "SELECT ((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS id, l_suppkey % 8 AS animal, l_linenumber AS section, l_quantity * 20 AS x, l_extendedprice / 100 AS y, (l_quantity - 25) / 5 AS mean_score, l_discount * 40 AS std_score, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 0 ELSE -1 END AS label FROM lineitem",
    "judged": "SELECT l.doc_id AS id, l.quality AS truth, (d.n_chars % 1000) / CAST(1000 AS DOUBLE) AS p FROM labels l JOIN documents d ON l.doc_id = d.doc_id",
    "section_tf": "SELECT user_id AS animal, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS section, value / 1000 AS rotation, CAST(event_id % 7 - 3 AS DOUBLE) AS xshift, CAST(event_id % 5 - 2 AS DOUBLE) AS yshift FROM events",
    "files": "SELECT doc_id AS id, source AS directory, 'file' || CAST(doc_id AS VARCHAR(20)) || '.tif' AS name, n_chars AS size FROM documents",
}
USES = {k: [b for b in BINDINGS if b != k and f" {b} " in f"{v} "] for k, v in BINDINGS.items()}


class Tables:
    """Driver tables and bindings as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name in BINDINGS:
            return self.bound(BINDINGS[name])
        raise AttributeError(name)

    def bound(self, sql: str) -> DataFrame:
        """Portable SQL over the driver's tables."""
        used = {t: getattr(self, t) for t in TABLES if f" {t}" in sql}
        for t in used:
            for lead in ("FROM ", "JOIN "):
                sql = sql.replace(f"{lead}{t} ", f"{lead}{{{t}}} ").replace(f"{lead}{t})", f"{lead}{{{t}}})")
            if sql.endswith(f"FROM {t}"):
                sql = sql[: -len(t)] + f"{{{t}}}"
        used = {t: df for t, df in used.items() if f"{{{t}}}" in sql}
        return self.spark.sql(sql, **used)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def with_bindings(sql: str) -> str:
    """The SQL with the bindings it names as leading common tables."""
    named = [b for b in BINDINGS if any(f"{lead}{b}{end}" in f"{sql} " for lead in ("FROM ", "JOIN ", ", ") for end in (" ", ")", "\n", ","))]
    if not named:
        return sql.strip()
    ctes = ", ".join(f"{b} AS ({BINDINGS[b]})" for b in named)
    text = sql.strip()
    if text.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes}, {text[15:]}"
    if text.upper().startswith("WITH "):
        return f"WITH {ctes}, {text[5:]}"
    return f"WITH {ctes} {text}"


def query(name: str, sql: str | None = None):
    """Register a function of Tables under ``name``, with its SQL twin."""

    def keep(function):
        QUERIES[name] = lambda spark, sf_dir: function(Tables(spark, sf_dir))
        if sql:
            ORACLES[name] = with_bindings(sql)
        return function

    return keep
