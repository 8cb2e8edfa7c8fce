"""Queries of sources, parsers, writers and streams, over text and files made from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella.functions.session import scratch
from tessella.plans.registry import query
from tessella.plans.volumes import rounded
from tessella.sources import files as I
from tessella.streaming import streams as R
from tessella.streaming.saves import read_saves, stream_upsert

query("io1_read_table", "SELECT c_custkey, c_name FROM customer")(lambda t: I.read_table(t.spark, "customer", {"path": t.sf_dir}).select("c_custkey", "c_name"))


@query("io2_read_csv_glob", "SELECT l_suppkey, l_quantity, l_tax FROM lineitem")
def _(t):
    path = scratch(t.spark, "csv")
    t.lineitem.select("l_linenumber", "l_suppkey", "l_quantity", "l_tax").write.partitionBy("l_linenumber").option("header", True).csv(path)
    return I.read_csv_glob(t.spark, f"{path}/*/*.csv", "l_suppkey bigint, l_quantity double, l_tax double").drop("file")


@query("io3_read_annotations", "SELECT x, y, CAST(section AS DOUBLE) AS section, name FROM pts WHERE name IN ('A', 'R')")
def _(t):
    paths = {}
    for name in "AR":
        paths[name] = scratch(t.spark, f"annotations-{name}")
        t.pts.where(F.col("name") == name).select("x", "y", "section").write.csv(paths[name])
    return I.read_annotations(t.spark, paths)


query("io4_parse_wide_csv", "SELECT CAST(l_orderkey AS DOUBLE) AS key, round(l_quantity + l_discount, 6) AS total, CAST(l_suppkey AS DOUBLE) AS supp FROM lineitem")(
    lambda t: rounded(I.parse_wide_csv(t.lineitem.select(F.concat_ws(",", *(F.col(c).cast("string") for c in ("l_orderkey", "l_quantity", "l_discount", "l_suppkey"))).alias("line")), [("key", 0, 1), ("pair", 1, 2), ("supp", 3, 1)]).select("key", (F.col("pair")[0] + F.col("pair")[1]).alias("total"), "supp"), "total", digits=6))


def states(t, most=I.PIECE):
    note = F.struct(F.array("x", "y", F.col("section") + 0.5).alias("point"), F.col("id").cast("string").alias("description"))
    # a state holds a bounded number of a prep's points, however many there are
    layers = I.pieces(t.pts, ["prep"], "id", most).groupBy("prep", "piece").agg(F.array(F.struct(F.lit("cells").alias("name"), F.collect_list(note).alias("annotations")), F.struct(F.lit("image").alias("name"), F.lit(None).cast("array<struct<point:array<double>,description:string>>").alias("annotations"))).alias("layers"))
    return layers.select("prep", F.to_json(F.struct("layers")).alias("state"))


query("io5_explode_layers", "SELECT prep, 'cells' AS layer, CAST(id AS VARCHAR) AS description, CAST(trunc(x) AS INT) AS x, CAST(trunc(y) AS INT) AS y, CAST(round_even(section + 0.5, 0) AS INT) AS section FROM pts")(
    lambda t: I.explode_layers(states(t), "state", half_even=True))
query("io6_parse_parameters", "SELECT event_id, event_type AS key, CAST(event_id % 9 AS DOUBLE) AS first, 'v' || event_id AS second, NULL::DOUBLE AS number FROM events")(
    lambda t: I.parse_parameters(t.events.select("event_id", F.format_string('(%s %s "v%s")', "event_type", (F.col("event_id") % 9).cast("string"), F.col("event_id").cast("string")).alias("value"))).select("event_id", "key", F.col("numbers")[0].alias("first"), F.col("texts")[1].alias("second"), F.col("numbers")[1].alias("number")))
query("io7_parse_points", "SELECT id, x, round(y, 6) AS y, z FROM pts3")(
    lambda t: rounded(I.parse_points(t.pts3.select("id", F.concat(F.lit("Point 1 ; OutputPoint = [ "), F.concat_ws(" ", *(F.col(c).cast("string") for c in "xyz")), F.lit(" ] ; Deformation = [ 0 0 0 ]")).alias("value"))), "y", digits=6))


@query("io8_write_points_text", "SELECT 'index' AS value UNION ALL SELECT CAST(count(*) AS VARCHAR) FROM orders UNION ALL SELECT o_orderkey || ' ' || o_custkey || ' ' || o_orderkey % 7 FROM orders")
def _(t):
    path = scratch(t.spark, "points")
    I.write_points_text(t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("x"), F.col("o_custkey").alias("y"), (F.col("o_orderkey") % 7).alias("z")), path)
    return t.spark.read.text(path)


ACRONYMS = "SELECT id, name, substr(name, 1, 4) AS acronym, parent_id FROM tree"
query("io9_flatten_ontology", f"WITH a AS ({ACRONYMS}) SELECT a.id, a.name, a.acronym, a.parent_id, coalesce(p.name, 'null') AS parent_name, coalesce(p.acronym, 'null') AS parent_acronym FROM a LEFT JOIN a p ON a.parent_id = p.id")(
    lambda t: I.flatten_ontology(t.tree.withColumn("acronym", F.substring("name", 1, 4))))
@query("io9_ontology_rows", """SELECT CAST(c_custkey AS BIGINT) AS id, c_name AS name, NULL::BIGINT AS parent_id FROM customer UNION ALL SELECT 1000000000 + o_orderkey, o_orderpriority, CAST(o_custkey AS BIGINT) FROM orders JOIN customer ON o_custkey = c_custkey
UNION ALL SELECT 1000000000000 + l_orderkey * 8 + l_linenumber, l_returnflag, 1000000000 + l_orderkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""")
def _(t):
    # a customer with orders with lines, as one nested text each
    part = lambda k, n, *more: F.struct(F.col(k).alias("id"), F.col(n).alias("name"), *more)
    lines = t.lineitem.withColumn("k", 1000000000000 + F.col("l_orderkey") * 8 + F.col("l_linenumber")).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(part("k", "l_returnflag")).alias("children"))
    orders = t.orders.join(lines, "o_orderkey", "left").withColumn("k", 1000000000 + F.col("o_orderkey")).groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.collect_list(part("k", "o_orderpriority", F.col("children"))).alias("children"))
    docs = t.customer.join(orders, "c_custkey", "left").select(F.to_json(part("c_custkey", "c_name", F.col("children"))).alias("doc"))
    return I.ontology_rows(docs, "doc").select("id", "name", "parent_id")


@query("io10_write_result", "SELECT label, count(*) AS voxels, 'csv' AS how FROM vox GROUP BY label UNION ALL SELECT label, count(*), 'parquet' FROM vox GROUP BY label")
def _(t):
    counts = t.vox.groupBy("label").agg(F.count(F.lit(1)).alias("voxels"))
    a, b = scratch(t.spark, "csv"), scratch(t.spark, "parquet")
    I.write_result(counts, a, "csv")
    I.write_result(counts, b)
    return t.spark.read.schema("label long, voxels long").option("header", True).csv(a).withColumn("how", F.lit("csv")).union(t.spark.read.parquet(b).withColumn("how", F.lit("parquet")))


query("io11_derive_tif_rows", "SELECT id, replace(replace(file_name, '.czi', ''), '__', '_') || '_S' || s || '_C' || c || '.tif' AS tif_name FROM (SELECT id, file_name, unnest(generate_series(1, scenes)) AS s FROM slides), (VALUES (1), (2)) v(c)")(
    lambda t: I.derive_tif_rows(t.slides.withColumn("channels", F.lit(2))).select("id", "tif_name"))
query("io12_parse_vertices", "SELECT p_partkey, CAST(p_partkey + p_size AS DOUBLE) AS sx, CAST(p_size + 7 AS DOUBLE) AS sy FROM part")(
    lambda t: I.parse_vertices(t.part.select("p_partkey", F.format_string("[[%s  %s]\n [ %s, ,7. ]]", F.col("p_partkey").cast("string"), F.col("p_size").cast("string"), F.col("p_size").cast("string")).alias("text")).withColumn("text", F.regexp_replace("text", "7\\.", "7.0")), "text").select("p_partkey", (F.col("vertices")[0]["x"] + F.col("vertices")[1]["x"]).alias("sx"), (F.col("vertices")[0]["y"] + F.col("vertices")[1]["y"]).alias("sy")))
query("io13_to_layer_json", "SELECT prep, count(*) AS points, CAST(sum(z + 0.5) AS DOUBLE) AS z FROM pts3 GROUP BY prep")(
    lambda t: I.to_layer_json(t.pts3.withColumn("z", F.round("z")), "prep").select("prep", F.from_json("json", "struct<annotations:array<struct<point:array<double>>>>")["annotations"].alias("a")).select("prep", F.size("a").cast("long").alias("points"), F.aggregate("a", F.lit(0.0), lambda s, x: s + x["point"][2]).alias("z")).groupBy("prep").agg(F.sum("points").alias("points"), F.sum("z").alias("z")))


# --- streams ------------------------------------------------------------------------------


def arriving(t):
    """Events as files that arrive."""
    path = scratch(t.spark, "arrivals")
    t.events.repartition(3).write.parquet(path)
    return path


@query("st1_stream_files", "SELECT event_id, user_id FROM events")
def _(t):
    source, out, check = arriving(t), scratch(t.spark, "out"), scratch(t.spark, "check")
    for _ in range(2):  # the second run finds nothing to do
        R.run_available(R.stream_files(t.spark, source, t.events.schema).select("event_id", "user_id"), out, check)
    return t.spark.read.schema("event_id long, user_id long").parquet(out)


@query("st2_stream_upsert", "SELECT user_id, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id")
def _(t):
    source, out, check = arriving(t), scratch(t.spark, "state"), scratch(t.spark, "check")
    saves = R.stream_files(t.spark, source, t.events.schema, per_batch=1).select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id", "value")
    stream_upsert(saves, out, check, ["user_id"], "ts", every=2)
    return read_saves(t.spark, out, saves.schema, ["user_id"], "ts").select("user_id", "event_id", "value")


LOG = "SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') || ' - ' || CASE event_type WHEN 'click' THEN 'START job' ELSE 'job took ' || event_id % 50 END AS value FROM events"


@query("st3_stream_log_counts", "SELECT date_trunc('minute', ts) AS minute, count(*) AS n, count(*) FILTER (WHERE event_type = 'click') AS starts, CAST(sum(CASE WHEN event_type <> 'click' THEN event_id % 50 END) AS DOUBLE) AS seconds FROM events GROUP BY 1")
def _(t):
    source, out, check = scratch(t.spark, "log"), "log_counts", scratch(t.spark, "check")
    line = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" - "), F.when(F.col("event_type") == "click", F.lit("START job")).otherwise(F.concat(F.lit("job took "), (F.col("event_id") % 50).cast("string"))))
    t.events.select(line.alias("value")).write.text(source)
    path = scratch(t.spark, out)

    def keep(batch, number):
        batch.write.mode("overwrite").parquet(path)

    counts = R.stream_log_counts(t.spark.readStream.text(source))
    counts.writeStream.foreachBatch(keep).outputMode("complete").option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.parquet(path)
