"""Queries of the annotation tables: filters, joins, counts, windows, order, sets, upkeep."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella.functions import columns as C
from tessella.operators import hierarchy, voxels
from tessella.operators import tables as T
from tessella.plans.registry import query

query("f1_query_table", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '2-HIGH'")(
    lambda t: T.query_table(t.orders, {"o_orderstatus": "O", "o_orderpriority": "2-HIGH"}).select("o_orderkey", "o_custkey", "o_totalprice"))
query("f2_get_row", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey = 7")(
    lambda t: T.get_row(t.orders, {"o_orderkey": 7}).select("o_orderkey", "o_custkey"))
query("f3_row_exists", "SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders) AS found FROM customer")(
    lambda t: T.row_exists(t.customer.select("c_custkey"), t.orders.withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"]))
query("f4_active_regions", "SELECT id, abbreviation FROM brain_regions WHERE active AND id NOT IN (52, 53, 54)")(
    lambda t: T.active_regions(t.brain_regions).select("id", "abbreviation"))
query("f5_region_lookup", "SELECT id, abbreviation FROM brain_regions WHERE abbreviation = 'R3_L' OR id = 4")(
    lambda t: T.region_id(t.brain_regions, "R3_L").withColumn("abbreviation", F.lit("R3_L")).union(T.region_abbr(t.brain_regions, 4).select(F.lit(4).cast("long").alias("id"), "abbreviation")))


@query("f6_label_side", "SELECT abbreviation, CASE WHEN abbreviation LIKE '%\\_L' ESCAPE '\\' THEN 'Left' WHEN abbreviation LIKE '%\\_R' ESCAPE '\\' THEN 'Right' ELSE 'Singular' END AS side, CASE WHEN split_part(abbreviation, '_', 1) IN ('R3', 'R4', 'R9') THEN 'midbrain' ELSE 'brainstem' END AS area, contains(abbreviation, '_') AS paired FROM brain_regions")
def _(t):
    r = t.brain_regions
    a = F.col("abbreviation")
    paired = T.paired_regions(r).select("id", F.lit(True).alias("paired"))
    return r.join(paired, "id", "left").select(a, T.label_side(a).alias("side"), T.label_area(a, ["R3", "R4", "R9"]).alias("area"), F.coalesce("paired", F.lit(False)).alias("paired"))


query("f7_hex_to_rgb", "SELECT p_partkey, (p_partkey * 7) % 256 AS r, (p_partkey * 13) % 256 AS g, (p_partkey * 29) % 256 AS b FROM part")(
    lambda t: t.part.select("p_partkey", F.concat(F.lit("#"), *(F.lpad(F.lower(F.hex((F.col("p_partkey") * k) % 256)), 2, "0") for k in (7, 13, 29))).alias("c")).select("p_partkey", *(c.cast("long").alias(n) for c, n in zip(T.hex_to_rgb(F.col("c")), "rgb"))))
query("f8_map_labels", "SELECT event_id, CASE WHEN event_type IN ('click', 'tap') THEN 'press' WHEN event_type IN ('view', 'impression') THEN 'look' END AS label FROM events")(
    lambda t: t.events.select("event_id", T.map_labels(F.col("event_type"), {"press": ["click", "tap"], "look": ["view", "impression"]}).alias("label")))
query("f9_compose_category", "SELECT o_orderkey, 'Sure_' || CAST(o_orderkey % 5 AS VARCHAR) || '_' || split_part(o_orderpriority, '-', -1) AS category FROM orders")(
    lambda t: t.orders.select("o_orderkey", T.compose_category(F.lit("Sure"), (F.col("o_orderkey") % 5).cast("string"), F.col("o_orderpriority")).alias("category")))
query("f10_significant", "SELECT id, truth AS grp, p FROM judged WHERE p > 0.1 AND p < 0.3")(
    lambda t: T.significant(t.judged.select("id", F.col("truth").alias("grp"), "p"), 0.1, 0.3))


@query("f11_by_category", "SELECT CASE WHEN mean_score <= -1.5 THEN 'not_cell' WHEN mean_score <= 1.5 THEN 'unsure' ELSE 'sure' END AS category, count(*) AS n FROM detections GROUP BY ALL")
def _(t):
    parts = T.by_category(t.detections.withColumn("predictions", C.decide_simple("mean_score")))
    return T.union_tagged("category", **parts).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


query("f12_in_bounds", "SELECT id FROM pts3 WHERE x >= 0 AND x < 30 AND y >= 0 AND y < 50 AND z >= 0 AND z < 8")(
    lambda t: voxels.in_bounds(t.pts3, {"x": 30, "y": 50, "z": 8}).select("id"))
query("f13_mask_box", "SELECT x, y, z, CASE WHEN x >= 5 AND x < 30 AND y >= 10 AND y < 40 THEN 0 ELSE label END AS label, 'masked' AS how FROM vox UNION ALL SELECT x - 5, y - 10, z, label, 'cropped' FROM vox WHERE x >= 5 AND x < 30 AND y >= 10 AND y < 40")(
    lambda t: voxels.mask_box(t.vox, {"x": (5, 30), "y": (10, 40)}).withColumn("how", F.lit("masked")).union(voxels.crop_box(t.vox, {"x": (5, 30), "y": (10, 40)}).withColumn("how", F.lit("cropped"))))


J1 = """SELECT a.prep_id, s.id AS scan_run_id, s.rescan_number, l.id AS slide_id, l.slide_physical_id, f.scene_index, f.scene_number, f.channel - 1 AS channel_index, f.active AS tif_active, f.id AS tif_id
FROM animals a JOIN scans s ON a.prep_id = s.prep_id JOIN slides l ON l.scan_run_id = s.id JOIN tifs f ON f.slide_id = l.id WHERE l.slide_status = 'Good'"""
sections = lambda t: T.sections_view(t.animals, t.scans, t.slides, t.tifs)
query("j1_sections_view", J1)(lambda t: sections(t).select("prep_id", "scan_run_id", "rescan_number", "slide_id", "slide_physical_id", "scene_index", "scene_number", "channel_index", "tif_active", "tif_id"))

CENTERS = "SELECT s.prep_id, s.user_id, r.abbreviation, c.id, c.x, c.y, c.z, c.source FROM centers c JOIN sessions s ON c.session_id = s.id JOIN brain_regions r ON r.id = s.brain_region_id WHERE s.active"
query("j2_centers_of", f"SELECT prep_id, user_id, abbreviation, max(id) AS id, arg_max(x, id) AS x, arg_max(y, id) AS y, arg_max(z, id) AS z FROM ({CENTERS} AND s.annotation_type = 'STRUCTURE_COM') GROUP BY ALL")(
    lambda t: T.centers_of(t.sessions, t.centers, t.brain_regions))
query("j3_manual_centers", f"SELECT prep_id, abbreviation, id, x, y, z FROM ({CENTERS}) WHERE source = 'MANUAL' AND abbreviation <> 'R1_R'")(
    lambda t: T.manual_centers(t.sessions, t.centers, t.brain_regions, "R1_R"))


def brain(t, prep, ref=None):
    return t.centroids.where(F.col("prep") == prep).select("abbr", "x", "y", "z")


query("j4_shared_points", "SELECT a.abbr, round(a.x, 4) AS xa, round(b.x, 4) AS xb, round(a.z, 4) AS za FROM centroids a JOIN centroids b ON a.abbr = b.abbr WHERE a.prep = 1 AND b.prep = 2")(
    lambda t: T.shared_points(brain(t, 1), brain(t, 2), "abbr").select("abbr", F.round("x_a", 4).alias("xa"), F.round("x_b", 4).alias("xb"), F.round("z_a", 4).alias("za")))
query("j5_all_keys", "SELECT DISTINCT abbr FROM centroids WHERE prep IN (1, 2, 3)")(lambda t: T.all_keys(brain(t, 1), brain(t, 2), brain(t, 3)))
query("j6_unprocessed", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")(lambda t: T.unprocessed(t.documents.select("doc_id"), t.labels.select("doc_id"), "doc_id"))


@query("j12_cross_edges", """WITH n AS (SELECT n_nationkey AS id, n_regionkey AS reg, count(c_custkey) AS c FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL)
SELECT a.id AS a, b.id AS b, round((a.c / (SELECT max(c) FROM n WHERE reg = 0) + b.c / (SELECT max(c) FROM n WHERE reg = 1)) / 2, 6) AS score FROM n a, n b
WHERE a.reg = 0 AND b.reg = 1 AND a.c > 0 AND b.c > 0 AND (a.c / (SELECT max(c) FROM n WHERE reg = 0) + b.c / (SELECT max(c) FROM n WHERE reg = 1)) / 2 > 0.8""")
def _(t):
    n = t.nation.join(t.customer, F.col("c_nationkey") == F.col("n_nationkey"), "left").groupBy(F.col("n_nationkey").alias("id"), "n_regionkey").agg(F.count("c_custkey").alias("cells"))
    a, b = (n.where(F.col("n_regionkey") == k).select("id", "cells") for k in (0, 1))
    return hierarchy.weighted_edges(a, b, 0.8).select("a", "b", F.round("score", 6).alias("score"))


# --- counts -------------------------------------------------------------------------------

query("a1_section_count", f"SELECT prep_id, count(*) AS n FROM ({J1}) WHERE channel_index = 0 AND rescan_number = 1 GROUP BY prep_id")(lambda t: T.section_count(sections(t)))


def safe(w, h):
    r = lambda c: f"round_even({c} / 1000, 0) * 1000 + 500"
    return f"CASE WHEN NOT ({w} > 10000 AND {h} > 10000) THEN {w} WHEN rotation % 2 = 1 THEN {r(h)} ELSE {r(w)} END AS width, CASE WHEN NOT ({w} > 10000 AND {h} > 10000) THEN {h} WHEN rotation % 2 = 1 THEN {r(w)} ELSE {r(h)} END AS height"


query("a2_safe_dimensions", f"SELECT scan_run_id, {safe('w', 'h')} FROM (SELECT s.id AS scan_run_id, s.rotation, max(f.width) AS w, max(f.height) AS h FROM scans s JOIN slides l ON l.scan_run_id = s.id JOIN tifs f ON f.slide_id = l.id WHERE l.active AND f.active GROUP BY ALL)")(
    lambda t: T.safe_dimensions(t.scans, t.slides, t.tifs))
query("a3_cropped_dimensions", f"SELECT prep_id, {safe('w', 'h')} FROM (SELECT l_suppkey AS prep_id, l_suppkey % 4 AS rotation, max(l_quantity * 10) * 32 AS w, max(l_tax * 5000 + l_quantity) * 32 AS h FROM lineitem GROUP BY ALL)")(
    lambda t: T.cropped_dimensions(t.lineitem.select(F.col("l_suppkey").alias("prep_id"), (F.col("l_suppkey") % 4).alias("rotation"), F.lit(0).alias("x1"), (F.col("l_quantity") * 10).alias("x2"), F.lit(0).alias("y1"), (F.col("l_tax") * 5000 + F.col("l_quantity")).alias("y2"))))
query("a4_modal_annotator", "SELECT prep_id, user_id FROM (SELECT prep_id, user_id, row_number() OVER (PARTITION BY prep_id ORDER BY n DESC, user_id) AS r FROM (SELECT prep_id, user_id, count(*) AS n FROM sessions WHERE active GROUP BY ALL)) WHERE r = 1")(lambda t: T.modal_annotator(t.sessions))
query("a5_annotated_animals", "SELECT DISTINCT prep_id, user_id FROM sessions WHERE active")(lambda t: T.annotated_animals(t.sessions))
query("a6_slide_duplicates", """WITH c AS (SELECT scan_run_id % 50 AS run, regexp_extract(file_name, 'slide(\\d+)', 1) AS number, count(*) AS n FROM slides GROUP BY ALL)
SELECT run, sum(n)::BIGINT AS total, count(*) AS distinct_numbers, coalesce(string_agg(number, ',' ORDER BY number::INT) FILTER (WHERE n > 1), '') AS duplicates FROM c GROUP BY run""")(
    lambda t: T.slide_duplicates(t.slides.withColumn("run", F.col("scan_run_id") % 50), by="run"))
query("a7_check_stack", "SELECT count(*) AS n_files, count(*) = 1000 AS count_right, count(*) FILTER (WHERE size < 200) AS n_small, count(*) > 100 AND (min(size) <> max(size)) AS sizes_differ FROM files")(
    lambda t: T.check_stack(t.files.withColumns({"width": F.col("size"), "height": F.lit(1)}), 1000, 200))
query("a8_stack_status", "SELECT s AS directory, count(id) AS n, count(id) = 50 AS complete FROM (SELECT DISTINCT 'src' || CAST(p_partkey % 25 AS VARCHAR(20)) AS s FROM part) LEFT JOIN files ON directory = s GROUP BY s")(
    lambda t: T.stack_status(t.files, t.part.select(F.concat(F.lit("src"), (F.col("p_partkey") % 25).cast("string")).alias("directory"), F.lit(50).alias("expected")).distinct()))
query("a37_task_progress", """WITH k AS (SELECT o_custkey AS prep_id, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0 END) * 100 AS percent, max(o_orderkey % 10) FILTER (WHERE o_orderstatus = 'F') AS lookup_id FROM orders GROUP BY 1)
SELECT prep_id, round(percent, 6) AS percent, lookup_id, p_name AS description FROM k LEFT JOIN part ON p_partkey = lookup_id""")(
    lambda t: T.task_progress(t.orders.select(F.col("o_custkey").alias("prep_id"), (F.col("o_orderkey") % 10).alias("lookup_id"), (F.col("o_orderstatus") == "F").cast("int").alias("completed")), t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("description"))).withColumn("percent", F.round("percent", 6)))
query("a38_distinct_files", f"SELECT DISTINCT prep_id, slide_id, scene_index FROM ({J1}) WHERE channel_index = 0")(lambda t: T.distinct_files(sections(t), 0))

# --- windows ------------------------------------------------------------------------------

W1 = f"SELECT s.*, row_number() OVER (PARTITION BY s.prep_id ORDER BY CASE WHEN side_sectioned_first = 'DESC' THEN -slide_physical_id ELSE slide_physical_id END, CASE WHEN scene_order = 'DESC' THEN -scene_number ELSE scene_number END, tif_id) - 1 AS section_number FROM ({J1}) s JOIN histology h ON s.prep_id = h.prep_id"
query("w1_number_sections", f"SELECT prep_id, tif_id, section_number FROM ({W1})")(lambda t: T.number_sections(sections(t), t.histology).select("prep_id", "tif_id", F.col("section_number").cast("long").alias("section_number")))
query("w2_latest_session", "SELECT prep_id, brain_region_id, user_id, id, created FROM (SELECT *, row_number() OVER (PARTITION BY prep_id, brain_region_id, user_id ORDER BY created DESC, id DESC) AS r FROM sessions WHERE active) WHERE r = 1")(lambda t: T.latest_session(t.sessions).withColumn("created", F.col("created").cast("timestamp")))
query("w3_polygon_index", "SELECT id, dense_rank() OVER (PARTITION BY session_id ORDER BY section) - 1 AS polygon_index FROM polygons")(lambda t: T.polygon_index(t.polygons).select("id", F.col("polygon_index").cast("long").alias("polygon_index")))
query("w4_polygon_arrays", "SELECT session_id, section, count(*) AS n, string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY point_order, id, x) AS xs FROM polygons GROUP BY session_id, section")(
    lambda t: T.polygon_arrays(t.polygons).select("session_id", "section", F.size("vertices").cast("long").alias("n"), F.array_join(F.transform("vertices", lambda v: v["x"].cast("long").cast("string")), ",").alias("xs")))
query("w5_dedupe_vertices", "SELECT session_id, section, min(id) AS id, first(x ORDER BY id, x) AS x FROM (SELECT session_id, section, point_order % 2 AS point_order, id, x FROM polygons) GROUP BY session_id, section, point_order")(
    lambda t: T.dedupe_vertices(t.polygons.withColumn("point_order", F.col("point_order") % 2)).select("session_id", "section", "id", "x"))


@query("w6_resolve_centers", """WITH c AS (SELECT l_suppkey AS prep_id, l_partkey % 40 AS abbreviation, ((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS id, CAST(floor(l_quantity / 25) AS BIGINT) AS x, l_linenumber % 2 AS y, CAST(0 AS BIGINT) AS z FROM lineitem),
s AS (SELECT prep_id, abbreviation, x, y, z, count(*) AS n, min(id) AS id FROM c GROUP BY ALL),
g AS (SELECT prep_id, abbreviation, count(*) AS places, count(*) FILTER (WHERE n > 1) AS repeated, min(id) FILTER (WHERE n > 1) AS again, min(id) AS f, greatest(max(x) - min(x), max(y) - min(y)) AS spread FROM s GROUP BY ALL),
v AS (SELECT *, CASE WHEN places = 1 OR repeated = 1 THEN 'kept' WHEN places = 2 AND spread <= 1 THEN 'near' ELSE 'conflict' END AS verdict FROM g)
SELECT prep_id, abbreviation, verdict, CASE WHEN verdict = 'conflict' THEN NULL WHEN repeated = 1 THEN again ELSE f END AS id FROM v""")
def _(t):
    c = t.lineitem.select(F.col("l_suppkey").alias("prep_id"), (F.col("l_partkey") % 40).alias("abbreviation"), (((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 100000 + F.col("l_partkey")) * 10000 + F.col("l_suppkey")).alias("id"), F.floor(F.col("l_quantity") / 25).alias("x"), (F.col("l_linenumber") % 2).cast("long").alias("y"), F.lit(0).cast("long").alias("z"))
    return T.resolve_centers(c).select("prep_id", "abbreviation", "verdict", "id")


@query("w7_merge_slides", """WITH m AS (SELECT *, min(id) OVER (PARTITION BY scan_run_id, slide_physical_id) AS master FROM slides),
j AS (SELECT f.id, f.scene_index, m.id AS slide_id, m.master FROM tifs f JOIN m ON f.slide_id = m.id),
b AS (SELECT master, max(scene_index) AS last FROM j WHERE slide_id = master GROUP BY master)
SELECT id, j.master AS slide_id, CASE WHEN slide_id = j.master THEN scene_index ELSE scene_index + coalesce(last, -1) + 1 END AS scene_index FROM j LEFT JOIN b ON j.master = b.master""")
def _(t):
    return T.merge_duplicate_slides(t.slides, t.tifs)[1].select("id", "slide_id", "scene_index")


query("w17_duplicate_sections", f"SELECT prep_id, section_number FROM (SELECT *, slide_physical_id * 10 + scene_index AS k, lead(slide_physical_id * 10 + scene_index) OVER (PARTITION BY prep_id ORDER BY section_number) AS nk FROM ({W1})) WHERE k = nk")(
    lambda t: T.duplicate_sections(T.number_sections(sections(t), t.histology), F.col("slide_physical_id") * 10 + F.col("scene_index")).select("prep_id", F.col("section_number").cast("long").alias("section_number")))

# --- order, samples, sets -----------------------------------------------------------------

query("o1_rank_by_error", "SELECT id, abs(mean_score) AS distance FROM detections")(lambda t: T.rank_by_error(t.detections.select("id", F.abs("mean_score").alias("distance"))))
query("o2_top_k", "SELECT prep, id, rank FROM (SELECT prep, id, row_number() OVER (PARTITION BY prep ORDER BY y DESC, id) AS rank FROM pts) WHERE rank <= 5")(
    lambda t: T.top_k(t.pts, "y", 5, per=["prep"]).select("prep", "id", F.col("rank").cast("long").alias("rank")))
query("o3_export_order", "SELECT id, row_number() OVER (PARTITION BY prep ORDER BY z, x, y, id) - 1 AS row FROM pts3")(lambda t: T.export_order(t.pts3, "prep").select("id", F.col("row").cast("long").alias("row")))
U = "md5('{seed}|' || CAST({k} AS VARCHAR))"
query("o4_sample_for_qc", f"SELECT id, section FROM (SELECT id, section, substr({U.format(seed=3, k='id')}, 1, 13) AS u FROM pts) ORDER BY u, id LIMIT 100")(lambda t: T.sample_for_qc(t.pts.select("id", "section"), 100, seed=3))
query("o5_split_rows", f"SELECT id, substr({U.format(seed=1, k='id')}, 1, 13) < '8000000000000' AS train FROM detections")(lambda t: T.split_rows(t.detections, 0.5, seed=1).select("id", "train"))
query("s1_union_tagged", "SELECT id, x, y, 'truth' AS name, NULL::DOUBLE AS score FROM truths UNION ALL SELECT id, x, y, 'pred', 1.0 FROM preds")(
    lambda t: T.union_tagged("name", truth=t.truths.select("id", "x", "y"), pred=t.preds.select("id", "x", "y", F.lit(1.0).alias("score"))))
query("s2_symmetric_difference", "(SELECT DISTINCT prep_id FROM sessions WHERE active EXCEPT SELECT DISTINCT prep_id FROM sessions WHERE NOT active) UNION ALL (SELECT DISTINCT prep_id FROM sessions WHERE NOT active EXCEPT SELECT DISTINCT prep_id FROM sessions WHERE active)")(
    lambda t: T.symmetric_difference(t.sessions.where("active").select("prep_id"), t.sessions.where("not active").select("prep_id")))
query("s3_intersect_keys", "SELECT abbr FROM centroids WHERE prep = 1 INTERSECT SELECT abbr FROM centroids WHERE prep = 2 INTERSECT SELECT abbr FROM centroids WHERE prep = 3")(
    lambda t: T.intersect_keys(*(brain(t, k).select("abbr") for k in (1, 2, 3))))

# --- upkeep -------------------------------------------------------------------------------

query("t1_upsert", "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 0 THEN -1.0 ELSE o_totalprice END AS x, o_orderkey % 5 = 0 AS fresh FROM orders UNION ALL SELECT -1 - o_orderkey, -1.0, true FROM orders WHERE o_orderkey % 50 = 0")(
    lambda t: T.upsert(
        t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("x"), F.lit(False).alias("fresh")),
        t.orders.where("o_orderkey % 5 = 0").select(F.col("o_orderkey").alias("id"), F.lit(-1.0).alias("x"), F.lit(True).alias("fresh")).union(t.orders.where("o_orderkey % 50 = 0").select((-1 - F.col("o_orderkey")).alias("id"), F.lit(-1.0), F.lit(True))), ["id"]))
query("t2_replace", "SELECT session_id, id, x FROM centers WHERE session_id NOT IN (SELECT session_id FROM centers WHERE x > 48) UNION ALL SELECT session_id, id, x + 1000 FROM centers WHERE x > 48")(
    lambda t: T.replace(t.centers.select("session_id", "id", "x"), t.centers.where("x > 48").select("session_id", "id", (F.col("x") + 1000).alias("x")), ["session_id"]))
query("t3_inactivate", "SELECT id, active AND prep_id <> 7 AS active FROM sessions")(lambda t: T.inactivate(t.sessions, 7).select("id", "active"))
query("t4_assign_active", "SELECT id, EXISTS (SELECT 1 FROM polygons WHERE session_id = s.id AND annotation_type = 'POLYGON_SEQUENCE' AND section = 1) OR EXISTS (SELECT 1 FROM centers WHERE session_id = s.id AND annotation_type = 'STRUCTURE_COM' AND x > 25) OR EXISTS (SELECT 1 FROM centers WHERE session_id = s.id AND annotation_type = 'MARKED_CELL' AND x < 10) AS active FROM sessions s")(
    lambda t: T.assign_active(t.sessions, t.centers.where("x < 10"), t.polygons.where("section = 1"), t.centers.where("x > 25")).select("id", "active"))
query("t5_split_points", "WITH g AS (SELECT DISTINCT prep, section, name FROM pts), s AS (SELECT *, row_number() OVER (PARTITION BY prep ORDER BY section, name) AS session_number FROM g) SELECT p.id, p.prep, s.session_number FROM pts p JOIN s ON p.prep = s.prep AND p.section = s.section AND p.name = s.name")(
    lambda t: T.split_points(t.pts, ["prep", "section"], "name")[1].select("id", "prep", F.col("session_number").cast("long").alias("session_number")))


@query("t6_archive_and_replace", "SELECT id, user_id, 'current' AS place, NULL::BIGINT AS set_id FROM sessions WHERE user_id <> 2 UNION ALL SELECT -1 - id, 2, 'current', NULL FROM sessions WHERE user_id = 3 UNION ALL SELECT id, user_id, 'archive', 9 FROM sessions WHERE user_id = 2")
def _(t):
    s = t.sessions.select("id", "user_id")
    new = s.where("user_id = 3").select((-1 - F.col("id")).alias("id"), F.lit(2).cast("long").alias("user_id"))
    current, archive = T.archive_and_replace(s, s.limit(0).withColumn("set_id", F.lit(None).cast("long")), new, 2, 9)
    return T.union_tagged("place", current=current, archive=archive)


query("t7_update_columns", "SELECT id, CASE WHEN id % 2 = 0 THEN 11.0 ELSE width END AS width, height FROM tifs")(
    lambda t: T.update_columns(t.tifs.select("id", "width", "height"), t.tifs.where("id % 2 = 0").select("id", F.lit(11.0).alias("width")).distinct(), "id"))
