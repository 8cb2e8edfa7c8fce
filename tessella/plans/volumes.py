"""Queries of labelled volumes, pixels, point counts and the region tree."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella.operators import hierarchy as H
from tessella.operators import spatial as S
from tessella.operators import voxels as V
from tessella.plans.registry import query


def rounded(df, *names, digits=5):
    return df.withColumns({n: F.round(n, digits) for n in names})


REGIONS = "SELECT DISTINCT p_partkey % 14 AS id, 'area' || CAST(p_partkey % 14 AS VARCHAR(20)) AS name FROM part"
regions = lambda t: t.bound(REGIONS)
LABELLED = "SELECT p.id, p.prep, v.label FROM pts3 p JOIN vox v ON CAST(trunc(p.x) AS BIGINT) = v.x AND CAST(trunc(p.y) AS BIGINT) = v.y AND CAST(trunc(p.z) AS BIGINT) = v.z"

query("j10_point_labels", LABELLED)(lambda t: V.point_labels(t.pts3, t.vox).select("id", "prep", "label"))
query("j11_all_region_counts", f"SELECT r.id, r.name, count(l.id) AS cells FROM ({REGIONS}) r LEFT JOIN ({LABELLED}) l ON l.label = r.id GROUP BY ALL")(
    lambda t: V.all_region_counts(regions(t), V.point_labels(t.pts3, t.vox).groupBy(F.col("label").alias("id")).agg(F.count(F.lit(1)).alias("cells"))))
query("a9_region_counts", f"SELECT r.id, r.name, count(*) AS cells FROM ({REGIONS}) r JOIN ({LABELLED}) l ON l.label = r.id WHERE l.label <> 0 GROUP BY ALL")(lambda t: V.region_counts(t.pts3, t.vox, regions(t)))
query("a10_region_counts_atlas", """WITH p AS (SELECT id, CAST(trunc((x * 50 * 0.8 + y * 50 * 0.6 + 100) / 10 * 0.1) AS BIGINT) - 1 AS x, CAST(trunc((x * 50 * -0.6 + y * 50 * 0.8 + 900) / 10 * 0.1) AS BIGINT) - 1 AS y, CAST(trunc((z * 50 + 100) / 20 * 0.2) AS BIGINT) - 1 AS z FROM pts3)
SELECT v.label, count(*) AS cells FROM p JOIN vox v ON p.x = v.x AND p.y = v.y AND p.z = v.z WHERE p.x > 0 AND p.x < 60 AND p.y > 0 AND p.y < 60 AND p.z > 0 AND p.z < 20 GROUP BY v.label""")(
    lambda t: V.region_counts_atlas(t.pts3, t.vox, [[0.8, 0.6, 0.0], [-0.6, 0.8, 0.0], [0.0, 0.0, 1.0]], [100.0, 900.0, 100.0], 50, {"x": 60, "y": 60, "z": 20}))
query("a11_hist3d", "WITH m AS (SELECT min(x) AS x0, min(y) AS y0, min(z) AS z0 FROM pts3) SELECT CAST(floor((x - x0) / 4) AS BIGINT) AS bx, CAST(floor((y - y0) / 4) AS BIGINT) AS by, CAST(floor((z - z0) / 4) AS BIGINT) AS bz, x0, y0, z0, count(*) AS n FROM pts3, m GROUP BY ALL")(lambda t: V.hist3d(t.pts3, 4))
query("a12_pool_counts", "SELECT event_type AS region, " + ", ".join(f"count(*) FILTER (WHERE user_id % 4 = {k}) AS \"{k}\"" for k in range(4)) + " FROM events GROUP BY event_type")(
    lambda t: V.pool_counts(t.events.groupBy((F.col("user_id") % 4).alias("brain"), F.col("event_type").alias("region")).agg(F.count(F.lit(1)).alias("n")), [0, 1, 2, 3]))
query("a13_voxel_overlap", "SELECT x, y, z, count(DISTINCT brain) AS brains FROM brain_vox WHERE v > 0 GROUP BY ALL")(lambda t: V.voxel_overlap(t.brain_vox))
query("a14_voxel_multiplicity", "SELECT CAST(trunc(x) AS BIGINT) AS x, CAST(trunc(y) AS BIGINT) AS y, CAST(trunc(z) AS BIGINT) AS z, count(*) AS n FROM pts3 GROUP BY 1, 2, 3")(lambda t: V.voxel_multiplicity(t.pts3))
query("a15_voxels_in_region", "SELECT label, count(*) AS voxels FROM vox GROUP BY label")(lambda t: V.voxels_in_region(t.vox))
query("a16_center_of_mass", "SELECT label, round(avg(x), 5) AS x, round(avg(y) + 7, 5) AS y, round(avg(z), 5) AS z FROM vox GROUP BY label")(lambda t: rounded(V.center_of_mass(t.vox, ["label"], {"y": 7}), "x", "y", "z"))
query("a17_sided_centers", "SELECT label, CASE WHEN z < 3 THEN 'L' ELSE 'R' END AS side, round(avg(x) * 25, 5) AS x, round(avg(y) * 25, 5) AS y, round(avg(z) * 25, 5) AS z FROM vox GROUP BY ALL")(lambda t: rounded(V.sided_centers(t.vox, 3), "x", "y", "z"))
BOUNDS = "SELECT session_id, min(x) AS x0, max(x) - min(x) AS xs, min(y) AS y0, max(y) - min(y) AS ys, min(section) AS s0, max(section) - min(section) AS ss FROM polygons GROUP BY session_id"
query("a18_polygon_bounds", f"SELECT session_id, x0, y0, s0 AS section0, xs AS x_size, round(ys, 5) AS y_size, ss AS section_size FROM ({BOUNDS})")(lambda t: rounded(V.polygon_bounds(t.polygons), "y_size"))
query("a18_merged_bbox", f"SELECT min(x0) AS x0, min(y0) AS y0, min(s0) AS section0, round(max(x0 + xs) - min(x0) + 1, 5) AS x_size, round(max(y0 + ys) - min(y0) + 1, 5) AS y_size, max(s0 + ss) - min(s0) + 1 AS section_size FROM ({BOUNDS})")(
    lambda t: rounded(V.merged_bbox(V.polygon_bounds(t.polygons)), "x_size", "y_size"))
query("a19_mean_by_region", "SELECT abbr, round(avg(x), 5) AS x, round(avg(y), 5) AS y, round(avg(z), 5) AS z FROM centroids GROUP BY abbr")(lambda t: rounded(V.mean_by_region(t.centroids), "x", "y", "z"))
query("a25_intensity_histogram", "SELECT section, value, count(*) AS n FROM pixels SEMI JOIN mask USING (section, x, y) GROUP BY section, value")(lambda t: V.intensity_histogram(t.pixels, t.mask))
query("a26_combined_histogram", "SELECT value, round(count(*) / (SELECT count(DISTINCT section) FROM pixels), 5) AS n FROM pixels GROUP BY value")(lambda t: rounded(V.combined_histogram(t.pixels, 5), "n"))
query("a36_dice", """WITH a AS (SELECT DISTINCT x, y, z, y % 3 AS label FROM brain_vox WHERE brain = 1), b AS (SELECT DISTINCT x, y, z, y % 3 AS label FROM brain_vox WHERE brain = 2)
SELECT coalesce(a.label, b.label) AS label, round(2 * count(a.x + b.x) / (count(a.x) + count(b.x)), 6) AS dice FROM a FULL JOIN b ON a.x = b.x AND a.y = b.y AND a.z = b.z AND a.label = b.label GROUP BY 1""")(
    lambda t: rounded(V.dice(*(t.brain_vox.where(F.col("brain") == k).select("x", "y", "z", (F.col("y") % 3).alias("label")) for k in (1, 2))), "dice", digits=6))

# --- volumes ------------------------------------------------------------------------------

query("v1_merge_volumes", """WITH b AS (SELECT brain, min(x) AS x0, min(y) AS y0, min(z) AS z0, max(x) - min(x) + 1 AS xn, max(y) - min(y) + 1 AS yn, max(z) - min(z) + 1 AS zn FROM brain_vox GROUP BY brain),
m AS (SELECT max(xn) AS xm, max(yn) AS ym, max(zn) AS zm, count(*) AS brains FROM b),
c AS (SELECT CAST(v.x - x0 + floor((xm + 2 - xn) / 2) AS BIGINT) AS x, CAST(v.y - y0 + floor((ym + 2 - yn) / 2) AS BIGINT) AS y, CAST(v.z - z0 + floor((zm + 2 - zn) / 2) AS BIGINT) AS z, count(*) AS n FROM brain_vox v JOIN b ON v.brain = b.brain, m GROUP BY 1, 2, 3)
SELECT x, y, z, n / (SELECT max(n) FROM c) AS share FROM c WHERE n / (SELECT max(n) FROM c) > 0.25""")(lambda t: V.merge_volumes(t.brain_vox, 2, 0.25))


def smooth_sql(sigma, radius):
    k = V.gaussian(sigma, radius)
    values = ", ".join(f"({i}, {w!r})" for i, w in k)
    return f"""WITH k(i, w) AS (VALUES {values}), p AS (SELECT x, y, z, CAST(label AS DOUBLE) AS v FROM vox),
a AS (SELECT x + i AS x, y, z, sum(v * w) AS v FROM p, k GROUP BY 1, 2, 3), b AS (SELECT x, y + i AS y, z, sum(v * w) AS v FROM a, k GROUP BY 1, 2, 3)
SELECT x, y, z + i AS z, round(sum(v * w), 5) AS v FROM b, k GROUP BY 1, 2, 3"""


query("v2_smooth", smooth_sql(0.8, 1))(lambda t: rounded(V.smooth(t.vox.withColumn("v", F.col("label")), 0.8, radius=1), "v"))
query("v3_assemble", "WITH o AS (SELECT label AS region, label * 10 AS id, CAST(floor(label / 2.0) AS BIGINT) AS x0, label AS y0 FROM (SELECT DISTINCT label FROM vox)) SELECT v.x + x0 AS x, v.y + y0 AS y, v.z, CAST(sum(id) AS BIGINT) AS label FROM vox v JOIN o ON v.label = o.region GROUP BY 1, 2, 3")(
    lambda t: V.assemble(t.vox.withColumnRenamed("label", "region"), t.vox.select(F.col("label").alias("region")).distinct().select("region", (F.col("region") * 10).alias("id"), (F.col("region") / 2).alias("x"), F.col("region").alias("y"), F.lit(0.5).alias("z"))))
query("v4_symmetrize", """WITH j AS (SELECT coalesce(a.x, b.x) AS x, coalesce(a.y, b.y) AS y, coalesce(a.z, 6 - b.z) AS z, a.label AS la, b.label AS lb FROM vox a FULL JOIN vox b ON a.x = b.x AND a.y = b.y AND a.z = 6 - b.z)
SELECT * FROM (SELECT x, y, z, CASE WHEN z = 3 THEN la ELSE CAST(floor((coalesce(la, 0) + coalesce(lb, 0)) / 2) AS BIGINT) END AS label FROM j) WHERE label > 0""")(lambda t: V.symmetrize(t.vox, 7))
query("v5_mirror_volume", "SELECT x, y, 6 - z AS z, label FROM vox")(lambda t: V.mirror_volume(t.vox, 7))
query("v6_recenter", "SELECT x - 5 AS x, y - 6 AS y, z - 1 AS z, label FROM vox WHERE x >= 5 AND x < 35 AND y >= 6 AND y < 36 AND z >= 1 AND z < 6")(lambda t: V.recenter(t.vox, {"x": 5, "y": 6, "z": 1}, {"x": 30, "y": 30, "z": 5}))
query("v7_pyramid_labels", "SELECT x, y, z, label FROM (SELECT x, y, z, label, row_number() OVER (PARTITION BY x, y, z ORDER BY n DESC, label) AS r FROM (SELECT CAST(floor(x / 2) AS BIGINT) AS x, CAST(floor(y / 2) AS BIGINT) AS y, z, label, count(*) AS n FROM vox GROUP BY 1, 2, 3, 4)) WHERE r = 1")(lambda t: V.pyramid(t.vox, (2, 2, 1)))
query("v7_pyramid_image", "SELECT CAST(floor(x / 2) AS BIGINT) AS x, CAST(floor(y / 2) AS BIGINT) AS y, CAST(floor(z / 2) AS BIGINT) AS z, sum(label) / 8 AS label FROM vox GROUP BY 1, 2, 3")(lambda t: V.pyramid(t.vox, (2, 2, 2), "image"))
query("v8_chunk_address", "SELECT x, y, z, CAST(floor(x / 16) AS BIGINT) AS chunk_x, CAST(floor(y / 16) AS BIGINT) AS chunk_y, CAST(floor(z / 4) AS BIGINT) AS chunk_z FROM vox")(lambda t: V.chunk_address(t.vox, (8, 8, 2), 1).drop("label"))
query("v9_segment_ids", "SELECT DISTINCT label FROM vox WHERE label <> 0")(lambda t: V.segment_ids(t.vox))
query("v10_apply_mask", "SELECT section, x, y, value, 1 AS factor FROM pixels SEMI JOIN mask USING (section, x, y) UNION ALL SELECT p.section, p.x, p.y, p.value, 4 FROM pixels p WHERE EXISTS (SELECT 1 FROM mask m WHERE m.section = p.section AND m.x = floor(p.x / 4) AND m.y = floor(p.y / 4))")(
    lambda t: V.apply_mask(t.pixels, t.mask).withColumn("factor", F.lit(1)).unionByName(V.apply_mask(t.pixels, t.mask, 4).withColumn("factor", F.lit(4))))
query("v11_threshold_volume", "WITH r AS (SELECT label AS region, x, y, z, x * 7 % 11 AS v FROM vox), c AS (SELECT region, coalesce(quantile_cont(v, 0.9) FILTER (WHERE v > 0), 0.5) AS cut FROM r GROUP BY region) SELECT r.* FROM r JOIN c ON r.region = c.region WHERE v >= cut")(
    lambda t: V.threshold_volume(t.vox.select(F.col("label").alias("region"), "x", "y", "z", (F.col("x") * 7 % 11).alias("v"))))
query("v12_origin_from_center", "WITH c AS (SELECT label AS region, label * 100.0 AS x, label * 50.0 AS y, 20.0 AS z FROM (SELECT DISTINCT label FROM vox)) SELECT c.region, round(any_value(c.x) / 10 - avg(v.x), 5) AS x, round(any_value(c.y) / 10 - avg(v.y), 5) AS y, round(any_value(c.z) / 20 - avg(v.z), 5) AS z FROM c JOIN vox v ON v.label = c.region GROUP BY c.region")(
    lambda t: rounded(V.origin_from_center(t.vox.select(F.col("label").alias("region")).distinct().select("region", (F.col("region") * 100.0).alias("x"), (F.col("region") * 50.0).alias("y"), F.lit(20.0).alias("z")), t.vox.withColumnRenamed("label", "region"), {"x": 10, "y": 10, "z": 20}), "x", "y", "z"))
query("v13_stack_volumes", "SELECT x, y, z, CAST(sum(v) AS DOUBLE) AS total, round(sum(v) / 4.0, 5) AS mean FROM brain_vox GROUP BY x, y, z")(
    lambda t: rounded(V.stack_volumes(t.brain_vox).withColumnRenamed("v", "total").join(V.stack_volumes(t.brain_vox, "mean").withColumnRenamed("v", "mean"), ["x", "y", "z"]), "mean"))
query("w13_rescale_intensity", """WITH q AS (SELECT section, quantile_cont(value, 0.9) AS q90, quantile_cont(value, 0.99) AS q99 FROM pixels WHERE value > 0 GROUP BY section),
c AS (SELECT p.section, x, y, CASE WHEN value > q99 THEN q90 ELSE value END AS v FROM pixels p JOIN q ON p.section = q.section), r AS (SELECT section, quantile_cont(v, 0.99) AS r99 FROM c WHERE v > 0 GROUP BY section)
SELECT c.section, x, y, round(v * 30000 / r99, 4) AS value FROM c JOIN r ON c.section = r.section""")(lambda t: rounded(V.rescale_intensity(t.pixels), "value", digits=4))
query("w14_normalize_bits", "SELECT section, x, y, round_even((value - mn) / (mx - mn) * 256 - 1, 0) AS value FROM (SELECT *, min(value) OVER (PARTITION BY section) AS mn, max(value) OVER (PARTITION BY section) AS mx FROM pixels)")(lambda t: V.normalize_bits(t.pixels, 8))

# --- components of volumes ----------------------------------------------------------------

VOXEL_COMPONENTS = """WITH RECURSIVE n AS (SELECT x * 10000 + y * 100 + z AS id, x, y, z, label FROM vox),
e AS (SELECT a.id AS a, b.id AS b FROM n a JOIN n b ON abs(a.x - b.x) + abs(a.y - b.y) + abs(a.z - b.z) = 1),
w(id, o) AS (SELECT id, id FROM n UNION SELECT w.id, e.b FROM w JOIN e ON w.o = e.a), c AS (SELECT id, min(o) AS comp FROM w GROUP BY id)"""


def voxel_components(t):
    n = t.vox.select((F.col("x") * 10000 + F.col("y") * 100 + F.col("z")).alias("id"), "x", "y", "z", F.col("label").alias("value"))
    found = S.voxel_components(n, 6)
    return n.join(found.hint("merge"), n["id"] == found["node"]).drop("node")


query("c1_voxel_components", f"{VOXEL_COMPONENTS} SELECT id, comp FROM c")(lambda t: voxel_components(t).select("id", "comp"))
query("c7_component_measures", f"{VOXEL_COMPONENTS}, v AS (SELECT n.*, comp FROM n JOIN c ON n.id = c.id), m AS (SELECT comp, CAST(trunc(avg(x)) AS BIGINT) AS cx, CAST(trunc(avg(y)) AS BIGINT) AS cy, CAST(trunc(avg(z)) AS BIGINT) AS cz, count(*) AS voxels, max(z) - min(z) + 1 AS depth FROM v GROUP BY comp) SELECT m.*, (SELECT max(label) FROM v WHERE v.comp = m.comp AND abs(z - cz) <= 5 AND abs(y - cy) <= 10 AND abs(x - cx) <= 10) AS intensity FROM m")(
    lambda t: V.component_measures(voxel_components(t)).select("comp", "cx", "cy", "cz", "voxels", "depth", "intensity"))
query("c8_size_filter", f"{VOXEL_COMPONENTS} SELECT id, comp FROM c WHERE comp IN (SELECT comp FROM c GROUP BY comp HAVING count(*) BETWEEN 2 AND 50)")(lambda t: V.size_filter(voxel_components(t), 2, 50).select("id", "comp"))


@query("c9_find_site", """WITH RECURSIVE b AS (SELECT (section * 100 + x) * 10000000000 + y AS id, section AS z, x, y FROM pixels WHERE value > (SELECT avg(value) + 0.3 * stddev_pop(value) FROM pixels)),
e AS (SELECT a.id AS a, c.id AS b FROM b a JOIN b c ON abs(a.x - c.x) + abs(a.y - c.y) + abs(a.z - c.z) = 1), w(id, o) AS (SELECT id, id FROM b UNION SELECT w.id, e.b FROM w JOIN e ON w.o = e.a),
c AS (SELECT id, min(o) AS comp FROM w GROUP BY id) SELECT comp, count(*) AS voxels FROM c GROUP BY comp ORDER BY voxels DESC, comp LIMIT 3""")
def _(t):
    voxels = t.pixels.select(((F.col("section") * 100 + F.col("x")).cast("long") * 10000000000 + F.col("y")).alias("id"), "x", "y", F.col("section").cast("long").alias("z"), "value")
    return V.find_site(voxels, 0.3, 3).select("comp", "voxels").distinct()


query("g19_mask_boxes", "WITH c AS (SELECT section, y % 3 AS comp, x, y FROM mask), k AS (SELECT section, comp FROM c GROUP BY ALL HAVING count(*) > 100) SELECT section, greatest(min(x) - 2, 0) AS x1, greatest(min(y) - 2, 0) AS y1, max(x) + 2 AS x2, max(y) + 2 AS y2 FROM c SEMI JOIN k USING (section, comp) GROUP BY section")(
    lambda t: V.mask_box_per_section(t.mask.withColumn("comp", F.col("y") % 3)))


@query("g18_rasterize", """WITH b AS (SELECT o_orderkey AS k, o_orderkey % 5 + 3 AS w, o_custkey % 4 + 2 AS h FROM orders) SELECT k, x, y FROM b, range(0, 12) r(x), range(0, 12) s(y) WHERE x <= w AND y <= h AND y * w <= h * (w - x)""")
def _(t):
    # right triangles (0, 0), (w, 0), (0, h)
    b = t.orders.select(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") % 5 + 3).alias("w"), (F.col("o_custkey") % 4 + 2).alias("h"))
    corners = F.array(F.struct(F.lit(0).alias("o"), F.lit(0).alias("x"), F.lit(0).alias("y")), F.struct(F.lit(1).alias("o"), F.col("w").alias("x"), F.lit(0).alias("y")), F.struct(F.lit(2).alias("o"), F.lit(0).alias("x"), F.col("h").alias("y")))
    return V.rasterize(b.select("k", F.explode(corners).alias("c")).select("k", F.col("c.o").alias("point_order"), "c.x", "c.y"), ["k"])


# --- region tree --------------------------------------------------------------------------

CLOSURE = "WITH RECURSIVE w(id, descendant, depth) AS (SELECT id, id, 0 FROM tree UNION ALL SELECT w.id, t.id, depth + 1 FROM w JOIN tree t ON t.parent_id = w.descendant)"
ROLLED = f"{CLOSURE}, r AS (SELECT w.id, CAST(sum(cells) AS BIGINT) AS cells, CAST(sum(voxels) AS BIGINT) AS voxels FROM w JOIN tree_counts c ON c.id = w.descendant GROUP BY w.id)"
query("h1_progeny", f"{CLOSURE} SELECT DISTINCT id, descendant FROM w WHERE depth > 0")(lambda t: H.progeny(t.tree))
query("h2_ancestors", f"{CLOSURE}, u AS (SELECT w.descendant AS id, string_agg(t.name, '>' ORDER BY depth) AS chain FROM w JOIN tree t ON t.id = w.id WHERE depth > 0 AND t.parent_id IS NOT NULL GROUP BY 1) SELECT t.id, coalesce(chain, '') AS chain FROM tree t LEFT JOIN u ON u.id = t.id")(
    lambda t: H.ancestors(t.tree).select("id", F.array_join("chain", ">").alias("chain")))
query("h3_rollup_counts", f"{ROLLED} SELECT t.id, t.name, coalesce(cells, 0) AS cells, coalesce(voxels, 0) AS voxels FROM tree t LEFT JOIN r ON r.id = t.id")(lambda t: H.rollup_counts(t.tree, t.tree_counts, ["cells", "voxels"]))


@query("h4_rollup_pivot", f"{CLOSURE}, c AS (SELECT 10000 + o_custkey AS id, count(*) FILTER (WHERE o_orderkey % 2 = 0) AS b0, count(*) FILTER (WHERE o_orderkey % 2 = 1) AS b1 FROM orders GROUP BY 1) SELECT t.id, t.name, coalesce(CAST(sum(b0) AS BIGINT), 0) AS b0, coalesce(CAST(sum(b1) AS BIGINT), 0) AS b1 FROM tree t JOIN w ON w.id = t.id LEFT JOIN c ON c.id = w.descendant GROUP BY t.id, t.name")
def _(t):
    wide = t.orders.groupBy((10000 + F.col("o_custkey")).alias("id")).agg(*(F.count_if(F.col("o_orderkey") % 2 == k).alias(f"b{k}") for k in (0, 1)))
    return H.rollup_pivot(t.tree, wide, ["b0", "b1"])


query("h5_progeny_to_level", f"{CLOSURE} SELECT descendant AS id, depth FROM w WHERE id = (SELECT id FROM tree WHERE name = 'EUROPE') AND depth BETWEEN 1 AND 2")(lambda t: H.progeny_to_level(t.tree, "EUROPE", 2).select("id", F.col("depth").cast("int").alias("depth")))
query("h6_level_counts", f"{ROLLED} SELECT w.descendant AS id, depth, coalesce(cells, 0) AS cells FROM w LEFT JOIN r ON r.id = w.descendant WHERE w.id = 0 AND (depth = 2 OR (depth BETWEEN 1 AND 1 AND w.descendant NOT IN (SELECT parent_id FROM tree WHERE parent_id IS NOT NULL)))")(
    lambda t: H.level_counts(t.tree, t.tree_counts, "root", 2, ["cells"]).select("id", F.col("depth").cast("int").alias("depth"), "cells"))
LABELS = "SELECT x, y, z, CASE WHEN label < 5 THEN 2000 + label ELSE 10000 + label END AS label FROM vox"
labels = lambda t: t.vox.withColumn("label", F.when(F.col("label") < 5, 2000 + F.col("label")).otherwise(10000 + F.col("label")))


@query("h7_consolidate", f"""{CLOSURE}, n AS (SELECT id, CASE name WHEN 'EUROPE' THEN 0 WHEN 'ASIA' THEN 1 END AS o FROM tree), own AS (SELECT descendant, arg_max(w.id, o) AS owner FROM w JOIN n ON n.id = w.id WHERE o IS NOT NULL GROUP BY descendant)
SELECT x, y, z, coalesce(owner, label) AS label FROM ({LABELS}) v LEFT JOIN own ON own.descendant = v.label""")
def _(t):
    return H.consolidate(labels(t), t.tree, ["EUROPE", "root", "ASIA"]).select("x", "y", "z", "label")


query("h8_isolate", "SELECT x, y, z, CASE WHEN label IN (2, 5, 7) THEN 255 ELSE 0 END AS label, 0 AS even FROM vox UNION ALL SELECT x, y, z, CASE label WHEN 2 THEN 85 WHEN 5 THEN 170 ELSE 255 END, 1 FROM vox WHERE label IN (2, 5, 7)")(
    lambda t: H.isolate(t.vox, [2, 5, 7]).withColumn("even", F.lit(0)).unionByName(H.evenly_valued(t.vox, [2, 5, 7]).withColumn("even", F.lit(1))))
query("h9_density_scale", "WITH c AS (SELECT label, count(*) AS cells FROM vox GROUP BY label) SELECT label, cells, round((cells - (SELECT min(cells) FROM c)) * 255.0 / ((SELECT max(cells) FROM c) - (SELECT min(cells) FROM c)), 5) AS density FROM c")(
    lambda t: rounded(H.density_scale(t.vox.groupBy("label").agg(F.count(F.lit(1)).alias("cells"))), "density"))
query("j15_leaves_in_atlas", f"SELECT id, name FROM tree WHERE id IN (SELECT parent_id FROM tree WHERE parent_id IS NOT NULL) OR id IN (SELECT label FROM ({LABELS}))")(lambda t: H.leaves_in_atlas(t.tree, labels(t)).select("id", "name"))


@query("entry_cells_by_region", f"""{CLOSURE}, l AS (SELECT 10000 + v.label AS id, count(*) AS cells FROM pts3 p JOIN vox v ON CAST(trunc(p.x) AS BIGINT) = v.x AND CAST(trunc(p.y) AS BIGINT) = v.y AND CAST(trunc(p.z) AS BIGINT) = v.z GROUP BY 1)
SELECT t.id, t.name, coalesce(CAST(sum(cells) AS BIGINT), 0) AS cells FROM tree t JOIN w ON w.id = t.id LEFT JOIN l ON l.id = w.descendant GROUP BY t.id, t.name""")
def flagship(t):
    """Cells by region, rolled up the region tree."""
    counts = V.point_labels(t.pts3, t.vox).groupBy((10000 + F.col("label")).alias("id")).agg(F.count(F.lit(1)).alias("cells"))
    return H.rollup_counts(t.tree, counts, ["cells"])
