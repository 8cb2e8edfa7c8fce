"""Queries of transforms, units, contours and alignment errors."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella.operators import transforms as X
from tessella.plans.registry import query
from tessella.plans.volumes import rounded

XYZ = ("x", "y", "z")


def paired(t):
    """Each brain's centres with those of brain 0."""
    a = t.centroids.where("prep <> 0").select("prep", "abbr", *(F.col(c).alias(f"{c}_a") for c in XYZ))
    return a.join(t.centroids.where("prep = 0").select("abbr", *(F.col(c).alias(f"{c}_b") for c in XYZ)), "abbr")


def moved(t):
    """Transforms with known parts: one a brain."""
    angle = F.col("prep") * 0.1
    cells = {"r00": F.cos(angle) * 2, "r01": -F.sin(angle) * 2, "r02": F.lit(0.0), "r10": F.sin(angle) * 2, "r11": F.cos(angle) * 2, "r12": F.lit(0.0), "r20": F.lit(0.0), "r21": F.lit(0.0), "r22": F.lit(2.0), "t0": F.lit(1.0), "t1": F.lit(2.0), "t2": F.lit(3.0)}
    return t.pts3.select("prep").distinct().select("prep", *(v.alias(k) for k, v in cells.items()))


# The SQL twins square the same matrix as a recursion, a row a step.


def fit_sql(pairs: str, scaled: bool) -> str:
    """Common tables ending in ``fitted`` (prep, r00, ..., t2, scale, n) of ``pairs`` (prep, x_a, ..., z_b)."""
    three, four = range(3), range(4)
    p = lambda i, j: f"p{min(i, j)}{max(i, j)}"
    upper = [(i, j) for i in four for j in range(i, 4)]

    class Term(str):  # so that the operator's own formulas write SQL
        __add__ = lambda a, b: Term(f"({a} + {str(b)})")
        __sub__ = lambda a, b: Term(f"({a} - {str(b)})")
        __rmul__ = lambda a, k: Term(f"({k} * {a})")

    n = X.quaternion_matrix(lambda i, j: Term(f"(c{i}{j} - mb{i} * ma{j})"))
    turn = X.rotation_of(lambda i, j: Term(p(i, j)))
    sums = ", ".join([*(f"avg({c}_{s}) AS m{s}{i}" for s in "ab" for i, c in enumerate(XYZ)), *(f"avg({c}_a * {c}_a) AS q{i}" for i, c in enumerate(XYZ)), *(f"avg({XYZ[i]}_b * {XYZ[j]}_a) AS c{i}{j}" for i in three for j in three)])
    squares = " + ".join(f"{p(i, j)} * {p(i, j)}" for i in four for j in four)
    start = ", ".join(f"CASE WHEN norm > 0 THEN {p(i, j)} / norm ELSE 0 END + {float(i == j) + (X.TIE if i == j == 0 else 0)!r}::DOUBLE AS {p(i, j)}" for i, j in upper)
    step = ", ".join(f"({' + '.join(f'{p(i, k)} * {p(k, j)}' for k in four)}) / ({squares})" for i, j in upper)
    cells = [f"r{i}{j}" for i in three for j in three]
    scale = f"CASE WHEN {str(scaled).upper()} AND q0 + q1 + q2 - ma0 * ma0 - ma1 * ma1 - ma2 * ma2 > 0 THEN ({' + '.join(f'r{i}{j} * (c{i}{j} - mb{i} * ma{j})' for i in three for j in three)}) / (q0 + q1 + q2 - ma0 * ma0 - ma1 * ma1 - ma2 * ma2) ELSE 1 END"
    return f"""sums AS (SELECT prep, CAST(count(*) AS DOUBLE) AS n, {sums} FROM ({pairs}) GROUP BY prep HAVING count(*) >= 3),
quat AS (SELECT prep, {', '.join(f'{v} AS {p(*k)}' for k, v in n.items())} FROM sums), normed AS (SELECT *, sqrt({squares}) AS norm FROM quat),
squared(prep, k, {', '.join(p(*k) for k in upper)}) AS (SELECT prep, 0 AS k, {start} FROM normed UNION ALL SELECT prep, k + 1, {step} FROM squared WHERE k < {X.SQUARINGS}),
turned AS (SELECT s.*, {', '.join(f'{turn[i][j]} AS r{i}{j}' for i in three for j in three)} FROM squared JOIN sums s USING (prep) WHERE k = {X.SQUARINGS}), scaled AS (SELECT *, {scale} AS scale FROM turned),
fitted AS (SELECT prep, {', '.join(f'scale * {c} AS {c}' for c in cells)}, {', '.join(f"mb{i} - scale * ({' + '.join(f'r{i}{j} * ma{j}' for j in three)}) AS t{i}" for i in three)}, scale, n FROM scaled)"""


FITTED = "prep, " + ", ".join(f"round({c}, 4) AS {c}" for c in [*(f"r{i}{j}" for i in range(3) for j in range(3)), "t0", "t1", "t2", "scale", "n"])
PAIRED = "SELECT a.prep, a.x AS x_a, a.y AS y_a, a.z AS z_a, b.x AS x_b, b.y AS y_b, b.z AS z_b FROM centroids a JOIN centroids b ON a.abbr = b.abbr WHERE a.prep <> 0 AND b.prep = 0"


@query("g1_fit_similarity", f"WITH RECURSIVE {fit_sql(PAIRED, True)} SELECT {FITTED} FROM fitted")
def _(t):
    f = X.fit_similarity(paired(t), ["prep"])
    return rounded(f, *(c for c in f.columns if c != "prep"), digits=4)


@query("g2_fit_rigid", f"WITH RECURSIVE {fit_sql(PAIRED, False)} SELECT {FITTED} FROM fitted")
def _(t):
    f = X.fit_rigid(paired(t), ["prep"])
    return rounded(f, *(c for c in f.columns if c != "prep"), digits=4)


@query("g3_align_brains", f"WITH RECURSIVE {fit_sql(PAIRED + " AND contains(a.abbr, '_')", True)} SELECT {FITTED} FROM fitted UNION ALL SELECT DISTINCT prep, 1, 0, 0, 0, 1, 0, 0, 0, 1, 0, 0, 0, 1, 0 FROM centroids WHERE prep = 0")
def _(t):
    f = X.align_brains(t.centroids, 0, subset=F.contains("abbr", F.lit("_")))
    return rounded(f, *(c for c in f.columns if c != "prep"), digits=4)


MOVED = "SELECT id, round(2 * (cos(prep * 0.1) * x - sin(prep * 0.1) * y) + 1, 8) AS x, round(2 * (sin(prep * 0.1) * x + cos(prep * 0.1) * y) + 2, 8) AS y, round(2 * z + 3, 8) AS z FROM pts3"
query("g4_apply_transform", MOVED)(lambda t: rounded(X.apply_transform(t.pts3, moved(t), ["prep"]).select("id", *XYZ), *XYZ, digits=8))
query("g5_apply_inverse", "SELECT id, round(x, 8) AS x, round(y, 8) AS y, round(z, 8) AS z FROM pts3")(
    lambda t: rounded(X.apply_inverse(X.apply_transform(t.pts3, moved(t), ["prep"]), moved(t), ["prep"]).select("id", *XYZ), *XYZ, digits=8))
query("g6_to_um", """WITH p AS (SELECT c.id, s.prep_id, c.x, c.y, c.z FROM centers c JOIN sessions s ON c.session_id = s.id), u AS (SELECT prep_id, orientation FROM histology)
SELECT p.id, round(x * CASE orientation WHEN 'coronal' THEN 20 ELSE 0.325 END, 8) AS x, round(y * CASE orientation WHEN 'horizontal' THEN 20 ELSE 0.325 END, 8) AS y, round(z * CASE orientation WHEN 'sagittal' THEN 20 ELSE 0.325 END, 8) AS z FROM p JOIN u ON p.prep_id = u.prep_id""")(
    lambda t: rounded(X.to_um(t.centers.join(t.sessions.select(F.col("id").alias("session_id"), "prep_id"), "session_id"), t.scans.select("prep_id", "resolution", "zresolution").distinct(), t.histology).select("id", *XYZ), *XYZ, digits=8))
query("g7_resample_points", "SELECT id, round(x * 0.5, 8) AS x, round(y * 2.5, 8) AS y, round(z * 0.1, 8) AS z FROM pts3")(lambda t: rounded(X.resample_points(t.pts3, {"x": 10, "y": 10, "z": 10}, {"x": 5, "y": 25, "z": 1}).select("id", *XYZ), *XYZ, digits=8))
query("g8_reorient", "SELECT id, round(z, 8) AS x, round(60 - (x + 1), 8) AS y, round(y, 8) AS z FROM pts3")(lambda t: rounded(X.reorient(t.pts3, ("2", "-0", "1"), {"x": 60, "y": 100, "z": 20}).select("id", *XYZ), *XYZ, digits=8))
TF = "SELECT animal, section, rotation, xshift, yshift FROM section_tf"
query("g9_matrix_and_back", f"SELECT animal, section, round(cos(rotation), 5) AS a, round(100 + xshift - (cos(rotation) * 100 - sin(rotation) * 50), 4) AS tx, round(rotation, 5) AS rotation, round(yshift, 4) AS yshift FROM ({TF})")(
    lambda t: rounded(rounded(X.matrix_to_params(X.params_to_matrix(t.section_tf, (100, 50)).drop("rotation", "xshift", "yshift"), (100, 50)).select("animal", "section", "a", "tx", "rotation", "yshift"), "a", "rotation"), "tx", "yshift", digits=4))
query("g10_scale_transform", f"SELECT animal, section, round((100 + xshift - (cos(rotation) * 100 - sin(rotation) * 50)) * 32, 3) AS tx FROM ({TF})")(lambda t: rounded(X.scale_transform(X.params_to_matrix(t.section_tf, (100, 50))).select("animal", "section", "tx"), "tx", digits=3))
# the chain as a recursion over sections, from the middle up and down
CHAIN = """WITH RECURSIVE s AS (SELECT animal, section, rotation, xshift, yshift, CAST(floor(count(*) OVER (PARTITION BY animal) / 2) AS BIGINT) AS mid FROM section_tf),
up(animal, section, angle, dx, dy) AS (SELECT animal, section, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM s WHERE section = mid
  UNION ALL SELECT s.animal, s.section, u.angle + s.rotation, u.dx + cos(u.angle) * xshift - sin(u.angle) * yshift, u.dy + sin(u.angle) * xshift + cos(u.angle) * yshift FROM up u JOIN s ON s.animal = u.animal AND s.section = u.section + 1),
down(animal, section, angle, dx, dy) AS (SELECT animal, section, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM s WHERE section = mid
  UNION ALL SELECT s.animal, d.section - 1, d.angle - s.rotation, d.dx - (cos(d.angle - s.rotation) * xshift - sin(d.angle - s.rotation) * yshift), d.dy - (sin(d.angle - s.rotation) * xshift + cos(d.angle - s.rotation) * yshift) FROM down d JOIN s ON s.animal = d.animal AND s.section = d.section AND d.section > 0),
c AS (SELECT * FROM up UNION SELECT * FROM down)"""
query("w15_compose_to_midpoint", f"{CHAIN} SELECT animal, section, round(angle, 5) AS angle, round(dx, 4) AS dx, round(dy, 4) AS dy FROM c")(
    lambda t: rounded(rounded(X.compose_to_midpoint(t.section_tf), "angle"), "dx", "dy", digits=4))
query("g11_align_points", f"{CHAIN}, p AS (SELECT event_id AS id, user_id AS animal, event_id % 20 AS section, value AS x, value / 2 AS y FROM events) SELECT id, round(cos(angle) * x - sin(angle) * y + dx, 3) AS x, round(sin(angle) * x + cos(angle) * y + dy, 3) AS y FROM p JOIN c ON c.animal = p.animal AND c.section = p.section")(
    lambda t: rounded(X.align_points(section_points(t), X.compose_to_midpoint(t.section_tf)).select("id", "x", "y"), "x", "y", digits=3))
query("g21_align_contours", f"{CHAIN}, p AS (SELECT event_id AS id, user_id AS animal, event_id % 20 AS section, value / 32 + (500 - 200) / 2 - dx AS x, value / 2 / 32 + (400 - 100) / 2 - dy AS y, angle FROM events JOIN c ON c.animal = user_id AND c.section = event_id % 20) SELECT id, round(cos(angle) * x + sin(angle) * y, 3) AS x, round(cos(angle) * y - sin(angle) * x, 3) AS y FROM p")(
    lambda t: rounded(X.align_contours(section_points(t), t.section_tf.select("animal", "section", F.lit(200).alias("width"), F.lit(100).alias("height")), X.compose_to_midpoint(t.section_tf), (500, 400)).select("id", "x", "y"), "x", "y", digits=3))


def section_points(t):
    return t.events.select(F.col("event_id").alias("id"), F.col("user_id").alias("animal"), (F.col("event_id") % 20).alias("section"), F.col("value").alias("x"), (F.col("value") / 2).alias("y"))


query("g12_orient_and_place", """WITH p AS (SELECT id, x % 100 AS x, y % 60 AS y, section % 4 AS q, CASE section % 3 WHEN 0 THEN 'none' WHEN 1 THEN 'flip' ELSE 'flop' END AS flip FROM pts),
t AS (SELECT id, flip, q, CASE q WHEN 0 THEN x WHEN 1 THEN y WHEN 2 THEN 99 - x ELSE 59 - y END AS tx, CASE q WHEN 0 THEN y WHEN 1 THEN 99 - x WHEN 2 THEN 59 - y ELSE x END AS ty, CASE WHEN q % 2 = 1 THEN 60 ELSE 100 END AS tw, CASE WHEN q % 2 = 1 THEN 100 ELSE 60 END AS th FROM p)
SELECT id, round(CASE WHEN flip = 'flop' THEN tw - 1 - tx ELSE tx END + floor((120 - tw) / 2), 8) AS x, round(CASE WHEN flip = 'flip' THEN th - 1 - ty ELSE ty END + floor((120 - th) / 2), 8) AS y FROM t""")(
    lambda t: rounded(X.orient_and_place(
        t.pts.select("id", (F.col("x") % 100).alias("x"), (F.col("y") % 60).alias("y"), F.col("section").alias("prep_id")),
        t.pts.select(F.col("section").alias("prep_id")).distinct().select("prep_id", F.lit(100).alias("width"), F.lit(60).alias("height"), (F.col("prep_id") % 4).alias("rotation"), F.when(F.col("prep_id") % 3 == 0, "none").when(F.col("prep_id") % 3 == 1, "flip").otherwise("flop").alias("flip")),
        (120, 120)).select("id", "x", "y"), "x", "y", digits=8))
query("g13_offset_table", """WITH r AS (SELECT * FROM centroids WHERE prep = 0), k AS (SELECT c.abbr, count(DISTINCT c.prep) AS n FROM centroids c JOIN r ON c.abbr = r.abbr GROUP BY c.abbr HAVING count(DISTINCT c.prep) >= 3),
j AS (SELECT b.prep, k.abbr || '(' || k.n || ')' AS region, c.x - r.x AS dx, c.y - r.y AS dy, c.z - r.z AS dz FROM (SELECT DISTINCT prep FROM centroids) b CROSS JOIN k JOIN r ON r.abbr = k.abbr LEFT JOIN centroids c ON c.prep = b.prep AND c.abbr = k.abbr),
d AS (SELECT *, sqrt(dx * dx + dy * dy + dz * dz) AS dist FROM j)
SELECT prep, region, 'dx' AS measure, round(dx, 4) AS value FROM d UNION ALL SELECT prep, region, 'dy', round(dy, 4) FROM d UNION ALL SELECT prep, region, 'dz', round(dz, 4) FROM d UNION ALL SELECT prep, region, 'dist', round(dist, 4) FROM d""")(
    lambda t: rounded(X.offset_table(t.centroids, t.centroids.where("prep = 0")), "value", digits=4))
ERRORS = "SELECT a.abbr, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) AS distance, CASE greatest(abs(a.x - b.x), abs(a.y - b.y), abs(a.z - b.z)) WHEN abs(a.x - b.x) THEN 'x' WHEN abs(a.y - b.y) THEN 'y' ELSE 'z' END AS axis FROM centroids a JOIN centroids b ON a.abbr = b.abbr WHERE a.prep = 1 AND b.prep = 2"
query("g14_alignment_error", f"SELECT abbr, round(distance, 4) AS distance, axis FROM ({ERRORS})")(lambda t: rounded(X.alignment_error(t.centroids.where("prep = 1"), t.centroids.where("prep = 2")), "distance", digits=4))
query("g15_midplane", "SELECT round(coalesce(avg(z) FILTER (WHERE NOT contains(abbr, '_')), 0), 4) AS mid FROM centroids WHERE prep = 1")(lambda t: rounded(X.midplane(t.centroids.where("prep = 1")), "mid", digits=4))
SIDED = "SELECT split_part(abbr, '_', 1) || CASE WHEN prep = 1 THEN '_L' ELSE '_R' END AS abbr, x, y, z FROM centroids WHERE prep IN (1, 2)"
query("g16_mirror_centers", f"WITH c AS ({SIDED}) SELECT a.abbr, round(coalesce(r.x, a.x), 4) AS x, round(coalesce(r.y, a.y), 4) AS y, round(coalesce(r.z - 2 * (r.z - 5), a.z), 4) AS z FROM c a LEFT JOIN c r ON a.abbr LIKE '%L' AND r.abbr = replace(a.abbr, '_L', '_R')")(
    lambda t: rounded(X.mirror_centers(t.centroids.where("prep in (1, 2)").select(F.concat(F.split("abbr", "_")[0], F.when(F.col("prep") == 1, "_L").otherwise("_R")).alias("abbr"), *XYZ), 5), *XYZ, digits=4))
query("g17_assign_tiles", "SELECT id, CAST(floor(y / 199) * 2 + floor(x / 500) AS BIGINT) AS tile, round(x - floor(x / 500) * 500, 8) AS tile_x, round(y - floor(y / 199) * 199, 8) AS tile_y FROM pts WHERE x >= 0 AND x < 1000 AND y >= 0 AND y < 995")(
    lambda t: rounded(X.assign_tiles(t.pts, 1001, 999).select("id", "tile", "tile_x", "tile_y"), "tile_x", "tile_y", digits=8))
query("g20_sort_from_center", """WITH u AS (SELECT DISTINCT l_orderkey AS k, l_quantity AS x, l_partkey % 40 AS y FROM lineitem), m AS (SELECT *, atan2(y - avg(y) OVER (PARTITION BY k), x - avg(x) OVER (PARTITION BY k)) AS a FROM u)
SELECT k, x, y, row_number() OVER (PARTITION BY k ORDER BY round(a, 9) DESC, x, y) - 1 AS point_order FROM m""")(
    lambda t: X.sort_from_center(t.lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_quantity").alias("x"), (F.col("l_partkey") % 40).alias("y")), ["k"]).withColumn("point_order", F.col("point_order").cast("long")))
query("w8_densify", """WITH p AS (SELECT session_id, section, x, y, row_number() OVER w - 1 AS i, coalesce(lead(x) OVER w, first_value(x) OVER w) AS nx, coalesce(lead(y) OVER w, first_value(y) OVER w) AS ny FROM polygons WINDOW w AS (PARTITION BY session_id, section ORDER BY id))
SELECT session_id, section, 2 * i AS point_order, x, round(y, 8) AS y FROM p UNION ALL SELECT session_id, section, 2 * i + 1, (x + nx) / 2, round((y + ny) / 2, 8) FROM p""")(
    lambda t: rounded(X.densify(t.polygons.withColumn("point_order", F.col("id")), ["session_id", "section"]).withColumn("point_order", F.col("point_order").cast("long")), "y", digits=8))
query("j17_positional_join", """WITH l AS (SELECT prep, x, y, z, row_number() OVER (PARTITION BY prep ORDER BY abbr) AS i FROM centroids WHERE NOT (prep = 3 AND abbr LIKE 'R1%')), c AS (SELECT prep, abbr, row_number() OVER (PARTITION BY prep ORDER BY abbr) AS i FROM centroids)
SELECT l.prep, c.abbr, round(l.x * 10, 4) AS x, round(l.y * 10, 4) AS y, round(l.z * 20, 4) AS z FROM l JOIN c ON l.prep = c.prep AND l.i = c.i WHERE l.prep <> 3 OR NOT EXISTS (SELECT 1 FROM centroids WHERE prep = 3 AND abbr LIKE 'R1%')""")(
    lambda t: rounded(X.positional_join(t.centroids.where("not (prep = 3 and abbr like 'R1%')"), t.centroids, "prep", "abbr", {"x": 10, "y": 10, "z": 20}), *XYZ, digits=4))
