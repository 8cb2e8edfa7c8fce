"""Queries of distance joins, components, groups, thresholds and matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella.functions import columns as C
from tessella.operators import spatial as S
from tessella.operators import tables as T
from tessella.plans.registry import query
from tessella.plans.volumes import rounded

DIST = "sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2)"
PAIRS = f"SELECT a.prep, a.section, a.id AS id_a, b.id AS id_b, {DIST} AS dist FROM pts a JOIN pts b ON a.prep = b.prep AND a.section = b.section AND a.id < b.id WHERE {DIST} < 8"
KEYS = ["prep", "section"]
PLACED = "(SELECT DISTINCT id, prep, section, x, y FROM pts)"
# the join's links by point: an id, its class and its number of links stand for the pairs
query("j7_close_pairs", f"""WITH RECURSIVE e AS (SELECT a.id AS a, b.id AS b FROM {PLACED} a JOIN {PLACED} b ON a.prep = b.prep AND a.section = b.section AND a.id <> b.id WHERE {DIST} < 8), w(id, o) AS (SELECT id, id FROM pts UNION SELECT w.id, e.b FROM w JOIN e ON w.o = e.a),
c AS (SELECT id, min(o) AS comp FROM w GROUP BY id), n AS (SELECT a AS id, count(*) AS links FROM e GROUP BY a) SELECT c.id, comp, coalesce(links, 0) AS links FROM c LEFT JOIN n ON c.id = n.id""")(lambda t: S.linked_points(t.pts, 8, keys=KEYS))
NEAR = f"SELECT a.prep, a.section, a.id AS id_a, b.id AS id_b, {DIST} AS dist FROM truths a JOIN preds b ON a.prep = b.prep AND a.section = b.section"
query("j8_nearest", f"SELECT id_a AS id, match, round(dist, 5) AS dist FROM (SELECT id_a, id_b AS match, dist, row_number() OVER (PARTITION BY id_a ORDER BY dist, id_b) AS r FROM ({NEAR}) WHERE dist < 40) WHERE r = 1")(
    lambda t: rounded(S.nearest(t.truths, t.preds, KEYS, 40).select("id", "match", "dist"), "dist"))
query("j9_nearest_in_tile", f"SELECT id_a AS id, match, round(dist, 5) AS dist FROM (SELECT id_a, id_b AS match, dist, row_number() OVER (PARTITION BY id_a ORDER BY dist, id_b) AS r FROM ({NEAR} WHERE CAST(floor(a.x / 250) AS BIGINT) = CAST(floor(b.x / 250) AS BIGINT) AND CAST(floor(a.y / 250) AS BIGINT) = CAST(floor(b.y / 250) AS BIGINT))) WHERE r = 1")(
    lambda t: rounded(S.nearest_in_tile(tiled(t.truths), tiled(t.preds), [*KEYS, "tx", "ty"]).select("id", "match", "dist"), "dist"))


def tiled(df):
    return df.withColumns({"tx": F.floor(F.col("x") / 250), "ty": F.floor(F.col("y") / 250)})


query("j13_exclude_detections", f"""WITH n AS (SELECT DISTINCT a.id FROM detections a JOIN pts b ON a.animal = b.prep AND a.section = b.section AND b.name = 'A' WHERE {DIST} < 5)
SELECT id FROM detections WHERE section <> 3 AND id NOT IN (SELECT id FROM detections WHERE x < 100) AND id NOT IN (SELECT id FROM n)""")(
    lambda t: S.exclude_detections(t.detections, t.spark.range(3, 4).select(F.col("id").cast("int").alias("section")).join(t.detections.select("animal").distinct()), t.detections.where("x < 100").select("id"), t.pts.where("name = 'A'").withColumnRenamed("prep", "animal"), 5).select("id"))
query("j14_border_flag", "SELECT p.id, EXISTS (SELECT 1 FROM mask m WHERE m.section = p.section AND m.x = CAST(trunc(p.x / 32) AS BIGINT) AND m.y = CAST(trunc(p.y / 32) AS BIGINT)) AS border FROM pts p")(
    lambda t: S.border_flag(t.pts, t.mask.select("section", F.col("y").alias("row"), F.col("x").alias("col"))).select("id", "border"))
BOXES = "SELECT DISTINCT x * 10000 + y * 100 + z AS id, x AS bx, y AS by, z AS bz FROM vox"
query("j16_neighbour_boxes", f"WITH b AS ({BOXES}) SELECT a.id, o.id AS other FROM b a JOIN b o ON abs(a.bx - o.bx) <= 1 AND abs(a.by - o.by) <= 1 AND abs(a.bz - o.bz) <= 1 AND a.id <> o.id")(
    lambda t: S.neighbour_boxes(t.vox.select((F.col("x") * 10000 + F.col("y") * 100 + F.col("z")).alias("id"), F.col("x").alias("bx"), F.col("y").alias("by"), F.col("z").alias("bz")).distinct()))

# --- components and groups ----------------------------------------------------------------

GROUPS = f"""WITH RECURSIVE e AS (SELECT id_a AS a, id_b AS b FROM ({PAIRS}) UNION ALL SELECT id_b, id_a FROM ({PAIRS})), w(id, o) AS (SELECT id, id FROM pts UNION SELECT w.id, e.b FROM w JOIN e ON w.o = e.a),
g AS (SELECT p.id, p.name, p.section, p.prep, c.comp FROM pts p JOIN (SELECT id, min(o) AS comp FROM w GROUP BY id) c ON p.id = c.id), l AS (SELECT comp, string_agg(name, ',' ORDER BY name) AS labels, count(*) AS members FROM g GROUP BY comp)"""
grouped = lambda t: S.group_close(t.pts.dropDuplicates(["id"]), 8, keys=KEYS)
labelled = lambda t: S.group_labels(grouped(t))
query("c1_components", f"{GROUPS} SELECT DISTINCT id, comp FROM g")(lambda t: grouped(t).select("id", "comp"))
query("c2_group_close", f"{GROUPS.replace('FROM pts p JOIN', 'FROM (SELECT DISTINCT * FROM pts) p JOIN')} SELECT comp, labels, members FROM l")(lambda t: labelled(t).select("comp", F.array_join("labels", ",").alias("labels"), "members"))
query("a21_signature_counts", f"{GROUPS.replace('FROM pts p JOIN', 'FROM (SELECT DISTINCT * FROM pts) p JOIN')} SELECT labels AS signature, count(*) AS groups FROM l GROUP BY labels")(lambda t: S.group_signature_counts(labelled(t)))
query("c3_group_matches", f"{GROUPS.replace('FROM pts p JOIN', 'FROM (SELECT DISTINCT * FROM pts) p JOIN')} SELECT comp FROM l WHERE contains(labels, 'A') AND NOT contains(labels, 'N') AND members BETWEEN 1 AND 2")(
    lambda t: labelled(t).where(C.group_matches("labels", ["A"], ["N"], 1, 2)).select("comp"))
query("c4_groups_with_signature", f"{GROUPS.replace('FROM pts p JOIN', 'FROM (SELECT DISTINCT * FROM pts) p JOIN')} SELECT g.id, g.comp FROM g JOIN l ON g.comp = l.comp WHERE labels IN ('A,R', 'N,N')")(
    lambda t: S.groups_with_signature(g := grouped(t), S.group_labels(g), [["R", "A"], ["N", "N"]]).select("id", "comp"))
query("a34_inter_rater", f"{GROUPS.replace('FROM pts p JOIN', 'FROM (SELECT DISTINCT * FROM pts) p JOIN')}, k AS (SELECT comp, string_agg(CASE WHEN section % 2 = 0 THEN 'ann' ELSE 'bob' END || CASE name WHEN 'A' THEN '_POSITIVE' ELSE '_NEGATIVE' END, ',' ORDER BY CASE WHEN section % 2 = 0 THEN 'ann' ELSE 'bob' END || CASE name WHEN 'A' THEN '_POSITIVE' ELSE '_NEGATIVE' END) AS s, count(*) AS n FROM g GROUP BY comp) SELECT CASE WHEN n = 1 THEN 'one_only' ELSE 'other' END AS kind, count(*) AS groups FROM k GROUP BY 1")(
    lambda t: S.inter_rater(S.group_labels(grouped(t).withColumn("name", F.concat(F.when(F.col("section") % 2 == 0, "ann").otherwise("bob"), F.when(F.col("name") == "A", "_POSITIVE").otherwise("_NEGATIVE")))), "ann", "bob"))
query("a20_section_spread", f"""WITH m AS (SELECT prep, section, count(*) AS n, avg(x) AS x, avg(y) AS y FROM pts GROUP BY ALL HAVING count(*) >= 2), d AS (SELECT a.prep, a.section, max({DIST}) AS spread FROM pts a JOIN pts b ON a.prep = b.prep AND a.section = b.section GROUP BY ALL)
SELECT m.prep, m.section, n, round(x, 4) AS x, round(y, 4) AS y, round(spread, 4) AS spread FROM m JOIN d ON m.prep = d.prep AND m.section = d.section""")(lambda t: rounded(S.section_spread(t.pts), "x", "y", "spread", digits=4))
RUNS = f"""WITH RECURSIVE l AS (SELECT a.id AS a, b.id AS b FROM pts a JOIN pts b ON a.prep = b.prep AND b.section = a.section + 1 WHERE {DIST} < 6), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l), w(id, o) AS (SELECT id, id FROM pts UNION SELECT w.id, e.b FROM w JOIN e ON w.o = e.a),
c AS (SELECT id, min(o) AS comp FROM w GROUP BY id)"""
query("w16_cross_section_runs", f"{RUNS} SELECT sections, count(*) AS cells FROM (SELECT comp, count(DISTINCT section) AS sections FROM pts p JOIN c ON p.id = c.id GROUP BY comp) GROUP BY sections")(lambda t: S.cross_section_runs(t.pts, 6))


SMALLEST = "w{n}(id, o) AS (SELECT id, id FROM {rows} UNION SELECT w{n}.id, e{n}.b FROM w{n} JOIN e{n} ON w{n}.o = e{n}.a), c{n} AS (SELECT id, min(o) AS comp FROM w{n} GROUP BY id)"
EDGES = "e{n} AS (SELECT a, b FROM l{n} UNION ALL SELECT b, a FROM l{n})"


@query("c5_dedupe_detections", f"""WITH RECURSIVE p AS (SELECT DISTINCT id, prep, section, x, y FROM pts), l1 AS (SELECT a.id AS a, b.id AS b FROM p a JOIN p b ON a.prep = b.prep AND a.section = b.section AND a.id < b.id WHERE {DIST} < 8), {EDGES.format(n=1)}, {SMALLEST.format(n=1, rows="p")},
k AS (SELECT p.* FROM p JOIN c1 ON p.id = c1.id WHERE comp = p.id), l2 AS (SELECT a.id AS a, b.id AS b FROM k a JOIN k b ON a.prep = b.prep AND b.section = a.section + 1 WHERE {DIST} < 8), {EDGES.format(n=2)}, {SMALLEST.format(n=2, rows="k")}
SELECT k.id, section FROM k JOIN c2 ON k.id = c2.id WHERE comp = k.id""")
def _(t):
    return S.dedupe_detections(t.pts.select("id", "prep", "section", "x", "y").distinct(), 8).select("id", "section")


@query("c6_merge_thresholds", f"""WITH RECURSIVE d AS (SELECT DISTINCT id, animal, section, x, y, mean_score, id % 3 AS threshold, CASE WHEN mean_score > 1.5 THEN 'sure' WHEN mean_score > -1.5 THEN 'unsure' ELSE 'null' END AS kind FROM detections), p AS (SELECT * FROM d WHERE kind <> 'null'),
l1 AS (SELECT a.id AS a, b.id AS b FROM p a JOIN p b ON a.animal = b.animal AND a.section = b.section AND a.id < b.id WHERE {DIST} < 8), {EDGES.format(n=1)}, {SMALLEST.format(n=1, rows="p")},
m AS (SELECT comp, count(DISTINCT kind) > 1 AS mixed FROM p JOIN c1 ON p.id = c1.id GROUP BY comp), k AS (SELECT p.*, c1.comp FROM p JOIN c1 ON p.id = c1.id JOIN m ON m.comp = c1.comp WHERE NOT mixed OR kind = 'sure'),
f AS (SELECT comp, threshold AS winner FROM (SELECT *, row_number() OVER (PARTITION BY comp ORDER BY mean_score DESC, id) AS r FROM k) WHERE r = 1)
SELECT id, threshold, kind, mean_score FROM k JOIN f ON k.comp = f.comp WHERE threshold = winner
UNION ALL SELECT id, threshold, kind, mean_score FROM d WHERE kind = 'null' AND CAST('0x' || substr(md5('0|' || id), 1, 13) AS BIGINT) / CAST(16 ** 13 AS DOUBLE) < 0.01""")
def _(t):
    d = t.detections.distinct().withColumns({"threshold": F.col("id") % 3, "kind": F.when(F.col("mean_score") > 1.5, "sure").when(F.col("mean_score") > -1.5, "unsure").otherwise("null")})
    return S.merge_thresholds(d, 8, ["animal", "section"]).select("id", "threshold", "kind", "mean_score")


query("c10_own_chunk", "SELECT DISTINCT id, CAST(floor(z / 4) AS BIGINT) AS chunk FROM pts3")(lambda t: S.own_chunk(t.pts3, 4, 1).select("id", "chunk").distinct())
@query("c11_link_planes", """WITH RECURSIVE r AS (SELECT id, prep, x, y, section AS z FROM pts),
l AS (SELECT a.id AS a, b.id AS b FROM r a JOIN r b ON a.prep = b.prep AND b.z = a.z + 1 AND abs(a.x - b.x) <= 7 AND abs(a.y - b.y) <= 7), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l), w(id, o) AS (SELECT id, id FROM r UNION SELECT w.id, e.b FROM w JOIN e ON w.o = e.a),
c AS (SELECT id, min(o) AS comp FROM w GROUP BY id) SELECT comp, round(avg(x), 8) AS x, round(avg(y), 8) AS y, round(avg(z), 8) AS z, count(*) AS planes FROM r JOIN c ON r.id = c.id GROUP BY comp""")
def _(t):
    r = t.pts.select("id", "prep", "x", "y", F.col("section").alias("z"))
    return rounded(S.link_planes(r, 7, ["prep"]), "x", "y", "z", digits=8)


# --- matching: the SQL twins fold each section's pairs, the shortest first, into those taken ---


def greedy_sql(rows: str, by: str) -> str:
    """Taken pairs (id_a, id_b, dist) of each group of ``rows``."""
    step = "lambda s, e: CASE WHEN list_contains(s.a, e.a[1]) OR list_contains(s.b, e.b[1]) THEN s ELSE {'a': s.a || e.a, 'b': s.b || e.b, 'd': s.d || e.d} END"
    folded = f"SELECT {by}, list_reduce(list({{'a': [id_a], 'b': [id_b], 'd': [dist]}} ORDER BY dist, id_a, id_b), {step}) AS r FROM ({rows}) GROUP BY {by}"
    return f"SELECT {by}, unnest(r.a) AS id_a, unnest(r.b) AS id_b, unnest(r.d) AS dist FROM ({folded})"


TAKEN = greedy_sql(f"SELECT * FROM ({NEAR}) WHERE dist < 40", "prep, section")


@query("m1_match_points", f"SELECT id_a, id_b, round(dist, 5) AS dist FROM ({TAKEN})")
def _(t):
    return rounded(S.match_points(t.truths, t.preds, 40, KEYS).select("id_a", "id_b", "dist"), "dist")


@query("m1_match_counts", f"""WITH a AS (SELECT prep, section, count(*) AS n FROM truths GROUP BY ALL), b AS (SELECT prep, section, count(*) AS n FROM preds GROUP BY ALL), k AS (SELECT prep, section, count(*) AS n FROM ({TAKEN}) GROUP BY ALL)
SELECT coalesce(a.prep, b.prep) AS prep, coalesce(a.section, b.section) AS section, coalesce(k.n, 0) AS tp, coalesce(a.n, 0) - coalesce(k.n, 0) AS fn, coalesce(b.n, 0) - coalesce(k.n, 0) AS fp
FROM a FULL JOIN b ON a.prep = b.prep AND a.section = b.section LEFT JOIN k ON k.prep = coalesce(a.prep, b.prep) AND k.section = coalesce(a.section, b.section)""")
def _(t):
    pairs = S.match_points(t.truths, t.preds, 40, KEYS)
    return S.match_counts(t.truths, t.preds, pairs, KEYS)


SWEPT = greedy_sql(f"SELECT cutoff, p.* FROM ({NEAR}) p, (VALUES (5.0::DOUBLE), (20.0), (40.0)) c(cutoff) WHERE dist < cutoff", "cutoff, prep, section")
query("m2_match_sweep", f"""WITH k AS (SELECT cutoff, count(*) AS n FROM ({SWEPT}) GROUP BY cutoff), a AS (SELECT count(*) AS n FROM truths), b AS (SELECT count(*) AS n FROM preds)
SELECT c.cutoff, coalesce(k.n, 0) AS tp, a.n - coalesce(k.n, 0) AS fn, b.n - coalesce(k.n, 0) AS fp FROM (VALUES (5.0::DOUBLE), (20.0), (40.0)) c(cutoff) LEFT JOIN k ON k.cutoff = c.cutoff, a, b""")(
    lambda t: S.match_sweep(t.truths, t.preds, [5, 20, 40], KEYS))


# without a cutoff the smaller side of each tile is used up
TILES = "SELECT prep, section, CAST(floor(x / 250) AS BIGINT) AS tx, CAST(floor(y / 250) AS BIGINT) AS ty, count(*) AS n FROM {} GROUP BY 1, 2, 3, 4"


@query("m3_match_all", f"""WITH a AS ({TILES.format("truths")}), b AS ({TILES.format("preds")}), j AS (SELECT coalesce(a.n, 0) AS na, coalesce(b.n, 0) AS nb FROM a FULL JOIN b USING (prep, section, tx, ty)),
s AS (SELECT 'pairs' AS side, sum(least(na, nb)) AS n FROM j UNION ALL SELECT 'truth', sum(na - least(na, nb)) FROM j UNION ALL SELECT 'prediction', sum(nb - least(na, nb)) FROM j) SELECT side, CAST(n AS BIGINT) AS n FROM s WHERE n > 0 OR side = 'pairs'""")
def _(t):
    pairs, rest = S.match_all(tiled(t.truths), tiled(t.preds), [*KEYS, "tx", "ty"])
    return pairs.select("id_a", "id_b").groupBy().agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit("pairs")).unionByName(rest.groupBy("side").agg(F.count(F.lit(1)).alias("n")))


COUNTS = "SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS tp, count(*) FILTER (WHERE event_type = 'view') AS fp, count(*) FILTER (WHERE event_type = 'error') AS fn FROM events GROUP BY user_id"


@query("m4_prf1", f"SELECT user_id, tp, fp, fn, CASE WHEN tp + fp = 0 THEN 0 ELSE round(tp / (tp + fp), 6) END AS \"precision\", CASE WHEN tp + fn = 0 THEN 0 ELSE round(tp / (tp + fn), 6) END AS recall, CASE WHEN tp = 0 THEN 0 ELSE round(2 * tp / (2 * tp + fp + fn), 6) END AS f1 FROM ({COUNTS})")
def _(t):
    n = lambda k: F.count_if(F.col("event_type") == k)
    c = t.events.groupBy("user_id").agg(n("click").alias("tp"), n("view").alias("fp"), n("error").alias("fn"))
    return rounded(S.prf1(c), "precision", "recall", "f1", digits=6)


CHANCE = "CAST('0x' || substr(md5('0|' || {id}), 1, 13) AS BIGINT) / CAST(16 ** 13 AS DOUBLE)"
STEPS = "(VALUES (0.1::DOUBLE), (0.3), (0.5), (0.7), (0.9)) c(threshold)"
PASSED = greedy_sql(f"SELECT threshold, p.* FROM ({NEAR}) p, {STEPS} WHERE dist < 40 AND {CHANCE.format(id='id_b')} >= threshold", "threshold, prep, section")
query("m5_f1_sweep", f"""WITH k AS (SELECT threshold, count(*) AS n FROM ({PASSED}) GROUP BY threshold), a AS (SELECT count(*) AS n FROM truths), b AS (SELECT threshold, count(*) AS n FROM preds, {STEPS} WHERE {CHANCE.format(id='id')} >= threshold GROUP BY threshold),
m AS (SELECT c.threshold, coalesce(k.n, 0) AS tp, coalesce(b.n, 0) - coalesce(k.n, 0) AS fp, a.n - coalesce(k.n, 0) AS fn FROM {STEPS} LEFT JOIN k ON k.threshold = c.threshold LEFT JOIN b ON b.threshold = c.threshold, a)
SELECT threshold, tp, fp, fn, CASE WHEN tp + fp = 0 THEN 0 ELSE round(tp / (tp + fp), 6) END AS "precision", CASE WHEN tp + fn = 0 THEN 0 ELSE round(tp / (tp + fn), 6) END AS recall, CASE WHEN tp = 0 THEN 0 ELSE round(2 * tp / (2 * tp + fp + fn), 6) END AS f1 FROM m""")(
    lambda t: rounded(S.f1_sweep(t.truths, t.preds.withColumn("p", T.unit_hash("id")), [0.1, 0.3, 0.5, 0.7, 0.9], 40, "prep", keys=["section"]), "precision", "recall", "f1", digits=6))

TAGGED = """WITH g AS (SELECT o_custkey * 5 + o_orderkey % 5 AS comp, o_orderkey % 7 AS k FROM orders), l AS (SELECT comp, list_sort(list(CASE k WHEN 0 THEN 'computer_sure' WHEN 1 THEN 'computer_unsure' WHEN 2 THEN 'manual_positive' WHEN 3 THEN 'manual_negative' ELSE 'manual_train' END)) AS s FROM g GROUP BY comp)"""


@query("c3_qc_categories", f"{TAGGED} " + " UNION ALL ".join(
    "SELECT comp, '{n}' AS category FROM l WHERE {w}".format(n=name, w=" AND ".join([*(f"list_contains(s, '{v}')" for v in include), *(f"NOT list_contains(s, '{v}')" for v in exclude), f"len(s) >= {least}", *([f"len(s) <= {most}"] if most else [])]))
    for name, (include, exclude, least, most) in C.QC_CATEGORIES.items()))
def _(t):
    k = F.col("o_orderkey") % 7
    name = F.when(k == 0, "computer_sure").when(k == 1, "computer_unsure").when(k == 2, "manual_positive").when(k == 3, "manual_negative").otherwise("manual_train")
    g = t.orders.select((F.col("o_custkey") * 5 + F.col("o_orderkey") % 5).alias("comp"), name.alias("name"))
    return S.group_labels(g).select("comp", F.explode(C.qc_categories("labels")).alias("category"))
