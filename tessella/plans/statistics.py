"""Queries of scores, distributions, thresholds, patches and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella.functions import columns as C
from tessella.operators import scores as K
from tessella.operators import spatial as S
from tessella.plans.registry import query
from tessella.plans.volumes import rounded

query("a22_score_stats", "SELECT id % 1000 AS id, round(avg(score), 5) AS mean, round(stddev_pop(score), 5) AS std, round(quantile_cont(score, 0.5), 5) AS median, round(quantile_cont(score, 0.9) - quantile_cont(score, 0.1), 5) AS spread FROM scores GROUP BY 1")(
    lambda t: rounded(K.score_stats(t.scores.withColumn("id", F.col("id") % 1000)), "mean", "std", "median", "spread"))
query("a23_size_outliers", "SELECT id, size FROM files WHERE abs(size - (SELECT avg(size) FROM files)) > 2 * (SELECT stddev_pop(size) FROM files)")(lambda t: K.size_outliers(t.files, 2).select("id", "size"))
query("a24_size_std", "SELECT round(stddev_pop(strlen(html) / 1024), 5) AS std_kb, count(html) AS n FROM pages")(lambda t: rounded(K.size_stats(t.pages, "html", "page_id")[0], "std_kb"))
query("a24_size_largest", "SELECT page_id, strlen(html) / 1024 AS kb FROM pages ORDER BY kb DESC, page_id LIMIT 10")(lambda t: K.size_stats(t.pages, "html", "page_id")[1])
COLS = ("l_quantity", "l_discount", "l_tax")
query("a27_pairwise_covariance", """WITH v AS (SELECT CASE WHEN l_linenumber = 1 THEN NULL ELSE l_quantity END AS a, CASE WHEN l_linenumber = 2 THEN NULL ELSE l_discount END AS b, l_tax AS c FROM lineitem)
SELECT i, j, n, round(s / n - m, 5) AS cov FROM (SELECT 0 AS i, 0 AS j, count(a * a) AS n, sum(a * a) AS s, avg(a) * avg(a) AS m FROM v UNION ALL SELECT 0, 1, count(a * b), sum(a * b), avg(a) * avg(b) FROM v UNION ALL SELECT 0, 2, count(a * c), sum(a * c), avg(a) * avg(c) FROM v
UNION ALL SELECT 1, 1, count(b * b), sum(b * b), avg(b) * avg(b) FROM v UNION ALL SELECT 1, 2, count(b * c), sum(b * c), avg(b) * avg(c) FROM v UNION ALL SELECT 2, 2, count(c * c), sum(c * c), avg(c) * avg(c) FROM v)""")(
    lambda t: rounded(K.pairwise_covariance(missing(t), ["a", "b", "c"]), "cov"))


def missing(t):
    return t.lineitem.select(F.when(F.col("l_linenumber") != 1, F.col("l_quantity")).alias("a"), F.when(F.col("l_linenumber") != 2, F.col("l_discount")).alias("b"), F.col("l_tax").alias("c"))


def dimension(t):
    """Components of the longest embedding."""
    return t.embeddings.select(F.max(F.size("embedding"))).first()[0] or 0


def embedding_columns(t, n):
    return t.embeddings.select("vec_id", "label", *(F.get("embedding", F.lit(i)).cast("double").alias(f"f{i}") for i in range(n)))


@query("a28_pca")
def _(t):
    d = dimension(t)
    return rounded(K.pca_from_cov(K.pairwise_covariance(embedding_columns(t, d), [f"f{i}" for i in range(d)]), d), "eigenvalue", digits=6).select("component", "eigenvalue")


# eigenvalues and vectors are pinned down by residuals of nothing, lengths of 1, and the matrix's own trace and squares
@query("a28_pca_residuals", """WITH e AS (SELECT vec_id, unnest(range(len(embedding))) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings), m AS (SELECT i, avg(v) AS m FROM e GROUP BY i),
c AS (SELECT a.i, b.i AS j, avg(a.v * b.v) - any_value(p.m) * any_value(q.m) AS cov FROM e a JOIN e b ON a.vec_id = b.vec_id JOIN m p ON p.i = a.i JOIN m q ON q.i = b.i GROUP BY a.i, b.i)
SELECT count(*) FILTER (WHERE i = j) AS components, CAST(0 AS DOUBLE) AS residual, CAST(0 AS DOUBLE) AS length_error, round(sum(cov) FILTER (WHERE i = j), 4) AS trace, round(sum(cov * cov), 4) AS squares FROM c""")
def _(t):
    d = dimension(t)
    cov = K.pairwise_covariance(embedding_columns(t, d), [f"f{i}" for i in range(d)])
    off = K.eigen_residuals(cov, K.pca_from_cov(cov, d))
    whole = off.agg(F.count(F.lit(1)).alias("components"), F.max("residual").alias("residual"), F.max("length_error").alias("length_error"), F.sum("eigenvalue").alias("trace"), F.sum(F.col("eigenvalue") * F.col("eigenvalue")).alias("squares"))
    return rounded(whole, "residual", "length_error", "trace", "squares", digits=4)


PATCH = "SELECT section AS patch, x, y, value, value % 3 AS channel, CASE WHEN value > 8000 THEN 1 ELSE 0 END AS v FROM pixels"
patch = lambda t: t.pixels.select(F.col("section").alias("patch"), "x", "y", "value", (F.col("value") % 3).alias("channel"), (F.col("value") > 8000).cast("int").alias("v"))
query("a29_patch_moments", f"""WITH p AS ({PATCH}), m AS (SELECT patch, sum(v)::DOUBLE AS m00, sum(x * v)::DOUBLE AS m10, sum(y * v)::DOUBLE AS m01, sum(x * y * v)::DOUBLE AS m11, sum(x * x * v)::DOUBLE AS m20, sum(y * y * v)::DOUBLE AS m02 FROM p GROUP BY patch)
SELECT patch, m00, m10, m11, round((m20 - m10 * m10 / m00 + m02 - m01 * m01 / m00) / (m00 * m00), 6) AS h0, round(((m20 - m10 * m10 / m00 - m02 + m01 * m01 / m00) ** 2 + 4 * (m11 - m10 * m01 / m00) ** 2) / m00 ** 4, 6) AS h1 FROM m""")(
    lambda t: rounded(K.patch_moments(patch(t)).select("patch", "m00", "m10", "m11", "h0", "h1"), "h0", "h1", digits=6))
query("a30_patch_contrast", f"WITH p AS ({PATCH}) SELECT patch, channel, coalesce(round((avg(value) FILTER (WHERE v > 0) - avg(value)) / (avg(value) FILTER (WHERE v > 0) + avg(value)), 6), 0) AS contrast FROM p GROUP BY patch, channel")(
    lambda t: rounded(K.patch_contrast(patch(t).withColumnRenamed("v", "mask")), "contrast", digits=6))
MEAN = f"SELECT 0 AS channel, x, y, avg(value) AS value FROM ({PATCH}) GROUP BY x, y"
query("a31_mean_patch", f"WITH m AS ({MEAN}) SELECT channel, x, y, round((value - avg(value) OVER ()) / stddev_pop(value) OVER (), 5) AS value FROM m")(lambda t: rounded(K.mean_patch(patch(t).withColumn("channel", F.lit(0))), "value"))


CELLS = "SELECT i - 2 AS i, j - 2 AS j, a.w * c.v AS kx, b.w * d.v AS ky FROM (VALUES (0, -1), (1, -2), (2, 0), (3, 2), (4, 1)) a(i, w), (VALUES (0, -1), (1, -2), (2, 0), (3, 2), (4, 1)) b(j, w), (VALUES (0, 1), (1, 4), (2, 6), (3, 4), (4, 1)) c(jj, v), (VALUES (0, 1), (1, 4), (2, 6), (3, 4), (4, 1)) d(ii, v) WHERE c.jj = b.j AND d.ii = a.i"
SLOPES = "SELECT {by}x - i AS x, y - j AS y, sum(value * kx) AS gx, sum(value * ky) AS gy FROM {rows}, cells GROUP BY {by}x - i, y - j HAVING count(*) = 25"


@query("a32_patch_gradients", f"""WITH cells AS ({CELLS}), p AS ({PATCH}), m0 AS (SELECT x, y, avg(value) AS value FROM p GROUP BY x, y), m1 AS (SELECT x, y, (value - avg(value) OVER ()) / stddev_pop(value) OVER () AS value FROM m0),
g AS ({SLOPES.format(by="patch, ", rows="p")}), h AS ({SLOPES.format(by="", rows="m1")}), s AS (SELECT patch, sqrt(avg(gx * gx + gy * gy) / 2) AS s FROM g GROUP BY patch), t AS (SELECT sqrt(avg(gx * gx + gy * gy) / 2) AS s FROM h)
SELECT g.patch, 0 AS channel, round(avg((g.gx * h.gx + g.gy * h.gy) / (s.s * t.s)), 4) AS corr, round(max(s.s), 4) AS energy FROM g JOIN h ON g.x = h.x AND g.y = h.y JOIN s ON s.patch = g.patch, t GROUP BY g.patch""")
def _(t):
    p = patch(t).withColumn("channel", F.lit(0)).select("patch", "channel", "x", "y", "value")
    return rounded(K.patch_gradient_features(p, K.mean_patch(p)), "corr", "energy", digits=4)


query("a33_cohen_d", """WITH s AS (SELECT l_shipdate::DATE AS d, l_linenumber AS region, l_quantity AS v, l_returnflag AS g FROM lineitem), k AS (SELECT region, count(*) FILTER (WHERE g = 'A') AS n1, avg(v) FILTER (WHERE g = 'A') AS m1, var_samp(v) FILTER (WHERE g = 'A') AS v1, count(*) FILTER (WHERE g = 'R') AS n2, avg(v) FILTER (WHERE g = 'R') AS m2, var_samp(v) FILTER (WHERE g = 'R') AS v2 FROM s GROUP BY region)
SELECT region, round((m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)), 6) AS d FROM k""")(lambda t: rounded(K.cohen_d(t.lineitem, "l_linenumber", "l_returnflag", "l_quantity", "A", "R").withColumnRenamed("l_linenumber", "region"), "d", digits=6))
query("a35_error_summary", "SELECT animal, count(mean_score) AS n, min(mean_score) AS min, max(mean_score) AS max, round(avg(mean_score), 5) AS mean FROM detections GROUP BY animal")(lambda t: rounded(K.error_summary(t.detections, "mean_score", ["animal"]), "mean"))

# --- distributions ------------------------------------------------------------------------

query("w9_score_cdf", "SELECT id, round((CASE WHEN truth = 1 THEN row_number() OVER (PARTITION BY truth ORDER BY p, id) ELSE row_number() OVER (PARTITION BY truth ORDER BY p DESC, id) END - 1) / count(*) OVER (PARTITION BY truth), 6) AS cdf FROM judged")(
    lambda t: rounded(K.score_cdf(t.judged, "truth", "p").select("id", "cdf"), "cdf", digits=6))
KS = """WITH c AS (SELECT k, v, count(*) FILTER (WHERE s = 'a') AS a, count(*) FILTER (WHERE s = 'b') AS b FROM ({rows}) GROUP BY k, v),
g AS (SELECT k, v, sum(a) OVER w / sum(a) OVER (PARTITION BY k) - sum(b) OVER w / sum(b) OVER (PARTITION BY k) AS gap, sum(a) OVER (PARTITION BY k) AS n1, sum(b) OVER (PARTITION BY k) AS n2 FROM c WINDOW w AS (PARTITION BY k ORDER BY v)), r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY abs(gap) DESC, v) AS o FROM g)"""
query("w10_ks_statistic", KS.format(rows="SELECT l_suppkey % 10 AS k, l_extendedprice AS v, CASE l_returnflag WHEN 'A' THEN 'a' ELSE 'b' END AS s FROM lineitem WHERE l_returnflag IN ('A', 'R')") + " SELECT k, round(gap, 6) AS gap, v AS at, CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2 FROM r WHERE o = 1")(
    lambda t: rounded(K.ks_statistic(*(t.lineitem.where(F.col("l_returnflag") == f).select((F.col("l_suppkey") % 10).alias("k"), F.col("l_extendedprice").alias("v")) for f in ("A", "R")), ["k"]), "gap", digits=6))


def box_values(t):
    d = t.lineitem.select((F.col("l_suppkey") % 27).alias("box"), F.col("l_linenumber").alias("feature"), F.col("l_quantity").alias("v"))
    return d.withColumn("v", F.when(F.col("box") % 5 == 0, F.col("v") * 2).otherwise(F.col("v")))


BOX_VALUES = "SELECT l_suppkey % 27 AS box, l_linenumber AS feature, CASE WHEN l_suppkey % 27 % 5 = 0 THEN l_quantity * 2 ELSE l_quantity END AS v FROM lineitem"
# the gap's p-value by the same series as the operator's
P_VALUE = "CASE WHEN lam < 0.2 THEN 1 ELSE least(greatest(list_sum(list_transform(range(1, 21), lambda k: 2 * (-1) ** (k - 1) * exp(-2 * k * k * lam * lam))), 0), 1) END"
TESTED = "SELECT *, (sqrt(n1 * n2 / (n1 + n2)) + 0.12 + 0.11 / sqrt(n1 * n2 / (n1 + n2))) * abs(gap) AS lam FROM r WHERE o = 1 AND n1 > 0 AND n2 > 0"
BACKGROUND = "SELECT {'b': box, 'f': feature} AS k, v, 'a' AS s FROM bv UNION ALL SELECT {'b': q.box, 'f': bv.feature}, v, 'b' FROM bv JOIN (SELECT DISTINCT box, feature FROM bv) q ON q.feature = bv.feature"
DIFFERENT = f'''SELECT k.b AS box, k.f AS feature, gap, v AS "at", CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, {P_VALUE} AS p FROM ({TESTED}) WHERE {P_VALUE} < 0.01'''


@query('w11_ks_test', f'''WITH bv AS ({BOX_VALUES}), {KS.format(rows=BACKGROUND)[5:]} SELECT box, feature, round(gap, 6) AS gap, "at", n1, n2, round(p, 6) AS p FROM ({DIFFERENT})''')
def _(t):
    return rounded(K.ks_test(box_values(t), box_values(t).select("feature", "v")), "gap", "p", digits=6)


@query("w12_box_relations", f"""WITH bv AS ({BOX_VALUES}), sig AS (WITH {KS.format(rows=BACKGROUND)[5:]} SELECT box, feature FROM ({DIFFERENT})), g3 AS (SELECT DISTINCT box AS id, box // 9 AS bx, box // 3 % 3 AS by, box % 3 AS bz FROM bv),
near AS (SELECT a.id, b.id AS other FROM g3 a JOIN g3 b ON a.id < b.id AND abs(a.bx - b.bx) <= 1 AND abs(a.by - b.by) <= 1 AND abs(a.bz - b.bz) <= 1),
rel AS (WITH {KS.format(rows="SELECT {'i': id, 'o': other, 'f': feature} AS k, v, 'a' AS s FROM near JOIN bv ON bv.box = id UNION ALL SELECT {'i': id, 'o': other, 'f': feature}, v, 'b' FROM near JOIN bv ON bv.box = other")[5:]} SELECT k.i AS id, k.o AS other, k.f AS feature, {P_VALUE} AS p FROM ({TESTED}))
SELECT rel.feature, CASE WHEN s1.box IS NULL OR s2.box IS NULL THEN 'not_significant' WHEN p > 0.1 THEN 'agree' WHEN p < 0.01 THEN 'disagree' ELSE 'neither' END AS relation, count(*) AS pairs
FROM rel LEFT JOIN sig s1 ON s1.box = id AND s1.feature = rel.feature LEFT JOIN sig s2 ON s2.box = other AND s2.feature = rel.feature GROUP BY 1, 2""")
def _(t):
    v = box_values(t)
    boxes = v.select(F.col("box").alias("id")).distinct().select("id", F.floor(F.col("id") / 9).alias("bx"), F.floor(F.col("id") / 3 % 3).alias("by"), (F.col("id") % 3).alias("bz"))
    significant = K.ks_test(v, v.select("feature", "v")).select("box", "feature")
    return K.box_relations(v, significant, S.neighbour_boxes(boxes)).groupBy("feature", "relation").agg(F.count(F.lit(1)).alias("pairs"))


# --- thresholds ---------------------------------------------------------------------------

CUTS = [0.1, 0.25, 0.5, 0.75, 0.9]
LEVELS = ", ".join(f"({c})" for c in CUTS)
query("m6_pixel_confusion", f"""SELECT t AS threshold, count(*) FILTER (WHERE truth > 0.4 AND p > t) AS tp, count(*) FILTER (WHERE NOT truth > 0.4 AND p > t) AS fp, count(*) FILTER (WHERE NOT truth > 0.4 AND NOT p > t) AS tn, count(*) FILTER (WHERE truth > 0.4 AND NOT p > t) AS fn,
round(count(*) FILTER (WHERE truth > 0.4 AND p > t) / count(*) FILTER (WHERE truth > 0.4), 6) AS tpr, round(count(*) FILTER (WHERE NOT truth > 0.4 AND p > t) / count(*) FILTER (WHERE NOT truth > 0.4), 6) AS fpr FROM judged, (SELECT CAST(c AS DOUBLE) AS t FROM (VALUES {LEVELS}) v(c)) GROUP BY t""")(
    lambda t: rounded(K.pixel_confusion(t.judged.withColumnRenamed("truth", "y"), CUTS), "tpr", "fpr", digits=6))
query("m7_roc", "SELECT round(t, 9) AS threshold, round(count(*) FILTER (WHERE truth > 0.4 AND p > t) / count(*) FILTER (WHERE truth > 0.4), 6) AS tpr, round(count(*) FILTER (WHERE NOT truth > 0.4 AND p > t) / count(*) FILTER (WHERE NOT truth > 0.4), 6) AS fpr FROM judged, (SELECT pow(10, -4 + 4 * i / 199) AS t FROM range(0, 200) r(i)) GROUP BY t")(
    lambda t: rounded(rounded(K.roc(t.judged.withColumnRenamed("truth", "y")), "threshold", digits=9), "tpr", "fpr", digits=6))
query("m8_error_by_threshold", f"SELECT t AS threshold, round(count(*) FILTER (WHERE truth = 1 AND p <= t) / count(*) FILTER (WHERE truth = 1), 6) AS error_1, round(count(*) FILTER (WHERE truth <> 1 AND p > t) / count(*) FILTER (WHERE truth <> 1), 6) AS error_0 FROM judged, (SELECT CAST(c AS DOUBLE) AS t FROM (VALUES {LEVELS}) v(c)) GROUP BY t")(
    lambda t: rounded(K.error_by_threshold(t.judged, CUTS, "truth", "p"), "error_1", "error_0", digits=6))
query("m9_selective_stats", "SELECT count(*) AS n, count(*) FILTER (WHERE p BETWEEN 0.3 AND 0.7) AS abstained, round(count(*) FILTER (WHERE (p > 0.7 AND truth = 1) OR (p < 0.3 AND truth <> 1)) / count(*) FILTER (WHERE p NOT BETWEEN 0.3 AND 0.7), 6) AS accuracy, round(count(*) FILTER (WHERE p > 0.7 AND truth = 1) / count(*) FILTER (WHERE p > 0.7), 6) AS positive, round(count(*) FILTER (WHERE p < 0.3 AND truth <> 1) / count(*) FILTER (WHERE p < 0.3), 6) AS negative FROM judged")(
    lambda t: rounded(K.selective_stats(t.judged, 0.3, 0.7, "truth", "p"), "accuracy", "positive", "negative", digits=6))
query("m10_error_ranges", """WITH d AS (SELECT s AS sample, p FROM judged, range(20) r(s) WHERE truth = 1 AND CAST('0x' || substr(md5(s || '|' || id), 1, 8) AS BIGINT) < 0.5 * 16 ** 8), c AS (SELECT CAST(i AS DOUBLE) / 20 AS threshold FROM range(1, 20) t(i)),
e AS (SELECT threshold, CAST(least(floor(count(*) FILTER (WHERE p <= threshold) / count(*) * 10), 9) AS BIGINT) AS bin FROM d, c GROUP BY sample, threshold) SELECT bin, min(threshold) AS low, max(threshold) AS high FROM e GROUP BY bin""")(lambda t: K.error_ranges(t.judged.select("id", F.col("truth").alias("label"), F.col("p").alias("score")), 20, 0.5, [i / 20 for i in range(1, 20)]))
query("m11_confusion", "SELECT truth, count(*) FILTER (WHERE k = -2) AS \"-2\", count(*) FILTER (WHERE k = 0) AS \"0\", count(*) FILTER (WHERE k = 2) AS \"2\" FROM (SELECT label AS truth, CASE WHEN mean_score <= -1.5 THEN -2 WHEN mean_score <= 1.5 THEN 0 ELSE 2 END AS k FROM detections) GROUP BY truth")(
    lambda t: K.confusion(t.detections.select(F.col("label").alias("truth"), C.decide_simple("mean_score").alias("k")), "truth", "k", [-2, 0, 2]))

# --- decisions and models -----------------------------------------------------------------


def lines_sql(points):
    b, r, t, l, fl, fr = points
    above = lambda p, q: f"std_score > {p[1]} + (mean_score - ({p[0]})) * ({q[1] - p[1]!r} / {float(q[0] - p[0])!r}::DOUBLE)"
    return f"CASE WHEN {above(b, r)} AND NOT {above(r, t)} AND NOT {above(t, l)} AND {above(l, b)} THEN 0 WHEN (mean_score < 0 AND NOT {above(l, fl)}) OR (mean_score > 0 AND {above(r, fr)}) THEN -2 WHEN (mean_score > 0 AND NOT {above(r, fr)}) OR (mean_score < 0 AND {above(l, fl)}) THEN 2 END"


query("d1_decide_simple", "SELECT id, CASE WHEN mean_score <= -1.5 THEN -2 WHEN mean_score <= 1.5 THEN 0 ELSE 2 END AS predictions FROM detections")(lambda t: t.detections.select("id", C.decide_simple("mean_score").alias("predictions")))
query("d2_decide_margin", "SELECT id, CASE WHEN mean_score < 0 THEN -2 WHEN mean_score > 0 AND mean_score - std_score < 0 THEN 0 WHEN mean_score - std_score > 0 THEN 2 END AS predictions FROM detections")(lambda t: t.detections.select("id", C.decide_margin("mean_score", "std_score").alias("predictions")))
query("d3_decide_lines", f"SELECT id, {lines_sql(C.CORNERS_A)} AS a, {lines_sql(C.CORNERS_B)} AS b FROM detections")(
    lambda t: t.detections.select("id", C.decide_lines("mean_score", "std_score").alias("a"), C.decide_lines("mean_score", "std_score", C.CORNERS_B).alias("b")))
query("d4_detections_table", "SELECT animal, section, y AS row, x AS col, label, mean_score, std_score, CASE WHEN mean_score <= 1.5 THEN 0 ELSE 2 END AS predictions FROM detections WHERE mean_score > -1.5")(lambda t: K.detections_table(t.detections, C.decide_simple("mean_score")))
query("d5_build_training_set", """WITH c AS (SELECT id, animal AS prep, section, x, y FROM detections), q AS (SELECT DISTINCT a.id FROM c a JOIN pts b ON a.prep = b.prep AND a.section = b.section WHERE b.name IN ('A', 'R') AND sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) < 5),
n AS (SELECT DISTINCT a.id FROM c a JOIN pts b ON a.prep = b.prep AND a.section = b.section WHERE b.name = 'N' AND sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) < 5)
SELECT id, CASE WHEN id IN (SELECT id FROM q) THEN 1 ELSE 0 END AS label FROM c WHERE id IN (SELECT id FROM q) OR id IN (SELECT id FROM n) OR (prep = 1 AND section = 2)""")(
    lambda t: K.build_training_set(t.detections.select("id", F.col("animal").alias("prep"), "section", "x", "y"), [t.pts.where(f"name = '{k}'") for k in "AR"], t.pts.where("name = 'N'"), t.pts.where("prep = 1 and section = 2"), 5, ["prep", "section"]).select("id", "label"))


def vectors(t):
    from pyspark.ml.functions import array_to_vector

    return t.embeddings.select(F.col("vec_id").alias("id"), (F.col("label") % 2).cast("double").alias("label"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


@query("d6_ensemble_scores")
def _(t):
    v = vectors(t)
    return rounded(K.score_stats(K.score_ensemble(v, K.train_ensemble(v, 30))), "mean", "std", "median", "spread", digits=6)


query("d7_kmeans_scan")(lambda t: rounded(K.kmeans_scan(vectors(t), [2, 3, 4], dim=dimension(t)), "bic", "silhouette", digits=4))
