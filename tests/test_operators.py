"""Operators against loops and hand-made truths where SQL has no say."""

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessella.functions.session import stored
from tessella.operators import graphs, hierarchy, scores, spatial, tables, transforms, voxels
from tessella.sources import files


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def cloud(spark, n, seed, side=100.0):
    r = random.Random(seed)
    return frame(spark, [(i, 1, r.uniform(0, side), r.uniform(0, side)) for i in range(n)], "id long, section int, x double, y double")


def greedy(a, b, cutoff):
    pairs = sorted((math.dist(p[2:], q[2:]), p[0], q[0]) for p in a for q in b if math.dist(p[2:], q[2:]) < cutoff)
    left, right, out = set(), set(), []
    for d, i, j in pairs:
        if i not in left and j not in right:
            left.add(i)
            right.add(j)
            out.append((i, j))
    return sorted(out)


def test_matching_is_greedy(spark):
    a, b = cloud(spark, 150, 1), cloud(spark, 140, 2)
    for cutoff in (3.0, 15.0):
        pairs = spatial.match_points(a, b, cutoff, ["section"])
        want = greedy([tuple(r) for r in a.collect()], [tuple(r) for r in b.collect()], cutoff)
        assert sorted((r["id_a"], r["id_b"]) for r in pairs.collect()) == want
        c = spatial.match_counts(a, b, pairs).first()
        assert c["tp"] + c["fn"] == 150 and c["tp"] + c["fp"] == 140
    sweep = {r["cutoff"]: r["tp"] for r in spatial.match_sweep(a, b, [3, 15], ["section"]).collect()}
    assert sweep[15.0] == len(want)


def test_match_all_leaves_the_rest(spark):
    a, b = cloud(spark, 12, 3), cloud(spark, 9, 4)
    pairs, rest = spatial.match_all(a, b, ["section"])
    assert pairs.count() == 9
    assert {r["side"] for r in rest.collect()} == {"truth"} and rest.count() == 3


@pytest.mark.parametrize("crowd", [1, 40])
def test_match_all_is_greedy_at_any_distance(spark, crowd):
    # a dense crowd in one corner and few points far away, in two sections and one that has truths alone
    r = random.Random(crowd)
    side = lambda first, n: [(first + i, 1 + i % 2, *((r.uniform(0, 1), r.uniform(0, 1)) if i < crowd else (r.uniform(0, 500), r.uniform(0, 500)))) for i in range(n)]
    a, b = [*side(0, 60), (900, 3, 1.0, 1.0), (901, 1, None, 2.0)], side(1000, 45)
    schema = "id long, section int, x double, y double"
    pairs, rest = spatial.match_all(frame(spark, a, schema), frame(spark, b, schema), ["section"])
    want = [p for s in (1, 2) for p in greedy([p for p in a if p[1] == s and p[2] is not None], [p for p in b if p[1] == s], math.inf)]
    assert sorted((x["id_a"], x["id_b"]) for x in pairs.collect()) == sorted(want)
    assert {x["id"] for x in rest.collect()} == {p[0] for p in a + b} - {i for p in want for i in p}


def test_rows_are_numbered_over_ranges(spark):
    r = random.Random(8)
    rows = [(i, r.choice(["a", "a", "a", "b", None]), r.choice([None, 0.0, -0.0, math.nan, *range(40)]), r.choice([0, 1, 1])) for i in range(700)]
    rows = [(i, k, None if v is None else float(v), y) for i, k, v, y in rows]
    df = frame(spark, rows, "id long, name string, score double, label int").withColumns({"z": F.col("score"), "x": F.lit(1.0), "y": F.lit(2.0)})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {x["id"]: x["row"] for x in tables.export_order(df).collect()}
        want = {x["id"]: x["n"] - 1 for x in df.withColumn("n", F.row_number().over(Window.partitionBy("name").orderBy("z", "x", "y", "id"))).collect()}
        assert got == want
        up, down = (F.row_number().over(Window.partitionBy("label").orderBy(o, "id")) for o in (F.col("score"), F.col("score").desc()))
        n = F.count(F.lit(1)).over(Window.partitionBy("label"))
        want = {x["id"]: x["c"] for x in df.withColumn("c", (F.when(F.col("label") == 1, up).otherwise(down) - 1) / n).collect()}
        cdf = scores.score_cdf(df)
        assert cdf.columns == [*df.columns, "cdf"] and {x["id"]: x["cdf"] for x in cdf.collect()} == want
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tables.export_order(df.where("id < 0")).count() == 0


def test_jittered_copies(spark):
    r = random.Random(5)
    base = [(i, 1, r.random() * 50, r.random() * 50) for i in range(300)]
    moved = [(i, 1, x + r.uniform(-0.01, 0.01), y + r.uniform(-0.01, 0.01)) for i, _, x, y in base[:290]]
    schema = "id long, section int, x double, y double"
    a, b = frame(spark, base, schema), frame(spark, moved, schema)
    c = spatial.prf1(spatial.match_counts(a, b, spatial.match_points(a, b, 0.035, ["section"]))).first()
    assert c["tp"] + c["fn"] == 300 and c["tp"] + c["fp"] == 290 and c["f1"] > 0.9


@pytest.mark.parametrize("settled", [0, 10, 10**6])
def test_matching_settles_chains_and_clouds_alike(spark, settled):
    # a chain of falling distances takes one pair a round
    chain = [(1, 2 * i, 2 * i + 1, 100.0 - 2 * i) for i in range(40)] + [(1, 2 * i + 2, 2 * i + 1, 99.0 - 2 * i) for i in range(39)]
    r = random.Random(5)
    cloud_ = [(2, a, b, float(r.randint(1, 30))) for a in range(20) for b in range(20) if r.random() < 0.4]
    want = set()
    for rows in (chain, cloud_):
        left, right = set(), set()
        for k, a, b, d in sorted(rows, key=lambda x: (x[3], x[1], x[2])):
            if a not in left and b not in right:
                left.add(a), right.add(b), want.add((k, a, b, d))
    pairs = frame(spark, chain + cloud_, "k int, id_a long, id_b long, dist double")
    if settled == 0:
        pairs = pairs.where("k = 2")
        want = {w for w in want if w[0] == 2}
    assert set(map(tuple, spatial._greedy(pairs, ["k"], settled).collect())) == want


def test_two_thousand_points_match_two_thousand(spark):
    r = random.Random(8)
    truth = [(i, 1, r.uniform(0, 400), r.uniform(0, 400)) for i in range(2010)]
    found = [(i, 1, x + r.gauss(0, 1), y + r.gauss(0, 1)) for i, (_, _, x, y) in enumerate(truth[:2000])]
    schema = "id long, section int, x double, y double"
    pairs = spatial.match_points(frame(spark, truth, schema), frame(spark, found, schema), 10, ["section"])
    assert {(p["id_a"], p["id_b"]) for p in pairs.collect()} == set(greedy(truth, found, 10))


def test_nearest_in_tile_widens_its_search(spark):
    r = random.Random(9)
    a = [(i, i % 3, r.uniform(0, 1000), r.uniform(0, 1000)) for i in range(150)]
    b = [(i, i % 2, r.choice([5.0, 990.0]) + r.random(), r.uniform(0, 1000)) for i in range(90)]
    schema = "id long, t int, x double, y double"
    got = {r["id"]: (r["match"], round(r["dist"], 9)) for r in spatial.nearest_in_tile(frame(spark, a, schema), frame(spark, b, schema), ["t"]).collect()}
    want = {}
    for i, t, x, y in a:
        near = sorted((math.dist((x, y), q[2:]), q[0]) for q in b if q[1] == t)
        if near:
            want[i] = (near[0][1], round(near[0][0], 9))
    assert got == want
    assert spatial.nearest_in_tile(frame(spark, [], schema), frame(spark, b, schema), ["t"]).count() == 0


def test_ks_test_of_boxes_that_share_no_values(spark):
    r = random.Random(10)
    boxes = [(k, 1, float(r.randint(0, 9 + 4 * k))) for k in range(5) for _ in range(40)]
    background = [(1, r.randint(0, 40) / 2 + 0.25) for _ in range(300)] + [(1, float(r.randint(0, 12))) for _ in range(60)]
    b, g = frame(spark, boxes, "box int, feature int, v double"), frame(spark, background, "feature int, v double")
    got = {r["box"]: (round(r["gap"], 9), r["at"], r["n1"], r["n2"]) for r in scores.ks_test(b, g, alpha=2.0).collect()}
    spread = g.join(b.select("box", "feature").distinct(), "feature")
    want = scores.ks_statistic(b, spread.select("box", "feature", "v"), ["box", "feature"]).collect()
    assert got == {r["box"]: (round(r["gap"], 9), r["at"], r["n1"], r["n2"]) for r in want} and len(got) == 5


def test_components_of_a_long_chain(spark):
    edges = frame(spark, [(i, i + 1) for i in range(60) if i % 20 != 19], "a long, b long")
    found = {r["node"]: r["comp"] for r in spatial.components(edges).collect()}
    assert found == {i: i // 20 * 20 for i in range(60)}


@pytest.mark.parametrize("alone", [0, graphs.ALONE])
def test_components_of_a_shuffled_path_take_few_rounds(spark, alone, monkeypatch):
    n, order, written = 10_000, np.random.default_rng(3).permutation(10_000).tolist(), []
    monkeypatch.setattr(graphs, "stored", lambda df, tag: written.append(tag) or stored(df, tag))
    edges = frame(spark, [(order[i], order[i + 1]) for i in range(n - 1) if i != n // 2] + [(7, 7)], "a long, b long")
    found = {r["node"]: r["comp"] for r in graphs.components(edges, alone).collect()}
    halves = [order[: n // 2 + 1], order[n // 2 + 1 :]]
    assert found == {x: min(h) for h in halves for x in h}
    assert written.count("small-stars") <= 16


def test_components_of_words_and_a_star(spark):
    edges = frame(spark, [("hub", f"leaf{i}") for i in range(3000)] + [("a", None), ("x", "y"), ("y", "x")], "a string, b string")
    for alone in (0, graphs.ALONE):
        found = collections.Counter(r["comp"] for r in graphs.components(edges, alone).collect())
        assert found == {"hub": 3001, "x": 2}


def test_components_of_nothing(spark):
    edges = frame(spark, [], "a long, b long")
    nodes = frame(spark, [(1,), (2,)], "node long")
    assert {r["comp"] for r in spatial.components(edges, nodes).collect()} == {1, 2}


def test_dedupe_keeps_the_lowest(spark):
    rows = [(1, 1, 1, 0.0, 0.0), (2, 1, 1, 1.0, 0.0), (3, 1, 2, 0.5, 0.0), (4, 1, 9, 0.0, 0.0)]
    kept = spatial.dedupe_detections(frame(spark, rows, "id long, prep int, section int, x double, y double"), 3)
    assert {r["id"] for r in kept.collect()} == {1, 4}


def test_merge_thresholds(spark):
    rows = [
        (1, 1, 0.0, 0.0, 10, "sure", 1.0), (2, 1, 1.0, 0.0, 20, "sure", 3.0), (3, 1, 1.5, 0.0, 20, "unsure", 9.0),  # mixed: the best sure one
        (4, 1, 50.0, 0.0, 10, "unsure", 1.0), (5, 1, 51.0, 0.0, 20, "unsure", 0.5),
    ]
    kept = spatial.merge_thresholds(frame(spark, rows, "id long, section int, x double, y double, threshold int, kind string, mean_score double"), 4)
    assert {r["id"] for r in kept.collect()} == {2, 4}


@pytest.mark.parametrize("scaled", [True, False])
def test_fit_finds_the_transform(spark, scaled):
    r = np.random.default_rng(0)
    q, _ = np.linalg.qr(r.normal(size=(3, 3)))
    q *= np.sign(np.linalg.det(q))
    m, t = q * (1.7 if scaled else 1.0), np.array([3.0, -2.0, 5.0])
    pts = r.normal(size=(20, 3)) * 10
    rows = [(1, *map(float, p), *map(float, m @ p + t)) for p in pts]
    pairs = frame(spark, rows, "prep int, x_a double, y_a double, z_a double, x_b double, y_b double, z_b double")
    f = transforms.fit(pairs, ["prep"], scaled).first()
    assert np.allclose([[f[f"r{i}{j}"] for j in range(3)] for i in range(3)], m, atol=1e-8)
    assert np.allclose([f[f"t{i}"] for i in range(3)], t, atol=1e-8)


def test_fit_keeps_the_hand(spark):
    pts = np.random.default_rng(1).normal(size=(10, 3))
    rows = [(1, *map(float, p), float(-p[0]), float(p[1]), float(p[2])) for p in pts]
    f = transforms.fit_rigid(frame(spark, rows, "prep int, x_a double, y_a double, z_a double, x_b double, y_b double, z_b double"), ["prep"]).first()
    assert np.linalg.det([[f[f"r{i}{j}"] for j in range(3)] for i in range(3)]) == pytest.approx(1)


def test_two_circles(spark):
    a = np.linspace(0, 2 * math.pi, 60)
    rows = [(1, 100 * math.cos(v), 100 * math.sin(v), 0.0, 100 * math.cos(v) + 2, 100 * math.sin(v) + 2, 0.0) for v in a]
    f = transforms.fit_similarity(frame(spark, rows, "prep int, x_a double, y_a double, z_a double, x_b double, y_b double, z_b double"), ["prep"]).first()
    assert abs(f["t0"] - 2) < 0.05 and abs(f["t1"] - 2) < 0.05 and abs(f["r00"] - 1) < 0.05


def test_few_points_are_not_fitted(spark):
    rows = [(1, 0.0, 0.0, 0.0, 1.0, 1.0, 1.0), (1, 1.0, 0.0, 0.0, 2.0, 1.0, 1.0)]
    assert not transforms.fit_rigid(frame(spark, rows, "prep int, x_a double, y_a double, z_a double, x_b double, y_b double, z_b double"), ["prep"]).count()


def test_effect_size(spark):
    rows = [("r", "a", v) for v in (1.0, 2.0, 3.0, 4.0)] + [("r", "b", v) for v in (2.0, 4.0, 6.0, 8.0)]
    d = scores.cohen_d(frame(spark, rows, "region string, g string, v double"), "region", "g", "v", "a", "b").first()["d"]
    a, b = np.array([1, 2, 3, 4.0]), np.array([2, 4, 6, 8.0])
    assert d == pytest.approx((a.mean() - b.mean()) / math.sqrt((a.var(ddof=1) + b.var(ddof=1)) / 2))


def test_rank_two_covariance(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(300, 2)) @ r.normal(size=(2, 6))
    df = frame(spark, [tuple(map(float, v)) for v in x], ", ".join(f"c{i} double" for i in range(6)))
    values = [v["eigenvalue"] for v in scores.pca_from_cov(scores.pairwise_covariance(df, df.columns), 6).orderBy("component").collect()]
    assert values[1] > 1e-3 and all(abs(v) < 1e-9 for v in values[2:])


def test_wide_covariance_with_missing_values(spark):
    r = np.random.default_rng(4)
    rows = [tuple(float(v) if r.random() < 0.8 else None for v in r.normal(size=20)) for _ in range(200)]
    df = frame(spark, rows, ", ".join(f"c{i} double" for i in range(20)))
    got = {(v["i"], v["j"]): (v["n"], v["cov"]) for v in scores.pairwise_covariance(df, df.columns).collect()}
    x = np.array(rows, float)
    assert len(got) == 20 * 21 // 2
    for (i, j), (n, cov) in got.items():
        both = x[:, i] * x[:, j]
        assert n == np.isfinite(both).sum() and cov == pytest.approx(np.nanmean(both) - np.nanmean(x[:, i]) * np.nanmean(x[:, j]))


def test_embedding_queries_use_all_components(spark, monkeypatch):
    from tessella.plans import catalog, statistics

    folder = "/root/testdata/sf0.001"
    x = np.array([r[0] for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("embedding").collect()], float)
    values = np.array([v["eigenvalue"] for v in catalog.queries()["a28_pca"](spark, folder).orderBy("component").collect()])
    assert np.allclose(values, np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1], atol=1e-5)
    seen = {}
    monkeypatch.setattr(statistics.K, "kmeans_scan", lambda df, ks, dim: seen.update(k=(df.first()["features"].size, dim)) or frame(spark, [(2, 0.0, 0.0)], "k int, bic double, silhouette double"))
    monkeypatch.setattr(statistics.K, "train_ensemble", lambda df, n, **kw: seen.update(e=(df.first()["features"].size, n, kw)) or [])
    monkeypatch.setattr(statistics.K, "score_ensemble", lambda df, models: frame(spark, [(1, 0, 0.5), (1, 1, 0.7)], "id long, model int, score double"))
    catalog.queries()["d7_kmeans_scan"](spark, folder)
    catalog.queries()["d6_ensemble_scores"](spark, folder)
    assert seen == {"k": (x.shape[1], x.shape[1]), "e": (x.shape[1], 30, {})}


def test_ks_of_equal_samples(spark):
    a = frame(spark, [(float(i % 50),) for i in range(500)], "v double")
    k = scores.ks_statistic(a, a).withColumn("p", scores.ks_p_value(F.col("gap"), F.col("n1"), F.col("n2"))).first()
    assert k["gap"] == 0 and k["p"] == 1


def test_rasterize_against_points(spark):
    corners = [(0, 0), (9, 2), (7, 8), (1, 6)]
    df = frame(spark, [(1, i, float(x), float(y)) for i, (x, y) in enumerate(corners)], "k int, point_order int, x double, y double")
    got = {(r["x"], r["y"]) for r in voxels.rasterize(df, ["k"]).collect()}

    def inside(p):
        return all((b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0]) >= 0 for a, b in zip(corners, corners[1:] + corners[:1]))

    assert got == {(x, y) for x in range(10) for y in range(10) if inside((x, y))}


def test_balls_by_size(spark):
    rows, comp = [], 0
    for radius in (3, 5, 9, 11):
        comp += 1
        rows += [(comp, x, y, z) for x in range(-radius, radius + 1) for y in range(-radius, radius + 1) for z in range(-radius, radius + 1) if x * x + y * y + z * z <= radius * radius]
    kept = voxels.size_filter(frame(spark, rows, "comp int, x int, y int, z int"), 200, 50000)
    assert {r["comp"] for r in kept.select("comp").distinct().collect()} == {2, 3, 4}


def test_get_row_wants_one(spark):
    df = frame(spark, [(1, "a"), (2, "a")], "id int, k string")
    assert tables.get_row(df, {"id": 1}).collect()[0]["k"] == "a"
    for search in ({"k": "a"}, {"k": "z"}):
        with pytest.raises(Exception, match="rows that match"):
            tables.get_row(df, search).collect()


def test_rollup_sums_leaves(spark):
    tree = frame(spark, [(0, None, "root"), (1, 0, "a"), (2, 0, "b"), (3, 1, "c"), (4, 3, "d")], "id long, parent_id long, name string")
    counts = frame(spark, [(2, 5), (4, 7), (3, 1)], "id long, cells long")
    got = {r["name"]: r["cells"] for r in hierarchy.rollup_counts(tree, counts, ["cells"]).collect()}
    assert got == {"root": 13, "a": 8, "b": 5, "c": 8, "d": 7}


def test_vertices_text(spark):
    df = frame(spark, [("[[1  2]\n [ 3, ,4 ]]",), ("[ [5,6] ]",)], "t string")
    got = [[tuple(v) for v in r["vertices"]] for r in files.parse_vertices(df, "t").collect()]
    assert got == [[(1.0, 2.0), (3.0, 4.0)], [(5.0, 6.0)]]


def test_sampling_repeats(spark):
    df = frame(spark, [(i, i % 3) for i in range(100)], "id long, section int")
    a, b = tables.sample_for_qc(df, 10, seed=4), tables.sample_for_qc(df.repartition(5), 10, seed=4)
    assert a.collect() == b.collect()
