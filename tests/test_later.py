"""Searches without a cutoff, matching over data sets, running sums, percentiles, outlines, sites, saves."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.functions.session import stored
from tessella.operators import graphs, ranges, scores, spatial, voxels
from tessella.plans import catalog
from tessella.sources import files
from tessella.streaming import saves
from tests.parity import compare
from tests.test_operators import frame, greedy

POINT = "id long, t int, x double, y double"


def looked_up(a, b):
    """Nearest candidates by comparing everything."""
    ok = lambda p: all(v is not None and math.isfinite(v) for v in p[2:])
    out = {}
    for p in filter(ok, a):
        near = sorted((math.dist(p[2:], q[2:]), q[0]) for q in b if q[1] == p[1] and ok(q))
        if near:
            out[p[1], p[0]] = (near[0][1], round(near[0][0], 9))
    return out


def found(rows):
    return {(r["t"], r["id"]): (r["match"], round(r["dist"], 9)) for r in rows.collect()}


@pytest.mark.parametrize("pairs", [9, spatial.CELL_PAIRS])
def test_nearest_in_tile_is_the_nearest(spark, pairs, monkeypatch):
    monkeypatch.setattr(spatial, "CELL_PAIRS", pairs)
    r = random.Random(pairs)
    spot = lambda k: [(r.uniform(0, 100), r.uniform(0, 100)), (r.randint(0, 3) * 1.0, 7.0), (50 + r.random() / 1e3, 50.0), (r.uniform(900, 901), r.uniform(-5, -4))][k % 4]
    a = [(i, i % 3, *spot(r.randrange(4))) for i in range(160)] + [(900, 1, math.nan, 1.0), (901, 1, None, 1.0), (902, 0, math.inf, 2.0), (0, 1, 3.0, 3.0), (903, 9, 1.0, 1.0)]
    b = [(i, i % 2, *spot(r.randrange(4))) for i in range(140)] + [(900, 1, math.nan, 1.0), (901, 0, -math.inf, 1.0), (902, 1, 3.0, None), (5, 5, 1.0, 1.0), (300, 0, 2.0, 7.0), (299, 0, 2.0, 7.0)]
    assert found(spatial.nearest_in_tile(frame(spark, a, POINT), frame(spark, b, POINT), ["t"])) == looked_up(a, b)


def test_nearest_in_tile_of_one_repeated_place_and_of_nothing(spark):
    same = frame(spark, [(i, 1, 4.0, 4.0) for i in range(3000)], POINT)
    got = spatial.nearest_in_tile(same, same, ["t"])
    assert got.count() == 3000 and got.select("match", "dist").distinct().collect() == [(0, 0.0)]
    empty, lost = frame(spark, [], POINT), frame(spark, [(1, 1, math.nan, math.nan)], POINT)
    for a, b in ((empty, same), (same, empty), (lost, same), (same, lost), (lost, lost)):
        assert spatial.nearest_in_tile(a, b, ["t"]).count() == 0


def test_two_far_crowds_are_compared_in_part(spark, monkeypatch):
    n, compared = 5000, []
    crowd = lambda seed, corner, first: spark.range(n).select((F.col("id") + first).alias("id"), F.lit(1).alias("t"), (F.rand(seed) + corner).alias("x"), (F.rand(seed + 1) + corner).alias("y"))
    a, b = stored(crowd(1, 0.0, 0), "a"), stored(crowd(5, 1000.0, 10**9), "b")
    plain = spatial._compared

    def counted(pairs, *more):
        compared.append(pairs.agg(F.coalesce(F.sum(F.col("nq") * F.col("nc")), F.lit(0))).first()[0])
        return plain(pairs, *more)

    monkeypatch.setattr(spatial, "_compared", counted)
    got = {r["id"]: r["dist"] for r in spatial.nearest_in_tile(a, b, ["t"]).collect()}
    assert len(got) == n and sum(compared) < n * n / 25
    p, q = (np.array(d.orderBy("id").select("x", "y").collect()) for d in (a, b))
    want = [np.sqrt(((q - v) ** 2).sum(axis=1).min()) for v in p]
    assert np.allclose([got[i] for i in range(n)], want)


def test_three_axes(spark):
    r = random.Random(3)
    a = [(i, 0, *(r.uniform(0, 9) for _ in "xyz")) for i in range(80)]
    b = [(i, 0, *(r.uniform(5, 30) for _ in "xyz")) for i in range(90)]
    schema = "id long, t int, x double, y double, z double"
    assert found(spatial.nearest_in_tile(frame(spark, a, schema), frame(spark, b, schema), ["t"], ("x", "y", "z"))) == looked_up(a, b)


def test_data_sets_with_the_same_ids(spark):
    truth = [(1, "a", 1, 0.0, 0.0), (1, "b", 1, 50.0, 50.0), (2, "b", 1, 0.0, 0.0)]
    pred = [(1, "a", 1, 1.0, 0.0, 0.9), (1, "b", 1, 50.0, 51.0, 0.8), (2, "b", 2, 0.0, 0.0, 0.9)]
    t = frame(spark, truth, "id long, prep string, section int, x double, y double")
    p = frame(spark, pred, "id long, prep string, section int, x double, y double, p double")
    sweep = {r["threshold"]: (r["tp"], r["fp"], r["fn"]) for r in spatial.f1_sweep(t, p, [0.5, 0.85], 5, "prep", keys=["section"]).collect()}
    assert sweep == {0.5: (2, 1, 1), 0.85: (1, 1, 2)}
    counts = {r["cutoff"]: (r["tp"], r["fn"], r["fp"]) for r in spatial.match_sweep(t, p, [0.5, 5], ["prep", "section"]).collect()}
    assert counts == {0.5: (0, 3, 3), 5.0: (2, 1, 1)}
    near = {(r["prep"], r["id"]): r["match"] for r in spatial.nearest(t, p, ["prep"], 5).collect()}
    assert near == {("a", 1): 1, ("b", 1): 1, ("b", 2): 2}
    kept = spatial.exclude_detections(t.withColumnRenamed("prep", "animal"), frame(spark, [("z", 9)], "animal string, section int"), frame(spark, [], "id long"), p.where("prep = 'a'").withColumnRenamed("prep", "animal"), 5)
    assert {(r["animal"], r["id"]) for r in kept.collect()} == {("b", 1), ("b", 2)}


def test_match_all_without_places_and_with_the_same_ids(spark):
    a = [(1, 1, 0.0, 0.0), (1, 2, 5.0, 5.0), (2, 1, math.nan, 0.0), (3, 1, math.inf, 0.0)]
    b = [(1, 1, 9.0, 0.0), (1, 3, 5.0, 5.0), (2, 2, math.nan, 1.0)]
    pairs, rest = spatial.match_all(frame(spark, a, POINT), frame(spark, b, POINT), ["t"])
    assert [(r["t"], r["id_a"], r["id_b"], r["dist"]) for r in pairs.collect()] == [(1, 1, 1, 9.0)]
    assert sorted((r["side"], r["t"], r["id"]) for r in rest.collect()) == [("prediction", 2, 2), ("prediction", 3, 1), ("truth", 1, 2), ("truth", 1, 3), ("truth", 2, 1)]
    assert greedy([a[0]], [b[0]], math.inf) == [(1, 1)]


@pytest.mark.parametrize("name", ["c1_components", "c11_link_planes", "w16_cross_section_runs", "m1_match_points", "m2_match_sweep", "m5_f1_sweep", "c1_voxel_components", "c5_dedupe_detections"])
def test_rounds_give_the_same_rows(spark, name, monkeypatch):
    monkeypatch.setattr(graphs, "ALONE", 0)
    monkeypatch.setattr(spatial, "SETTLED", 300)
    folder = "/root/testdata/sf0.01" if name in ("c1_components", "c11_link_planes") else "/root/testdata/sf0.001"
    compare(spark, folder, catalog.queries()[name], catalog.oracle_sql()[name])


# --- running sums, percentiles, gaps ------------------------------------------------------


def test_percentiles_are_exact_over_ranges(spark):
    r = random.Random(4)
    rows = [(k, r.choice([None, r.gauss(0, 9), float(r.randint(0, 5)), -0.0, 0.0])) for k in ("a", "a", "a", "b", None) for _ in range(500)] + [("c", 1.5), ("d", None)]
    df = frame(spark, rows, "k string, v double").repartition(6)
    shares = {"q0": 0.0, "q1": 0.1, "q5": 0.5, "q9": 0.9, "q99": 0.99, "q100": 1.0}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {x["k"]: [x[q] for q in shares] for x in ranges.percentiles(df, ["k"], "v", shares).collect()}
        want = {x["k"]: [x[q] for q in shares] for x in df.where("v is not null").groupBy("k").agg(*(F.percentile("v", p).alias(q) for q, p in shares.items())).collect()}
        assert got == want and set(got) == {"a", "b", "c", None}
        whole = ranges.percentiles(df, [], "v", {"m": 0.5}).collect()
        assert [x["m"] for x in whole] == [df.agg(F.percentile("v", 0.5)).first()[0]]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_group_of_half_a_million_values_is_split(spark):
    df = spark.range(500_001).select(F.lit(1).alias("k"), ((F.col("id") * 7_919) % 500_009).cast("double").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = ranges.running(df.withColumn("n", F.lit(1)), ["k"], ["v"], ["n"])
        assert placed.select(F.spark_partition_id()).distinct().count() >= 1 and placed.agg(F.max("n_until"), F.max("n_total")).first()[:] == (500_001, 500_001)
        assert placed.where(F.col("n_until") == 1).first()["v"] == df.agg(F.min("v")).first()[0]
        got = ranges.percentiles(df, ["k"], "v", {"m": 0.5, "p": 0.999}).first()
        want = df.agg(F.percentile("v", 0.5), F.percentile("v", 0.999)).first()
        assert (got["m"], got["p"]) == tuple(want)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_gap_of_two_samples_without_groups(spark):
    r = random.Random(6)
    a, b = [r.gauss(0, 1) for _ in range(900)] + [1.0] * 50, [r.gauss(0.4, 1) for _ in range(700)] + [1.0] * 30
    got = scores.ks_statistic(frame(spark, [(v,) for v in a], "v double"), frame(spark, [(v,) for v in b] + [(None,)], "v double")).collect()
    steps = sorted(set(a + b))
    gaps = [(sum(x <= v for x in a) / len(a) - sum(x <= v for x in b) / len(b), v) for v in steps]
    want = max(gaps, key=lambda g: (round(abs(g[0]), 12), -g[1]))
    assert len(got) == 1 and got[0]["gap"] == pytest.approx(want[0]) and got[0]["at"] == want[1] and (got[0]["n1"], got[0]["n2"]) == (len(a), len(b))
    assert scores.ks_statistic(frame(spark, [], "v double"), frame(spark, [(1.0,)], "v double")).count() == 0


# --- voxels -------------------------------------------------------------------------------


@pytest.mark.parametrize("neighbours", [6, 18, 26])
@pytest.mark.parametrize("share", [0.03, 0.3, 0.8])
def test_components_of_dense_and_thin_volumes(spark, neighbours, share, monkeypatch):
    monkeypatch.setattr(spatial, "LINE", 5)
    monkeypatch.setattr(graphs, "ALONE", 0)
    r = random.Random(neighbours)
    spots = [(x, y, z) for x in range(-7, 9) for y in range(6) for z in range(5) if r.random() < share]
    ids = r.sample(range(10_000), len(spots))
    place, most = dict(zip(spots, ids)), {6: 1, 18: 2, 26: 3}[neighbours]
    want, todo = {}, sorted(spots, key=place.get)
    for spot in todo:
        if place[spot] not in want:
            stack = [spot]
            want[place[spot]] = place[spot]
            while stack:
                x, y, z = stack.pop()
                for i, j, k in ((i, j, k) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1) if 0 < abs(i) + abs(j) + abs(k) <= most):
                    near = (x + i, y + j, z + k)
                    if near in place and place[near] not in want:
                        want[place[near]] = place[spot]
                        stack.append(near)
    vox = frame(spark, [(place[s], *s) for s in spots], "id long, x int, y int, z int")
    assert {v["node"]: v["comp"] for v in spatial.voxel_components(vox, neighbours).collect()} == want


def test_a_box_reads_few_row_groups(spark, tmp_path):
    import pyarrow.parquet as pq

    path = f"{tmp_path}/vox"
    vox = spark.range(64**3).select((F.col("id") % 64 - 20).alias("x"), (F.col("id") / 64 % 64).cast("int").alias("y"), (F.col("id") / 4096).cast("int").alias("z"), F.hash("id").alias("label"))
    far = frame(spark, [(10**6, 0, 0, 5), (-(10**6), 3, 3, 6)], "x long, y int, z int, label int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        voxels.write_by_place(vox.unionByName(far), path, 64 << 10)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for low, high in (((-4, 10, 30), (3, 17, 37)), ((5, 5, 5), (5, 5, 5)), ((-30, -5, -9), (99, 99, 99)), ((10**6, 0, 0), (10**6, 9, 9)), ((90, 0, 0), (99, 9, 9))):
        want = vox.unionByName(far).where(" AND ".join(f"{c} BETWEEN {a} AND {b}" for c, a, b in zip("xyz", low, high)))
        assert sorted(map(tuple, voxels.read_box(spark, path, low, high).collect())) == sorted(map(tuple, want.collect()))
    wanted, groups = voxels.key_ranges((-4, 10, 30), (3, 17, 37)), []
    assert len(wanted) <= voxels.KEY_RANGES
    for part in (tmp_path / "vox").glob("*.parquet"):
        meta = pq.ParquetFile(part).metadata
        for g in range(meta.num_row_groups):
            stats = next(meta.row_group(g).column(c).statistics for c in range(meta.num_columns) if meta.row_group(g).column(c).path_in_schema == "key")
            groups.append(stats is not None and stats.has_min_max and any(a <= stats.max and stats.min <= b for a, b in wanted))
    assert len(groups) >= 8 and sum(groups) <= len(groups) / 2, (sum(groups), len(groups))
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        assert "GreaterThanOrEqual(key" in voxels.read_box(spark, path, (-4, 10, 30), (3, 17, 37))._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


# --- outlines -----------------------------------------------------------------------------


def test_spread_of_clouds_lines_and_circles(spark, monkeypatch):
    monkeypatch.setattr(spatial, "OUTLINED", 40)
    r = random.Random(2)
    clouds = {1: [(r.gauss(0, 3), r.gauss(0, 9)) for _ in range(300)], 2: [(float(i), 2.0 * i) for i in range(90)], 3: [(5.0, 5.0)] * 3, 4: [(1.0, 1.0), (4.0, 5.0)],
              5: [(math.cos(i / 100 * math.tau), math.sin(i / 100 * math.tau)) for i in range(100)], 6: [(float(r.randint(0, 3)), float(r.randint(0, 3))) for _ in range(60)], 7: [(1.0, 2.0)], 8: [(3.0, float(i)) for i in range(9)]}
    rows = [(1, s, x, y) for s, pts in clouds.items() for x, y in pts] + [(1, 4, math.nan, 0.0)]
    got = {x["section"]: x["spread"] for x in spatial.section_spread(frame(spark, rows, "prep int, section int, x double, y double")).collect()}
    want = {s: max(math.dist(p, q) for p in pts for q in pts) for s, pts in clouds.items() if len(pts) > 1}
    assert got == pytest.approx(want)


def test_spread_of_a_circle_of_many_corners(spark):
    n = 200_000
    angle = F.col("id") * (math.tau / n)
    df = spark.range(n).select(F.lit(1).alias("prep"), F.lit(1).alias("section"), (F.cos(angle) * 7).alias("x"), (F.sin(angle) * 7).alias("y"))
    assert spatial.section_spread(df).first()["spread"] == pytest.approx(14.0, abs=1e-8)


# --- sites, layers, saves -----------------------------------------------------------------


def test_sites_are_the_largest_bright_components(spark):
    rows = [(x, x, 0, 0, 100) for x in (1, 2, 3, 7, 8, 20)] + [(100 + i, i, 5, 5, 1) for i in range(40)]
    vox = frame(spark, rows, "id long, x int, y int, z int, value int")
    got = voxels.find_site(vox, 1.0, 2)
    assert sorted((r["comp"], r["id"], r["voxels"]) for r in got.collect()) == [(1, 1, 3), (1, 2, 3), (1, 3, 3), (7, 7, 2), (7, 8, 2)]
    for dark in (vox.withColumn("value", F.lit(3)), vox.where("id < 0")):
        with pytest.raises(ValueError, match="bright enough"):
            voxels.find_site(dark, 1.0)


def test_layers_carry_notes_and_colours(spark):
    rows = [(2, "cells", 1.0, 2.0, 3.0, "seen twice", "#1d66db"), (1, "cells", 0.0, 0.0, 1.0, None, None)]
    df = frame(spark, rows, "id int, name string, x double, y double, z double, note string, shade string")
    plain = json.loads(files.to_layer_json(df).first()["json"])
    assert plain == {"name": "cells", "annotations": [{"point": [0.0, 0.0, 1.5], "type": "point", "category": "cells"}, {"point": [1.0, 2.0, 3.5], "type": "point", "category": "cells"}]}
    full = json.loads(files.to_layer_json(df, description="note", color="shade").first()["json"])
    assert full["annotations"][1] == plain["annotations"][1] | {"description": "seen twice", "props": ["#1d66db"]} and full["annotations"][0] == plain["annotations"][0]


SAVE = "k long, ts timestamp, v string"


def arrive(spark, path, rows):
    spark.createDataFrame(rows, "k long, ts string, v string").withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(path)


def keep(spark, folder, every=3):
    stream = spark.readStream.schema(SAVE).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    return saves.stream_upsert(stream, f"{folder}/table", f"{folder}/check", ["k"], "ts", every)


def table(spark, folder):
    return sorted((r["k"], str(r["ts"])[:10], r["v"]) for r in saves.read_saves(spark, f"{folder}/table", SAVE, ["k"], "ts").collect())


def test_late_first_saves_stay_and_older_ones_change_nothing(spark, tmp_path):
    folder = str(tmp_path)
    assert table(spark, folder) == []
    arrive(spark, f"{folder}/in", [(1, "2024-05-01", "new"), (1, "2024-04-01", "old")])
    keep(spark, folder)
    arrive(spark, f"{folder}/in", [(2, "2001-01-01", "years late"), (1, "2023-01-01", "older"), (1, "2024-05-01", "new")])
    keep(spark, folder)
    assert table(spark, folder) == [(1, "2024-05-01", "new"), (2, "2001-01-01", "years late")]
    for day in range(1, 12):  # several bases, of which two stay
        arrive(spark, f"{folder}/in", [(day % 3, f"2024-06-{day:02d}", f"v{day}"), (7, f"2000-01-{day:02d}", "x")])
        keep(spark, folder)
    assert table(spark, folder) == [(0, "2024-06-09", "v9"), (1, "2024-06-10", "v10"), (2, "2024-06-11", "v11"), (7, "2000-01-11", "x")]
    bases = [p for p in (tmp_path / "table").iterdir() if p.name.startswith("base-")]
    assert len(bases) == 2 and len(list((tmp_path / "table" / "log").glob("batch=*"))) < 8


@pytest.mark.parametrize("where", ["_publish", "_compact", "remove"])
def test_a_batch_that_dies_runs_again(spark, tmp_path, monkeypatch, where):
    folder, plain = str(tmp_path), getattr(saves, where)
    days = 12 if where == "remove" else 6
    for day in range(1, days + 1):
        arrive(spark, f"{folder}/in", [(day % 3, f"2024-06-{day:02d}", f"v{day}"), (9, "2024-01-01", "once")])
        dies = day % 3 == 0 and (day > 6 or where != "remove")
        if dies:
            def die(*a):
                raise RuntimeError("killed")

            monkeypatch.setattr(saves, where, die)
            try:
                keep(spark, folder)
            except Exception as error:  # noqa: BLE001
                assert "killed" in str(error)
            monkeypatch.setattr(saves, where, plain)
            before = dict((k, v) for k, _, v in table(spark, folder))
            assert before[9] == "once" and before[day % 3] == f"v{day}"
        keep(spark, folder)
    assert table(spark, folder) == [(k, f"2024-06-{d:02d}", f"v{d}") for k, d in ((0, days), (1, days - 2), (2, days - 1))] + [(9, "2024-01-01", "once")]


# --- bounded texts of layers, sums that have one result ------------------------------------


def test_a_layer_of_many_points_has_several_texts(spark):
    df = spark.range(25).select("id", F.when(F.col("id") % 5 > 0, "a").alias("name"), F.col("id").alias("x"), F.lit(1.0).alias("y"), F.lit(2.0).alias("z")).repartition(4)
    got = {(r["name"], r["piece"]): [p["point"][0] for p in json.loads(r["json"])["annotations"]] for r in files.to_layer_json(df, most=8).collect()}
    ids = [i for i in range(25) if i % 5]
    assert got == {("a", 0): ids[:8], ("a", 1): ids[8:16], ("a", 2): ids[16:], (None, 0): [0, 5, 10, 15, 20]}


def test_states_are_bounded(spark):
    from tessella.plans import files as plans
    from tessella.plans.registry import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    sizes = [r["n"] for r in plans.states(t, 100).select(F.size(F.from_json("state", files.LAYERS)["layers"][0]["annotations"]).alias("n")).collect()]
    assert sum(sizes) == t.pts.count() and max(sizes) == 100


def test_rolled_up_sums_do_not_depend_on_the_order_of_rows(spark):
    # one after the other, ten tenths as binary fractions add up to a little less than one
    from tessella.plans.registry import BINDINGS

    frame(spark, [(1, 0.1)] * 10, "o_custkey long, o_totalprice double").coalesce(1).createOrReplaceTempView("orders_of_one")
    sql = BINDINGS["tree_counts"].replace("FROM orders", "FROM orders_of_one")
    assert [(r["cells"], r["voxels"]) for r in spark.sql(sql).collect()] == [(10, 1)]


# --- components of crowds ------------------------------------------------------------------


@pytest.mark.parametrize("along", [None, "s"])
@pytest.mark.parametrize("pairs", [1, spatial.CELL_PAIRS])
@pytest.mark.parametrize("square", [False, True])
def test_crowds_have_the_components_of_their_pairs(spark, monkeypatch, along, pairs, square):
    monkeypatch.setattr(spatial, "CELL_PAIRS", pairs)
    r = random.Random(6)
    d = 5.0
    spots = [(r.uniform(0, 60), r.uniform(0, 60)) for _ in range(70)]
    # crowds at 5 exactly, a little nearer, and a little farther; copies of one place; points alone
    spots += [(x + r.uniform(-0.01, 0.01), 0.0) for x in (100, 105.5, 109.9, 115.5) for _ in range(20)] + [(200.0, 0.0), (205.0, 0.0), (209.999, 0.0)] * 9
    rows = [(i, r.randrange(2), r.randrange(3), x, y) for i, (x, y) in enumerate(spots)] + [(900, 0, 1, math.nan, 0.0), (901, 0, 1, None, 0.0), (902, None, 1, 0.0, 0.0)]
    strict = not square

    def near(a, b):
        v = max(abs(a[3] - b[3]), abs(a[4] - b[4])) if square else math.dist(a[3:], b[3:])
        return v < d if strict else v <= d

    parent = {row[0]: row[0] for row in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in rows[:-3]:
        for b in rows[:-3]:
            if a[1] == b[1] and b[2] - a[2] == (1 if along else 0) and near(a, b):
                parent[max(root(a[0]), root(b[0]))] = min(root(a[0]), root(b[0]))
    df = frame(spark, rows, "id long, k int, s int, x double, y double")
    got = {x["id"]: x["comp"] for x in spatial.grouped_points(df, d, keys=["k", "s"], along=along, strict=strict, square=square).collect()}
    assert got == {i: root(i) for i in parent}


def test_a_crowd_costs_no_pairs(spark, monkeypatch):
    sizes, plain = [], graphs.components

    def counted(edges, *more):
        sizes.append(edges.count())
        return plain(edges, *more)

    monkeypatch.setattr(graphs, "components", counted)
    pts = spark.range(20_000).select("id", F.lit(1).alias("prep"), (F.col("id") % 2).cast("int").alias("section"), (F.rand(1) * 20).alias("x"), (F.rand(2) * 20).alias("y"))
    assert spatial.group_close(pts, 8, keys=["prep", "section"]).select("comp").distinct().count() == 2
    assert [(x["sections"], x["cells"]) for x in spatial.cross_section_runs(pts, 6).collect()] == [(2, 1)]
    assert max(sizes) < 5_000


@pytest.mark.parametrize("settled", [150, 10**6])
def test_crowds_match_without_all_their_pairs(spark, monkeypatch, settled):
    # copies of few places on a grid, with equal distances everywhere
    monkeypatch.setattr(spatial, "SETTLED", settled)
    r = random.Random(7)
    spot = lambda: (float(r.randint(0, 5)), float(r.randint(0, 2)))
    a, b = ([(first + i, 1, *spot()) for i in range(n)] for first, n in ((0, 90), (1000, 80)))
    left, right, want = set(), set(), []
    for d, i, j in sorted((math.dist(p[2:], q[2:]), p[0], q[0]) for p in a for q in b):
        if d < 2.5 and i not in left and j not in right:
            left.add(i), right.add(j), want.append((i, j))
    sizes, plain = [], spatial._greedy_places

    def counted(pairs, *more):
        sizes.append(pairs.count())
        return plain(pairs, *more)

    monkeypatch.setattr(spatial, "_greedy_places", counted)
    pairs = spatial.match_points(frame(spark, a, POINT), frame(spark, b, POINT), 2.5, ["t"])
    assert sorted((x["id_a"], x["id_b"]) for x in pairs.collect()) == sorted(want)
    assert max(sizes) <= 18 * 18  # places, not 7,200 points


# --- growth ---------------------------------------------------------------------------------


def test_rasters_sort_a_bounded_part_and_make_no_point_twice(spark, monkeypatch):
    # a star whose edges cross rows many times, a flat polygon, two parts that share an edge, a place
    star = [(1, i, 20 + 20 * math.cos(i * 4 * math.pi / 5), 20 + 20 * math.sin(i * 4 * math.pi / 5)) for i in range(5)]
    comb = [(2, i, float(x), float(y)) for i, (x, y) in enumerate([(0, 0), (9, 0), (9, 6), (6, 6), (6, 2), (3, 2), (3, 6), (0, 6)])]
    rows = [*star, *comb, (3, 0, 0.0, 0.0), (3, 1, 7.0, 0.0), (4, 0, 3.0, 3.0)]
    monkeypatch.setattr(voxels, "CORNERS", 5)
    got = voxels.rasterize(frame(spark, rows, "k int, point_order int, x double, y double"), ["k"])
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found))
    low = min(x for k, _, x, _ in star), min(y for k, _, _, y in star)
    outline = {1: [(int(x - low[0]), int(y - low[1])) for _, _, x, y in star], 2: [(x, y) for _, _, x, y in comb]}

    def inside(corners, x, y):
        odd = False
        for (x1, y1), (x2, y2) in zip(corners, corners[1:] + corners[:1]):
            if min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2) and (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1):
                return True
            if (y1 <= y < y2 or y2 <= y < y1) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                odd = not odd
        return odd

    want = {(k, x, y) for k, c in outline.items() for x in range(45) for y in range(45) if inside(c, x, y)}
    assert set(found) == want | {(3, x, 0) for x in range(8)} | {(4, 0, 0)}
    assert got.rdd.getNumPartitions() == 4  # 16 corners, 5 a task


@pytest.mark.parametrize("pairs", [4, spatial.COUNTED_PAIRS])
def test_links_of_points_without_their_pairs(spark, monkeypatch, pairs):
    monkeypatch.setattr(spatial, "COUNTED_PAIRS", pairs)
    monkeypatch.setattr(spatial, "close_pairs", None)
    r, d = random.Random(8), 5.0
    spots = [(r.uniform(0, 40), r.uniform(0, 40)) for _ in range(60)] + [(x + r.uniform(-0.01, 0.01), 0.0) for x in (100, 105, 109.9) for _ in range(15)] + [(200.0, 0.0), (205.0, 0.0), (209.999, 0.0)] * 9
    rows = [(i, r.randrange(2), x, y) for i, (x, y) in enumerate(spots)] + [(7, 0, 200.0, 0.0), (7, 0, 201.0, 0.0), (8, 1, 201.0, 1.0), (0, 0, 3.0, 3.0), (900, 0, math.nan, 0.0), (901, 0, None, 0.0), (902, None, 1.0, 0.0)]
    rows += rows[:2]
    want, ok = dict.fromkeys((p[0] for p in rows), 0), [p for p in set(rows) if p[0] < 900]
    for p in ok:
        want[p[0]] += sum(p[0] != q[0] and p[1] == q[1] and math.dist(p[2:], q[2:]) < d for q in ok)
    df = frame(spark, rows, "id long, section int, x double, y double")
    got = spatial.linked_points(df, d).collect()
    assert {x["id"]: x["links"] for x in got} == want and len(got) == len(want)
    comps = {x["id"]: x["comp"] for x in spatial.grouped_points(df, d).collect()}
    assert {x["id"]: x["comp"] for x in got} == comps


def test_nearest_within_a_distance_makes_no_pairs(spark, monkeypatch):
    monkeypatch.setattr(spatial, "close_pairs", None)
    r = random.Random(9)
    spot = lambda: (r.randint(0, 40) * 1.0, r.choice([0.0, 0.5, r.uniform(0, 90)]))
    a = [(i, i % 3, *spot()) for i in range(300)] + [(900, 1, math.nan, 1.0), (901, 1, None, 1.0), (5, 2, 1.0, 1.0), (6, 0, 30.0, 80.0)]
    b = [(i, i % 2, *spot()) for i in range(60)] + [(900, 1, math.nan, 1.0), (700, 2, 1.0, 6.0), (699, 2, 4.0, 5.0)]
    near = {}
    for p in a:
        for q in b:
            if p[1] == q[1] and p[2] is not None and math.dist(p[2:], q[2:]) < 5:
                near[p[1], p[0]] = min(near.get((p[1], p[0]), (9.0, 0)), (math.dist(p[2:], q[2:]), q[0]))
    got = found(spatial.nearest(frame(spark, a, POINT), frame(spark, b, POINT), ["t"], 5.0))
    assert got == {k: (i, round(v, 9)) for k, (v, i) in near.items()}
    marks = lambda rows: frame(spark, rows, POINT)
    made = scores.build_training_set(marks([*a[:9], a[0]]), [marks([(1, *a[0][1:])]), marks([(2, *a[1][1:])])], marks([(3, *a[2][1:])]), marks([(4, 2, 0.0, 0.0)]), 0.25, ["t"])
    labels = [(x["id"], x["label"]) for x in made.collect()]
    assert labels.count((0, 1)) == 2 and (1, 1) in labels and (2, 0) in labels


def test_candidates_of_a_cell_are_one_row(spark, monkeypatch):
    plans, plain = [], spatial._compared

    def kept(*args):
        out = plain(*args)
        plans.append(out._jdf.queryExecution().optimizedPlan().toString())
        return out

    monkeypatch.setattr(spatial, "_compared", kept)
    a, b = [(i, 1, float(i), 0.0) for i in range(9)], [(i, 1, i % 7 + 0.25, 0.25 * (i % 3)) for i in range(40)]
    assert found(spatial.nearest_in_tile(frame(spark, a, POINT), frame(spark, b, POINT), ["t"])) == looked_up(a, b)
    assert plans and all("array_min" in p for p in plans)  # the aggregate sorts places by cells, not by candidates


def test_components_broadcast_nothing(spark, monkeypatch):
    plans = []

    def kept(df, tag):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, tag)

    monkeypatch.setattr(graphs, "stored", kept)
    edges = frame(spark, [(i, i + 1) for i in range(6)], "a long, b long")
    assert {r["comp"] for r in graphs.components(edges, 1).collect()} == {0}
    assert any("SortMergeJoin" in p for p in plans) and not any("Broadcast" in p for p in plans)


@pytest.mark.parametrize("cutoff", [6.0, math.inf])
def test_tiles_match_as_all_pairs_do(spark, monkeypatch, cutoff):
    # even places, equal distances, copies of a place, a crowd; many tiles, and no table of pairs
    monkeypatch.setattr(spatial, "FEW", 0)
    monkeypatch.setattr(spatial, "CROWD", 120)
    monkeypatch.setattr(spatial, "close_pairs", None)
    r = random.Random(11)
    spots = [lambda: (r.uniform(0, 90), r.uniform(0, 60)), lambda: (20.0 * r.randint(0, 4), r.randint(0, 4000) / 100), lambda: (float(r.randint(0, 12)), float(r.randint(0, 9))), lambda: (50.0 + r.random() * 1e-3, r.random() * 1e-3) if r.random() < 0.5 else (r.uniform(0, 90), 7.0)]
    side = lambda first, n: [(first + i, k, *spot()) for k, spot in enumerate(spots) for i in r.sample(range(n), n)]
    a, b = [*side(2**60, 260), (7, 0, math.nan, 1.0), (8, 9, 1.0, 1.0)], [*side(2**61, 240), (7, None, 1.0, 1.0), (None, 0, 1.0, 1.0)]
    want = [p for k in range(len(spots)) for p in greedy([p for p in a if p[1] == k and p[2] == p[2]], [p for p in b if p[1] == k and p[0]], cutoff)]
    pairs = spatial.match_points(frame(spark, a, POINT), frame(spark, b, POINT), cutoff, ["t"])
    assert sorted((x["id_a"], x["id_b"]) for x in pairs.collect()) == sorted(want)


def test_a_sweep_deals_points_to_tiles_once(spark, monkeypatch):
    monkeypatch.setattr(spatial, "FEW", 0)
    monkeypatch.setattr(spatial, "CROWD", 150)
    sizes, plain = [], spatial._in_tiles

    def counted(points, *more):
        sizes.append(points.count())
        return plain(points, *more)

    monkeypatch.setattr(spatial, "_in_tiles", counted)
    r = random.Random(12)
    side = lambda n: [(i, "ab"[i % 2], r.uniform(0, 80), r.uniform(0, 80), r.choice([0.1, 0.5, 0.9, None, math.nan])) for i in range(n)]
    a, b = side(400), side(380)
    schema = "id long, prep string, x double, y double, p double"
    sweep = {x["threshold"]: x["tp"] for x in spatial.f1_sweep(frame(spark, a, schema).drop("p"), frame(spark, b, schema), [0.2, 0.5, 0.7], 5, "prep").collect()}
    passes = lambda p, t: p is not None and (p >= t or p != p)
    assert sweep == {t: sum(len(greedy([q[:4] for q in a if q[1] == k], [q[:4] for q in b if q[1] == k and passes(q[4], t)], 5)) for k in "ab") for t in (0.2, 0.5, 0.7)}
    assert sizes[0] == 400 + sum(q[4] is not None for q in b)


def test_only_places_without_a_candidate_in_their_cell_are_searched(spark, monkeypatch):
    sizes, plain = [], spatial._nearest

    def counted(queries, *more):
        sizes.append(queries.count())
        return plain(queries, *more)

    monkeypatch.setattr(spatial, "_nearest", counted)
    r, d = random.Random(13), 5.0
    crowd = lambda first, n: [(first + i, 1, r.uniform(0, 12), r.uniform(0, 12)) for i in range(n)]
    few = lambda first, n: [(first + i, i % 3, r.choice([5.0 * r.randint(20, 30), r.uniform(90, 160)]), 5.0 * r.randint(0, 4)) for i in range(n)]
    odd = [(900, 1, math.nan, 1.0), (901, 1, None, 1.0), (902, None, 1.0, 1.0), (None, 1, 2.0, 2.0), (903, 2, 4e15, 0.0), (904, 2, 4e15 + 8, 0.0), (3, 2, 1e3, 1e3)]
    rows = [*crowd(0, 600), *few(1000, 60), *odd]
    marks = [*crowd(2000, 400), *few(3000, 40), (905, 2, 4e15 + 4, 3.0), (906, 1, math.nan, 1.0)]
    near = lambda p: any(p[1] == q[1] and p[2] is not None and math.dist(p[2:], q[2:]) < d for q in marks)
    ids = {p[0] for p in rows if near(p)} - {None}
    df, there = frame(spark, rows, POINT), frame(spark, marks, POINT)
    kept = spatial.exclude_detections(df, frame(spark, [(7,)], "t int"), frame(spark, [], "id long"), there, d, ["t"])
    gone = {(p[1], p[0]) for p in rows if near(p)} - {(1, None)}
    assert sorted(map(repr, kept.select("id", "t").collect())) == sorted(repr(x) for x in df.select("id", "t").collect() if (x["t"], x["id"]) not in gone)
    made = scores.build_training_set(df, [there.where("id % 2 = 0"), there.where("id % 2 = 1")], frame(spark, rows[-1:], POINT), frame(spark, [(1, 0, 0.0, 0.0)], POINT), d, ["t"])
    labels = [(x["id"], x["label"]) for x in made.collect()]
    assert sorted(labels) == sorted((p[0], int(p[0] in ids)) for p in rows if p[0] in ids or p[0] == 3 or p[1] == 0)
    assert sizes and max(sizes) < 100 and made.columns == ["t", "id", "x", "y", "label"]


def test_links_are_counted_in_blocks_without_tables_of_cells(spark, monkeypatch):
    called, plain = [], spatial._counted

    def counted(*args):
        called.append(1)
        return plain(*args)

    monkeypatch.setattr(spatial, "_counted", counted)
    r, d = random.Random(14), 2.0
    spots = [(r.uniform(-60, 60), r.uniform(-60, 60)) for _ in range(500)] + [(r.uniform(23, 25), r.uniform(23, 25)) for _ in range(250)] + [(20.0 * r.randint(0, 3), r.randint(0, 600) / 10) for _ in range(350)] + [(-24.0, -24.0)] * 5 + [(-26.0, -24.0), (-25.999, -24.0)]
    rows = [(i, i % 2, "k" if i % 3 else "l", x, y) for i, (x, y) in enumerate(spots)] + [(9000, 0, "k", math.nan, 1.0), (9001, None, "k", 1.0, 1.0)]
    df = frame(spark, rows, "id long, section int, prep string, x double, y double")
    want = {p[0]: sum(p[0] != q[0] and None is not p[1] == q[1] and p[2] == q[2] and math.sqrt((p[3] - q[3]) ** 2 + (p[4] - q[4]) ** 2) < d for q in rows) for p in rows}
    links = lambda: {x["id"]: x["near"] - x["own"] for x in spatial._near_rows(df, d, ["x", "y"], ["section", "prep"]).groupBy("id").agg(F.sum("near").alias("near"), F.count(F.lit(1)).alias("own")).collect()}
    monkeypatch.setattr(spatial, "BUCKET", 400)
    assert links() == {k: v for k, v in want.items() if k < 9000} and not called
    assert {x["id"]: x["links"] for x in spatial.linked_points(df, d, keys=["section", "prep"]).collect()} == want
    before = len(called)
    monkeypatch.setattr(spatial, "LARGEST", 10)  # a block that one task doesn't hold
    assert {x["id"]: x["links"] for x in spatial.linked_points(df, d, keys=["section", "prep"]).collect()} == want and len(called) == before + 1
