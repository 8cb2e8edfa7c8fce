"""Trees of any depth and breadth against plain walks."""

import random

import pytest

from tessella.operators import hierarchy


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, parent_id long, name string")


def forest(n, seed, shape):
    """Parents of nodes, ids shuffled."""
    r = random.Random(seed)
    pick = {"any": lambda i: r.randrange(i), "chain": lambda i: i - 1, "star": lambda i: 0, "deep": lambda i: max(0, i - r.randint(1, 3))}[shape]
    ids = r.sample(range(10 * n), n)
    rows = [(ids[i], None if i == 0 or (shape == "any" and i % 97 == 0) else ids[pick(i)], f"n{i}") for i in range(n)]
    r.shuffle(rows)
    return rows


def walks(rows):
    """Ancestors of each node, itself first."""
    parent, out = {i: p for i, p, _ in rows}, {}
    for i in parent:
        path = [i]
        while parent.get(path[-1]) is not None and parent[path[-1]] in parent:
            path.append(parent[path[-1]])
        out[i] = path
    return out


@pytest.mark.parametrize("shape", ["any", "chain", "star", "deep"])
def test_trees_of_many_shapes(spark, shape):
    rows = forest(400, 1, shape) + [(99_999, 88_888, "its parent isn't here")]
    tree, paths = frame(spark, rows), walks(rows)
    want = {(a, i, d) for i, path in paths.items() for d, a in enumerate(path)}
    assert sorted(map(tuple, hierarchy.closure(tree).collect())) == sorted(want)
    counts = [(i, i % 7, float(i % 5)) for i, *_ in rows if i % 3] + [(-1, 5, 1.0), (rows[0][0], 1, 1.0)]
    got = {r["id"]: (r["cells"], r["w"]) for r in hierarchy.rollup_counts(tree, spark.createDataFrame(counts, "id long, cells long, w double"), ["cells", "w"]).collect()}
    sums = {i: [0, 0.0] for i in paths}
    for i, c, w in counts:
        for a in paths.get(i, ()):
            sums[a][0] += c
            sums[a][1] += w
    assert got == {i: tuple(v) for i, v in sums.items()}
    spans = {r["id"]: (r["first"], r["last"], r["depth"]) for r in hierarchy.intervals(tree).collect()}
    assert sorted(v[0] for v in spans.values()) == list(range(len(rows)))
    for i, path in paths.items():
        assert spans[i][2] == len(path) - 1
        assert {a for a in spans if spans[a][0] <= spans[i][0] <= spans[a][1]} == set(path)


def test_named_regions_and_levels(spark):
    rows = forest(300, 2, "any")
    tree, paths = frame(spark, rows), walks(rows)
    top = next(i for i, p, _ in rows if p is None)
    name = {i: n for i, _, n in rows}
    got = {(r["id"], r["depth"]) for r in hierarchy.progeny_to_level(tree, name[top], 3).collect()}
    assert got == {(i, p.index(top)) for i, p in paths.items() if top in p and 0 < p.index(top) <= 3}
    vox = spark.createDataFrame([(i,) for i in paths], "label long")
    listed = [name[i] for i in list(paths)[:6]]
    owner = {n: i for i, n in name.items()}
    want = {i: next((owner[n] for n in reversed(listed) if owner[n] in p), i) for i, p in paths.items()}
    got = sorted(r["label"] for r in hierarchy.consolidate(vox, tree, [*listed, "root", None]).collect())
    assert got == sorted(want.values())


def test_cycles_and_two_parents_are_named(spark):
    with pytest.raises(ValueError, match=r"cycle goes through \[4, 5, 6\]"):
        hierarchy.closure(frame(spark, [(1, None, "a"), (2, 1, "b"), (4, 5, "c"), (5, 6, "d"), (6, 4, "e"), (7, 4, "f")]))
    with pytest.raises(ValueError, match=r"cycle goes through \[3\]"):
        hierarchy.closure(frame(spark, [(3, 3, "a")]))
    with pytest.raises(ValueError, match=r"two parents: \[2\]"):
        hierarchy.closure(frame(spark, [(1, None, "a"), (3, None, "a"), (2, 1, "b"), (2, 3, "b")]))


def test_no_tree(spark):
    empty = frame(spark, [])
    assert hierarchy.closure(empty).count() == 0 and hierarchy.intervals(empty).count() == 0


def test_a_chain_of_a_hundred_thousand_levels_below_a_star(spark):
    n, leaves = 100_000, 200_000
    links = spark.range(1, n).selectExpr("id", "id - 1 AS parent_id", "'c' AS name")
    star = spark.range(n, n + leaves).selectExpr("id", "0L AS parent_id", "'s' AS name")
    tree = links.unionByName(star).unionByName(frame(spark, [(0, None, "root")]))
    levels = hierarchy.lifts(tree)
    assert len(levels) == 17
    got = hierarchy.subtree_sums(tree, tree.selectExpr("id", "1L AS cells"), ["cells"], levels).where("id IN (0, 1, 50000, 99999, 100000)")
    assert {r["id"]: r["cells"] for r in got.collect()} == {0: n + leaves, 1: n - 1, 50_000: n - 50_000, 99_999: 1, 100_000: 1}
    below = hierarchy.reached(tree, tree.where("name = 'root'"), levels)
    assert below.selectExpr("count(*)", "max(depth)").first()[0:] == (n + leaves, n - 1)
