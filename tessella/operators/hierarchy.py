"""The region tree: closures, roll-ups, levels, intervals, relabelling. Trees have columns id, parent_id, name.

Nothing walks level by level. Every node knows its ancestor 1, 2, 4, ... levels up
(``lifts``, found by joining such a table with itself), and sums, paths and reach
double with them: what lies less than 2k levels below a node is what lies less than
k below it, and below those that are exactly k below. So a tree costs joins of its
nodes by the logarithm of its depth, and its depth has no limit. A node whose parent
isn't in the tree is a root; a cycle or an id with two parents is an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.session import discard, stored
from tessella.operators.tables import numbered


def lifts(tree: DataFrame) -> list[DataFrame]:
    """Tables (id, up) of ancestors 1, 2, 4, ... levels up, of the nodes that have them; written to the shared folder."""
    nodes = stored(tree.select("id", F.col("parent_id").alias("up")).distinct(), "nodes")
    n = nodes.count()
    twice = nodes.groupBy("id").count().where("count > 1").select("id").limit(5).collect()
    if twice:
        raise ValueError(f"nodes with two parents: {sorted(r['id'] for r in twice)}")
    up, out, reach = stored(nodes.where("up is not null").join(nodes.select(F.col("id").alias("up")), "up", "left_semi").select("id", "up"), "lift"), [], 1
    while up.limit(1).count():
        if reach >= n:  # ancestors so far up are on a cycle
            raise ValueError(f"a cycle goes through {sorted(r['up'] for r in up.select('up').distinct().orderBy('up').limit(5).collect())}")
        out.append(up)
        further = up.select(F.col("id").alias("up"), F.col("up").alias("further"))
        up = stored(up.join(further, "up").select("id", F.col("further").alias("up")), "lift")
        reach *= 2
    return out


def reached(tree: DataFrame, marked: DataFrame | None = None, levels: list[DataFrame] | None = None) -> DataFrame:
    """(id, descendant, depth): every marked node (column id; all if None) with itself and all below it.

    Only rows of the answer are made: a node takes over what the node k levels up has found.
    """
    nodes = tree.select("id").distinct()
    found = nodes if marked is None else nodes.join(marked.select("id").distinct(), "id", "left_semi")
    found = found.select("id", F.col("id").alias("descendant"), F.lit(0).cast("long").alias("depth"))
    reach, spent = 1, None
    for up in lifts(tree) if levels is None else levels:
        found, before = stored(found, "reached"), spent
        spent = found
        discard(*filter(None, [before]))
        over = up.join(found, up["up"] == found["descendant"]).select(found["id"], up["id"].alias("descendant"), (F.col("depth") + reach).alias("depth"))
        found = found.unionByName(over)
        reach *= 2
    return found


def closure(tree: DataFrame) -> DataFrame:
    """(id, descendant, depth): every region with itself and all below it."""
    return reached(tree)


def subtree_sums(tree: DataFrame, own: DataFrame, values: list[str], levels: list[DataFrame] | None = None) -> DataFrame:
    """(id, values): sums of ``own`` (id, values) over each node and all below it, of nodes that have any."""
    summed = own.join(tree.select("id").distinct(), "id", "left_semi").groupBy("id").agg(*(F.sum(v).alias(v) for v in values))
    kinds, spent = dict(summed.dtypes), None
    for up in lifts(tree) if levels is None else levels:
        summed, before = stored(summed, "subtree-sums"), spent
        spent = summed
        discard(*filter(None, [before]))
        lifted = up.join(summed, "id").select(F.col("up").alias("id"), *values)
        summed = summed.unionByName(lifted).groupBy("id").agg(*(F.sum(v).cast(kinds[v]).alias(v) for v in values))
    return summed


def _path_sums(own: DataFrame, value: str, levels: list[DataFrame]) -> DataFrame:
    """(id, value): sums over each node and all above it."""
    for up in levels:
        own = stored(own, "path-sums")
        above = up.join(own.select(F.col("id").alias("up"), F.col(value).alias("__above")), "up").select("id", "__above")
        own = own.join(above, "id", "left").select("id", (F.col(value) + F.coalesce("__above", F.lit(0))).alias(value))
    return own


def intervals(tree: DataFrame) -> DataFrame:
    """(id, first, last, depth): numbers of an Euler tour, children in the order of their ids.

    A node is below another if its ``first`` lies in that one's interval, and a sum
    over a subtree is one over a range of ``first``. Siblings are numbered over
    ranges, so a node may have any number of children.
    """
    levels = lifts(tree)
    nodes = stored(tree.select("id", "parent_id").distinct(), "nodes")
    sizes = stored(subtree_sums(tree, nodes.select("id", F.lit(1).cast("long").alias("n")), ["n"], levels), "sizes")
    parents = levels[0] if levels else nodes.select("id", F.col("id").alias("up")).limit(0)
    family = sizes.join(parents, "id", "left").select("id", "n", "up")
    ranked = numbered(family, ["up"], ["id"], "row")
    # within blocks of siblings, and then over the blocks of a family
    block = F.call_function("div", F.col("row"), F.lit(1024))
    inside = Window.partitionBy("up", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    ranked = stored(ranked.withColumn("block", block).withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0))), "siblings")
    over = Window.partitionBy("up").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = ranked.groupBy("up", "block").agg(F.sum("n").alias("n")).select(F.col("up").alias("up2"), F.col("block").alias("block2"), F.coalesce(F.sum("n").over(over), F.lit(0)).alias("earlier"))
    offset = F.col("before") + F.col("earlier") + F.when(F.col("up").isNull(), 0).otherwise(1)
    steps = ranked.join(blocks, F.col("up").eqNullSafe(F.col("up2")) & (F.col("block") == F.col("block2"))).select("id", offset.alias("first"))
    first = _path_sums(steps, "first", levels)
    depth = _path_sums(nodes.select("id").withColumn("depth", F.lit(1).cast("long")), "depth", levels)
    return first.join(sizes, "id").join(depth, "id").select("id", "first", (F.col("first") + F.col("n") - 1).alias("last"), (F.col("depth") - 1).alias("depth"))


def progeny(tree: DataFrame) -> DataFrame:
    """(id, descendant) of all regions below each region, each once."""
    return closure(tree).where("depth > 0").select("id", "descendant").distinct()


def ancestors(tree: DataFrame) -> DataFrame:
    """Names above each region, the nearest first, without the root."""
    names = tree.select(F.col("id").alias("above"), "name", F.col("parent_id").isNull().alias("root"))
    up = closure(tree).where("depth > 0").select(F.col("id").alias("above"), F.col("descendant").alias("id"), "depth").join(names, "above").where(~F.col("root"))
    chain = F.array_sort(F.collect_list(F.struct("depth", "name")))
    return tree.select("id").join(up.groupBy("id").agg(F.transform(chain, lambda s: s["name"]).alias("chain")), "id", "left").withColumn("chain", F.coalesce("chain", F.array().cast("array<string>")))


def rollup_counts(tree: DataFrame, counts: DataFrame, values: list[str]) -> DataFrame:
    """Sums over each region and all below it, 0 where there are none."""
    return tree.select("id", "name").join(subtree_sums(tree, counts, values), "id", "left").na.fill(0, values)


def rollup_pivot(tree: DataFrame, wide: DataFrame, brains: list[str]) -> DataFrame:
    """The same for one column a brain."""
    return rollup_counts(tree, wide, brains)


def below(tree: DataFrame, name: str) -> DataFrame:
    """(id, depth) of a named region and all below it."""
    return reached(tree, tree.where(F.col("name") == name)).select(F.col("descendant").alias("id"), "depth")


def progeny_to_level(tree: DataFrame, name: str, n: int) -> DataFrame:
    return below(tree, name).where((F.col("depth") > 0) & (F.col("depth") <= n))


def level_counts(tree: DataFrame, counts: DataFrame, name: str, n: int, values: list[str]) -> DataFrame:
    """Regions at level n below a region, and leaves above that level, with rolled-up counts."""
    parents = tree.select(F.col("parent_id").alias("id")).where("id is not null").distinct().withColumn("inner", F.lit(True))
    wanted = progeny_to_level(tree, name, n).join(parents, "id", "left").where((F.col("depth") == n) | F.col("inner").isNull())
    return wanted.select("id", "depth").join(rollup_counts(tree, counts, values), "id")


def consolidate(vox: DataFrame, tree: DataFrame, names: list[str], root: str = "root") -> DataFrame:
    """Voxels under the listed regions take their id; later names win; the root and nulls are ignored."""
    listed = [(i, n) for i, n in enumerate(names) if n and n != root]
    order = F.lit(None).cast("int")
    for i, n in listed:
        order = F.when(F.col("name") == n, F.lit(i)).otherwise(order)
    chosen = tree.select("id", order.alias("ord")).where("ord is not null")
    owner = reached(tree, chosen).join(chosen, "id").groupBy("descendant").agg(F.max_by("id", "ord").alias("owner"))
    return vox.join(owner, vox["label"] == owner["descendant"], "left").withColumn("label", F.coalesce("owner", "label")).drop("owner", "descendant")


def isolate(vox: DataFrame, ids: list[int]) -> DataFrame:
    """Voxels of the given regions as 255, others as 0."""
    return vox.withColumn("label", F.when(F.col("label").isin(*ids), 255).otherwise(0))


def evenly_valued(vox: DataFrame, ids: list[int], top: int = 255) -> DataFrame:
    """Voxels of the given regions with evenly spaced values in the order of their ids."""
    step = F.lit(0)
    for i, k in enumerate(sorted(ids), 1):
        step = F.when(F.col("label") == k, F.lit(i * (top // len(ids)))).otherwise(step)
    return vox.where(F.col("label").isin(*ids)).withColumn("label", step)


def density_scale(counts: DataFrame, value: str = "cells") -> DataFrame:
    """(c - min) / (max - min) * 255."""
    ends = counts.agg(F.min(value).alias("__a"), F.max(value).alias("__b"))
    return counts.join(F.broadcast(ends)).withColumn("density", F.coalesce(F.try_divide((F.col(value) - F.col("__a")) * 255.0, (F.col("__b") - F.col("__a")).cast("double")), F.lit(0.0))).drop("__a", "__b")


def leaves_in_atlas(tree: DataFrame, vox: DataFrame) -> DataFrame:
    """Regions without children stay only if the volume has their label; parents stay."""
    parents = tree.select(F.col("parent_id").alias("id")).where("id is not null").distinct().withColumn("inner", F.lit(True))
    present = vox.select(F.col("label").alias("id")).distinct().withColumn("here", F.lit(True))
    return tree.join(parents, "id", "left").join(present, "id", "left").where(F.col("inner") | F.col("here")).select(*tree.columns)


def weighted_edges(a: DataFrame, b: DataFrame, threshold: float, value: str = "cells") -> DataFrame:
    """Pairs of two small region sets: the mean of their counts, each over its set's largest, above the threshold.

    A score above the threshold needs b's share above 2 * threshold - (a's share), so
    sets are joined on tenths of their shares rather than expanded.
    """
    top = lambda df, n: df.join(F.broadcast(df.agg(F.max(value).alias("__m")))).where(F.col(value) > 0).select(F.col("id").alias(n), (F.col(value) / F.col("__m")).alias(f"s{n}"))
    left, right = top(a, "a"), top(b, "b")
    tenths = left.withColumn("t", F.explode(F.sequence(F.greatest(F.floor((2 * threshold - F.col("sa")) * 10), F.lit(0)), F.greatest(F.lit(10), F.floor((2 * threshold - F.col("sa")) * 10)))))
    score = (F.col("sa") + F.col("sb")) / 2
    return tenths.join(right.withColumn("t", F.floor(F.col("sb") * 10)), "t").select("a", "b", score.alias("score")).where(F.col("score") > threshold)
