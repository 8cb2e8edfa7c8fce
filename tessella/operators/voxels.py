"""Sparse volumes (x, y, z, label) and pixel tables (section, x, y, value); absent means 0."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.functions.columns import all_of, divided, truncated
from tessella.functions.session import stored
from tessella.operators import spatial
from tessella.operators.ranges import percentiles

XYZ = ["x", "y", "z"]


def in_bounds(pts: DataFrame, dims: dict[str, float]) -> DataFrame:
    """Points with 0 <= coordinate < dim."""
    return pts.where(all_of((F.col(c) >= 0) & (F.col(c) < d) for c, d in dims.items()))


def _inside(ranges: dict[str, tuple]) -> Column:
    return all_of((F.col(c) >= a) & (F.col(c) < b) for c, (a, b) in ranges.items())


def mask_box(vox: DataFrame, ranges: dict[str, tuple], keep: bool = False) -> DataFrame:
    """Labels inside the box become 0, or, with ``keep``, those outside."""
    inside = _inside(ranges)
    return vox.withColumn("label", F.when(~inside if keep else inside, F.lit(0)).otherwise(F.col("label")))


def crop_box(vox: DataFrame, ranges: dict[str, tuple]) -> DataFrame:
    """Voxels inside the box, counted from its lower corner."""
    return vox.where(_inside(ranges)).withColumns({c: F.col(c) - a for c, (a, _) in ranges.items()})


# --- points and labels --------------------------------------------------------------------


def point_labels(pts: DataFrame, vox: DataFrame) -> DataFrame:
    """Each point with its voxel's label; coordinates are cut toward zero, points without a voxel go."""
    at = {f"__{c}": F.col(c).cast("long") for c in XYZ}
    keyed = vox.select(*(F.col(c).cast("long").alias(f"__{c}") for c in XYZ), "label")
    return pts.withColumns(at).join(keyed, list(at)).drop(*at)


def region_counts(pts: DataFrame, vox: DataFrame, regions: DataFrame) -> DataFrame:
    """Points by region; label 0 and labels without a region go."""
    counts = point_labels(pts, vox).where("label <> 0").groupBy("label").agg(F.count(F.lit(1)).alias("cells"))
    return counts.join(regions, counts["label"] == regions["id"]).drop("label")


def all_region_counts(regions: DataFrame, counts: DataFrame, on: str = "id", value: str = "cells") -> DataFrame:
    """All regions with their counts, 0 where there are none."""
    return regions.join(counts.select(on, value), on, "left").withColumn(value, F.coalesce(value, F.lit(0)).cast("long"))


def region_counts_atlas(pts: DataFrame, vox: DataFrame, rotation: list, shift: list, resolution: float, shape: dict, grid=(10, 10, 20), coarse=(0.1, 0.1, 0.2)) -> DataFrame:
    """Points by label on a coarse grid: scaled, moved, divided, cut and counted from 1, strictly inside."""
    p = [F.col(c) * resolution for c in XYZ]
    moved = [sum((p[j] * rotation[i][j] for j in range(3)), F.lit(0.0)) + shift[i] for i in range(3)]
    at = {c: truncated(moved[i] / grid[i] * coarse[i]) - 1 for i, c in enumerate(XYZ)}
    placed = pts.select("id", *(v.alias(c) for c, v in at.items()))
    inside = placed.where(all_of((F.col(c) > 0) & (F.col(c) < n) for c, n in shape.items()))
    return point_labels(inside, vox).groupBy("label").agg(F.count(F.lit(1)).alias("cells"))


def hist3d(pts: DataFrame, size: float = 1.0) -> DataFrame:
    """Points by cube, counted from each axis's smallest value; bins are floors of plain quotients."""
    low = pts.agg(*(F.min(c).alias(f"{c}0") for c in XYZ))
    bins = pts.join(F.broadcast(low))  # one row
    at = [F.floor((F.col(c) - F.col(f"{c}0")) / size).alias(f"b{c}") for c in XYZ]
    return bins.groupBy(*at, *(F.col(f"{c}0") for c in XYZ)).agg(F.count(F.lit(1)).alias("n"))


def pool_counts(counts: DataFrame, brains: list, brain: str = "brain", region: str = "region", value: str = "n") -> DataFrame:
    """Region by brain, 0 where absent."""
    return counts.groupBy(region).pivot(brain, brains).agg(F.sum(value)).na.fill(0)


def voxel_overlap(vox: DataFrame, value: str = "v") -> DataFrame:
    """Brains in which a voxel is positive."""
    return vox.where(F.col(value) > 0).groupBy(*XYZ).agg(F.count_distinct("brain").alias("brains"))


def voxel_multiplicity(pts: DataFrame) -> DataFrame:
    return pts.groupBy(*(F.col(c).cast("long").alias(c) for c in XYZ)).agg(F.count(F.lit(1)).alias("n"))


def voxels_in_region(vox: DataFrame) -> DataFrame:
    return vox.groupBy("label").agg(F.count(F.lit(1)).alias("voxels"))


def center_of_mass(vox: DataFrame, by: list[str] = (), origin: dict | None = None) -> DataFrame:
    """Mean place; of no voxels it is (0, 0, 0). ``origin`` is added."""
    origin = origin or {}
    return vox.groupBy(*by).agg(*((F.coalesce(F.avg(c), F.lit(0.0)) + origin.get(c, 0)).alias(c) for c in XYZ))


def sided_centers(vox: DataFrame, mid: float, um: float = 25) -> DataFrame:
    """Centre of each label's half below and from the middle plane, in micrometres."""
    side = F.when(F.col("z") < mid, "L").otherwise("R")
    return vox.groupBy("label", side.alias("side")).agg(*((F.avg(c) * um).alias(c) for c in XYZ))


def polygon_bounds(polygons: DataFrame, by: str = "session_id", axes=("x", "y", "section")) -> DataFrame:
    """Lowest corner and size of each region's vertices."""
    return polygons.groupBy(by).agg(*(F.min(c).alias(f"{c}0") for c in axes), *((F.max(c) - F.min(c)).alias(f"{c}_size") for c in axes))


def merged_bbox(bounds: DataFrame, axes=("x", "y", "section")) -> DataFrame:
    """The box around all boxes; sizes count both ends."""
    return bounds.agg(*(F.min(f"{c}0").alias(f"{c}0") for c in axes), *((F.max(F.col(f"{c}0") + F.col(f"{c}_size")) - F.min(f"{c}0") + 1).alias(f"{c}_size") for c in axes))


def mean_by_region(pts: DataFrame, by: str = "abbr") -> DataFrame:
    return pts.groupBy(by).agg(*(F.avg(c).alias(c) for c in XYZ))


# --- layout by a space-filling key --------------------------------------------------------

#: Bits of each axis in the key; coordinates count from ``ORIGIN``.
KEY_BITS, ORIGIN = 20, -(1 << 19)
#: Ranges of the key at most that a box is cut into.
KEY_RANGES = 64


def _spread(v: Column) -> Column:
    """The bits of a number of KEY_BITS bits, two apart."""
    for shift, mask in ((32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
    return v


def space_key(x="x", y="y", z="z") -> Column:
    """A number in which near voxels are mostly near: the bits of x, y and z take turns (Z order). Null beyond the key's range."""
    within = [F.col(c).cast("long") - ORIGIN for c in (x, y, z)]
    inside = all_of(v.between(0, (1 << KEY_BITS) - 1) for v in within)
    bits = [_spread(v) for v in within]
    return F.when(inside, bits[0].bitwiseOR(F.shiftleft(bits[1], 1)).bitwiseOR(F.shiftleft(bits[2], 2)))


def write_by_place(vox: DataFrame, path: str, group_bytes: int = 8 << 20) -> None:
    """Voxels as Parquet in the order of ``space_key`` (a column ``key``), so that a row group covers a small part of space."""
    keyed = vox.withColumn("key", space_key())
    keyed.repartitionByRange("key").sortWithinPartitions("key").write.option("parquet.block.size", group_bytes).mode("overwrite").parquet(path)


def key_ranges(low: tuple[int, int, int], high: tuple[int, int, int], most: int = KEY_RANGES) -> list[tuple[int, int]]:
    """At most ``most`` ranges of keys that hold all voxels of a box: cells of an octree, the largest ones cut first."""
    low, high = [v - ORIGIN for v in low], [v - ORIGIN for v in high]
    done, todo = [], [(0, KEY_BITS, (0, 0, 0))]
    while todo and len(done) + len(todo) * 8 <= most:
        key, bits, corner = todo.pop(0)
        size = 1 << bits
        if all(a <= c and c + size - 1 <= b for a, b, c in zip(low, high, corner)):
            done.append((key, bits))
            continue
        half = size >> 1
        for child in range(8):
            at = tuple(c + half * (child >> i & 1) for i, c in enumerate(corner))
            if all(a <= c + half - 1 and c <= b for a, b, c in zip(low, high, at)):
                todo.append((key + (child << 3 * (bits - 1)), bits - 1, at))
    out: list[list[int]] = []
    for key, bits in sorted(done + [(k, b) for k, b, _ in todo]):
        if out and out[-1][1] + 1 == key:
            out[-1][1] = key + (1 << 3 * bits) - 1
        else:
            out.append([key, key + (1 << 3 * bits) - 1])
    return [tuple(r) for r in out]


def read_box(spark: SparkSession, path: str, low: tuple[int, int, int], high: tuple[int, int, int]) -> DataFrame:
    """The voxels of a box, corners included, of a table that ``write_by_place`` wrote: other row groups aren't read."""
    table = spark.read.parquet(path)
    inside = all_of(F.col(c).between(a, b) for c, a, b in zip(XYZ, low, high))
    near = F.lit(False)
    for a, b in key_ranges(low, high):
        near = near | F.col("key").between(a, b)
    if min(low) < ORIGIN or max(high) >= ORIGIN + (1 << KEY_BITS):
        near = near | F.col("key").isNull()
    return table.where(inside & near).drop("key")


# --- pixels -------------------------------------------------------------------------------


def intensity_histogram(pixels: DataFrame, mask: DataFrame) -> DataFrame:
    return pixels.join(mask, ["section", "x", "y"], "left_semi").groupBy("section", "value").agg(F.count(F.lit(1)).alias("n"))


def combined_histogram(pixels: DataFrame, least: int = 10) -> DataFrame:
    """Counts by value over the stack, divided by its sections; nothing for few sections."""
    sections = pixels.agg(F.count_distinct("section").alias("__n"))
    counts = pixels.groupBy("value").agg(F.count(F.lit(1)).alias("c"))
    return counts.join(F.broadcast(sections)).where(F.col("__n") > least).select("value", (F.col("c") / F.col("__n")).alias("n"))


def apply_mask(pixels: DataFrame, mask: DataFrame, factor: int = 1) -> DataFrame:
    """Pixels under the mask, which may be coarser by a whole factor."""
    if factor == 1:
        return pixels.join(mask, ["section", "x", "y"], "left_semi")
    keys = {f"__{c}": F.floor(F.col(c) / factor) for c in "xy"}
    coarse = mask.select("section", *(F.col(c).alias(f"__{c}") for c in "xy"))
    return pixels.withColumns(keys).join(coarse, ["section", *keys], "left_semi").drop(*keys)


def rescale_intensity(pixels: DataFrame, top: float = 30000) -> DataFrame:
    """By section: positive values above the 99 % point become the 90 % point, then the new 99 % point becomes ``top``."""
    q = percentiles(pixels.where("value > 0"), ["section"], "value", {"q90": 0.9, "q99": 0.99})
    capped = pixels.join(q, "section").withColumn("value", F.when(F.col("value") > F.col("q99"), F.col("q90")).otherwise(F.col("value")).cast("double"))
    again = percentiles(capped.where("value > 0"), ["section"], "value", {"r99": 0.99})
    return capped.join(again, "section").withColumn("value", F.col("value") * top / F.col("r99")).drop("q90", "q99", "r99")


def normalize_bits(pixels: DataFrame, bits: int) -> DataFrame:
    """Smallest to largest value of a section as 0 to 2^bits, rounded half to even, less 1."""
    ends = pixels.groupBy("section").agg(F.min("value").alias("mn"), F.max("value").alias("mx"))
    share = divided(F.col("value") - F.col("mn"), F.col("mx") - F.col("mn"))
    return pixels.join(ends, "section").withColumn("value", F.bround(share * 2**bits - 1, 0)).drop("mn", "mx")


def mask_box_per_section(blobs: DataFrame, least_area: int = 100, margin: int = 2) -> DataFrame:
    """Box around a section's components (section, comp, x, y) with more than ``least_area`` pixels, with a margin."""
    size = Window.partitionBy("section", "comp")
    large = blobs.withColumn("__area", F.count(F.lit(1)).over(size)).where(F.col("__area") > least_area)
    low = lambda c: F.greatest(F.min(c) - margin, F.lit(0))
    return large.groupBy("section").agg(low("x").alias("x1"), low("y").alias("y1"), (F.max("x") + margin).alias("x2"), (F.max("y") + margin).alias("y2"))


# --- volumes ------------------------------------------------------------------------------


def dice(a: DataFrame, b: DataFrame) -> DataFrame:
    """Twice the shared voxels over all voxels, by label."""
    keys = [*XYZ, "label"]
    both = a.select(*keys, F.lit(1).alias("a")).join(b.select(*keys, F.lit(1).alias("b")), keys, "full")
    counts = both.groupBy("label").agg(F.count("a").alias("a"), F.count("b").alias("b"), F.count(F.col("a") + F.col("b")).alias("both"))
    return counts.select("label", (2 * F.col("both") / (F.col("a") + F.col("b"))).alias("dice"))


def gaussian(sigma: float, radius: int | None = None) -> list[tuple[int, float]]:
    radius = radius if radius is not None else int(4 * sigma + 0.5)
    raw = [(i, math.exp(-0.5 * (i / sigma) ** 2)) for i in range(-radius, radius + 1)]
    total = sum(w for _, w in raw)
    return [(i, w / total) for i, w in raw]


def smooth(vox: DataFrame, sigma: float, value: str = "v", by: list[str] = (), radius: int | None = None) -> DataFrame:
    """Separable Gaussian of sparse voxels, one axis after another."""
    kernel = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(w).alias("w")) for i, w in gaussian(sigma, radius)))
    out = vox.select(*by, *XYZ, F.col(value).cast("double").alias(value))
    for axis in XYZ:
        spread = out.select(*by, *(c for c in XYZ if c != axis), F.explode(F.transform(kernel, lambda k: F.struct((F.col(axis) + k["i"]).alias("at"), (F.col(value) * k["w"]).alias("part")))).alias("k"))
        out = spread.groupBy(*by, *(c for c in XYZ if c != axis), F.col("k.at").alias(axis)).agg(F.sum("k.part").alias(value))
    return out


def merge_volumes(vox: DataFrame, margin: int = 0, threshold: float = 0.25) -> DataFrame:
    """Average shape: volumes centred in the largest box, overlaps over the largest one, cut at the threshold.

    One brain is returned as it is. ``vox``: brain, x, y, z.
    """
    boxes = vox.groupBy("brain").agg(*(F.min(c).alias(f"{c}0") for c in XYZ), *((F.max(c) - F.min(c) + 1).alias(f"{c}n") for c in XYZ))
    largest = boxes.agg(*(F.max(f"{c}n").alias(f"{c}m") for c in XYZ), F.count(F.lit(1)).alias("brains"))
    placed = vox.join(boxes, "brain").join(F.broadcast(largest))
    shift = [(F.col(c) - F.col(f"{c}0") + F.floor((F.col(f"{c}m") + margin - F.col(f"{c}n")) / 2)).alias(c) for c in XYZ]
    counts = placed.select("brain", "brains", *shift).distinct().groupBy("brains", *XYZ).agg(F.count(F.lit(1)).alias("n"))
    top = counts.agg(F.max("n").alias("top"))
    share = F.col("n") / F.col("top")
    return counts.join(F.broadcast(top)).where((F.col("brains") == 1) | (share > threshold)).select(*XYZ, share.alias("share"))


def assemble(vox: DataFrame, origins: DataFrame) -> DataFrame:
    """One volume of region volumes (region, x, y, z) at the floor of their origins; overlapping ids add up."""
    o = origins.select("region", "id", *(F.floor(c).alias(f"{c}0") for c in XYZ))
    return vox.join(o, "region").groupBy(*((F.col(c) + F.col(f"{c}0")).alias(c) for c in XYZ)).agg(F.sum("id").alias("label"))


def symmetrize(vox: DataFrame, depth: int) -> DataFrame:
    """Floor of the mean of each voxel and its mirror image in z; an odd depth's middle plane stays."""
    own = vox.select(*XYZ, F.col("label").alias("a"))
    mirrored = vox.select("x", "y", (depth - 1 - F.col("z")).alias("z"), F.col("label").alias("b"))
    mean = F.floor((F.coalesce("a", F.lit(0)) + F.coalesce("b", F.lit(0))) / 2)
    middle = (F.col("z") * 2 == depth - 1) if depth % 2 else F.lit(False)
    return own.join(mirrored, XYZ, "full").withColumn("label", F.when(middle, F.col("a")).otherwise(mean)).where("label > 0").select(*XYZ, "label")


def mirror_volume(vox: DataFrame, depth: int) -> DataFrame:
    return vox.withColumn("z", depth - 1 - F.col("z"))


def recenter(vox: DataFrame, low: dict, size: dict) -> DataFrame:
    """Voxels of a box, counted from its lower corner; what lies outside goes."""
    moved = vox.withColumns({c: F.col(c) - low[c] for c in XYZ})
    return in_bounds(moved, size)


def pyramid(vox: DataFrame, factors: tuple[int, int, int], mode: str = "label") -> DataFrame:
    """One level down: the mean of images, the most frequent label of labels (the smaller at ties)."""
    at = [F.floor(F.col(c) / f).alias(c) for c, f in zip(XYZ, factors)]
    if mode == "image":
        return vox.groupBy(*at).agg((F.sum("label") / math.prod(factors)).alias("label"))
    counts = vox.groupBy(*at, "label").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*XYZ).agg(F.max(F.struct("n", (-F.col("label")).alias("l")))["l"].alias("l")).select(*XYZ, (-F.col("l")).alias("label"))


def chunk_address(vox: DataFrame, chunk=(64, 64, 64), level: int = 0) -> DataFrame:
    """Chunk of each voxel at a pyramid level."""
    return vox.withColumns({f"chunk_{c}": F.floor(F.col(c) / (n * 2**level)) for c, n in zip(XYZ, chunk)})


def segment_ids(vox: DataFrame) -> DataFrame:
    return vox.where("label <> 0").select("label").distinct()


def threshold_volume(vox: DataFrame, q: float = 0.9, value: str = "v", by: str = "region") -> DataFrame:
    """Voxels of at least the q-quantile of their region's positive ones; 0.5 where there are none."""
    cut = percentiles(vox.where(F.col(value) > 0), [by], value, {"__cut": q})
    return vox.where(F.col(by).isNotNull()).join(cut, by, "left").where(F.col(value) >= F.coalesce("__cut", F.lit(0.5))).drop("__cut")


def origin_from_center(centers: DataFrame, vox: DataFrame, voxel_size: dict, by: str = "region") -> DataFrame:
    """Centre in voxels less the volume's own centre, for regions that have both."""
    own = vox.groupBy(by).agg(*(F.avg(c).alias(f"__{c}") for c in XYZ))
    return centers.join(own, by).select(by, *((F.col(c) / voxel_size[c] - F.coalesce(F.col(f"__{c}"), F.lit(0.0))).alias(c) for c in XYZ))


def stack_volumes(vox: DataFrame, how: str = "sum", value: str = "v") -> DataFrame:
    """Voxelwise sum over brains, or the mean over all brains, absent ones as 0."""
    total = vox.groupBy(*XYZ).agg(F.sum(value).cast("double").alias(value))
    if how == "sum":
        return total
    brains = vox.agg(F.count_distinct("brain").alias("__n"))
    return total.join(F.broadcast(brains)).withColumn(value, F.col(value) / F.col("__n")).drop("__n")


# --- components of voxels -----------------------------------------------------------------


def component_measures(vox: DataFrame) -> DataFrame:
    """Of components (comp, x, y, z, value): truncated centre, voxels, depth, largest value near the centre."""
    measures = vox.groupBy("comp").agg(*(F.avg(c).cast("long").alias(f"c{c}") for c in XYZ), F.count(F.lit(1)).alias("voxels"), (F.max("z") - F.min("z") + 1).alias("depth"))
    near = all_of(F.abs(F.col(c) - F.col(f"c{c}")) <= r for c, r in (("z", 5), ("y", 10), ("x", 10)))
    top = vox.join(measures.hint("merge"), "comp").where(near).groupBy("comp").agg(F.max("value").alias("intensity"))
    return measures.join(top.hint("merge"), "comp", "left")


def find_site(vox: DataFrame, k: float, n: int = 1, neighbours: int = 6, value: str = "value") -> DataFrame:
    """(comp, id, x, y, z, voxels) of the n largest components of voxels (id, x, y, z, value) brighter than mean + k deviations.

    Equal sizes go to the smaller ``comp``. A volume without a bright voxel has no
    site, which is an error.
    """
    bright = stored(bright_voxels(vox, k, value).select("id", *XYZ), "bright")
    if not bright.limit(1).count():
        raise ValueError("no voxel is bright enough for a site")
    found = spatial.voxel_components(bright, neighbours)
    largest = found.groupBy("comp").agg(F.count(F.lit(1)).alias("voxels")).orderBy(F.col("voxels").desc(), "comp").limit(n)
    return bright.join(found.join(F.broadcast(largest), "comp").hint("merge"), F.col("id") == F.col("node")).select("comp", "id", *XYZ, "voxels")


def size_filter(vox: DataFrame, low: int, high: int) -> DataFrame:
    """Voxels of components with ``low`` to ``high`` voxels."""
    sizes = vox.groupBy("comp").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n").between(low, high))
    return vox.join(sizes.select("comp"), "comp", "left_semi")


def bright_voxels(vox: DataFrame, k: float, value: str = "value") -> DataFrame:
    """Voxels above mean + k standard deviations (of the population)."""
    cut = vox.agg((F.avg(value) + k * F.stddev_pop(value)).alias("__cut"))
    return vox.join(F.broadcast(cut)).where(F.col(value) > F.col("__cut")).drop("__cut")


# --- polygons as voxels -------------------------------------------------------------------

#: Corners of polygons, about, that one task puts in order, so that none spills.
CORNERS = 100_000


def rasterize(polygons: DataFrame, by: list[str]) -> DataFrame:
    """Whole grid points inside polygons (``by``, point_order, x, y), edges included.

    Vertices are cut to whole numbers from the lowest corner. A row of the grid
    meets an edge in one place at most; sorted, these places bound the inside. All
    steps go by polygon, so the vertices are shuffled once and the points never.
    """
    order = Window.partitionBy(*by).orderBy("point_order")
    low = Window.partitionBy(*by)
    cut = polygons.repartition(polygons.count() // CORNERS + 1, *by).select(*by, "point_order", *((F.col(c) - F.min(c).over(low)).cast("long").alias(c) for c in "xy"))
    edges = cut.select(*by, F.col("x").alias("x1"), F.col("y").alias("y1"),
                       F.coalesce(F.lead("x").over(order), F.first("x").over(order)).alias("x2"), F.coalesce(F.lead("y").over(order), F.first("y").over(order)).alias("y2"))
    lo, hi, flat = F.least("y1", "y2"), F.greatest("y1", "y2"), F.col("y1") == F.col("y2")
    rows = edges.withColumn("y", F.explode(F.sequence(lo, hi)))
    at = F.col("x1") + (F.col("y") - F.col("y1")) * (F.col("x2") - F.col("x1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0))
    # half-open edges cross each row an even number of times
    met = rows.select(*by, "y", F.when(flat, F.least("x1", "x2").cast("double")).otherwise(at).alias("a"), F.when(flat, F.greatest("x1", "x2").cast("double")).otherwise(at).alias("b"),
                      (~flat & (F.col("y") < hi)).cast("int").alias("crosses"))
    row = Window.partitionBy(*by, "y").orderBy("a")
    so_far = row.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = F.sum("crosses").over(so_far) % 2 == 1  # up to the next place
    spans = met.withColumn("to", F.when(F.col("a").isNotNull(), F.floor(F.when(inside, F.greatest("b", F.lead("a").over(row))).otherwise(F.col("b")))))
    # what a span shares with earlier ones is theirs, so no point comes twice
    known = F.max("to").over(row.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("from", F.greatest(F.ceil("a"), known + 1)).where("from <= to")
    return spans.select(*by, "y", F.explode(F.sequence("from", "to")).alias("x")).select(*by, "x", "y")
