"""Fits and moves of points: similarity and rigid transforms, section chains, units, axes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

XYZ = ["x", "y", "z"]
R = [[f"r{i}{j}" for j in range(3)] for i in range(3)]
T = [f"t{i}" for i in range(3)]

# --- fits ---------------------------------------------------------------------------------


def _sums(pairs: DataFrame, by: list[str]) -> DataFrame:
    """Count, means, squared source radius and cross-covariance of each group: one row a group."""
    a, b = [F.col(f"{c}_a") for c in XYZ], [F.col(f"{c}_b") for c in XYZ]
    n = F.count(F.lit(1)).cast("double")
    return pairs.groupBy(*by).agg(
        n.alias("n"), *(F.avg(a[i]).alias(f"ma{i}") for i in range(3)), *(F.avg(b[i]).alias(f"mb{i}") for i in range(3)),
        *(F.avg(a[i] * a[i]).alias(f"q{i}") for i in range(3)), *(F.avg(b[i] * a[j]).alias(f"c{i}{j}") for i in range(3) for j in range(3)),
    )


#: Squarings of a 4 x 4 matrix, after which its largest eigenvalue's share is all that is left of it.
SQUARINGS = 50
#: Where several rotations fit equally well, this share decides for the one nearest to none at all.
TIE = 1e-13
_UPPER = [(i, j) for i in range(4) for j in range(i, 4)]


def _at(m: Column, i: int, j: int) -> Column:
    return m[f"p{min(i, j)}{max(i, j)}"]


def quaternion_matrix(c) -> dict[tuple[int, int], object]:
    """Upper half of the symmetric matrix whose top eigenvector is the best rotation's quaternion; ``c(i, j)`` is the cross-covariance of b_i and a_j."""
    return {
        (0, 0): c(0, 0) + c(1, 1) + c(2, 2), (0, 1): c(2, 1) - c(1, 2), (0, 2): c(0, 2) - c(2, 0), (0, 3): c(1, 0) - c(0, 1),
        (1, 1): c(0, 0) - c(1, 1) - c(2, 2), (1, 2): c(1, 0) + c(0, 1), (1, 3): c(0, 2) + c(2, 0),
        (2, 2): c(1, 1) - c(0, 0) - c(2, 2), (2, 3): c(2, 1) + c(1, 2), (3, 3): c(2, 2) - c(0, 0) - c(1, 1),
    }


def rotation_of(p) -> list[list]:
    """The rotation of a unit quaternion whose products q_i q_j are ``p(i, j)``."""
    return [
        [p(0, 0) + p(1, 1) - p(2, 2) - p(3, 3), 2 * (p(1, 2) - p(0, 3)), 2 * (p(1, 3) + p(0, 2))],
        [2 * (p(1, 2) + p(0, 3)), p(0, 0) - p(1, 1) + p(2, 2) - p(3, 3), 2 * (p(2, 3) - p(0, 1))],
        [2 * (p(1, 3) - p(0, 2)), 2 * (p(2, 3) + p(0, 1)), p(0, 0) - p(1, 1) - p(2, 2) + p(3, 3)],
    ]


def _projector(entries: dict[tuple[int, int], Column]) -> Column:
    """Of a symmetric 4 x 4 matrix, the projection onto its top eigenvector, as a struct p00, p01, ..., p33."""
    bound = lambda value, body: F.element_at(F.transform(F.array(value), body), 1)
    packed = F.struct(*(entries[k].alias(f"p{k[0]}{k[1]}") for k in _UPPER))
    norm = lambda m: F.sqrt(sum((_at(m, i, j) * _at(m, i, j) for i in range(4) for j in range(4)), F.lit(0.0)))
    # all eigenvalues positive, the top one largest
    lifted = lambda m, n: F.struct(*(((F.when(n > 0, _at(m, i, j) / n).otherwise(0.0)) + (1.0 if i == j else 0.0) + (TIE if i == j == 0 else 0.0)).alias(f"p{i}{j}") for i, j in _UPPER))
    start = bound(packed, lambda m: bound(norm(m), lambda n: lifted(m, n)))
    square = lambda m, t: F.struct(*((sum((_at(m, i, k) * _at(m, k, j) for k in range(4)), F.lit(0.0)) / t).alias(f"p{i}{j}") for i, j in _UPPER))
    trace = lambda m: sum((_at(m, i, j) * _at(m, i, j) for i in range(4) for j in range(4)), F.lit(0.0))
    return F.aggregate(F.sequence(F.lit(1), F.lit(SQUARINGS)), start, lambda m, _: bound(trace(m), lambda t: square(m, t)))


def fit(pairs: DataFrame, by: list[str], scaled: bool = True, least: int = 3) -> DataFrame:
    """Least-squares transform of the _a points onto the _b points of each group with ``least`` pairs.

    The sums are Spark aggregates; the rotation is that of the quaternion which is
    the top eigenvector of a 4 x 4 matrix of them, found by squaring the matrix, all
    in column expressions. It never reflects. Where several rotations fit equally
    well (points on a line), the one nearest to no rotation is taken.
    """
    sums = _sums(pairs, by).where(F.col("n") >= least)
    cov = lambda i, j: F.col(f"c{i}{j}") - F.col(f"mb{i}") * F.col(f"ma{j}")
    turned = sums.withColumn("__p", _projector(quaternion_matrix(cov)))
    turn = rotation_of(lambda i, j: _at(F.col("__p"), i, j))
    turned = turned.withColumns({f"__{R[i][j]}": turn[i][j] for i in range(3) for j in range(3)})
    spread = F.col("q0") + F.col("q1") + F.col("q2") - sum((F.col(f"ma{i}") * F.col(f"ma{i}") for i in range(3)), F.lit(0.0))
    fitted = sum((F.col(f"__{R[i][j]}") * cov(i, j) for i in range(3) for j in range(3)), F.lit(0.0))
    turned = turned.withColumn("scale", F.when(F.lit(scaled) & (spread > 0), fitted / spread).otherwise(1.0))
    turned = turned.withColumns({R[i][j]: F.col("scale") * F.col(f"__{R[i][j]}") for i in range(3) for j in range(3)})
    moved = [(F.col(f"mb{i}") - sum((F.col(R[i][j]) * F.col(f"ma{j}") for j in range(3)), F.lit(0.0))).alias(T[i]) for i in range(3)]
    return turned.select(*by, *sum(R, []), *moved, "scale", "n")


def fit_similarity(pairs: DataFrame, by: list[str]) -> DataFrame:
    return fit(pairs, by, True)


def fit_rigid(pairs: DataFrame, by: list[str]) -> DataFrame:
    return fit(pairs, by, False)


def align_brains(points: DataFrame, fixed, brain: str = "prep", key: str = "abbr", subset: Column | None = None) -> DataFrame:
    """Transform of every brain onto the fixed one from the regions both have; identity for itself."""
    rows = points if subset is None else points.where(subset)
    target = rows.where(F.col(brain) == fixed).select(key, *(F.col(c).alias(f"{c}_b") for c in XYZ))
    moving = rows.where(F.col(brain) != fixed).select(brain, key, *(F.col(c).alias(f"{c}_a") for c in XYZ))
    found = fit(moving.join(target, key), [brain])
    unit = [F.lit(1.0 if i == j else 0.0).alias(R[i][j]) for i in range(3) for j in range(3)]
    own = points.where(F.col(brain) == fixed).select(brain).distinct().select(brain, *unit, *(F.lit(0.0).alias(t) for t in T), F.lit(1.0).alias("scale"), F.lit(0.0).alias("n"))
    return found.unionByName(own)


def apply_transform(points: DataFrame, transforms: DataFrame, by: list[str]) -> DataFrame:
    """R p + t."""
    joined = points.join(transforms.select(*by, *sum(R, []), *T), by)
    moved = {c: sum((F.col(R[i][j]) * F.col(XYZ[j]) for j in range(3)), F.col(T[i])) for i, c in enumerate(XYZ)}
    return joined.withColumns(moved).select(*points.columns)


def apply_inverse(points: DataFrame, transforms: DataFrame, by: list[str]) -> DataFrame:
    """The point that R p + t would move here, by cofactors."""
    joined = points.join(transforms.select(*by, *sum(R, []), *T), by)
    m = lambda i, j: F.col(R[i % 3][j % 3])
    cofactor = lambda i, j: m(i + 1, j + 1) * m(i + 2, j + 2) - m(i + 1, j + 2) * m(i + 2, j + 1)
    det = sum((m(0, j) * cofactor(0, j) for j in range(3)), F.lit(0.0))
    p = [F.col(c) - F.col(t) for c, t in zip(XYZ, T)]
    back = {c: sum((cofactor(j, i) * p[j] for j in range(3)), F.lit(0.0)) / det for i, c in enumerate(XYZ)}
    return joined.withColumns(back).select(*points.columns)


# --- units, grids, axes -------------------------------------------------------------------


def to_um(points: DataFrame, scans: DataFrame, histology: DataFrame) -> DataFrame:
    """Pixels as micrometres by the brain's resolutions; the slicing direction has the coarse one."""
    unit = scans.join(histology.select("prep_id", "orientation"), "prep_id").select("prep_id", "orientation", F.col("resolution").alias("__r"), F.col("zresolution").alias("__z"))
    o = F.col("orientation")
    factor = {"x": F.when(o == "coronal", F.col("__z")).otherwise(F.col("__r")), "y": F.when(o == "horizontal", F.col("__z")).otherwise(F.col("__r")), "z": F.when(o == "sagittal", F.col("__z")).otherwise(F.col("__r"))}
    # coronal z,r,r; horizontal r,z,r; sagittal r,r,z
    return points.join(unit, "prep_id").withColumns({c: F.col(c) * f for c, f in factor.items()}).drop("orientation", "__r", "__z")


def resample_points(points: DataFrame, source: dict, target: dict) -> DataFrame:
    """From one grid's voxels to another's."""
    return points.withColumns({c: F.col(c) * (target[c] / source[c]) for c in source})


def reorient(points: DataFrame, axes: tuple[str, str, str], dims: dict) -> DataFrame:
    """Axes as ('2', '-0', '1'): the new i-th axis is the named old one, counted from its end if negative."""
    old = {}
    for a in axes:
        c = XYZ[int(a.lstrip("-"))]
        old[c] = dims[c] - (F.col(c) + 1) if a.startswith("-") else F.col(c)
    return points.withColumns({XYZ[i]: old[XYZ[int(a.lstrip("-"))]] for i, a in enumerate(axes)})


# --- two-dimensional section transforms ---------------------------------------------------


def params_to_matrix(df: DataFrame, center: tuple[float, float]) -> DataFrame:
    """Angle and shifts about a centre as a matrix (a, b, c, d) and its shift (tx, ty)."""
    cos, sin = F.cos("rotation"), F.sin("rotation")
    cx, cy = map(F.lit, map(float, center))
    return df.withColumns({"a": cos, "b": -sin, "c": sin, "d": cos, "tx": cx + F.col("xshift") - (cos * cx - sin * cy), "ty": cy + F.col("yshift") - (sin * cx + cos * cy)})


def matrix_to_params(df: DataFrame, center: tuple[float, float]) -> DataFrame:
    cx, cy = map(F.lit, map(float, center))
    return df.withColumns({
        "rotation": F.atan2(F.col("c"), F.col("a")),
        "xshift": F.col("tx") - cx + (F.col("a") * cx + F.col("b") * cy), "yshift": F.col("ty") - cy + (F.col("c") * cx + F.col("d") * cy),
    })


def scale_transform(df: DataFrame, k: float = 32) -> DataFrame:
    """A transform of thumbnails at full resolution: its shift times k."""
    return df.withColumns({"tx": F.col("tx") * k, "ty": F.col("ty") * k})


def compose_to_midpoint(tf: DataFrame, by: str = "animal") -> DataFrame:
    """Each section's transform to the animal's middle one, as angle and shift, from its transform to its neighbour.

    Section s leads to s - 1 by its rotation and shift (s >= 1). The middle one
    stays; above it transforms multiply, below it their inverses do. Angles of
    a chain add up, and its shift is the sum of its links' shifts, each turned by
    the angles of the links before it, so two running sums a side do.
    """
    rows = tf.withColumn("mid", F.floor(F.count(F.lit(1)).over(Window.partitionBy(by)) / 2))
    above, below = rows.where("section > mid"), rows.where("section <= mid and section > 0")

    # p -> R_{m+1}(... (R_s p + t_s) ...) + t_{m+1}: link k is turned by the links m+1 .. k-1
    up = Window.partitionBy(by).orderBy("section").rowsBetween(Window.unboundedPreceding, 0)
    angle = F.sum("rotation").over(up)
    before = angle - F.col("rotation")
    up_rows = above.withColumns({"angle": angle, "__x": F.cos(before) * F.col("xshift") - F.sin(before) * F.col("yshift"), "__y": F.sin(before) * F.col("xshift") + F.cos(before) * F.col("yshift")})
    up_rows = up_rows.select(by, "section", "angle", F.sum("__x").over(up).alias("dx"), F.sum("__y").over(up).alias("dy"))

    # section s < mid goes by the inverses of links s+1 .. mid: the inverse of the chain from mid down to s
    down = Window.partitionBy(by).orderBy(F.col("section").desc()).rowsBetween(Window.unboundedPreceding, 0)
    turn = F.sum("rotation").over(down)
    # inverse links: p -> R_k^-1 (p - t_k); link k is turned back by itself and all links after it up to mid
    back = below.withColumns({"__t": turn})
    back = back.withColumns({"__x": -(F.cos("__t") * F.col("xshift") + F.sin("__t") * F.col("yshift")), "__y": -(F.cos("__t") * F.col("yshift") - F.sin("__t") * F.col("xshift"))})
    down_rows = back.select(by, (F.col("section") - 1).alias("section"), (-F.col("__t")).alias("angle"), F.sum("__x").over(down).alias("dx"), F.sum("__y").over(down).alias("dy"))
    middle = rows.where("section = mid").select(by, "section", F.lit(0.0).alias("angle"), F.lit(0.0).alias("dx"), F.lit(0.0).alias("dy"))
    return up_rows.union(down_rows).union(middle)


def align_points(points: DataFrame, composed: DataFrame, by: list[str] = ("animal", "section")) -> DataFrame:
    """Points moved by their section's composed transform."""
    joined = points.join(composed.select(*by, "angle", "dx", "dy"), list(by))
    cos, sin = F.cos("angle"), F.sin("angle")
    return joined.withColumns({"x": cos * F.col("x") - sin * F.col("y") + F.col("dx"), "y": sin * F.col("x") + cos * F.col("y") + F.col("dy")}).drop("angle", "dx", "dy")


def align_contours(points: DataFrame, sizes: DataFrame, composed: DataFrame, canvas: tuple[float, float], by: list[str] = ("animal", "section"), factor: float = 32) -> DataFrame:
    """Vertices in thumbnail pixels, centred on the canvas, then moved back through the section's transform."""
    placed = points.join(sizes, list(by)).withColumns({"x": F.col("x") / factor + (canvas[0] - F.col("width")) / 2, "y": F.col("y") / factor + (canvas[1] - F.col("height")) / 2})
    joined = placed.join(composed.select(*by, "angle", "dx", "dy"), list(by))
    cos, sin, x, y = F.cos("angle"), F.sin("angle"), F.col("x") - F.col("dx"), F.col("y") - F.col("dy")
    return joined.withColumns({"x": cos * x + sin * y, "y": cos * y - sin * x}).drop("angle", "dx", "dy", "width", "height")


def orient_and_place(points: DataFrame, scans: DataFrame, canvas: tuple[float, float], key: str = "prep_id") -> DataFrame:
    """Quarter turns, then flip (up-down) or flop (left-right), then the centre of the largest canvas.

    ``scans``: key, width, height, rotation (quarter turns against the clock), flip.
    """
    j = points.join(scans, key)
    w, h, x, y, q = F.col("width"), F.col("height"), F.col("x"), F.col("y"), F.col("rotation") % 4
    turned_x = F.when(q == 0, x).when(q == 1, y).when(q == 2, w - 1 - x).otherwise(h - 1 - y)
    turned_y = F.when(q == 0, y).when(q == 1, w - 1 - x).when(q == 2, h - 1 - y).otherwise(x)
    tw, th = F.when(q % 2 == 1, h).otherwise(w), F.when(q % 2 == 1, w).otherwise(h)
    fx = F.when(F.col("flip") == "flop", tw - 1 - turned_x).otherwise(turned_x)
    fy = F.when(F.col("flip") == "flip", th - 1 - turned_y).otherwise(turned_y)
    return j.select(*(c for c in points.columns if c not in ("x", "y")), (fx + F.floor((canvas[0] - tw) / 2)).alias("x"), (fy + F.floor((canvas[1] - th) / 2)).alias("y"))


# --- tiles, centres, errors ---------------------------------------------------------------


def assign_tiles(points: DataFrame, width: int, height: int, cols: int = 2, rows: int = 5) -> DataFrame:
    """Tile of each point and its place there; points beyond the last whole tile go."""
    tw, th = width // cols, height // rows
    inside = points.where((F.col("x") >= 0) & (F.col("x") < tw * cols) & (F.col("y") >= 0) & (F.col("y") < th * rows))
    col, row = F.floor(F.col("x") / tw), F.floor(F.col("y") / th)
    return inside.withColumns({"tile": row * cols + col, "tile_x": F.col("x") - col * tw, "tile_y": F.col("y") - row * th})


def offset_table(points: DataFrame, reference: DataFrame, brain: str = "prep", key: str = "abbr", least: int = 3) -> DataFrame:
    """dx, dy, dz and distance of each brain's centres from the reference, long; regions of few brains go.

    A brain without a region that others have gets a null; labels carry the number of brains.
    """
    seen = points.join(reference.select(key), key, "left_semi").groupBy(key).agg(F.count_distinct(brain).alias("brains")).where(F.col("brains") >= least)
    grid = points.select(brain).distinct().crossJoin(seen)  # the result itself has a row for each brain and region
    joined = grid.join(points.select(brain, key, *XYZ), [brain, key], "left").join(reference.select(key, *(F.col(c).alias(f"__{c}") for c in XYZ)), key)
    d = [F.col(c) - F.col(f"__{c}") for c in XYZ]
    values = joined.select(brain, F.concat(key, F.lit("("), F.col("brains").cast("string"), F.lit(")")).alias("region"), *(v.alias(f"d{c}") for v, c in zip(d, XYZ)), F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2]).alias("dist"))
    return values.unpivot([brain, "region"], ["dx", "dy", "dz", "dist"], "measure", "value")


def alignment_error(a: DataFrame, b: DataFrame, key: str = "abbr") -> DataFrame:
    """Distance of the same region's centres and the axis of the largest difference."""
    j = a.select(key, *(F.col(c).alias(f"{c}_a") for c in XYZ)).join(b.select(key, *(F.col(c).alias(f"{c}_b") for c in XYZ)), key)
    d = [F.abs(F.col(f"{c}_a") - F.col(f"{c}_b")) for c in XYZ]
    top = F.greatest(*d)
    axis = F.when(d[0] == top, "x").when(d[1] == top, "y").otherwise("z")
    return j.select(key, F.sqrt(sum((v * v for v in d), F.lit(0.0))).alias("distance"), axis.alias("axis"))


def _prefix() -> Column:
    return F.split("abbr", "_")[0]


def midplane(centers: DataFrame) -> DataFrame:
    """Mean z of unpaired regions, or, without them, of the pairs' middles."""
    rows = centers.withColumn("pair", F.contains("abbr", F.lit("_")))
    pairs = rows.where("pair").groupBy(_prefix().alias("p")).agg(F.avg("z").alias("m"), F.count(F.lit(1)).alias("n")).where("n = 2").agg(F.avg("m").alias("paired"))
    return rows.agg(F.avg(F.when(~F.col("pair"), F.col("z"))).alias("single")).join(F.broadcast(pairs)).select(F.coalesce("single", "paired").alias("mid"))


def mirror_centers(centers: DataFrame, mid: float) -> DataFrame:
    """Left centres from right ones, mirrored about the plane; unpaired regions lie on it."""
    right = centers.where(F.col("abbr").endswith("_R")).select(_prefix().alias("p"), F.col("x").alias("rx"), F.col("y").alias("ry"), F.col("z").alias("rz"))
    j = centers.withColumn("p", F.when(F.col("abbr").endswith("_L"), _prefix())).join(right, "p", "left")
    left, single = F.col("rx").isNotNull(), ~F.contains("abbr", F.lit("_"))
    return j.select(
        "abbr", F.when(left, F.col("rx")).otherwise(F.col("x")).alias("x"), F.when(left, F.col("ry")).otherwise(F.col("y")).alias("y"),
        F.when(left, F.col("rz") - 2 * (F.col("rz") - mid)).when(single, F.lit(float(mid))).otherwise(F.col("z")).alias("z"),
    )


def sort_from_center(polygons: DataFrame, by: list[str]) -> DataFrame:
    """Distinct vertices of convex polygons by falling angle about their mean."""
    u = polygons.select(*by, "x", "y").distinct()
    w = Window.partitionBy(*by)
    # rounded, so that vertices in line with the centre tie however the mean was summed
    angle = F.round(F.atan2(F.col("y") - F.avg("y").over(w), F.col("x") - F.avg("x").over(w)), 9)
    return u.withColumn("angle", angle).withColumn("point_order", F.row_number().over(w.orderBy(F.col("angle").desc(), "x", "y")) - 1).drop("angle")


def densify(polygons: DataFrame, by: list[str]) -> DataFrame:
    """Midpoints between consecutive vertices, the closing one at the end; ``point_order`` counts anew."""
    w = Window.partitionBy(*by).orderBy("point_order")
    following = {c: F.coalesce(F.lead(c).over(w), F.first(c).over(w)) for c in "xy"}
    two = F.array(F.struct(F.lit(0).alias("k"), F.col("x"), F.col("y")), F.struct(F.lit(1).alias("k"), ((F.col("x") + F.col("nx")) / 2).alias("x"), ((F.col("y") + F.col("ny")) / 2).alias("y")))
    rows = polygons.select(*by, (F.row_number().over(w) - 1).alias("i"), "x", "y", following["x"].alias("nx"), following["y"].alias("ny"))
    return rows.select(*by, "i", F.explode(two).alias("v")).select(*by, (F.col("i") * 2 + F.col("v.k")).alias("point_order"), "v.x", "v.y")


def positional_join(lines: DataFrame, centers: DataFrame, by: str, line_order: str, grid: dict) -> DataFrame:
    """The i-th line of a group belongs to its i-th centre by abbreviation; unequal numbers give nothing."""
    i = lambda df, o: df.withColumn("__i", F.row_number().over(Window.partitionBy(by).orderBy(*o)))
    a, b = i(lines.select(by, line_order, *XYZ), [line_order]).drop(line_order), i(centers.select(by, "abbr"), ["abbr"])
    equal = lines.groupBy(by).agg(F.count(F.lit(1)).alias("__n")).join(centers.groupBy(by).agg(F.count(F.lit(1)).alias("__m")), by).where("__n = __m").select(by)
    return a.join(b, [by, "__i"]).join(equal, by, "left_semi").select(by, "abbr", *((F.col(c) * k).alias(c) for c, k in grid.items()))
