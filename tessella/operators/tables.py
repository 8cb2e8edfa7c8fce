"""Relational look-ups, joins and upkeep of the annotation tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.columns import matches
from tessella.functions.session import stored

# --- filters and look-ups -----------------------------------------------------------------


def query_table(df: DataFrame, search: dict) -> DataFrame:
    """All rows whose columns equal the given values."""
    return df.where(matches(search))


def get_row(df: DataFrame, search: dict) -> DataFrame:
    """The one row that matches; none or several raise an error when the result is read."""
    found = query_table(df, search).limit(2)
    counted = found.agg(F.count(F.lit(1)).alias("__n"), *(F.first(c).alias(c) for c in df.columns))
    checked = F.when(F.col("__n") == 1, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("rows that match: "), F.col("__n").cast("string"))).cast("boolean"))
    return counted.where(checked).select(*df.columns)


def row_exists(keys: DataFrame, df: DataFrame, on: list[str]) -> DataFrame:
    """Each row of ``keys`` with a flag ``found``."""
    known = df.select(*on).distinct().withColumn("found", F.lit(True))
    return keys.join(known, on, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def active_regions(df: DataFrame, exclude_ids=(52, 53, 54)) -> DataFrame:
    return df.where(F.col("active") & ~F.col("id").isin(*exclude_ids))


def region_id(df: DataFrame, abbreviation: str) -> DataFrame:
    """Case counts."""
    return df.where(F.col("abbreviation") == abbreviation).select("id")


def region_abbr(df: DataFrame, ident: int) -> DataFrame:
    return df.where(F.col("id") == ident).select("abbreviation")


def label_side(c: Column) -> Column:
    """Side of an abbreviation: its part after an underscore, or Singular."""
    return F.when(c.endswith("_L"), "Left").when(c.endswith("_R"), "Right").otherwise("Singular")


def label_area(c: Column, midbrain: list[str]) -> Column:
    return F.when(F.split(c, "_")[0].isin(*midbrain), "midbrain").otherwise("brainstem")


def paired_regions(df: DataFrame) -> DataFrame:
    return df.where(F.contains("abbreviation", F.lit("_")))


def hex_to_rgb(c: Column) -> list[Column]:
    """Three integers of ``#rrggbb``."""
    return [F.conv(F.substring(c, at, 2), 16, 10).cast("int").alias(n) for n, at in (("r", 2), ("g", 4), ("b", 6))]


def map_labels(c: Column, mapping: dict[str, list[str]]) -> Column:
    """The key whose list of synonyms has the text, else null."""
    out = F.lit(None).cast("string")
    for key, synonyms in mapping.items():
        out = F.when(F.lower(F.trim(c)).isin(*synonyms), F.lit(key)).otherwise(out)
    return out


def compose_category(category: Column, user: Column, source: Column) -> Column:
    """``category_annotator_source`` with the part of the source after its last dash."""
    return F.concat_ws("_", category, user, F.element_at(F.split(source, "-"), -1))


def significant(df: DataFrame, low: float, high: float, p: str = "p", order: tuple[str, ...] = ("grp", "id")) -> DataFrame:
    """Rows with low < p < high, by group."""
    return df.where((F.col(p) > low) & (F.col(p) < high)).orderBy(*order)


def by_category(df: DataFrame, decision: str = "predictions") -> dict[str, DataFrame]:
    """Detections as sure, unsure and not a cell."""
    return {name: df.where(F.col(decision) == value) for name, value in (("sure", 2), ("unsure", 0), ("not_cell", -2))}


# --- joins --------------------------------------------------------------------------------


def sections_view(animals: DataFrame, scans: DataFrame, slides: DataFrame, tifs: DataFrame) -> DataFrame:
    """Good slides' files by animal; channel numbers count from zero."""
    return (
        animals.select("prep_id")
        .join(scans.select(F.col("id").alias("scan_run_id"), "prep_id", "rescan_number"), "prep_id")
        .join(slides.where("slide_status = 'Good'").select(F.col("id").alias("slide_id"), "scan_run_id", "slide_physical_id"), "scan_run_id")
        .join(tifs.select("slide_id", "scene_index", "scene_number", (F.col("channel") - 1).alias("channel_index"), F.col("active").alias("tif_active"), F.col("id").alias("tif_id")), "slide_id")
    )


def centers_of(sessions: DataFrame, centers: DataFrame, regions: DataFrame, prep_id: int | None = None, user_id: int | None = None) -> DataFrame:
    """One centre a brain, annotator and region: that with the largest id."""
    wanted = sessions.where(F.col("active") & (F.col("annotation_type") == "STRUCTURE_COM"))
    if prep_id is not None:
        wanted = wanted.where(F.col("prep_id") == prep_id)
    if user_id is not None:
        wanted = wanted.where(F.col("user_id") == user_id)
    joined = (
        centers.join(wanted.select(F.col("id").alias("session_id"), "prep_id", "user_id", "brain_region_id"), "session_id")
        .join(regions.select(F.col("id").alias("brain_region_id"), "abbreviation"), "brain_region_id")
    )
    best = F.max_by(F.struct("id", "x", "y", "z"), "id").alias("c")
    return joined.groupBy("prep_id", "user_id", "abbreviation").agg(best).select("prep_id", "user_id", "abbreviation", "c.id", "c.x", "c.y", "c.z")


def manual_centers(sessions: DataFrame, centers: DataFrame, regions: DataFrame, placeholder: str = "point") -> DataFrame:
    """All centres set by hand, over all brains, without the placeholder region."""
    return (
        centers.where("source = 'MANUAL'")
        .join(sessions.where("active").select(F.col("id").alias("session_id"), "prep_id", "brain_region_id"), "session_id")
        .join(regions.where(F.col("abbreviation") != placeholder).select(F.col("id").alias("brain_region_id"), "abbreviation"), "brain_region_id")
        .select("prep_id", "abbreviation", "id", "x", "y", "z")
    )


def shared_points(a: DataFrame, b: DataFrame, on: str | list[str]) -> DataFrame:
    """Points of the keys that both sets have."""
    on = [on] if isinstance(on, str) else on
    return a.select(*on, *(F.col(c).alias(f"{c}_a") for c in "xyz")).join(b.select(*on, *(F.col(c).alias(f"{c}_b") for c in "xyz")), on)


def all_keys(*sets: DataFrame, key: str = "abbr") -> DataFrame:
    out = sets[0].select(key)
    for s in sets[1:]:
        out = out.union(s.select(key))
    return out.distinct().orderBy(key)


def unprocessed(listing: DataFrame, log: DataFrame, on: str | list[str]) -> DataFrame:
    return listing.join(log, on, "left_anti")


# --- counts -------------------------------------------------------------------------------


def section_count(sections: DataFrame, channel_index: int = 0, rescan: int = 1) -> DataFrame:
    return sections.where((F.col("channel_index") == channel_index) & (F.col("rescan_number") == rescan)).groupBy("prep_id").agg(F.count(F.lit(1)).alias("n"))


def safe_size(width: Column, height: Column, rotation: Column) -> list[Column]:
    """Sizes above 10000 both: rounded to thousands (half to even) plus 500, swapped at odd rotations."""
    both = (width > 10000) & (height > 10000)
    w, h = (F.bround(c, -3) + 500 for c in (width, height))
    odd = rotation % 2 == 1
    return [
        F.when(~both, width).when(odd, h).otherwise(w).alias("width"),
        F.when(~both, height).when(odd, w).otherwise(h).alias("height"),
    ]


def safe_dimensions(scans: DataFrame, slides: DataFrame, tifs: DataFrame) -> DataFrame:
    largest = (
        tifs.where("active").select("slide_id", "width", "height")
        .join(slides.where("active").select(F.col("id").alias("slide_id"), "scan_run_id"), "slide_id")
        .groupBy("scan_run_id").agg(F.max("width").alias("w"), F.max("height").alias("h"))
    )
    joined = scans.select(F.col("id").alias("scan_run_id"), "rotation").join(largest, "scan_run_id")
    return joined.select("scan_run_id", *safe_size(F.col("w").cast("double"), F.col("h").cast("double"), F.col("rotation")))


def cropped_dimensions(boxes: DataFrame, scale: int = 32) -> DataFrame:
    """As ``safe_dimensions``, of the largest mask box of each animal in full resolution."""
    largest = boxes.groupBy("prep_id", "rotation").agg((F.max(F.col("x2") - F.col("x1")) * scale).cast("double").alias("w"), (F.max(F.col("y2") - F.col("y1")) * scale).cast("double").alias("h"))
    return largest.select("prep_id", *safe_size(F.col("w"), F.col("h"), F.col("rotation")))


def modal_annotator(sessions: DataFrame) -> DataFrame:
    """The annotator with most active sessions of a brain; at ties the smallest id."""
    counts = sessions.where("active").groupBy("prep_id", "user_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("prep_id").agg(F.min(F.struct((-F.col("n")).alias("a"), "user_id"))["user_id"].alias("user_id"))


def annotated_animals(sessions: DataFrame) -> DataFrame:
    return sessions.where("active").select("prep_id", "user_id").distinct()


def slide_duplicates(files: DataFrame, name: str = "file_name", by: str | None = None) -> DataFrame:
    """Files, distinct slide numbers and the numbers that occur more than once."""
    number = F.regexp_extract(name, r"slide(\d+)", 1)
    keys = [by] if by else []
    counts = files.where(F.col(name).endswith(".czi")).groupBy(*keys, number.alias("number")).agg(F.count(F.lit(1)).alias("n"))
    repeated = F.array_sort(F.collect_list(F.when(F.col("n") > 1, F.col("number").cast("int"))))
    return counts.groupBy(*keys).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct_numbers"), F.array_join(repeated, ",").alias("duplicates"))


def check_stack(files: DataFrame, expected: int, min_size: int, many: int = 100) -> DataFrame:
    """Count against the expected one, small files, and, beyond ``many`` files, whether sizes are equal."""
    out = files.agg(
        F.count(F.lit(1)).alias("n_files"), F.count_if(F.col("size") < min_size).alias("n_small"),
        F.min("width").alias("w1"), F.max("width").alias("w2"), F.min("height").alias("h1"), F.max("height").alias("h2"),
    )
    unequal = (F.col("n_files") > many) & ((F.col("w1") != F.col("w2")) | (F.col("h1") != F.col("h2")))
    return out.select("n_files", (F.col("n_files") == expected).alias("count_right"), "n_small", unequal.alias("sizes_differ"))


def stack_status(files: DataFrame, expected: DataFrame) -> DataFrame:
    """Files of each expected directory and whether their number is right."""
    counts = files.groupBy("directory").agg(F.count(F.lit(1)).alias("n"))
    joined = expected.join(counts, "directory", "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))
    return joined.select("directory", "n", (F.col("n") == F.col("expected")).alias("complete"))


def task_progress(tasks: DataFrame, lookup: DataFrame) -> DataFrame:
    """Percent of an animal's tasks that are done, and the last done one."""
    done = tasks.groupBy("prep_id").agg((F.avg(F.col("completed").cast("double")) * 100).alias("percent"), F.max(F.when(F.col("completed") == 1, F.col("lookup_id"))).alias("lookup_id"))
    return done.join(lookup.select(F.col("id").alias("lookup_id"), "description"), "lookup_id", "left").select("prep_id", "percent", "lookup_id", "description")


def distinct_files(sections: DataFrame, channel_index: int) -> DataFrame:
    return sections.where(F.col("channel_index") == channel_index).select("prep_id", "slide_id", "scene_index").distinct()


# --- windows ------------------------------------------------------------------------------


def number_sections(sections: DataFrame, histology: DataFrame) -> DataFrame:
    """Section numbers from 0 in the animal's own slide and scene order."""
    joined = sections.join(histology.select("prep_id", "side_sectioned_first", "scene_order"), "prep_id")
    signed = lambda c, d: F.when(F.col(d) == "DESC", -F.col(c)).otherwise(F.col(c))
    order = Window.partitionBy("prep_id").orderBy(signed("slide_physical_id", "side_sectioned_first"), signed("scene_number", "scene_order"), "tif_id")
    return joined.withColumn("section_number", F.row_number().over(order) - 1)


def latest_session(sessions: DataFrame) -> DataFrame:
    keys = ["prep_id", "brain_region_id", "user_id"]
    newest = F.max_by(F.struct("id", "created"), F.struct("created", "id")).alias("s")
    return sessions.where("active").groupBy(*keys).agg(newest).select(*keys, "s.id", "s.created")


def polygon_index(polygons: DataFrame) -> DataFrame:
    """Rank from 0 of a section among its session's sections."""
    return polygons.withColumn("polygon_index", F.dense_rank().over(Window.partitionBy("session_id").orderBy("section")) - 1)


def polygon_arrays(polygons: DataFrame) -> DataFrame:
    """Vertices of each section's polygon in their order."""
    points = F.array_sort(F.collect_list(F.struct("point_order", "id", "x", "y")))
    return polygons.groupBy("session_id", "section").agg(F.transform(points, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("vertices"))


def dedupe_vertices(polygons: DataFrame, keys=("session_id", "section", "point_order")) -> DataFrame:
    """One vertex a key: the lowest id."""
    rest = [c for c in polygons.columns if c not in keys and c != "id"]
    return polygons.groupBy(*keys).agg(F.min(F.struct("id", *rest)).alias("v")).select(*keys, "v.*")


def resolve_centers(centers: DataFrame, near: float = 1.0) -> DataFrame:
    """One centre of several: the repeated one if just one repeats; the first of two near ones; else flagged."""
    keys = ["prep_id", "abbreviation"]
    same = centers.groupBy(*keys, "x", "y", "z").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id"))
    spread = [F.max(c) - F.min(c) for c in "xyz"]
    one = F.struct("id", "x", "y", "z")
    groups = same.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("places"), F.count_if(F.col("n") > 1).alias("repeated"),
        F.min(F.when(F.col("n") > 1, one)).alias("again"), F.min(one).alias("first"), F.greatest(*spread).alias("spread"),
    )
    verdict = F.when((F.col("places") == 1) | (F.col("repeated") == 1), "kept").when((F.col("places") == 2) & (F.col("spread") <= near), "near").otherwise("conflict")
    chosen = F.when(F.col("repeated") == 1, F.col("again")).otherwise(F.col("first"))
    return groups.select(*keys, verdict.alias("verdict"), chosen.alias("c")).select(*keys, "verdict", *(F.when(F.col("verdict") != "conflict", F.col(f"c.{k}")).alias(k) for k in ("id", "x", "y", "z")))


def merge_duplicate_slides(slides: DataFrame, tifs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Slides of one number in a run become the one with the smallest id; the others' files follow it."""
    run = Window.partitionBy("scan_run_id", "slide_physical_id")
    mastered = slides.withColumn("master_id", F.min("id").over(run))
    moved = tifs.join(mastered.select(F.col("id").alias("slide_id"), "master_id"), "slide_id")
    last = moved.where("slide_id = master_id").groupBy("master_id").agg(F.max("scene_index").alias("last"))
    own = F.col("slide_id") == F.col("master_id")
    new_tifs = moved.join(last, "master_id", "left").withColumn("scene_index", F.when(own, F.col("scene_index")).otherwise(F.col("scene_index") + F.coalesce("last", F.lit(-1)) + 1))
    new_slides = mastered.withColumn("active", F.col("active") & (F.col("id") == F.col("master_id")))
    return new_slides.drop("master_id"), new_tifs.withColumn("slide_id", F.col("master_id")).drop("master_id", "last")


def duplicate_sections(numbered: DataFrame, label: Column) -> DataFrame:
    """Sections whose label equals the next section's in stack order."""
    order = Window.partitionBy("prep_id").orderBy("section_number")
    return numbered.withColumn("__label", label).withColumn("__next", F.lead("__label").over(order)).where("__label = __next").drop("__label", "__next")


# --- order, sampling, sets ----------------------------------------------------------------


def rank_by_error(df: DataFrame, distance: str = "distance") -> DataFrame:
    return df.orderBy(distance)


def top_k(df: DataFrame, by: str, k: int, tie: str = "id", per: list[str] | None = None) -> DataFrame:
    """The k largest rows, or of each group; ties go to the smaller id."""
    if not per:
        return df.orderBy(F.col(by).desc(), tie).limit(k)
    order = Window.partitionBy(*per).orderBy(F.col(by).desc(), tie)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def numbered(df: DataFrame, by: list[str], order: list, row: str = "row", total: str | None = None) -> DataFrame:
    """Numbers from 0 in ``order`` within ``by``, and each group's rows as ``total``.

    Rows are dealt to ranges of the order, numbered within their range, and moved
    on by the rows of earlier ranges, a small table; so a group may have any size.
    ``order`` should tell all rows of a group apart. Null groups are groups.
    """
    ranged = stored(df.repartitionByRange(*by, *order).withColumn("__range", F.spark_partition_id()), "ranges")
    earlier = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy(*by, "__range").agg(F.count(F.lit(1)).alias("__n"))
    sizes = sizes.select(*(F.col(b).alias(f"__by{i}") for i, b in enumerate(by)), F.col("__range").alias("__of"), F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"), F.sum("__n").over(Window.partitionBy(*by)).alias("__total"))
    placed = ranged.withColumn("__row", F.row_number().over(Window.partitionBy(*by, "__range").orderBy(*order)) - 1)
    same = F.col("__range") == F.col("__of")
    for i, b in enumerate(by):
        same = same & F.col(b).eqNullSafe(F.col(f"__by{i}"))
    more = [F.col("__total").alias(total)] if total else []
    return placed.join(sizes, same).select(*df.columns, (F.col("__row") + F.col("__before")).alias(row), *more)


def export_order(pts: DataFrame, layer: str = "name") -> DataFrame:
    """Dense ids from 0 in z, x, y order in each layer."""
    return numbered(pts, [layer], ["z", "x", "y", "id"])


def unit_hash(*keys: str, seed: int = 0) -> Column:
    """A repeatable number in [0, 1) of a row's keys: the top 13 hexadecimal digits of a hash."""
    text = F.concat_ws("|", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(16**13)


def sample_for_qc(df: DataFrame, n: int, key: str = "id", seed: int = 0) -> DataFrame:
    """n rows with the smallest hashes, in section order."""
    return df.withColumn("__u", unit_hash(key, seed=seed)).orderBy("__u", key).limit(n).drop("__u").orderBy("section", key)


def split_rows(df: DataFrame, fraction: float, key: str = "id", seed: int = 0) -> DataFrame:
    """Rows with a flag ``train`` that the key alone decides."""
    return df.withColumn("train", unit_hash(key, seed=seed) < fraction)


def union_tagged(tag: str = "name", **sources: DataFrame) -> DataFrame:
    """Bag union by column name, with the source's name."""
    out = None
    for name, df in sources.items():
        tagged = df.withColumn(tag, F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.distinct().exceptAll(b.distinct()).union(b.distinct().exceptAll(a.distinct()))


def intersect_keys(*sets: DataFrame) -> DataFrame:
    out = sets[0]
    for s in sets[1:]:
        out = out.intersect(s)
    return out


# --- upkeep -------------------------------------------------------------------------------


def upsert(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``changes`` win; others stay."""
    rest = [c for c in target.columns if c not in keys]
    new = changes.select(*keys, F.lit(True).alias("__new"), *(F.col(c).alias(f"__{c}") for c in rest))
    return target.join(new, keys, "full").select(*keys, *(F.when(F.col("__new"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) for c in rest))


def replace(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """All rows with a changed key go, then the new ones come."""
    return target.join(changes.select(*keys).distinct(), keys, "left_anti").unionByName(changes)


def inactivate(sessions: DataFrame, prep_id: int) -> DataFrame:
    return sessions.withColumn("active", F.when(F.col("prep_id") == prep_id, F.lit(False)).otherwise(F.col("active")))


def assign_active(sessions: DataFrame, cells: DataFrame, polygons: DataFrame, centers: DataFrame) -> DataFrame:
    """Sessions are active that own a row of their type."""
    owners = None
    for kind, rows in (("MARKED_CELL", cells), ("POLYGON_SEQUENCE", polygons), ("STRUCTURE_COM", centers)):
        part = sessions.where(F.col("annotation_type") == kind).join(rows.select(F.col("session_id").alias("id")), "id", "left_semi").select("id")
        owners = part if owners is None else owners.union(part)
    flagged = owners.distinct().withColumn("__owns", F.lit(True))
    return sessions.join(flagged, "id", "left").withColumn("active", F.coalesce("__owns", F.lit(False))).drop("__owns")


def split_points(points: DataFrame, keys: list[str], kind: str) -> tuple[DataFrame, DataFrame]:
    """One wide table as sessions, numbered from 1 within the first key, and points with session numbers."""
    groups = points.select(*keys, kind).distinct()
    order = Window.partitionBy(keys[0]).orderBy(*keys[1:], kind)
    sessions = groups.withColumn("session_number", F.row_number().over(order))
    return sessions, points.join(sessions, [*keys, kind]).drop(*keys[1:])


def archive_and_replace(current: DataFrame, archive: DataFrame, new: DataFrame, user_id: int, set_id: int) -> tuple[DataFrame, DataFrame]:
    """The user's current points move to the archive under a set; the new ones take their place."""
    mine = F.col("user_id") == user_id
    archived = current.where(mine).withColumn("set_id", F.lit(set_id).cast("long"))
    return current.where(~mine).unionByName(new), archive.unionByName(archived)


def update_columns(df: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Columns of ``changes`` that aren't null replace those of the same key."""
    changed = [c for c in changes.columns if c != key]
    joined = df.join(changes.select(key, *(F.col(c).alias(f"__{c}") for c in changed)), key, "left")
    return joined.select(*(F.coalesce(f"__{c}", c).alias(c) if c in changed else F.col(c) for c in df.columns))
