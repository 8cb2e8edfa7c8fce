"""Files and text as tables: tables, CSV, JSON, parameter and point files, and back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions.session import stored
from tessella.operators.ranges import running


def read_table(spark: SparkSession, name: str, options: dict) -> DataFrame:
    """A table of a Parquet folder (``path``), or over JDBC (``url`` and others; give it a partition column)."""
    if "path" in options:
        return spark.read.parquet(f"{options['path']}/{name}.parquet")
    return spark.read.format("jdbc").options(dbtable=name, **options).load()


def read_csv_glob(spark: SparkSession, pattern: str, schema: str, header: bool = True) -> DataFrame:
    """All CSV files that match, with their file's name; empty ones give no rows."""
    return spark.read.schema(schema).option("header", header).csv(pattern).select("*", F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"))


def read_annotations(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Headerless x, y, section files as one table, by category name."""
    parts = [spark.read.schema("x double, y double, section double").csv(p).withColumn("name", F.lit(n)) for n, p in paths.items()]
    return reduce(DataFrame.unionByName, parts)


def parse_wide_csv(df: DataFrame, fields: list[tuple[str, int, int]], column: str = "line") -> DataFrame:
    """Fields (name, first position, number) of wide lines: one number, or an array of several."""
    parts = F.split(column, ",")

    def field(at: int, n: int) -> Column:
        if n == 1:
            return F.try_element_at(parts, F.lit(at + 1)).try_cast("double")
        return F.transform(F.slice(parts, at + 1, n), lambda v: v.try_cast("double"))

    return df.select(*(field(at, n).alias(name) for name, at, n in fields))


LAYERS = "struct<layers:array<struct<name:string,annotations:array<struct<point:array<double>,description:string>>>>>"


def explode_layers(df: DataFrame, json_col: str, half_even: bool = False) -> DataFrame:
    """One row an annotation of viewer states; layers without annotations give nothing.

    x and y are cut toward zero; z is cut too, or rounded half to even.
    """
    layers = df.select("*", F.explode(F.from_json(json_col, LAYERS)["layers"]).alias("__l"))
    notes = layers.select("*", F.explode("__l.annotations").alias("__a"))
    p = lambda i: F.get(F.col("__a.point"), F.lit(i))
    z = F.bround(p(2), 0) if half_even else p(2)
    return notes.select(*(c for c in df.columns if c != json_col), F.col("__l.name").alias("layer"), F.col("__a.description").alias("description"), p(0).cast("int").alias("x"), p(1).cast("int").alias("y"), z.cast("int").alias("section"))


def parse_parameters(lines: DataFrame, column: str = "value") -> DataFrame:
    """``(key v1 v2 ...)`` lines: key, texts, numbers (null where a token is none), and whether it is a single value."""
    inside = F.regexp_extract(column, r"^\s*\((\S+)\s+(.*?)\)\s*$", 2)
    texts = F.transform(F.split(F.trim(inside), r"\s+"), lambda v: F.regexp_replace(v, '"', ""))
    return lines.where(F.col(column).rlike(r"^\s*\(\S+\s+.*\)\s*$")).select(
        *(c for c in lines.columns if c != column), F.regexp_extract(column, r"^\s*\((\S+)\s+(.*?)\)\s*$", 1).alias("key"), texts.alias("texts")
    ).withColumns({"numbers": F.transform("texts", lambda v: v.try_cast("double")), "single": F.size("texts") == 1})


def parse_parameter_files(spark: SparkSession, path: str) -> DataFrame:
    return parse_parameters(spark.read.text(path))


def parse_points(lines: DataFrame, kind: str = "OutputPoint", column: str = "value") -> DataFrame:
    """The three numbers 3 to 5 tokens after the keyword of each line."""
    tokens = F.split(F.trim(column), r"\s+")
    at = F.array_position(tokens, kind)
    return lines.where(F.contains(F.col(column), F.lit(kind))).select(
        *(c for c in lines.columns if c != column), *(F.try_element_at(tokens, (at + 3 + i).cast("int")).try_cast("double").alias(c) for i, c in enumerate("xyz"))
    )


def parse_point_output(spark: SparkSession, path: str, kind: str = "OutputPoint") -> DataFrame:
    return parse_points(spark.read.text(path), kind)


def points_as_text(df: DataFrame, order: str = "id") -> DataFrame:
    """Lines of a point file: ``index``, the count, and ``x y z`` a point, with their place ``n``."""
    points = df.select(F.col(order).alias("n"), F.concat_ws(" ", *(F.col(c).cast("string") for c in "xyz")).alias("value"))
    head = df.agg(F.count(F.lit(1)).cast("string").alias("c")).select(F.explode(F.array(F.struct(F.lit(-2).cast("long").alias("n"), F.lit("index").alias("value")), F.struct(F.lit(-1).cast("long").alias("n"), F.col("c").alias("value")))).alias("h")).select("h.*")
    return head.unionByName(points)


def write_points_text(df: DataFrame, path: str, order: str = "id") -> None:
    """Files of one point list, in order over the files."""
    points_as_text(df, order).repartitionByRange("n").sortWithinPartitions("n").select("value").write.text(path)


def flatten_ontology(df: DataFrame) -> DataFrame:
    """Regions (id, name, acronym, parent_id) with their parent's name and acronym; ``null`` where there is none."""
    parents = df.select(F.col("id").alias("parent_id"), F.col("name").alias("parent_name"), F.col("acronym").alias("parent_acronym"))
    joined = df.join(parents, "parent_id", "left")
    return joined.select("id", "name", "acronym", "parent_id", *(F.coalesce(c, F.lit("null")).alias(c) for c in ("parent_name", "parent_acronym")))


def ontology_rows(documents: DataFrame, column: str) -> DataFrame:
    """Nested ontologies (id, name, acronym, children) of any depth as flat rows with parent ids.

    Level by level: children stay text until their turn, and each level is
    written to the shared folder. Text that can't be read gives a row of nulls.
    """
    kind = "struct<id:bigint,name:string,acronym:string,children:array<string>>"
    level, out = documents.where(F.col(column).isNotNull()).select(F.col(column).alias("doc"), F.lit(None).cast("long").alias("parent_id")), None
    while out is None or level.limit(1).count():
        read = stored(level.select(F.from_json("doc", kind).alias("r"), "parent_id").select("r.*", "parent_id"), "ontology-level")
        rows = read.select("id", "name", "acronym", "parent_id")
        out = rows if out is None else out.union(rows)
        level = read.select(F.explode("children").alias("doc"), F.col("id").alias("parent_id")).where("doc is not null")
    return out


def write_result(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = df.write.mode("overwrite")
    writer.option("header", True).csv(path) if fmt == "csv" else writer.format(fmt).save(path)


def derive_tif_rows(slides: DataFrame, channels: str = "channels") -> DataFrame:
    """A file name for every scene and channel of each slide."""
    base = F.regexp_replace(F.regexp_replace("file_name", r"\.czi", ""), "__", "_")
    every = slides.withColumn("scene", F.explode(F.sequence(F.lit(1), F.col("scenes")))).withColumn("channel", F.explode(F.sequence(F.lit(1), F.col(channels))))
    name = F.concat(base, F.lit("_S"), F.col("scene").cast("string"), F.lit("_C"), F.col("channel").cast("string"), F.lit(".tif"))
    return every.withColumn("tif_name", name)


def parse_vertices(df: DataFrame, column: str) -> DataFrame:
    """Bracketed vertex text, with whatever blanks, line ends and commas, as an array of (x, y)."""
    spaced = F.regexp_replace(column, r"[\s,]+", ",")
    clean = F.regexp_replace(F.regexp_replace(F.regexp_replace(spaced, r"\[,", "["), r",\]", "]"), r"\]\[", "],[")
    return df.withColumn("vertices", F.transform(F.from_json(clean, "array<array<double>>"), lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))


#: Points of a layer, at most, in one JSON text.
PIECE = 1_000


def pieces(df: DataFrame, by: list[str], order: str, most: int = PIECE) -> DataFrame:
    """Add ``piece``: rows of each group, in order, are dealt to pieces 0, 1, ... of ``most`` rows (the last has the rest)."""
    numbered = running(df.withColumn("__one", F.lit(1).cast("long")), by, [order], ["__one"])
    return numbered.select(*df.columns, F.floor((F.col("__one_until") - 1) / most).alias("piece"))


def to_layer_json(pts: DataFrame, layer: str = "name", order: str = "id", description: str | None = None, color: str | None = None, most: int = PIECE) -> DataFrame:
    """Each layer's points as a viewer's annotation JSON, z half a section on: (layer, piece, json).

    A layer of more than ``most`` points has several texts, each a layer of its own
    with the next points in order, so no layer is held together. ``description``
    and ``color`` name columns of the points' notes and colours (``#rrggbb``, in
    ``props``); a point without one goes without the field.
    """
    place = F.array(F.col("x").cast("double"), F.col("y").cast("double"), F.col("z") + 0.5).alias("point")
    fields = [place, F.lit("point").alias("type"), F.col(layer).cast("string").alias("category")]
    fields += [F.col(description).cast("string").alias("description")] if description else []
    fields += [F.when(F.col(color).isNotNull(), F.array(F.col(color).cast("string"))).alias("props")] if color else []
    point = F.struct(F.col(order).alias("o"), F.struct(*fields).alias("a"))
    notes = F.transform(F.array_sort(F.collect_list(point)), lambda s: s["a"])
    used = dict.fromkeys([layer, order, "x", "y", "z", *filter(None, (description, color))])
    text = F.to_json(F.struct(F.col(layer).cast("string").alias("name"), notes.alias("annotations"))).alias("json")
    return pieces(pts.select(*used), [layer], order, most).groupBy(layer, "piece").agg(text)
