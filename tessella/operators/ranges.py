"""Running sums, percentiles and distribution gaps over ranges of an order, so that a group may have any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.session import stored


def running(df: DataFrame, by: list[str], order: list[str], sums: list[str] = (), maxima: list[str] = ()) -> DataFrame:
    """Add, within ``by`` in ``order``: ``<s>_until`` (with the row's own) and ``<s>_total`` of sums, ``<m>_before`` (the largest earlier one) of maxima.

    Rows are dealt to ranges of (by, order); each range sums up its own rows, and
    what earlier ranges hold comes from a small table, a row a group and range.
    ``order`` should tell the rows of a group apart. Null groups are groups.
    """
    by, sums, maxima = list(by), list(sums), list(maxima)
    ranged = stored(df.repartitionByRange(*by, *order).withColumn("__range", F.spark_partition_id()), "ranges")
    parts = ranged.groupBy(*by, "__range").agg(*(F.sum(s).alias(s) for s in sums), *(F.max(m).alias(m) for m in maxima))
    group = Window.partitionBy(*(by or [F.lit(0)]))
    earlier = group.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        *(F.col(b).alias(f"__by{i}") for i, b in enumerate(by)), F.col("__range").alias("__of"),
        *(F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"__{s}") for s in sums), *(F.sum(s).over(group).alias(f"{s}_total") for s in sums),
        *(F.max(m).over(earlier).alias(f"__{m}") for m in maxima),
    )
    inside = Window.partitionBy(*by, "__range").orderBy(*order)
    placed = ranged.withColumns(
        {f"{s}_until": F.sum(s).over(inside.rowsBetween(Window.unboundedPreceding, 0)) for s in sums}
        | {f"{m}_before": F.max(m).over(inside.rowsBetween(Window.unboundedPreceding, -1)) for m in maxima}
    )
    same = F.col("__range") == F.col("__of")
    for i, b in enumerate(by):
        same = same & F.col(b).eqNullSafe(F.col(f"__by{i}"))
    return placed.join(parts, same).select(
        *df.columns,
        *((F.col(f"{s}_until") + F.col(f"__{s}")).alias(f"{s}_until") for s in sums), *(f"{s}_total" for s in sums),
        *(F.greatest(f"{m}_before", f"__{m}").alias(f"{m}_before") for m in maxima),
    )


def percentiles(df: DataFrame, by: list[str], value: str | Column, shares: dict[str, float]) -> DataFrame:
    """(by, names): exact percentiles with linear interpolation of each group's values that aren't null.

    Values are counted and the counts run up over ranges; a percentile lies where
    they pass its rank. No group is held together, whatever its distinct values.
    """
    by = list(by)
    v = (F.col(value) if isinstance(value, str) else value).cast("double").alias("__v")
    counts = df.select(*by, v).where("__v is not null").groupBy(*by, "__v").agg(F.count(F.lit(1)).alias("__n"))
    placed = running(counts, by, ["__v"], ["__n"])
    before, until = F.col("__n_until") - F.col("__n"), F.col("__n_until")
    at = {name: F.lit(float(share)) * (F.col("__n_total") - 1) for name, share in shares.items()}
    here = lambda rank: F.max(F.when((before <= rank) & (rank < until), F.col("__v")))
    ends = [e for name, p in at.items() for e in (here(F.floor(p)).alias(f"__low_{name}"), here(F.ceil(p)).alias(f"__high_{name}"))]
    found = placed.groupBy(*by).agg(F.max("__n_total").alias("__n_total"), *ends)

    def between(name: str) -> Column:
        p, low, high = at[name], F.col(f"__low_{name}"), F.col(f"__high_{name}")
        return F.when(F.floor(p) == F.ceil(p), low).otherwise((F.ceil(p) - p) * low + (p - F.floor(p)) * high).alias(name)

    return found.select(*by, *map(between, shares))


def largest_gap(steps: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, gap, at, n1, n2) of counts ``a`` and ``b`` by value: the largest gap of the two distributions, at the smallest such value."""
    placed = running(steps, by, [value], ["a", "b"]).where("a_total > 0 and b_total > 0")
    gap = F.col("a_until") / F.col("a_total") - F.col("b_until") / F.col("b_total")
    best = F.max(F.struct(F.abs("gap").alias("g"), (-F.col(value)).alias("v"), "gap", "a_total", "b_total")).alias("m")
    found = placed.withColumn("gap", gap).groupBy(*by).agg(best).where("m is not null")
    return found.select(*by, F.col("m.gap").alias("gap"), (-F.col("m.v")).alias("at"), F.col("m.a_total").alias("n1"), F.col("m.b_total").alias("n2"))
