"""All queries of the library outside the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessella.plans import annotations, files, geometry, points, registry, statistics, volumes

MODULES = (annotations, files, geometry, points, statistics, volumes)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells by region, rolled up the region tree."""
    return volumes.flagship(registry.Tables(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.ORACLES)
