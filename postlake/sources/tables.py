"""Parquet files and catalog tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def scan_parquet(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    return spark.read.parquet(path).select(*columns)


def read_catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """A saved table; one that is missing raises."""
    return spark.table(name)


def load_or_build(
    spark: SparkSession, name: str, build: Callable[[], DataFrame], path: str | None = None
) -> DataFrame:
    """The saved table ``name``, built and saved first if it is missing."""
    if not spark.catalog.tableExists(name):
        writer = build().write.mode("errorifexists").format("parquet")
        if path:
            writer = writer.option("path", path)
        writer.saveAsTable(name)
    return spark.table(name)
