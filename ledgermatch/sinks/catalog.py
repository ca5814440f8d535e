"""Expose stored datasets as catalog tables, so they can be queried by name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from .tables import exists


def register(spark: SparkSession, datasets: Iterable[tuple[str, str, str]], prefix: str = "") -> list[str]:
    """Create databases and external Parquet tables over ``(database, table, path)``.

    Tables are external: dropping one leaves its files. Partitioned datasets
    get their partitions registered. Datasets not written yet are skipped.
    Returns the qualified names registered.
    """
    names = []
    for database, table, path in datasets:
        if not exists(spark, path):
            continue
        db = f"{prefix}{database}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
        name = f"`{db}`.`{table}`"
        if spark.catalog.tableExists(f"{db}.{table}"):
            spark.sql(f"REFRESH TABLE {name}")
        else:
            spark.catalog.createTable(f"{db}.{table}", path=path, source="parquet")
        if any(c.isPartition for c in spark.catalog.listColumns(f"{db}.{table}")):
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        names.append(f"{db}.{table}")
    return names
