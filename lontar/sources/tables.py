"""Loaders of the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` under ``sf_dir`` (a file or a folder of files)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_jdbc(spark: SparkSession, url: str, name: str, key: str | None = None, parts: int = 1, **options: str) -> DataFrame:
    """A table of a database; with a numeric ``key`` in ``parts`` parallel ranges of it.

    Filters and columns are pushed down to the database. Rows with a null key are in the first range. An empty table has one range.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if key is None or parts < 2:
        return reader.option("dbtable", name).load()
    low, high = reader.option("dbtable", name).load().agg(F.min(key), F.max(key)).first()  # reads the key alone
    if low is None or low == high:
        return reader.option("dbtable", name).load()
    bounds = {"partitionColumn": key, "lowerBound": str(int(low)), "upperBound": str(int(high) + 1), "numPartitions": str(parts)}
    return spark.read.format("jdbc").option("url", url).options(**options).option("dbtable", name).options(**bounds).load()


def write_jdbc(rows: DataFrame, url: str, name: str, mode: str = "append", **options: str) -> None:
    """Rows into a table of a database: a transaction for each task; ``overwrite`` empties the table and keeps its definition."""
    rows.write.format("jdbc").option("url", url).option("dbtable", name).option("truncate", "true").options(**options).mode(mode).save()
