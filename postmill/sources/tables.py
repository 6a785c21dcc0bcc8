"""Warehouse tables: parquet folders by layer, published as views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postmill.fixed import LAYERS


def table_path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


def write_table(df: DataFrame, root: str, layer: str, name: str, mode: str = "errorifexists") -> DataFrame:
    """Write a table and return a frame that reads it.

    A run writes below a root of its own, never over an earlier run or a path its own plan reads.
    """
    path = table_path(root, layer, name)
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Catalog table bucketed and sorted by key: joins on it need no shuffle.

    For the jobs and bridge tables, which every mart joins by job_id.
    """
    writer = df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def create_layers(spark: SparkSession, prefix: str = "", folder: str | None = None) -> None:
    """The catalog's databases, in the session's warehouse folder or below one of their own."""
    for layer in LAYERS:
        place = f" LOCATION '{folder}/{layer}'" if folder else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{prefix}{layer}`{place}")


def publish(spark: SparkSession, root: str, layer: str, name: str, prefix: str = "") -> None:
    """Point the view layer.name at the files below root, by one statement.

    The files stay where they are; a later run publishes its own root instead.
    """
    path = table_path(root, layer, name).replace("`", "``")
    spark.sql(f"CREATE OR REPLACE VIEW `{prefix}{layer}`.`{name}` AS SELECT * FROM parquet.`{path}`")


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Replace a database table. Partitions are sent in parallel, one connection each."""
    df.write.jdbc(url, table, mode="overwrite", properties=properties)
