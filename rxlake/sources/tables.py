"""Layered tables: one database per layer, every table replaced as a whole."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

BRONZE, SILVER, GOLD = "bronze", "silver", "gold"


def create_layers(spark: SparkSession, *layers: str) -> None:
    for layer in layers or (BRONZE, SILVER, GOLD):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")


VERSION = "__v"


def _versions(spark: SparkSession, layer: str, table: str) -> list[str]:
    """The written versions of a layer table, oldest first."""
    found = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN `{layer}`").collect()]
    named = re.compile(re.escape(table.lower()) + VERSION + r"\d{8}_[0-9a-f]{8}")
    return sorted(n for n in found if named.fullmatch(n.lower()))


def _adopt(spark: SparkSession, layer: str, table: str, name: str) -> None:
    """Make a plain table of the layer's name, as other tools write it, the version ``name``."""
    if spark.catalog.tableExists(f"`{layer}`.`{table}`") and spark.catalog.getTable(f"`{layer}`.`{table}`").tableType != "VIEW":
        spark.sql(f"ALTER TABLE `{layer}`.`{table}` RENAME TO `{layer}`.`{name}`")
        spark.sql(f"CREATE VIEW `{layer}`.`{table}` AS SELECT * FROM `{layer}`.`{name}`")


def write_layer(
    df: DataFrame,
    layer: str,
    table: str,
    partition_by: list[str] | None = None,
) -> None:
    """Replace ``layer.table``, data and schema, at once.

    The rows are written as a new version, a table of its own, and the layer's name, a view, is
    pointed at it in one step when all of them are there. A job that fails leaves the name where it was, and
    a table can be rebuilt from itself. The version before stays for readers that have begun
    with it and goes with the next write; older ones are removed.
    """
    spark = df.sparkSession
    create_layers(spark, layer)
    if partition_by:  # rows of a partition together, large ones in several files
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("error").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    before = _versions(spark, layer, table)
    number = int(before[-1].rsplit(VERSION, 1)[1].split("_")[0]) + 1 if before else 1
    name = f"{table}{VERSION}{number:08}_{uuid.uuid4().hex[:8]}"
    try:
        writer.saveAsTable(f"`{layer}`.`{name}`")
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS `{layer}`.`{name}`")
        raise
    _adopt(spark, layer, table, f"{table}{VERSION}{0:08}_{uuid.uuid4().hex[:8]}")
    spark.sql(f"CREATE OR REPLACE VIEW `{layer}`.`{table}` AS SELECT * FROM `{layer}`.`{name}`")
    for old in before[:-1]:
        spark.sql(f"DROP TABLE IF EXISTS `{layer}`.`{old}`")


def layer_tables(spark: SparkSession, layer: str) -> list[str]:
    """The names of a layer's tables, without their versions."""
    found = spark.sql(f"SHOW TABLES IN `{layer}`").filter("NOT isTemporary").collect()
    names = [r["tableName"] for r in found]
    return [n for n in names if not re.search(VERSION + r"\d{8}_[0-9a-f]{8}$", n)]


def read_layer(spark: SparkSession, layer: str, table: str) -> DataFrame:
    return spark.table(f"{layer}.{table}")


def copy_table(spark: SparkSession, source: str, table: str, layer: str = BRONZE) -> None:
    """Take over an existing catalog table as a layer table."""
    write_layer(spark.table(source), layer, table)
