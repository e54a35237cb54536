"""Table scans, table creation and column defaults.

A "table" is a Parquet folder (or a catalog table); a namespace is a root
folder or a catalog database. Nothing here reads data on the driver.
"""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T


def table_path(root: str, name: str) -> str:
    """Path of table ``name`` under a namespace root; accepts ``name.parquet`` files too."""
    direct = os.path.join(root, f"{name}.parquet")
    if "://" not in root and os.path.exists(direct):
        return direct
    return os.path.join(root, name)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Scan a table by name inside a namespace (a folder of Parquet tables).

    Only the columns and filters the caller's plan uses reach the reader
    (column pruning, pushed filters).
    """
    return spark.read.parquet(table_path(root, name))


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table that may not exist yet reads as an empty frame of its schema."""
    from pyspark.errors import AnalysisException

    try:
        df = spark.read.schema(schema).parquet(path)
        df.schema  # resolves the path; raises when it does not exist
        return df
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":  # anything else is an error, not an absent table
            raise
        return spark.createDataFrame([], schema)


def use_namespace(spark: SparkSession, name: str, reset: bool = False) -> None:
    """``CREATE SCHEMA IF NOT EXISTS`` + ``SET search_path`` (catalog databases)."""
    if reset:
        spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    spark.catalog.setCurrentDatabase(name)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, partition_by: list[str] | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS ... USING parquet`` in the current namespace."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    part = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` ({cols}) USING parquet{part}")


def create_with_defaults(
    spark: SparkSession, name: str, schema: T.StructType, defaults: Mapping[str, str], path: str | None = None
) -> None:
    """A catalog table whose columns have ``DEFAULT`` expressions (SQL text), kept by the catalog."""
    cols = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" + (f" DEFAULT {defaults[f.name]}" if f.name in defaults else "") for f in schema.fields
    )
    where = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` ({cols}) USING parquet{where}")


def insert_by_name(df: DataFrame, name: str) -> None:
    """``INSERT INTO name (columns of df)``: absent columns take the catalog's defaults, an explicit NULL stays."""
    cols = ", ".join(f"`{c}`" for c in df.columns)
    df.sparkSession.sql(f"INSERT INTO `{name}` ({cols}) SELECT {cols} FROM {{rows}}", rows=df)


def with_defaults(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Add the columns that the input does not carry, with their default expressions.

    As for an ``INSERT``, a default fills an absent column; an explicit NULL stays.
    """
    return df.withColumns({name: expr for name, expr in defaults.items() if name not in df.columns})


def count_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of several tables after a load, one row per table."""
    from ledgerflow.operators.relational import labelled_counts

    return labelled_counts(tables, "table_name", "rows")
