"""Delimited-text and Parquet sources and sinks (IO-1..3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabulon.operators.clean import cast_columns


def read_delimited(spark: SparkSession, path: str, types: dict[str, str] | None = None,
                   sep: str = ";", header: bool = True, schema=None) -> DataFrame:
    """Read text as strings (no schema inference pass over the data), then re-type with
    ``try_cast`` so malformed numbers become NULL instead of failing the job."""
    reader = spark.read.option("sep", sep).option("header", str(header).lower())
    if schema is not None:
        return reader.schema(schema).option("mode", "PERMISSIVE").csv(path)
    df = reader.option("inferSchema", "false").csv(path)
    return cast_columns(df, types) if types else df


def write_delimited(df: DataFrame, path: str, sep: str = ";", mode: str = "overwrite") -> None:
    df.write.mode(mode).option("sep", sep).option("header", "true").csv(path)


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet scan; a column list is pruned into the scan's ReadSchema by Catalyst."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
