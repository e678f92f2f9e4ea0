"""File sources and sinks.

Raw inputs are newline-delimited JSON (and one CSV); they are read once with a declared
schema (no inference pass over the data) and landed as Parquet, so every later job gets
column pruning, predicate pushdown and the vectorised reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from featuremill.functions.columns import sanitize_name

# Fixed value: timestamp text written by the text sinks (microsecond precision).
TS_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def sanitize_columns(df: DataFrame, old: str = ".", new: str = "_") -> DataFrame:
    """Rename every column, replacing ``old`` by ``new`` (pre-flattened sources carry
    names such as ``attributes.WiFi`` that do not resolve unquoted)."""
    names = [c.replace(old, new) for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError("renaming makes two columns share a name")
    return df.toDF(*names)


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None,
              sanitize: bool = True) -> DataFrame:
    """Newline-delimited JSON. Give ``schema`` in production: inference costs a full
    extra pass and makes the column set depend on the data."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.json(path)
    return sanitize_columns(df) if sanitize else df


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             sep: str = ",", multiline: bool = False) -> DataFrame:
    """CSV with a header. ``multiline``: line feeds inside quotes (each file is then one
    task that cannot be split). Without ``schema`` the types are inferred (an extra pass)."""
    reader = (spark.read.option("header", "true").option("multiLine", str(multiline).lower())
              .option("sep", sep))
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true")
    return reader.csv(path)


def save_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None,
               mode: str = "overwrite") -> str:
    """Write a table (Parquet by default). Column names are made legal for Parquet."""
    out = df.toDF(*[sanitize_name(c) if fmt == "parquet" else c for c in df.columns])
    writer = out.write.mode(mode).format(fmt)
    if fmt in ("csv", "json"):
        # text formats default to millisecond timestamps; keep every microsecond
        writer = (writer.option("timestampFormat", TS_TEXT + "XXX")
                  .option("timestampNTZFormat", TS_TEXT))
    if fmt == "csv":
        writer = writer.option("header", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def load_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: StructType | str | None = None) -> DataFrame:
    if fmt == "csv":
        return read_csv(spark, path, schema=schema)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_tables(spark: SparkSession, base: str, names, fmt: str = "parquet") -> dict:
    """``{name: DataFrame}`` for ``{base}/{name}.{fmt}``."""
    return {n: spark.read.format(fmt).load(f"{base.rstrip('/')}/{n}.{fmt}") for n in names}


def register_views(tables: dict) -> None:
    """Expose DataFrames to ``spark.sql`` under their dict keys."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
