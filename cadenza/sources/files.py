"""Delimited-text and JSON-envelope sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv_strings(spark: SparkSession, path: str, columns=None,
                     schema: T.StructType | None = None) -> DataFrame:
    """Header CSV read with every column typed STRING, so ids such as '007' keep
    their text form. ``schema`` may be given instead of ``columns``."""
    if schema is None:
        if columns is None:
            # Only the header is read here: one line, not the data.
            header = spark.read.option("header", True).csv(path).columns
            columns = header
        schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    return (spark.read.schema(schema).option("header", True)
            .option("mode", "PERMISSIVE").csv(path))


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV read with inferred types (one extra pass over the file)."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType | None = None,
                        multi_line: bool = True) -> DataFrame:
    reader = spark.read.option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def envelope_rows(df: DataFrame, field: str = "data", keep=()) -> DataFrame:
    """JSON envelope -> one row per element of its array ``field`` (struct fields
    become columns). Documents whose array is null or empty give no row."""
    exploded = df.select(*keep, F.explode(F.col(field)).alias("_elem"))
    return exploded.select(*keep, "_elem.*")


def parse_json_column(col: Column | str, schema: T.DataType | str) -> Column:
    """Text column -> typed struct; malformed text becomes null."""
    return F.from_json(col if isinstance(col, Column) else F.col(col), schema,
                       {"mode": "PERMISSIVE"})
