"""Question surface: run SQL over the registered tables and prepare the result
for display (preview records, date detection and coercion, ordering)."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions.scalars import to_timestamp_coerced
from cadenza.operators.ordering import date_columns, sort_by_date
from cadenza.operators.profile import numeric_columns
from cadenza.sources.sinks import preview_records


# SQL-callable helpers for questions asked in SQL. They are SQL-bodied
# temporary functions: Catalyst inlines them, so they run as plain expressions.
SQL_FUNCTIONS = {
    # Case-insensitive genre membership (a NULL list gives NULL).
    "has_genre": ("(genres ARRAY<STRING>, genre STRING) RETURNS BOOLEAN "
                  "RETURN exists(genres, g -> lower(g) = lower(genre))"),
}


def register_sql_functions(spark: SparkSession) -> None:
    for name, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")


def run_sql(spark: SparkSession, sql: str, args: dict | None = None):
    """Q0: returns ``(DataFrame, None)`` or ``(None, {"error", "sql"})``.
    Analysis errors surface here; runtime errors surface when the result is
    evaluated, which :func:`preview` does inside the same guard."""
    try:
        return spark.sql(sql, args=args or {}), None
    except PySparkException as exc:
        return None, {"error": str(exc), "sql": sql}


def preview(spark: SparkSession, sql: str, args: dict | None = None, n: int = 10,
            order_by=None):
    """Q0 + K8: the response of the question endpoint: up to ``n`` result rows
    as JSON record strings, or the error with the SQL. Only the ``n`` rows are
    brought back (the limit is part of the plan), inside the error guard, so
    runtime errors such as failed ANSI casts are reported too."""
    df, err = run_sql(spark, sql, args)
    if err:
        return None, err
    try:
        records = [r["record"] for r in preview_records(df, n, order_by).collect()]
    except PySparkException as exc:
        return None, {"error": str(exc), "sql": sql}
    return records, None


def coerce_dates(df: DataFrame) -> DataFrame:
    """P10 + F8: the *first* column whose name mentions date or day becomes a timestamp,
    if the result has a numeric column to show against it; numbers are epoch milliseconds,
    text is parsed, bad values -> null. Other columns of that kind of name
    (a count of days, say) stay as they are."""
    numeric = set(numeric_columns(df))
    col = next(iter(date_columns(df)), None)
    kind = dict(df.dtypes).get(col, "")
    if col is None or not numeric or kind.startswith("timestamp") or kind == "date":
        return df
    return df.withColumn(col, to_timestamp_coerced(F.col(col), numeric=col in numeric))


def display_series(df: DataFrame) -> DataFrame:
    """P10 + F8 + O4: detect the date column, coerce it and sort by it."""
    return sort_by_date(coerce_dates(df))
