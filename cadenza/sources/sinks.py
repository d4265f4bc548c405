"""Table sinks: full refresh, day-partitioned append, retention, views, preview."""

from __future__ import annotations

import datetime as dt
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.operators.quality import reject_nulls, require_not_null
from cadenza.sources import storage


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns, in the declared order and types; a missing column
    is an error (a value that does not fit its type is one at run time, in ANSI mode)."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the declared schema: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_full_refresh(df: DataFrame, path: str, fmt: str = "parquet", schema=None,
                       required=()) -> bool:
    """WRITE_TRUNCATE. Returns whether a write happened: an empty input leaves the
    table as it was.

    ``df`` is evaluated once, into a staging folder beside the table; the emptiness guard
    and the REQUIRED check read the staged rows, and the staged folder then takes the table's
    place. A write that fails leaves the old table. ``schema`` and ``required``
    enforce a declared schema (see :mod:`cadenza.schemas`). ``df`` may read the table itself.

    The reference loads in chunks whose first chunk truncates and the rest
    append; the net effect is one overwrite, which is what Spark does here, with
    files as large as the tasks that write them."""
    spark = df.sparkSession
    if schema is not None:
        df = conform(df, schema)
    staged = storage.staging(path)
    try:
        df.write.format(fmt).save(staged)
        rows = spark.read.schema(df.schema).format(fmt).load(staged)
        if rows.isEmpty():
            return False
        require_not_null(rows, required)
        storage.swap(spark, staged, path)
        return True
    finally:
        storage.delete(spark, staged)


def refresh_published(df: DataFrame, name: str, folder: str, schema=None, required=(),
                      keep: int = 2) -> bool:
    """K1 for tables that readers never miss. ``name`` is a view of the catalog over one version of
    the table; a refresh writes a new version under ``folder``, checks it (declared schema,
    required fields, emptiness), and then moves the view to it by one catalog operation.
    A reader sees the old version or the new one, in whole; a refresh that fails, at the last
    step too, leaves the old one published. The newest ``keep`` versions stay on disk, so
    readers that started before a refresh can finish. Returns whether a version was
    published: an empty input publishes nothing. ``df`` may read ``name`` itself."""
    spark = df.sparkSession
    if schema is not None:
        df = conform(df, schema)
    # Names sort by time.
    version = f"{folder.rstrip('/')}/v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    published = False
    try:
        df.write.parquet(version)
        rows = spark.read.schema(df.schema).parquet(version)
        if not rows.isEmpty():
            require_not_null(rows, required)
            publish_catalog_view(spark, name, f"SELECT * FROM parquet.`{version}`")
            published = True
    finally:
        if not published:
            storage.delete(spark, version)
    if published:
        for old in storage.children(spark, folder)[:-max(1, keep)]:
            storage.delete(spark, f"{folder.rstrip('/')}/{old}")
    return published


def append_day_partition(df: DataFrame, path: str, date_col: str = "ingestion_date",
                         replace_day: bool = False, files_per_day: int | None = None,
                         schema=None, required=(), commit_key: tuple | None = None) -> bool:
    """WRITE_APPEND into a table partitioned by day. The first append creates the
    table. ``replace_day=True`` replaces the days present in ``df`` (dynamic partition
    overwrite), so that a rerun on the same day is idempotent. Returns whether rows were written.

    One Spark write: ``df`` is evaluated once, required fields are checked in the same pass, and
    the job's committer publishes the files of all tasks when the last one has ended, so
    a write that fails before that adds nothing. Plain readers see the table; it holds no
    metadata of its own, so batch appends, streams and expiry share it.

    ``commit_key`` (writer, number) makes the append happen once however often it is tried,
    for writers that repeat a batch after a failure (see :func:`_append_once`).

    Rows are brought together by day and dealt by size (``REBALANCE``: AQE cuts a
    large day and merges small ones up to its advisory partition size), so a day has
    files of about that size. ``files_per_day`` bounds their number instead: rows are
    dealt by (day, position of the row mod ``files_per_day``), whatever they hold."""
    spark = df.sparkSession
    if schema is not None:
        df = conform(df, schema)
    df = reject_nulls(df, required)
    if files_per_day:
        df = df.repartition(F.col(date_col), F.pmod(F.xxhash64(F.monotonically_increasing_id()),
                                                    F.lit(int(files_per_day))))
    else:
        df = df.hint("rebalance", date_col)
    if commit_key is not None:
        return _append_once(df, path, date_col, *commit_key)
    fresh = not storage.exists(spark, path)
    written = Observation()
    out = df.observe(written, F.count(F.lit(1)).alias("n")).write.partitionBy(date_col)
    if replace_day:
        out.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        out.mode("append").parquet(path)
    if not written.get["n"]:
        if fresh:
            storage.delete(spark, path)
        return False
    return True


def _append_once(df: DataFrame, path: str, date_col: str, writer: str, number: int) -> bool:
    """Append under a key: batch ``number`` of ``writer``, whose numbers rise. The rows are
    staged beside the table in a folder named by the key, moved in under file names that hold the
    key, and the batch is recorded. A repeat finds the record and does nothing, or finds
    the finished staging folder and moves what is still in it, or starts anew: no row is lost or
    doubled, whatever step failed. Until the repeat, a failed move may show part of a batch."""
    spark = df.sparkSession
    log = f"{path}/_commits"                      # hidden from readers, like all names in _
    mine = [n for n in storage.children(spark, log) if n.startswith(f"{writer}.")]
    if any(int(n.rpartition(".")[2]) >= number for n in mine):
        return False
    key = f"{writer}.{number:012d}"
    parent, _, name = path.rstrip("/").rpartition("/")
    staged = f"{parent}/.{name}-{key}"
    if not storage.exists(spark, f"{staged}/_SUCCESS"):
        df.write.mode("overwrite").partitionBy(date_col).parquet(staged)
    days = [d for d in storage.children(spark, staged) if d.startswith(f"{date_col}=")]
    for day in days:
        # As many files as one batch has: a batch's input is bounded by its trigger.
        for file in storage.children(spark, f"{staged}/{day}"):
            storage.move(spark, f"{staged}/{day}/{file}", f"{path}/{day}/{key}-{file}")
    storage.create_empty(spark, f"{log}/{key}")
    storage.delete(spark, staged)
    for n in mine:
        storage.delete(spark, f"{log}/{n}")
    return bool(days)


def read_day(spark: SparkSession, path: str, day, date_col: str = "ingestion_date") -> DataFrame:
    """One day's snapshot; the filter prunes to one partition folder."""
    return spark.read.parquet(path).filter(F.col(date_col) == F.lit(day).cast("date"))


def read_retained(spark: SparkSession, path: str, days: int = 7,
                  date_col: str = "ingestion_date", as_of=None) -> DataFrame:
    """Partition expiry: keep only days newer than ``as_of - days``.

    ``as_of`` defaults to the newest day present (a scalar subquery over the
    partition column), so the result is stable for tests."""
    df = spark.read.parquet(path)
    if as_of is None:
        newest = df.select(F.max(date_col)).scalar()
    else:
        newest = F.lit(as_of).cast("date")
    return df.filter(F.col(date_col) > F.date_sub(newest, days))


def expire_partitions(spark: SparkSession, path: str, days: int = 7,
                      date_col: str = "ingestion_date", as_of=None) -> list[str]:
    """Partition expiry (K4): delete the day folders that are ``days`` or more older than
    ``as_of`` (default: the newest day present); returns the deleted days. Every later
    reader sees the rest, also of a table that streams and batches append to."""
    found = {d.partition("=")[2]: d for d in storage.children(spark, path)
             if d.startswith(f"{date_col}=")}
    dated = {dt.date.fromisoformat(d): name for d, name in found.items() if d[:1].isdigit()}
    if not dated:
        return []
    newest = max(dated) if as_of is None else dt.date.fromisoformat(str(as_of))
    gone = sorted(d for d in dated if d <= newest - dt.timedelta(days=days))
    for d in gone:
        storage.delete(spark, f"{path}/{dated[d]}")
    return [d.isoformat() for d in gone]


def land_table(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` once as parquet in the shared work folder and return the
    scan of it: a result that several steps read is computed once, its
    lineage is cut, and later reads get column pruning and filter pushdown."""
    from cadenza.session import work_path

    path = work_path(df.sparkSession, name)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """``create or replace view``: the view stores a plan, not data. It lives as long
    as the session; :func:`publish_catalog_view` makes one that outlives it."""
    df.createOrReplaceTempView(name)
    return df


def publish_catalog_view(spark: SparkSession, name: str, sql: str) -> DataFrame:
    """``create or replace view`` in the session catalog, over catalog tables: other
    sessions see it, and it stays as long as the catalog does."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sql}")
    return spark.table(name)


def preview_records(df: DataFrame, n: int = 10, order_by=None,
                    epoch_dates: bool = True) -> DataFrame:
    """First ``n`` rows as JSON records (one string per row). An explicit order
    makes "first" deterministic; the limit is pushed into the plan. Dates and
    timestamps are written as epoch milliseconds (as the records the question
    API returns), unless ``epoch_dates`` is False."""
    if order_by:
        df = df.orderBy(*order_by)
    df = df.limit(n)
    cols = []
    for name, dtype in df.dtypes:
        c = F.col(name)
        if epoch_dates and dtype == "date":
            c = F.unix_millis(c.cast("timestamp")).alias(name)
        elif epoch_dates and dtype.startswith("timestamp"):
            c = F.unix_millis(c.cast("timestamp")).alias(name)
        cols.append(c)
    # Null fields stay in the record as null, as in pandas' records output.
    return df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("record"))


def resolve_day(spark: SparkSession, as_of=None) -> str:
    """The run's day as text, fixed once: a run that goes past midnight keeps its day."""
    return str(as_of) if as_of is not None else str(spark.sql("SELECT current_date() AS d").first()["d"])


def run_date(as_of=None):
    """Date stamp for a run: today by default, fixed for reproducible tests."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, (dt.date, str)):
        return F.lit(str(as_of)).cast("date")
    return as_of
