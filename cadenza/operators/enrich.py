"""Keyed enrichment: ids in batches -> caller-supplied ``fetch`` -> parsed rows.


``fetch(ids: list[str]) -> iterable of (id, status, body)`` stands for any
per-batch lookup (an HTTP endpoint in the reference). Batching happens inside
each partition with ``mapInArrow``; ``max_parallel`` bounds the number of
concurrent tasks (and thus concurrent callers). Response bodies are JSON text
and are parsed JVM-side with ``from_json``, so error documents, non-JSON
bodies and non-200 statuses are dropped by plain filters.

With a ``ledger`` folder every response lands before anything is made of it, and a
run asks only for ids without an answer there, so work done before a failure is never
asked for again (:func:`answer_all`)."""

from __future__ import annotations

import time
from typing import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.session import default_parallelism, ship_package
from cadenza.sources import storage
from cadenza.sources.sinks import land_table

RESPONSE_SCHEMA = "request_id string, status int, body string"


FAILED = -1          # status of an id whose call raised
SILENT = 0           # ledger status of an id that its call did not answer
ROUND_SECONDS = 30   # a round shorter than this is followed by one of twice the size
MAX_ROUNDS = 200     # parts that the open ids of one pass are dealt to


def _requester(id_col: str, fetch: Callable, batch_size: int, on_error: str):
    def answers(chunk: list[str]):
        try:
            return list(fetch(chunk))
        except Exception as exc:
            if on_error == "raise":
                raise
            if len(chunk) == 1:
                return [(chunk[0], FAILED, f"{type(exc).__name__}: {exc}")]
            # One id may spoil a batch: each is asked for alone.
            return [row for one in chunk for row in answers([one])]

    def run(batches: Iterable):
        import pyarrow as pa

        def record(rows):
            rid, status, body = zip(*rows)
            return pa.RecordBatch.from_pydict(
                {"request_id": [str(x) for x in rid], "status": pa.array(status, pa.int32()),
                 "body": pa.array(body, pa.string())})

        held: list[str] = []          # ids go on from one Arrow batch to the next
        for batch in batches:
            values = batch.column(batch.schema.get_field_index(id_col)).to_pylist()
            held += [v for v in values if v is not None and v != ""]
            while len(held) >= batch_size:
                chunk, held = held[:batch_size], held[batch_size:]
                if rows := answers(chunk):
                    yield record(rows)
        if held and (rows := answers(held)):
            yield record(rows)
    return run


def request_batches(ids: DataFrame, id_col: str, fetch: Callable, batch_size: int = 500,
                    max_parallel: int | None = None, on_error: str = "raise") -> DataFrame:
    """Raw responses (request_id, status, body). Batches of
    ``batch_size`` ids run over the whole partition. A call that raises fails the job, or, with
    ``on_error="drop"``, costs only the ids that fail alone as well: each gives a
    row with status :data:`FAILED`, so losses can be counted."""
    ship_package(ids.sparkSession)
    src = ids.select(F.col(id_col).cast("string").alias(id_col))
    if max_parallel:
        src = src.repartition(int(max_parallel))
    return src.mapInArrow(_requester(id_col, fetch, batch_size, on_error), RESPONSE_SCHEMA)


def _recorder(fetch: Callable, batch_size: int, batches_per_turn: int):
    """Like :func:`_requester`, with a row for every id: a call that raises gives ``FAILED`` rows
    and ends the calls of its turn (the service may be down), so the responses before it are
    kept. A turn is ``batches_per_turn`` calls; the next one tries the service again."""
    def run(batches: Iterable):
        import pyarrow as pa

        held: list[str] = []
        down, calls = False, 0

        def ask(chunk):
            nonlocal down, calls
            if calls % batches_per_turn == 0:
                down = False
            calls += 1
            try:
                rows = [] if down else [(str(i), s, b) for i, s, b in fetch(chunk)]
                silent = set() if down else set(chunk) - {r[0] for r in rows}
                rows += [(i, SILENT, None) for i in chunk if i in silent]
            except Exception as exc:
                down = True
                rows = [(i, FAILED, f"{type(exc).__name__}: {exc}") for i in chunk]
            rid, status, body = zip(*rows) if rows else ((), (), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(rid, pa.string()), pa.array(status, pa.int32()), pa.array(body, pa.string())],
                names=["request_id", "status", "body"])

        for batch in batches:
            held += batch.column(0).to_pylist()
            while len(held) >= batch_size:
                chunk, held = held[:batch_size], held[batch_size:]
                yield ask(chunk)
        if held:
            yield ask(held)
    return run


def read_ledger(spark, ledger: str) -> DataFrame:
    """Responses in a ledger folder (none before its first run)."""
    if not storage.exists(spark, ledger):
        return spark.createDataFrame([], RESPONSE_SCHEMA)
    return spark.read.schema(RESPONSE_SCHEMA).parquet(ledger)


def answer_all(ids: DataFrame, id_col: str, fetch: Callable, ledger: str, batch_size: int = 500,
               max_parallel: int | None = None, batches_per_task: int = 20, attempts: int = 3,
               on_error: str = "raise") -> DataFrame:
    """S7 / G2 that survives failures: every distinct id gets one answer in ``ledger``, and is
    asked for only while it has none.

    The ids without an answer (anti join with the ledger) are dealt to parts of at most
    ``max_parallel`` tasks of ``batches_per_task`` calls each (larger ones beyond ``MAX_ROUNDS``
    parts); a round is one Spark write that appends the responses to one part, or to several where
    rounds end within ``ROUND_SECONDS``, so a slow service is asked in small rounds and the cost of
    the writes stays small beside a fast one. A call that raises costs the rest of its turn of
    ``batches_per_task`` calls: what the task heard before is kept, and the rest waits for the next of
    ``attempts`` passes. A run that dies loses the round it was in; the next run goes on from the
    ledger. Ids that the service leaves out are recorded as ``SILENT``, and not asked for again. If ids still have no
    answer, the run raises, or with ``on_error="drop"`` leaves them out. Returns the answers to
    ``ids``: request_id, status, body."""
    spark = ids.sparkSession
    ship_package(spark)
    tasks = max_parallel or default_parallelism(spark)
    want = land_table(ids.select(F.col(id_col).cast("string").alias("request_id"))
                      .filter("request_id IS NOT NULL AND request_id <> ''").distinct(), "wanted-ids")

    def answered():
        return read_ledger(spark, ledger).filter(F.col("status") != FAILED)

    for _ in range(attempts):
        todo = land_table(want.join(answered(), "request_id", "left_anti"), "open-ids")
        n = todo.count()
        parts = min(MAX_ROUNDS, -(-n // (tasks * batches_per_task * batch_size)))
        if not n:
            break
        if parts > 1:
            # A folder per part, so that a round reads its own ids only.
            part = F.pmod(F.xxhash64("request_id"), F.lit(parts)).alias("part")
            todo = land_table(todo.select("request_id", part).repartition("part"), "open-parts", "part")
        done, step = 0, 1
        while done < parts:
            mine = todo if parts == 1 else todo.filter(F.col("part").between(done, done + step - 1))
            begin = time.monotonic()
            (mine.select("request_id").repartition(tasks)
             .mapInArrow(_recorder(fetch, batch_size, batches_per_task), RESPONSE_SCHEMA)
             .write.mode("append").parquet(ledger))
            done += step
            if time.monotonic() - begin < ROUND_SECONDS:
                step *= 2
    answers = answered().join(want, "request_id", "left_semi")
    if on_error == "raise":
        lost = want.join(answered(), "request_id", "left_anti").count()
        if lost:
            raise RuntimeError(f"{lost} ids have no answer after {attempts} attempts")
    return answers


def _responses(ids, id_col, fetch, batch_size, max_parallel, on_error, ledger, attempts):
    if ledger is None:
        return request_batches(ids, id_col, fetch, batch_size, max_parallel, on_error)
    return answer_all(ids, id_col, fetch, ledger, batch_size, max_parallel,
                      attempts=attempts, on_error=on_error)


def enrich_batches(ids: DataFrame, id_col: str, fetch: Callable,
                   body_schema: T.StructType | str, batch_size: int = 500,
                   max_parallel: int | None = None, on_error: str = "raise",
                   ledger: str | None = None, attempts: int = 3) -> DataFrame:
    """S7 + P14 + P15: one parsed record per successful id. Drops non-200
    responses, bodies that are not JSON, documents with an ``error`` field and
    records without an id. Output: ``request_id`` plus the body fields. ``ledger`` and
    ``attempts``: see :func:`answer_all`."""
    raw = _responses(ids, id_col, fetch, batch_size, max_parallel, on_error, ledger, attempts)
    schema = body_schema if isinstance(body_schema, T.StructType) else \
        T.DataType.fromDDL(body_schema)
    if "error" not in schema.fieldNames():
        schema = schema.add("error", T.StringType())
    parsed = raw.filter(F.col("status") == 200).select(
        "request_id", F.from_json("body", schema).alias("doc"))
    ok = (F.col("doc").isNotNull() & F.col("doc.error").isNull() &
          F.col("doc.id").isNotNull() & (F.col("doc.id").cast("string") != ""))
    fields = [f for f in schema.fieldNames() if f != "error"]
    return parsed.filter(ok).select("request_id", *[F.col("doc." + f).alias(f) for f in fields])


def enrich_children(ids: DataFrame, id_col: str, fetch: Callable, child_field: str,
                    body_schema: T.StructType | str, batch_size: int = 50,
                    max_parallel: int | None = None, on_error: str = "raise",
                    ledger: str | None = None, attempts: int = 3) -> DataFrame:
    """One-to-many lookup; each id yields the elements of ``child_field``
    of its response (none for a missing parent). Output: ``request_id`` and
    ``child`` (a struct). ``ledger`` and ``attempts``: see :func:`answer_all`."""
    raw = _responses(ids, id_col, fetch, batch_size, max_parallel, on_error, ledger, attempts)
    schema = body_schema if isinstance(body_schema, T.StructType) else \
        T.DataType.fromDDL(body_schema)
    parsed = raw.filter(F.col("status") == 200).select(
        "request_id", F.from_json("body", schema).alias("doc"))
    return parsed.select("request_id", F.explode(F.col("doc." + child_field)).alias("child"))
