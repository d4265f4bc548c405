"""WARC archives: a monolithic gzip writer, its normaliser, and an indexed reader.

* Roles. Records of at least ``min_revisit`` payload bytes whose payloads are
  equal (SHA-1 and length) form a group; the one with the largest id is the
  response, the others are revisits that refer to it. Groups are found on ids and
  digests alone; payloads move once, and not at all if Spark can broadcast the revisits.
* :func:`write_archives` writes each task's records into one gzip stream, as
  careless crawlers do.
* :func:`normalise` inflates each such stream once, from front to back and in
  pieces of bounded size, and rewrites every record as a gzip member of its own. Beside the archive it
  writes ``.idx``: 64-bit offset and length of each member.
* :func:`read_archives` reads ranges of records through the index: each member
  is inflated alone, so one archive can be read by many tasks.

File names are unique per task attempt and listed in a manifest table that only
committed attempts reach. Files go to the shared folder of ``spark.checkpoint.dir``
unless a path is given.

Defined cases: null html is an empty payload; null urls stay null; a null id is
always a response and stays null; rows that repeat id and payload are each a record and
have the same role; an empty table gives no archive. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.token_files import local_path, open_output, read_array
from cadenza.session import ship_package, work_path

_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_GZIP = 31                                  # zlib's window bits for the gzip format
_MANIFEST = "name string, n_records long"


def open_input(path: str):
    here = local_path(path)
    if here is not None:
        return open(here, "rb")
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_file(name)


def record_roles(pages: DataFrame, id_col: str, html_col: str, min_revisit: int) -> DataFrame:
    """``_id, _digest, _response`` of the revisits."""
    payload = F.coalesce(F.col(html_col), F.lit(""))
    meta = pages.select(F.col(id_col).alias("_id"), F.sha1(payload).alias("_digest"),
                        F.octet_length(payload).alias("_bytes")).filter(
        (F.col("_bytes") >= min_revisit) & F.col("_id").isNotNull())
    group = (meta.groupBy("_digest", "_bytes")
             .agg(F.max("_id").alias("_response"), F.min("_id").alias("_least"))
             .filter(F.col("_least") < F.col("_response")).drop("_least"))
    return (meta.join(group, ["_digest", "_bytes"]).filter(F.col("_id") != F.col("_response"))
            .select("_id", "_digest", "_response").distinct())


def warc_record(kind: str, name: str, url: str | None, digest: str, size: int, payload: bytes,
                refers_to: str | None, date: str) -> bytes:
    body = _HTTP + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{name}>",
            f"WARC-Date: {date}", "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}",
            f"Content-Length: {len(body)}"]
    if url is not None:
        head.insert(3, "WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head.insert(3, f"WARC-Refers-To: <urn:page:{refers_to}>")
        head.insert(3, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _write_task(folder: str, level: int, date: str):
    def run(batches):
        import pyarrow as pa

        name, out, pack, n = f"{folder}/mono-{uuid.uuid4().hex}.warc.gz", None, None, 0
        for batch in batches:
            for i in range(batch.num_rows):
                if out is None:
                    out, pack = open_output(name), zlib.compressobj(level, zlib.DEFLATED, _GZIP)
                page, url, digest, response = (batch.column(c)[i].as_py() for c in
                                               ("_id", "_url", "_digest", "_response"))
                payload = (batch.column("_html")[i].as_py() or "").encode()
                out.write(pack.compress(warc_record(
                    "response" if response is None else "revisit", "" if page is None else str(page), url,
                    digest, len(payload), payload, None if response is None else str(response), date)))
                n += 1
        if out is not None:
            out.write(pack.flush())
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())],
                                             names=["name", "n_records"])
    return run


def write_archives(pages: DataFrame, folder: str | None = None, id_col: str = "page_id",
                   url_col: str = "url", html_col: str = "html", min_revisit: int = 1000,
                   level: int = 1, date: str = "1970-01-01T00:00:00Z") -> str:
    """Write all pages; returns the folder (archives and ``manifest``)."""
    spark = pages.sparkSession
    ship_package(spark)
    folder = folder or work_path(spark, "warc")
    roles = record_roles(pages, id_col, html_col, min_revisit).withColumnsRenamed(
        {"_id": "_rid", "_digest": "_rdigest"})
    rows = (pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"),
                         F.sha1(F.coalesce(F.col(html_col), F.lit(""))).alias("_digest"),
                         F.col(html_col).alias("_html"))
            .join(roles, (F.col("_id") == F.col("_rid")) & (F.col("_digest") == F.col("_rdigest")), "left")
            .select("_id", "_url", "_digest", "_html", "_response"))
    rows.mapInArrow(_write_task(folder, level, date), _MANIFEST).write.parquet(f"{folder}/manifest")
    return folder


def inflate(stream, piece: int = 1 << 20):
    """Inflated pieces of a gzip file, however many members it has."""
    engine, raw = zlib.decompressobj(_GZIP), b""
    while True:
        raw = raw or stream.read(piece)
        if not raw:
            return
        out = engine.decompress(raw, piece)
        raw = engine.unconsumed_tail
        if out:
            yield out
        if engine.eof:
            raw, engine = engine.unused_data, zlib.decompressobj(_GZIP)


def split_records(pieces):
    """Whole records of an inflated stream, one at a time."""
    held = bytearray()
    pieces = iter(pieces)

    def more() -> bool:
        part = next(pieces, None)
        if part is None:
            return False
        held.extend(part)
        return True

    while held or more():
        while (head := held.find(b"\r\n\r\n")) < 0:
            if not more():
                raise ValueError("the archive ends inside a record's head")
        size = next(int(line.split(b":", 1)[1]) for line in bytes(held[:head]).split(b"\r\n")
                    if line.lower().startswith(b"content-length:"))
        end = head + 4 + size + 4
        while len(held) < end:
            if not more():
                raise ValueError("the archive ends inside a record")
        yield bytes(held[:end])
        del held[:end]


def _normalise_task(folder: str, level: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for source in batch.column("name").to_pylist():
                name = f"{folder}/norm-{uuid.uuid4().hex}.warc.gz"
                at, index = 0, []
                with open_input(source) as stream, open_output(name) as out:
                    for record in split_records(inflate(stream)):
                        pack = zlib.compressobj(level, zlib.DEFLATED, _GZIP)
                        member = pack.compress(record) + pack.flush()
                        out.write(member)
                        index.append((at, len(member)))
                        at += len(member)
                with open_output(name + ".idx") as out:
                    out.write(np.array(index, dtype="<i8").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([len(index)], pa.int64())], names=["name", "n_records"])
    return run


def normalise(spark: SparkSession, source: str, folder: str | None = None, level: int = 4) -> str:
    """Rewrite all archives of a folder; returns the new folder."""
    ship_package(spark)
    folder = folder or work_path(spark, "warc-members")
    parts = spark.read.schema(_MANIFEST).parquet(f"{source}/manifest")
    # A task per archive: a repartition by number is not merged, and deals the names (one
    # row per archive) of one partition out evenly.
    (parts.coalesce(1).repartition(max(1, parts.count()))
     .mapInArrow(_normalise_task(folder, level), _MANIFEST).write.parquet(f"{folder}/manifest"))
    return folder


def parse_record(record: bytes) -> dict:
    head, body = record.split(b"\r\n\r\n", 1)
    fields = {}
    for line in head.decode().split("\r\n")[1:]:
        key, value = line.split(":", 1)
        fields[key.lower()] = value.strip()
    page = lambda v: v[len("<urn:page:"):-1] or None
    out = {"page": page(fields["warc-record-id"]), "url": fields.get("warc-target-uri"),
           "record_type": fields["warc-type"], "refers_to": None,
           "payload_bytes": int(fields["x-payload-length"]),
           "payload_digest": fields["warc-payload-digest"].split(":", 1)[1], "payload": None}
    if out["record_type"] == "revisit":
        out["refers_to"] = page(fields["warc-refers-to"])
        return out
    payload = body[:int(fields["content-length"])].split(b"\r\n\r\n", 1)[1]
    out["payload"] = payload
    if len(payload) != out["payload_bytes"] or hashlib.sha1(payload).hexdigest() != out["payload_digest"]:
        raise ValueError(f"damaged record {out['page']}")
    return out


def _read_task(with_payload: bool):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for job in batch.to_pylist():
                index = read_array(job["name"] + ".idx", "<i8").reshape(-1, 2)[job["lo"]:job["hi"]]
                rows, held = [], 0
                with open_input(job["name"]) as f:
                    for at, size in index.tolist():
                        f.seek(at)
                        rows.append(parse_record(zlib.decompress(f.read(size), _GZIP)))
                        held += len(rows[-1]["payload"] or b"")
                        if not with_payload:
                            rows[-1]["payload"] = None
                        if held > 8 << 20 and with_payload or len(rows) >= 4096:
                            yield pa.RecordBatch.from_pylist(rows, _SCHEMA())
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _SCHEMA())
    return run


def _SCHEMA():
    import pyarrow as pa

    return pa.schema([("page", pa.string()), ("url", pa.string()), ("record_type", pa.string()),
                      ("refers_to", pa.string()), ("payload_bytes", pa.int64()),
                      ("payload_digest", pa.string()), ("payload", pa.binary())])


#: Tasks of one reading at most; beyond that a task reads several ranges.
MAX_TASKS = 50_000


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True,
                  records_per_task: int = 2_000) -> DataFrame:
    """Records of normalised archives: ``page, url, record_type, refers_to,
    payload_bytes, payload_digest, payload`` (null for revisits). Digests and lengths of
    responses are checked against the payload that was read."""
    ship_package(spark)
    step = F.lit(records_per_task).cast("long")
    jobs = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest").select(
        "name", "n_records", F.explode(F.sequence(F.lit(0).cast("long"),
                                                  F.col("n_records") - 1, step)).alias("lo")).select(
        "name", "lo", F.least(F.col("lo") + step, "n_records").alias("hi"))
    return jobs.repartition(max(1, min(jobs.count(), MAX_TASKS))).mapInArrow(
        _read_task(with_payload),
        "page string, url string, record_type string, refers_to string, payload_bytes long, "
        "payload_digest string, payload binary")
