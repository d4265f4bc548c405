"""Interaction audit of quality filters: what each filter removes in every order.

A document's fate in an order depends only on which filters it fails, so documents are
first counted by part, failed filters and labels: at most 4 x 2^f classes per part. Then,
per part, the mask matrix (classes x filters: 0 where the filter fails, else infinity) and the
matrix of inverse permutations (orders x filters: the step at which an order applies a
filter) are combined by the min-plus product: the smallest step of a failing filter
is the step that removes the class. The classes' weights are scattered to (order, removal
step), and the counts of the audit follow from these sums.

The five filters of :data:`FILTERS`, by letter, and when a text fails them:
A fewer than 200 words; B 100 x distinct words < 50 x words; C 100 x capitals A-Z > 2 x code
points; D any of ``#$%&*|``; E equal to the text of a smaller id of the whole table. Words
are runs without ASCII white space, and case counts.

Defined cases: a null text is the empty text; a null part is the empty string; a null id is
smaller than no other and has no smaller one (E holds for it never); repeated rows of one id and
text count each, and neither is a copy of the other; an id with several label rows has a label
if one of them says so; an empty table has no parts and no rows. Columns other than
those named are not read.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.session import ship_package
from cadenza.sources.sinks import land_table

#: Letter of the filter on copies, and of the ones that look at one text.
COPIES = "E"
FILTERS = "ABCD" + COPIES
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_NEVER = 99


def text_failures(text: Column) -> list[Column]:
    """The failure conditions of A to D, in this order."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n = F.size(words)
    capitals = F.length(text) - F.length(F.translate(text, _CAPITALS, ""))
    return [n < 200, 100 * F.size(F.array_distinct(words)) < 50 * n,
            100 * capitals > 2 * F.length(text), text.rlike("[#$%&*|]")]


def failure_classes(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str,
                    part_col: str) -> DataFrame:
    """``_part, _mask`` (bit i: the i-th filter fails), ``_good, _toxic, _n``: documents
    of each class."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    mask = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(text_failures(text))), F.lit(0))
    # From here on a text is its digest; repeated rows are one row with a count.
    flags = land_table(
        docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(part_col), F.lit("")).alias("_part"),
                    F.unhex(F.sha2(text, 256)).alias("_key"), mask.alias("_mask"))
        .groupBy("_id", "_part", "_key", "_mask").agg(F.count(F.lit(1)).alias("_n")), "filter-flags")
    known = (labels.groupBy(F.col("doc_id").alias("_id"))
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("_good"),
                  F.max((F.col("toxic") == 1).cast("int")).alias("_toxic")))
    # The smallest id of every text that several ids hold; min is taken in each task first.
    first = (flags.groupBy("_key").agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"))
             .filter(F.col("_first") < F.col("_last")).select("_key", "_first"))
    copied = F.when(F.col("_id") > F.col("_first"), 1 << FILTERS.index(COPIES)).otherwise(0)
    return (flags.join(first, "_key", "left").join(known, "_id", "left")
            .groupBy("_part", (F.col("_mask") + copied).alias("_mask"),
                     F.coalesce("_good", F.lit(0)).alias("_good"),
                     F.coalesce("_toxic", F.lit(0)).alias("_toxic"))
            .agg(F.sum("_n").alias("_n")))


def removal_steps(fails: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Min-plus product: the step (classes x orders) at which a class is removed, ``_NEVER``
    or more for none. ``fails`` classes x filters, ``places`` orders x filters."""
    cost = np.where(fails, 0, _NEVER)
    return (cost[:, None, :] + places[None, :, :]).min(2)


def _audit_task(letters: str):
    def run(batches):
        import pyarrow as pa

        f = len(letters)
        orders = np.array(list(itertools.permutations(range(f))))
        places = np.argsort(orders, axis=1) + 1              # inverse permutations
        names = pa.array(["".join(letters[i] for i in o) for o in orders])
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                p, k = part.num_rows, len(orders)
                lists = part.column("_classes")
                flat = lists.flatten()
                own = np.repeat(np.arange(p), np.diff(lists.offsets.to_numpy()))
                mask, good, toxic, n = (flat.field(c).to_numpy() for c in
                                        ("_mask", "_good", "_toxic", "_n"))
                fails = (mask[:, None] >> np.arange(f)) & 1 == 1
                step = removal_steps(fails, places)
                gone = step <= f
                where = (own[:, None] * k + np.arange(k)) * f + np.minimum(step, f) - 1

                def scatter(weight):
                    out = np.zeros(p * k * f, dtype=np.int64)
                    np.add.at(out, where[gone], np.broadcast_to(weight[:, None], where.shape)[gone])
                    return out.reshape(p, k, f)

                def by_filter(rows):
                    out = np.zeros((p, f), dtype=np.int64)
                    np.add.at(out, own, np.where(rows, n[:, None], 0))
                    return out

                removed = scatter(n)
                total = np.bincount(own, weights=n, minlength=p).astype(np.int64)
                failing = by_filter(fails)[:, orders]
                alone = by_filter(fails & (fails.sum(1) == 1)[:, None])[:, orders]
                share = np.zeros((p, f), dtype=np.int64)
                for i in range(k):
                    share[:, orders[i]] += removed[:, i]
                columns = {"kept": total[:, None, None] - removed.cumsum(2), "removed": removed,
                           "redundant": failing - removed, "unique_fails": alone,
                           "good_lost": scatter(n * good), "toxic_lost": scatter(n * toxic),
                           "shapley": share[:, orders]}
                row = np.arange(p * k * f)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_part").take(pa.array(row // (k * f))),
                     names.take(pa.array(row // f % k)), pa.array(row % f + 1, pa.int32())]
                    + [pa.array(c.reshape(-1), pa.int64()) for c in columns.values()],
                    names=["part", "filter_order", "step", *columns])
    return run


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """One row per ``part``, ``filter_order`` and ``step`` with the documents ``kept`` after
    the step, ``removed`` here, ``redundant`` (failing this filter, removed earlier),
    ``unique_fails`` (failing this filter only), ``good_lost`` and ``toxic_lost`` (removed
    here with that label), and ``shapley`` (removed by this filter, over all orders)."""
    ship_package(docs.sparkSession)
    classes = failure_classes(docs, labels, id_col, text_col, part_col)
    # A part has at most 4 x 2^f classes.
    parts = classes.groupBy("_part").agg(F.collect_list(F.struct(
        F.col("_mask"), F.col("_good"), F.col("_toxic"), F.col("_n"))).alias("_classes"))
    counts = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return parts.mapInArrow(_audit_task(FILTERS), "part string, filter_order string, step int, "
                            + ", ".join(f"{c} long" for c in counts))
