"""Triple-pattern query over an entity-property table (subject, predicate, object).

``?item P_req ?a . OPTIONAL {?item P1 ?b} ... + label`` becomes a chain of left joins
on the subject. A multi-valued property may hold a hot subject, so each optional join is the
balanced form (:func:`cadenza.operators.joins.left_join_balanced`), which evaluates
its left side once: a property costs two filtered scans and two joins, however
many come before it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.operators.joins import left_join_balanced


def property_rows(triples: DataFrame, predicate: str, name: str) -> DataFrame:
    return (triples.filter(F.col("predicate") == F.lit(predicate))
            .select(F.col("subject").alias("item"), F.col("object").alias(name)))


def triple_pattern(triples: DataFrame, required: tuple, optional=(), label: str | None = None,
                   label_name: str = "itemLabel") -> DataFrame:
    """J3 / S6. ``required`` and each ``optional`` entry are (predicate, column).
    Multi-valued properties multiply rows, as in SPARQL. The label is the
    subject's label value, or the subject itself when it has none."""
    pred, name = required
    out = property_rows(triples, pred, name)
    for pred, name in optional:
        out = left_join_balanced(out, property_rows(triples, pred, name), "item")
    if label is not None:
        # One label per subject (the smallest if several were given).
        labels = (property_rows(triples, label, "_label").groupBy("item")
                  .agg(F.min("_label").alias("_label")))
        out = (out.join(labels, "item", "left")
               .withColumn(label_name, F.coalesce(F.col("_label"), F.col("item")))
               .drop("_label"))
        cols = ["item", label_name] + [c for c in out.columns if c not in ("item", label_name)]
        out = out.select(*cols)
    return out
