"""Line dedup over three-line windows (native: DataFrame functions only).

Every run of three consecutive ``\\n``-separated lines is a window. Windows are
hashed (128 bits), repeated hashes are found over the whole corpus, and every
occurrence but the first (in order of document id, then line number) is later.
The lines that later occurrences cover are merged into spans and removed.

Because each later window has an equal earlier one, each removed line has an
equal line that stays: no line's content is lost.

Defined cases: null text has no lines and stays null; an empty text is one
empty line; texts with fewer lines than the window have no window and stay
as they are; windows without a visible character are ignored (paragraph
breaks are not passages); rows that repeat a document id *and* text are one
document written twice, so neither is later than the other; rows with one id
and different texts are ordered by a hash of the text; a null id sorts first.
Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def line_windows(docs: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """One row per window: ``_id, _th`` (text hash), ``_pos`` (first line,
    0-based) and the 128-bit hash ``_a, _b``."""
    lines = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_th"),
                        F.split(F.col(text_col), "\n", -1).alias("_lines")).filter(
        F.size("_lines") >= window)
    hashed = lines.select("_id", "_th", F.transform("_lines", lambda x: F.struct(
        F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"),
        x.rlike(r"\S").alias("seen"))).alias("_h"))
    at = lambda i, k, f: F.element_at("_h", (i + k + 1).cast("int"))[f]
    wins = hashed.select("_id", "_th", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("_h") - window),
        lambda i: F.struct(
            i.alias("pos"),
            F.xxhash64(*[at(i, k, "a") for k in range(window)]).alias("a"),
            F.xxhash64(F.lit(2), *[at(i, k, "b") for k in range(window)]).alias("b"),
            F.greatest(*[at(i, k, "seen") for k in range(window)]).alias("seen")))).alias("_w"))
    return wins.filter("_w.seen").select("_id", "_th", F.col("_w.pos").alias("_pos"),
                                         F.col("_w.a").alias("_a"), F.col("_w.b").alias("_b"))


def repeated_spans(wins: DataFrame, window: int) -> DataFrame:
    """Per document: the merged spans (``s`` to ``e``, inclusive) that later
    occurrences of repeated windows cover."""
    from pyspark.sql import Window

    place = F.struct("_id", "_th", "_pos")
    # A partial aggregate per task first, so a window that a third of all
    # documents share sends one row per task; the join below may split it.
    first = (wins.groupBy("_a", "_b")
             .agg(F.min(place).alias("_first"), F.max(place).alias("_last"))
             .filter(F.col("_first") < F.col("_last")).drop("_last"))
    later = (wins.join(first, ["_a", "_b"]).filter(place > F.col("_first"))
             .select("_id", "_th", "_pos").distinct())
    by_doc = Window.partitionBy("_id", "_th").orderBy("_pos")
    islands = (later
               .withColumn("_new", (F.col("_pos") > F.lag("_pos", 1, -2 * window).over(by_doc)
                                    + window).cast("int"))
               .withColumn("_isle", F.sum("_new").over(by_doc)))
    return (islands.groupBy("_id", "_th", "_isle")
            .agg(F.min("_pos").alias("s"), (F.max("_pos") + window - 1).alias("e"))
            .groupBy("_id", "_th")
            .agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("_spans")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                window: int = 3) -> DataFrame:
    """``docs`` with the text cleaned, plus ``n_lines``, ``n_removed`` and
    ``removed_spans`` (array of first and last removed line, 0-based); columns of
    ``docs`` with one of these names are replaced."""
    names = docs.columns
    # Numbered names inside, so no input column can clash with a helper column.
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    id_, text = f"c{names.index(id_col)}", f"c{names.index(text_col)}"
    spans = repeated_spans(line_windows(plain, id_, text, window), window)
    named = spans.withColumnsRenamed({"_id": "_sid", "_th": "_sth"})
    joined = (plain.withColumn("_th", F.xxhash64(text))
              .join(named, F.col(id_).eqNullSafe(F.col("_sid"))
                    & (F.col("_th") == F.col("_sth")), "left")
              .withColumn("_lines", F.split(F.col(text), "\n", -1)))
    n = F.size("_spans")
    # Kept stretches: before the first span, between spans, after the last.
    stretch = F.transform(F.sequence(F.lit(0), n), lambda i: F.struct(
        F.when(i == 0, F.lit(0)).otherwise(
            F.get("_spans", i - 1)["e"] + 1).cast("int").alias("at"),
        F.when(i == n, F.size("_lines")).otherwise(
            F.get("_spans", i)["s"]).cast("int").alias("to")))
    kept = F.flatten(F.transform(F.col("_keep"), lambda g: F.slice(
        "_lines", g["at"] + 1, F.greatest(g["to"] - g["at"], F.lit(0)))))
    removed = F.aggregate("_spans", F.lit(0), lambda acc, x: acc + x["e"] - x["s"] + 1)
    cut = F.col("_spans").isNotNull()
    out = joined.withColumn("_keep", F.when(cut, stretch))
    results = ("n_lines", "n_removed", "removed_spans")
    return out.select(
        *[F.when(cut, F.concat_ws("\n", kept)).otherwise(F.col(text)).alias(name)
          if f"c{i}" == text else F.col(f"c{i}").alias(name)
          for i, name in enumerate(names) if name not in results],
        F.when(F.col(text).isNull(), 0).otherwise(F.size("_lines")).cast("long").alias("n_lines"),
        F.when(cut, removed).otherwise(0).cast("long").alias("n_removed"),
        F.coalesce("_spans", F.expr("cast(array() as array<struct<s:int,e:int>>)"))
        .alias("removed_spans"))
