"""Near-duplicates from SimHash fingerprints, by a grid over segment popcounts.

1. Fingerprint. A text's words (ASCII letters lower-cased) give ``shingle``-word runs,
   repeats kept; each is hashed to 64 bits (XXH64, seed 42), and a bit of the fingerprint is
   1 if more than half of the hashes set it. Equal fingerprints form a class, so a group of
   copies costs one row from here on.
2. Embedding. The 64 bits are cut into sixteen segments of four, and a point's coordinates are
   the segments' numbers of ones. A bit that differs moves one coordinate by one, so the
   Manhattan distance of two points is a lower bound of the differing bits. Coordinates are
   written in unary (c ones at the bottom of the segment), so that distance is again a
   count of differing bits.
3. Grid range join. Of two points within Manhattan distance 2, the first or the last
   eight coordinates are within distance 1. A cell is one half's eight coordinates: every
   point is at home in two cells and looks into those cells and the sixteen cells one step
   up (a step down is the other point's step up). Points that meet, are within distance
   2 over all coordinates, and differ in at most 2 bits on exact comparison, are linked.
4. Overfull cells (more than ``cell_rows`` rows) are joined on the finest grid, whose segments are
   single bits: a point there looks into the 65 cells within distance 1 of itself. Points
   that meet in such a cell are within distance 2 of each other, all points within distance 2
   meet in one, and it never holds more than 65 points, however dense the data. So no
   cell is compared all against all beyond its bound, and no link is lost.
5. Connected components of the links.

Native but for the fingerprints. Defined cases: texts without words and null texts have fingerprint
0 and are linked like any others; fewer words than a shingle are one shingle; rows of
one id are one document (one component); a row with a null id gets its fingerprint, links
with nothing and has a null component; an empty table gives an empty result. Columns other
than id and text are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.components import components
from cadenza.session import ship_package
from cadenza.sources.sinks import land_table

SEED, BITS = 42, 64
#: Segments of four bits: the lowest bit of each.
_LOW = 0x1111111111111111
_LOWER_ASCII = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, shingle: int = 3, block: int = 1 << 15) -> int:
    """64-bit SimHash of one text. Bits are counted ``block`` shingles at a time."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().translate(_LOWER_ASCII).split()     # ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([np.zeros(1, np.int64), ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    starts, ends = starts[:n].tolist(), ends[-n:].tolist()
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, block):
        h = np.array([xxh64_intdigest(joined[a:b], SEED)
                      for a, b in zip(starts[at:at + block], ends[at:at + block])], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprint_task(shingle: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            marks = np.array([fingerprint(t, shingle) for t in batch.column("_text").to_pylist()],
                             dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(marks)],
                                             names=["_id", "_fp"])
    return run


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``_id, _fp`` (the 64 bits as a long)."""
    ship_package(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(
        _fingerprint_task(shingle), f"_id {kind}, _fp long")


def embed(fp: Column) -> Column:
    """The sixteen popcounts of a fingerprint in unary: four bit planes, sorted by a network of
    five comparisons, so that the ones of every segment move to its lowest places."""
    plane = [F.shiftrightunsigned(fp, i).bitwiseAND(F.lit(_LOW)) for i in range(4)]
    for lo, hi in ((0, 1), (2, 3), (0, 2), (1, 3), (1, 2)):
        plane[lo], plane[hi] = (plane[lo].bitwiseOR(plane[hi]), plane[lo].bitwiseAND(plane[hi]))
    out = plane[0]
    for i in (1, 2, 3):
        out = out.bitwiseOR(F.shiftleft(plane[i], i))
    return out


def differing_bits(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _cells(points: DataFrame) -> DataFrame:
    """``_cell, _role, _fp, _e``: role 0 at home, 1 looking into its own cell, 2 into the
    cell one step up in one coordinate."""
    entries = []
    for half in (0, 1):
        own = F.shiftrightunsigned("_e", 32 * half).bitwiseAND(F.lit(0xFFFFFFFF))
        cell = own.bitwiseOR(F.lit(half << 32))
        entries += [F.struct(cell.alias("c"), F.lit(role).alias("r")) for role in (0, 1)]
        for seg in range(8):
            code = F.shiftrightunsigned(own, 4 * seg).bitwiseAND(F.lit(15))
            # One more one in the segment: c is coded 2^c - 1, so the step adds code + 1.
            up = F.when(code != 15, F.struct((cell + F.shiftleft(code + 1, 4 * seg)).alias("c"),
                                             F.lit(2).alias("r")))
            entries.append(up)
    return (points.select("_fp", "_e", F.explode(F.array(*entries)).alias("_x"))
            .filter(F.col("_x").isNotNull())
            .select(F.col("_x.c").alias("_cell"), F.col("_x.r").alias("_role"), "_fp", "_e"))


def _finest_links(points: DataFrame) -> DataFrame:
    """Links ``_a, _b`` over the 65 cells around each point; a cell's points hang on the smallest."""
    flips = F.array(F.col("_fp"), *[F.col("_fp").bitwiseXOR(F.lit(np.uint64(1 << i).view(np.int64).item()))
                                    for i in range(BITS)])
    met = (points.select("_fp", F.explode(flips).alias("_cell")).groupBy("_cell")
           .agg(F.min("_fp").alias("_a"), F.collect_set("_fp").alias("_all"))     # 65 at most
           .filter(F.size("_all") > 1))
    return (met.select("_a", F.explode("_all").alias("_b")).filter(F.col("_a") != F.col("_b"))
            .distinct())


def fingerprint_links(points: DataFrame, cell_rows: int = 2000) -> DataFrame:
    """Links ``_a, _b`` that connect distinct fingerprints (``_fp``) as all pairs at 2 or fewer
    differing bits do."""
    points = points.select("_fp", embed(F.col("_fp")).alias("_e"))
    rows = _cells(points)
    # Cells with a point at home; one of two rows holds a point that looks into its own cell.
    cells = land_table(rows.groupBy("_cell").agg(F.count(F.lit(1)).alias("_rows"),
                                                 F.min("_role").alias("_least"))
                       .filter((F.col("_least") == 0) & (F.col("_rows") > 2))
                       .select("_cell", "_rows"), "grid-cells")
    full = cells.filter(F.col("_rows") > cell_rows).select("_cell")
    kept = rows.join(cells.filter(F.col("_rows") <= cell_rows).select("_cell"), "_cell", "left_semi")
    home = kept.filter("_role = 0").select("_cell", F.col("_fp").alias("_a"), F.col("_e").alias("_ea"))
    look = kept.filter("_role > 0").select("_cell", "_role", F.col("_fp").alias("_b"),
                                           F.col("_e").alias("_eb"))
    met = (home.join(look, "_cell")
           .filter((F.col("_role") == 2) | (F.col("_a") < F.col("_b")))
           .filter(differing_bits(F.col("_ea"), F.col("_eb")) <= 2)        # Manhattan distance
           .filter(differing_bits(F.col("_a"), F.col("_b")) <= 2)          # exact
           .select("_a", "_b"))
    dense = rows.join(full, "_cell", "left_semi").select("_fp").distinct()
    return met.unionByName(_finest_links(dense))


def simhash_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 3, cell_rows: int = 2000) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hexadecimal digits), ``component_id``
    (smallest id reachable over links of 2 or fewer differing bits, its own included)."""
    marks = land_table(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    known = marks.filter(F.col("_id").isNotNull())
    classes = land_table(known.groupBy("_fp").agg(F.min("_id").alias("_rep")), "fingerprint-classes")
    links = land_table(fingerprint_links(classes, cell_rows), "fingerprint-links")
    end = lambda c, name: classes.select(F.col("_fp").alias(c), F.col("_rep").alias(name))
    linked = (links.join(end("_a", "_ra"), "_a").join(end("_b", "_rb"), "_b").select("_ra", "_rb"))
    # An id with several fingerprints is one document: it joins their classes.
    twice = (known.groupBy("_id").agg(F.min("_fp").alias("_lo"), F.max("_fp").alias("_hi"))
             .filter(F.col("_lo") != F.col("_hi")).select("_id"))
    same = (known.join(twice, "_id", "left_semi").distinct().join(classes, "_fp")
            .select(F.col("_id").alias("_ra"), F.col("_rep").alias("_rb")))
    comp = components(linked.unionByName(same), "_ra", "_rb")
    found = land_table(classes.join(comp, F.col("_rep") == F.col("node"), "left").select(
        "_fp", F.coalesce("component", "_rep").alias("component_id")), "fingerprint-components")
    return marks.join(found, "_fp", "left").select(
        F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("_id").isNotNull(), F.col("component_id")).alias("component_id"))
