"""Secret scan with corpus-wide ownership (native: DataFrame functions only).

Base spans, leftmost and non-overlapping per kind, in whole texts:

* ``assign``: a credential word, an assignment sign, and a value of 12 or more characters;
* ``access``: ``AKIA`` and upper-case letters and digits, 18 or more characters;
* ``hex``: lower-case hexadecimal runs of 16 or more characters.

The method's own kind, ``token``: runs of 20 or more letters, digits and ``+/_=-`` that
mix upper case, lower case and digits, outside of base spans. A token is a span only
if the corpus says that it is somebody's own.

Ownership. Every candidate value (an assignment's value, else the whole match) is
hashed (128 bits). Over the whole corpus, the distinct repositories and the
distinct owners that hold each hash are counted, after repeats within a repository have been
added up. A value that at most ``max_owners`` owners hold is live-looking; others
are widely copied examples. Base spans stay whatever the count; tokens are kept if live.

Places are code points, the end exclusive. Matches are placed by the lengths of the
stretches between them, added up by a window per text, so no user code runs and the time
is linear in the number of matches, however many one text holds.

Defined cases: null text is empty; a null repository or owner counts as one of its own;
rows that repeat a document each get the same spans and count once per repository; an
empty table gives no rows. Columns other than the named ones are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.sources.sinks import land_table

# The patterns of the base kinds.
ASSIGN = (r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"           # a run is maximal, so the least length can be in the pattern
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "token")
LEAST = {"assign": 12, "access": 18, "hex": 16, "token": 20}


def _matches(text: Column, kind: str, pattern: str) -> Column:
    """Array of ``(gap, size, value)`` of all matches: code points since the match before,
    code points of the match, value."""
    lit = F.lit(pattern)
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    whole = F.regexp_extract_all(text, lit, F.lit(0))
    value = F.regexp_extract_all(text, lit, F.lit(2)) if kind == "assign" else whole
    row = F.arrays_zip(gaps.alias("gap"), whole.alias("hit"), value.alias("val"))
    got = F.transform(F.slice(row, 1, F.size(whole)), lambda r: F.struct(
        r["gap"].alias("gap"), F.length(r["hit"]).alias("size"), r["val"].alias("value")))
    # Most texts have no match: one search decides.
    return F.when(F.regexp_like(text, lit), got).otherwise(
        F.expr("cast(array() as array<struct<gap:int,size:int,value:string>>)"))


def matches(docs: DataFrame, id_col: str, text_col: str, repo: Column, owner: Column) -> DataFrame:
    """Per row: ``_id, _repo, _owner`` and one array of ``(gap, size, value)`` per kind."""
    text = F.coalesce(F.col("_text"), F.lit(""))
    patterns = (ASSIGN, ACCESS, HEX, TOKEN)
    return (docs.select(F.col(id_col).alias("_id"), repo.alias("_repo"), owner.alias("_owner"),
                        F.col(text_col).alias("_text"))
            .select("_id", "_repo", "_owner",
                    *[_matches(text, k, p).alias(f"_{k}") for k, p in zip(KINDS, patterns)]))


def candidates(rows: DataFrame) -> DataFrame:
    """One row per candidate span of the numbered ``rows`` of :func:`matches`: ``_row, _repo,
    _owner``, two hashes of the value, ``start, kind, end``.

    Places are running sums over a text's matches, and tokens inside of base spans are told by
    the furthest end before them and the next start after them, so the time is linear in the
    matches of a text. Values are hashed before the rows move."""
    hit = F.col("_m.value")
    every = None
    for n, kind in enumerate(KINDS):
        fits = F.length(hit) >= LEAST[kind]
        if kind == "token":
            fits = fits & hit.rlike("[a-z]") & hit.rlike("[A-Z]") & hit.rlike("[0-9]")
        one = (rows.filter(F.size(f"_{kind}") > 0)
               .select("_row", "_repo", "_owner", F.posexplode(f"_{kind}").alias("_pos", "_m"))
               .select("_row", "_repo", "_owner", "_pos", F.lit(n).alias("kind"), fits.alias("_fits"),
                       (F.col("_m.gap") + F.col("_m.size")).alias("_step"), F.col("_m.size").alias("_size"),
                       F.xxhash64(hit).alias("_a"), F.xxhash64(F.lit(1), hit).alias("_b")))
        every = one if every is None else every.unionByName(one)
    so_far = Window.partitionBy("_row", "kind").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    placed = (every.repartition("_row")
              .withColumn("end", F.sum("_step").over(so_far).cast("int"))
              .withColumn("start", F.col("end") - F.col("_size"))
              .filter("_fits"))
    base = F.col("kind") != KINDS.index("token")
    before = Window.partitionBy("_row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    after = (Window.partitionBy("_row").orderBy(F.desc("start"), F.desc("kind"))
             .rowsBetween(Window.unboundedPreceding, -1))
    reach, following = F.max(F.when(base, F.col("end"))), F.min(F.when(base, F.col("start")))
    free = (F.coalesce(F.col("_reach") <= F.col("start"), F.lit(True))
            & F.coalesce(F.col("_next") >= F.col("end"), F.lit(True)))
    return (placed.withColumn("_reach", reach.over(before)).withColumn("_next", following.over(after))
            .filter(base | free)
            .select("_row", "_repo", "_owner", "_a", "_b", "start", "kind", "end"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo: Column | None = None,
         owner: Column | None = None, max_owners: int = 2) -> DataFrame:
    """One row per document: id and ``spans``, an array of ``(start, kind, end,
    live, repos, owners)`` sorted by start, then kind."""
    repo = F.col("source") if repo is None else repo
    owner = F.col("source") if owner is None else owner
    # Written once: the patterns run once, and each row gets a number that stays.
    rows = land_table(matches(docs, id_col, text_col, repo, owner).select(
        F.monotonically_increasing_id().alias("_row"), "*"), "secret_matches")
    keyed = land_table(candidates(rows), "secret_candidates")
    # One row per value and repository, then per value and owner, then per value:
    # each step is added up within tasks first, so a value in a third of all rows stays small.
    owned = (keyed.groupBy("_a", "_b", "_owner", "_repo").agg(F.lit(1).alias("_one"))
             .groupBy("_a", "_b", "_owner").agg(F.count(F.lit(1)).alias("_n"))
             .groupBy("_a", "_b").agg(F.sum("_n").alias("repos"), F.count(F.lit(1)).alias("owners")))
    judged = (keyed.join(owned, ["_a", "_b"])
              .withColumn("live", F.col("owners") <= max_owners)
              .filter((F.col("kind") != KINDS.index("token")) | F.col("live"))
              .groupBy("_row").agg(F.array_sort(F.collect_list(F.struct(
                  "start", "kind", "end", "live", "repos", "owners"))).alias("spans")))
    none = F.expr("cast(array() as array<struct<start:int,kind:int,end:int,live:boolean,"
                  "repos:bigint,owners:bigint>>)")
    return rows.select("_row", F.col("_id").alias(id_col)).join(judged, "_row", "left").select(
        id_col, F.coalesce("spans", none).alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined, in the given order."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
