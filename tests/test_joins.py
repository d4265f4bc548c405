from pyspark.sql import functions as F

from cadenza.operators import joins as J
from conftest import rows


def catalogues(spark):
    spotify = spark.createDataFrame(
        [("s1", "Alpha", ["Rock"]), ("s2", "Beta", []), ("s3", None, None),
         ("s4", "Gamma", ["pop", "ROCK"]), ("s5", "Alpha", ["jazz"])],
        "sid string, sname string, genres array<string>")
    deezer = spark.createDataFrame(
        [("d1", "Alpha", 10), ("d2", "Alpha", 20), ("d3", None, 30), ("d4", "Delta", 40),
         ("d5", "alpha", 50)],
        "did string, dname string, fans long")
    return spotify, deezer


def test_name_join_semantics(spark):
    s, d = catalogues(spark)
    out = J.left_join_on_name(s, d, "sname", "dname")
    got = rows(out, "sid", "did")
    # duplicates multiply (s1, s5 x d1, d2); null and unmatched names keep one
    # row with nulls; matching is case-sensitive ("alpha" never matches).
    assert got == sorted([("s1", "d1"), ("s1", "d2"), ("s5", "d1"), ("s5", "d2"),
                          ("s2", None), ("s3", None), ("s4", None)],
                         key=lambda t: tuple((v is not None, v) for v in t))


def test_balanced_join_equals_plain_join(spark):
    left = spark.range(0, 300).select(
        (F.col("id") % 7).alias("k"), F.col("id").alias("lid"))
    left = left.union(spark.createDataFrame([(None, 999)], "k long, lid long"))
    # key 3 is hot on the right: 400 rows, several of them identical
    right = spark.range(0, 400).select(F.lit(3).cast("long").alias("k"),
                                       (F.col("id") % 5).alias("rv"))
    right = right.union(spark.range(0, 20).select((F.col("id") % 4).alias("k"),
                                                  (F.col("id") + 100).alias("rv")))
    plain = left.join(right, "k", "left")
    balanced = J.left_join_balanced(left, right, "k")
    assert balanced.columns == plain.columns
    assert rows(balanced) == rows(plain)


def test_balanced_join_distinct_key_names(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "lk int, lv string")
    right = spark.createDataFrame([(1, "x")] * 30 + [(2, "y")], "rk int, rv string")
    plain = left.join(right, left.lk == right.rk, "left")
    balanced = J.left_join_balanced(left, right, "lk", "rk")
    assert balanced.columns == plain.columns
    assert rows(balanced, "lk", "rk", "rv") == rows(plain, "lk", "rk", "rv")


def test_view_keeps_left_rows_when_the_right_table_changes(spark, scratch_dir):
    """A published view is lazy and holds no statistics: publishing starts no job, and
    left rows stay after the table behind the right side has changed."""
    import os

    from cadenza.sources.sinks import publish_view

    path = os.path.join(scratch_dir, "right.csv")

    def write(name):          # a file of the same length, so the plan's file list stays valid
        with open(path, "w") as fh:
            fh.write("".join(f"{name},{i % 10}\n" for i in range(50)))

    write("hot")
    left = spark.createDataFrame([("a",), ("hot",)], "k string")
    right = spark.read.schema("n string, v int").csv(path)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("publish", "publish")
    publish_view(J.left_join_on_name(left, right, "k", "n"), "v_left")
    assert not tracker.getJobIdsForGroup("publish")
    assert spark.table("v_left").count() == 51
    write("zzz")
    assert rows(spark.table("v_left"), "k", "v") == [("a", None), ("hot", None)]


def test_lookup_with_default(spark):
    tracks = spark.createDataFrame([(1, 10), (2, 0), (3, None), (4, 99)],
                                   "track int, artist int")
    artists = spark.createDataFrame([(10, "Ann"), (0, "Zero")], "id int, name string")
    out = J.lookup_with_default(tracks, artists, "artist", "id", "name", "artist_name")
    assert rows(out, "track", "artist_name") == [(1, "Ann"), (2, "Unknown"),
                                                 (3, "Unknown"), (4, "Unknown")]


def test_unnest_and_member(spark):
    s, _ = catalogues(spark)
    un = J.unnest(s, "genres", "genre")
    # empty and null arrays produce no row
    assert rows(un, "sid", "genre") == [("s1", "Rock"), ("s4", "ROCK"), ("s4", "pop"),
                                        ("s5", "jazz")]
    member = J.with_member(s, "genres", "rock")
    # one row per artist however many genres match; null array is dropped
    assert rows(member, "sid") == [("s1",), ("s4",)]


def test_triple_pattern_with_hot_subject(spark):
    from cadenza.operators.graph import property_rows, triple_pattern
    data = [("Q1", "deezer", "d1"), ("Q2", "deezer", "d2"), ("Q3", "deezer", "d3")]
    data += [("Q1", "track", f"t{i}") for i in range(40)]          # hot subject
    data += [("Q2", "track", "tx"), ("Q1", "url", "u1"), ("Q3", "url", "u3")]
    t = spark.createDataFrame(data, "subject string, predicate string, object string")
    got = triple_pattern(t, ("deezer", "did"), [("track", "tid"), ("url", "url")])
    base = property_rows(t, "deezer", "did")
    want = (base.join(property_rows(t, "track", "tid"), "item", "left")
            .join(property_rows(t, "url", "url"), "item", "left"))
    assert rows(got, "item", "did", "tid", "url") == rows(want, "item", "did", "tid", "url")
    assert got.count() == 42


def test_left_side_is_evaluated_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    left = spark.range(1000).mapInArrow(count, "id long").select(
        F.when(F.col("id") % 5 != 0, F.col("id") % 50).alias("k"), "id")
    right = spark.range(0, 90, 2).select((F.col("id") % 60).alias("k"), F.col("id").alias("v"))
    got = J.left_join_balanced(left, right, "k")
    plain = spark.range(1000).select(F.when(F.col("id") % 5 != 0, F.col("id") % 50).alias("k"), "id").join(
        right, "k", "left")
    assert rows(got) == rows(plain)
    assert seen.value == 1000


def test_pattern_plan_grows_by_a_constant_per_property(spark):
    from cadenza.operators.graph import triple_pattern

    t = spark.createDataFrame(
        [(f"s{i % 7}", f"p{i % 6}", str(i)) for i in range(60)] + [(None, "p0", "x"), (None, "p1", "y")],
        "subject string, predicate string, object string").filter("subject is null or subject <> 's9'")
    scans = []
    for n in range(1, 6):
        out = triple_pattern(t, ("p0", "a"), [(f"p{i}", f"o{i}") for i in range(1, n + 1)])
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        scans.append(plan.count("LogicalRDD") + plan.count("LocalRelation"))
    assert len({b - a for a, b in zip(scans, scans[1:])}) == 1
    side = lambda p, c: t.filter(F.col("predicate") == p).select("subject", F.col("object").alias(c))
    plain = side("p0", "a")
    for i in range(1, 6):
        plain = plain.join(side(f"p{i}", f"o{i}"), "subject", "left")
    assert rows(out) == rows(plain.withColumnRenamed("subject", "item"))
