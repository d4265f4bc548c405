import datetime as dt

from cadenza.plans.sql_surface import coerce_dates, display_series, preview, run_sql
from cadenza.sources.tables import register_tables
from conftest import SF_SMALL


def test_run_sql_and_errors(spark):
    register_tables(spark, SF_SMALL, ["region"])
    df, err = run_sql(spark, "SELECT r_name FROM region WHERE r_regionkey = :k", {"k": 2})
    assert err is None and df.first()["r_name"] == "ASIA"
    df, err = run_sql(spark, "SELECT nope FROM region")
    assert df is None and err["sql"] == "SELECT nope FROM region" and err["error"]
    recs, err = preview(spark, "SELECT CAST('x' AS INT) AS v FROM region")
    assert recs is None and "sql" in err       # runtime (ANSI cast) error is caught
    recs, err = preview(spark, "SELECT r_regionkey FROM region", n=2, order_by=["r_regionkey"])
    assert err is None and recs == ['{"r_regionkey":0}', '{"r_regionkey":1}']


def test_coerce_dates(spark):
    df = spark.createDataFrame([(1704067200000, "2024-01-02", 12), (None, "garbage", 1)],
                               "release_date long, day_label string, days_on_chart int")
    out = coerce_dates(df).collect()
    # Only the first date column is one; a count of days stays a count.
    assert out[0]["release_date"] == dt.datetime(2024, 1, 1) and out[1]["release_date"] is None
    assert [(r["day_label"], r["days_on_chart"]) for r in out] == [("2024-01-02", 12), ("garbage", 1)]
    text = spark.createDataFrame([("2024-01-02", 3), ("garbage", 1)], "day string, days_on_chart int")
    assert [r["day"] for r in coerce_dates(text).collect()] == [dt.datetime(2024, 1, 2), None]
    # Nothing numeric to show against a date: left alone.
    assert coerce_dates(text.select("day")).collect()[1]["day"] == "garbage"
    series = display_series(spark.createDataFrame([(2, 1), (1, 2)], "day long, n int"))
    assert [r["n"] for r in series.collect()] == [2, 1]


def test_sql_genre_function(spark):
    from cadenza.plans.sql_surface import register_sql_functions
    register_sql_functions(spark)
    spark.createDataFrame([("a", ["Rock", "pop"]), ("b", ["jazz"]), ("c", None)],
                          "id string, genres array<string>").createOrReplaceTempView("g_view")
    df, err = run_sql(spark, "SELECT id FROM g_view WHERE has_genre(genres, :g)", {"g": "ROCK"})
    assert err is None and [r["id"] for r in df.collect()] == ["a"]
