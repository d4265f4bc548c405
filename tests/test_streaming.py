import os

from pyspark.sql import functions as F

from cadenza.streaming.snapshots import stream_day_snapshots


def test_stream_appends_each_file_once(spark, scratch_dir):
    landing = os.path.join(scratch_dir, "landing")
    out = os.path.join(scratch_dir, "out")
    ckpt = os.path.join(scratch_dir, "ckpt")
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "id int, d string")
    df.write.mode("append").parquet(landing)
    schema = spark.read.parquet(landing).schema
    day = F.to_date("d")
    first = stream_day_snapshots(spark, landing, schema, out, ckpt, day_expr=day)
    assert first.count() == 2
    again = stream_day_snapshots(spark, landing, schema, out, ckpt, day_expr=day)
    assert again.count() == 2            # nothing new: no duplicate rows
    df.limit(1).write.mode("append").parquet(landing)
    third = stream_day_snapshots(spark, landing, schema, out, ckpt, day_expr=day)
    assert third.count() == 3
    assert sorted(c for c in third.columns) == ["d", "id", "ingestion_date"]


def test_stream_batches_and_expiry_share_a_table(spark, scratch_dir):
    from cadenza.sources import sinks as K
    from conftest import rows

    landing, out = os.path.join(scratch_dir, "landing"), os.path.join(scratch_dir, "out")
    day = lambda n: F.lit(f"2024-01-{n:02d}").cast("date")
    source = lambda a, b, n: spark.range(a, b).select("id", day(n).alias("d"))
    source(0, 3, 1).write.mode("append").parquet(landing)
    schema = spark.read.parquet(landing).schema
    run = lambda c: stream_day_snapshots(spark, landing, schema, out, os.path.join(scratch_dir, c),
                                         day_expr=F.col("d"))
    assert run("c1").count() == 3
    K.append_day_partition(source(10, 20, 2).withColumn("ingestion_date", F.col("d")), out)
    source(3, 5, 9).write.mode("append").parquet(landing)
    assert rows(run("c1"), "id") == [(i,) for i in (*range(5), *range(10, 20))]
    assert K.expire_partitions(spark, out, days=8) == ["2024-01-01"]
    assert rows(spark.read.parquet(out), "id") == [(3,), (4,), *[(i,) for i in range(10, 20)]]
    assert run("c2").count() == 17           # a second stream has its own numbers
