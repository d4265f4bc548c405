"""Connected components of an edge table, as a loop of joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.session import ship_package
from cadenza.sources.sinks import land_table

#: Edges that one task contracts at most.
LOCAL_EDGES = 200_000


def _contract_task():
    """The components of a task's own edges, as edges from each node to its smallest one."""
    def run(batches):
        import pyarrow as pa

        up: dict = {}

        def root(x):
            while up.setdefault(x, x) != x:
                up[x] = x = up[up[x]]
            return x

        for batch in batches:
            kind = batch.schema.field("u").type
            for a, b in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
                a, b = root(a), root(b)
                if a != b:
                    up[max(a, b)] = min(a, b)
        nodes = [x for x in up if root(x) != x]
        for at in range(0, len(nodes), 1 << 16):
            part = nodes[at:at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part, kind), pa.array([root(x) for x in part], kind)],
                                             names=["u", "v"])
    return run


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the smallest node nearby: the larger neighbours of
    every node (``large``), or the node itself and its smaller neighbours."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    # min() is pre-aggregated per task; the join splits a node with many rows.
    least = both.groupBy("u").agg(F.min("v").alias("_m")).withColumn("_m", F.least("u", "_m"))
    joined = both.join(least, "u")
    if large:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"),
                                                            F.col("_m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("_m").alias("v")).unionByName(
            least.select("u", F.col("_m").alias("v")))
    return out.filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node of an edge, the component being its
    smallest node. Tasks of at most ``LOCAL_EDGES`` edges first contract their own edges to stars;
    a graph of one task is then done. Else large and small stars alternate until nothing
    changes (a number of rounds logarithmic in the nodes); every round is written to the
    shared folder, so lineage stays short. Edges with a null end, loops and
    repeated edges are ignored."""
    ship_package(edges.sparkSession)
    cur = land_table(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
                     .filter(F.col("u") != F.col("v")).distinct(), "edges")
    kind = cur.schema["u"].dataType.simpleString()
    parts = max(1, -(-cur.count() // LOCAL_EDGES))
    cur = land_table(cur.repartition(parts).mapInArrow(_contract_task(), f"u {kind}, v {kind}"), "stars")
    mark = None
    while parts > 1:
        cur = land_table(_star(_star(cur, True), False), "stars")
        state = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == mark:
            break
        mark = state
    leaves = cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("component"))
                              .distinct())
