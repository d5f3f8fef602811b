"""Connected components over an edge table: local contraction plus large-star and small-star rounds."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.storage import drop_stored, stored


def _contract(batches):
    """Union-find over the edges of one partition; yields one edge per node to the smallest node it reaches here."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [n for n in parent if find(n) != n]
    for at in range(0, len(nodes), 50_000):
        part = nodes[at : at + 50_000]
        yield pa.RecordBatch.from_pydict({"a": pa.array(part, pa.int64()), "b": pa.array([find(n) for n in part], pa.int64())})


def connected(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, root) for every node of ``edges`` (two long columns) that is not the smallest of its component.

    Each round contracts the partitions on their own, then hangs every neighbour of a node on the smallest one
    (large star) and every smaller neighbour too (small star); the rounds grow with the logarithm of the longest path.
    The smallest neighbour comes from a partial aggregate, is written, and is spread by a join of two plain shuffles,
    which Spark can split at a node with very many neighbours.  Every round is a table in the shared folder.
    """
    a, b = edges.columns
    now = stored(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").mapInArrow(_contract, "a long, b long").distinct())
    for _ in range(max_rounds):
        both = now.union(now.select("b", "a"))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("_a"), F.least("a", "m").alias("m")))
        large = both.join(least, F.col("a") == F.col("_a")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.where("a <> b").distinct())
        drop_stored(least)
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "_a"))
        spread = large.join(least, F.col("a") == F.col("_a")).select(F.explode(F.array("a", "b")).alias("n"), "m")
        small = spread.select(F.col("n").alias("a"), F.col("m").alias("b")).where("a <> b")
        new = stored(small.mapInArrow(_contract, "a long, b long").distinct())
        settled = _same(now, new)
        for table in (large, least, now):
            drop_stored(table)
        now = new
        if settled:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _same(one: DataFrame, other: DataFrame) -> bool:
    def mark(df):
        return df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()

    return mark(one) == mark(other)
