"""Connected components of an edge table, and groups of rows in a task."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.texts import checkpointed


def _with_least(edges: DataFrame) -> DataFrame:
    """Both directions of edges, with the least neighbour of ``u`` or ``u`` itself as ``m``."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return both.join(least, "u").withColumn("m", F.least("u", "m"))


def connected_components(edges: DataFrame, u: str = "u", v: str = "v", most_rounds: int = 60) -> DataFrame:
    """id, component (the least id that can be reached) of every id that an edge names.

    Alternates two steps until nothing changes: link the larger neighbours of a node to its least neighbour, then the
    smaller ones. The number of rounds grows with the logarithm of the size; beyond ``most_rounds`` it raises an error and gives no
    half result. Edges to nothing (null) are left out.
    """
    links = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u is not null and v is not null")
    nodes = None
    current = checkpointed(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    loops = links.where("u = v").select("u", F.col("u").alias("v"))
    before = None
    for _ in range(most_rounds):
        large = _with_least(current).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # in the second step a node and its smaller neighbours go to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = checkpointed(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components are not at rest after {most_rounds} rounds")
    # at rest every edge leads from a node to the least node of its component
    found = current.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = found.select(F.col("component").alias("id"), "component")
    nodes = found.unionByName(roots).unionByName(loops.select(F.col("u").alias("id"), F.col("v").alias("component")))
    return nodes.groupBy("id").agg(F.min("component").alias("component"))


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows that agree in the first ``keys`` columns, across batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_pylist() for i in range(keys)]
        start = 0
        rows = list(zip(*columns, strict=True))
        for i, row in enumerate(rows):
            if row != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, last = [], i, row
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


class UnionFind:
    """Links between places 0 … n - 1 of one group."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, a: int) -> int:
        parent = self.parent
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True
