"""Connected components of an undirected graph, by joins."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.llm.base import in_few_tasks
from tamiz.session import materialize


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node of a task's edges with the smallest node that these edges lead to."""
    parent, schema = {}, None

    def root(x):
        while (above := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[above]
        return x

    for batch in batches:
        schema = batch.schema
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, y = root(x), root(y)
            parent[max(x, y)] = min(x, y)
    if parent:
        nodes = list(parent)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip((nodes, [root(x) for x in nodes]), schema)], schema=schema
        )


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node that has an edge; the component is its smallest node.

    Each task first turns its own edges into stars, which link the same nodes by short paths: a round is
    several jobs, and their number follows the length of paths. Each round takes the least label among a node
    and its neighbours and then that label's own label, so that what is long still shrinks by jumps. Labels are
    stored every round and never leave the cluster. Edges from a node to itself and repeated edges change
    nothing; no edges give an empty result.
    """
    one_way = edges.select(F.col(a).alias("x"), F.col(b).alias("y"))
    most = 2 * one_way.count()  # of edges and of nodes
    stars = in_few_tasks(one_way, most).mapInArrow(_stars, one_way.schema)
    ways = [F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in ("xy", "yx", "xx")]
    both = stars.select(F.explode(F.array(*ways)).alias("way")).select("way.*").distinct()
    both = materialize(in_few_tasks(both, most), "edges")
    labels = both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("component"))
    labels = materialize(in_few_tasks(labels, most), "labels")
    while True:
        # A node is among its own neighbours.
        near = both.join(labels.withColumnRenamed("node", "y"), "y").groupBy(F.col("x").alias("node")).agg(
            F.min("component").alias("target"), F.max(F.when(F.col("x") == F.col("y"), F.col("component"))).alias("old")
        )
        jump = labels.select(F.col("node").alias("target"), F.col("component").alias("jumped"))
        stepped = near.join(jump, "target").select("node", F.least("target", "jumped").alias("component"), "old")
        stepped = materialize(in_few_tasks(stepped, most), "labels")
        labels = stepped.select("node", "component")
        if stepped.filter("component <> old").isEmpty():
            return labels
