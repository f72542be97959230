"""Connected components of a pair table: union-find inside partitions, then contraction."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docstrata.runtime import checkpoint, release


def _union_find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning links (node, root) of the partition's pairs, root being the smallest key."""
    parent: dict = {}

    def find(x):
        root = x
        while parent[root] != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if find(x) != x]
    for i in range(0, len(nodes), 50_000):
        part = nodes[i : i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([find(x) for x in part], pa.string())], names=["a", "b"])


def components(pairs: DataFrame) -> DataFrame:
    """pairs: two string columns a, b. Returns node, root: every node of a pair with the
    smallest key of its component. Every round hooks each node to its smallest neighbour and
    contracts; rounds end when no link between different roots is left."""
    links = checkpoint(pairs.where(F.col("a") != F.col("b")).mapInArrow(_union_find, "a string, b string"))
    member = links.select(F.col("a").alias("node"), F.col("a").alias("root")).unionAll(links.select("b", "b")).distinct()
    while True:
        both = links.select("a", "b").unionAll(links.select(F.col("b"), F.col("a")))
        old = (links, member)
        hook = checkpoint(both.groupBy(F.col("a").alias("root")).agg(F.least(F.min("b"), F.first("a")).alias("up")))
        member = checkpoint(member.join(hook, "root", "left").select("node", F.coalesce("up", "root").alias("root")))
        up = hook.select(F.col("root").alias("k"), "up")
        links = links.join(up, links.a == up.k).select(F.col("up").alias("a"), "b").join(up.select(F.col("k").alias("k2"), F.col("up").alias("up2")), F.col("b") == F.col("k2")).select("a", F.col("up2").alias("b"))
        links = checkpoint(links.where(F.col("a") != F.col("b")).distinct().mapInArrow(_union_find, "a string, b string"))
        for done in (*old, hook):
            release(done)
        if links.isEmpty():
            return member
