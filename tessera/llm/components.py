"""Connected components of an edge table by distributed union-find."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import batch, map_arrow
from tessera.session import materialize


class Forest:
    """Union-find with path halving; the smallest node of a tree is its root."""

    def __init__(self):
        self.parent = {}

    def find(self, x):
        p = self.parent
        p.setdefault(x, x)
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def join(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True

    def edges(self) -> list[tuple]:
        return [(x, r) for x in self.parent if (r := self.find(x)) != x]


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of each batch: fewer edges, the same components."""
    for b in batches:
        f = Forest()
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            f.join(u, v)
        if found := f.edges():
            yield batch(b.schema, list(map(list, zip(*found, strict=True))))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge that is not a root; root is its component's
    smallest node.  ``edges`` has two columns of one orderable type without nulls.

    Each round links every node to the smallest root it knows, links its other
    roots to that one, and follows one pointer.  Nodes are grouped with a
    map-side minimum only; the neighbours of a hub never meet in one task.
    Rounds end when nothing changes.  No edges: no rows.
    """
    a, b = edges.columns
    e = edges.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root")).filter("node != root")
    kind = {f.name: f.dataType for f in e.schema}["node"].simpleString()
    e = materialize(e.transform(map_arrow, _local, f"node {kind}, root {kind}").distinct())
    state = None
    while True:
        least = e.groupBy("node").agg(F.min("root").alias("to"))
        above = least.select(F.col("node").alias("to"), F.col("to").alias("top"))
        other = e.join(least, "node").filter("root != to").select(F.col("root").alias("node"), F.col("to").alias("root"))
        hop = least.join(above, "to", "left").select("node", F.coalesce("top", "to").alias("root"))
        e = materialize(hop.unionByName(other).distinct())
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "root"))).first()
        if now == state:
            return e
        state = now
