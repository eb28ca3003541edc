"""Connected components of an edge table.

Every task first contracts its own edges to a forest, so a node has at most one edge per task
and no node is hot.  A forest of at most ``local_edges`` edges is finished by one task of
that bounded size; a larger one by rounds of joins over narrow rows, whose number grows with
the logarithm of the largest component.  Nothing but counts reaches the driver.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import stage

LOCAL_EDGES = 500_000


class Forest:
    """Union-find over any ordered ids; a root is the least id of its tree."""

    def __init__(self):
        self.up: dict = {}

    def root(self, x):
        up = self.up
        top = x
        while (y := up.get(top, top)) != top:
            top = y
        while (y := up.get(x, x)) != top:
            up[x] = top
            x = y
        return top

    def join(self, a, b) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        if b < a:
            a, b = b, a
        self.up[b] = a
        return True

    def edges(self):
        """(node, root) of every node that is not a root."""
        return [(x, self.root(x)) for x in self.up if self.root(x) != x]


def edge_batches(pairs, kind: pa.DataType, size: int = 1 << 16):
    for i in range(0, len(pairs), size):
        u, v = zip(*pairs[i : i + size])
        yield pa.RecordBatch.from_arrays([pa.array(u, kind), pa.array(v, kind)], ["u", "v"])


def contract(edges: DataFrame) -> DataFrame:
    """The forest of each task's edges (u, v): every node with its least node, u > v."""
    schema = edges.select("u", "v").schema

    def run(batches):
        forest, kind = Forest(), None
        for b in batches:
            kind = b.schema.field(0).type
            for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if u is not None and v is not None and u != v:
                    forest.join(u, v)
        yield from edge_batches(forest.edges(), kind)

    return edges.select("u", "v").mapInArrow(run, schema)


def _finished(forest: DataFrame) -> DataFrame:
    """(id, component, size) of a forest that one task can hold."""
    kind = forest.schema["u"].dataType.simpleString()

    def run(batches):
        whole, at = Forest(), None
        for b in batches:
            at = b.schema.field(0).type
            for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                whole.join(u, v)
        size: dict = {}
        pairs = whole.edges()
        for _, root in pairs:
            size[root] = size.get(root, 1) + 1
        pairs += [(r, r) for r in size]
        for i in range(0, len(pairs), 1 << 16):
            u, v = zip(*pairs[i : i + (1 << 16)])
            yield pa.RecordBatch.from_arrays([pa.array(u, at), pa.array(v, at), pa.array([size[x] for x in v], pa.int64())], ["id", "component", "size"])

    return forest.coalesce(1).mapInArrow(run, f"id {kind}, component {kind}, size long")


def components(edges: DataFrame, local_edges: int = LOCAL_EDGES, most_rounds: int = 60) -> DataFrame:
    """(id, component, size): the smallest id reachable and their number, for every id on an edge of ``edges(u, v)``.

    Ids are binary or of another ordered type.  Loops and repeated edges are harmless; edges
    with a null end are dropped.
    """
    # edges often come from Python: staged, they and their forest need one worker a task and not two
    now = stage(contract(stage(edges.select("u", "v"), "edges")), "forest")
    for _ in range(most_rounds):
        if now.count() <= local_edges:
            return stage(_finished(now), "components")
        # a node's trees in several tasks meet in the least of their roots
        least = now.groupBy("u").agg(F.min("v").alias("m"))
        meet = now.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stage(contract(least.select("u", F.col("m").alias("v")).unionByName(meet).repartition("u")), "forest")
        # and a node under a root that has a parent moves up to it
        above = stage(now.groupBy("u").agg(F.min("v").alias("v")), "above")
        moved = now.join(above.select(F.col("u").alias("v"), F.col("v").alias("w")), "v", "left")
        news = moved.agg(F.count_if(F.col("w").isNotNull())).first()[0] + now.count() - above.count()
        now = stage(contract(moved.select("u", F.coalesce("w", "v").alias("v")).unionByName(moved.where("w is not null").select(F.col("v").alias("u"), F.col("w").alias("v")))), "forest")
        if not news:
            break
    else:
        raise RuntimeError("components did not settle")
    now = now.distinct()
    roots = now.groupBy("v").agg((F.count(F.lit(1)) + 1).alias("size"))
    named = now.unionByName(roots.select(F.col("v").alias("u"), "v"))
    return stage(named.join(roots, "v").select(F.col("u").alias("id"), F.col("v").alias("component"), "size"), "components")
