"""Connected components of an edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.session import discard, materialize


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars: each node hangs on one other, or others hang on it."""
    ends = F.array(*[F.struct(F.col(end).alias("node"), F.lit(up).alias("up")) for end, up in (("u", 1), ("v", 0))])
    nodes = edges.select(F.inline(ends)).groupBy("node").agg(F.sum("up").alias("hangs"), F.min("up").alias("least"))
    return nodes.filter((F.col("hangs") > 1) | ((F.col("hangs") == 1) & (F.col("least") == 0))).isEmpty()


def components(edges: DataFrame, a: str, b: str, most_rounds: int = 60, tasks: int | None = None) -> DataFrame:
    """``(node, component)`` for every node with an edge; the component is its smallest node.

    Each round hangs the larger neighbours of a node on the smallest one, then the smaller ones.
    Neighbours are reduced by partial minima and met by a join that AQE can split, so a node with
    very many edges is never gathered. Rounds end when only stars are left; each is written to the
    shared folder, by ``tasks`` tasks at most. Edges with a null end and loops are left out; no edges
    give no rows.
    """
    u, v = F.greatest(a, b), F.least(a, b)
    edges = edges.filter(F.col(a) != F.col(b)).select(u.alias("u"), v.alias("v")).distinct()
    edges = materialize(edges, "edges", tasks)
    for _ in range(most_rounds):
        if _settled(edges):
            break
        # an edge's larger end is u, here and after each step
        both = edges.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        least = both.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = edges.join(least, "v").select("u", F.col("m").alias("v"))
        centre = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = F.array(*[F.struct(F.col(end).alias("u"), F.col("m").alias("v")) for end in ("u", "v")])
        small = large.join(centre, "u").select(F.inline(hung)).filter(F.col("u") != F.col("v")).distinct()
        edges, old = materialize(small, "edges", tasks), edges
        discard(old)
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
