"""Connected components of an edge table by alternating large and small stars.

Each round is two aggregations and two joins; edges and minima are written to
the shared folder between steps, so that no lineage grows, nothing reaches the
driver but a count and a checksum, and AQE can split the rows of a node with
very many neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.store import stored

EDGES_PER_TASK = 100_000


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``component`` (its smallest node) for every node that has an edge to another.

    Null ends and loops are left out; an empty table gives an empty result.
    """
    edges = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    edges = stored(_oriented(edges), "edges")
    mark = _mark(edges)
    while mark[0]:
        tasks = max(8, mark[0] // EDGES_PER_TASK)
        both = edges.union(edges.select("v", "u")).toDF("u", "v")
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "minima", tasks)
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = stored(_oriented(large), "edges", tasks)
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "minima", tasks)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least.toDF("u", "v"))
        edges = stored(_oriented(small), "edges", tasks)
        last, mark = mark, _mark(edges)
        if mark == last:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _oriented(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller end."""
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _mark(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("bit_xor(xxhash64(v, u, 1))")).first())
