"""Connected components of an edge table by repeated Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billscope.llm.common import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, the smallest node it reaches, for every node of an edge.

    Alternating large-star and small-star steps: each is one grouped minimum and one join, edges never outnumber the
    input's, and the number of rounds grows with the logarithm of the longest path. Each round's table is written, so
    a lost executor costs a task and not the rounds before it. Nodes must be comparable; null nodes are left out.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u is not null and v is not null and u != v")
    pairs = written(pairs.distinct(), "edges")
    print_ = digest(pairs)
    while True:
        before = print_
        both = pairs.select("u", "v").unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # minima are written: a join of two plain tables can split the rows of a node with very many neighbours
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "least")
        # large star: every greater neighbour links to the smallest neighbour
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "large")
        # small star: every smaller neighbour, and the node itself, links to the smallest of them
        small_least = written(large.groupBy("u").agg(F.min("v").alias("m")), "small_least")
        rows = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        small = large.join(small_least, "u").select(F.explode(rows).alias("e")).select("e.u", "e.v").where("u != v")
        pairs = written(small.distinct(), "edges")
        print_ = digest(pairs)
        if print_ == before:
            break
    roots = pairs.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)


def digest(pairs: DataFrame) -> tuple:
    """Count and hash sum of a table without repeated rows; equal for equal tables."""
    return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
