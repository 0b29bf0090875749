"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipstream.llm.staging import remove, staged


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
    return row["n"], row["h"]


def _star(edges: DataFrame) -> DataFrame:
    """One large star and one small star: every node is hung below the least node it knows of.

    Both steps group by node before they join, so a hub costs one combined row and its links can be split.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lowest = down.groupBy("a").agg(F.min("b").alias("m"))
    hung = down.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links`` (columns ``a``, ``b``, both of one type that can be ordered); the component is its least node.

    Each round is a Spark job over all links, written to the shared folder; only a count and a checksum come to the
    driver. Links of a node to itself and nulls are passed over; an empty table gives an empty result.
    """
    spark = links.sparkSession
    edges = staged(links.where("a <> b").select("a", "b").distinct(), "links")
    state = _state(edges)
    while state[0]:
        following = staged(_star(edges), "links")
        then = _state(following)
        for path in {f.rpartition("/")[0] for f in edges.inputFiles()}:
            remove(spark, path)
        edges = following
        if then == state:
            break
        state = then
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
