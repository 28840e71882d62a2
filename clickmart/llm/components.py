"""Connected components of a graph given as a table of links, in Spark."""

from pyspark.sql import functions as F

from clickmart.session import stored


def components(links):
    """(``node``, ``component``) for every node of ``links`` (``a``, ``b``; any orientation): the smallest node reached.

    Each round links every node to the smallest of its neighbours and itself, first among its larger neighbours, then
    among its smaller ones; trees flatten to stars in a number of rounds that grows with the logarithm of the longest
    chain. Rows never meet in one task for a node with many links: each step is an aggregate and a join, in which a
    node's smallest neighbour is one row. Every round is written to the shared checkpoint folder.
    """

    def oriented(frame):
        """Distinct links from the larger to the smaller node."""
        return (
            frame.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        )

    def sign(frame):
        """Number of the links and sum of their hashes."""
        return tuple(frame.select(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = stored(oriented(links), "links")
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    while True:
        # every larger neighbour of a node is linked to the smallest node around it
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")).withColumnRenamed("a", "of")
        large = oriented(edges.join(least, F.col("b") == F.col("of")).select("a", F.col("least").alias("b")))
        # every smaller neighbour too
        least = large.groupBy("a").agg(F.min("b").alias("least")).withColumnRenamed("a", "of")
        joined = large.join(least, F.col("a") == F.col("of"))
        small = joined.select("a", F.col("least").alias("b")).unionAll(joined.select(F.col("b").alias("a"), F.col("least").alias("b")))
        new = stored(oriented(small), "links")
        before, after = sign(edges), sign(new)
        edges = new
        if before == after:
            break
    return nodes.join(edges, F.col("node") == F.col("a"), "left").select("node", F.coalesce("b", "node").alias("component"))
