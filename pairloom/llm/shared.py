"""Joins and components that no single large key or group can stop."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.session import materialize

# A group is hot above this size and above 1/MAX_HOT of all rows: under MAX_HOT of them.
HOT_ROWS = 10_000
MAX_HOT = 10_000


def meet_groups(members: DataFrame, groups: DataFrame, key: str, rows: str,
                hot_rows=HOT_ROWS) -> DataFrame:
    """Inner join of members with their group; `rows` is the group's number of members.

    `groups` is stored and small per row. Groups that would fill one task are at most
    MAX_HOT rows, so they are broadcast; the others meet their members in an equi join.
    """
    total, largest = groups.agg(F.sum(rows), F.max(rows)).first()
    limit = max(hot_rows, (total or 0) // MAX_HOT)
    if (largest or 0) <= limit:
        return members.join(groups, key)
    hot = groups.filter(F.col(rows) > limit)
    rest = members.join(F.broadcast(hot.select(key)), key, "left_anti")
    cold = groups.filter(F.col(rows) <= limit)
    return members.join(F.broadcast(hot), key).unionByName(rest.join(cold, key))


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Hang the neighbours of each node on the least of them.

    `larger` moves the larger neighbours of a node, otherwise the smaller ones and
    the node itself. Edges are (a, b) with b < a.
    """
    if larger:
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges
    least = around.groupBy("a").agg(F.min("b").alias("m"))
    if larger:
        least = least.withColumn("m", F.least("a", "m"))
        moved = edges.select(F.col("b").alias("a"), F.col("a").alias("v")).join(least, "a")
        moved = moved.select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.unionByName(least.select("a", F.col("m").alias("b")))
    return moved.filter("a > b")


def _not_stars(edges: DataFrame) -> int:
    """Nodes that hang on several others, or on one and have others hang on them."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.filter("up > 1 or up = 1 and down = 1").count()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; edges are columns a and b of longs.

    Alternates large and small stars until only stars are left: a number of rounds that
    grows with the logarithm of the longest chain. Each round is stored.
    """
    edges = materialize(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while _not_stars(edges):
        edges = materialize(_stars(_stars(edges, True), False).distinct())
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root")))
