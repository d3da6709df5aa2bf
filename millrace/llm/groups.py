"""Problem 3: consolidating pairwise matches into groups, by deterministic Boruvka hooking.

In each round every component selects its smallest outgoing edge, the resulting trees collapse by pointer
doubling, and the edges are relabelled and deduplicated, until none remain. A round at least halves the number of
components that still have edges, so the tables shrink geometrically.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Scratch


def connected_groups(spark: SparkSession, edges: DataFrame, tmp: Scratch | None = None) -> DataFrame:
    """``(node, grp)`` for every end of an edge of ``edges(a, b)``; ``grp`` is the smallest node of the group.

    Edges with a null end are ignored, repeated edges count once, loops give a group of their own. Edges of a
    component are ordered by their two ends, so the smallest edge of a node leads to its smallest neighbour and
    two components that select each other are the only cycles."""
    tmp = tmp or Scratch(spark, "p3")
    edges = edges.select("a", "b").where("a is not null and b is not null")
    every = tmp.cut(edges)
    pairs = tmp.cut(every.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    rounds: list[DataFrame] = []
    while not pairs.isEmpty():
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = tmp.cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up")))
        up = hooks.select(F.col("node").alias("up"), F.col("up").alias("up2"))
        # of two that select each other the smaller is the root
        parents = tmp.cut(hooks.join(up, "up").select("node", F.when((F.col("up2") == F.col("node")) & (F.col("node") < F.col("up")), F.col("node")).otherwise(F.col("up")).alias("up")))
        tmp.drop(hooks)
        while True:
            up = parents.select(F.col("node").alias("up"), F.col("up").alias("up2"))
            doubled = tmp.cut(parents.join(up, "up").select("node", F.col("up2").alias("up"), (F.col("up") != F.col("up2")).alias("moved")))
            tmp.drop(parents)
            parents = doubled
            if parents.where("moved").isEmpty():
                break
        rounds.append(parents)
        of = parents.select("node", "up")
        left = pairs.join(of.withColumnRenamed("node", "a"), "a").select(F.col("up").alias("u"), "b")
        left = left.join(of.withColumnRenamed("node", "b"), "b").select("u", F.col("up").alias("v")).where("u <> v")
        fewer = tmp.cut(left.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct())
        tmp.drop(pairs)
        pairs = fewer

    # from the last round back: the roots of a round are the nodes of the next
    roots = None
    for parents in reversed(rounds):
        here = parents.select("node", "up")
        if roots is not None:
            here = here.join(roots.select(F.col("node").alias("up"), F.col("root")), "up", "left").select("node", F.coalesce("root", "up").alias("up"))
        roots = tmp.cut(here.withColumnRenamed("up", "root"))
    alone = every.where("a = b").select(F.col("a").alias("node")).distinct()
    if roots is None:
        return alone.select("node", F.col("node").alias("grp"))
    # the smallest node of each root, then of every node
    least = roots.groupBy("root").agg(F.min("node").alias("grp"))
    named = roots.join(least, "root").select("node", "grp")
    return named.unionByName(alone.join(named, "node", "left_anti").select("node", F.col("node").alias("grp")))


def clean(col):
    """Null as empty, outer white space removed."""
    return F.coalesce(F.regexp_replace(F.col(col).cast("string"), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""), F.lit(""))


def node_links(nodes: DataFrame, keys: DataFrame) -> DataFrame:
    """``(a, b)``: every distinct id with itself, with the parents that are ids, and the nodes of one key as a star
    around the smallest: a key with a third of all rows gives as many links as rows, never all pairs."""
    ids = nodes.select(F.col("id").alias("a")).where("a is not null").distinct()
    parents = nodes.select(F.col("id").alias("a"), F.col("parent").alias("b")).where("a <> b").distinct()
    parents = parents.join(ids.select(F.col("a").alias("b")), "b", "left_semi").select("a", "b")
    key = ["kind", "value", "lang", "dataset"]
    rows = keys.select(*(clean(c).alias(c) for c in key), F.col("node_id").alias("a")).where("a is not null").distinct()
    hubs = rows.groupBy(*key).agg(F.min("a").alias("b"), F.max("a").alias("top")).where("b < top").drop("top")
    stars = rows.join(hubs, key).where("a <> b").select("a", "b").distinct()
    return ids.select("a", F.col("a").alias("b")).unionByName(parents).unionByName(stars)


def node_groups(spark: SparkSession, nodes: DataFrame, keys: DataFrame, tmp: Scratch | None = None) -> DataFrame:
    """``(node_id, group_id)``: one row for each distinct id of ``nodes``; ``group_id`` is the smallest id of its group.

    Rows with a null id are left out; a parent that is no id links nothing; a key's node that is no id of
    ``nodes`` links the nodes it shares keys with but has no row of its own."""
    grp = connected_groups(spark, node_links(nodes, keys), tmp)
    ids = nodes.select(F.col("id").alias("node")).where("node is not null").distinct()
    inside = grp.join(ids, "node", "left_semi")
    # a group may hold foreign nodes: name it by its smallest own id
    least = inside.groupBy("grp").agg(F.min("node").alias("group_id"))
    return inside.join(least, "grp").select(F.col("node").alias("node_id"), "group_id")
