"""Graph operators: components of the query-passage graph, splits and shards that never cut one."""

from __future__ import annotations

from heapq import heapify, heapreplace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.keys import hash60, normalize
from ..schema import require_empty
from ..session import Scratch


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every end of ``edges(a, b)``; ``component`` is the smallest node of it.

    Alternates large-star and small-star steps (Kiveris et al., 2014): every node hands the smallest neighbour to
    its larger, then to its smaller neighbours, until nothing changes; then all edges lead to the smallest node. A node
    with very many edges is a key of joins only, never a list. Edges with a null end are ignored."""
    tmp = Scratch(spark, "cc")
    edges = edges.select("a", "b").where("a is not null and b is not null").distinct()
    every = tmp.cut(edges)
    e = tmp.cut(every.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = tmp.cut(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x")).select("x.u", "x.v").where("u <> v").distinct()
        small = tmp.cut(small)
        tmp.drop(large, e)
        e = small
        # a star forest that a round leaves as it was is final
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    nodes = every.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    return nodes.join(e.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def bipartite_edges(pairs: DataFrame, query_id="query_id", passage_id="passage_id") -> DataFrame:
    """One edge for each pair of ids; language variants share their ids and so hang together."""
    return pairs.select(F.concat(F.lit("q:"), normalize(query_id)).alias("a"), F.concat(F.lit("p:"), normalize(passage_id)).alias("b")).distinct()


def scoped_edges(pairs: DataFrame) -> DataFrame:
    """Edges between ids in their language and dataset; the parts are joined with a character that ids lack."""
    def key(kind, col):
        return F.concat_ws("\x1f", F.lit(kind), normalize(col), normalize("lang"), normalize("dataset"))

    return pairs.select(key("q", "query_id").alias("a"), key("p", "passage_id").alias("b")).distinct()


def pair_components(spark: SparkSession, pairs: DataFrame) -> DataFrame:
    """``pairs`` with ``component``, by ids only."""
    cc = connected_components(spark, bipartite_edges(pairs)).where(F.col("node").startswith("q:"))
    return pairs.withColumn("node", F.concat(F.lit("q:"), normalize("query_id"))).join(cc, "node").drop("node")


def component_sizes(with_components: DataFrame, *by: str) -> DataFrame:
    """``(component, by, rows, pairs)``."""
    pair = F.struct(normalize("query_id"), normalize("passage_id"))
    return with_components.groupBy("component", *by).agg(F.count("*").alias("rows"), F.count_distinct(pair).alias("pairs"))


def running_before(df: DataFrame, order: str, size: str, out: str) -> DataFrame:
    """Add the sum of ``size`` over all rows that come before in the order of the hex string ``order``, without a
    window over everything: rows are dealt to 4096 ranges of the order, and the ranges' sums are added up."""
    df = df.withColumn("_r", F.substring(order, 1, 3))
    sums = df.groupBy("_r").agg(F.sum(size).alias("_s"))  # 4096 rows at most
    sums = sums.withColumn("_before", F.coalesce(F.sum("_s").over(W.orderBy("_r").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("_s")
    inside = F.coalesce(F.sum(size).over(W.partitionBy("_r").orderBy(order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return df.withColumn(out, inside).join(F.broadcast(sums), "_r").withColumn(out, F.col(out) + F.col("_before")).drop("_r", "_before")


def split_components(spark: SparkSession, pairs: DataFrame, val_fraction: float = 0.04, seed: int = 42) -> DataFrame:
    """``pairs`` with ``component`` and ``split``: components in a seeded order go to train while the pairs before them
    are fewer than the train target, then to validation. Train exceeds its target by one component at most.

    The order is by MD5 of seed and component: the same on any cluster. The target is rounded half to even."""
    tmp = Scratch(spark, "split")
    edges = tmp.cut(bipartite_edges(pairs))
    of = connected_components(spark, edges)
    of = tmp.cut(of.where(F.col("node").startswith("q:")))
    sizes = edges.join(of, edges["a"] == of["node"]).groupBy("component").agg(F.count("*").alias("n"))
    sizes = tmp.cut(sizes.withColumn("o", F.md5(F.concat(F.lit(f"{seed}|"), F.col("component")))))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    train = total - min(max(round(val_fraction * total), 0), total)  # Python rounds half to even
    placed = running_before(sizes, "o", "n", "before").select("component", F.when(F.col("before") < train, "train").otherwise("validation").alias("split"))
    # ids are split first; the rows with their texts are joined once
    ids = tmp.cut(of.join(placed, "component").select(F.substring("node", 3, 1 << 30).alias("_q"), "component", "split"))
    return pairs.withColumn("_q", normalize("query_id")).join(ids, "_q").drop("_q")


def torn_ids(placed: DataFrame, shard: str, keys: list[str]) -> DataFrame:
    """Keys that lie in more than one shard: ``(keys, shards)``. Empty if nothing leaks."""
    return placed.groupBy(*(normalize(k).alias(k) for k in keys)).agg(F.count_distinct(shard).alias("shards")).where("shards > 1")


def validate_no_split(placed: DataFrame, shard: str, keys: list[str]) -> None:
    require_empty(torn_ids(placed, shard, keys), "ids in more than one shard")


def place_runs(histogram: list[tuple[str, int, int]], target: int) -> list[tuple]:
    """``(dataset, size, shard, first, last)`` for ``histogram`` of ``(dataset, size, count)``: which of a dataset's components of one size,
    numbered from 1, go to which shard, by the rule of :func:`assign_shards`.

    Components of one size and dataset are a run. In a run a shard's rank among the others changes only when it takes one, so the
    shards wait in a heap; and one that stays below its part of the dataset and its capacity only gets better by taking more, so it
    takes as many at once as keep it there. A run costs its shards and, beyond that, a logarithm for each turn."""
    total = sum(size * n for _, size, n in histogram)
    shards = max(1, -(-total // target))
    cap = np.full(shards, target, np.int64)
    cap[-1] = total - target * (shards - 1) if total - target * (shards - 1) > 0 else target
    filled, out = np.zeros(shards, np.int64), []
    for dataset in sorted({d for d, _, _ in histogram}):
        part = sorted(((size, n) for d, size, n in histogram if d == dataset), reverse=True)
        aim = cap * (sum(size * n for size, n in part) / max(total, 1))
        own = np.zeros(shards, np.int64)
        for size, n in part:
            after = filled + size
            keys = zip(np.maximum(0, after - cap).tolist(), np.abs(own + size - aim).tolist(), np.abs(after - cap).tolist(), filled.tolist(), range(shards))
            heap = list(keys)
            heapify(heap)
            done = 0
            while done < n:
                s = heap[0][4]
                if size == 0:
                    m = n - done
                else:  # one less than what fits, as the part is no whole number
                    m = max(1, min(n - done, int(cap[s] - filled[s]) // size, int((aim[s] - own[s]) // size) - 1))
                filled[s] += m * size
                own[s] += m * size
                last = out[-1] if out else None
                if last and last[0] == dataset and last[1] == size and last[2] == s:
                    out[-1] = (*last[:4], done + m)
                else:
                    out.append((dataset, size, s, done + 1, done + m))
                done += m
                f, c = int(filled[s]) + size, int(cap[s])
                heapreplace(heap, (max(0, f - c), abs(float(own[s] + size - aim[s])), abs(f - c), int(filled[s]), s))
    return out


def assign_shards(spark: SparkSession, sizes: DataFrame, target: int, seed: int = 42, chunk: int = 100_000) -> DataFrame:
    """``(component, dataset, rows, shard_id)`` for ``sizes(component, dataset, rows)``: datasets in name order, large
    components first, each to the shard with the least overflow, then the dataset count nearest to its part of the
    capacity, then the fill nearest to capacity, the lower fill and the lower number.

    The rule looks at sizes only, so it runs on the histogram of sizes (a dataset of N rows has fewer than
    sqrt(2 N) different ones) in one task (:func:`place_runs`); which component of a size takes which place is decided by a seeded
    hash, ranked in chunks. Null sizes count as 0, a null dataset as the empty name."""
    tmp = Scratch(spark, "shards")
    rows = tmp.cut(sizes.select("component", normalize("dataset").alias("dataset"), F.coalesce("rows", F.lit(0)).cast("long").alias("rows")))
    histogram = tmp.cut(rows.groupBy("dataset", "rows").agg(F.count("*").alias("n")))

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        out = place_runs([(d, int(r), int(n)) for d, r, n in zip(pdf["dataset"], pdf["rows"], pdf["n"])], target)
        return pd.DataFrame(out, columns=["dataset", "rows", "shard_id", "first", "last"])

    places = histogram.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(lambda pdf: place(pdf), "dataset string, rows long, shard_id int, first long, last long")
    dealt = rows.join(histogram, ["dataset", "rows"]).withColumn("o", hash60(F.lit(f"{seed}|"), "component")).withColumn("c", F.floor(F.col("o") / (F.lit(1 << 60) / F.ceil(F.col("n") / chunk))))
    inside = dealt.withColumn("i", F.row_number().over(W.partitionBy("dataset", "rows", "c").orderBy("o", "component")))
    before = dealt.groupBy("dataset", "rows", "c").agg(F.count("*").alias("k"))
    before = before.withColumn("before", F.coalesce(F.sum("k").over(W.partitionBy("dataset", "rows").orderBy("c").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("k")
    ranked = inside.join(before, ["dataset", "rows", "c"]).withColumn("i", F.col("i") + F.col("before"))
    # components of one size are many: they meet their places in blocks
    block = lambda c: F.floor((F.col(c) - 1) / chunk)
    places = tmp.cut(places).select(F.col("dataset").alias("_d"), F.col("rows").alias("_r"), "shard_id", "first", "last", F.explode(F.sequence(block("first"), block("last"))).alias("_b"))
    ranked = ranked.withColumn("_block", block("i"))
    on = (ranked["dataset"] == places["_d"]) & (ranked["rows"] == places["_r"]) & (ranked["_block"] == places["_b"]) & ranked["i"].between(places["first"], places["last"])
    return ranked.join(places, on).select("component", "dataset", "rows", "shard_id")
