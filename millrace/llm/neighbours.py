"""Problem 5: the most similar vectors of every vector, by small-world graphs per shard.

Vectors are dealt to shards by the nearest of some centroids (fitted on a bounded sample), so that a vector needs
to be searched in a few shards only; each shard's hierarchical navigable small-world graph is stored as flat neighbour
arrays, a row a shard, and searched by blocks of visitors; the results of a vector's shards are merged. Equal vectors are indexed
once and expanded afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import Scratch
from .hnsw import Hnsw

#: Vectors of one kind that the centroids are fitted on, at most.
SAMPLE = 32_768
#: Vectors of a shard, about, and at most once the number of centroids is at its bound. A cluster with more than twice
#: as many is dealt to several shards, which are all searched.
SHARD, WIDEST = 2048, 65_536
#: Centroids of one kind, at most.
CENTROIDS = 4096
#: Clusters searched for each vector, its own included.
PROBES = 3


def usable_vectors(store: DataFrame, dim: int = 128) -> DataFrame:
    """``(id, kind, vec)``: for each id the vector with the lowest ``source_shard`` among those with ``dim`` finite
    numbers that aren't all zero (null shard: last; ties: the smallest kind and vector); scaled to unit length, as
    bytes. Rows with a null id or kind are left out."""
    e = F.col("embedding")
    good = f"id is not null and kind is not null and size(embedding) = {dim} and exists(embedding, x -> x <> 0) and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < cast('Infinity' as double))"
    rows = store.where(good).select("id", F.struct(F.coalesce(F.col("source_shard").cast("long"), F.lit((1 << 62))).alias("s"), F.col("kind").alias("k"), e.cast("array<float>").alias("e")).alias("r"))
    first = rows.groupBy("id").agg(F.min("r").alias("r")).select("id", F.col("r.k").alias("kind"), F.col("r.e").alias("e"))

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)
            x = (x / np.sqrt((x * x).sum(1, keepdims=True))).astype(np.float32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([r.tobytes() for r in x], pa.binary())], ["id", "kind", "vec"])

    return first.mapInArrow(unit, f"id {dict(store.dtypes)['id']}, kind {dict(store.dtypes)['kind']}, vec binary")


def _rows(vecs, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(vecs), np.float32).reshape(-1, dim)


def fit_centroids(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Unit centroids by spherical k-means; an empty one is put at the vector worst represented."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        of, best = np.empty(len(x), np.int64), np.empty(len(x), np.float32)
        for at in range(0, len(x), 2048):  # a block of similarities at a time
            s = x[at : at + 2048] @ c.T
            of[at : at + 2048], best[at : at + 2048] = s.argmax(1), s.max(1)
        total = np.zeros_like(c)
        np.add.at(total, of, x)
        empty = np.bincount(of, minlength=k) == 0
        if empty.any():
            total[empty] = x[np.argsort(best)[: int(empty.sum())]]
        c = total / np.maximum(np.sqrt((total * total).sum(1, keepdims=True)), 1e-12)
    return c.astype(np.float32)


def _nearest(s: np.ndarray, w: int) -> np.ndarray:
    """The columns of the ``w`` largest numbers of each row, largest first."""
    top = np.argpartition(-s, w - 1, axis=1)[:, :w]
    return np.take_along_axis(top, np.argsort(-np.take_along_axis(s, top, 1), axis=1, kind="stable"), 1)


GRAPH = "kind string, cluster int, shard long, names array<string>, vectors binary, neighbours array<binary>, degrees array<int>, entry int, entry_level int"


def build_graphs(spark: SparkSession, reps: DataFrame, dim: int, probes: int, shard: int, tmp: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(graphs, routed, plan)`` of ``reps(kind, m, vec)``: a row for each shard with its graph as flat arrays (GRAPH), a row for
    each vector and cluster that it is searched in (its own first), and for each cluster its shards and blocks of visitors.

    The graphs are written once, whatever the number of blocks that visit them."""
    sizes = {r["kind"]: r["n"] for r in reps.groupBy("kind").agg(F.count("*").alias("n")).collect()}  # one row a kind
    centroids, wide = {}, {}
    for kind, n in sorted(sizes.items()):
        sample = reps.where(F.col("kind") == kind).select("vec", "m").orderBy("m").limit(SAMPLE).collect()  # bounded: SAMPLE vectors
        parts = min(CENTROIDS, -(-n // shard), max(1, len(sample) // 8))
        wide[kind] = max(shard, min(WIDEST, n // parts))
        centroids[kind] = fit_centroids(_rows([r["vec"] for r in sample], dim), parts)
    fitted = spark.sparkContext.broadcast(centroids)  # CENTROIDS vectors a kind at most

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for kind, part in pdf.groupby("kind"):
                c = fitted.value[kind]
                w = min(probes, len(c))
                x = _rows(part["vec"], dim)
                near = np.concatenate([_nearest(x[at : at + 2048] @ c.T, w) for at in range(0, len(x), 2048)])
                yield pd.DataFrame({"kind": kind, "m": np.repeat(part["m"].values, w), "vec": np.repeat(part["vec"].values, w), "cluster": near.ravel(), "own": np.tile(np.arange(w) == 0, len(part))})

    routed = tmp.cut(reps.mapInPandas(route, "kind string, m string, vec binary, cluster int, own boolean"))
    # clusters by size: how many shards hold their vectors, and how many blocks of visitors each shard gets
    counts = routed.groupBy("kind", "cluster").agg(F.count_if("own").alias("n"), F.count("*").alias("all"))
    width = F.create_map(*(F.lit(x) for kind, n in sorted(wide.items()) for x in (kind, n)))[F.col("kind")] if wide else F.lit(shard)
    plan = tmp.cut(counts.select("kind", "cluster", F.ceil(F.col("n") / (2 * width)).alias("shards"), F.greatest(F.lit(1), F.ceil(F.col("all") / (8 * width))).alias("blocks")))
    stored = routed.where("own").join(plan, ["kind", "cluster"]).select("kind", "cluster", F.pmod(F.xxhash64("m"), F.col("shards")).alias("shard"), "m", "vec")
    shards = plan.agg(F.sum("shards")).first()[0] or 1
    # building is much work on few bytes: a partition for each shard, which is not to be merged by its size
    stored = stored.repartition(int(min(shards, 20_000)), "kind", "cluster", "shard")

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("m")
        graph = Hnsw(_rows(pdf["vec"], dim)).to_bytes()
        return pd.DataFrame([{"kind": key[0], "cluster": key[1], "shard": key[2], "names": list(pdf["m"])} | graph])

    graphs = tmp.cut(stored.groupBy("kind", "cluster", "shard").applyInPandas(build, GRAPH))
    return graphs, routed, plan


def search_graphs(graphs: DataFrame, routed: DataFrame, plan: DataFrame, k: int, dim: int, ef: int) -> DataFrame:
    """``(kind, m, other, similarity)``: the ``k`` + 1 best of each visited shard for each vector, itself left out; visitors come
    in blocks, each of which reads the stored graph."""
    longs = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n).cast("long") - 1)
    asked = routed.join(plan.where("shards > 0"), ["kind", "cluster"])
    asked = asked.select("kind", "cluster", F.explode(longs("shards")).alias("shard"), F.pmod(F.xxhash64("m", F.lit(1)), F.col("blocks")).alias("block"), "m", "vec")
    held = graphs.join(plan.select("kind", "cluster", "blocks"), ["kind", "cluster"]).withColumn("block", F.explode(longs("blocks"))).drop("blocks")
    on = ["kind", "cluster", "shard", "block"]
    tasks = plan.agg(F.sum(F.col("shards") * F.col("blocks"))).first()[0] or 1
    tasks = int(min(tasks, 20_000))
    asked = asked.repartition(tasks, *on)
    held = held.select(*(F.col(c).alias(f"graph_{c}") for c in held.columns)).repartition(tasks, *(f"graph_{c}" for c in on))

    def search(key: tuple, ask: pd.DataFrame, graph: pd.DataFrame) -> pd.DataFrame:
        if not len(ask) or not len(graph):
            return pd.DataFrame({"kind": [], "m": [], "other": [], "similarity": []})
        g = graph.iloc[0]
        names = np.asarray(g["graph_names"], object)
        ids, sims = Hnsw.from_bytes(dim, *(g[f"graph_{c}"] for c in ("vectors", "neighbours", "degrees", "entry", "entry_level"))).search(_rows(ask["vec"], dim), k + 1, ef)
        r, c = np.nonzero(ids >= 0)
        out = pd.DataFrame({"kind": key[0], "m": ask["m"].values[r], "other": names[ids[r, c]], "similarity": sims[r, c].astype(np.float64)})
        return out[out["m"] != out["other"]]

    return asked.groupBy(*on).cogroup(held.groupBy(*(f"graph_{c}" for c in on))).applyInPandas(search, "kind string, m string, other string, similarity double")


def most_similar(spark: SparkSession, store: DataFrame, k: int = 5, dim: int = 128, ef: int = 64, probes: int = PROBES, shard: int = SHARD) -> DataFrame:
    """``(kind, id, other, rank, similarity)``: the ``k`` most similar other ids of the same kind for every id with a
    usable vector (see :func:`usable_vectors`); ties go to the smaller id. An id alone in its kind has no row.

    Approximate: of the true neighbours at least 0.95 are found on the test tables (see the README). Equal vectors
    aren't lost: they share one place in the graph and are expanded from it, ``k`` + 1 of a group at most, which is
    all that a list of ``k`` can hold."""
    tmp = Scratch(spark, "p5")
    vectors = tmp.cut(usable_vectors(store, dim))
    members = tmp.cut(vectors.select("kind", "id", F.md5("vec").alias("m")))
    reps = tmp.cut(vectors.groupBy("kind", F.md5("vec").alias("m")).agg(F.min("vec").alias("vec")))
    graphs, routed, plan = build_graphs(spark, reps, dim, probes, shard, tmp)
    found = search_graphs(graphs, routed, plan, k, dim, ef)
    best = found.withColumn("r", F.row_number().over(W.partitionBy("kind", "m").orderBy(F.desc("similarity"), "other"))).where(F.col("r") <= k).drop("r")
    best = tmp.cut(best)

    # equal vectors: the k + 1 smallest ids of each group (limited before the shuffle) stand for it
    few = members.withColumn("r", F.row_number().over(W.partitionBy("kind", "m").orderBy("id"))).where(F.col("r") <= k + 1)
    few = tmp.cut(few.select("kind", F.col("m").alias("other"), F.col("id").alias("other_id")))
    own = few.select("kind", F.col("other").alias("m"), F.lit(1.0).alias("similarity"), F.col("other_id"))
    lists = best.join(few, ["kind", "other"]).select("kind", "m", "similarity", "other_id").unionByName(own)
    lists = lists.withColumn("r", F.row_number().over(W.partitionBy("kind", "m").orderBy(F.desc("similarity"), "other_id"))).where(F.col("r") <= k + 1)
    lists = lists.groupBy("kind", "m").agg(F.sort_array(F.collect_list(F.struct((-F.col("similarity")).alias("s"), F.col("other_id").alias("o")))).alias("near"))
    mine = members.select("kind", "id", "m").join(lists, ["kind", "m"])
    mine = mine.select("kind", "id", F.posexplode(F.slice(F.filter("near", lambda x: x["o"] != F.col("id")), 1, k)).alias("rank", "x"))
    return mine.select("kind", "id", F.col("x.o").alias("other"), (F.col("rank") + 1).alias("rank"), (-F.col("x.s")).alias("similarity"))


def similar_pairs(spark: SparkSession, store: DataFrame, least: float = 0.80, **options) -> DataFrame:
    """``(id_a, id_b)``: pairs of one kind with a similarity of at least ``least`` of which one is among the most
    similar of the other; the smaller id first, rows distinct."""
    near = most_similar(spark, store, **options).where(F.col("similarity") >= least)
    return near.select(F.least("id", "other").alias("id_a"), F.greatest("id", "other").alias("id_b")).distinct()
