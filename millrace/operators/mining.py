"""Hard-negative mining: near passages that aren't positives and stay below the margin of the positives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .knn import knn_join


def depth(n_passages, k0: int, k_max: int) -> Column:
    """How deep the search goes: ``k0`` doubled while twice the depth is within the smaller of passages and ``k_max``."""
    cap = F.least(n_passages, F.lit(k_max))
    steps = F.greatest(F.lit(0), F.floor(F.log2(cap / F.lit(float(k0))) + F.lit(1e-12)))
    return (F.lit(k0) * F.pow(F.lit(2.0), steps)).cast("long")


def reference_scores(positives: DataFrame, places: int = 9) -> DataFrame:
    """``(query, avg_pos_score)`` of ``positives(query, same_lang, score)``: the mean over positives in the query's
    language, else over all; queries without a scored positive have no row."""
    same = F.avg(F.when(F.col("same_lang"), F.col("score")))
    return positives.where("score is not null").groupBy("query").agg(F.round(F.coalesce(same, F.avg("score")), places).alias("avg_pos_score"))


def threshold(avg, delta: float | None = 0.05, margin: float | None = None) -> Column:
    """Relative: ``avg - |avg| * delta``; absolute: ``avg - margin``."""
    return avg - F.lit(margin) if margin is not None else avg - F.abs(avg) * F.lit(delta)


def mine(queries: DataFrame, passages: DataFrame, positives: DataFrame, reference: DataFrame, k0: int = 50, k_max: int = 1000, n_min: int = 8, delta: float = 0.05, margin: float | None = None, scope: tuple[str, ...] = (), drop_short: bool = False, strict: bool = False, exclude_cross_lingual: bool = True) -> DataFrame:
    """``(scope, query, passage, score, avg_pos_score, rank, n)``: the first ``n_min`` hard negatives of each query by score,
    then passage, both descending; ``rank`` is the 0-based place in the search, ``n`` the 1-based place here.

    ``queries(scope, query, vector)`` and ``passages(scope, passage, vector)``; ``positives(query, passage, same_lang)`` are left
    out in whatever language (or only in the query's, without ``exclude_cross_lingual``); queries without reference
    score have no negatives. A query short of ``n_min`` keeps what it has unless ``drop_short``. ``strict`` takes scores
    below the threshold only."""
    scope = list(scope)
    n = passages.groupBy(*scope).agg(F.count("*").alias("_n")) if scope else passages.agg(F.count("*").alias("_n"))
    active = queries.join(reference.select("query"), "query", "left_semi")
    near = knn_join(active, passages, max(k0, k_max), "ip", scope)
    near = near.join(n, scope) if scope else near.crossJoin(F.broadcast(n))  # a row per scope
    near = near.where(F.col("rank") <= depth(F.col("_n"), k0, k_max)).drop("_n")
    out = positives if exclude_cross_lingual else positives.where("same_lang")
    near = near.join(out.select("query", "passage"), ["query", "passage"], "left_anti").join(reference, "query")
    limit = threshold(F.col("avg_pos_score"), delta, margin)
    near = near.where(F.col("score") < limit if strict else F.col("score") <= limit)
    of = W.partitionBy(*scope, "query")
    near = near.withColumn("n", F.row_number().over(of.orderBy(F.desc("score"), F.desc("passage")))).where(F.col("n") <= n_min)
    if drop_short:
        near = near.withColumn("_all", F.count("*").over(of)).where(F.col("_all") >= n_min).drop("_all")
    return near.select(*scope, "query", "passage", "score", "avg_pos_score", (F.col("rank") - 1).alias("rank"), "n")


def nested(mined: DataFrame, positives: DataFrame, lang: str | None = None) -> DataFrame:
    """``(query, positive_ids, hard_negatives)``: one record per query with its negatives in order."""
    item = F.struct("n", F.struct(F.col("passage").alias("passage_id"), "score", "avg_pos_score", "rank", *( [F.col(lang).alias("lang")] if lang else [])).alias("h"))
    negs = mined.groupBy("query").agg(F.transform(F.sort_array(F.collect_list(item)), lambda x: x["h"]).alias("hard_negatives"))
    pos = positives.groupBy("query").agg(F.sort_array(F.collect_set("passage")).alias("positive_ids"))
    return negs.join(pos, "query", "left").select("query", F.coalesce("positive_ids", F.array().cast("array<string>")).alias("positive_ids"), "hard_negatives")


def merge_negatives(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two lists of ``(query, passage, score, rank)`` as one: per passage the higher score and the larger rank; numbered
    by score, then passage, both descending."""
    both = a.select("query", "passage", "score", "rank").unionByName(b.select("query", "passage", "score", "rank"))
    both = both.groupBy("query", "passage").agg(F.max("score").alias("score"), F.max("rank").alias("rank"))
    return both.withColumn("n", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), F.desc("passage"))))
