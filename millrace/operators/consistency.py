"""The consistency filter: is a labelled passage found among the nearest of its query?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.keys import normalize
from .knn import knn_join

ID = ["query_id", "passage_id", "lang", "dataset"]


def score(pairs: DataFrame, query_vectors: DataFrame, passage_vectors: DataFrame, k: int = 30, k_max: int = 100, scope: tuple[str, ...] = ("dataset",)) -> DataFrame:
    """``pairs`` with ``retrieval_rank``, ``virtual_rank`` and ``consistency``.

    ``query_vectors(dataset, lang, query, vector)`` and ``passage_vectors(dataset, lang, passage, vector)`` hold one
    vector for each scoped id. Each query sees its nearest passages of ``scope`` by L2: ``k`` of them if it has
    one positive, ``k_max`` otherwise. ``retrieval_rank`` is the place of the row's own passage, -1 if it isn't
    there or a vector is missing. Beyond ``k`` the virtual rank counts without the query's other positives: place
    minus the other positives before it. Consistent: either rank is within ``k``. Equal rows keep their number.

    Only the ids and ranks of labelled pairs leave the search; texts are joined to them at the end."""
    keys = pairs.select(*(normalize(c).alias(c) for c in ID)).distinct()
    q = query_vectors.select(*(normalize(c).alias(c) for c in ("dataset", "lang", "query")), "vector")
    p = passage_vectors.select(*(normalize(c).alias(c) for c in ("dataset", "lang", "passage")), "vector")
    name = lambda c: F.struct(*(F.col(x) for x in ("dataset", "lang", c)))
    known = keys.groupBy("query_id", "lang", "dataset").agg(F.count("*").alias("n"))
    q = q.join(known, (q["dataset"] == known["dataset"]) & (q["lang"] == known["lang"]) & (q["query"] == known["query_id"]), "left_semi")
    qs = q.select(*scope, F.to_json(name("query")).alias("query"), "vector")
    ps = p.select(*scope, F.to_json(name("passage")).alias("passage"), "vector")
    near = knn_join(qs, ps, max(k, k_max), "l2", list(scope)).select("query", "passage", F.col("rank").alias("r"))
    own = keys.select(*ID, F.to_json(F.struct("dataset", "lang", F.col("query_id").alias("query"))).alias("query"), F.to_json(F.struct("dataset", "lang", F.col("passage_id").alias("passage"))).alias("passage"))
    own = own.join(known, ["query_id", "lang", "dataset"])
    ranked = own.join(near, ["query", "passage"], "left")
    depth = F.when(F.col("n") > 1, k_max).otherwise(k)
    rr = F.when(F.col("r") <= depth, F.col("r"))
    # positives among themselves, in the order of their ranks: those before a row are its place in it less one
    before = F.row_number().over(W.partitionBy("query").orderBy(F.col("r").asc_nulls_last())) - 1
    ranked = ranked.withColumn("b", before).withColumn("rr", rr)
    vr = F.when((F.col("rr") > k) & (F.col("n") > 1), F.col("rr") - F.col("b"))
    ranked = ranked.select(*ID, F.coalesce("rr", F.lit(-1)).cast("int").alias("retrieval_rank"), F.coalesce(vr, F.lit(-1)).cast("int").alias("virtual_rank"))
    ranked = ranked.withColumn("consistency", within(k, strict=False))
    cond = None
    for c in ID:
        e = normalize(pairs[c]) == ranked[c]
        cond = e if cond is None else cond & e
    return pairs.join(ranked, cond).select(*(pairs[c] for c in pairs.columns), "retrieval_rank", "virtual_rank", "consistency")


def within(k: int, strict: bool = True) -> Column:
    """The hybrid condition on the two ranks. ``strict``: below ``k`` (the filter); otherwise up to ``k`` (the flag)."""
    rr, vr = F.col("retrieval_rank"), F.col("virtual_rank")
    r, v = (rr < k, vr < k) if strict else (rr <= k, vr <= k)
    return ((rr != -1) & r) | (((rr == -1) | ~r) & (vr != -1) & v)


def rank_filter(scored: DataFrame, k: int, strict: bool = True) -> DataFrame:
    return scored.where(within(k, strict))


def filter_stats(scored: DataFrame, k: int) -> DataFrame:
    """Counts by dataset and over all (``is_total`` 1, null dataset): rows, rows not consistent, found, found below ``k``, without
    virtual rank, kept by retrieval, kept by virtual rank, and the kept part in percent."""
    rr, vr = F.col("retrieval_rank"), F.col("virtual_rank")
    by_r = (rr != -1) & (rr < k)
    return scored.rollup("dataset").agg(
        F.grouping("dataset").cast("int").alias("is_total"), F.count("*").alias("n"), F.count_if(~F.col("consistency")).alias("inconsistent"), F.count_if(rr != -1).alias("found"), F.count_if(by_r).alias("kept_by_retrieval"),
        F.count_if(vr == -1).alias("without_virtual"), F.count_if(~by_r & (vr != -1) & (vr < k)).alias("kept_by_virtual"), F.round(100.0 * F.count_if(within(k)) / F.count("*"), 6).alias("kept_percent"),
    )


def shard_ratios(scored: DataFrame, by: str) -> DataFrame:
    """Rows, consistent rows and their part, by shard or dataset."""
    return scored.groupBy(by).agg(F.count("*").alias("n"), F.count_if("consistency").alias("consistent"), F.round(F.avg(F.col("consistency").cast("int")), 9).alias("ratio"))
