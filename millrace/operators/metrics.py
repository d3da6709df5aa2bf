"""Ranking metrics over runs ``(query_id, doc_id, score)`` and judgements ``(query_id, doc_id, relevance)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.keys import lang_key
from ..schema import require_empty

CUTOFFS = (1, 3, 5, 10, 100)


def rank_run(run: DataFrame, by: list[str] = ("query_id",)) -> DataFrame:
    """Add the 1-based ``rk`` by score descending, then document id."""
    return run.withColumn("rk", F.row_number().over(W.partitionBy(*by).orderBy(F.desc("score"), "doc_id")))


def truncate_run(run: DataFrame, k: int, by: list[str] = ("query_id",)) -> DataFrame:
    """The ``k`` best of each query; shorter lists stay as they are."""
    return rank_run(run, by).where(F.col("rk") <= k)


def query_metrics(run: DataFrame, qrels: DataFrame, cutoffs=CUTOFFS, places: int = 9) -> DataFrame:
    """One row for each judged query: NDCG (linear gain, log2), MAP, recall and precision at each cut-off, reciprocal
    rank, accuracy (any hit) and average precision over the whole list (equal scores share one threshold).

    Figures are rounded to ``places``; take many where means are to be rounded again. Every query with a relevant judgement has a row; one without results has zeros. Relevance 0 and null is not relevant."""
    key = ["query_id"]
    judged = qrels.where("relevance > 0").groupBy("query_id", "doc_id").agg(F.max("relevance").alias("relevance"))
    ideal = judged.withColumn("i", F.row_number().over(W.partitionBy(*key).orderBy(F.desc("relevance"), "doc_id")))
    gain = lambda pos: F.col("relevance") / F.log2(F.col(pos) + F.lit(1.0))
    ideals = ideal.groupBy(*key).agg(F.count("*").alias("n_rel"), *(F.sum(F.when(F.col("i") <= k, gain("i")).otherwise(0.0)).alias(f"idcg{k}") for k in cutoffs))
    r = rank_run(run).join(judged, ["query_id", "doc_id"], "left").withColumn("relevance", F.coalesce("relevance", F.lit(0)))
    hit = (F.col("relevance") > 0).cast("int")
    upto = W.partitionBy(*key).orderBy("rk").rowsBetween(W.unboundedPreceding, 0)
    tied = W.partitionBy(*key).orderBy(F.desc("score")).rangeBetween(W.unboundedPreceding, 0)
    r = r.withColumn("hits", F.sum(hit).over(upto)).withColumn("tie_hits", F.sum(hit).over(tied)).withColumn("tie_rows", F.count("*").over(tied)).withColumn("hit", hit)
    aggs = [F.sum(F.when(F.col("hit") == 1, F.col("tie_hits") / F.col("tie_rows")).otherwise(0.0)).alias("ap_sum"), F.min(F.when(F.col("hit") == 1, F.col("rk"))).alias("first")]
    for k in cutoffs:
        top = F.col("rk") <= k
        aggs += [F.sum(F.when(top, gain("rk")).otherwise(0.0)).alias(f"dcg{k}"), F.sum(F.when(top & (F.col("hit") == 1), F.col("hits") / F.col("rk")).otherwise(0.0)).alias(f"aps{k}"), F.sum(F.when(top, F.col("hit")).otherwise(0)).alias(f"h{k}")]
    m = ideals.join(r.groupBy(*key).agg(*aggs), key, "left")
    out = [F.round(F.coalesce(F.col("ap_sum") / F.col("n_rel"), F.lit(0.0)), places).alias("ap")]
    for k in cutoffs:
        z = lambda c: F.round(F.coalesce(c, F.lit(0.0)), places)
        out += [
            z(F.col(f"dcg{k}") / F.col(f"idcg{k}")).alias(f"ndcg_{k}"), z(F.col(f"aps{k}") / F.col("n_rel")).alias(f"map_{k}"), z(F.col(f"h{k}") / F.col("n_rel")).alias(f"recall_{k}"),
            z(F.col(f"h{k}") / F.lit(float(k))).alias(f"p_{k}"), z(F.when(F.col("first") <= k, 1.0 / F.col("first"))).alias(f"mrr_{k}"), F.coalesce((F.col("first") <= k).cast("int"), F.lit(0)).alias(f"accuracy_{k}"),
        ]
    return m.select(*key, *out)


def mean_metrics(per_query: DataFrame, by: list[str] = (), places: int = 7) -> DataFrame:
    """Means over queries, by ``by`` if given (for example language or dataset), with the number of queries."""
    metrics = [c for c, t in per_query.dtypes if c not in {*by, "query_id"} and t in ("double", "int")]
    aggs = [F.count("*").alias("queries"), *(F.round(F.avg(c), places).alias(c) for c in metrics)]
    return per_query.groupBy(*by).agg(*aggs) if by else per_query.agg(*aggs)


def macro_metrics(by_dataset: DataFrame, dataset: str = "dataset", places: int = 7) -> DataFrame:
    """Means of the datasets' means; datasets without a row take no part."""
    metrics = [c for c, t in by_dataset.dtypes if c not in {dataset, "queries"} and t == "double"]
    return by_dataset.agg(F.count("*").alias("datasets"), *(F.round(F.avg(c), places).alias(c) for c in metrics))


def metrics_by_language(per_query: DataFrame, lang: str = "lang", places: int = 7) -> DataFrame:
    """``(lang_key, queries, metrics)``: means of the queries in Russian, English and both directions between them, and over all
    (``all``). Languages are read by :func:`millrace.functions.keys.lang_key`; others count in ``all`` only."""
    rows = per_query.withColumn("lang_key", F.explode(F.array_compact(F.array(lang_key(lang), F.lit("all"))))).drop(lang)
    return mean_metrics(rows, ["lang_key"], places)


def sample_run(samples: DataFrame, score) -> tuple[DataFrame, DataFrame]:
    """``(run, qrels)`` of evaluation samples ``(query_id, query, positive, negative)``: each sample ranks its own positives (relevant) and
    negatives by ``score(query, text)``, a function of columns. ``doc_id`` tells places apart, positives first."""
    docs = F.concat(F.transform("positive", lambda x, i: F.struct(F.format_string("p%06d", i).alias("doc_id"), x.alias("text"))), F.transform(F.coalesce("negative", F.array().cast("array<string>")), lambda x, i: F.struct(F.format_string("n%06d", i).alias("doc_id"), x.alias("text"))))
    rows = samples.select("query_id", "query", F.explode(docs).alias("d")).select("query_id", "query", "d.doc_id", "d.text")
    run = rows.select("query_id", "doc_id", score(F.col("query"), F.col("text")).alias("score"))
    return run, rows.where(F.col("doc_id").startswith("p")).select("query_id", "doc_id", F.lit(1).alias("relevance"))


def first_queries(run: DataFrame, queries: DataFrame, n: int | None, order: str = "query_id") -> DataFrame:
    """The run of the ``n`` first of ``queries`` by ``order`` (a column of them, such as a row ordinal); None: all."""
    if n is None:
        return run
    return run.join(F.broadcast(queries.select("query_id", order).distinct().orderBy(order, "query_id").limit(n).select("query_id")), "query_id", "left_semi")  # n rows


def validate_run(run: DataFrame, expected: DataFrame, k: int) -> DataFrame:
    """``(query_id, n, problem)`` for expected queries: ``missing`` without results, ``oversize`` with more than ``k``."""
    n = run.groupBy("query_id").agg(F.count("*").alias("n"))
    r = expected.select("query_id").distinct().join(n, "query_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return r.select("query_id", "n", F.when(F.col("n") == 0, "missing").when(F.col("n") > k, "oversize").alias("problem")).where("problem is not null")


def resolve_run(run: DataFrame, queries: DataFrame, corpus: DataFrame, strict: bool = True) -> DataFrame:
    """``run`` with the query's and the document's text; an id without text raises if ``strict``."""
    r = run.join(queries.select("query_id", F.col("text").alias("query_text")), "query_id", "left").join(corpus.select("doc_id", F.col("text").alias("doc_text")), "doc_id", "left")
    if strict:
        require_empty(r.where("query_text is null or doc_text is null").select("query_id", "doc_id"), "no text for")
    return r


def rerank(resolved: DataFrame, scorer, batch: bool = True) -> DataFrame:
    """Replace ``score`` by a model's. ``scorer()`` is called once per worker and gives ``score(queries, docs) -> floats``;
    batches run across query boundaries. With ``batch=False`` it sees one query and all of its documents at a time
    (list-wise models; first-stage lists are of bounded length)."""
    from collections.abc import Iterator

    import pandas as pd

    if batch:

        def f(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            score = scorer()
            for pdf in it:
                yield pdf.assign(score=[float(x) for x in score(list(pdf["query_text"]), list(pdf["doc_text"]))])[["query_id", "doc_id", "score"]]

        return resolved.select("query_id", "doc_id", "query_text", "doc_text").mapInPandas(f, f"query_id {dict(resolved.dtypes)['query_id']}, doc_id {dict(resolved.dtypes)['doc_id']}, score double")

    def g(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id")
        return pdf.assign(score=[float(x) for x in scorer()(list(pdf["query_text"]), list(pdf["doc_text"]))])[["query_id", "doc_id", "score"]]

    return resolved.groupBy("query_id").applyInPandas(lambda pdf: g(pdf), f"query_id {dict(resolved.dtypes)['query_id']}, doc_id {dict(resolved.dtypes)['doc_id']}, score double")


def gpu_summary(samples: DataFrame, by: list[str], value: str) -> DataFrame:
    """Mean and nearest-rank percentiles (the element at index ``int(n * p)`` of the sorted values) of each group."""
    w = W.partitionBy(*by)
    r = samples.where(F.col(value).isNotNull()).withColumn("i", F.row_number().over(w.orderBy(value)) - 1).withColumn("n", F.count("*").over(w))
    at = lambda p: F.max(F.when(F.col("i") == F.least(F.floor(F.col("n") * p), F.col("n") - 1), F.col(value)))
    return r.groupBy(*by).agg(F.max("n").alias("n"), F.round(F.avg(value), 6).alias("mean"), at(0.1).alias("p10"), at(0.9).alias("p90"))
