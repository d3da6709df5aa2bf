"""Queries over vectors, runs and judgements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import keys, vector
from ..functions.models import overlap_scorer
from ..operators import bm25, consistency, knn, metrics, mining, store
from ..session import Scratch
from . import sql


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _knn(spark, d, metric, k=10):
    """The stated query set: rows whose id is divisible by 100, against all rows."""
    e = _t(spark, d, "embeddings")
    q = e.where(F.col("vec_id") % 100 == 0).select(F.col("vec_id").alias("query"), F.col("embedding").alias("vector"))
    p = e.select(F.col("vec_id").alias("passage"), F.col("embedding").alias("vector"))
    return knn.knn_join(q, p, k, metric)


def knn_topk_ip(spark, d):
    return _knn(spark, d, "ip").withColumn("score", F.round("score", 6))


def knn_topk_l2(spark, d):
    return _knn(spark, d, "l2").withColumn("score", F.round("score", 6))


def knn_recall(spark, d):
    """Of the ten nearest of the stated queries, how many the approximate search with its defaults finds."""
    e = _t(spark, d, "embeddings")
    q = e.where(F.col("vec_id") % 100 == 0).select(F.col("vec_id").alias("query"), F.col("embedding").alias("vector"))
    p = e.select(F.col("vec_id").alias("passage"), F.col("embedding").alias("vector"))
    near = knn.knn_join_cells(q, p, 10).select("query", "passage")
    exact = knn.knn_join(q, p, 10).select("query", "passage")
    r = exact.join(near.withColumn("found", F.lit(1)), ["query", "passage"], "left").agg(F.count("*").alias("wanted"), F.count("found").alias("found"))
    return r.select("wanted", (F.col("found") >= 0.9 * F.col("wanted")).cast("int").alias("recall_of_09"))


def _stored(spark, d):
    """Vectors kept for each key; ``item`` is the id without its language."""
    st = store.stored(_t(spark, d, "vector_store"), 128)
    return st.withColumn("item", F.regexp_replace("id", "_[^_]*$", ""))


def _scored(spark, d):
    st = _stored(spark, d)
    q = st.where("kind = 'query'").select("dataset", "lang", F.col("item").alias("query"), "vector")
    p = st.where("kind = 'passage'").select("dataset", "lang", F.col("item").alias("passage"), "vector")
    return consistency.score(_t(spark, d, "pairs"), q, p, 30, 100)


def consistency_score(spark, d):
    s = _scored(spark, d)
    return s.groupBy("query_id", "passage_id", "lang", "dataset", "retrieval_rank", "virtual_rank", "consistency").agg(F.count("*").alias("n"))


def consistency_filter(spark, d):
    return consistency.rank_filter(_scored(spark, d), 30).select("query_id", "passage_id", "lang", "dataset", "query", "retrieval_rank", "virtual_rank")


def filter_stats_rollup(spark, d):
    return consistency.filter_stats(_scored(spark, d), 30)


def consistency_by_dataset(spark, d):
    return consistency.shard_ratios(_scored(spark, d), "dataset")


def _mining(spark, d):
    tmp = Scratch(spark, "mine")
    st = tmp.cut(_stored(spark, d))
    q = st.where("kind = 'query'").select("dataset", F.col("id").alias("query"), "lang", "item", "vector")
    p = st.where("kind = 'passage'").select("dataset", F.col("id").alias("passage"), "lang", "item", "vector")
    base = _t(spark, d, "pairs").select("dataset", F.col("query_id").alias("item"), "passage_id").distinct()
    pos = q.select("dataset", "query", "item", F.col("lang").alias("ql"), F.col("vector").alias("qv")).join(base, ["dataset", "item"]).drop("item")
    pos = pos.join(p.select("dataset", "passage", F.col("item").alias("passage_id"), "lang", "vector"), ["dataset", "passage_id"])
    pos = tmp.cut(pos.select("query", "passage", (F.col("ql") == F.col("lang")).alias("same_lang"), F.round(vector.dot("qv", "vector"), 9).alias("score")).distinct())
    ref = tmp.cut(mining.reference_scores(pos))
    mined = mining.mine(q.select("dataset", "query", "vector"), p.select("dataset", "passage", "vector"), pos, ref, scope=("dataset",))
    return tmp.cut(mined), pos, ref


def positive_reference_score(spark, d):
    return _mining(spark, d)[2].withColumn("avg_pos_score", F.round("avg_pos_score", 6))


def hard_negative_mine(spark, d):
    m = _mining(spark, d)[0]
    return m.withColumn("score", F.round("score", 6)).withColumn("avg_pos_score", F.round("avg_pos_score", 6))


def hard_negative_nested(spark, d):
    m, pos, _ = _mining(spark, d)
    n = mining.nested(m, pos)
    return n.select("query", F.array_join("positive_ids", ",").alias("positive_ids"), F.array_join(F.transform("hard_negatives", lambda h: h["passage_id"]), ",").alias("negative_ids"), F.size("hard_negatives").alias("n"))


def merged_negatives(spark, d):
    """The mined list merged with the plain nearest passages of the same queries."""
    m, pos, ref = _mining(spark, d)
    plain = mining.mine(*(_sides(spark, d)), pos, ref, margin=-1000.0, scope=("dataset",))
    return mining.merge_negatives(m, plain).withColumn("score", F.round("score", 6))


def _sides(spark, d):
    st = _stored(spark, d)
    return st.where("kind = 'query'").select("dataset", F.col("id").alias("query"), "vector"), st.where("kind = 'passage'").select("dataset", F.col("id").alias("passage"), "vector")


def _run(spark, d, k=100):
    """A run of the stated query set with judgements: vectors of one label are relevant, those of the next label slightly."""
    e = _t(spark, d, "embeddings")
    found = _knn(spark, d, "ip", k + 1).where("query <> passage")  # one more: the query itself is mostly among them
    found = found.withColumn("n", F.row_number().over(W.partitionBy("query").orderBy("rank"))).where(F.col("n") <= k)
    run = found.select(F.col("query").alias("query_id"), F.col("passage").alias("doc_id"), "score")
    q = e.where(F.col("vec_id") % 100 == 0).select(F.col("vec_id").alias("query_id"), "label")
    docs = e.select(F.col("vec_id").alias("doc_id"), F.explode(F.array(F.struct(F.col("label").alias("l"), F.lit(2).alias("r")), F.struct(((F.col("label") + 9) % 10).alias("l"), F.lit(1).alias("r")))).alias("x"))
    qrels = q.join(docs, q["label"] == F.col("x.l")).where("query_id <> doc_id").select("query_id", "doc_id", F.col("x.r").alias("relevance"))
    return run, qrels, q


def rank_metrics(spark, d):
    run, qrels, _ = _run(spark, d)
    return metrics.query_metrics(run, qrels, (1, 3, 10, 100)).select("query_id", "ap", *_METRICS)


def _by_label(spark, d):
    run, qrels, q = _run(spark, d)
    return metrics.query_metrics(run, qrels, (1, 3, 10, 100), places=13).select("query_id", "ap", *_METRICS).join(q, "query_id").withColumnRenamed("label", "dataset")


def rank_metrics_by_group(spark, d):
    return metrics.mean_metrics(_by_label(spark, d), ["dataset"])


def macro_metrics(spark, d):
    return metrics.macro_metrics(metrics.mean_metrics(_by_label(spark, d), ["dataset"], places=13).withColumn("dataset", F.col("dataset").cast("string")))


def _bm25(spark, d, k=100):
    docs = _t(spark, d, "documents").select("doc_id", "text")
    items = _t(spark, d, "heldout_items").select(F.col("item_id").alias("query_id"), "text")
    return bm25.bm25(docs, items, k)


def bm25_topk(spark, d):
    return _bm25(spark, d)


def run_truncate(spark, d):
    return metrics.truncate_run(_bm25(spark, d).drop("rk"), 5)


def run_validate(spark, d):
    items = _t(spark, d, "heldout_items").select(F.col("item_id").alias("query_id"))
    return metrics.validate_run(_bm25(spark, d), items, 10)


def rerank_apply(spark, d):
    """The first stage reranked by word overlap (a model's place), ranked again."""
    tmp = Scratch(spark, "rerank")
    run = tmp.cut(_bm25(spark, d).select("query_id", "doc_id", "score"))
    full = metrics.resolve_run(run, _t(spark, d, "heldout_items").select(F.col("item_id").alias("query_id"), "text"), _t(spark, d, "documents").select("doc_id", "text"))
    again = metrics.rerank(full, overlap_scorer).withColumn("score", F.round("score", 9))
    return metrics.rank_run(again).where("rk <= 5")


_METRICS = [f"{m}_{k}" for k in (1, 3, 10, 100) for m in ("ndcg", "map", "recall", "p", "mrr", "accuracy")]

_KNN = """e as (select vec_id, embedding::double[] as v from embeddings),
  n as (select q.vec_id as query, p.vec_id as passage, {score} as s from e q cross join e p where q.vec_id % 100 = 0),
  r as (select query, passage, s, row_number() over (partition by query order by s {order}, passage) as rank from n)"""
_KNN_IP = _KNN.format(score=sql.IP, order="desc")
_KNN_L2 = _KNN.format(score=sql.L2, order="asc")

_AT = ", ".join(
    f"""round(coalesce(sum(case when rk <= {k} then rel / log2(rk + 1) end) / any_value(i.idcg{k}), 0), 9) as ndcg_{k}, round(coalesce(sum(case when rk <= {k} and rel > 0 then hits / rk end) / any_value(i.n_rel), 0), 9) as map_{k},
    round(coalesce(count(*) filter (rk <= {k} and rel > 0) / any_value(i.n_rel), 0), 9) as recall_{k}, round(count(*) filter (rk <= {k} and rel > 0) / {k}.0, 9) as p_{k},
    round(coalesce(max(case when rk <= {k} and rel > 0 then 1.0::double / rk end), 0), 9) as mrr_{k}, cast(coalesce(max(case when rk <= {k} and rel > 0 then 1 end), 0) as int) as accuracy_{k}"""
    for k in (1, 3, 10, 100)
)
_EVAL = f"""{_KNN_IP}, qr as (select q.vec_id as query_id, p.vec_id as doc_id, case when p.label = q.label then 2 else 1 end as rel from embeddings q join embeddings p on (p.label = q.label or (p.label + 9) % 10 = q.label) and q.vec_id <> p.vec_id where q.vec_id % 100 = 0),
  ir as (select *, row_number() over (partition by query_id order by rel desc, doc_id) as i from qr),
  ideal as (select query_id, count(*) as n_rel, {', '.join(f'sum(case when i <= {k} then rel / log2(i + 1) end) as idcg{k}' for k in (1, 3, 10, 100))} from ir group by 1),
  run as (select query as query_id, passage as doc_id, s as score, row_number() over (partition by query order by s desc, passage) as rk from r where query <> passage qualify rk <= 100),
  j as (select run.*, coalesce(qr.rel, 0) as rel, sum(case when qr.rel > 0 then 1 else 0 end) over (partition by run.query_id order by rk rows unbounded preceding) as hits,
    sum(case when qr.rel > 0 then 1 else 0 end) over (partition by run.query_id order by score desc range unbounded preceding) as th, count(*) over (partition by run.query_id order by score desc range unbounded preceding) as tn
    from run left join qr on qr.query_id = run.query_id and qr.doc_id = run.doc_id),
  per as (select i.query_id, round(coalesce(sum(case when rel > 0 then th / tn end) / any_value(i.n_rel), 0), 9) as ap, {_AT} from ideal i left join j on j.query_id = i.query_id group by 1)"""
_MEANS = ", ".join(f"round(avg({m}), 7) as {m}" for m in ["ap", *_METRICS])
_MEANS_BY = ", ".join(f"round({m}, 7) as {m}" for m in ["ap", *_METRICS])
_GROUPED = f"{_EVAL.replace(', 9) as', ', 13) as').replace(', 9)::', ', 13)::')}, g as (select e.label as dataset, count(*) as queries, {_MEANS.replace(', 7) as', ', 13) as')} from per join embeddings e on e.vec_id = per.query_id group by 1)"

_WORDS = "regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+')"
_BM25 = f"""dt as (select doc_id, {_WORDS} as w from documents), st as (select count(*) as n_docs, avg(len(w)) as avg_len from dt),
  q as (select query_id, term, count(*) as qtf from (select item_id as query_id, unnest({_WORDS}) as term from heldout_items) group by 1, 2),
  po as (select term, doc_id, len, count(*) as tf from (select doc_id, len(w) as len, unnest(w) as term from dt) where term in (select term from q) group by 1, 2, 3),
  dfs as (select term, count(*) as df from po group by 1),
  sc as (select q.query_id, po.doc_id, round(sum(ln(1 + (st.n_docs - dfs.df + 0.5) / (dfs.df + 0.5)) * po.tf / (po.tf + 1.2 * (1 - 0.75 + 0.75 * po.len / st.avg_len)) * q.qtf), 6) as score
    from q join po on po.term = q.term join dfs on dfs.term = q.term cross join st group by 1, 2),
  bm as (select * from (select *, row_number() over (partition by query_id order by score desc, doc_id) as rk from sc) where rk <= 100)"""
_A = "list_distinct(regexp_extract_all(lower(coalesce({}.text, '')), '[\\p{{L}}\\p{{N}}]+'))"

QUERIES = {
    "knn_topk_ip": (knn_topk_ip, f"with {_KNN_IP} select query, passage, round(s, 6) as score, cast(rank as int) as rank from r where rank <= 10"),
    "knn_recall": (knn_recall, f"with {_KNN_IP} select count(*) as wanted, 1 as recall_of_09 from r where rank <= 10"),
    "knn_topk_l2": (knn_topk_l2, f"with {_KNN_L2} select query, passage, round(s, 6) as score, cast(rank as int) as rank from r where rank <= 10"),
    "consistency_score": (consistency_score, f"with {sql.SCORED} select query_id, passage_id, lang, dataset, retrieval_rank, virtual_rank, consistency, count(*) as n from scored group by all"),
    "consistency_filter": (consistency_filter, f"with {sql.SCORED} select query_id, passage_id, lang, dataset, query, retrieval_rank, virtual_rank from scored where {sql.BY_R} or (not {sql.BY_R} and {sql.BY_V})"),
    "filter_stats_rollup": (filter_stats_rollup, f"""with {sql.SCORED} select dataset, cast(grouping(dataset) as int) as is_total, count(*) as n, count(*) filter (not consistency) as inconsistent, count(*) filter (retrieval_rank <> -1) as found, count(*) filter {sql.BY_R} as kept_by_retrieval,
      count(*) filter (virtual_rank = -1) as without_virtual, count(*) filter (not {sql.BY_R} and {sql.BY_V}) as kept_by_virtual, round(100.0 * count(*) filter ({sql.BY_R} or {sql.BY_V}) / count(*), 6) as kept_percent from scored group by rollup (dataset)"""),
    "consistency_by_dataset": (consistency_by_dataset, f"with {sql.SCORED} select dataset, count(*) as n, count(*) filter (consistency) as consistent, round(avg(cast(consistency as int)), 9) as ratio from scored group by 1"),
    "positive_reference_score": (positive_reference_score, f"with {sql.MINED} select query, round(avg_pos_score, 6) as avg_pos_score from ref"),
    "hard_negative_mine": (hard_negative_mine, f"with {sql.MINED} select dataset, query, passage, round(score, 6) as score, round(avg_pos_score, 6) as avg_pos_score, rank, n from mined"),
    "hard_negative_nested": (hard_negative_nested, f"with {sql.MINED}, p as (select query, string_agg(passage, ',' order by passage) as positive_ids from (select distinct query, passage from pos) group by 1) select m.query, any_value(p.positive_ids) as positive_ids, string_agg(m.passage, ',' order by m.n) as negative_ids, cast(count(*) as int) as n from mined m join p on p.query = m.query group by 1"),
    "merged_negatives": (merged_negatives, f"""with {sql.MINED}, pl as (select * from (select n.query, n.passage, n.score, cast(n.rk - 1 as int) as rank, row_number() over (partition by n.query order by n.score desc, n.passage desc) as k from near n where n.rk <= (select s.depth from size s where s.dataset = n.dataset) and not exists (select 1 from pos p where p.query = n.query and p.passage = n.passage)) where k <= 8),
      u as (select query, passage, max(score) as score, max(rank) as rank from (select query, passage, score, rank from mined union all select query, passage, score, rank from pl) group by 1, 2)
      select query, passage, round(score, 6) as score, rank, cast(row_number() over (partition by query order by u.score desc, passage desc) as int) as n from u"""),
    "rank_metrics": (rank_metrics, f"with {_EVAL} select * from per"),
    "rank_metrics_by_group": (rank_metrics_by_group, f"with {_GROUPED} select dataset, queries, {_MEANS_BY} from g"),
    "macro_metrics": (macro_metrics, f"with {_GROUPED} select count(*) as datasets, {_MEANS} from g"),
    "bm25_topk": (bm25_topk, f"with {_BM25} select query_id, doc_id, score, cast(rk as int) as rk from bm"),
    "run_truncate": (run_truncate, f"with {_BM25} select query_id, doc_id, score, cast(rk as int) as rk from bm where rk <= 5"),
    "run_validate": (run_validate, f"with {_BM25}, c as (select h.item_id as query_id, count(bm.doc_id) as n from (select distinct item_id from heldout_items) h left join bm on bm.query_id = h.item_id group by 1) select query_id, n, case when n = 0 then 'missing' else 'oversize' end as problem from c where n = 0 or n > 10"),
    "rerank_apply": (rerank_apply, f"""with {_BM25}, s as (select bm.query_id, bm.doc_id, {_A.format('h')} as a, {_A.format('d')} as b from bm join heldout_items h on h.item_id = bm.query_id join documents d on d.doc_id = bm.doc_id),
      x as (select query_id, doc_id, round(case when len(a) = 0 or len(b) = 0 then 0.0::double else len(list_intersect(a, b))::double / len(list_distinct(list_concat(a, b))) end, 9) as score from s),
      y as (select *, cast(row_number() over (partition by query_id order by score desc, doc_id) as int) as rk from x) select * from y where rk <= 5"""),
}
