"""Round trips through sinks and sources, manifests, row counts between stages, and evaluation by language."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys, text
from ..operators import batches, consistency, coverage, metrics, mining, store, training_rows
from ..schema import count_differences
from ..session import Scratch
from ..sources import sinks, sqlite, tables
from . import pairs_queries, retrieval_queries, sql, training_queries


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def io_run(spark, d):
    tmp = Scratch(spark, "io")
    sinks.write_run(retrieval_queries._bm25(spark, d), f"{tmp.root}/run")
    return tables.read_run(spark, f"{tmp.root}/run")


def io_buckets(spark, d):
    """Buckets written with their manifest; those of one rank of four read back, checked file by file."""
    tmp = Scratch(spark, "io")
    b = training_queries._bucketed(spark, d).withColumn("split", F.when(F.col("bucket_id") % 5 == 0, "validation").otherwise("train"))
    sinks.write_buckets(b, f"{tmp.root}/buckets")
    return tables.read_bucketed(spark, f"{tmp.root}/buckets/split=train", world_size=4, rank=1).groupBy("dataset", "bucket_id").agg(F.count("*").alias("n"), F.max("query_key64").alias("last_key"))


def io_shards(spark, d):
    """Assigned components written to a folder for each shard, three of them read back."""
    tmp = Scratch(spark, "io")
    a = _t(spark, d, "component_assignments").where("shard_id is not null")
    sinks.write_shards(a, f"{tmp.root}/shards", (a.agg(F.max("shard_id")).first()[0] or 0) + 1)
    return tables.read_shards(spark, f"{tmp.root}/shards", first=3).groupBy("shard_id").agg(F.count("*").alias("n"), F.max("root").alias("last_root"))


def io_splits(spark, d):
    tmp = Scratch(spark, "io")
    s = _t(spark, d, "reranking_samples").withColumn("split", F.lower(F.trim("split"))).withColumn("source_file", keys.safe_dataset_name("dataset"))
    sinks.write_splits(s, f"{tmp.root}/splits")
    return spark.read.parquet(f"{tmp.root}/splits").groupBy("split", "source_file").agg(F.count("*").alias("n"))


def io_pairs(spark, d):
    """Pairs written to a folder for each dataset and read back as one table of strings."""
    tmp = Scratch(spark, "io")
    sinks.write_by_dataset(_t(spark, d, "pairs"), f"{tmp.root}/pairs")
    p = tables.read_pairs(spark, f"{tmp.root}/pairs", recursive=True)
    return p.groupBy("dataset", "lang").agg(F.count("*").alias("n"), F.count_distinct("query_id").alias("ids"), F.max("passage").alias("last_passage"))


def io_mined(spark, d):
    tmp = Scratch(spark, "io")
    m, pos, _ = retrieval_queries._mining(spark, d)
    sinks.write_mined(mining.nested(m, pos).withColumnRenamed("query", "query_id"), f"{tmp.root}/mined.json")
    back = tables.read_mined(spark, tmp.root, "not_there", "mined")
    return back.select(F.col("query_id").alias("query"), F.array_join("positive_ids", ",").alias("positive_ids"), F.array_join(F.transform("hard_negatives", lambda h: h["passage_id"]), ",").alias("negative_ids"), F.size("hard_negatives").alias("n"))


def io_vectors(spark, d):
    """The query vectors of the first dataset, to SQLite and back."""
    tmp = Scratch(spark, "io")
    st = store.stored(_t(spark, d, "vector_store"), 128).where("kind = 'query'")
    name = st.agg(F.min("dataset")).first()[0]
    rows = st.where(F.col("dataset") == F.lit(name)).select("id", "lang", F.col("vector").alias("embedding"), F.lit(0).alias("source_shard"))
    path = f"{tmp.root.removeprefix('file://').removeprefix('file:')}/vectors.sqlite"
    sqlite.write_sqlite(rows, path)
    back = sqlite.read_sqlite(spark, path, name or "", "query")
    return back.select("dataset", "id", "lang", "dim", F.round(F.aggregate("embedding", F.lit(0.0), lambda m, v: m + v.cast("double")), 6).alias("total"))


def stage_counts(spark, d):
    """Rows of each dataset that scoring and filtering leave, where they aren't equally many."""
    scored = retrieval_queries._scored(spark, d)
    return count_differences(["dataset"], pairs=_t(spark, d, "pairs"), scored=scored, kept=consistency.rank_filter(scored, 30))


def manifest_shards(spark, d):
    a = _t(spark, d, "component_assignments").where("shard_id is not null").withColumn("dataset", F.lower(keys.strip("dataset")))
    return sinks.shard_manifest(a).withColumn("dataset_counts", F.to_json("dataset_counts"))


def manifest_filter(spark, d):
    scored = retrieval_queries._scored(spark, d)
    return sinks.filter_manifest(scored, consistency.rank_filter(scored, 30))


def manifest_vectors(spark, d):
    p = _t(spark, d, "pairs")
    texts = coverage.first_text(p, ["query_id", "lang", "dataset"], "query", F.col("loaded_at")).select("dataset", F.lit("query").alias("kind"), "mismatches")
    texts = texts.unionByName(coverage.first_text(p, ["passage_id", "lang", "dataset"], "passage", F.col("loaded_at")).select("dataset", F.lit("passage").alias("kind"), "mismatches"))
    return sinks.embedding_manifest(store.stored(_t(spark, d, "vector_store"), 128), texts)


def bucket_files(spark, d):
    """The manifest of written buckets: files numbered within their bucket, and all rows in them."""
    tmp = Scratch(spark, "io")
    m = sinks.write_buckets(training_queries._bucketed(spark, d).withColumn("split", F.lit("train")), f"{tmp.root}/buckets")
    g = m.groupBy("dataset", "bucket_id").agg(F.sum("n_rows").alias("n_rows"), (F.max("part") + 1 - F.count("path")).alias("parts_missing"))
    return g


def mined_lookup(spark, d):
    """Mined lists found by the id with its language or, where there is none, by the bare id."""
    m = retrieval_queries._mining(spark, d)[0]
    bare = F.regexp_replace("query", "_[^_]*$", "")
    m = m.select(F.when(F.col("query").endswith("_ru"), F.col("query")).otherwise(bare).alias("query"), "passage", "n")
    q = _t(spark, d, "pairs").select(keys.item_lang_key("query_id", "lang").alias("with_lang"), keys.normalize("query_id").alias("bare_id"))
    return training_rows.mined_lists(q, m, "with_lang", "bare_id").groupBy("with_lang", "bare_id").agg(F.count("*").alias("n"), F.max("passage").alias("last_passage"))


def training_texts(spark, d):
    """The columns that a loss needs; some passages of the tables are empty, so emptiness isn't an error here."""
    return training_rows.for_loss(training_queries.compile_training_rows(spark, d), 2, check=False)


def run_first(spark, d):
    return metrics.first_queries(retrieval_queries._bm25(spark, d), _t(spark, d, "heldout_items").select(F.col("item_id").alias("query_id")), 10)


def row_ordinal(spark, d):
    return keys.with_ordinal(_t(spark, d, "documents").select("doc_id", "added_at"), "added_at", "doc_id").select("doc_id", "ordinal")


def metrics_by_language(spark, d):
    """Each sample's positives ranked among its negatives by the words shared with the query, by language."""
    s = _t(spark, d, "reranking_samples").where("query is not null").groupBy("sample_id").agg(F.min(F.struct("query", "lang", "positive", "negative")).alias("s"))
    s = s.select(F.col("sample_id").alias("query_id"), "s.*").where("size(positive) > 0")
    score = lambda q, t: F.round(text.jaccard(text.tokens(q), text.tokens(t)), 9)
    run, qrels = metrics.sample_run(s, score)
    per = metrics.query_metrics(run, qrels, (1, 3, 5, 10), places=12).select("query_id", "ap", "mrr_10", "accuracy_1", "accuracy_3", "accuracy_5")
    return metrics.metrics_by_language(per.join(s.select("query_id", "lang"), "query_id"), places=6)


def batch_faults(spark, d):
    """Of the batches without duplicates: rows, and rows or batches that break the rules."""
    rows = training_queries._rows(spark, d)
    b = batches.no_duplicate_batches(rows, 16).join(rows.select("row", "anchor", "positive"), "row")
    per = b.groupBy("dataset", "chunk", "batch").agg(F.count("*").alias("n"), F.count_distinct("anchor").alias("a"), F.count_distinct("positive").alias("p"), F.count_distinct("row").alias("r"))
    return per.groupBy("dataset").agg(F.sum("r").alias("n_rows"), F.count_if(F.col("n") > 16).alias("too_large"), F.count_if(F.col("a") < F.col("n")).alias("anchor_twice"), F.count_if(F.col("p") < F.col("n")).alias("positive_twice"), F.count_if(F.col("r") < F.col("n")).alias("row_twice"))


def shard_totals(spark, d):
    """What the assignment to shards holds of each dataset, and how many components have more than one shard."""
    s = pairs_queries.shard_assignment(spark, d)
    per = s.groupBy("dataset", "component").agg(F.count_distinct("shard_id").alias("k"), F.sum("n_rows").alias("n_rows"))
    return per.groupBy("dataset").agg(F.count("*").alias("components"), F.sum("n_rows").alias("n_rows"), F.count_if(F.col("k") > 1).alias("torn"))


_BM = retrieval_queries._BM25
_B, _MAN = training_queries._B, training_queries._MAN
_SAMPLE_AP = """per as (select query_id, sum(case when rel = 1 then 1.0 * th / tn end) / sum(rel) as ap, coalesce(1.0 / min(case when rel = 1 and rk <= 10 then rk end), 0) as mrr_10,
      max(case when rel = 1 and rk <= 1 then 1 else 0 end) as accuracy_1, max(case when rel = 1 and rk <= 3 then 1 else 0 end) as accuracy_3, max(case when rel = 1 and rk <= 5 then 1 else 0 end) as accuracy_5 from ra group by 1)"""

QUERIES = {
    "io_run": (io_run, f"with {_BM} select cast(query_id as varchar) as query_id, cast(doc_id as varchar) as doc_id, score from bm"),
    "io_buckets": (io_buckets, f"with b as ({_B}) select dataset, bucket_id, count(*) as n, max(query_key64) as last_key from b where bucket_id % 5 <> 0 and bucket_id % 4 = 1 group by 1, 2"),
    "io_shards": (io_shards, "select shard_id, count(*) as n, max(root) as last_root from component_assignments where shard_id < 3 group by 1"),
    "io_splits": (io_splits, "select lower(trim(split)) as split, case when coalesce(dataset, '') = '' then 'unknown_dataset' else regexp_replace(dataset, '[^A-Za-z0-9_.-]+', '_', 'g') end as source_file, count(*) as n from reranking_samples group by 1, 2"),
    "io_pairs": (io_pairs, "select dataset, lang, count(*) as n, count(distinct query_id) as ids, max(passage) as last_passage from pairs group by 1, 2"),
    "io_mined": (io_mined, retrieval_queries.QUERIES["hard_negative_nested"][1]),
    "io_vectors": (io_vectors, f"with {sql.STORE} select dataset, id, lang, len(v) as dim, round(list_sum(v), 6) as total from st where kind = 'query' and dataset = (select min(dataset) from st where kind = 'query')"),
    "stage_counts": (stage_counts, f"""with {sql.SCORED}, p as (select coalesce(dataset, '') as dataset, count(*) as pairs from pairs group by 1), s as (select coalesce(dataset, '') as dataset, count(*) as scored, count(*) filter ({sql.BY_R} or {sql.BY_V}) as kept from scored group by 1)
      select p.dataset, p.pairs, s.scored, s.kept from p join s on s.dataset = p.dataset where greatest(pairs, scored, kept) <> least(pairs, scored, kept)"""),
    "manifest_shards": (manifest_shards, f"with g as (select shard_id, coalesce(lower({sql.strip('dataset')}), '') as ds, count(*) as n from component_assignments where shard_id is not null group by 1, 2) select shard_id, cast(sum(n) as bigint) as row_count, '{{' || string_agg('\"' || ds || '\":' || n, ',' order by ds) || '}}' as dataset_counts from g group by 1"),
    "manifest_filter": (manifest_filter, f"with {sql.SCORED} select coalesce(dataset, '') as dataset, count(*) as input_rows, count(*) filter ({sql.BY_R} or {sql.BY_V}) as output_rows from scored group by 1"),
    "manifest_vectors": (manifest_vectors, f"""with {sql.STORE}, f as (select 'query' as kind, coalesce(query_id, '') as k, coalesce(lang, '') as l, coalesce(dataset, '') as dataset, coalesce(query, '') as x, loaded_at from pairs union all select 'passage', coalesce(passage_id, ''), coalesce(lang, ''), coalesce(dataset, ''), coalesce(passage, ''), loaded_at from pairs),
      g as (select *, first_value(x) over (partition by kind, k, l, dataset order by loaded_at is null, loaded_at, x) as t from f), mi as (select kind, dataset, count(*) filter (x <> t) as text_mismatches from g group by 1, 2)
      select st.dataset, st.kind, count(*) as vectors, count(distinct (id, lang)) as keys, cast(max(len(v)) as int) as dim, coalesce(any_value(mi.text_mismatches), 0) as text_mismatches from st left join mi on mi.kind = st.kind and mi.dataset = st.dataset group by 1, 2"""),
    "bucket_files": (bucket_files, f"with b as ({_B}) select dataset, bucket_id, count(*) as n_rows, 0 as parts_missing from b group by 1, 2"),
    "mined_lookup": (mined_lookup, f"""with {sql.MINED}, ml as (select case when query like '%\\_ru' escape '\\' then query else regexp_replace(query, '_[^_]*$', '') end as query, passage from mined),
      q as (select distinct coalesce(query_id, '') || '_' || coalesce(lang, '') as with_lang, coalesce(query_id, '') as bare_id from pairs),
      k as (select q.*, case when exists (select 1 from ml where ml.query = q.with_lang) then with_lang else bare_id end as by_key from q)
      select with_lang, bare_id, count(*) as n, max(passage) as last_passage from k join ml on ml.query = k.by_key group by 1, 2"""),
    "training_texts": (training_texts, f"select {', '.join(f'{sql.strip(c)} as {c}' for c in ('query', 'positive', 'negative1', 'negative2'))} from ({training_queries.QUERIES['compile_training_rows'][1]})"),
    "run_first": (run_first, f"with {_BM} select query_id, doc_id, score, cast(rk as int) as rk from bm where query_id in (select distinct item_id from heldout_items order by 1 limit 10)"),
    "row_ordinal": (row_ordinal, "select doc_id, row_number() over (order by added_at nulls first, doc_id) - 1 as ordinal from documents"),
    "metrics_by_language": (metrics_by_language, f"""with s as (select * from (select sample_id as query_id, query, lang, positive, negative, row_number() over (partition by sample_id order by query, lang nulls first) as rn from reranking_samples where query is not null) where rn = 1 and len(positive) > 0),
      e as (select query_id, query, lang, unnest(positive) as t, 'p' || lpad(cast(generate_subscripts(positive, 1) - 1 as varchar), 6, '0') as doc_id, 1 as rel from s union all select query_id, query, lang, unnest(negative), 'n' || lpad(cast(generate_subscripts(negative, 1) - 1 as varchar), 6, '0'), 0 from s),
      sc as (select query_id, lang, doc_id, rel, round({sql.jaccard('a', 'b')}, 9) as score from (select *, {sql.tokens('query')} as a, {sql.tokens('t')} as b from e)),
      ra as (select *, row_number() over (partition by query_id order by score desc, doc_id) as rk, sum(rel) over (partition by query_id order by score desc range unbounded preceding) as th, count(*) over (partition by query_id order by score desc range unbounded preceding) as tn from sc),
      {_SAMPLE_AP}, la as (select lang, lang_key from ({pairs_queries.LANG_KEY})),
      al as (select per.*, la.lang_key from per join s on s.query_id = per.query_id left join la on la.lang is not distinct from s.lang)
      select lang_key, count(*) as queries, {', '.join(f'round(avg({c}), 6) as {c}' for c in ('ap', 'mrr_10', 'accuracy_1', 'accuracy_3', 'accuracy_5'))} from (select * from al where lang_key in ('ru', 'en', 'ru-en', 'en-ru') union all select * replace ('all' as lang_key) from al) group by 1"""),
    "batch_faults": (batch_faults, f"with {training_queries._RS} select dataset, count(*) as n_rows, 0 as too_large, 0 as anchor_twice, 0 as positive_twice, 0 as row_twice from rs group by 1"),
    "shard_totals": (shard_totals, f"with recursive {pairs_queries._SCOPED}, p as (select coalesce(dataset, '') as dataset, cc.component, count(*) as n from pairs join cc on cc.node = {pairs_queries._EDGE.format('q', 'query_id')} group by 1, 2) select dataset, count(*) as components, cast(sum(n) as bigint) as n_rows, 0 as torn from p group by 1"),
}
