"""Queries over compiled rows, buckets, batches and evaluation samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys
from ..operators import batches, buckets, coverage, quality, training_rows
from ..session import Scratch
from . import retrieval_queries, sql


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _pairs(spark, d):
    """The pairs with their language in lower case; null is the empty language."""
    return _t(spark, d, "pairs").withColumn("lang", F.lower(F.trim(keys.normalize("lang"))))


def _pair_keys(spark, d):
    return _pairs(spark, d).select("dataset", "query_id", "passage_id", "lang").distinct()


_PK = "pk as (select distinct dataset, query_id, passage_id, lower(trim(coalesce(lang, ''))) as lang from pairs)"


def lang_permutations(spark, d):
    return training_rows.permutations(_pair_keys(spark, d))


#: Negatives of a compiled row.
NEGATIVES = 8


def _compiled(spark, d, n=NEGATIVES):
    """Rows compiled from the pairs and, as mined lists, what mining over the store found."""
    tmp = Scratch(spark, "compile")
    mined = retrieval_queries._mining(spark, d)[0]
    q = F.regexp_extract("query", "^(.*)_([^_]*)$", 1)
    lists = mined.select("dataset", q.alias("query_id"), F.regexp_extract("query", "^(.*)_([^_]*)$", 2).alias("query_lang"), F.regexp_extract("passage", "^(.*)_([^_]*)$", 1).alias("passage_id"), F.regexp_extract("passage", "^(.*)_([^_]*)$", 2).alias("lang"), F.col("n").alias("place"))
    rows, fate = training_rows.recipes(tmp.cut(_pair_keys(spark, d)), tmp.cut(lists), n)
    return tmp.cut(rows), tmp.cut(fate)


def compile_recipes(spark, d):
    r = _compiled(spark, d)[0]
    return r.select("dataset", "query_id", "query_lang", "passage_lang", "positive_id", F.array_join(F.transform("negatives", lambda x: F.concat(x["passage"], F.lit("_"), x["lang"])), ",").alias("negatives"))


def _with_texts(spark, d):
    rows, _ = _compiled(spark, d)
    p = _pairs(spark, d)
    qt = coverage.last_row(p, ["dataset", "query_id", "lang"], "query", F.col("loaded_at")).withColumnRenamed("query", "text")
    pt = coverage.last_row(p, ["dataset", "passage_id", "lang"], "passage", F.col("loaded_at")).withColumnRenamed("passage", "text")
    return training_rows.with_texts(rows, qt, pt, NEGATIVES)


def compile_training_rows(spark, d):
    return _with_texts(spark, d).drop("truncated")


def compile_row_stats(spark, d):
    return training_rows.row_stats(_with_texts(spark, d))


def compile_drop_stats(spark, d):
    return training_rows.drop_stats(_compiled(spark, d)[1])


_LISTS = f"""ml as (select dataset, regexp_extract(query, '^(.*)_([^_]*)$', 1) as query_id, regexp_extract(query, '^(.*)_([^_]*)$', 2) as query_lang, regexp_extract(passage, '^(.*)_([^_]*)$', 1) as passage_id, regexp_extract(passage, '^(.*)_([^_]*)$', 2) as lang, n as place from mined),
  li as (select m.* from ml m where not exists (select 1 from pk where pk.dataset = m.dataset and pk.query_id = m.query_id and pk.passage_id = m.passage_id)),
  kn as (select distinct dataset, passage_id, lang from pk),
  us as (select l.dataset, l.query_id, l.query_lang, count(distinct (l.passage_id, l.lang)) as usable from li l join kn on kn.dataset = l.dataset and kn.passage_id = l.passage_id and kn.lang = l.lang group by all),
  fi as (select dataset, query_id, query_lang, passage_id, min(place) filter (lang = query_lang) as own, arg_min(lang, place) as fl, min(place) as fp from li group by all),
  pi as (select * from (select dataset, query_id, query_lang, passage_id, case when own is not null then query_lang else fl end as lang, row_number() over (partition by dataset, query_id, query_lang order by own is null, coalesce(own, fp), passage_id) as pick from fi) where pick <= {NEGATIVES}),
  ch as (select p.dataset, p.query_id, p.query_lang, count(*) as picked, string_agg(p.passage_id || '_' || p.lang, ',' order by pick) as negatives, list(p.passage_id order by pick) as ns, list(p.lang order by pick) as ls
    from pi p join kn on kn.dataset = p.dataset and kn.passage_id = p.passage_id and kn.lang = p.lang group by all),
  qs as (select distinct dataset, query_id, lang as query_lang from pk),
  fate as (select q.dataset, q.query_id, q.query_lang, case when coalesce(us.usable, 0) < {NEGATIVES} then 'insufficient' when coalesce(ch.picked, 0) < {NEGATIVES} then 'incomplete' else 'written' end as outcome
    from qs q left join us on us.dataset = q.dataset and us.query_id = q.query_id and us.query_lang = q.query_lang left join ch on ch.dataset = q.dataset and ch.query_id = q.query_id and ch.query_lang = q.query_lang),
  rc as (select f.dataset, f.query_id, f.query_lang, pk.lang as passage_lang, pk.passage_id as positive_id, ch.* exclude (dataset, query_id, query_lang)
    from fate f join pk on pk.dataset = f.dataset and pk.query_id = f.query_id join ch on ch.dataset = f.dataset and ch.query_id = f.query_id and ch.query_lang = f.query_lang where f.outcome = 'written')"""
_COMPILED = f"{sql.MINED}, {_PK}, {_LISTS}"
_LAST = """lt_{0} as (select dataset, id, lang, text from (select coalesce(dataset, '') as dataset, coalesce({0}_id, '') as id, lower(trim(coalesce(lang, ''))) as lang, coalesce({0}, '') as text, row_number() over (partition by coalesce(dataset, ''), coalesce({0}_id, ''), lower(trim(coalesce(lang, ''))) order by loaded_at desc nulls last, coalesce({0}, '') desc) as rn from pairs) where rn = 1)"""
_NEGATIVE_COLUMNS = ", ".join(f"t{i}.text as negative{i}" for i in range(1, NEGATIVES + 1))
_NEGATIVE_TEXTS = " ".join(f"join lt_passage t{i} on t{i}.dataset = rc.dataset and t{i}.id = rc.ns[{i}] and t{i}.lang = rc.ls[{i}]" for i in range(1, NEGATIVES + 1))


def _bucketed(spark, d, algorithm="md5"):
    row = F.md5(F.concat_ws("\x1f", *(keys.normalize(c) for c in ("query", "passage", "passage_id", "lang"))))
    p = _t(spark, d, "pairs").select("query_id", "dataset", F.col("query"), F.col("passage").alias("positive"), "lang", row.alias("row"))
    return buckets.add_bucket(p, 64, row_key="row", algorithm=algorithm).drop("row")


def hash_buckets(spark, d):
    return _bucketed(spark, d).groupBy("query_id", "query_key64", "bucket_id").agg(F.count("*").alias("n"), F.count_distinct("positive_key64").alias("positives"), F.max("positive_key64").alias("last_positive"))


def hash_buckets_blake2b(spark, d):
    return _bucketed(spark, d, "blake2b").groupBy("query_id", "query_key64", "bucket_id").agg(F.count("*").alias("n"))


def bucket_manifest(spark, d):
    return buckets.manifest(_bucketed(spark, d))


def bucket_totals(spark, d):
    p = _t(spark, d, "reranking_samples").select(F.lower(F.trim("split")).alias("split"), "dataset", F.col("query").alias("query_id"), "sample_id")
    return buckets.split_totals(buckets.manifest(buckets.add_bucket(p, 16, row_key="sample_id"), split="split"), "split")


def max_length_hint(spark, d):
    return buckets.max_length_hint(_t(spark, d, "pairs"), ["query", "passage"])


def balance_simulation(spark, d):
    return buckets.simulate_balance(buckets.manifest(_bucketed(spark, d)), [2, 8, 12])


def rank_modulo(spark, d):
    return buckets.rank_modulo(buckets.manifest(_bucketed(spark, d)), 8).groupBy("dataset", "rank").agg(F.sum("n_rows").alias("n_rows"), F.count("*").alias("buckets"))


def rank_greedy_lpt(spark, d):
    return buckets.rank_greedy(buckets.manifest(_bucketed(spark, d)), 8)


def _rows(spark, d):
    """Rows to batch: one for each distinct non-blank positive of a sample, with its query as the anchor; the id is of sample
    and positive. A sample without a positive is one row with the empty one."""
    r = _t(spark, d, "reranking_samples").where("query is not null").select("dataset", "sample_id", "query", F.explode_outer("positive").alias("x"))
    r = r.withColumn("positive", keys.strip(keys.normalize("x")))
    g = r.groupBy("dataset", "sample_id").agg(F.min("query").alias("anchor"), F.collect_set(F.when(F.col("positive") != "", F.col("positive"))).alias("ps"))
    g = g.select("dataset", "sample_id", "anchor", F.explode_outer("ps").alias("p")).withColumn("positive", F.coalesce("p", F.lit("")))
    return g.select("dataset", F.concat(F.col("sample_id").cast("string"), F.lit("|"), F.md5("positive")).alias("row"), "anchor", "positive")


_RS = f"""an as (select dataset, sample_id, min(query) as anchor from reranking_samples where query is not null group by 1, 2),
  ps as (select distinct dataset, sample_id, {sql.strip('x')} as t from (select dataset, sample_id, unnest(positive) as x from reranking_samples where query is not null) where {sql.strip("coalesce(x, '')")} <> ''),
  rs as (select an.dataset, cast(an.sample_id as varchar) || '|' || md5(coalesce(ps.t, '')) as row, an.anchor, coalesce(ps.t, '') as positive from an left join ps on ps.dataset is not distinct from an.dataset and ps.sample_id is not distinct from an.sample_id)"""


def batch_plain(spark, d):
    return batches.plain_batches(_rows(spark, d), "row", 16).select("dataset", "row", "batch")


def batch_no_dup(spark, d):
    return batches.no_duplicate_batches(_rows(spark, d), 16)


def _rank_counts(spark, d):
    r = _rows(spark, d).withColumn("rank", F.pmod(keys.hash60("anchor"), F.lit(4)))
    return batches.batch_counts(r, 16, ["dataset", "rank"])


def batch_count_sync(spark, d):
    return batches.synchronised_counts(_rank_counts(spark, d))


def batch_schedule(spark, d):
    return batches.schedule(batches.batch_counts(_rows(spark, d), 16, ["dataset"]))


def in_batch_negatives(spark, d):
    return batches.in_batch_negatives(batches.plain_batches(_rows(spark, d), "row", 16), 2)


_BATCHED = f"{_RS}, pb as (select dataset, row, anchor, positive, cast(floor((row_number() over (partition by dataset order by {sql.hash60(chr(39) + '42|' + chr(39) + ' || row')}) - 1) / 16) as bigint) as batch from rs)"


def eval_samples(spark, d):
    s = quality.eval_samples(_t(spark, d, "reranking_samples"))
    join = lambda c: F.md5(F.array_join(c, "\x1f"))
    return s.select("dataset", "query", "lang", F.size("positive").alias("n_positive"), join("positive").alias("positives"), F.size("negative").alias("n_negative"), join("negative").alias("negatives"))


def invalid_eval_samples(spark, d):
    return quality.invalid_samples(_t(spark, d, "reranking_samples"))


def analyze_quality(spark, d):
    return quality.sample_faults(_t(spark, d, "reranking_samples"), "positive", "negative")


def analyze_empty(spark, d):
    return quality.empty_texts(_t(spark, d, "reranking_samples"), "query", ["positive", "negative"])


def analyze_datasets(spark, d):
    return quality.dataset_counts(_t(spark, d, "reranking_samples"))


def jaccard_suspicious(spark, d):
    s = quality.suspicious_samples(_t(spark, d, "reranking_samples").select("sample_id", "query", "positive", "negative").distinct(), "query", "positive", "negative")
    return s.select("sample_id", "score", "worst_negative", "positive_jaccard", "query_jaccard").distinct().orderBy(F.desc("score"), "worst_negative", F.desc("positive_jaccard"), F.desc("query_jaccard"), "sample_id").limit(20)


def benchmark_overlap(spark, d):
    return quality.benchmark_overlap(_t(spark, d, "heldout_items"), _t(spark, d, "documents"))


def stream_filter_bucket(spark, d):
    """The scored pairs through a stream of Parquet files: filtered, bucketed, read back."""
    from ..streaming.incremental import stream_buckets

    tmp = Scratch(spark, "stream")
    scored = tmp.cut(retrieval_queries._scored(spark, d))
    q = stream_buckets(spark, scored._millrace_path, scored.schema, f"{tmp.root}/out", f"{tmp.root}/state", 30, 64)
    q.awaitTermination()
    out = spark.read.option("basePath", f"{tmp.root}/out").parquet(f"{tmp.root}/out").drop("epoch")
    return out.select("query_id", "passage_id", "lang", "dataset", "query_key64", "bucket_id")


_ROW = "md5(" + " || chr(31) || ".join(f"coalesce({c}, '')" for c in ("query", "passage", "passage_id", "lang")) + ")"
_ID = f"case when {sql.strip("coalesce(query_id, '')")} <> '' then {sql.strip('query_id')} else '__missing_query_id__:' || {_ROW} end"
_B = f"select query_id, dataset, passage, {sql.hash60(_ID)} as query_key64, cast({sql.hash60(_ID)} % 64 as int) as bucket_id, case when {sql.strip('passage')} is null or {sql.strip('passage')} = '' then {sql.hash60(chr(39) + '__empty_positive__' + chr(39))} else {sql.hash60(sql.strip('passage'))} end as positive_key64 from pairs"
_MAN = "select dataset, bucket_id, count(*) as n_rows, count(distinct query_id) as unique_query_ids from b group by 1, 2"
def _texts(column: str) -> str:
    return f"list_filter(list_transform(coalesce({column}, []), lambda x: {sql.clean('x')}), lambda x: x <> '')"


def _empty(column: str) -> str:
    blank = f"len(list_filter(coalesce({column}, []), lambda x: {sql.clean('x')} = ''))"
    return f"count(*) filter (len(coalesce({column}, [])) = {blank}) as without_{column}, cast(sum({blank}) as bigint) as empty_{column}"


_GRAM = "list_transform(range(1, len(w) - {0} + 2), lambda i: array_to_string(w[i:i + {0} - 1], ' '))"
_E_TEXT = "(select distinct coalesce(dataset, '') as dataset, {q} as query, {t} as t from (select dataset, query, unnest({c}) as x from reranking_samples) where {q} <> '' and {t} <> '')"
_Q, _X = sql.strip("coalesce(query, '')"), sql.strip("coalesce(x, '')")

QUERIES = {
    "lang_permutations": (lang_permutations, f"with {_PK}, l as (select distinct dataset, lang from pk) select a.dataset, a.lang as query_lang, b.lang as passage_lang from l a join l b on a.dataset = b.dataset"),
    "compile_recipes": (compile_recipes, f"with {_COMPILED} select dataset, query_id, query_lang, passage_lang, positive_id, negatives from rc"),
    "compile_training_rows": (compile_training_rows, f"""with {_COMPILED}, {_LAST.format('query')}, {_LAST.format('passage')}
      select rc.query_id, rc.dataset, rc.query_lang, rc.passage_lang, q.text as query, p.text as positive, {_NEGATIVE_COLUMNS} from rc
      join lt_query q on q.dataset = rc.dataset and q.id = rc.query_id and q.lang = rc.query_lang join lt_passage p on p.dataset = rc.dataset and p.id = rc.positive_id and p.lang = rc.passage_lang
      {_NEGATIVE_TEXTS}"""),
    "compile_row_stats": (compile_row_stats, f"""with {_COMPILED}, {_LAST.format('query')}, {_LAST.format('passage')}
      select rc.dataset, count(*) as n_rows, cast(sum({' + '.join(f"cast(length({x}.text) > 32768 as int)" for x in ["q", "p", *(f"t{i}" for i in range(1, NEGATIVES + 1))])}) as bigint) as truncated from rc
      join lt_query q on q.dataset = rc.dataset and q.id = rc.query_id and q.lang = rc.query_lang join lt_passage p on p.dataset = rc.dataset and p.id = rc.positive_id and p.lang = rc.passage_lang
      {_NEGATIVE_TEXTS} group by 1"""),
    "compile_drop_stats": (compile_drop_stats, f"with {_COMPILED} select dataset, count(*) as queries, count(*) filter (outcome = 'written') as written, count(*) filter (outcome = 'insufficient') as insufficient, count(*) filter (outcome = 'incomplete') as incomplete from fate group by 1"),
    "hash_buckets": (hash_buckets, f"with b as ({_B}) select query_id, query_key64, bucket_id, count(*) as n, count(distinct positive_key64) as positives, max(positive_key64) as last_positive from b group by 1, 2, 3"),
    "hash_buckets_blake2b": (hash_buckets_blake2b, None),
    "bucket_manifest": (bucket_manifest, f"with b as ({_B}) {_MAN}"),
    "bucket_totals": (bucket_totals, f"with b as (select lower(trim(split)) as split, dataset, case when {sql.strip('query')} is null or {sql.strip('query')} = '' then '__missing_query_id__:' || sample_id else {sql.strip('query')} end as k from reranking_samples) select split, count(*) as n_rows, count(distinct dataset) as datasets, count(distinct (dataset, {sql.hash60('k')} % 16)) as buckets from b group by 1"),
    "max_length_hint": (max_length_hint, "with g as (select dataset, max(greatest(length(coalesce(query, '')), length(coalesce(passage, '')))) as max_chars from pairs group by 1) select dataset, cast(max_chars as int) as max_chars, cast(least(512, greatest(128, ceil(max_chars / 4))) as int) as max_length from g"),
    "balance_simulation": (balance_simulation, f"""with b as ({_B}), m as ({_MAN}), w as (select unnest([2, 8, 12]) as world_size), rk as (select world_size, unnest(range(world_size)) as rank from w),
      pl as (select world_size, dataset, bucket_id % world_size as rank, n_rows from m cross join w), ld as (select rk.world_size, rk.rank, coalesce(sum(pl.n_rows), 0) as n_rows from rk left join pl on pl.world_size = rk.world_size and pl.rank = rk.rank group by 1, 2),
      em as (select world_size, count(*) filter (r < world_size) as empty from (select world_size, dataset, count(distinct rank) as r from pl group by 1, 2) group by 1)
      select cast(ld.world_size as int) as world_size, cast(max(n_rows) as bigint) as max_rows, avg(n_rows) as mean_rows, round(max(n_rows) / avg(n_rows), 9) as imbalance, any_value(em.empty) as empty from ld join em on em.world_size = ld.world_size group by 1"""),
    "rank_modulo": (rank_modulo, f"with b as ({_B}), m as ({_MAN}) select dataset, bucket_id % 8 as rank, cast(sum(n_rows) as bigint) as n_rows, count(*) as buckets from m group by 1, 2"),
    "rank_greedy_lpt": (rank_greedy_lpt, f"""with recursive b as ({_B}), m as ({_MAN}), o as (select dataset, bucket_id, n_rows, row_number() over (partition by dataset order by n_rows desc, bucket_id) as i from m),
      r as (select dataset, 0::bigint as i, 0 as bucket_id, 0::bigint as n_rows, 0::bigint as rank, [0, 0, 0, 0, 0, 0, 0, 0]::bigint[] as loads from (select distinct dataset from m)
        union all select o.dataset, o.i, o.bucket_id, o.n_rows, list_position(r.loads, list_min(r.loads)) - 1, list_transform(r.loads, lambda x, j: case when j = list_position(r.loads, list_min(r.loads)) then x + o.n_rows else x end) from r join o on o.dataset = r.dataset and o.i = r.i + 1)
      select dataset, bucket_id, n_rows, cast(rank as int) as rank from r where i > 0"""),
    "batch_plain": (batch_plain, f"with {_BATCHED} select dataset, row, batch from pb"),
    "batch_no_dup": (batch_no_dup, None),
    "batch_count_sync": (batch_count_sync, f"with {_RS}, c as (select dataset, {sql.hash60('anchor')} % 4 as rank, cast(ceil(count(*) / 16) as bigint) as batches from rs group by 1, 2), g as (select dataset, min(batches) as batches, round(avg(batches), 9) as mean from c group by 1) select *, case when batches = 0 then 'empty' when batches < mean / 2 then 'unbalanced' else 'ok' end as outcome from g"),
    "batch_schedule": (batch_schedule, f"with {_RS}, c as (select dataset, cast(ceil(count(*) / 16) as bigint) as batches from rs group by 1), s as (select dataset, unnest(range(batches)) as i from c), o as (select dataset, row_number() over (order by {sql.hash60(chr(39) + '42|' + chr(39) + ' || dataset || ' + chr(39) + '|' + chr(39) + ' || i')}) - 1 as step from s) select step, dataset, row_number() over (partition by dataset order by step) - 1 as batch from o"),
    "in_batch_negatives": (in_batch_negatives, f"with {_BATCHED} select * from (select a.dataset, a.batch, a.row, b.row as negative_row, cast(row_number() over (partition by a.dataset, a.batch, a.row order by {sql.hash60(chr(39) + '42|' + chr(39) + ' || a.row || ' + chr(39) + '|' + chr(39) + ' || b.row')}, b.row) as int) as n from pb a join pb b on a.dataset = b.dataset and a.batch = b.batch and a.row <> b.row and a.anchor <> b.anchor and a.positive <> b.positive) where n <= 2"),
    "eval_samples": (eval_samples, f"""with po as {_E_TEXT.format(q=_Q, t=_X, c='positive')}, ne as {_E_TEXT.format(q=_Q, t=_X, c='negative')},
      nn as (select * from ne where not exists (select 1 from po where po.dataset = ne.dataset and po.t = ne.t)),
      la as (select coalesce(dataset, '') as dataset, {_Q} as query, min(nullif({sql.strip("coalesce(lang, '')")}, '')) as lang from reranking_samples group by 1, 2),
      p as (select dataset, query, cast(count(*) as int) as n, md5(string_agg(t, chr(31) order by t)) as h from po group by 1, 2), n as (select dataset, query, cast(count(*) as int) as n, md5(string_agg(t, chr(31) order by t)) as h from nn group by 1, 2)
      select p.dataset, p.query, la.lang, p.n as n_positive, p.h as positives, coalesce(n.n, 0) as n_negative, coalesce(n.h, md5('')) as negatives from p left join n on n.dataset = p.dataset and n.query = p.query join la on la.dataset = p.dataset and la.query = p.query"""),
    "invalid_eval_samples": (invalid_eval_samples, f"with s as (select {_Q} = '' as q, coalesce(len(list_filter(positive, lambda x: {_X} <> '')), 0) = 0 as p from reranking_samples) select count(*) as samples, count(*) filter (q) as without_query, count(*) filter (not q and p) as without_positive from s"),
    "analyze_quality": (analyze_quality, f"with n as (select {_texts('positive')} as p, {_texts('negative')} as ns from reranking_samples) select count(*) as n_rows, count(*) filter (len(list_distinct(ns)) < len(ns)) as duplicate_negatives, count(*) filter (len(list_intersect(p, ns)) > 0) as positive_is_negative from n"),
    "analyze_empty": (analyze_empty, f"select count(*) filter ({sql.clean('query')} = '') as empty_query, {_empty('positive')}, {_empty('negative')} from reranking_samples"),
    "analyze_datasets": (analyze_datasets, f"select {sql.clean('dataset')} as dataset, count(*) as n from reranking_samples group by 1 order by n desc, 1 limit 20"),
    "jaccard_suspicious": (jaccard_suspicious, f"""with k as (select distinct sample_id, query, positive, negative from reranking_samples),
      pp as (select row_number() over () as rid, * from (select sample_id, query, negative, unnest(case when coalesce(len(positive), 0) = 0 or len(list_filter(positive, lambda x: x is null)) > 0 then list_concat(list_distinct(coalesce(positive, [])), [null]) else list_distinct(positive) end) as p from k)),
      tk as (select rid, {sql.tokens('query')} as tq, {sql.tokens('p')} as tp, unnest(negative) as neg, generate_subscripts(negative, 1) as i from pp where len(negative) > 0),
      js as (select rid, i, round({sql.jaccard('tp', 'tn')}, 9) as pj, round({sql.jaccard('tq', 'tn')}, 9) as qj from (select *, {sql.tokens('neg')} as tn from tk where {sql.clean('neg')} <> '')),
      be as (select *, row_number() over (partition by rid order by greatest(pj, qj) desc, i) as rn from js)
      select distinct pp.sample_id, coalesce(greatest(be.pj, be.qj), -1.0) as score, cast(coalesce(be.i, 0) as int) as worst_negative, coalesce(be.pj, 0.0) as positive_jaccard, coalesce(be.qj, 0.0) as query_jaccard
      from pp left join be on be.rid = pp.rid and be.rn = 1 order by score desc, worst_negative, positive_jaccard desc, query_jaccard desc, sample_id limit 20"""),
    "benchmark_overlap": (benchmark_overlap, f"""with b as (select item_id, md5(regexp_replace(lower({sql.strip('text')}), '[\\s\\p{{Z}}]+', ' ', 'g')) as h from heldout_items where {sql.strip("coalesce(text, '')")} <> ''), c as (select md5(regexp_replace(lower({sql.strip('text')}), '[\\s\\p{{Z}}]+', ' ', 'g')) as h, count(doc_id) as documents from documents where {sql.strip("coalesce(text, '')")} <> '' group by 1),
      x as (select b.item_id, cast(sum(c.documents) as bigint) as documents from b join c on c.h = b.h group by 1),
      iw as (select distinct item_id, {retrieval_queries._WORDS} as w from heldout_items), ig as (select item_id, md5(array_to_string(w, ' ')) as o, least(len(w), 12) as n, unnest(list_distinct({_GRAM.format('least(len(w), 12)')})) as g from iw where len(w) > 0),
      al as (select item_id, o, count(*) as k from ig group by 1, 2), sz as (select distinct n from ig), dw as (select doc_id, {retrieval_queries._WORDS} as w from documents),
      dg as (select distinct doc_id, n, unnest({_GRAM.format('n')}) as g from dw, sz where len(w) >= n),
      sh as (select ig.item_id, ig.o, dg.doc_id, count(distinct ig.g) as k from ig join dg on dg.n = ig.n and dg.g = ig.g group by 1, 2, 3),
      ne as (select sh.item_id, count(distinct sh.doc_id) as near_documents, round(max(sh.k / al.k), 9) as containment from sh join al on al.item_id = sh.item_id and al.o = sh.o group by 1)
      select i.item_id, coalesce(x.documents, 0) as documents, coalesce(ne.near_documents, 0) as near_documents, coalesce(ne.containment, 0.0) as containment, case when x.documents > 0 or ne.containment is not null then 'exclude' else 'keep' end as verdict
      from (select distinct item_id from heldout_items) i left join x on x.item_id = i.item_id left join ne on ne.item_id = i.item_id"""),
    "stream_filter_bucket": (stream_filter_bucket, f"with {sql.SCORED} select query_id, passage_id, lang, dataset, {sql.hash60(sql.strip('query_id'))} as query_key64, cast({sql.hash60(sql.strip('query_id'))} % 64 as int) as bucket_id from scored where {sql.BY_R} or (not {sql.BY_R} and {sql.BY_V})"),
}
