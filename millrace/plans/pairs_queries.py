"""Queries over labelled pairs, their components and shards, and the vector store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys, text, vector
from ..operators import buckets, coverage, graph, metrics, quality, store
from .. import schema
from . import sql


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _pairs(spark, d):
    """Pairs with ``lang`` in lower case, blanks removed."""
    return _t(spark, d, "pairs").withColumn("lang", F.lower(F.trim("lang")))


_CLEAN = "pr as (select * replace (lower(trim(lang)) as lang) from pairs)"
_ROWS = ["dataset", "query_id", "passage_id", "lang"]


def lang_full_coverage(spark, d):
    return coverage.full_coverage(_pairs(spark, d), ["dataset"]).groupBy(*_ROWS).agg(F.count("*").alias("n"))


def lang_single_only(spark, d):
    return coverage.single_language(_pairs(spark, d), ["dataset"]).groupBy(*_ROWS).agg(F.count("*").alias("n"))


def pair_languages(spark, d):
    p = _pairs(spark, d)
    return p.groupBy("dataset", "query_id", "passage_id").agg(F.array_join(F.sort_array(F.collect_set("lang")), ",").alias("langs"), F.count("*").alias("n"))


def connected_components(spark, d):
    return graph.connected_components(spark, graph.bipartite_edges(_t(spark, d, "pairs")))


def scoped_components(spark, d):
    cc = graph.connected_components(spark, graph.scoped_edges(_t(spark, d, "pairs")))
    return cc.groupBy("component").agg(F.count("*").alias("nodes")).groupBy("nodes").agg(F.count("*").alias("components"))


def component_sizes(spark, d):
    rows = graph.pair_components(spark, _t(spark, d, "pairs").withColumn("dataset", keys.normalize("dataset")))
    return graph.component_sizes(rows, "dataset").withColumnRenamed("rows", "n_rows")


def component_split(spark, d):
    s = graph.split_components(spark, _t(spark, d, "pairs"), 0.05, 42)
    return s.groupBy(keys.normalize("query_id").alias("query_id"), keys.normalize("passage_id").alias("passage_id")).agg(F.max("split").alias("split"), F.count("*").alias("n"))


def no_split_check(spark, d):
    s = graph.split_components(spark, _t(spark, d, "pairs"), 0.05, 42)
    return graph.torn_ids(s, "split", ["query_id"]).agg(F.count("*").alias("torn")).unionAll(graph.torn_ids(s, "split", ["passage_id"]).agg(F.count("*").alias("torn")))


_SPLIT = f"""{sql.COMPONENTS}, sized as (select cc.component, count(*) as n from edges e join cc on cc.node = e.a group by 1),
  tot as (select sum(n) - cast(round_even(0.05 * sum(n), 0) as bigint) as train from sized),
  placed as (select component, case when coalesce(sum(n) over (order by md5('42|' || component) rows between unbounded preceding and 1 preceding), 0) < (select train from tot) then 'train' else 'validation' end as split from sized),
  split_rows as (select coalesce(p.query_id, '') as query_id, coalesce(p.passage_id, '') as passage_id, s.split from pairs p join cc on cc.node = 'q:' || coalesce(p.query_id, '') join placed s on s.component = cc.component)"""


def shard_assignment(spark, d):
    """Components of scoped ids into shards of about 1,000 rows."""
    p = _t(spark, d, "pairs").withColumn("dataset", keys.normalize("dataset"))
    edges = graph.scoped_edges(p)
    cc = graph.connected_components(spark, edges)
    name = F.concat_ws("\x1f", F.lit("q"), keys.normalize("query_id"), keys.normalize("lang"), "dataset")
    sizes = p.withColumn("node", name).join(cc, "node").groupBy("component", "dataset").agg(F.count("*").alias("rows"))
    return graph.assign_shards(spark, sizes, 1000).withColumnRenamed("rows", "n_rows")


def query_passage_positives(spark, d):
    p = coverage.positives(_t(spark, d, "pairs"))
    return p.groupBy("query_id", "lang", "dataset").agg(F.count("*").alias("n"), F.min("passage_id").alias("first_id"), F.max("passage_id").alias("last_id"))


def scoped_distinct_first(spark, d):
    return coverage.first_text(_t(spark, d, "pairs"), ["query_id", "lang", "dataset"], "query", F.col("loaded_at")).select("query_id", "lang", "dataset", "text")


def text_mismatches(spark, d):
    p = _t(spark, d, "pairs")
    q = coverage.first_text(p, ["query_id", "lang", "dataset"], "query", F.col("loaded_at")).select(F.lit("query").alias("kind"), "dataset", "n", "mismatches")
    r = coverage.first_text(p, ["passage_id", "lang", "dataset"], "passage", F.col("loaded_at")).select(F.lit("passage").alias("kind"), "dataset", "n", "mismatches")
    return q.unionByName(r).groupBy("kind", "dataset").agg(F.count("*").alias("n_keys"), F.sum("n").alias("n_rows"), F.sum("mismatches").alias("mismatches"))


def last_occurrence(spark, d):
    return coverage.last_row(_t(spark, d, "pairs"), ["passage_id", "lang"], "passage", F.col("loaded_at"))


def embedding_dedup(spark, d):
    return store.outcome_counts(store.resolve(_t(spark, d, "vector_store"), dim=128))


def embedding_conflicts(spark, d):
    r = store.resolve(_t(spark, d, "vector_store"), dim=128)
    gap = F.aggregate(F.zip_with("embedding", "first", lambda a, b: F.abs(a.cast("double") - b.cast("double"))), F.lit(0.0), lambda m, v: F.greatest(m, v))
    return r.where("outcome = 'conflict'").select(*store.KEY, "source_shard", "copies", F.round(gap, 6).alias("largest_gap"))


_RESOLVED = f"""base as (select coalesce(dataset, '') as dataset, coalesce(kind, '') as kind, coalesce(id, '') as id, coalesce(lang, '') as lang, coalesce(source_shard, 2147483647) as source_shard, embedding, count(*) as copies
    from vector_store where {sql.USABLE} group by all),
  firsts as (select *, first_value(embedding) over w as fe, first_value(source_shard) over w as fs from base window w as (partition by dataset, kind, id, lang order by source_shard, embedding)),
  res as (select *, case when source_shard = fs and embedding = fe then 'written'
    when len(list_filter(list_zip(embedding::double[], fe::double[]), lambda z: not (abs(z[1] - z[2]) <= 1e-8 + 1e-5 * abs(z[2])))) = 0 then 'duplicate' else 'conflict' end as outcome from firsts)"""


def missing_vectors(spark, d):
    """Scoped ids of the pairs without a usable vector, by kind and dataset."""
    p, st = _t(spark, d, "pairs"), store.stored(_t(spark, d, "vector_store"), 128)
    out = []
    for kind, col in (("query", "query_id"), ("passage", "passage_id")):
        ids = p.select(keys.normalize("dataset").alias("dataset"), keys.item_lang_key(col, "lang").alias("id")).distinct()
        have = st.where(F.col("kind") == kind).select("dataset", "id").distinct().withColumn("have", F.lit(1))
        out.append(ids.join(have, ["dataset", "id"], "left").groupBy("dataset").agg(F.count("*").alias("ids"), F.count_if(F.col("have").isNull()).alias("missing")).withColumn("kind", F.lit(kind)))
    return out[0].unionByName(out[1])


def dataset_shard_ratios(spark, d):
    """Rows of each dataset in each shard by the current assignments, and both shares."""
    a = _t(spark, d, "component_assignments").where("root is not null")
    now = a.groupBy("root").agg(F.max(F.struct("assigned_at", "row_count", "shard_id", F.lower(keys.strip("dataset")).alias("dataset"))).alias("r")).select("r.*")
    return buckets.dataset_ratios(now.where("shard_id is not null and row_count is not null"), "shard_id", "row_count")


def spherical_mean(spark, d):
    st = store.stored(_t(spark, d, "vector_store"), 128)
    m = vector.spherical_mean(st, ["dataset", "kind"], "vector")
    return m.select("dataset", "kind", F.round(vector.norm("mean"), 6).alias("length"), F.round(F.col("mean")[0], 6).alias("x0"), F.round(F.col("mean")[127], 6).alias("x127"))


def lang_key_normalise(spark, d):
    return _t(spark, d, "reranking_samples").groupBy("lang").agg(F.count("*").alias("n")).select("lang", keys.lang_key("lang").alias("lang_key"), "n")


def safe_dataset_name(spark, d):
    return _t(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n")).select("source", keys.safe_dataset_name("source").alias("file_name"), keys.default_dataset("source", "none").alias("dataset"), keys.safe_name("source").alias("model_name"), "n")


def compile_keys(spark, d):
    k = keys.compile_keys()
    return _t(spark, d, "pairs").select(*(c.alias(n) for n, c in k.items())).groupBy(*k).agg(F.count("*").alias("n"))


def truncate_text_stats(spark, d):
    t = F.col("text")
    cut_b, cut_c = text.truncate_bytes(t, 900), text.truncate_chars(t, 600)
    return _t(spark, d, "documents").groupBy("lang").agg(
        F.count("*").alias("n"), F.count_if(F.octet_length(t) > 900).alias("over_bytes"), F.sum(F.octet_length(cut_b)).alias("bytes_left"), F.count_if(F.char_length(t) > 600).alias("over_chars"),
        F.sum(F.char_length(cut_c)).alias("chars_left"), F.sum(F.char_length(text.truncate_words("text", 50))).alias("words_left"),
    )


def clean_texts(spark, d):
    return _t(spark, d, "documents").select("doc_id", text.short("text", 80).alias("short_text"), F.size(text.tokens("text")).alias("tokens"))


def prompts(spark, d):
    p = _t(spark, d, "pairs").select("query_id", "lang", "query", "passage").distinct()
    return p.select("query_id", F.md5(text.prompt("query: {q}\npassage: {p}", q="query", p="passage")).alias("prompt"), F.char_length(text.title_and_text("query", "passage")).alias("joined"))


def event_summary(spark, d):
    return metrics.gpu_summary(_t(spark, d, "events"), ["event_type"], "value")


def inspect_sample(spark, d):
    return quality.sample_rows(_t(spark, d, "documents").select("doc_id", "lang", "source"), "doc_id", 20)


def cast_strings(spark, d):
    p = schema.all_strings(_t(spark, d, "nodes"))
    return p.groupBy(F.coalesce("parent", F.lit("")).alias("parent")).agg(F.count("*").alias("n"), F.max("id").alias("last_id"))


_JOINED = "coalesce(query, '') || ' ' || coalesce(passage, '')"
_EDGE = "'{}' || chr(31) || coalesce({}, '') || chr(31) || coalesce(lang, '') || chr(31) || coalesce(dataset, '')"
_SCOPED = sql.COMPONENTS.replace("'q:' || coalesce(query_id, '')", _EDGE.format("q", "query_id")).replace("'p:' || coalesce(passage_id, '')", _EDGE.format("p", "passage_id"))

#: The language key of every spelling in the samples.
LANG_KEY = """with g as (select lang, count(*) as n from reranking_samples group by 1),
      k as (select lang, n, list_slice(list_filter(list_transform(string_split(regexp_replace(lower(coalesce(lang, '')), '[^a-zа-я]+', '-', 'g'), '-'), lambda x: case when x in ('ru', 'rus', 'russian', 'рус', 'русский') then 'ru' when x in ('en', 'eng', 'english', 'англ', 'английский') then 'en' end), lambda x: x is not null), 1, 2) as two from g)
      select lang, case when len(two) = 0 then null when len(two) = 2 and two[1] <> two[2] then two[1] || '-' || two[2] else two[1] end as lang_key, n from k"""

QUERIES = {
    "lang_full_coverage": (lang_full_coverage, f"""with {_CLEAN}, al as (select dataset, count(distinct lang) as a from pr group by 1),
      pl as (select dataset, query_id, passage_id, count(distinct lang) as n, bool_or(lang is null) as z from pr group by all)
      select p.dataset, p.query_id, p.passage_id, p.lang, count(*) as n from pr p join pl on pl.dataset is not distinct from p.dataset and pl.query_id is not distinct from p.query_id and pl.passage_id is not distinct from p.passage_id
      join al on al.dataset is not distinct from p.dataset where al.a = 0 or (pl.n = al.a and not pl.z) group by all"""),
    "lang_single_only": (lang_single_only, f"""with {_CLEAN}, pl as (select dataset, query_id, passage_id from pr group by all having count(distinct lang) = 1)
      select p.dataset, p.query_id, p.passage_id, p.lang, count(*) as n from pr p join pl on pl.dataset is not distinct from p.dataset and pl.query_id is not distinct from p.query_id and pl.passage_id is not distinct from p.passage_id group by all"""),
    "pair_languages": (pair_languages, f"with {_CLEAN} select dataset, query_id, passage_id, coalesce(array_to_string(list_sort(list_distinct(list(lang) filter (lang is not null))), ','), '') as langs, count(*) as n from pr group by dataset, query_id, passage_id"),
    "connected_components": (connected_components, f"with recursive {sql.COMPONENTS} select node, component from cc"),
    "scoped_components": (scoped_components, f"with recursive {_SCOPED} select nodes, count(*) as components from (select component, count(*) as nodes from cc group by 1) group by 1"),
    "component_sizes": (component_sizes, f"with recursive {sql.COMPONENTS} select cc.component, coalesce(p.dataset, '') as dataset, count(*) as n_rows, count(distinct (coalesce(p.query_id, ''), coalesce(p.passage_id, ''))) as pairs from pairs p join cc on cc.node = 'q:' || coalesce(p.query_id, '') group by all"),
    "component_split": (component_split, f"with recursive {_SPLIT} select query_id, passage_id, split, count(*) as n from split_rows group by all"),
    "no_split_check": (no_split_check, f"with recursive {_SPLIT} select count(*) as torn from (select query_id from split_rows group by 1 having count(distinct split) > 1) union all select count(*) from (select passage_id from split_rows group by 1 having count(distinct split) > 1)"),
    "shard_assignment": (shard_assignment, None),
    "query_passage_positives": (query_passage_positives, "select coalesce(query_id, '') as query_id, coalesce(lang, '') as lang, coalesce(dataset, '') as dataset, count(distinct coalesce(passage_id, '')) as n, min(coalesce(passage_id, '')) as first_id, max(coalesce(passage_id, '')) as last_id from pairs group by 1, 2, 3"),
    "scoped_distinct_first": (scoped_distinct_first, "select query_id, lang, dataset, text from (select coalesce(query_id, '') as query_id, coalesce(lang, '') as lang, coalesce(dataset, '') as dataset, coalesce(query, '') as text, row_number() over (partition by coalesce(query_id, ''), coalesce(lang, ''), coalesce(dataset, '') order by loaded_at is null, loaded_at, coalesce(query, '')) as rn from pairs) where rn = 1"),
    "text_mismatches": (text_mismatches, f"""with f as (select 'query' as kind, coalesce(query_id, '') as k, coalesce(lang, '') as l, coalesce(dataset, '') as dataset, coalesce(query, '') as x, loaded_at from pairs union all select 'passage', coalesce(passage_id, ''), coalesce(lang, ''), coalesce(dataset, ''), coalesce(passage, ''), loaded_at from pairs),
      g as (select *, first_value(x) over (partition by kind, k, l, dataset order by loaded_at is null, loaded_at, x) as t from f)
      select kind, dataset, count(distinct (k, l)) as n_keys, count(*) as n_rows, count(*) filter (x <> t) as mismatches from g group by 1, 2"""),
    "last_occurrence": (last_occurrence, "select passage_id, lang, passage from (select coalesce(passage_id, '') as passage_id, coalesce(lang, '') as lang, coalesce(passage, '') as passage, row_number() over (partition by coalesce(passage_id, ''), coalesce(lang, '') order by loaded_at desc nulls last, coalesce(passage, '') desc) as rn from pairs) where rn = 1"),
    "embedding_dedup": (embedding_dedup, f"with {_RESOLVED} select dataset, kind, count(*) filter (outcome = 'written') as written, cast(coalesce(sum(copies) filter (outcome <> 'conflict'), 0) - count(*) filter (outcome = 'written') as bigint) as duplicates, cast(coalesce(sum(copies) filter (outcome = 'conflict'), 0) as bigint) as conflicts from res group by 1, 2"),
    "embedding_conflicts": (embedding_conflicts, f"with {_RESOLVED} select dataset, kind, id, lang, source_shard, copies, round(list_max(list_transform(list_zip(embedding::double[], fe::double[]), lambda z: abs(z[1] - z[2]))), 6) as largest_gap from res where outcome = 'conflict'"),
    "missing_vectors": (missing_vectors, f"""with st as (select distinct coalesce(dataset, '') as dataset, kind, coalesce(id, '') as id from vector_store where {sql.USABLE}),
      i as (select distinct 'query' as kind, coalesce(dataset, '') as dataset, coalesce(query_id, '') || '_' || coalesce(lang, '') as id from pairs union all select distinct 'passage', coalesce(dataset, ''), coalesce(passage_id, '') || '_' || coalesce(lang, '') from pairs)
      select i.kind, i.dataset, count(*) as ids, count(*) filter (st.id is null) as missing from i left join st on st.kind = i.kind and st.dataset = i.dataset and st.id = i.id group by 1, 2"""),
    "dataset_shard_ratios": (dataset_shard_ratios, f"""with c as (select *, lower({sql.strip('dataset')}) as ds, row_number() over (partition by root order by assigned_at desc nulls last, row_count desc nulls last, shard_id desc nulls last, lower({sql.strip('dataset')}) desc nulls last) as rn from component_assignments where root is not null),
      g as (select shard_id, ds as dataset, cast(sum(row_count) as bigint) as n_rows from c where rn = 1 and shard_id is not null and row_count is not null group by 1, 2)
      select *, round(n_rows / sum(n_rows) over (partition by shard_id), 9) as in_shard, round(n_rows / sum(n_rows) over (partition by dataset), 9) as of_dataset from g"""),
    "spherical_mean": (spherical_mean, f"""with {sql.STORE}, u as (select dataset, kind, v, sqrt(list_dot_product(v, v)) as n from st), e as (select dataset, kind, n, unnest(v) as x, generate_subscripts(v, 1) as i from u),
      m as (select dataset, kind, i, avg(x / n) as x from e group by 1, 2, 3), l as (select dataset, kind, sqrt(sum(x * x)) as l from m group by 1, 2), a as (select dataset, kind, avg(n) as len from u group by 1, 2)
      select m.dataset, m.kind, round(any_value(a.len), 6) as length, round(max(case when i = 1 then x / l.l * a.len end), 6) as x0, round(max(case when i = 128 then x / l.l * a.len end), 6) as x127
      from m join l on l.dataset = m.dataset and l.kind = m.kind join a on a.dataset = m.dataset and a.kind = m.kind group by 1, 2"""),
    "lang_key_normalise": (lang_key_normalise, LANG_KEY),
    "safe_dataset_name": (safe_dataset_name, f"""with g as (select source, count(*) as n from documents group by 1)
      select source, case when coalesce(source, '') = '' then 'unknown_dataset' else regexp_replace(source, '[^A-Za-z0-9_.-]+', '_', 'g') end as file_name, case when coalesce({sql.strip('source')}, '') = '' then 'none' else {sql.strip('source')} end as dataset,
        regexp_replace(regexp_replace(coalesce(source, ''), '[^A-Za-z0-9_.-]+', '-', 'g'), '^-+|-+$', '', 'g') as model_name, n from g"""),
    "compile_keys": (compile_keys, "select coalesce(query_id, '') || '::' || coalesce(dataset, '') as qid_dataset, coalesce(query_id, '') || '::' || coalesce(dataset, '') || '_' || coalesce(lang, '') as qid_lang, coalesce(passage_id, '') || '_' || coalesce(lang, '') as pid_lang, count(*) as n from pairs group by 1, 2, 3"),
    "truncate_text_stats": (truncate_text_stats, f"""select lang, count(*) as n, count(*) filter (strlen(text) > 900) as over_bytes, cast(sum(strlen(case when strlen(text) > 900 then substr(text, 1, 900) else text end)) as bigint) as bytes_left,
      count(*) filter (length(text) > 600) as over_chars, cast(sum(length(substr(text, 1, 600))) as bigint) as chars_left,
      cast(sum(length(case when len(regexp_split_to_array({sql.strip('text')}, '[\\s\\p{{Z}}]+')) <= 50 then text else array_to_string(list_slice(regexp_split_to_array({sql.strip('text')}, '[\\s\\p{{Z}}]+'), 1, 50), ' ') end)) as bigint) as words_left from documents group by 1"""),
    "clean_texts": (clean_texts, f"select doc_id, substr({sql.clean('text')}, 1, 80) || case when length({sql.clean('text')}) > 80 then '...' else '' end as short_text, len({sql.tokens('text')}) as tokens from documents"),
    "prompts": (prompts, f"select query_id, md5('query: ' || coalesce(query, '') || chr(10) || 'passage: ' || coalesce(passage, '')) as prompt, length({sql.strip(_JOINED)}) as joined from (select distinct query_id, lang, query, passage from pairs)"),
    "event_summary": (event_summary, """with r as (select event_type, value, row_number() over (partition by event_type order by value) - 1 as i, count(*) over (partition by event_type) as n from events where value is not null)
      select event_type, max(n) as n, round(avg(value), 6) as mean, max(case when i = least(floor(n * 0.1), n - 1) then value end) as p10, max(case when i = least(floor(n * 0.9), n - 1) then value end) as p90 from r group by 1"""),
    "inspect_sample": (inspect_sample, "select doc_id, lang, source from documents order by md5('42|' || doc_id), doc_id limit 20"),
    "cast_strings": (cast_strings, "select coalesce(cast(parent as varchar), '') as parent, count(*) as n, max(cast(id as varchar)) as last_id from nodes group by 1"),
}
