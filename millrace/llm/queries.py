"""The queries of the eight problems over the tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import charform, groups, leaks, lookalike, mixing, neighbours, overlap, packing, splits


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def p1_found(spark, d):
    return overlap.overlap_pairs(spark, _t(spark, d, "reranking_samples"))


def p1_report(spark, d):
    return overlap.overlap_report(spark, _t(spark, d, "reranking_samples"))


def p2_found(spark, d):
    packed = packing.pack_components(spark, _t(spark, d, "component_assignments"), _t(spark, d, "shard_capacity"))
    return packed.groupBy("root").agg(F.count("*").alias("pieces")).where("pieces > 1").select("root")


def p2_shards(spark, d):
    return packing.pack_components(spark, _t(spark, d, "component_assignments"), _t(spark, d, "shard_capacity"))


def p2_fill(spark, d):
    """Of each dataset: components, rows, components cut, shards beyond the capacity, and whether the shards are as few as they can be
    but for one in fifty (and one more)."""
    packed, caps = p2_shards(spark, d), _t(spark, d, "shard_capacity").select(packing.clean_name("dataset").alias("dataset"), "capacity")
    per = packed.groupBy("dataset", "shard_id").agg(F.sum("rows").alias("n"))
    of = packed.groupBy("dataset", "root").agg(F.sum("rows").alias("n"), F.count("*").alias("k")).groupBy("dataset").agg(F.count("*").alias("components"), F.sum("n").alias("n_rows"), F.count_if(F.col("k") > 1).alias("cut"))
    g = per.join(caps, "dataset").groupBy("dataset", "capacity").agg(F.count_if(F.col("n") > F.col("capacity")).alias("beyond"), F.count("*").alias("shards"))
    g = g.join(of, "dataset")
    return g.select("dataset", "components", "n_rows", "cut", "beyond", (F.col("shards") <= 1.02 * F.ceil(F.col("n_rows") / F.col("capacity")) + 1).cast("int").alias("filled"))


def p3_found(spark, d):
    return groups.node_groups(spark, _t(spark, d, "nodes"), _t(spark, d, "scoped_keys"))


def p4_found(spark, d):
    return splits.torn_entities(spark, _t(spark, d, "nodes"), _t(spark, d, "scoped_keys"), _t(spark, d, "component_assignments"), _t(spark, d, "split_targets"))


def p4_splits(spark, d):
    return splits.grouped_split(spark, _t(spark, d, "nodes"), _t(spark, d, "scoped_keys"), _t(spark, d, "split_targets"))


def p4_shares(spark, d):
    """Of each split: whether its share of the records is within two hundredths of the target; and the entities and groups torn."""
    s = splits.grouped_split(spark, _t(spark, d, "nodes"), _t(spark, d, "scoped_keys"), _t(spark, d, "split_targets"))
    n = splits.entity_columns(_t(spark, d, "scoped_keys")).join(s, ["dataset", "kind", "value"]).groupBy("split_name").agg(F.count("*").alias("n"))
    n = n.crossJoin(n.agg(F.sum("n").alias("total"))).join(_t(spark, d, "split_targets"), "split_name")  # one row
    torn = s.groupBy("dataset", "value").agg(F.count_distinct("split_name").alias("k")).agg(F.count_if(F.col("k") > 1).alias("torn_entities"))
    groups_ = s.groupBy("component").agg(F.count_distinct("split_name").alias("k")).agg(F.count_if(F.col("k") > 1).alias("torn_components"))
    return n.select("split_name", (F.abs(F.col("n") / F.col("total") - F.col("target_share")) < 0.02).cast("int").alias("near")).crossJoin(torn).crossJoin(groups_)  # one row each


def p5_found(spark, d):
    return neighbours.similar_pairs(spark, _t(spark, d, "vector_store"))


def p5_most_similar(spark, d):
    return neighbours.most_similar(spark, _t(spark, d, "vector_store"))


def p6_found(spark, d):
    return leaks.leaked_passages(spark, _t(spark, d, "documents"), _t(spark, d, "heldout_items")).select("doc_id", "item_id")


def p6_passages(spark, d):
    return leaks.passages(spark, _t(spark, d, "documents"), _t(spark, d, "heldout_items"))


def p7_found(spark, d):
    return mixing.shares(spark, _t(spark, d, "documents"), _t(spark, d, "mix_targets")).where("short").select("source")


def p7_shares(spark, d):
    return mixing.shares(spark, _t(spark, d, "documents"), _t(spark, d, "mix_targets"))


def p7_shares_tokens(spark, d):
    return mixing.shares(spark, _t(spark, d, "documents"), _t(spark, d, "mix_targets"), size=mixing.tokenizer_size())


def p7_mix(spark, d):
    return mixing.mix(spark, _t(spark, d, "documents"), _t(spark, d, "mix_targets"))


def p7_mix_sums(spark, d):
    """Of each source what the chosen documents add up to with their repeats, and how many are repeated too often or listed twice."""
    caps = mixing.wanted_shares(_t(spark, d, "mix_targets"))
    m = p7_mix(spark, d).join(caps, "source").groupBy("source", "doc_id").agg(F.sum(F.col("size") * F.col("repeats")).alias("n"), F.count("*").alias("k"), F.max(F.col("repeats") > F.col("max_repeats")).alias("often"))
    return m.groupBy("source").agg(F.sum("n").alias("taken"), F.count_if("often").alias("too_often"), F.count_if(F.col("k") > 1).alias("twice"))


def p7_mix_tokens(spark, d):
    return mixing.mix(spark, _t(spark, d, "documents"), _t(spark, d, "mix_targets"), size=mixing.tokenizer_size())


def p8_found(spark, d):
    return lookalike.look_alike_pairs(spark, _t(spark, d, "documents"))


def p8_forms(spark, d):
    return lookalike.normalise_text(_t(spark, d, "documents").select("doc_id", "text")).select("doc_id", "text_form")


def p8_form_counts(spark, d):
    """Documents with a form, different texts and different forms."""
    f = lookalike.normalise_text(_t(spark, d, "documents").select("doc_id", "text"))
    return f.agg(F.count("text_form").alias("documents"), F.count_distinct("text").alias("texts"), F.count_distinct("text_form").alias("forms"))


def p8_classes(spark, d):
    return lookalike.form_classes(_t(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    names = "p1_found p1_report p2_found p2_shards p2_fill p3_found p4_found p4_splits p4_shares p5_found p5_most_similar p6_found p6_passages p7_found p7_shares p7_shares_tokens p7_mix p7_mix_sums p7_mix_tokens p8_found p8_forms p8_form_counts p8_classes".split()
    return {n: globals()[n] for n in names}



def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')"


_DATASET = f"lower({_strip('dataset')})"
_NOW = f"""now as (select * from (select root, {_DATASET} as ds, row_count, shard_id,
  row_number() over (partition by root order by assigned_at desc nulls last, row_count desc nulls last, shard_id desc nulls last, {_DATASET} desc nulls last) as rn from component_assignments where root is not null) where rn = 1)"""
_KEY = ", ".join(f"{_strip(f'coalesce({c}, {chr(39) * 2})')} as {c}" for c in ("kind", "value", "lang", "dataset"))
_GROUPS = f"""ids as (select distinct id from nodes where id is not null), ks as (select distinct {_KEY}, node_id from scoped_keys where node_id is not null),
  hub as (select kind, value, lang, dataset, min(node_id) as h from ks group by all),
  links as (select n.id as a, n.parent as b from nodes n where n.parent in (select id from ids) union select k.node_id, hub.h from ks k join hub using (kind, value, lang, dataset)),
  both_ways as (select a, b from links where a <> b union select b, a from links where a <> b),
  reach(node, root) as (select id, id from ids union select e.b, r.root from reach r join both_ways e on e.a = r.node where r.root < e.b),
  grp as (select node as node_id, min(root) as group_id from reach group by node)"""


def _mapped(x: str, table: dict[str, str]) -> str:
    """``x`` with the characters of ``table`` replaced: those with one for one at once, the others one after the other (those of the Latin
    blocks; rarer ones are left to the tests by brute force)."""
    one = {k: v for k, v in table.items() if len(k) == len(v) == 1 and not {k, v} & {chr(39), chr(92)}}
    two = {k: v for k, v in table.items() if len(k) == 1 and len(v) == 2 and ord(k) < 0x250}
    for k, v in two.items():
        x = f"replace({x}, '{k}', '{v}')"
    return f"translate({x}, '{''.join(one)}', '{''.join(one.values())}')"


_INVISIBLE = "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in charform.NO_WIDTH) + "]"


def _words_sql(x: str) -> str:
    """The words of a text as a list."""
    table = {chr(k): v for k, v in charform._fold_table().items()}
    folded = _mapped(f"lower(nfc_normalize(regexp_replace(coalesce({x}, ''), '{_INVISIBLE}', '', 'g')))", table)
    return f"regexp_extract_all(nfc_normalize({folded}), '[\\p{{L}}\\p{{N}}](?:[\\p{{L}}\\p{{N}}]|[\\x{{300}}-\\x{{36f}}])*')"


def _form_sql(x: str) -> str:
    """A text in one consistent form, with representatives of its own."""
    spaced = f"regexp_replace(regexp_replace({x}, '{_INVISIBLE}', '', 'g'), '\\p{{Zs}}', ' ', 'g')"
    table = charform.rewrites({})
    return f"nfc_normalize({_mapped(f'nfc_normalize({spaced})', table)})"


def _agree(a: str, b: str) -> str:
    return f"len(list_intersect({a}, {b})) * 10 >= 7 * (len({a}) + len({b}) - len(list_intersect({a}, {b})))"


_SAMPLES = f"""sm as (select distinct sample_id, case when lower({_strip('split')}) = 'val' then 'validation' else lower({_strip('split')}) end as sp, lower({_strip('dataset')}) as ds, query, positive from reranking_samples where sample_id is not null),
  sq as (select sample_id, sp, list_distinct({_words_sql('query')}) as q from sm where sp in ('train', 'validation', 'test')),
  po as (select distinct sample_id, list_distinct({_words_sql('x')}) as p from (select sample_id, unnest(positive) as x from sm)),
  qa as (select a.sample_id as a, b.sample_id as b, len(list_intersect(a.q, b.q)) = greatest(len(a.q), len(b.q)) as same from sq a join sq b on a.sp = 'train' and b.sp <> 'train' and len(a.q) > 0 and len(b.q) > 0 and len(a.q) * 10 >= 7 * len(b.q) and len(b.q) * 10 >= 7 * len(a.q) and {_agree('a.q', 'b.q')}),
  pr as (select qa.a, qa.b, bool_or(qa.same and len(list_intersect(x.p, y.p)) = greatest(len(x.p), len(y.p))) as equal from qa join po x on x.sample_id = qa.a join po y on y.sample_id = qa.b where len(x.p) > 0 and len(y.p) > 0 and {_agree('x.p', 'y.p')} and qa.a <> qa.b group by 1, 2)"""
_GRAMS = "list_transform(range(1, len(w) - {0} + 2), lambda i: array_to_string(w[i:i + {0} - 1], ' '))"
_SIZE = f"""t as (select lower({_strip('source')}) as source, sum(target_share) as share, max(coalesce(max_repeats, 0)) as cap from mix_targets where source is not null group by 1),
          s as (select lower({_strip('source')}) as source, count(*) as docs, sum(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\s\\p{{Z}}]+'), lambda x: x <> ''))) as size from documents group by 1),
          j as (select t.*, cast(coalesce(s.docs, 0) as bigint) as docs, cast(coalesce(s.size, 0) as bigint) as size from t left join s on s.source = t.source)"""


def oracle_sql() -> dict[str, str]:
    """For the results that SQL can give on whole tables; the others are tested against brute force."""
    return {
        "p2_found": f"with {_NOW} select root from now join shard_capacity c on c.dataset = now.ds where now.row_count > c.capacity",
        "p3_found": f"with recursive {_GROUPS} select node_id, group_id from grp",
        "p4_found": f"""with recursive {_GROUPS}, {_NOW}, gs as (select distinct g.group_id, now.shard_id from now join grp g on g.node_id = now.root where now.shard_id is not null)
          select ks.dataset, ks.kind, ks.value from ks join grp g on g.node_id = ks.node_id join gs on gs.group_id = g.group_id group by all having count(distinct gs.shard_id) > 1""",
        "p1_found": f"with {_SAMPLES} select distinct least(a, b) as sample_a, greatest(a, b) as sample_b from pr",
        "p1_report": f"""with {_SAMPLES}, per as (select b as sample_id, count(*) as pairs, count(*) filter (equal) as equal_pairs from pr group by 1), al as (select distinct sample_id, sp, ds from sm where sp in ('validation', 'test'))
          select sp as split, ds as dataset, count(*) as samples, count(*) filter (per.pairs > 0) as overlapping, cast(coalesce(sum(per.pairs), 0) as bigint) as pairs, cast(coalesce(sum(per.equal_pairs), 0) as bigint) as equal_pairs from al left join per on per.sample_id = al.sample_id group by 1, 2""",
        "p2_fill": f"""with {_NOW} select ds as dataset, count(*) as components, cast(sum(greatest(coalesce(row_count, 0), 0)) as bigint) as n_rows, count(*) filter (row_count > c.capacity) as cut, 0 as beyond, 1 as filled from now join shard_capacity c on c.dataset = now.ds group by 1""",
        "p4_shares": "select split_name, 1 as near, 0 as torn_entities, 0 as torn_components from split_targets",
        "p5_found": f"""with u as (select id, kind, source_shard, embedding::double[] as v from vector_store where id is not null and kind is not null and embedding is not null and len(embedding) = 128 and len(list_filter(embedding, lambda x: x is null)) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
          f as (select * from (select *, row_number() over (partition by id order by source_shard nulls last, kind, v) as rn from u) where rn = 1), n as (select id, kind, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) as v from f),
          s as (select a.id as a, b.id as b, round(list_dot_product(a.v, b.v), 7) as s from n a join n b on a.kind = b.kind and a.id <> b.id), r as (select *, row_number() over (partition by a order by s desc, b) as rk from s)
          select distinct least(a, b) as id_a, greatest(a, b) as id_b from r where rk <= 5 and s >= 0.8""",
        "p6_found": f"""with iw as (select item_id, {_words_sql('text')} as w from heldout_items), ig as (select distinct item_id, least(len(w), 12) as n, unnest({_GRAMS.format('least(len(w), 12)')}) as g from iw where len(w) > 0),
          sz as (select distinct n from ig), dw as (select doc_id, {_words_sql('text')} as w from documents), dg as (select distinct doc_id, n, unnest({_GRAMS.format('n')}) as g from dw, sz where len(w) >= n)
          select distinct dg.doc_id, ig.item_id from ig join dg on dg.n = ig.n and dg.g = ig.g""",
        "p7_found": f"with {_SIZE} select source from j where cap * size < share * (select sum(size) from j)",
        "p7_shares": f"""with {_SIZE}, b as (select *, share * (select sum(size) from j) as budget from j), k as (select *, cap * size < budget as short, cast(case when cap * size < budget then cap * size else floor(budget) end as bigint) as taken from b)
          select source, docs, size, share as target_share, budget, taken, taken / sum(taken) over () as actual_share, short from k""",
        "p7_mix_sums": f"""with {_SIZE}, b as (select *, share * (select sum(size) from j) as budget from j), k as (select source, cast(case when cap * size < budget then cap * size else floor(budget) end as bigint) as taken from b)
          select source, taken, 0 as too_often, 0 as twice from k where taken > 0""",
        "p8_form_counts": f"select count(form) as documents, count(distinct text) as texts, count(distinct form) as forms from (select text, {_form_sql('text')} as form from documents)",
        "p8_found": f"with f as (select doc_id, text, {_form_sql('text')} as form from documents where text is not null) select distinct a.doc_id as doc_a, b.doc_id as doc_b from f a join f b on a.form = b.form and a.text <> b.text and a.doc_id < b.doc_id",
        "p8_classes": f"with f as (select doc_id, text, {_form_sql('text')} as form from documents where text is not null), c as (select form, min(doc_id) as class_id, count(distinct text) as n_texts, count(*) as n_rows from f group by 1) select f.doc_id, c.class_id, c.n_texts, c.n_rows from f join c on c.form = f.form",
    }
