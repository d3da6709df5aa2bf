"""Compilation: joining pairs with mined negatives to fixed-width training rows.

Everything up to the last step works on keys; texts are joined once, at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.keys import first_non_empty, normalize, strip
from ..schema import require_empty


def permutations(pairs: DataFrame, mode: str = "all") -> DataFrame:
    """``(dataset, query_lang, passage_lang)``: the ordered pairs of a dataset's languages, or the diagonal only
    (``same_only``). The join is on the dataset, over its handful of languages."""
    langs = pairs.select("dataset", "lang").distinct()
    p = langs.select("dataset", F.col("lang").alias("query_lang")).join(langs.select("dataset", F.col("lang").alias("passage_lang")), "dataset")
    return p.where("query_lang = passage_lang") if mode == "same_only" else p


def select_negatives(mined: DataFrame, n: int, targets: DataFrame) -> DataFrame:
    """``(query, target, passage, lang, pick)``: for each query and target language the first ``n`` distinct passages of its
    mined list ``(query, passage, lang, place)``, those in the target language first, then any; positives are
    expected to be gone from the list. ``targets(query, target)``."""
    first = mined.groupBy("query", "passage").agg(F.min(F.struct("place", "lang")).alias("f"), F.collect_set(F.struct("lang", "place")).alias("all"))
    rows = first.join(targets, "query")
    # a passage stands at its first place in the target language, else at its first at all
    own = F.array_min(F.transform(F.filter("all", lambda x: x["lang"].eqNullSafe(F.col("target"))), lambda x: x["place"]))
    rows = rows.withColumn("own", own).withColumn("lang", F.when(F.col("own").isNotNull(), F.col("target")).otherwise(F.col("f.lang")))
    w = W.partitionBy("query", "target").orderBy(F.col("own").isNull(), F.coalesce("own", "f.place"), "passage")
    return rows.withColumn("pick", F.row_number().over(w)).where(F.col("pick") <= n).select("query", "target", "passage", "lang", "pick")


def recipes(pairs: DataFrame, mined: DataFrame, n: int = 8, mode: str = "all", policy: str = "query_lang") -> tuple[DataFrame, DataFrame]:
    """The rows to write, as keys, and what became of each query.

    ``pairs(dataset, query_id, passage_id, lang)``, distinct; ``mined(dataset, query_id, query_lang, passage_id, lang, place)``.
    A query in a language is dropped as ``insufficient`` if fewer than ``n`` distinct mined passages are neither positives
    of it in any language nor unknown, and as ``incomplete`` if one of its permutations picks fewer than ``n`` usable ones.
    Else there is a row for each positive in each passage language of the dataset."""
    pos = pairs.select("dataset", "query_id", "passage_id").distinct()
    known = pairs.select("dataset", "passage_id", "lang").distinct()
    queries = pairs.select("dataset", "query_id", F.col("lang").alias("query_lang")).distinct()
    key = ["dataset", "query_id", "query_lang"]
    lists = mined.join(pos, ["dataset", "query_id", "passage_id"], "left_anti")
    usable = lists.join(known, ["dataset", "passage_id", "lang"], "left_semi")
    enough = usable.groupBy(*key).agg(F.count_distinct(F.struct("passage_id", "lang")).alias("usable"))
    perms = queries.join(permutations(pairs, mode), ["dataset", "query_lang"])
    rows = perms.join(pairs.select("dataset", "query_id", F.col("passage_id").alias("positive_id"), F.col("lang").alias("passage_lang")), ["dataset", "query_id", "passage_lang"])
    name = F.to_json(F.struct(*key))
    target = "query_lang" if policy == "query_lang" else "passage_lang"
    targets = rows.select(name.alias("query"), F.col(target).alias("target")).distinct()
    picks = select_negatives(lists.select(name.alias("query"), F.col("passage_id").alias("passage"), "lang", "place"), n, targets)
    picks = picks.withColumn("dataset", F.get_json_object("query", "$.dataset"))
    ok = picks.join(known.select("dataset", F.col("passage_id").alias("passage"), "lang"), ["dataset", "passage", "lang"], "left_semi")
    chosen = ok.groupBy("query", "target").agg(F.count("*").alias("picked"), F.transform(F.sort_array(F.collect_list(F.struct("pick", "passage", "lang"))), lambda x: F.struct(x["passage"].alias("passage"), x["lang"].alias("lang"))).alias("negatives"))
    short = targets.join(chosen.select("query", "target", "picked"), ["query", "target"], "left").groupBy("query").agg(F.min(F.coalesce("picked", F.lit(0))).alias("least"))
    fate = queries.withColumn("query", name).join(enough, key, "left").join(short, "query", "left")
    fate = fate.select(*key, "query", F.when(F.coalesce("usable", F.lit(0)) < n, "insufficient").when(F.coalesce("least", F.lit(0)) < n, "incomplete").otherwise("written").alias("outcome"))
    good = rows.withColumn("query", name).join(fate.where("outcome = 'written'").select("query"), "query", "left_semi")
    out = good.withColumn("target", F.col(target)).join(chosen, ["query", "target"]).select(*key, "passage_lang", "positive_id", "negatives")
    return out, fate.drop("query")


def with_texts(rows: DataFrame, query_texts: DataFrame, passage_texts: DataFrame, n: int, max_chars: int = 32768) -> DataFrame:
    """Fixed-width rows ``(query_id, dataset, query_lang, passage_lang, query, positive, negative1..n)``.

    ``query_texts(dataset, query_id, lang, text)`` and ``passage_texts(dataset, passage_id, lang, text)`` hold one text a key.
    All passages of a row are exploded, joined with their texts once, and collected again by place. Longer texts than ``max_chars``
    are cut; ``truncated`` counts those of a row."""
    cut = lambda c: F.substring(c, 1, max_chars)
    over = lambda c: (F.char_length(c) > max_chars).cast("int")
    key = ["dataset", "query_id", "query_lang", "passage_lang", "positive_id"]
    everything = F.concat(F.array(F.struct(F.col("positive_id").alias("passage"), F.col("passage_lang").alias("lang"))), "negatives")
    parts = rows.select(*key, F.posexplode(everything).alias("place", "x")).select(*key, "place", F.col("x.passage").alias("passage_id"), F.col("x.lang").alias("lang"))
    parts = parts.join(passage_texts.select("dataset", "passage_id", "lang", cut("text").alias("text"), over("text").alias("over")), ["dataset", "passage_id", "lang"])
    g = parts.groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("place", "text"))).alias("m"), F.sum("over").alias("over"))
    g = g.join(query_texts.select("dataset", "query_id", F.col("lang").alias("query_lang"), cut("text").alias("query"), over("text").alias("q_over")), ["dataset", "query_id", "query_lang"])
    return g.select("query_id", "dataset", "query_lang", "passage_lang", "query", F.col("m")[0].alias("positive"), *(F.col("m")[i].alias(f"negative{i}") for i in range(1, n + 1)), (F.col("over") + F.col("q_over")).cast("int").alias("truncated"))


def mined_lists(queries: DataFrame, mined: DataFrame, first: str, second: str, key: str = "query") -> DataFrame:
    """``mined`` once for each row of ``queries`` that finds it by its ``first`` key or, only where nothing has that key, by its
    ``second``; with both key columns of ``queries``. Nulls find nothing."""
    held = mined.select(F.col(key).alias("_k")).distinct()
    q = queries.select(first, second).distinct()
    known = q.join(held, q[first] == held["_k"], "left").select(first, second, F.coalesce("_k", second).alias("_by"))
    return known.join(mined, known["_by"] == mined[key]).drop("_by", key)


def row_stats(rows: DataFrame) -> DataFrame:
    """``(dataset, rows, truncated)`` of what :func:`with_texts` made: rows, and texts that were cut."""
    return rows.groupBy("dataset").agg(F.count("*").alias("n_rows"), F.sum("truncated").alias("truncated"))


def drop_stats(fate: DataFrame) -> DataFrame:
    o = F.col("outcome")
    return fate.groupBy("dataset").agg(F.count("*").alias("queries"), F.count_if(o == "written").alias("written"), F.count_if(o == "insufficient").alias("insufficient"), F.count_if(o == "incomplete").alias("incomplete"))


def training_text_columns(columns: list[str], k: int) -> list[str]:
    """``query`` (or ``anchor``), ``positive`` and the first ``k`` of ``negative1``, ``negative_1``, ... in numeric order."""
    import re

    anchor = next((c for c in ("query", "anchor") if c in columns), None)
    if anchor is None or "positive" not in columns:
        raise ValueError("no query or positive column")
    negs = sorted((int(m[1]), c) for c in columns if (m := re.match(r"^negative_?(\d+)$", c)))
    if len(negs) < k:
        raise ValueError(f"{len(negs)} negative columns; {k} are wanted")
    return [anchor, "positive", *(c for _, c in negs[:k])]


def for_loss(df: DataFrame, k: int, check: bool = True) -> DataFrame:
    """The text columns only, as stripped strings, null as empty; of an array the first text that isn't blank. Raises if an anchor or a
    positive is empty then, unless told not to check."""
    kinds = dict(df.dtypes)
    cols = training_text_columns(df.columns, k)
    out = df.select(*((first_non_empty(F.col(c)) if kinds[c].startswith("array") else strip(normalize(c))).alias(c) for c in cols))
    if check:
        require_empty(out.where((F.col(cols[0]) == "") | (F.col("positive") == "")).select(*cols[:2]), "empty texts")
    return out
