"""Language coverage of pairs, and what a key holds first, last and distinct."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import normalize


def full_coverage(pairs: DataFrame, scope: list[str], lang: str = "lang") -> DataFrame:
    """Rows of pairs that occur in all non-null languages of their scope; a pair with a null language never does.
    In a scope without languages nothing is filtered."""
    pair = [*scope, "query_id", "passage_id"]
    all_langs = pairs.groupBy(*scope).agg(F.count_distinct(lang).alias("_all")) if scope else pairs.agg(F.count_distinct(lang).alias("_all"))
    of = pairs.groupBy(*pair).agg(F.count_distinct(lang).alias("_n"), F.max(F.col(lang).isNull()).alias("_null"))
    of = of.join(F.broadcast(all_langs), scope) if scope else of.crossJoin(F.broadcast(all_langs))  # a row per scope
    keep = of.where("_all = 0 or (_n = _all and not _null)").select(*pair)
    return null_safe_semi(pairs, keep, pair)


def single_language(pairs: DataFrame, scope: list[str], lang: str = "lang") -> DataFrame:
    """Rows of pairs that occur in exactly one non-null language; nulls are ignored."""
    pair = [*scope, "query_id", "passage_id"]
    keep = pairs.groupBy(*pair).agg(F.count_distinct(lang).alias("_n")).where("_n = 1").select(*pair)
    return null_safe_semi(pairs, keep, pair)


def null_safe_semi(df: DataFrame, keep: DataFrame, keys: list[str]) -> DataFrame:
    on = [df[k].eqNullSafe(keep[k]) for k in keys]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return df.join(keep, cond, "left_semi")


def first_text(df: DataFrame, keys: list[str], text: str, order: Column) -> DataFrame:
    """``(keys, text, n, mismatches)``: the text that came first for each key (by ``order``, ties: the smaller text), the
    key's rows, and how many of them have another text than the first. Null text reads as empty."""
    t = normalize(text)
    rows = df.select(*(normalize(k).alias(k) for k in keys), t.alias("_t"), order.alias("_o"))
    first = rows.groupBy(*keys).agg(F.min(F.struct(F.col("_o").isNull().alias("z"), "_o", "_t")).alias("_f"), F.count("*").alias("n"))
    per_text = rows.groupBy(*keys, "_t").agg(F.count("*").alias("_k"))
    same = per_text.join(first, keys).where(F.col("_t") == F.col("_f._t"))
    return same.select(*keys, F.col("_t").alias("text"), "n", (F.col("n") - F.col("_k")).alias("mismatches"))


def last_row(df: DataFrame, keys: list[str], value: str, order: Column) -> DataFrame:
    """``(keys, value)``: the value of the key's last row (null order is earliest; ties: the larger value)."""
    rows = df.select(*(normalize(k).alias(k) for k in keys), normalize(value).alias("_v"), order.alias("_o"))
    return rows.groupBy(*keys).agg(F.max(F.struct("_o", "_v")).alias("_l")).select(*keys, F.col("_l._v").alias(value))


def positives(pairs: DataFrame) -> DataFrame:
    """``(query_id, lang, dataset, passage_id)``: the distinct positives of each scoped query."""
    return pairs.select(*(normalize(c).alias(c) for c in ("query_id", "lang", "dataset", "passage_id"))).distinct()
