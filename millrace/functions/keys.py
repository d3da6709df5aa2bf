"""Keys, names and hashes. Nulls in keys read as the empty string."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACES = r"(?U)^\s+|\s+$"


def strip(c) -> Column:
    """Remove outer white space of any kind (``trim`` removes blanks only). Null stays null."""
    return F.regexp_replace(F.col(c) if isinstance(c, str) else c, SPACES, "")


def normalize(c) -> Column:
    """As a string, null as the empty string."""
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))


def scoped_key(*cols: str) -> Column:
    """A struct of the normalised columns: joins on it never confuse ``('a_b', 'c')`` with ``('a', 'b_c')``."""
    return F.struct(*(normalize(c).alias(c) for c in cols))


def item_lang_key(id_col: str, lang_col: str) -> Column:
    """``id_lang``, for output only: it can collide where ids hold underscores."""
    return F.concat(normalize(id_col), F.lit("_"), normalize(lang_col))


def compile_keys(query_id="query_id", passage_id="passage_id", lang="lang", dataset="dataset") -> dict[str, Column]:
    """The derived keys of compilation: query in its dataset, that in its language, passage in its language."""
    qd = F.concat(normalize(query_id), F.lit("::"), normalize(dataset))
    ql = F.concat(qd, F.lit("_"), normalize(lang))
    return {"qid_dataset": qd, "qid_lang": ql, "pid_lang": item_lang_key(passage_id, lang)}


def default_dataset(c, default: str) -> Column:
    """Stripped; null and empty become ``default``."""
    s = strip(c)
    return F.when(F.coalesce(s, F.lit("")) == "", F.lit(default)).otherwise(s)


def first_non_empty(c) -> Column:
    """First element of an array that isn't blank, stripped; else the empty string. Null array: empty."""
    arr = F.transform(F.filter(c, lambda x: F.coalesce(strip(x), F.lit("")) != ""), strip)
    return F.coalesce(F.try_element_at(arr, F.lit(1)), F.lit(""))


def safe_dataset_name(c) -> Column:
    """Usable as a file name: runs of other characters become ``_``; null and empty become ``unknown_dataset``."""
    s = F.regexp_replace(normalize(c), "[^A-Za-z0-9_.-]+", "_")
    return F.when(s == "", "unknown_dataset").otherwise(s)


def safe_name(c) -> Column:
    """For model names: ``/`` and other separators become ``-``, outer ``-`` removed."""
    return F.regexp_replace(F.regexp_replace(normalize(c), "[^A-Za-z0-9_.-]+", "-"), "^-+|-+$", "")


def hash60(*cols) -> Column:
    """The first 60 bits of the MD5 of a string: non-negative, the same in any engine, inside generated code."""
    c = F.concat(*(normalize(x) for x in cols)) if len(cols) > 1 else normalize(cols[0])
    return F.conv(F.substring(F.md5(c), 1, 15), 16, 10).cast("long")


@F.pandas_udf(T.LongType())
def hash63(s: pd.Series) -> pd.Series:
    """63 bits of an 8-byte BLAKE2b digest, little-endian: the bit-compatible bucket hash. Null reads as empty."""
    mask = (1 << 63) - 1
    return pd.Series([int.from_bytes(hashlib.blake2b((t or "").encode(), digest_size=8).digest(), "little") & mask for t in s])


# Spellings of the two languages that metrics are kept for
RUSSIAN = ("ru", "rus", "russian", "рус", "русский")
ENGLISH = ("en", "eng", "english", "англ", "английский")


def lang_key(c) -> Column:
    """``ru``, ``en``, ``ru-en`` or ``en-ru``, by the first two of these languages that the value names; null if it
    names neither. Tokens are runs of Latin and Russian letters, in any case."""
    tokens = F.split(F.regexp_replace(F.lower(normalize(c)), "[^a-zа-я]+", "-"), "-")
    named = F.transform(tokens, lambda x: F.when(x.isin(*RUSSIAN), "ru").when(x.isin(*ENGLISH), "en"))
    two = F.slice(F.filter(named, lambda x: x.isNotNull()), 1, 2)
    return F.when(F.size(two) > 0, F.array_join(F.array_distinct(two), "-"))


def with_ordinal(df, *order: str, out: str = "ordinal"):
    """``df`` in the given order with its 0-based place, without a window over everything: rows are sorted in ranges, written, and
    offset by the counts of the ranges before. Equal rows get places of their own."""
    from pyspark.sql import Window as W

    from ..session import Scratch

    tmp = Scratch(df.sparkSession, "ordinal")
    rows = tmp.cut(df.sort(*order).withColumn("_m", F.monotonically_increasing_id()))
    rows = rows.withColumn("_p", F.shiftright("_m", 33))
    n = rows.groupBy("_p").agg(F.count("*").alias("_k"))  # a row for each range
    n = n.select("_p", F.coalesce(F.sum("_k").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    return rows.join(F.broadcast(n), "_p").withColumn(out, F.col("_b") + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))).drop("_m", "_p", "_b")
