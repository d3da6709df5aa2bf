"""The vector store: what is kept of vectors that are stored again, and reading with a fallback key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import normalize
from ..functions.vector import allclose, usable
from ..schema import require_empty

KEY = ["dataset", "kind", "id", "lang"]


def resolve(vectors: DataFrame, rtol: float = 1e-5, atol: float = 1e-8, dim: int | None = None) -> DataFrame:
    """All usable vectors with ``first`` (the vector kept for the key: lowest ``source_shard``, then the smallest vector)
    and ``outcome``: ``written``, ``duplicate`` (agrees with the first within the tolerance) or ``conflict``.

    The first of a key is found by a partial minimum and joined back, so one key with many rows is never a list.
    Null, empty and all-zero vectors are left out, as are those of another size than ``dim`` if it is given."""
    rows = vectors.where(usable("embedding", dim)).select(*(normalize(c).alias(c) for c in KEY), F.coalesce("source_shard", F.lit(2147483647)).alias("source_shard"), "embedding")
    first = rows.groupBy(*KEY).agg(F.min(F.struct("source_shard", "embedding")).alias("f"))
    # of equal rows one is the written one
    rows = rows.groupBy(*KEY, "source_shard", "embedding").agg(F.count("*").alias("copies"))
    out = rows.join(first, KEY).withColumn("is_first", (F.col("source_shard") == F.col("f.source_shard")) & (F.col("embedding") == F.col("f.embedding")))
    again = F.when(allclose("embedding", "f.embedding", rtol, atol), "duplicate").otherwise("conflict")
    return out.select(*KEY, "source_shard", "embedding", "copies", F.col("f.embedding").alias("first"), F.when(F.col("is_first"), "written").otherwise(again).alias("outcome"))


def stored(vectors: DataFrame, dim: int | None = None) -> DataFrame:
    """``(dataset, kind, id, lang, vector)``: the vector kept for each key."""
    rows = vectors.where(usable("embedding", dim)).select(*(normalize(c).alias(c) for c in KEY), F.struct(F.coalesce("source_shard", F.lit(2147483647)).alias("s"), F.col("embedding").alias("e")).alias("r"))
    return rows.groupBy(*KEY).agg(F.min("r").alias("r")).select(*KEY, F.col("r.e").alias("vector"))


def outcome_counts(resolved: DataFrame) -> DataFrame:
    """``(dataset, kind, written, duplicates, conflicts)``; a copy of the first is a duplicate."""
    n = lambda o: F.sum(F.when(F.col("outcome") == o, F.col("copies")).otherwise(0))
    first = F.count_if(F.col("outcome") == "written")
    return resolved.groupBy("dataset", "kind").agg(first.alias("written"), (n("duplicate") + n("written") - first).alias("duplicates"), n("conflict").alias("conflicts"))


def with_vectors(rows: DataFrame, store: DataFrame, keys: dict[str, str], out: str, fallback: tuple[DataFrame, dict[str, str]] | None = None) -> DataFrame:
    """Left join of vectors by ``keys`` (column of rows: column of store), then by the ``fallback`` store and keys."""
    def attach(df, st, on, name):
        st = st.select(*(F.col(b).alias(f"_{a}") for a, b in on.items()), F.col("vector").alias(name))
        cond = None
        for a in on:
            c = normalize(df[a]) == st[f"_{a}"]
            cond = c if cond is None else cond & c
        return df.join(st, cond, "left").drop(*(f"_{a}" for a in on))

    rows = attach(rows, store, keys, out)
    if fallback:
        rows = attach(rows, fallback[0], fallback[1], "_other").withColumn(out, F.coalesce(out, "_other")).drop("_other")
    return rows


def complete_vectors(rows: DataFrame, vector: str, key: str, text: str, embed=None, dim: int | None = None) -> DataFrame:
    """``rows`` with a ``vector`` each: those without one get it from ``embed`` (a function of a text column, as
    :func:`millrace.functions.models.embedder` makes them; only their texts reach the model), else they raise. A vector of another size
    than ``dim`` raises, too. Null and blank texts have no vector to get: with a model they keep a null."""
    if dim is not None:
        require_empty(rows.where(F.col(vector).isNotNull() & (F.size(vector) != dim)).select(key, F.size(vector).alias("dim")), f"vectors not of {dim} numbers")
    if embed is None:
        return require_vectors(rows, vector, key)
    missing = rows.where(F.col(vector).isNull())
    made = missing.withColumn(vector, embed(F.col(text)).cast(dict(rows.dtypes)[vector]))
    return rows.where(F.col(vector).isNotNull()).unionByName(made)


def require_vectors(rows: DataFrame, vector: str, key: str) -> DataFrame:
    """Raise if a row has no vector and there is no embedder to make one."""
    require_empty(rows.where(F.col(vector).isNull()).select(key).distinct(), "no vector for")
    return rows
