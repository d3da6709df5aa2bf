"""Table contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAIR = T.StructType([T.StructField(c, T.StringType()) for c in ("query", "passage", "query_id", "passage_id", "lang", "dataset")])
VECTOR = T.StructType([*(T.StructField(c, T.StringType()) for c in ("id", "lang", "dataset", "kind")), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("source_shard", T.IntegerType())])
_S, _D, _I = T.StringType(), T.DoubleType(), T.IntegerType()


def _struct(**kinds) -> T.StructType:
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


_NEGATIVE = _struct(passage_id=_S, score=_D, avg_pos_score=_D, rank=_I, lang=_S)
MINED = _struct(query_id=_S, query=_S, positive_ids=T.ArrayType(_S), hard_negatives=T.ArrayType(_NEGATIVE))
RUN = _struct(query_id=_S, doc_id=_S, score=_D)
QRELS = _struct(query_id=_S, doc_id=_S, relevance=_I)
SAMPLE = _struct(query=_S, positive=T.ArrayType(_S), negative=T.ArrayType(_S), lang=_S)
IDENTITY = ["query_id", "passage_id", "lang", "dataset"]


class ContractError(ValueError):
    """A table lacks columns, or breaks an invariant."""


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    if missing := [c for c in columns if c not in df.columns]:
        raise ContractError(f"missing columns: {missing}")
    return df


def ensure_columns(df: DataFrame, **columns) -> DataFrame:
    """Set or append columns."""
    return df.withColumns(columns)


def require_empty(df: DataFrame, what: str) -> None:
    """Raise if ``df``, the rows that break an invariant, has any; the first few are named."""
    if bad := df.limit(3).collect():
        raise ContractError(f"{what}: {[r.asDict() for r in bad]}")


def require_counts(**counts: int) -> None:
    """Raise unless all counts are equal: rows read, written, restored."""
    if len(set(counts.values())) > 1:
        raise ContractError("row counts differ: " + ", ".join(f"{k} {n}" for k, n in counts.items()))


def count_differences(by: list[str], **tables: DataFrame) -> DataFrame:
    """``(by, <name>...)``: the keys that some tables hold in other numbers than others, with each table's number of rows. Empty if
    nothing was lost or repeated between the stages."""
    out = None
    for name, df in tables.items():
        n = df.groupBy(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in by)).agg(F.count("*").alias(name))
        out = n if out is None else out.join(n, by, "full")
    names = list(tables)
    out = out.fillna(0, names)
    return out.where(F.greatest(*names) != F.least(*names))


def all_strings(df: DataFrame) -> DataFrame:
    return df.select(*(F.col(f"`{c}`").cast("string").alias(c) for c in df.columns))


def add_constant_dataset(df: DataFrame, value: str) -> DataFrame:
    """Add the ``dataset`` column; it must not be there yet."""
    if "dataset" in df.columns:
        raise ContractError("there is a dataset column already")
    return df.withColumn("dataset", F.lit(value))
