"""Filtering and bucketing of pairs as they arrive: stateless, so a batch run and a stream give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.buckets import add_bucket
from ..operators.consistency import rank_filter


def filter_and_bucket(scored: DataFrame, k: int, buckets: int) -> DataFrame:
    return add_bucket(rank_filter(scored, k), buckets)


def stream_buckets(spark: SparkSession, source: str, schema: T.StructType, sink: str, checkpoint: str, k: int = 30, buckets: int = 64, once: bool = True) -> StreamingQuery:
    """Read scored pairs from Parquet files that appear in ``source`` and append the bucketed survivors to ``sink``.

    Each micro-batch is written to a folder of its own number, which a repeated batch overwrites: exactly once."""
    def write(df: DataFrame, epoch: int) -> None:
        filter_and_bucket(df, k, buckets).write.mode("overwrite").parquet(f"{sink}/epoch={epoch}")

    stream = spark.readStream.schema(schema).parquet(source)
    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w).start()
