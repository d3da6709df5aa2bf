"""Stable buckets, their manifest, and how buckets are given to ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.keys import default_dataset, first_non_empty, hash60, hash63, normalize, strip

HASHES = {"md5": hash60, "blake2b": lambda c: hash63(normalize(c))}
# What stands for an id or text that is missing, and for an empty text, in a hash
MISSING_ID, MISSING_POSITIVE, EMPTY_POSITIVE, EMPTY_NEGATIVE = "__missing_query_id__:", "__missing_positive__:", "__empty_positive__", "__empty_negative__:"


def add_bucket(df: DataFrame, n: int, key: str = "query_id", row_key: str | None = None, algorithm: str = "md5", positive: str = "positive", negatives: list[str] = (), stem: str | None = None) -> DataFrame:
    """Add ``query_key64``, ``bucket_id``, ``positive_key64``, ``negative_key64_i`` and, where it is missing, an empty ``lang``.
    ``algorithm``: ``blake2b`` for 63 bits of BLAKE2b (equal to stored buckets, in Python), ``md5`` for 60 bits of MD5 (inside
    generated code). ``stem``: the name of the rows' file, for rows whose ``dataset`` is null or blank.

    Keys and texts are hashed without outer white space; of an array the first text that isn't blank counts. A null or blank key
    and a missing positive column are replaced by ``row_key`` (a column that names the row; if there is none, the hash of all
    columns, so that such rows spread over all buckets); empty positives hash a sentinel, empty negatives one with their number."""
    h = HASHES[algorithm]
    row = normalize(row_key) if row_key else F.md5(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns))))
    k = strip(normalize(key))
    df = df.withColumn("_k", F.when(k != "", k).otherwise(F.concat(F.lit(MISSING_ID), row)))
    if positive not in df.columns:
        df = df.withColumn("_p", F.concat(F.lit(MISSING_POSITIVE), row)).withColumn("positive_key64", h("_p")).drop("_p")
    df = df.withColumn("query_key64", h("_k")).withColumn("bucket_id", F.pmod("query_key64", F.lit(n)).cast("int")).drop("_k")
    kinds = dict(df.dtypes)
    for name, c, sentinel in [("positive_key64", positive, EMPTY_POSITIVE), *((f"negative_key64_{i}", c, f"{EMPTY_NEGATIVE}{i}") for i, c in enumerate(negatives, 1))]:
        if c in df.columns:
            t = first_non_empty(F.col(c)) if kinds[c].startswith("array") else strip(normalize(c))
            df = df.withColumn("_t", F.when(t == "", sentinel).otherwise(t)).withColumn(name, h("_t")).drop("_t")
    if stem is not None:
        df = df.withColumn("dataset", default_dataset("dataset", stem) if "dataset" in df.columns else F.lit(stem))
    return df if "lang" in df.columns else df.withColumn("lang", F.lit(""))


def manifest(bucketed: DataFrame, key: str = "query_id", split: str | None = None) -> DataFrame:
    """``(split, dataset, bucket_id, rows, unique_query_ids)``; null keys aren't counted among the ids."""
    by = ([split] if split else []) + ["dataset", "bucket_id"]
    return bucketed.groupBy(*by).agg(F.count("*").alias("n_rows"), F.count_distinct(key).alias("unique_query_ids"))


def split_totals(manifest_rows: DataFrame, split: str) -> DataFrame:
    return manifest_rows.groupBy(split).agg(F.sum("n_rows").alias("n_rows"), F.count_distinct("dataset").alias("datasets"), F.count_distinct(F.struct("dataset", "bucket_id")).alias("buckets"))


def max_length_hint(df: DataFrame, texts: list[str], default: int = 512) -> DataFrame:
    """``(dataset, max_chars, max_length)``: a quarter of the longest text, within 128 and ``default``."""
    longest = F.greatest(*(F.char_length(normalize(c)) for c in texts)) if len(texts) > 1 else F.char_length(normalize(texts[0]))
    g = df.groupBy("dataset").agg(F.max(longest).alias("max_chars"))
    return g.withColumn("max_length", F.least(F.lit(default), F.greatest(F.lit(128), F.ceil(F.col("max_chars") / 4))).cast("int"))


def simulate_balance(manifest_rows: DataFrame, world_sizes: list[int]) -> DataFrame:
    """``(world_size, max_rows, mean_rows, imbalance, empty)``: rows per rank if bucket b goes to rank b % world size;
    ``empty`` counts the datasets that leave a rank without rows. The ranks are a dense list, so empty ones count."""
    spark = manifest_rows.sparkSession
    ranks = spark.createDataFrame([(w, r) for w in world_sizes for r in range(w)], "world_size int, rank int")
    sizes = spark.createDataFrame([(w,) for w in world_sizes], "world_size int")
    by = manifest_rows.groupBy("dataset", "bucket_id").agg(F.sum("n_rows").alias("n_rows"))
    placed = by.crossJoin(F.broadcast(sizes)).withColumn("rank", F.pmod("bucket_id", F.col("world_size")))  # a few world sizes
    load = placed.groupBy("world_size", "rank").agg(F.sum("n_rows").alias("n_rows"))
    load = ranks.join(load, ["world_size", "rank"], "left").fillna(0, ["n_rows"])
    stats = load.groupBy("world_size").agg(F.max("n_rows").alias("max_rows"), F.avg("n_rows").alias("mean_rows"))
    held = placed.where("n_rows > 0").groupBy("world_size", "dataset").agg(F.count_distinct("rank").alias("r"))
    empty = held.groupBy("world_size").agg(F.count_if(F.col("r") < F.col("world_size")).alias("empty"))
    return stats.join(empty, "world_size", "left").select("world_size", "max_rows", "mean_rows", F.round(F.try_divide("max_rows", "mean_rows"), 9).alias("imbalance"), F.coalesce("empty", F.lit(0)).alias("empty"))


def rank_modulo(manifest_rows: DataFrame, world_size: int) -> DataFrame:
    return manifest_rows.withColumn("rank", F.pmod("bucket_id", F.lit(world_size)).cast("int"))


def rank_greedy(manifest_rows: DataFrame, world_size: int) -> DataFrame:
    """Longest first per dataset: (dataset, bucket) groups by rows descending, then bucket, each to the least loaded rank,
    the lowest of equals. A dataset has at most as many rows here as there are buckets, a fixed number."""
    import pandas as pd

    by = manifest_rows.groupBy("dataset", "bucket_id").agg(F.sum("n_rows").alias("n_rows"))

    def lpt(pdf: pd.DataFrame) -> pd.DataFrame:
        import heapq

        pdf = pdf.sort_values(["n_rows", "bucket_id"], ascending=[False, True])
        heap, of = [(0, r) for r in range(world_size)], []
        for n in pdf["n_rows"]:
            load, r = heapq.heappop(heap)
            of.append(r)
            heapq.heappush(heap, (load + int(n), r))
        return pdf.assign(rank=of)

    return by.groupBy("dataset").applyInPandas(lambda pdf: lpt(pdf), "dataset string, bucket_id int, n_rows long, rank int")


def dataset_ratios(sizes: DataFrame, shard: str, rows: str) -> DataFrame:
    """``(shard, dataset, n_rows, in_shard, of_dataset)``: rows of each dataset in each shard, and both shares."""
    g = sizes.groupBy(shard, "dataset").agg(F.sum(rows).alias("n_rows"))
    s = F.sum("n_rows")
    return g.select(shard, "dataset", "n_rows", F.round(F.try_divide("n_rows", s.over(W.partitionBy(shard))), 9).alias("in_shard"), F.round(F.try_divide("n_rows", s.over(W.partitionBy("dataset"))), 9).alias("of_dataset"))
