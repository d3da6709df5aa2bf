"""Small made-up tables for trying the pipeline out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import hash60


def mini_pairs(spark: SparkSession, dataset: str, ids: int, langs: list[str]) -> DataFrame:
    """Pairs of query n and passage n for n below ``ids``, in each language."""
    rows = spark.range(ids).withColumn("lang", F.explode(F.array(*(F.lit(x) for x in langs))))
    name = lambda form: F.format_string(form, F.lit(dataset), F.col("id"), F.col("lang"))
    return rows.select(
        name("query-%s-%d-%s").alias("query"), name("passage-%s-%d-%s").alias("passage"), name("%s:q%d:%s").alias("query_id"), name("%s:p%d:%s").alias("passage_id"), "lang", F.lit(dataset).alias("dataset")
    )


def mini_compiled(spark: SparkSession, datasets: list[str], ids: int = 20, lang: str = "ru", pool: int = 100, negatives: int = 8, seed: int = 42) -> DataFrame:
    """Training rows ``query, positive, negative_1..n``: passage n for query n, and negatives from the other passages of its dataset in
    the order of a seeded hash."""
    text = lambda kind, n: F.format_string(f"{kind}-%s-%d-{lang}", F.col("dataset"), n)
    rows = spark.range(ids).withColumn("dataset", F.explode(F.array(*(F.lit(d) for d in datasets))))
    others = F.filter(F.sequence(F.lit(0), F.lit(pool - 1)), lambda j: j != F.col("id"))
    order = F.transform(others, lambda j: F.struct(hash60(F.lit(f"{seed}|"), "dataset", F.lit("|"), "id", F.lit("|"), j).alias("h"), j.alias("j")))
    picked = rows.withColumn("order", F.slice(F.array_sort(order), 1, negatives))
    return picked.select(text("query", F.col("id")).alias("query"), text("passage", F.col("id")).alias("positive"), *(text("passage", F.col("order")[i]["j"]).alias(f"negative_{i + 1}") for i in range(negatives)))
