"""Writers and manifests. None overwrites what it reads."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.keys import safe_dataset_name
from ..schema import MINED, ContractError, require_counts


def _exists(spark: SparkSession, where: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def write_splits(df: DataFrame, path: str, split: str = "split", source: str = "source_file") -> None:
    df.write.partitionBy(split, source).option("compression", "snappy").parquet(path)


def write_by_dataset(df: DataFrame, path: str, compression: str = "snappy") -> None:
    """A folder for each dataset, under a name that is safe for files. Rows aren't gathered by dataset first: a dataset
    with most of the rows stays spread over all tasks."""
    df.withColumn("dataset_file", safe_dataset_name("dataset")).write.partitionBy("dataset_file").option("compression", compression).parquet(path)


def write_shards(df: DataFrame, path: str, shards: int, files_per_shard: int = 1, max_records: int = 0) -> None:
    """A folder for each of ``shards`` shards, from one shuffle; a shard without rows has an empty file."""
    spread = df.withColumn("_f", F.pmod(F.xxhash64(*df.columns), F.lit(files_per_shard)))
    spread.repartition(shards * files_per_shard, "shard_id", "_f").drop("_f").write.partitionBy("shard_id").option("maxRecordsPerFile", max_records).parquet(path)
    spark = df.sparkSession
    for s in range(shards):
        if not _exists(spark, f"{path}/shard_id={s}"):
            spark.createDataFrame([], df.drop("shard_id").schema).coalesce(1).write.parquet(f"{path}/shard_id={s}")


def write_buckets(df: DataFrame, path: str, overwrite: bool = False, compression: str = "zstd") -> DataFrame:
    """``split/dataset/bucket_id`` folders and, in ``_manifest``, an entry for each file: ``split, dataset, bucket_id, path`` (below the
    root), ``part`` (numbered within its bucket), ``n_rows`` and ``unique_query_ids``; the manifest is returned. Raises if the path
    exists, unless told to overwrite, and if not all rows arrived."""
    spark = df.sparkSession
    if _exists(spark, path) and not overwrite:
        raise ContractError(f"{path} exists")
    df.write.mode("overwrite").partitionBy("split", "dataset", "bucket_id").option("compression", compression).parquet(path)
    back = spark.read.schema(df.schema).parquet(path).withColumn("path", F.regexp_extract("_metadata.file_path", "(split=.*)$", 1))
    m = back.groupBy("split", "dataset", "bucket_id", "path").agg(F.count("*").alias("n_rows"), F.count_distinct("query_id").alias("unique_query_ids"))
    m = m.withColumn("part", F.row_number().over(W.partitionBy("split", "dataset", "bucket_id").orderBy("path")) - 1)
    m.orderBy("split", "dataset", "bucket_id", "part").coalesce(1).write.json(f"{path}/_manifest")
    m = spark.read.json(f"{path}/_manifest")
    require_counts(processed=df.count(), written=m.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0])
    return m


def write_manifest(spark: SparkSession, path: str, **entries) -> None:
    """A manifest of plain values; tables of a bounded number of rows (shards, datasets, buckets) become lists of objects."""
    plain = {k: [r.asDict(True) for r in v.collect()] if isinstance(v, DataFrame) else v for k, v in entries.items()}
    spark.createDataFrame([(json.dumps(plain, ensure_ascii=False, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_manifest(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def shard_manifest(rows: DataFrame) -> DataFrame:
    """``(shard_id, row_count, dataset_counts)`` of rows with ``shard_id`` and ``dataset``; the counts by dataset as a map."""
    per = rows.groupBy("shard_id", F.coalesce("dataset", F.lit("")).alias("dataset")).agg(F.count("*").alias("n"))
    return per.groupBy("shard_id").agg(F.sum("n").alias("row_count"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("dataset", "n")))).alias("dataset_counts"))


def filter_manifest(scored: DataFrame, kept: DataFrame) -> DataFrame:
    """``(dataset, input_rows, output_rows)`` of a filter, a row for each dataset of its input."""
    n = lambda df, name: df.groupBy(F.coalesce("dataset", F.lit("")).alias("dataset")).agg(F.count("*").alias(name))
    return n(scored, "input_rows").join(n(kept, "output_rows"), "dataset", "left").fillna(0, ["output_rows"])


def embedding_manifest(vectors: DataFrame, texts: DataFrame) -> DataFrame:
    """``(dataset, kind, vectors, keys, dim, text_mismatches)``: the stored vectors and keys, and how many rows of
    ``texts(dataset, kind, n, mismatches)`` (:func:`millrace.operators.coverage.first_text`) have another text than their key's first."""
    v = vectors.groupBy("dataset", "kind").agg(F.count("*").alias("vectors"), F.count_distinct("id", "lang").alias("keys"), F.max(F.size("vector")).alias("dim"))
    m = texts.groupBy("dataset", "kind").agg(F.sum("mismatches").alias("text_mismatches"))
    return v.join(m, ["dataset", "kind"], "left").fillna(0, ["text_mismatches"])


def replace_table(df: DataFrame, path: str) -> None:
    """Write beside ``path``, then move into its place; the old table is there until the new one is complete."""
    spark = df.sparkSession
    fresh, old = f"{path}.new", f"{path}.old"
    df.write.mode("overwrite").parquet(fresh)
    to = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    fs = to(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(to(old), True)
    if fs.exists(to(path)):
        fs.rename(to(path), to(old))
    fs.rename(to(fresh), to(path))
    fs.delete(to(old), True)


def write_conflicts(resolved: DataFrame, path: str) -> None:
    """Append the conflicts of :func:`millrace.operators.store.resolve` as JSON lines."""
    resolved.where("outcome = 'conflict'").select("dataset", "kind", "id", "lang", "source_shard").write.mode("append").json(path)


def write_run(run: DataFrame, path: str) -> None:
    """JSON objects ``{query: {document: score}}``, a line for each query, which :func:`millrace.sources.tables.read_run` reads as it
    reads one object over all queries; a query's list is of bounded length."""
    docs = F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col("doc_id").cast("string").alias("doc_id"), F.col("score").cast("double").alias("score")))))
    one = run.groupBy(F.col("query_id").cast("string").alias("query_id")).agg(docs.alias("docs"))
    one.select(F.to_json(F.map_from_arrays(F.array("query_id"), F.array("docs"))).alias("value")).write.text(path)


def write_run_object(run: DataFrame, path: str) -> None:
    """One JSON object over all queries in one file, for tools that read that: a run of some thousand queries, never a corpus."""
    docs = F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col("doc_id").cast("string").alias("doc_id"), F.col("score").cast("double").alias("score")))))
    one = run.groupBy(F.col("query_id").cast("string").alias("query_id")).agg(F.to_json(docs).alias("docs"))
    quoted = F.expr("substr(to_json(array(query_id)), 2, length(to_json(array(query_id))) - 2)")
    whole = one.select(F.concat(quoted, F.lit(": "), "docs").alias("e")).agg(F.concat(F.lit("{"), F.array_join(F.sort_array(F.collect_list("e")), ", "), F.lit("}")).alias("value"))
    whole.coalesce(1).write.text(path)


def write_mined(nested: DataFrame, path: str, form: str = "json") -> None:
    """Records of mined negatives (``query_id, query, positive_ids, hard_negatives``, :data:`millrace.schema.MINED`) as JSON lines or
    Parquet, as :func:`millrace.sources.tables.read_mined` reads them. Columns that are missing are null."""
    if "hard_negatives" in nested.columns:
        have, want = nested.schema["hard_negatives"].dataType.elementType.names, MINED["hard_negatives"].dataType.elementType.fields
        one = lambda h: F.struct(*((h[f.name] if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in want))
        nested = nested.withColumn("hard_negatives", F.transform("hard_negatives", one))
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in nested.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in MINED.fields]
    w = nested.select(*cols).write
    w.option("ignoreNullFields", False).json(path) if form == "json" else w.parquet(path)


def write_metrics(df: DataFrame, path: str, form: str = "json", mode: str = "append") -> None:
    w = df.coalesce(1).write.mode(mode)
    w.json(path) if form == "json" else w.option("header", True).csv(path)
