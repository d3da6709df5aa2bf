"""Readers."""

from __future__ import annotations

import os
import tomllib
from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..schema import MINED, PAIR, VECTOR, ContractError, require_columns, require_empty


def read_pairs(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """All Parquet files of a folder as pairs of strings, with ``source_file`` (the file's name without ``.parquet``).
    Raises if there is none or an identity column is missing."""
    try:
        df = spark.read.option("recursiveFileLookup", str(recursive).lower()).parquet(path)
    except AnalysisException as e:
        raise ContractError(f"no Parquet files in {path}") from e
    require_columns(df, ["query_id", "passage_id", "lang", "dataset"])
    cols = [F.col(c).cast("string").alias(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in PAIR.names]
    return df.select(*cols, F.regexp_extract("_metadata.file_name", r"^(.*?)(\.parquet)?$", 1).alias("source_file"))


def read_shards(spark: SparkSession, path: str, shards: list[int] | None = None, first: int | None = None, pattern: str | None = None) -> DataFrame:
    """A table partitioned by ``shard_id``: all of it, the named shards, or the ``first`` so many; only their folders are listed
    and read. With a ``pattern`` (such as ``group_*/shard_*.parquet``) the files that match it, with ``shard_id`` from their name."""
    if pattern is not None:
        df = spark.read.parquet(f"{path}/{pattern}")
        df = df.withColumn("shard_id", F.regexp_extract("_metadata.file_path", r"shard[_=-]?0*(\d+)[^/]*(/[^/]*)?$", 1).cast("int"))
    else:
        df = spark.read.parquet(path)
    if shards is not None:
        return df.where(F.col("shard_id").isin(*shards))
    return df if first is None else df.where(F.col("shard_id") < first)


def count_rows(df: DataFrame) -> int:
    """From the footers where the source can (``spark.sql.parquet.aggregatePushdown``)."""
    return df.count()


def read_vectors(spark: SparkSession, path: str, dataset: list[str] | None = None, kind: str | None = None) -> DataFrame:
    df = require_columns(spark.read.parquet(path), VECTOR.names)
    if dataset is not None:
        df = df.where(F.col("dataset").isin(*dataset))
    return df if kind is None else df.where(F.col("kind") == kind)


def read_mined(spark: SparkSession, folder: str, *names: str) -> DataFrame:
    """The first of the candidate names that exists, as records of mined negatives; none: an empty table."""
    for n in names:
        for suffix in (".json", ".parquet", ""):
            where = f"{folder}/{n}{suffix}"
            path = spark._jvm.org.apache.hadoop.fs.Path(where)
            if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
                if suffix == ".parquet":
                    return spark.read.parquet(where)
                first = spark.read.text(where).where("trim(value) <> ''").limit(1).collect()
                lines = bool(first) and first[0][0].lstrip().startswith("{") and first[0][0].rstrip().endswith("}")
                return spark.read.option("multiLine", not lines).schema(MINED).json(where)
    return spark.createDataFrame([], MINED)


def read_run(spark: SparkSession, path: str) -> DataFrame:
    """JSON objects query -> document -> score as ``(query_id, doc_id, score)``: one over all queries, or one a line. A score that is
    null is no result."""
    lines = spark.read.text(path).where("trim(value) <> ''")
    top = lines.limit(1).collect()
    if top and not top[0][0].strip().endswith("}"):  # one object over several lines
        lines = spark.read.text(path, wholetext=True)
    m = lines.select(F.explode(F.from_json("value", "map<string,map<string,double>>")).alias("query_id", "docs"))
    return m.select("query_id", F.explode("docs").alias("doc_id", "score")).where("score is not null")


def _table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path) if path.endswith((".json", ".jsonl")) else spark.read.option("header", True).option("sep", "\t").csv(path) if path.endswith(".tsv") else spark.read.parquet(path)


def _renamed(df: DataFrame, **names: tuple[str, ...]) -> DataFrame:
    """Columns by the first of their names that is there."""
    cols = []
    for want, known in names.items():
        have = next((n for n in (want, *known) if n in df.columns), None)
        if have is None:
            raise ContractError(f"missing column: {want}")
        cols.append(F.col(have).alias(want))
    return df.select(*cols)


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, title, text)`` from Parquet or JSON lines; ids as strings, a missing title is empty."""
    df = _table(spark, path)
    if "title" not in df.columns:
        df = df.withColumn("title", F.lit(""))
    df = _renamed(df, doc_id=("_id", "id"), title=(), text=("contents",))
    return df.withColumn("doc_id", F.col("doc_id").cast("string")).withColumn("title", F.coalesce("title", F.lit("")))


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    """``(query_id, text)`` from Parquet or JSON lines; ids as strings."""
    return _renamed(_table(spark, path), query_id=("_id", "id"), text=("query",)).withColumn("query_id", F.col("query_id").cast("string"))


def read_qrels(spark: SparkSession, path: str) -> DataFrame:
    """``(query_id, doc_id, relevance)`` from Parquet, JSON lines or tab-separated text with a header."""
    df = _renamed(_table(spark, path), query_id=("query-id", "qid"), doc_id=("corpus-id", "docid"), relevance=("score", "label"))
    return df.select(F.col("query_id").cast("string").alias("query_id"), F.col("doc_id").cast("string").alias("doc_id"), F.col("relevance").cast("int").alias("relevance"))


def bucket_root(path: str, split: str | None = None) -> tuple[str, str]:
    """The root and the split of a bucketed table, given the root (and a split, else ``train``), a split's folder or the manifest."""
    path = path.rstrip("/")
    if path.endswith("/_manifest"):
        path = path[: -len("/_manifest")]
    head, _, last = path.rpartition("/")
    if last.startswith("split="):
        return head, split or last[len("split=") :]
    return path, split or "train"


def read_bucketed(spark: SparkSession, path: str, split: str | None = None, world_size: int | None = None, rank: int | None = None, assignment: DataFrame | None = None, check: bool = True) -> DataFrame:
    """One split of a bucketed table (see :func:`bucket_root`); the manifest beside it names the files and the rows that must be in
    each, else it raises. With a rank, its buckets only: by an ``assignment(dataset, bucket_id, rank)`` table or bucket modulo world
    size."""
    path, split = bucket_root(path, split)
    df = spark.read.option("basePath", path).parquet(f"{path}/split={split}")
    if check:
        want = spark.read.json(f"{path}/_manifest").where(F.col("split") == split).select("path", F.col("n_rows").alias("want"))
        have = df.groupBy(F.regexp_extract("_metadata.file_path", "(split=.*)$", 1).alias("path")).agg(F.count("*").alias("have"))
        require_empty(have.join(want, "path", "full").where("have is null or want is null or have <> want"), "files differ from the manifest")
    if rank is None:
        return df
    if assignment is None:
        return df.where(F.pmod("bucket_id", F.lit(world_size)) == rank)
    return df.join(F.broadcast(assignment.where(F.col("rank") == rank).select("dataset", "bucket_id")), ["dataset", "bucket_id"], "left_semi")  # as many rows as buckets


def read_plain_groups(spark: SparkSession, path: str) -> DataFrame:
    """All files of a folder, each a group of its own, named by its stem; empty files leave no group."""
    return spark.read.parquet(path).withColumn("dataset", F.regexp_extract("_metadata.file_name", r"^(.*?)(\.parquet)?$", 1))


def load_config(cls, path: str | None, section: str | None = None, **given):
    """A dataclass filled from given values, then from a TOML file, then from its defaults."""
    table = {}
    if path and os.path.exists(path):
        with open(path, "rb") as f:
            table = tomllib.load(f)
        table = table.get(section, {}) if section else table
    names = {f.name for f in fields(cls)}
    return cls(**({k: v for k, v in table.items() if k in names} | {k: v for k, v in given.items() if k in names and v is not None}))


def inspect_rows(spark: SparkSession, path: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows of a Parquet table for inspection, spread over all files by a seeded hash of ``key``."""
    from ..operators.quality import sample_rows

    return sample_rows(spark.read.parquet(path), key, n, seed)
