"""Stored vectors of the older layouts: SQLite files and NumPy/pickle folders, imported to tables."""

from __future__ import annotations

import pickle
import sqlite3

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "id string, lang string, dataset string, kind string, embedding array<float>, dim int, source_shard int"


class SqliteVectors(DataSource):
    """``spark.read.format("sqlite_vectors").option("dataset", d).option("kind", k).load(path)`` over a file with the table
    ``embeddings(id, lang, embedding blob, dtype, dim, source_shard)``; read in ranges of row numbers."""

    @classmethod
    def name(cls) -> str:
        return "sqlite_vectors"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path, self.dataset, self.kind = options["path"], options.get("dataset", ""), options.get("kind", "passage")
        self.step = int(options.get("rows", 50_000))

    def _open(self):
        return sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)

    def partitions(self):
        with self._open() as db:
            lo, hi = db.execute("select coalesce(min(rowid), 0), coalesce(max(rowid), -1) from embeddings").fetchone()
        return [InputPartition((at, at + self.step)) for at in range(lo, hi + 1, self.step)] or [InputPartition((0, 0))]

    def read(self, partition):
        with self._open() as db:
            for i, lang, blob, dtype, dim, shard in db.execute("select id, lang, embedding, dtype, dim, source_shard from embeddings where rowid >= ? and rowid < ?", partition.value):
                v = None if blob is None else np.frombuffer(blob, np.dtype(dtype or "float32")).astype(np.float32)
                if v is not None and dim is not None and len(v) != dim:
                    raise ValueError(f"vector of {i!r} has {len(v)} numbers; its row says {dim}")
                yield (i, lang, self.dataset, self.kind, None if v is None else v.tolist(), dim, shard)


def read_sqlite(spark: SparkSession, path: str, dataset: str, kind: str) -> DataFrame:
    spark.dataSource.register(SqliteVectors)
    return spark.read.format("sqlite_vectors").option("dataset", dataset).option("kind", kind).load(path)


def write_sqlite(vectors: DataFrame, path: str) -> None:
    """The vectors of one dataset and kind to one SQLite file; rows arrive one at a time. Export only, for tools that read this
    layout; tables within the engine are Parquet."""
    with sqlite3.connect(path) as db:
        db.execute("create table if not exists embeddings (id text, lang text, embedding blob, dtype text, dim int, source_shard int, primary key (id, lang))")
        for r in vectors.select("id", "lang", "embedding", "source_shard").toLocalIterator():
            v = np.asarray(r["embedding"], np.float32)
            db.execute("insert or ignore into embeddings values (?, ?, ?, 'float32', ?, ?)", (r["id"], r["lang"] or "", v.tobytes(), len(v), r["source_shard"]))


def split_key(key: tuple) -> tuple[str, str, str]:
    """``(id, lang, dataset)`` of a stored key; four-part keys are ``(id, text, dataset, lang)``."""
    parts = tuple("" if x is None else str(x) for x in key)
    if len(parts) == 4:
        return parts[0], parts[3], parts[2]
    if len(parts) == 3:
        return parts
    raise ValueError(f"a key of {len(parts)} parts")


def read_pickled(spark: SparkSession, path: str, kind: str, source_shard: int = 0) -> DataFrame:
    """A pickled (or NumPy-saved) dict of key to vector. Import only, through the driver; for files one trusts, as unpickling runs code."""
    if path.endswith(".npy"):
        table = np.load(path, allow_pickle=True).item()
    else:
        with open(path, "rb") as f:
            table = pickle.load(f)
    rows = [(*split_key(k), kind, np.asarray(v, np.float32).tolist(), len(v), source_shard) for k, v in table.items()]
    rows = [(i, lang, dataset, k, v, n, s) for i, lang, dataset, k, v, n, s in rows]
    return spark.createDataFrame(rows, SCHEMA)
