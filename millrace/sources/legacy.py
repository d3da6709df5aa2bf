"""Stores of vectors in NumPy and pickle files, imported and exported. The files are read and written by one process: for exchange
with tools that need them, never between steps of the engine. Unpickling runs code: only for files one trusts."""

from __future__ import annotations

import os
import pickle
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from ..functions.keys import normalize, safe_dataset_name
from .sqlite import SCHEMA, read_pickled, split_key


def _load(path: str):
    if path.endswith(".npy"):
        return np.load(path, allow_pickle=True)
    with open(path, "rb") as f:
        return pickle.load(f)


def _frame(spark: SparkSession, rows: Iterator[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), SCHEMA)


def read_embedding_folder(spark: SparkSession, folder: str, dataset: str = "", source_shard: int = 0) -> DataFrame:
    """A folder with ``passage_embeddings.npy``, ``query_embeddings.npy`` and ``metadata.pkl`` (keys and languages in the order of the
    rows) as vectors. Raises if keys and rows aren't equally many."""
    meta = _load(f"{folder}/metadata.pkl")

    def rows():
        for kind, keys, langs, file in (("passage", "p_keys", "passage_langs", "passage_embeddings.npy"), ("query", "q_keys", "query_langs", "query_embeddings.npy")):
            x = np.load(f"{folder}/{file}").astype(np.float32)
            if not len(x) == len(meta[keys]) == len(meta[langs]):
                raise ValueError(f"{file} has {len(x)} rows; {len(meta[keys])} keys and {len(meta[langs])} languages")
            for key, lang, v in zip(meta[keys], meta[langs], x):
                yield (str(key), lang or "", dataset, kind, v.tolist(), len(v), source_shard)

    return _frame(spark, rows())


def read_query_vectors(spark: SparkSession, folder: str, source_shard: int = 0) -> DataFrame:
    """The scoped map ``query_embedding.pkl`` of a shard's folder; where it is missing the older ``query_embedding_by_text.pkl``, whose keys
    are texts (read as ids without language and dataset). Raises if there is neither."""
    if os.path.exists(f"{folder}/query_embedding.pkl"):
        return read_pickled(spark, f"{folder}/query_embedding.pkl", "query", source_shard)
    if not os.path.exists(f"{folder}/query_embedding_by_text.pkl"):
        raise FileNotFoundError(f"no map of query vectors in {folder}")
    table = _load(f"{folder}/query_embedding_by_text.pkl")
    return _frame(spark, ((*(split_key(k) if isinstance(k, tuple) else (str(k), "", "")), "query", np.asarray(v, np.float32).tolist(), len(v), source_shard) for k, v in table.items()))


def read_passage_places(spark: SparkSession, folder: str) -> DataFrame:
    """``(passage_id, lang, dataset, place)``: the row of each passage key in its index, from ``passage_key_to_faiss.pkl`` or, where that is
    missing, rebuilt from ``passages_id_map.npy`` (place to ``(passage_id, text, dataset, lang)``)."""
    if os.path.exists(f"{folder}/passage_key_to_faiss.pkl"):
        rows = [(*(str(x or "") for x in k), int(n)) for k, n in _load(f"{folder}/passage_key_to_faiss.pkl").items()]
    else:
        rows = [(*split_key(tuple(entry)), int(n)) for n, entry in _load(f"{folder}/passages_id_map.npy").item().items()]
    return spark.createDataFrame(rows, "passage_id string, lang string, dataset string, place long")


def write_pickled(resolved: DataFrame, folder: str) -> None:
    """What :func:`millrace.operators.store.resolve` wrote, as a dict ``(id, lang)`` to vector in ``<dataset>/<kind>_embeddings.pkl``. Rows
    arrive one at a time; one dataset and kind at a time is held, as the format demands."""
    kept = resolved.where("outcome = 'written'").select(safe_dataset_name("dataset").alias("file"), "kind", normalize("id").alias("id"), normalize("lang").alias("lang"), "embedding")
    groups = [(r["file"], r["kind"]) for r in kept.select("file", "kind").distinct().collect()]  # a row for each dataset and kind
    for file, kind in sorted(groups):
        of = {(r["id"], r["lang"]): np.asarray(r["embedding"], np.float32) for r in kept.where((kept["file"] == file) & (kept["kind"] == kind)).toLocalIterator()}
        os.makedirs(f"{folder}/{file}", exist_ok=True)
        with open(f"{folder}/{file}/{kind}_embeddings.pkl", "wb") as f:
            pickle.dump(of, f, protocol=pickle.HIGHEST_PROTOCOL)
