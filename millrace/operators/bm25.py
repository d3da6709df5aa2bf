"""First-stage retrieval: BM25 over an inverted index made of DataFrames."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import Scratch, small

#: Queries with up to this many terms in all travel to the corpus, a document being scored for all of them at once; beyond
#: that postings and query terms are joined by shuffle.
MOST_TERMS = 500_000
#: Scores of documents and queries that a worker holds at a time.
CELLS = 4_000_000


def analyze(c) -> Column:
    """Lower-case runs of letters and digits; the default analyzer. Null: none."""
    return F.regexp_extract_all(F.lower(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))), F.lit(r"([\p{L}\p{N}]+)"), 1)


def _counted(schema_id: str, terms: dict | None):
    """Each document's distinct terms with their counts, and its length; only known terms, by number, if ``terms`` are given."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if terms is None else terms.value
        for b in batches:
            lens, names, counts = [], [], []
            for words in b.column(1).to_pylist():
                lens.append(len(words))
                n = Counter(words) if known is None else Counter(known[w] for w in words if w in known)
                names.append(list(n))
                counts.append(list(n.values()))
            kind = pa.string() if known is None else pa.int32()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lens, pa.int32()), pa.array(names, pa.list_(kind)), pa.array(counts, pa.list_(pa.int32()))], ["doc_id", "len", "terms", "tf"])

    return f, f"doc_id {schema_id}, len int, terms array<{'string' if terms is None else 'int'}>, tf array<int>"


def bm25(corpus: DataFrame, queries: DataFrame, k: int = 100, k1: float = 1.2, b: float = 0.75, analyzer=analyze, places: int = 6, most_terms: int = MOST_TERMS) -> DataFrame:
    """``(query_id, doc_id, score, rk)``: the ``k`` best documents of each query, ties to the smaller id.

    ``corpus(doc_id, text)`` and ``queries(query_id, text)``. The corpus is read and analysed once, into an index of the terms that
    queries have; a term of the query counts as often as it occurs in it. While the queries are few (``most_terms``) each task
    scores its documents for all of them and passes on ``k`` a query; else postings are joined with the queries by term.
    Documents without a term of the query are no result. Of rows with one document id the best counts. Scores are
    rounded, so that ties are ties on any cluster."""
    spark = corpus.sparkSession
    tmp = Scratch(spark, "bm25")
    q = tmp.cut(queries.select("query_id", F.explode(analyzer("text")).alias("term")).groupBy("query_id", "term").agg(F.count("*").alias("qtf")))
    docs = corpus.select("doc_id", analyzer("text").alias("w"))
    kinds = {"doc": dict(corpus.dtypes)["doc_id"], "query": dict(queries.dtypes)["query_id"]}
    if q.count() <= most_terms:
        rows = q.collect()
        terms = {t: i for i, t in enumerate(sorted({r["term"] for r in rows}))}
        f, schema = _counted(kinds["doc"], spark.sparkContext.broadcast(terms))
        index = tmp.cut(docs.mapInArrow(f, schema))
        n_docs, avg_len = index.agg(F.count("*"), F.avg("len")).first()  # two numbers
        df = np.zeros(len(terms))
        for r in index.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("n")).collect():  # a row for each query term
            df[r["t"]] = r["n"]
        found = index.mapInArrow(_scored(rows, terms, df, n_docs, avg_len, k, k1, b, places, spark, to_arrow_type(queries.schema["query_id"].dataType)), f"query_id {kinds['query']}, doc_id {kinds['doc']}, score double")
    else:
        f, schema = _counted(kinds["doc"], None)
        index = tmp.cut(docs.mapInArrow(f, schema).withColumn("row", F.monotonically_increasing_id()))
        n_docs, avg_len = index.agg(F.count("*"), F.avg("len")).first()
        postings = index.select("row", "doc_id", "len", F.explode(F.arrays_zip("terms", "tf")).alias("x")).select("row", "doc_id", "len", F.col("x.terms").alias("term"), F.col("x.tf").alias("tf"))
        postings = postings.join(small(tmp.cut(q.select("term").distinct()), MOST_TERMS), "term", "left_semi")
        norm = F.lit(k1) * (1 - b + b * F.col("len") / F.lit(float(avg_len or 1.0)))
        postings = tmp.cut(postings.select("term", "row", "doc_id", (F.col("tf") / (F.col("tf") + norm)).alias("w")))
        df = postings.groupBy("term").agg(F.count("*").alias("df"))
        idf = F.log(1 + (F.lit(n_docs) - F.col("df") + 0.5) / (F.col("df") + 0.5))
        weights = q.join(df, "term").select("query_id", "term", (idf * F.col("qtf")).alias("idf"))
        found = postings.join(weights, "term").groupBy("query_id", "row", "doc_id").agg(F.round(F.sum(F.col("w") * F.col("idf")), places).alias("score"))
    found = found.groupBy("query_id", "doc_id").agg(F.max("score").alias("score"))
    return found.withColumn("rk", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))).where(F.col("rk") <= k)


def _scored(rows, terms: dict, df: np.ndarray, n_docs: int, avg_len: float, k: int, k1: float, b: float, places: int, spark, id_type):
    """The ``k`` best documents of a task for each query."""
    names = sorted({r["query_id"] for r in rows}, key=lambda x: (x is None, x))
    number = {x: i for i, x in enumerate(names)}
    t, q = np.array([terms[r["term"]] for r in rows], np.int64), np.array([number[r["query_id"]] for r in rows], np.int64)
    idf = np.log(1 + (n_docs - df + 0.5) / (df + 0.5))
    order = np.argsort(t, kind="stable")
    weight = (idf[t] * np.array([r["qtf"] for r in rows], float))[order]
    start = np.searchsorted(t[order], np.arange(len(terms) + 1))
    shared = spark.sparkContext.broadcast((names, q[order], weight, start))
    avg_len = float(avg_len or 1.0)

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, of_query, weight, start = shared.value
        most, best = len(names), None  # best: query, score, document
        kind = None
        for whole in batches:
            kind = whole.schema
            step = max(1, CELLS // max(1, most))
            for at in range(0, whole.num_rows, step):
                part = whole.slice(at, step)
                size = part.column(2).value_lengths().to_numpy(zero_copy_only=False)
                term, tf = (part.column(i).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3))
                length = part.column(1).to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(part.num_rows), size)
                w = tf / (tf + k1 * (1 - b + b * length[doc] / avg_len))
                n = start[term + 1] - start[term]  # queries with the term
                cell = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[term], n)
                key = of_query[cell] * part.num_rows + np.repeat(doc, n)
                score = np.round(np.bincount(key, np.repeat(w, n) * weight[cell], minlength=most * part.num_rows), places)
                held = np.zeros(most * part.num_rows, bool)
                held[key] = True
                hit = np.nonzero(held)[0]
                hit = hit[_promising(hit // part.num_rows, score[hit], k)]
                ids = np.array(part.column(0).to_pylist() + [None], object)[:-1]
                here = (hit // part.num_rows, score[hit], ids[hit % part.num_rows])
                best = _first(here if best is None else tuple(np.concatenate([x, y]) for x, y in zip(best, here)), k)
        if best is not None and len(best[0]):
            yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in best[0]], id_type), pa.array(list(best[2]), kind.field(0).type), pa.array(best[1])], ["query_id", "doc_id", "score"])

    return f


def _promising(q: np.ndarray, s: np.ndarray, k: int) -> np.ndarray:
    """Which rows score at least as much as the ``k``-th of their query."""
    order = np.lexsort((-s, q))
    qs, ss = q[order], s[order]
    last = np.minimum(np.searchsorted(qs, qs) + k, np.searchsorted(qs, qs, "right")) - 1
    return order[ss >= ss[last]]


def _first(rows: tuple, k: int) -> tuple:
    """Of ``query, score, document`` the first ``k`` of each query: by score, then document."""
    q, s, d = rows
    place = {x: i for i, x in enumerate(sorted(set(d), key=lambda x: (x is not None, x)))}  # null first, as in the window over all tasks
    rank = np.array([place[x] for x in d], np.int64)
    order = np.lexsort((rank, -s, q))
    q, s, d = q[order], s[order], d[order]
    n = np.arange(len(q)) - np.searchsorted(q, q)
    return q[n < k], s[n < k], d[n < k]
