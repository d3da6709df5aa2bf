"""Problem 6: evaluation texts leaking into training text.

A positional inverted index of the corpus (term, document, positions) is restricted to terms that test items
hold. Each window of consecutive item words is looked up by its two rarest terms: their posting lists, each
shifted by the term's offset in the item, are intersected, which leaves few candidates; for these all postings
are compared at the same shift, and runs of consecutive words give the exact phrases. Proximity matches come from
the lists of some more rare terms, intersected within a slop.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import Scratch, small
from . import charform

#: Terms of test items up to this number travel to the executors as one array of 8-byte hashes (4 MB at most), and
#: tables with as many rows are broadcast; beyond it both are joined by shuffle.
MOST_TERMS = 500_000


class _Terms(dict):
    """Word to signed 64-bit hash, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word) - (1 << 63)
        return h


def postings(texts: DataFrame, id_col: str, text_col: str = "text", only=None) -> DataFrame:
    """``(id, term, pos)``: one row per word of each text, 0-based. ``only``: a Spark broadcast of the sorted
    term hashes to keep. Null and empty texts have no postings."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = _Terms()
        keep = None if only is None else only.value
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            texts = b.column(1).to_pylist()
            for at in range(0, len(texts), 500):  # bounded rows a batch, however long the texts
                of, found = [], []
                for t in texts[at : at + 500]:
                    w = charform.words(t)
                    of.append(len(w))
                    found.extend([terms[x] for x in w])
                n = np.asarray(of, np.int64)
                term = np.asarray(found, np.int64)
                pos = np.arange(len(term)) - np.repeat(np.cumsum(n) - n, n)
                who = np.repeat(ids[at : at + 500], n)
                if keep is not None and len(keep):
                    k = np.minimum(np.searchsorted(keep, term), len(keep) - 1)
                    on = keep[k] == term
                    term, pos, who = term[on], pos[on], who[on]
                elif keep is not None:
                    term, pos, who = term[:0], pos[:0], who[:0]
                yield pa.RecordBatch.from_arrays([pa.array(who, b.schema.field(0).type), pa.array(term), pa.array(pos.astype(np.int32))], ["id", "term", "pos"])

    rows = texts.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")).where("id is not null and t is not null")
    return rows.mapInArrow(emit, f"id {dict(rows.dtypes)['id']}, term bigint, pos int")


def store_index(documents: DataFrame, path: str, doc_id: str = "doc_id", text_col: str = "text", buckets: int = 256) -> DataFrame:
    """Write the positional index of all words of ``documents`` to ``path``, in folders of hashed terms and sorted by term, and
    return it: looking up some terms reads their row groups only. :func:`leaked_passages` takes it as ``index``."""
    rows = postings(documents, doc_id, text_col).withColumn("bucket", F.pmod("term", F.lit(buckets)).cast("int"))
    # a term with a tenth of all words is dealt to several files by document
    rows.repartition(F.col("bucket"), F.pmod(F.xxhash64("id"), F.lit(8))).sortWithinPartitions("bucket", "term", "id").write.partitionBy("bucket").option("compression", "zstd").parquet(path)
    return documents.sparkSession.read.parquet(path)


class _Lookup:
    """What a search needs of both sides: ``words(item, term, pos)``, ``index(term, id, pos)`` restricted to the items' terms, and
    ``known``: the words with their number of postings in the corpus."""

    def __init__(self, spark: SparkSession, documents: DataFrame | None, items: DataFrame, doc_id: str, item_id: str, text_col: str, index: DataFrame | None):
        self.tmp = tmp = Scratch(spark, "p6")
        items = items.select(item_id, text_col).distinct()
        self.words = tmp.cut(postings(items, item_id, text_col).withColumnRenamed("id", "item").distinct())
        vocabulary = self.words.select("term").distinct()
        few = vocabulary.count() <= MOST_TERMS
        if index is None:
            only = None
            if few:
                only = spark.sparkContext.broadcast(np.sort(np.array([r[0] for r in vocabulary.collect()], np.int64)))
            index = postings(documents, doc_id, text_col, only)
        elif few:
            index = index.join(F.broadcast(vocabulary), "term", "left_semi")
        if not few:
            index = index.join(vocabulary, "term", "left_semi")
        self.index = tmp.cut(index.select("term", "id", "pos"))
        df = small(tmp.cut(self.index.groupBy("term").agg(F.count("*").alias("df"))), MOST_TERMS)
        known = self.words.withColumnRenamed("pos", "off").join(df, "term", "left").withColumn("df", F.coalesce("df", F.lit(0)))
        self.known = known.withColumn("n", F.count("*").over(W.partitionBy("item")))

    def windows(self, window: int) -> DataFrame:
        """``(item, n, w)``: of each ``window`` consecutive words (all, if there are fewer) their structs of df, term and offset,
        the rarest first."""
        by = W.partitionBy("item").orderBy("off")
        ranked = F.sort_array(F.collect_list(F.struct("df", "term", "off")).over(by.rowsBetween(0, window - 1)))
        return self.known.withColumn("w", ranked).where(f"size(w) = least({window}, n)").select("item", "n", "w")


def _exact(x: _Lookup, window: int) -> DataFrame:
    tmp, index, words = x.tmp, x.index, x.words
    # the two rarest terms of each window; windows that share both, and their shift, are looked up once
    windows = x.windows(window).select("item", "n", F.col("w")[0].alias("a"), F.col("w")[F.when(F.size("w") > 1, 1).otherwise(0)].alias("b"))
    anchors = windows.where("a.df > 0 and b.df > 0").select("item", "n", F.col("a.term").alias("term"), F.col("a.off").alias("off_a"), F.col("b.term").alias("term_b"), F.col("b.off").alias("off_b")).distinct()
    anchors = small(tmp.cut(anchors), MOST_TERMS)
    first = index.join(anchors, "term").select("id", "item", "n", (F.col("pos") - F.col("off_a")).alias("shift"), F.col("term_b").alias("term"), (F.col("pos") - F.col("off_a") + F.col("off_b")).alias("pos"))
    second = index.join(small(anchors.select(F.col("term_b").alias("term")).distinct(), MOST_TERMS), "term", "left_semi")
    candidates = tmp.cut(first.join(second, ["term", "id", "pos"], "left_semi").select("id", "item", "n", "shift").distinct())

    # all words of the candidates at their shift; runs of consecutive positions
    of_docs = index.join(small(candidates.select("id").distinct(), MOST_TERMS), "id", "left_semi")
    at = words.select("item", "term", F.col("pos").alias("off"))
    agree = candidates.join(at, "item").withColumn("pos", F.col("shift") + F.col("off")).join(of_docs, ["id", "term", "pos"])
    shift = W.partitionBy("id", "item", "shift")
    agree = agree.select("id", "item", "n", "shift", "off").distinct().withColumn("matched", F.count("*").over(shift))
    agree = agree.withColumn("island", F.col("off") - F.row_number().over(shift.orderBy("off")))
    runs = agree.groupBy("id", "item", "n", "shift", "matched", "island").agg(F.count("*").alias("run"), F.min("off").alias("item_from")).where(f"run >= least({window}, n)")
    best = runs.groupBy("id", "item", "n").agg(F.max(F.struct("run", "matched", (-F.col("item_from")).alias("from"), (-F.col("shift")).alias("by"))).alias("m"))
    return best.select(
        F.col("id").alias("doc_id"), F.col("item").alias("item_id"), (-F.col("m.from") - F.col("m.by")).cast("int").alias("doc_from"), (-F.col("m.from")).cast("int").alias("item_from"),
        F.col("m.run").alias("run"), F.col("n").alias("item_words"), F.col("m.matched").alias("matched"),
    )


def near_rows(window: int, share: float, slop: int):
    """Of rows ``id, item, n, centres, offs, terms, at`` (the item's words, and the document's as structs of term and position) the
    best proximity match around one of the centres, if it has enough words."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, out = [], []
            numbers = [b.column(2).to_pylist(), *(_arrays(b.column(i)) for i in (3, 4, 5)), *(_arrays(c) for c in _fields(b.column(6)))]
            for i, (n, centres, offs, terms, doc_terms, doc_at) in enumerate(zip(*numbers)):
                need = int(np.ceil(round(min(window, n) * share, 6)))
                order = np.argsort(doc_terms, kind="stable")
                lo, hi = np.searchsorted(doc_terms[order], terms), np.searchsorted(doc_terms[order], terms, "right")
                k = np.repeat(np.arange(len(terms)), hi - lo)
                pos = doc_at[order[np.arange(len(k)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + lo[k]]]
                off = offs[k]
                best = None
                for c in centres:
                    ok = np.abs(pos - off - c) <= slop
                    first = np.full(n, np.iinfo(np.int64).max)
                    np.minimum.at(first, off[ok], pos[ok])
                    there = np.nonzero(first < np.iinfo(np.int64).max)[0]
                    runs = np.searchsorted(there, there + window) - np.arange(len(there))
                    if len(runs) and runs.max() >= need:
                        o = int(there[runs.argmax()])
                        got = (int(runs.max()), len(there), -o, -int(first[o]))
                        best = got if best is None else max(best, got)
                if best:
                    rows.append(i)
                    out.append((-best[3], -best[2], best[0], n, best[1]))
            take = pa.array(rows, pa.int64())
            cols = [pa.array([x[j] for x in out], pa.int32() if j in (0, 1) else pa.int64()) for j in range(5)]
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), *cols], ["doc_id", "item_id", "doc_from", "item_from", "run", "item_words", "matched"])

    return f


def _arrays(lists) -> list[np.ndarray]:
    flat, ends = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    return np.split(flat, ends[:-1]) if len(ends) else []


def _fields(structs) -> list:
    """The two fields of a list of structs as lists of numbers."""
    return [pa.ListArray.from_arrays(pc.subtract(structs.offsets, structs.offsets[0]), structs.flatten().field(i)) for i in (0, 1)]


def _near(x: _Lookup, window: int, share: float, slop: int) -> DataFrame:
    tmp, index = x.tmp, x.index
    size = F.least(F.lit(window), F.col("n"))
    need = F.ceil(F.round(size * F.lit(share), 6))
    # size - need words of a window may lack: of two more than these two are there, the rarest are taken
    rare = x.windows(window).where("n > 1").select("item", "n", F.explode(F.slice("w", 1, (size - need + 2).cast("int"))).alias("a"))
    rare = rare.where("a.df > 0").select("item", "n", F.col("a.term").alias("term"), F.col("a.off").alias("off")).distinct()
    found = index.join(small(tmp.cut(rare), MOST_TERMS), "term").select("id", "item", "n", "off", (F.col("pos") - F.col("off")).alias("shift"))
    around = W.partitionBy("id", "item").orderBy("shift").rangeBetween(-slop, slop)
    found = found.withColumn("lo", F.min("off").over(around)).withColumn("hi", F.max("off").over(around)).where("lo < hi")
    candidates = tmp.cut(found.groupBy("id", "item", "n").agg(F.sort_array(F.collect_set("shift")).alias("centres")))

    texts = x.words.groupBy("item").agg(F.sort_array(F.collect_list(F.struct(F.col("pos").alias("off"), "term"))).alias("w"))
    texts = texts.select("item", F.col("w.off").alias("offs"), F.col("w.term").alias("terms"))
    docs = index.join(small(candidates.select("id").distinct(), MOST_TERMS), "id", "left_semi").groupBy("id").agg(F.collect_list(F.struct("term", "pos")).alias("at"))  # as long as the document
    both = candidates.join(texts, "item").join(docs, "id").select("id", "item", "n", "centres", "offs", "terms", "at")
    kinds = dict(both.dtypes)
    return both.mapInArrow(near_rows(window, share, slop), f"doc_id {kinds['id']}, item_id {kinds['item']}, doc_from int, item_from int, run long, item_words long, matched long")


def leaked_passages(spark: SparkSession, documents: DataFrame | None, items: DataFrame, window: int = 12, doc_id: str = "doc_id", item_id: str = "item_id", text_col: str = "text", index: DataFrame | None = None) -> DataFrame:
    """``(doc_id, item_id, doc_from, item_from, run, item_words, matched)``: for each document and item of which the
    document holds ``window`` consecutive words without gap (or the whole item if it is shorter), the longest such
    run: where it begins in both, its length, the item's length, and the words that agree at that shift in all.

    Character form and case are set aside. Null or empty texts, and items without words, match nothing. Repeated
    item or document ids are read as one text after the other only if their texts differ; equal rows count once. With an
    ``index`` of :func:`store_index` the documents aren't read."""
    return _exact(_Lookup(spark, documents, items, doc_id, item_id, text_col, index), window)


def passages(spark: SparkSession, documents: DataFrame | None, items: DataFrame, window: int = 12, share: float = 0.8, slop: int = 3, doc_id: str = "doc_id", item_id: str = "item_id", text_col: str = "text", index: DataFrame | None = None) -> DataFrame:
    """The rows of :func:`leaked_passages` with ``match`` = ``exact``, and those with ``match`` = ``proximity``: of some
    ``window`` consecutive words of the item (of all, if there are fewer) at least ``share`` occur in the document, each at most
    ``slop`` positions off the place that one of the item's rare words gives it, where a second one is within the slop (rare: among
    the rarest of a window, so many that two must be there); so words may be inserted, dropped, changed or swapped. ``run`` is then the number of these words, ``matched`` that of all words of the item within the slop.

    A document and item with an exact match have that row only. An item of one word has no proximity. Where several places
    of a document match, the one with most words counts (ties: the earliest of the item, then of the document)."""
    x = _Lookup(spark, documents, items, doc_id, item_id, text_col, index)
    exact = x.tmp.cut(_exact(x, window))
    near = _near(x, window, share, slop).join(exact, ["doc_id", "item_id"], "left_anti")
    return exact.withColumn("match", F.lit("exact")).unionByName(near.withColumn("match", F.lit("proximity")))
