"""Batches for training: plain, without duplicates, their counts and schedule; negatives from the batch."""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.keys import hash60
from ..session import Scratch

#: Rows of a dataset that one task packs without duplicates.
CHUNK = 262_144


def batch_keys(df: DataFrame, row: str = "row") -> DataFrame:
    """``df`` with the ``anchor`` and ``positive`` keys that batches go by: the first of the columns ``query_key64, query_id, query, anchor``, and of
    ``positive_key64, positive_id, positive``, that isn't null in the row, else a key of the row's own."""
    own = F.concat(F.lit("row "), F.col(row).cast("string"))
    first = lambda *names: F.coalesce(*(F.col(n).cast("string") for n in names if n in df.columns), own)
    return df.withColumns({"anchor": first("query_key64", "query_id", "query", "anchor"), "positive": first("positive_key64", "positive_id", "positive")})


def ranked(df: DataFrame, by: list[str], order, out: str, chunk: int = 100_000) -> DataFrame:
    """Add the 0-based place of each row in the order of the 60-bit hash ``order`` within ``by``. A large group is dealt to
    ranges of the hash, ranked in each and offset by the counts before, so it is never sorted in one task."""
    df = df.withColumn("_o", order)
    n = df.groupBy(*by).agg(F.ceil(F.count("*") / chunk).alias("_n"))
    df = df.join(n, by).withColumn("_c", F.floor(F.col("_o") / (F.lit(float(1 << 60)) / F.col("_n"))))
    cells = df.groupBy(*by, "_c").agg(F.count("*").alias("_k"))
    cells = cells.withColumn("_b", F.coalesce(F.sum("_k").over(W.partitionBy(*by).orderBy("_c").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("_k")
    rest = [c for c in df.columns if c not in {*by, "_o", "_n", "_c"}]
    inside = F.row_number().over(W.partitionBy(*by, "_c").orderBy("_o", *rest))
    return df.withColumn("_i", inside).join(cells, [*by, "_c"]).withColumn(out, F.col("_b") + F.col("_i") - 1).drop("_o", "_n", "_c", "_i", "_b")


def plain_batches(df: DataFrame, key: str, size: int, seed: int = 42, epoch: int = 0, drop_last: bool = False) -> DataFrame:
    """``df(dataset, key, ...)`` with ``batch``: rows in the order of a hash of seed + epoch and key, cut every ``size``."""
    out = ranked(df, ["dataset"], hash60(F.lit(f"{seed + epoch}|"), key), "place").withColumn("batch", F.floor(F.col("place") / size))
    if drop_last:
        out = out.withColumn("_n", F.count("*").over(W.partitionBy("dataset", "batch"))).where(F.col("_n") == size).drop("_n")
    return out.drop("place")


def greedy_batches(queues: list[list[tuple]], size: int) -> list[list]:
    """Batches of rows from ``queues`` of ``(row, positive)``, each queue taken from its front. A batch is what a walk along the
    queues takes that stops at ``size`` rows and leaves out queues whose next positive it holds already.

    That is, for each positive the first queue that offers it, and of these the first ``size``. Queues are kept by the positive
    they offer, and positives by their first queue, in heaps: a row costs a logarithm, whatever is waiting."""
    queues = [q[::-1] for q in queues]
    offers: dict = {}  # positive: heap of the queues that offer it next
    for i, q in enumerate(queues):
        if q:
            offers.setdefault(q[-1][1], []).append(i)  # ascending, so a heap
    first = [(of[0], p) for p, of in offers.items()]
    order = {p: n for n, p in enumerate(offers)}  # positives needn't compare
    heap = [(i, order[p], p) for i, p in first]
    heapify(heap)
    out = []
    while heap:
        batch, moved, again = [], [], set()
        while heap and len(batch) < size:
            i, _, p = heappop(heap)
            of = offers.get(p)
            if p in again or not of or of[0] != i:  # in the batch already, or not this positive's first queue any more
                continue
            heappop(of)
            batch.append(queues[i].pop()[0])
            again.add(p)
            if queues[i]:
                moved.append(i)
        for i in moved:
            p = queues[i][-1][1]
            heappush(offers.setdefault(p, []), i)
            again.add(p)
        for p in again:
            if offers[p]:
                heappush(heap, (offers[p][0], order.setdefault(p, len(order)), p))
            else:
                del offers[p]
        if batch:
            out.append(batch)
    return out


def no_duplicate_batches(df: DataFrame, size: int, seed: int = 42, epoch: int = 0, drop_last: bool = False, chunk: int = CHUNK) -> DataFrame:
    """``df(dataset, row, anchor, positive)`` with ``chunk`` and ``batch``: in a batch no anchor and no positive occurs twice.

    Anchors are queues in seeded order, and :func:`greedy_batches` fills the batches; every batch takes at least one row, so
    it always ends. A dataset of more than ``chunk`` rows is dealt to chunks by a hash of the row and packed chunk by chunk; full
    batches are final, the rows of short ones are dealt again to as few chunks as hold them, until one is enough or most
    batches stay short because their keys repeat too often. So chunks cost no rows; with ``drop_last`` the short
    batches of the last round are dropped. Null keys count as keys of their own row. Rows without a dataset are a group of their own."""
    spark, tmp = df.sparkSession, None
    h = hash60(F.lit(f"{seed + epoch}|"), F.coalesce(F.col("anchor").cast("string"), F.concat(F.lit("row "), F.col("row").cast("string"))))
    rows = df.select("dataset", "row", "anchor", "positive").withColumn("_h", h)
    kinds, cols = dict(rows.dtypes), rows.columns
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in cols) + ", chunk long, batch long, full boolean"

    def pack(round_: int):
        def f(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["_h", "row"]).reset_index(drop=True)
            queues: dict = {}
            for at, (row, a, p) in enumerate(zip(pdf["row"], pdf["anchor"], pdf["positive"])):
                queues.setdefault(("row", row) if pd.isna(a) else a, []).append((at, ("row", row) if pd.isna(p) else p))
            made = greedy_batches(list(queues.values()), size)
            at = [i for b in made for i in b]
            out = pdf.iloc[at].copy()
            out["chunk"] = (round_ << 40) + pdf["_chunk"].iloc[0]
            out["batch"] = np.repeat(np.arange(len(made)), [len(b) for b in made])
            out["full"] = np.repeat([len(b) == size for b in made], [len(b) for b in made])
            return out[[*cols, "chunk", "batch", "full"]]

        return f

    final, left, round_ = None, rows, 0
    while True:
        n = left.groupBy("dataset").agg(F.count("*").alias("_all"))
        n = n.select(F.col("dataset").alias("_d"), F.ceil(F.col("_all") / chunk).alias("_n"))
        dealt = left.join(n, F.col("dataset").eqNullSafe(F.col("_d"))).withColumn("_chunk", F.pmod(F.xxhash64("row", F.lit(round_)), F.col("_n"))).drop("_d", "_n")
        packed = dealt.groupBy("dataset", "_chunk").applyInPandas(pack(round_), schema)
        most = n.agg(F.max("_n")).first()[0] or 1  # one number
        if most == 1:
            break
        tmp = tmp or Scratch(spark, "batches")
        packed = tmp.cut(packed)
        full = packed.where("full")
        final = full if final is None else final.unionByName(full)
        short = packed.where("not full").select(*cols)
        before, after = packed.count(), short.count()
        if not after or 10 * after > 9 * before:  # what is left repeats its keys too often
            packed = packed.where("not full")
            break
        left, round_ = short, round_ + 1
    out = packed.where("full") if drop_last else packed
    out = out if final is None else final.unionByName(out)
    return out.select("dataset", "row", "chunk", "batch")


def batch_counts(df: DataFrame, size: int, by: list[str], drop_last: bool = False) -> DataFrame:
    """The number of batches by rows alone."""
    n = F.count("*") / size
    return df.groupBy(*by).agg((F.floor(n) if drop_last else F.ceil(n)).alias("batches"))


def synchronised_counts(counts: DataFrame) -> DataFrame:
    """``(dataset, batches, mean, outcome)`` from ``counts(dataset, rank, batches)``: all ranks use the least; ``empty`` if
    that is 0, ``unbalanced`` if it is below half the mean, else ``ok``."""
    g = counts.groupBy("dataset").agg(F.min("batches").alias("batches"), F.round(F.avg("batches"), 9).alias("mean"))
    return g.withColumn("outcome", F.when(F.col("batches") == 0, "empty").when(F.col("batches") < F.col("mean") / 2, "unbalanced").otherwise("ok"))


def schedule(counts: DataFrame, seed: int = 42, epoch: int = 0) -> DataFrame:
    """``(step, dataset, batch)`` from ``counts(dataset, batches)``: one batch of one dataset a step, in the order of a hash of
    seed + epoch, dataset and number; the n-th step of a dataset gets its n-th batch."""
    steps = counts.where("batches > 0").select("dataset", F.explode(F.sequence(F.lit(0).cast("long"), F.col("batches").cast("long") - 1)).alias("i"))
    h = hash60(F.lit(f"{seed + epoch}|"), "dataset", F.lit("|"), "i")
    steps = ranked(steps.withColumn("_all", F.lit(0)), ["_all"], h, "step").drop("_all")
    return ranked(steps, ["dataset"], h, "batch").select("step", "dataset", "batch")


def in_batch_negatives(batched: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """``(dataset, batch, row, negative_row)``: for each row the positives of ``k`` other rows of its batch, by a seeded hash.
    Rows of the same anchor or positive, where ``batched`` has these columns, are no negatives. Batches are of bounded size,
    which bounds the self-join."""
    same = [c for c in ("anchor", "positive") if c in batched.columns]
    b = batched.select("dataset", "batch", "row", *same)
    other = b.select("dataset", "batch", F.col("row").alias("negative_row"), *(F.col(c).alias(f"_{c}") for c in same))
    pairs = b.join(other, ["dataset", "batch"]).where("row <> negative_row")
    for c in same:
        pairs = pairs.where(F.col(c).isNull() | F.col(f"_{c}").isNull() | (F.col(c) != F.col(f"_{c}")))
    pairs = pairs.select("dataset", "batch", "row", "negative_row")
    h = hash60(F.lit(f"{seed}|"), "row", F.lit("|"), "negative_row")
    w = W.partitionBy("dataset", "batch", "row").orderBy(h, "negative_row")
    return pairs.withColumn("n", F.row_number().over(w)).where(F.col("n") <= k)
