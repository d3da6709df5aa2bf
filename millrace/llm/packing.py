"""Problem 2: filling fixed-capacity containers with items, by hierarchical residual packing.

Partitions pack their items best-fit (largest first). Bins that nothing can join any more are emitted; the others
become items of the next round, in which a group of partitions is packed together, up a tree to one per dataset.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import Scratch

#: Items a partition packs in the first round, and partitions that merge in each later one.
CHUNK, FAN_IN = 8192, 16
#: A bin this full is final.
NEARLY_FULL = 0.99


def clean_name(col):
    return F.lower(F.regexp_replace(col, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""))


def current_rows(assignments: DataFrame) -> DataFrame:
    """One row for each root, the one with the latest ``assigned_at`` (null is earliest; ties: the largest
    ``row_count``, ``shard_id`` and ``dataset`` in this order, null last); ``dataset`` without case and blanks.
    The maximum is partly taken before the shuffle, so a root with a third of all rows is no hot spot."""
    rows = assignments.select(F.col("root"), F.struct("assigned_at", "row_count", "shard_id", clean_name("dataset").alias("dataset")).alias("r")).where("root is not null")
    return rows.groupBy("root").agg(F.max("r").alias("r")).select("root", "r.dataset", "r.row_count", "r.shard_id", "r.assigned_at")


def best_fit(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each item, bins numbered from 0: largest items first, each into the fullest bin that has room."""
    bins: list[int] = [0] * len(sizes)
    rooms: list[tuple[int, int]] = []  # (room left, bin), sorted
    n = 0
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = bisect_left(rooms, (sizes[i], -1))
        if at < len(rooms):
            room, b = rooms.pop(at)
        else:
            room, b, n = capacity, n, n + 1
        bins[i] = b
        insort(rooms, (room - sizes[i], b))
    return bins


def pack(spark: SparkSession, items: DataFrame, capacities: DataFrame, chunk: int = CHUNK, fan_in: int = FAN_IN, nearly_full: float = NEARLY_FULL, all_up: bool = False) -> DataFrame:
    """``(item, dataset, piece, size, bin_id)``: a bin for each piece of each item of ``items(item, dataset, size)``;
    bins of a dataset hold its ``capacity`` of ``capacities(dataset, capacity)`` and are numbered from 0.

    An item larger than the capacity is cut into full pieces and a rest; no other item is cut (``piece`` 0 only).
    Null and negative sizes count as 0. A dataset without a positive capacity has one bin without bound.

    Bounds: a first-round task packs about ``chunk`` items. After best-fit no two bins of a task fit together, so at most one
    is filled to half or less. Bins above half never fit together, so a merge of ``fan_in`` tasks adds something to at most
    ``fan_in`` of them, and all merges on the way to the root to at most ``fan_in`` times their number. Each task sends up its
    bin below half and as many of the roomiest others: any other partner could be exchanged for one of these that is unused and
    has more room, so no union of bins is lost by the rest being final (``all_up`` sends all, for comparison)."""
    tmp = Scratch(spark, "p2")
    sized = items.select("item", "dataset", F.greatest(F.coalesce(F.col("size").cast("long"), F.lit(0)), F.lit(0)).alias("size"))
    # cells of a dataset's items that are equal null-safely; capacities are a table of datasets, joined by name
    caps = capacities.select(clean_name("dataset").alias("dataset"), F.col("capacity").cast("long").alias("capacity")).where("capacity > 0")
    caps = caps.groupBy("dataset").agg(F.max("capacity").alias("capacity"))
    sized = sized.join(caps, "dataset", "left")
    unbounded = sized.where("capacity is null").select("item", "dataset", F.lit(0).cast("long").alias("piece"), "size", F.lit(0).cast("long").alias("bin_id"))
    sized = tmp.cut(sized.where("capacity is not null"))
    counts = tmp.cut(sized.groupBy("dataset", "capacity").agg(F.count("*").alias("n"), F.sum(F.when(F.col("size") > F.col("capacity"), F.floor((F.col("size") - 1) / F.col("capacity"))).otherwise(0)).alias("full")))

    full = sized.where("size > capacity").select("item", "dataset", "capacity", F.explode(F.sequence(F.lit(0), F.floor((F.col("size") - 1) / F.col("capacity")) - 1)).alias("piece")).select("item", "dataset", "piece", F.col("capacity").alias("size"), F.concat_ws("|", F.lit("full"), F.col("item").cast("string"), F.col("piece").cast("string")).alias("bin"))
    last = F.when(F.col("size") > F.col("capacity"), F.floor((F.col("size") - 1) / F.col("capacity"))).otherwise(0)
    rest = sized.join(counts.select("dataset", F.ceil(F.col("n") / chunk).alias("parts")), "dataset")
    rest = rest.select("item", "dataset", "capacity", last.alias("piece"), (F.col("size") - last * F.col("capacity")).alias("size"), F.pmod(F.xxhash64("item"), F.col("parts")).alias("part"))

    def first(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "item"], ascending=[False, True])
        pdf["bin"] = [f"0|{key[1]}|{b}" for b in best_fit([int(x) for x in pdf["size"]], int(pdf["capacity"].iloc[0]))]
        return pdf[["item", "dataset", "capacity", "piece", "size", "part", "bin"]]

    kind = dict(items.dtypes)["item"]
    placed = tmp.cut(rest.groupBy("dataset", "part").applyInPandas(first, f"item {kind}, dataset string, capacity long, piece long, size long, part long, bin string"))
    bins = placed.groupBy("dataset", "capacity", "part", "bin").agg(F.sum("size").alias("level"))

    def open_bins(bins: DataFrame, merges: int) -> DataFrame:
        """Those that go up with so many merges to come: not nearly full; of each task the one filled to half or less and the
        roomiest others."""
        under = bins.where(F.col("level") < F.col("capacity") * nearly_full)
        return under.withColumn("rk", F.row_number().over(W.partitionBy("dataset", "part").orderBy("level", "bin"))).where(F.lit(all_up) | (F.col("rk") <= fan_in * merges + 1)).drop("rk")

    def merge(round_: int):
        def f(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["level", "bin"], ascending=[False, True])
            of = best_fit([int(x) for x in pdf["level"]], int(pdf["capacity"].iloc[0]))
            pdf["into"] = [f"{round_}|{key[1]}|{b}" for b in of]
            return pdf[["dataset", "capacity", "part", "bin", "level", "into"]]

        return f

    widest = counts.agg(F.max(F.ceil(F.col("n") / chunk))).first()[0] or 0
    merged, round_, merges = None, 0, 0
    while fan_in**merges < widest:
        merges += 1
    current = bins
    while widest > 1:
        round_ += 1
        up = open_bins(current, merges - round_ + 1).withColumn("part", F.floor(F.col("part") / fan_in))
        step = tmp.cut(up.groupBy("dataset", "part").applyInPandas(merge(round_), "dataset string, capacity long, part long, bin string, level long, into string"))
        current = step.groupBy("dataset", "capacity", "part", F.col("into").alias("bin")).agg(F.sum("level").alias("level"))
        if merged is None:
            merged = step.select("dataset", "bin", "into")
        else:  # where the bins of earlier rounds are now
            now = step.select("dataset", F.col("bin").alias("into"), F.col("into").alias("later"))
            merged = tmp.cut(merged.join(now, ["dataset", "into"], "left").select("dataset", "bin", F.coalesce("later", "into").alias("into")))
        widest = -(-widest // fan_in)
    if merged is not None:
        placed = placed.join(merged, ["dataset", "bin"], "left").withColumn("bin", F.coalesce("into", "bin"))
    pieces = tmp.cut(placed.select("item", "dataset", "piece", "size", "bin").unionByName(full))

    # dense numbers: bins are counted in hashed blocks, blocks are offset by the counts before them
    names = pieces.select("dataset", "bin").distinct().join(counts.select("dataset", F.ceil((F.col("n") + F.col("full")) / chunk).alias("blocks")), "dataset")
    names = names.withColumn("block", F.pmod(F.xxhash64("bin"), F.col("blocks"))).withColumn("i", F.row_number().over(W.partitionBy("dataset", "block").orderBy("bin")))
    names = tmp.cut(names.select("dataset", "bin", "block", "i"))
    offsets = names.groupBy("dataset", "block").agg(F.max("i").alias("of")).withColumn("before", F.coalesce(F.sum("of").over(W.partitionBy("dataset").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    numbers = names.join(offsets.select("dataset", "block", "before"), ["dataset", "block"]).select("dataset", "bin", (F.col("before") + F.col("i") - 1).cast("long").alias("bin_id"))
    return pieces.join(numbers, ["dataset", "bin"]).select("item", "dataset", "piece", "size", "bin_id").unionByName(unbounded)


def pack_components(spark: SparkSession, assignments: DataFrame, capacities: DataFrame, **options) -> DataFrame:
    """``(root, dataset, piece, rows, shard_id)``: a shard for every component of ``assignments`` by its current row."""
    now = current_rows(assignments)
    packed = pack(spark, now.select(F.col("root").alias("item"), "dataset", F.col("row_count").alias("size")), capacities, **options)
    return packed.select(F.col("item").alias("root"), "dataset", "piece", F.col("size").alias("rows"), F.col("bin_id").cast("int").alias("shard_id"))
