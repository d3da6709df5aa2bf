"""Problem 4: splits that keep related records together, by grouped iterative stratification.

Records of one entity (value in its dataset, in whatever language) and of one group of linked nodes form a
component. Components carry label vectors; those whose rarest outstanding label is the rarest of all are placed
first, each into the split that needs that label most.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import Scratch
from .groups import clean, connected_groups, node_groups
from .packing import current_rows

#: A component with at least this part of all records is heavy; there are at most 1 / HEAVY of these.
HEAVY = 1 / 1024
#: Light components are stratified in tasks of about this many.
CHUNK = 8192


def stratify(components: list[tuple[object, dict[str, int]]], want: dict[str, list[float]], n_splits: int) -> dict[object, int]:
    """The split of each component. ``want``: for each label the number of records each split still needs; it is
    lowered in place. Ties go to the split that needs most in all, then to the first."""
    left: dict[str, int] = {}
    holders: dict[str, list[int]] = {}
    for i, (_, labels) in enumerate(components):
        for k, n in labels.items():
            left[k] = left.get(k, 0) + n
            holders.setdefault(k, []).append(i)
    need = [sum(w[s] for w in want.values()) for s in range(n_splits)]
    out: dict[object, int] = {}
    placed = [False] * len(components)
    while left:
        rarest = min(left, key=lambda k: (left[k], k))
        mine = [i for i in holders[rarest] if not placed[i]]
        mine.sort(key=lambda i: (-components[i][1][rarest], -sum(components[i][1].values()), str(components[i][0])))
        for i in mine:
            name, labels = components[i]
            s = max(range(n_splits), key=lambda s: (want[rarest][s], need[s], -s))
            out[name], placed[i] = s, True
            for k, n in labels.items():
                want[k][s] -= n
                need[s] -= n
                left[k] -= n
        del left[rarest]
    return out


def entity_columns(keys: DataFrame) -> DataFrame:
    return keys.select(*(clean(c).alias(c) for c in ("dataset", "kind", "value")), F.lower(clean("lang")).alias("lang"), F.col("node_id").alias("node"))


def components(spark: SparkSession, nodes: DataFrame, keys: DataFrame, tmp: Scratch):
    """``(rows, groups)``: every record of ``keys`` with its component, and ``(node_id, group_id)``.

    An entity links its groups as a star around the smallest; entities with one group link nothing, so the second search runs over
    what is left to link."""
    groups = tmp.cut(node_groups(spark, nodes, keys, tmp))
    rows = entity_columns(keys).join(groups.withColumnRenamed("node_id", "node"), "node", "left")
    # one number space: groups are even, entities without one odd (a hash; should two entities share it, they stay together)
    rows = rows.withColumn("entity", F.xxhash64("dataset", "value"))
    rows = tmp.cut(rows.withColumn("own", F.coalesce(F.shiftleft("group_id", 1), F.shiftleft("entity", 1).bitwiseOR(F.lit(1)))))
    hubs = rows.groupBy("entity").agg(F.min("own").alias("b"), F.max("own").alias("top")).where("b < top").drop("top")
    links = rows.select("entity", F.col("own").alias("a")).distinct().join(hubs, "entity").where("a <> b").select("a", "b").distinct()
    comp = connected_groups(spark, links, tmp).select(F.col("node").alias("own"), "grp")
    return tmp.cut(rows.join(comp, "own", "left").withColumn("component", F.coalesce("grp", "own")).drop("entity", "own", "grp")), groups


def grouped_split(spark: SparkSession, nodes: DataFrame, keys: DataFrame, targets: DataFrame, chunk: int = CHUNK, heavy: float = HEAVY, assignments: DataFrame | None = None) -> DataFrame:
    """``(dataset, kind, value, component, split_name)``: one row for each entity (and kind); all records of a
    component share a split. With ``assignments`` also ``first_shard`` and ``last_shard``, the least and the largest shard that the
    current rows of the entity's groups name (null: none): where they differ, the present shards tear what the split keeps together.

    Labels of a record are its dataset with its kind, and its dataset with its language. Heavy components are placed
    by one task (their number is bounded), which knows what is then still wanted; light ones by tasks that each get
    their part of that, in proportion to the labels they hold. Null shares count as 0; with no targets there is no
    row. Nodes that no row of ``nodes`` names form no group: their entity stands alone."""
    tmp = Scratch(spark, "p4")
    rows, groups = components(spark, nodes, keys, tmp)
    present, shown = [], []
    if assignments is not None:
        named = current_rows(assignments).where("shard_id is not null").join(groups, F.col("root") == F.col("node_id"))
        named = named.groupBy("group_id").agg(F.min("shard_id").alias("first_shard"), F.max("shard_id").alias("last_shard"))
        rows = rows.join(named, "group_id", "left")
        present = [F.min("first_shard").alias("first_shard"), F.max("last_shard").alias("last_shard")]
        shown = ["first_shard", "last_shard"]
    goal = targets.groupBy("split_name").agg(F.sum(F.coalesce("target_share", F.lit(0.0))).alias("share")).orderBy("split_name").collect()  # a fixed handful of splits
    names, shares = [g["split_name"] for g in goal], [g["share"] for g in goal]
    if not names or sum(shares) <= 0:
        return rows.select("dataset", "kind", "value", "component", F.lit(None).cast("string").alias("split_name"), *shown).limit(0)
    shares = [s / sum(shares) for s in shares]
    labels = rows.select("component", F.explode(F.array(F.concat_ws("/", F.lit("kind"), "dataset", "kind"), F.concat_ws("/", F.lit("lang"), "dataset", "lang"))).alias("label"))
    vectors = tmp.cut(labels.groupBy("component", "label").agg(F.count("*").alias("n")))
    sizes = vectors.groupBy("component").agg(F.sum("n").alias("size"))
    total = vectors.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-sizes.count() // chunk))
    big = sizes.where(F.col("size") >= heavy * total)
    schema = "component long, split int"

    def place(pdf: pd.DataFrame, want: dict[str, list[float]]) -> pd.DataFrame:
        of: dict[int, dict[str, int]] = {}
        for c, k, n in zip(pdf["component"], pdf["label"], pdf["n"]):
            of.setdefault(c, {})[k] = int(n)
        got = stratify(sorted(of.items()), want, len(names))
        return pd.DataFrame({"component": list(got), "split": list(got.values())})

    heavies = tmp.cut(vectors.join(big.select("component"), "component", "left_semi"))
    label_totals = tmp.cut(vectors.groupBy("label").agg(F.sum("n").alias("in_all")))

    def first(pdf: pd.DataFrame) -> pd.DataFrame:
        want = {k: [t * s for s in shares] for k, t in zip(pdf["label"], pdf["in_all"])}
        return place(pdf, want)

    chosen = tmp.cut(heavies.join(label_totals, "label").withColumn("part", F.lit(0)).groupBy("part").applyInPandas(first, schema))
    # what the heavy ones took of each label, by split
    took = heavies.join(chosen, "component").groupBy("label").pivot("split", list(range(len(names)))).agg(F.sum("n")).fillna(0)
    light = vectors.join(chosen.select("component"), "component", "left_anti").withColumn("part", F.pmod(F.xxhash64("component"), F.lit(parts)))
    rest = light.groupBy("label").agg(F.sum("n").alias("light"))
    open_ = label_totals.join(rest, "label", "left").join(took, "label", "left").fillna(0)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        """What light components shall give each split of each label: the rows add up to what there is, the columns to what
        the splits lack in all, as near to the open label shares as that allows (iterative proportional fitting)."""
        took = pdf[[str(i) for i in range(len(names))]].to_numpy(float)
        there, light = pdf["in_all"].to_numpy(float)[:, None], pdf["light"].to_numpy(float)
        lack = np.maximum(0.0, there.sum() * np.array(shares) - took.sum(0))
        lack *= light.sum() / max(lack.sum(), 1e-9)
        w = np.maximum(there * np.array(shares) - took, 1e-6 * there * np.array(shares))
        for _ in range(100):
            w *= (light / np.maximum(w.sum(1), 1e-12))[:, None]
            w *= lack / np.maximum(w.sum(0), 1e-12)
        return pd.DataFrame({"label": pdf["label"], "light": pdf["light"], "want": list(w)})

    # one row for each label
    wanted = tmp.cut(open_.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(fit, "label string, light long, want array<double>"))

    # each task gets whole records of each label and split, so that even a label with few records reaches all splits:
    # along the tasks the wants are added up, and a task gets what the sum's whole part grows by; train has the rest
    cells = light.groupBy("label", "part").agg(F.sum("n").alias("here"))
    cells = tmp.cut(cells.withColumn("before", F.coalesce(F.sum("here").over(W.partitionBy("label").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))))
    largest = max(range(len(names)), key=lambda i: (shares[i], -i))

    def later(pdf: pd.DataFrame) -> pd.DataFrame:
        want = {}
        for k, g in pdf.groupby("label"):
            here, before, all_ = (float(g[c].iloc[0]) for c in ("here", "before", "light"))
            w = np.asarray(g["want"].iloc[0]) / max(all_, 1.0)
            phase = np.array([(zlib.crc32(f"{k}/{i}".encode()) % 997) / 997 for i in range(len(names))])
            got = np.floor((before + here) * w + phase) - np.floor(before * w + phase)
            got[largest] = here - (got.sum() - got[largest])
            want[k] = list(got)
        return place(pdf[["component", "label", "n"]], want)

    spread = light.join(cells, ["label", "part"]).join(wanted, "label").groupBy("part").applyInPandas(later, schema)
    final = tmp.cut(chosen.unionByName(spread))
    word = F.element_at(F.array(*(F.lit(n) for n in names)), F.col("split") + 1)
    entities = rows.select("dataset", "kind", "value", "component", *(["group_id", *shown] if shown else [])).distinct()
    if shown:
        entities = entities.groupBy("dataset", "kind", "value", "component").agg(*present)
    return entities.join(final, "component").select("dataset", "kind", "value", "component", word.alias("split_name"), *shown)


def torn_entities(spark: SparkSession, nodes: DataFrame, keys: DataFrame, assignments: DataFrame, targets: DataFrame) -> DataFrame:
    """``(dataset, kind, value)``: entities that the split keeps together although their groups' current rows name at least two
    different shards.

    Null shards name none; a root outside ``nodes`` belongs to no group. Without targets there is no split and no row."""
    placed = grouped_split(spark, nodes, keys, targets, assignments=assignments)
    return placed.where("first_shard < last_shard").select("dataset", "kind", "value")
