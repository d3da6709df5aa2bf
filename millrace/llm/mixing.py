"""Problem 7: mixing sources to target weights.

Each source gets a budget, its share of the total size. Whole passes over the source come first, up to the capped
number of repeats; what is left of the budget is fitted as a subset sum over the source's histogram of exact
lengths: an even fraction of every length, then large lengths while they fit, then a bounded-knapsack dynamic
programme for the rest. Which documents of a length are taken is decided by a seeded hash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import Scratch

#: The dynamic programme covers what is left once it is below this many units (or below two of the longest lengths).
DP_UNITS = 1 << 16
#: Documents of one source and length are numbered in chunks of about this many.
CHUNK = 100_000
# White space at which str.split() cuts
SPACE = r"[\s\x1c-\x1f]"


def clean_source(col):
    return F.lower(F.regexp_replace(col, rf"(?U)^{SPACE}+|{SPACE}+$", ""))


def whitespace_size(col):
    """Number of pieces between white space; null and blank texts: 0."""
    return F.coalesce(F.regexp_count(col, F.lit(r"(?U)[^\s\x1c-\x1f]+")), F.lit(0)).cast("long")


def tokenizer_size(path: str | None = None):
    """Size in tokens of a public byte-level BPE vocabulary (a file of ranks at ``path``, as tiktoken reads it)."""

    def size(col):
        @F.pandas_udf("long")
        def count(s: pd.Series) -> pd.Series:
            enc = _encoding(path)
            return pd.Series([0 if t is None else len(enc.encode_ordinary(t)) for t in s])

        return count(col)

    return size


_encodings: dict = {}


def _encoding(path: str | None):
    if path not in _encodings:
        import base64

        import public_tokenizers
        import tiktoken

        file = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
        with open(file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encodings[path] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]


def fit_lengths(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many of each length to take so that their sum comes as near to ``budget`` as possible without passing
    it. Exact (a subset sum with bounded counts) once the rest is within the dynamic programme's range."""
    take = [0] * len(lengths)
    order = sorted((i for i, x in enumerate(lengths) if x > 0), key=lambda i: -lengths[i])
    total = sum(lengths[i] * counts[i] for i in order)
    if budget >= total:
        return [c if x > 0 else 0 for x, c in zip(lengths, counts)]
    if budget <= 0 or not order:
        return take
    limit = max(DP_UNITS, 2 * lengths[order[0]])
    left = budget
    if left > limit:
        for i in order:  # an even fraction of each length, so that no length is favoured
            take[i] = counts[i] * (budget - limit // 2) // total
            left -= take[i] * lengths[i]
    for i in order:
        if left <= limit:
            break
        more = min(counts[i] - take[i], -(-(left - limit // 2) // lengths[i]), left // lengths[i])
        take[i] += max(0, more)
        left -= max(0, more) * lengths[i]
    # reachable sums as the bits of one integer; an item of a length counts in powers of two. Of each sum only the step that
    # reached it first is kept: what it was reached from was there before, so steps lead back to 0, each used once at most
    mask, size = (1 << (left + 1)) - 1, left // 8 + 1
    by, steps, sums = np.zeros(left + 1, np.int32), [(0, 0)], 1
    for i in order:
        rest, k = min(counts[i] - take[i], left // lengths[i]), 1
        while rest > 0 and not sums >> left:
            k = min(k, rest)
            more = sums | (sums << (k * lengths[i])) & mask
            if more != sums:
                new = np.unpackbits(np.frombuffer((more ^ sums).to_bytes(size, "little"), np.uint8), count=left + 1, bitorder="little")
                by[new.view(bool)] = len(steps)
                steps.append((i, k))
                sums = more
            rest -= k
            k *= 2
        if sums >> left:  # filled to the unit
            break
    at = sums.bit_length() - 1
    while at:
        i, k = steps[by[at]]
        take[i] += k
        at -= k * lengths[i]
    return take


def wanted_shares(targets: DataFrame) -> DataFrame:
    """``(source, target_share, max_repeats)``, a row for each source that is listed."""
    wanted = targets.select(clean_source("source").alias("source"), F.col("target_share").cast("double").alias("target_share"), F.coalesce(F.col("max_repeats").cast("long"), F.lit(0)).alias("max_repeats"))
    return wanted.where("source is not null").groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))


def plan_mix(spark: SparkSession, documents: DataFrame, targets: DataFrame, size=whitespace_size, tmp: Scratch | None = None):
    """The sized documents of the listed sources, and a row for each source and length: how many documents of that
    length are taken once more than ``passes`` times; and a row for each source with size and budget.

    Sources are compared without case and outer blanks. A listed source without documents has size 0. Null texts
    count as size 0. A source listed twice adds its shares and keeps the larger repeat cap; a null cap is 0."""
    tmp = tmp or Scratch(spark, "p7")
    wanted = tmp.cut(wanted_shares(targets))
    keep = ["doc_id"] if "doc_id" in documents.columns else []
    sized = documents.select(*keep, clean_source("source").alias("source"), size(F.col("text").cast("string")).alias("len"))
    sized = tmp.cut(sized.join(wanted.select("source"), "source", "left_semi"))
    lengths = tmp.cut(sized.groupBy("source", "len").agg(F.count("*").alias("n")))
    sizes = lengths.groupBy("source").agg(F.sum(F.col("len") * F.col("n")).alias("size"), F.sum("n").alias("docs"))
    plan = wanted.join(sizes, "source", "left").fillna(0, ["size", "docs"])
    plan = plan.crossJoin(F.broadcast(sizes.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("total"))))  # one row
    plan = plan.withColumn("budget", F.coalesce(F.col("target_share"), F.lit(0.0)) * F.col("total"))
    whole = F.when(F.col("size") > 0, F.floor(F.col("budget") / F.col("size"))).otherwise(0)
    plan = plan.withColumn("passes", F.least("max_repeats", whole))
    plan = plan.withColumn("rest", F.when(F.col("passes") < F.col("max_repeats"), F.floor("budget") - F.col("passes") * F.col("size")).otherwise(0).cast("long"))
    plan = tmp.cut(plan)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("len")
        return pdf.assign(take=fit_lengths([int(x) for x in pdf["len"]], [int(x) for x in pdf["n"]], int(pdf["rest"].iloc[0])))[["source", "len", "n", "passes", "take"]]

    # a group is one source's histogram: as many rows as it has different lengths
    taken = lengths.join(plan.select("source", "passes", "rest"), "source").groupBy("source").applyInPandas(fit, "source string, len long, n long, passes long, take long")
    return sized, tmp.cut(taken), plan


def mix(spark: SparkSession, documents: DataFrame, targets: DataFrame, size=whitespace_size, seed: int = 42) -> DataFrame:
    """``(doc_id, source, size, repeats)``: the chosen documents, each at most ``max_repeats`` times.

    Documents of one source and length are taken in the order of a seeded hash of their id. Where these are many,
    they are dealt to chunks by hash first: chunks are taken whole until one is cut, and only that one is ranked."""
    tmp = Scratch(spark, "p7")
    sized, taken, _ = plan_mix(spark, documents, targets, size, tmp)
    dealt = sized.join(taken.select("source", "len", "n", "passes", "take"), ["source", "len"])
    h = F.xxhash64(F.lit(seed), F.col("doc_id"))
    dealt = dealt.withColumn("chunk", F.when(F.col("take") % F.col("n") == 0, 0).otherwise(F.pmod(h, F.ceil(F.col("n") / CHUNK))))
    dealt = tmp.cut(dealt.withColumn("h", F.xxhash64(F.lit(seed + 1), F.col("doc_id"))))
    per = dealt.where("take > 0").groupBy("source", "len", "chunk", "take").agg(F.count("*").alias("in_chunk"))
    per = per.withColumn("before", F.coalesce(F.sum("in_chunk").over(W.partitionBy("source", "len").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    per = per.select("source", "len", "chunk", "in_chunk", F.greatest(F.lit(0), F.least("in_chunk", F.col("take") - F.col("before"))).alias("quota"))
    dealt = dealt.join(per, ["source", "len", "chunk"], "left").fillna(0, ["quota"])
    partly = dealt.where("quota > 0 and quota < in_chunk").withColumn("rk", F.row_number().over(W.partitionBy("source", "len", "chunk").orderBy("h", "doc_id")))
    rest = dealt.where("quota = 0 or quota = in_chunk").withColumn("rk", F.lit(0))
    both = partly.unionByName(rest).withColumn("repeats", F.col("passes") + F.when((F.col("quota") > 0) & (F.col("rk") <= F.col("quota")), 1).otherwise(0))
    return both.where("repeats > 0").select("doc_id", "source", F.col("len").alias("size"), "repeats")


def shares(spark: SparkSession, documents: DataFrame, targets: DataFrame, size=whitespace_size) -> DataFrame:
    """``(source, docs, size, target_share, budget, taken, actual_share, short)``: what the mix takes of each source. ``short``: the
    filling took every document as often as it may be repeated and the budget isn't reached. The share is null if nothing is taken."""
    _, taken, plan = plan_mix(spark, documents, targets, size)
    uses = F.col("n") * F.col("passes") + F.col("take")
    got = taken.groupBy("source").agg(F.sum(F.col("len") * uses).alias("taken"), F.sum(F.when(F.col("len") > 0, uses)).alias("uses"), F.sum(F.when(F.col("len") > 0, F.col("n"))).alias("sized"))
    out = plan.join(got, "source", "left").fillna(0, ["taken", "uses", "sized"])
    out = out.withColumn("short", (F.col("uses") == F.col("sized") * F.col("max_repeats")) & (F.col("taken") < F.col("budget")))
    return out.select("source", "docs", "size", "target_share", "budget", "taken", F.try_divide("taken", F.sum("taken").over(W.partitionBy())).alias("actual_share"), "short")
