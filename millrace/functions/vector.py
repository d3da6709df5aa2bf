"""Vector functions over arrays; sums run in double and in index order, so they equal those of other engines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a, b) -> Column:
    z = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(z, F.lit(0.0), lambda m, v: m + v)


def l2_squared(a, b) -> Column:
    z = F.zip_with(_c(a), _c(b), lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.aggregate(z, F.lit(0.0), lambda m, v: m + v)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def unit(a, eps: float = 1e-12) -> Column:
    n = F.greatest(norm(a), F.lit(eps))
    return F.transform(_c(a), lambda x: x.cast("double") / n)


def allclose(a, b, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    """Of equal length and each ``|a - b| <= atol + rtol * |b|``."""
    z = F.zip_with(_c(a), _c(b), lambda x, y: F.abs(x.cast("double") - y.cast("double")) <= F.lit(atol) + F.lit(rtol) * F.abs(y.cast("double")))
    return (F.size(_c(a)) == F.size(_c(b))) & F.forall(z, lambda ok: F.coalesce(ok, F.lit(False)))


def usable(c, dim: int | None = None) -> Column:
    """Not null, without null elements, not all zero, of ``dim`` numbers if given."""
    v = _c(c)
    ok = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull()) & F.exists(v, lambda x: x != 0)
    return F.coalesce(ok & (F.size(v) == dim) if dim else ok, F.lit(False))


def spherical_mean(df: DataFrame, keys: list[str], vector: str, weight: str | None = None, eps: float = 1e-8) -> DataFrame:
    """``(keys, mean)``: the weighted mean of the unit vectors of a group, scaled to unit length and then to the
    weighted mean of their lengths. Element sums are taken by position before the shuffle, so a large group is no
    hot spot. Groups with vectors of different sizes get the mean of what each position has; null vectors are left out."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = df.where(F.col(vector).isNotNull()).select(*keys, w.alias("_w"), norm(vector).alias("_n"), F.col(vector).alias("_v"))
    parts = rows.select(*keys, "_w", "_n", F.posexplode("_v").alias("_i", "_x"))
    parts = parts.groupBy(*keys, "_i").agg(F.sum(F.col("_w") * F.col("_x") / F.greatest("_n", F.lit(eps))).alias("_s"), F.sum("_w").alias("_sw"), F.sum(F.col("_w") * F.col("_n")).alias("_sn"))
    g = parts.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_i", "_s", "_sw", "_sn"))).alias("_p"))
    m = F.transform("_p", lambda p: p["_s"] / p["_sw"])
    g = g.withColumn("_m", m).withColumn("_l", F.greatest(norm("_m"), F.lit(eps))).withColumn("_len", F.col("_p")[0]["_sn"] / F.col("_p")[0]["_sw"])
    return g.select(*keys, F.transform("_m", lambda x: x / F.col("_l") * F.col("_len")).alias("mean"))


def merge_tensors(tensors: DataFrame, key: str = "name", model: str = "model", values: str = "values", is_float: str = "is_float", weight: str | None = None, eps: float = 1e-8) -> DataFrame:
    """``(key, values)``: of tensors with a name in several models one each: the :func:`spherical_mean` where they are floating-point, else
    the one of the first model (the smallest ``model``)."""
    mean = spherical_mean(tensors.where(is_float), [key], values, weight, eps).withColumnRenamed("mean", values)
    first = tensors.where(~F.col(is_float)).groupBy(key).agg(F.min_by(values, model).alias(values))
    return mean.unionByName(first.select(key, F.col(values).cast("array<double>").alias(values)))
