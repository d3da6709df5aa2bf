"""The nearest-neighbour join: exact, in blocks of matrix products."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Passages of a block; a block of queries is multiplied with one of passages at a time.
BLOCK, QUERY_BLOCK = 16_384, 8_192
#: Scores are compared after rounding to this many places, so that equal vectors tie whatever the block.
PLACES = 9


def _sent(c: str, df: DataFrame):
    """Single precision stays so on its way to the tasks, which compute in double."""
    return F.col(c) if dict(df.dtypes)[c] == "array<float>" else F.col(c).cast("array<double>")


def knn_join(queries: DataFrame, passages: DataFrame, k: int, metric: str = "ip", scope: list[str] = (), block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``(scope, query, passage, score, rank)``: for each row of ``queries(scope, query, vector)`` the ``k`` best of
    ``passages(scope, passage, vector)`` of its scope, by inner product (descending) or squared L2 distance
    (ascending); ties go to the smaller passage.

    A scope turns the product of all with all into one per scope. Within it, passages and queries are dealt to
    blocks by hash, so that a scope with most of the rows is spread over many tasks; a task multiplies one block
    with the other and keeps ``k`` rows a query, which are merged by a window. Null vectors are left out; vectors
    of another size than the others of a block raise."""
    scope = list(scope)
    if metric not in ("ip", "l2"):
        raise ValueError(f"unknown metric {metric!r}")
    ps = passages.where("vector is not null").select(*scope, F.col("passage").alias("key"), _sent("vector", passages).alias("vector"))
    qs = queries.where("vector is not null").select(*scope, F.col("query").alias("key"), _sent("vector", queries).alias("vector"))
    # a row per scope; in the shape of the keys of the join
    size = lambda df, n, of: df.groupBy(*scope).agg(F.ceil(F.count("*") / n).alias(of)) if scope else df.agg(F.greatest(F.lit(1), F.ceil(F.count("*") / n)).alias(of))
    pb, qb = size(ps, block, "_pn"), size(qs, query_block, "_qn")
    if scope:
        plan = pb.join(qb, scope)
        ps, qs = ps.join(plan, scope), qs.join(plan, scope)
    else:
        plan = pb.crossJoin(qb)  # one row
        ps, qs = ps.crossJoin(F.broadcast(plan)), qs.crossJoin(F.broadcast(plan))
    one = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n).cast("long") - 1)
    ps = ps.withColumn("_p", F.pmod(F.xxhash64("key"), F.col("_pn"))).withColumn("_q", F.explode(one("_qn"))).drop("_pn", "_qn")
    qs = qs.withColumn("_q", F.pmod(F.xxhash64("key"), F.col("_qn"))).withColumn("_p", F.explode(one("_pn"))).drop("_pn", "_qn")
    on = [*scope, "_p", "_q"]
    # names of their own: both sides may come from one table
    ps = ps.select(*(F.col(c).alias(f"passage_{c}") for c in [*on, "key", "vector"]))
    kinds = dict(passages.dtypes) | dict(queries.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in scope), f"query {kinds['query']}, passage {kinds['passage']}, score double"])

    def best(key: tuple, q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        names = [*scope, "query", "passage", "score"]
        if not len(q) or not len(p):
            return pd.DataFrame({n: [] for n in names})
        p = p.sort_values("passage_key")
        x, y = (np.stack(v.values).astype(np.float64) for v in (q["vector"], p["passage_vector"]))
        ids, out = p["passage_key"].values, []
        for at in range(0, len(x), 512):
            s = x[at : at + 512] @ y.T
            if metric == "l2":
                s = 2 * s - (x[at : at + 512] ** 2).sum(1)[:, None] - (y**2).sum(1)[None]
            s = np.round(s, PLACES)
            w = min(k, s.shape[1])
            # everything at or above the w-th best, then ordered by score and passage
            least = np.partition(s, s.shape[1] - w, axis=1)[:, s.shape[1] - w]
            r, c = np.nonzero(s >= least[:, None])
            o = np.lexsort((c, -s[r, c], r))
            r, c = r[o], c[o]
            n = np.arange(len(r)) - np.searchsorted(r, r)
            r, c = r[n < w], c[n < w]
            out.append(pd.DataFrame({"query": q["key"].values[at + r], "passage": ids[c], "score": s[r, c]}))
        out = pd.concat(out)
        for c, v in zip(scope, key):
            out[c] = v
        return out[names]

    found = qs.groupBy(*on).cogroup(ps.groupBy(*(f"passage_{c}" for c in on))).applyInPandas(best, schema)
    w = W.partitionBy(*scope, "query").orderBy(F.desc("score"), "passage")
    found = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return found.withColumn("score", -F.col("score") + F.lit(0.0)) if metric == "l2" else found


#: Vectors that the cells of an approximate search are fitted on, at most, and cells at most.
SAMPLE, CELLS = 32_768, 4096


def fit_cells(x: np.ndarray, n: int, rounds: int = 8, seed: int = 42) -> np.ndarray:
    """``n`` centres of the rows of ``x`` by k-means; a centre without rows moves to the row farthest from its own."""
    x = x.astype(np.float64)
    c = x[np.random.default_rng(seed).permutation(len(x))[:n]].copy()
    for _ in range(rounds):
        of, gap = nearest_cells(x, c, 1)
        of, gap = of[:, 0], gap[:, 0]
        sums, n_of = np.zeros_like(c), np.bincount(of, minlength=len(c))
        np.add.at(sums, of, x)
        c = np.where(n_of[:, None] > 0, sums / np.maximum(n_of, 1)[:, None], c)
        lost = np.nonzero(n_of == 0)[0]
        c[lost] = x[np.argsort(-gap, kind="stable")[: len(lost)]]
    return c


def nearest_cells(x: np.ndarray, c: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the ``w`` nearest centres of each row and their squared distances, nearest first."""
    ids, gaps = [], []
    for at in range(0, len(x), 4096):
        part = x[at : at + 4096]
        d = (part**2).sum(1)[:, None] - 2 * part @ c.T + (c**2).sum(1)[None]
        top = np.argsort(d, axis=1, kind="stable")[:, :w]
        ids.append(top)
        gaps.append(np.take_along_axis(d, top, 1))
    return np.concatenate(ids), np.concatenate(gaps)


def knn_join_cells(queries: DataFrame, passages: DataFrame, k: int, metric: str = "ip", scope: list[str] = (), cells: int | None = None, probes: int | None = None, sample: int = SAMPLE, **blocks) -> DataFrame:
    """As :func:`knn_join`, approximate: passages lie in the cell of their nearest centre, and a query is compared with the passages of its
    ``probes`` nearest cells only. All passages are indexed; the centres are fitted on ``sample`` of them at most. ``cells`` are about the
    root of the number of passages if not given (at most CELLS), ``probes`` six tenths of them and at least 16: vectors without any
    clusters need so many for a recall of 0.9, clustered ones far fewer. With as many probes as cells it is exact.

    Cells take the place of blocks in the exact join, so work per query is probes / cells of it; a large cell is still dealt to blocks."""
    ps = passages.where("vector is not null")
    n = ps.count()
    names = [*scope, "query", "passage", "score", "rank"]
    if n == 0:
        return knn_join(queries, passages, k, metric, scope, **blocks).select(*names)
    cells = min(CELLS, cells or max(1, round(n**0.5)), n)
    probes = probes or max(16, -(-6 * cells // 10))
    rows = ps.select("passage", "vector").orderBy(F.xxhash64("passage"), "passage").limit(max(sample, cells)).collect()  # bounded
    centres = queries.sparkSession.sparkContext.broadcast(fit_cells(np.array([r["vector"] for r in rows], np.float64), cells))

    def near(w: int):
        @F.pandas_udf("array<int>")
        def f(s: pd.Series) -> pd.Series:
            x = np.stack(s.values).astype(np.float64) if len(s) else np.zeros((0, 1))
            return pd.Series(list(nearest_cells(x, centres.value, w)[0].astype(np.int32)) if len(s) else [], index=s.index)

        return f

    ps = ps.withColumn("_cell", near(1)("vector")[0])
    qs = queries.where("vector is not null").withColumn("_cell", F.explode(near(min(probes, cells))("vector")))
    found = knn_join(qs, ps, k, metric, [*scope, "_cell"], **blocks).drop("rank", "_cell")
    order = F.col("score").asc() if metric == "l2" else F.col("score").desc()
    return found.withColumn("rank", F.row_number().over(W.partitionBy(*scope, "query").orderBy(order, "passage"))).where(F.col("rank") <= k).select(*names)
