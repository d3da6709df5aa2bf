"""Data quality of compiled rows, evaluation samples, and overlap with benchmarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import first_non_empty, normalize, strip
from ..functions.text import clean, jaccard, tokens
from ..session import small
from .bm25 import analyze

#: Runs of words of a benchmark up to this number are broadcast to the corpus.
MOST_RUNS = 500_000


def dataset_counts(df: DataFrame, column: str = "dataset", top: int = 20) -> DataFrame:
    """The ``top`` most frequent values with their counts; ties in name order."""
    return df.groupBy(clean(column).alias(column)).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(top)


def empty_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: how often each column is null or blank."""
    return df.agg(*(F.count_if(clean(c) == "").alias(f"empty_{c}") for c in columns))


def negative_faults(df: DataFrame, positive: str, negatives: list[str]) -> DataFrame:
    """One row: rows, rows with a repeated negative, rows whose positive equals a negative; blank texts don't count."""
    negs = F.filter(F.array(*(clean(c) for c in negatives)), lambda x: x != "")
    twice = F.size(F.array_distinct(negs)) < F.size(negs)
    same = (clean(positive) != "") & F.array_contains(negs, clean(positive))
    return df.agg(F.count("*").alias("n_rows"), F.count_if(twice).alias("duplicate_negatives"), F.count_if(same).alias("positive_is_negative"))


def suspicious(df: DataFrame, query: str, positive: str, negatives: list[str], places: int = 9) -> DataFrame:
    """``df`` with the negative that shares most words with the query or the positive: its number, the score (the larger
    Jaccard) and both Jaccards. The first negative wins ties; rows without negatives score -1."""
    q, p = tokens(query), tokens(positive)
    one = []
    for i, c in enumerate(negatives, 1):
        pn, qn = F.round(jaccard(p, tokens(c)), places), F.round(jaccard(q, tokens(c)), places)
        one.append(F.when(clean(c) != "", F.struct(F.greatest(pn, qn).alias("score"), F.lit(-i).alias("neg"), pn.alias("positive_jaccard"), qn.alias("query_jaccard"))))
    none = F.struct(F.lit(-1.0).alias("score"), F.lit(0).alias("neg"), F.lit(0.0).alias("positive_jaccard"), F.lit(0.0).alias("query_jaccard"))
    best = F.array_max(F.array_compact(F.array(*one, none)))
    return df.withColumn("_b", best).select(*df.columns, F.col("_b.score").alias("score"), (-F.col("_b.neg")).alias("worst_negative"), "_b.positive_jaccard", "_b.query_jaccard")


def sample_faults(df: DataFrame, positives: str, negatives: str) -> DataFrame:
    """As :func:`negative_faults` for samples with arrays: rows, rows with a repeated negative, rows with a positive that
    equals a negative; blank texts and null arrays don't count."""
    texts = lambda c: F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), clean), lambda x: x != "")
    p, n = texts(F.col(positives)), texts(F.col(negatives))
    return df.agg(F.count("*").alias("n_rows"), F.count_if(F.size(F.array_distinct(n)) < F.size(n)).alias("duplicate_negatives"), F.count_if(F.arrays_overlap(p, n)).alias("positive_is_negative"))


def empty_texts(df: DataFrame, column: str, arrays: list[str]) -> DataFrame:
    """One row: how often ``column`` is null or blank, and for each of ``arrays`` the samples without a text in it
    (``without_``) and the null or blank elements of all samples (``empty_``)."""
    blank = lambda c: F.size(F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda x: clean(x) == ""))
    size = lambda c: F.size(F.coalesce(c, F.array().cast("array<string>")))
    each = [x for c in arrays for x in (F.count_if(size(F.col(c)) == blank(F.col(c))).alias(f"without_{c}"), F.sum(blank(F.col(c))).alias(f"empty_{c}"))]
    return df.agg(F.count_if(clean(column) == "").alias(f"empty_{column}"), *each)


def suspicious_samples(df: DataFrame, query: str, positives: str, negatives: str, places: int = 9) -> DataFrame:
    """As :func:`suspicious` for samples with arrays: a row for each positive (one without, if a sample has none), with the
    worst of all negatives."""
    rows = df.withColumn("_p", F.explode_outer(F.array_distinct(positives)))
    q, p = tokens(query), tokens("_p")
    rows = rows.withColumn("_q", q).withColumn("_t", p)

    def one(c, i):
        t = tokens(c)
        pn, qn = F.round(jaccard(F.col("_t"), t), places), F.round(jaccard(F.col("_q"), t), places)
        return F.when(clean(c) != "", F.struct(F.greatest(pn, qn).alias("score"), (-i - 1).alias("neg"), pn.alias("positive_jaccard"), qn.alias("query_jaccard")))

    none = F.struct(F.lit(-1.0).alias("score"), F.lit(0).alias("neg"), F.lit(0.0).alias("positive_jaccard"), F.lit(0.0).alias("query_jaccard"))
    all_of = F.transform(F.coalesce(negatives, F.array().cast("array<string>")), one)
    best = F.array_max(F.array_compact(F.concat(all_of, F.array(none))))
    return rows.withColumn("_b", best).select(*df.columns, F.col("_p").alias("one_positive"), F.col("_b.score").alias("score"), (-F.col("_b.neg")).alias("worst_negative"), "_b.positive_jaccard", "_b.query_jaccard")


def eval_samples(samples: DataFrame, family: str = "dataset", query: str = "query") -> DataFrame:
    """``(family, query, positive, negative, lang)``: samples grouped by family and query text; positives and negatives are the
    distinct non-blank texts of the group (sorted), a negative that is a positive anywhere in the family is dropped, the
    language is the smallest non-blank one. Groups without a query or a positive are dropped.

    Texts of a group are deduplicated before they are collected; the family's positives are joined, not collected."""
    rows = samples.select(normalize(family).alias(family), strip(normalize(query)).alias(query), "positive", "negative", strip(normalize("lang")).alias("lang"))
    rows = rows.where(F.col(query) != "")
    texts = lambda c: rows.select(family, query, F.explode(c).alias("t")).select(family, query, strip(normalize("t")).alias("t")).where("t <> ''").distinct()
    pos, neg = texts("positive"), texts("negative")
    neg = neg.join(pos.select(family, "t").distinct(), [family, "t"], "left_anti")
    p = pos.groupBy(family, query).agg(F.sort_array(F.collect_list("t")).alias("positive"))
    n = neg.groupBy(family, query).agg(F.sort_array(F.collect_list("t")).alias("negative"))
    lang = rows.groupBy(family, query).agg(F.min(F.when(F.col("lang") != "", F.col("lang"))).alias("lang"))
    return p.join(n, [family, query], "left").join(lang, [family, query]).select(family, query, "positive", F.coalesce("negative", F.array().cast("array<string>")).alias("negative"), "lang")


def invalid_samples(samples: DataFrame) -> DataFrame:
    """One row: samples, those without a query, and those without a non-blank positive (of the ones with a query)."""
    q = strip(normalize("query")) == ""
    p = F.coalesce(first_non_empty("positive"), F.lit("")) == ""
    return samples.agg(F.count("*").alias("samples"), F.count_if(q).alias("without_query"), F.count_if(~q & p).alias("without_positive"))


def _grams(words, n) -> Column:
    """Hashes of the runs of ``n`` consecutive ``words`` (by their hashes); none if there are fewer."""
    starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, n)))


def benchmark_overlap(benchmark: DataFrame, corpus: DataFrame, bench_id: str = "item_id", corpus_id: str = "doc_id", text: str = "text", n: int = 12) -> DataFrame:
    """``(bench_id, documents, near_documents, containment, verdict)``: how many corpus texts equal an item's once case and white
    space are set aside; how many share a run of ``n`` words with it (all of its words if it has fewer); the largest share
    of its runs that one text holds. ``exclude`` if any text is equal or shares a run, else ``keep``. Items without text
    are kept; those without words can be equal only.

    Runs are compared by 64-bit hash; only the item's runs travel to the corpus if they are few."""
    form = F.md5(F.regexp_replace(F.lower(strip(normalize(text))), r"(?U)\s+", " "))
    b = benchmark.where(strip(normalize(text)) != "").select(bench_id, form.alias("h"))
    c = corpus.where(strip(normalize(text)) != "").groupBy(form.alias("h")).agg(F.count(corpus_id).alias("documents"))
    hit = b.join(c, "h").groupBy(bench_id).agg(F.sum("documents").alias("documents"))

    size = F.least(F.size("w"), F.lit(n))
    hashes = F.transform(analyze(text), lambda x: F.xxhash64(x)).alias("w")
    w = benchmark.select(bench_id, hashes).distinct().where(F.size("w") > 0).select(bench_id, F.xxhash64("w").alias("of"), size.alias("n"), F.array_distinct(_grams(F.col("w"), size)).alias("g"))
    runs = w.select(bench_id, "of", "n", F.size("g").alias("all"), F.explode("g").alias("g"))
    lengths = F.broadcast(runs.select("n").distinct())  # n rows at most
    texts = corpus.select(F.col(corpus_id).alias("_doc"), hashes).crossJoin(lengths).select("_doc", "n", F.explode(_grams(F.col("w"), F.col("n"))).alias("g"))
    near = texts.join(small(runs, MOST_RUNS), ["n", "g"]).groupBy(bench_id, "of", "_doc").agg((F.count_distinct("g") / F.first("all")).alias("part"))
    near = near.groupBy(bench_id).agg(F.count_distinct("_doc").alias("near_documents"), F.round(F.max("part"), 9).alias("containment"))
    out = benchmark.select(bench_id).distinct().join(hit, bench_id, "left").join(near, bench_id, "left")
    exclude = (F.col("documents") > 0) | F.col("containment").isNotNull()
    zero = lambda x: F.coalesce(x, F.lit(0)).alias(x)
    return out.select(bench_id, zero("documents"), zero("near_documents"), F.coalesce("containment", F.lit(0.0)).alias("containment"), F.when(exclude, "exclude").otherwise("keep").alias("verdict"))


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows in the order of a seeded hash of ``key``: the same rows however the table is stored."""
    h = F.md5(F.concat(F.lit(f"{seed}|"), normalize(key)))
    return df.orderBy(h, *[c for c in df.columns if dict(df.dtypes)[c] in ("string", "bigint", "int")]).limit(n)
