"""Queries that do the whole job, on the larger tables."""

import pytest
from compare import connect, differences

from millrace.operators import quality
from millrace.plans import retrieval_queries as rq
from millrace.plans import sql
from millrace.plans import training_queries as tq


@pytest.fixture(scope="module")
def con01(sf01):
    return connect(sf01)


WHOLE = {"hard_negative_mine": rq, "merged_negatives": rq, "compile_recipes": tq, "compile_training_rows": tq, "bm25_topk": rq, "run_truncate": rq, "run_validate": rq, "rerank_apply": rq, "lang_permutations": tq, "batch_plain": tq, "in_batch_negatives": tq, "jaccard_suspicious": tq, "benchmark_overlap": tq}


@pytest.mark.parametrize("name", sorted(WHOLE))
def test_larger_tables(spark, sf01, con01, name):
    query, text = WHOLE[name].QUERIES[name]
    assert differences(spark, con01, sf01, query, text) is None


def test_the_settings_of_the_registered_queries(spark, sf01):
    assert "cast(50 * power" in sql.MINED and "1000) / 50.0" in sql.MINED and "n <= 8)" in sql.MINED
    assert {f"negative{i}" for i in range(1, 9)} < set(tq.compile_training_rows(spark, sf01).columns)
    assert rq.bm25_topk(spark, sf01).groupBy("query_id").count().agg({"count": "max"}).first()[0] == 100


def test_a_benchmark_item_inside_a_document_is_excluded(spark):
    long, words = " ".join(f"w{i}" for i in range(20)), " ".join(f"W{i}," for i in range(4, 16))
    items = spark.createDataFrame([("inside", long), ("short", "One two."), ("other", "three four"), ("gap", " ".join(f"w{i}" for i in range(10)) + " x"), ("equal", "?!"), ("none", None)], "item_id string, text string")
    docs = spark.createDataFrame([(1, f"before {words} after"), (2, "zero one two three"), (3, "?!"), (None, words), (4, None)], "doc_id long, text string")
    got = {r["item_id"]: (r["documents"], r["near_documents"], r["containment"], r["verdict"]) for r in quality.benchmark_overlap(items, docs).collect()}
    assert got == {"inside": (0, 1, round(1 / 9, 9), "exclude"), "short": (0, 1, 1.0, "exclude"), "other": (0, 0, 0.0, "keep"), "gap": (0, 0, 0.0, "keep"), "equal": (1, 0, 0.0, "exclude"), "none": (0, 0, 0.0, "keep")}


def test_samples_are_analysed_with_all_their_texts(spark):
    rows = [(1, "q", ["a b", "c d"], ["x", "y", "z", "c d"]), (2, "q", ["a"], ["x", "y", "z", "w", "w"]), (3, " ", None, [" ", None]), (4, "q", ["k"], None)]
    df = spark.createDataFrame(rows, "sample_id long, query string, positive array<string>, negative array<string>")
    assert tuple(quality.sample_faults(df, "positive", "negative").first()) == (4, 1, 1)
    assert quality.empty_texts(df, "query", ["positive", "negative"]).first().asDict() == {"empty_query": 1, "without_positive": 1, "empty_positive": 0, "without_negative": 2, "empty_negative": 2}
    got = {(r["sample_id"], r["one_positive"]): (r["score"], r["worst_negative"]) for r in quality.suspicious_samples(df, "query", "positive", "negative").collect()}
    assert got == {(1, "a b"): (0.0, 1), (1, "c d"): (1.0, 4), (2, "a"): (0.0, 1), (3, None): (-1.0, 0), (4, "k"): (-1.0, 0)}


def test_pairs_without_language_are_compiled(spark, sf01, con01):
    assert con01.sql("select count(*) from pairs where lang is null").fetchall()[0][0] > 0
    want = con01.sql("select count(*) from (select distinct dataset, query_id, passage_id, lower(trim(coalesce(lang, ''))) from pairs)").fetchall()[0][0]
    assert tq._pair_keys(spark, sf01).count() == want


def test_every_positive_of_a_sample_is_batched(spark, tmp_path):
    rows = [("d", 1, "q", [" a", "b", "a", " ", None]), ("d", 2, "r", ["c"]), ("d", 3, "s", None), ("d", 4, None, ["e"])]
    spark.createDataFrame(rows, "dataset string, sample_id long, query string, positive array<string>").write.parquet(f"{tmp_path}/reranking_samples.parquet")
    d = str(tmp_path)
    assert sorted((r["anchor"], r["positive"]) for r in tq._rows(spark, d).collect()) == [("q", "a"), ("q", "b"), ("r", "c"), ("s", "")]
    assert tq.batch_plain(spark, d).count() == 4
    got = tq.batch_no_dup(spark, d).collect()
    assert len({(r["chunk"], r["batch"]) for r in got if r["row"].startswith("1|")}) == 2
    assert all(r["row"].split("|")[0] != r["negative_row"].split("|")[0] for r in tq.in_batch_negatives(spark, d).collect())


@pytest.mark.parametrize("name", ["rank_metrics", "rank_metrics_by_group", "macro_metrics"])
def test_runs_have_a_hundred_documents_without_the_query(spark, sf01, con01, name):
    query, text = rq.QUERIES[name]
    assert "where query <> passage qualify rk <= 100)" in text
    assert differences(spark, con01, sf01, query, text) is None
