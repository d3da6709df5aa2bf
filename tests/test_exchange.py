"""Sources, sinks, manifests and models that have no table of the test data."""

import hashlib
import json
import pickle

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace import schema
from millrace.functions import keys, models, russian, text, vector
from millrace.operators import batches, bm25, buckets, knn, metrics, store, training_rows
from millrace.sources import legacy, mini, sinks, tables


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_runs_in_both_forms(spark, tmp_path):
    run = spark.createDataFrame([("q 1", 'd"1', 0.5), ("q 1", "d2", -1.0), ("в2", "d1", 3.0)], "query_id string, doc_id string, score double")
    sinks.write_run(run, f"{tmp_path}/lines")
    sinks.write_run_object(run, f"{tmp_path}/object")
    pretty = tmp_path / "pretty.json"
    pretty.write_text(json.dumps({"q 1": {'d"1': 0.5, "d2": -1.0}, "в2": {"d1": 3.0}}, indent=4, ensure_ascii=False))
    for path in ("lines", "object", "pretty.json"):
        assert rows(tables.read_run(spark, f"{tmp_path}/{path}")) == rows(run), path
    assert len(json.loads(next((tmp_path / "object").glob("part-*")).read_text())) == 2
    sinks.write_run(run.limit(0), f"{tmp_path}/none")
    assert tables.read_run(spark, f"{tmp_path}/none").count() == 0


def test_mined_lists_are_read_in_lines_and_arrays(spark, tmp_path):
    rec = {"query_id": "q_ru", "query": None, "positive_ids": ["p1"], "hard_negatives": [{"passage_id": "n1", "score": 0.5, "avg_pos_score": 0.7, "rank": 3, "lang": "ru"}]}
    (tmp_path / "array.json").write_text(json.dumps([rec, rec], indent=2))
    df = tables.read_mined(spark, str(tmp_path), "array")
    assert df.count() == 2 and df.first()["hard_negatives"][0]["passage_id"] == "n1"
    sinks.write_mined(df, f"{tmp_path}/lines.json")
    sinks.write_mined(df.select("query_id", F.expr("transform(hard_negatives, h -> struct(h.passage_id as passage_id))").alias("hard_negatives")), f"{tmp_path}/few.parquet", "parquet")
    assert rows(tables.read_mined(spark, str(tmp_path), "lines")) == rows(df)
    assert tables.read_mined(spark, str(tmp_path), "few").first()["hard_negatives"][0]["score"] is None
    assert tables.read_mined(spark, str(tmp_path), "nothing").count() == 0


def test_corpus_queries_and_judgements(spark, tmp_path):
    (tmp_path / "corpus.jsonl").write_text('{"_id": "1", "title": null, "text": "a"}\n{"_id": "2", "title": "t", "text": "b"}\n')
    (tmp_path / "queries.jsonl").write_text('{"_id": 7, "text": "x"}\n')
    (tmp_path / "qrels.tsv").write_text("query-id\tcorpus-id\tscore\n7\t2\t1\n")
    assert rows(tables.read_corpus(spark, f"{tmp_path}/corpus.jsonl")) == [("1", "", "a"), ("2", "t", "b")]
    assert rows(tables.read_queries(spark, f"{tmp_path}/queries.jsonl")) == [("7", "x")]
    assert rows(tables.read_qrels(spark, f"{tmp_path}/qrels.tsv")) == [("7", "2", 1)]
    with pytest.raises(schema.ContractError):
        tables.read_qrels(spark, f"{tmp_path}/queries.jsonl")


def test_buckets_hash_as_stored_ones_do(spark, tmp_path):
    """Keys by hashlib itself: stripped ids, numbered sentinels, ids of their own for rows without one."""
    h = lambda s: int.from_bytes(hashlib.blake2b(s.encode(), digest_size=8).digest(), "little") & ((1 << 63) - 1)
    df = spark.createDataFrame([("r1", " q1 ", ["", " p "], " ", None), ("r2", None, [], "n", ""), ("r3", "", None, "n", " n2")], "row string, query_id string, positive array<string>, negative1 string, negative_2 string")
    got = {r["row"]: r for r in buckets.add_bucket(df, 8, row_key="row", algorithm="blake2b", negatives=["negative1", "negative_2"], stem="file").collect()}
    assert got["r1"]["query_key64"] == h("q1") and got["r1"]["bucket_id"] == h("q1") % 8 and got["r1"]["positive_key64"] == h("p")
    assert got["r2"]["query_key64"] == h("__missing_query_id__:r2") != got["r3"]["query_key64"] and got["r2"]["positive_key64"] == h("__empty_positive__")
    assert (got["r1"]["negative_key64_1"], got["r1"]["negative_key64_2"]) == (h("__empty_negative__:1"), h("__empty_negative__:2"))
    assert (got["r2"]["negative_key64_1"], got["r3"]["negative_key64_2"]) == (h("n"), h("n2")) and got["r1"]["lang"] == "" and got["r1"]["dataset"] == "file"
    bare = buckets.add_bucket(df.drop("positive"), 8, algorithm="blake2b").collect()
    assert len({r["positive_key64"] for r in bare}) == 3 and len({r["query_key64"] for r in bare}) == 3


def test_bucket_files_are_checked(spark, tmp_path):
    df = spark.range(40).select(F.lit("train").alias("split"), F.lit("d").alias("dataset"), (F.col("id") % 4).cast("int").alias("bucket_id"), F.col("id").cast("string").alias("query_id"))
    m = sinks.write_buckets(df.repartition(3), f"{tmp_path}/b")
    assert {"path", "part"} < set(m.columns) and m.agg(F.sum("n_rows")).first()[0] == 40 and m.where("part = 1").count() == 4
    assert tables.bucket_root(f"{tmp_path}/b/_manifest") == (f"{tmp_path}/b", "train") and tables.bucket_root("x/split=test/") == ("x", "test")
    assert tables.read_bucketed(spark, f"{tmp_path}/b/_manifest").count() == 40
    next((tmp_path / "b/split=train/dataset=d/bucket_id=2").glob("part-*")).unlink()
    with pytest.raises(schema.ContractError):
        tables.read_bucketed(spark, f"{tmp_path}/b", "train")
    with pytest.raises(schema.ContractError):
        sinks.write_buckets(df, f"{tmp_path}/b")


def test_shards_by_number_and_pattern(spark, tmp_path):
    for n in (0, 2, 11):
        spark.range(n + 1).write.parquet(f"{tmp_path}/group_0/shard_{n:04d}.parquet")
    df = tables.read_shards(spark, str(tmp_path), pattern="group_*/shard_*.parquet")
    assert {r["shard_id"]: r["count"] for r in df.groupBy("shard_id").count().collect()} == {0: 1, 2: 3, 11: 12}
    assert tables.read_shards(spark, str(tmp_path), [2, 11], pattern="group_*/shard_*.parquet").count() == 15


def test_older_vector_folders(spark, tmp_path):
    np.save(tmp_path / "passage_embeddings.npy", np.eye(3, dtype=np.float32)[:2])
    np.save(tmp_path / "query_embeddings.npy", np.ones((1, 3), np.float32))
    meta = {"p_keys": ["p1_ru", "p2_en"], "passage_langs": ["ru", "en"], "q_keys": ["q1_ru"], "query_langs": ["ru"], "idx_by_pid": {}, "queries": ["x"]}
    (tmp_path / "metadata.pkl").write_bytes(pickle.dumps(meta))
    got = legacy.read_embedding_folder(spark, str(tmp_path), "d").collect()
    assert sorted((r["id"], r["lang"], r["kind"], tuple(r["embedding"])) for r in got) == [("p1_ru", "ru", "passage", (1, 0, 0)), ("p2_en", "en", "passage", (0, 1, 0)), ("q1_ru", "ru", "query", (1, 1, 1))]
    (tmp_path / "metadata.pkl").write_bytes(pickle.dumps(meta | {"p_keys": ["p1_ru"]}))
    with pytest.raises(ValueError):
        legacy.read_embedding_folder(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        legacy.read_query_vectors(spark, str(tmp_path))
    (tmp_path / "query_embedding_by_text.pkl").write_bytes(pickle.dumps({"some text": [1.0, 2.0]}))
    assert legacy.read_query_vectors(spark, str(tmp_path)).first()["id"] == "some text"
    (tmp_path / "query_embedding.pkl").write_bytes(pickle.dumps({("q", "ru", "d"): [1.0]}))
    assert legacy.read_query_vectors(spark, str(tmp_path)).first()["dataset"] == "d"
    np.save(tmp_path / "passages_id_map.npy", {0: ("p", "text", "d", "ru"), 1: ("o", "text", "d", None)}, allow_pickle=True)
    assert rows(legacy.read_passage_places(spark, str(tmp_path))) == [("o", "", "d", 1), ("p", "ru", "d", 0)]
    (tmp_path / "passage_key_to_faiss.pkl").write_bytes(pickle.dumps({("p", "ru", "d"): 5}))
    assert rows(legacy.read_passage_places(spark, str(tmp_path))) == [("p", "ru", "d", 5)]


def test_pickled_store(spark, tmp_path):
    v = spark.createDataFrame([("d/1", "query", "a", "ru", 0, [1.0]), ("d/1", "query", "a", "ru", 1, [2.0]), ("d/1", "passage", "b", None, 0, [3.0])], "dataset string, kind string, id string, lang string, source_shard int, embedding array<float>")
    legacy.write_pickled(store.resolve(v), str(tmp_path))
    with open(tmp_path / "d_1/query_embeddings.pkl", "rb") as f:
        assert {k: x.tolist() for k, x in pickle.load(f).items()} == {("a", "ru"): [1.0]}
    assert (tmp_path / "d_1/passage_embeddings.pkl").exists()


def test_missing_vectors_come_from_the_model(spark):
    df = spark.createDataFrame([(1, "ab", [1.0, 0.0]), (2, "abc", None), (3, None, None)], "id int, text string, v array<float>")
    embed = models.embedder(lambda: lambda texts: [[float(len(t)), 1.0] for t in texts])
    assert rows(store.complete_vectors(df, "v", "id", "text", embed, 2)) == [(1, "ab", [1.0, 0.0]), (2, "abc", [3.0, 1.0]), (3, None, None)]
    with pytest.raises(schema.ContractError):
        store.complete_vectors(df, "v", "id", "text")
    with pytest.raises(schema.ContractError):
        store.complete_vectors(df, "v", "id", "text", embed, 3)


def test_counts_manifests_and_ordinals(spark, tmp_path):
    schema.require_counts(read=3, written=3)
    with pytest.raises(schema.ContractError, match="written 2"):
        schema.require_counts(read=3, written=2)
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "dataset string")
    assert rows(schema.count_differences(["dataset"], a=a, b=a.where("dataset = 'x'"))) == [("", 1, 0), ("y", 1, 0)]
    sinks.write_manifest(spark, f"{tmp_path}/m", top_k=30, datasets=sinks.filter_manifest(a, a.where("dataset = 'x'")).orderBy("dataset"))
    assert sinks.read_manifest(spark, f"{tmp_path}/m")["datasets"][1] == {"dataset": "x", "input_rows": 2, "output_rows": 2}
    df = spark.createDataFrame([(i % 7, i) for i in range(100)], "k int, v int").repartition(5)
    got = keys.with_ordinal(df, "k", F.desc("v")).orderBy("ordinal").collect()
    assert [r["ordinal"] for r in got] == list(range(100)) and [(r["k"], -r["v"]) for r in got] == sorted((i % 7, -i) for i in range(100))


def test_lists_by_either_key_and_cut_texts(spark):
    q = spark.createDataFrame([("q1_ru", "q1"), ("q2_ru", "q2"), ("q3_ru", None)], "a string, b string")
    mined = spark.createDataFrame([("q1_ru", "x"), ("q1", "y"), ("q2", "z")], "query string, passage string")
    assert rows(training_rows.mined_lists(q, mined, "a", "b")) == [("q1_ru", "q1", "x"), ("q2_ru", "q2", "z")]
    texts = spark.createDataFrame([("d", "q", "", "q" * 9), ("d", "p", "", "p" * 3), ("d", "n", "", "n" * 8)], "dataset string, id string, lang string, text string")
    recipe = spark.createDataFrame([("d", "q", "", "", "p", [("n", "")])], "dataset string, query_id string, query_lang string, passage_lang string, positive_id string, negatives array<struct<passage:string,lang:string>>")
    got = training_rows.with_texts(recipe, texts.withColumnRenamed("id", "query_id"), texts.withColumnRenamed("id", "passage_id"), 1, 5)
    r = got.first()
    assert (r["query"], r["positive"], r["negative1"], r["truncated"]) == ("q" * 5, "ppp", "n" * 5, 2)
    assert rows(training_rows.row_stats(got)) == [("d", 1, 2)]
    loss = spark.createDataFrame([(" q ", ["", "p"], None, 1)], "query string, positive array<string>, negative1 string, helper int")
    assert rows(training_rows.for_loss(loss, 1)) == [("q", "p", "")]
    with pytest.raises(schema.ContractError):
        training_rows.for_loss(loss.withColumn("query", F.lit(" ")), 1)


def test_backends(spark, tmp_path):
    (tmp_path / "config.json").write_text(json.dumps({"architectures": ["Qwen3ForCausalLM"], "model_type": "qwen3"}))
    assert models.model_kind(str(tmp_path)) == "cross-encoder" and models.model_kind("x/my-reranker", {"model_type": "llama"}) == "qwen-reranker"
    assert models.model_kind("a/Qwen-Reranker-4b", {}) == "qwen-reranker" and models.model_kind("jina-reranker-v3", {}) == "jina-v3"
    assert models.model_kind("x", {"auto_map": {"AutoModel": "modeling.JinaForRanking"}}) == "jina-v3"
    with pytest.raises(ValueError):
        models.reranker("x")
    models.register_backend("constant", lambda path, value: lambda: lambda q, d: [value] * len(q))
    df = spark.createDataFrame([(1, 2, "a", "b")], "query_id int, doc_id int, query_text string, doc_text string")
    assert metrics.rerank(df, models.reranker("x", "constant", value=0.25)).first()["score"] == 0.25
    assert models.reranker("", "word-overlap")()(["a b"], ["b c"]) == [1 / 3]


def test_metrics_by_language_counts_others_in_all_only(spark):
    df = spark.createDataFrame([("1", "ru", 1.0), ("2", "English", 0.0), ("3", None, 0.5), ("4", "fr", 0.5)], "query_id string, lang string, ap double")
    assert rows(metrics.metrics_by_language(df)) == [("all", 4, 0.5), ("en", 1, 0.0), ("ru", 1, 1.0)]


def test_tensors_and_small_tables(spark):
    t = spark.createDataFrame([("w", 0, [1.0, 0.0], True), ("w", 1, [0.0, 1.0], True), ("steps", 0, [5.0], False), ("steps", 1, [7.0], False)], "name string, model int, values array<double>, is_float boolean")
    got = {r["name"]: r["values"] for r in vector.merge_tensors(t).collect()}
    assert got["steps"] == [5.0] and np.allclose(got["w"], [0.5**0.5] * 2)
    p = mini.mini_pairs(spark, "mini_a", 25, ["ru", "en"])
    assert p.count() == 50 and p.where("query = 'query-mini_a-3-ru' and query_id = 'mini_a:q3:ru' and passage_id = 'mini_a:p3:ru'").count() == 1
    c = mini.mini_compiled(spark, ["mini_a", "mini_b"]).toPandas()
    assert len(c) == 40 and isinstance(c, pd.DataFrame)
    for r in c.itertuples(index=False):
        assert len(set(r[2:])) == 8 and r.positive not in r[2:]


def test_cells_find_most_and_all_with_all_probes(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16))
    x = np.concatenate([c + 0.4 * rng.normal(size=(25, 16)) for c in centres])
    ps = spark.createDataFrame([(i, i % 2, v.tolist()) for i, v in enumerate(x)] + [(9999, 0, None)], "passage int, half int, vector array<float>")
    qs = ps.where("passage % 10 = 0").withColumnRenamed("passage", "query")
    for metric in ("ip", "l2"):
        want = set(rows(knn.knn_join(qs, ps, 5, metric, ["half"]).select("query", "passage", "rank")))
        every = knn.knn_join_cells(qs, ps, 5, metric, ["half"], cells=8, probes=8)
        assert set(rows(every.select("query", "passage", "rank"))) == want
        some = set(rows(knn.knn_join_cells(qs, ps, 5, metric, ["half"], probes=6).select("query", "passage", "rank")))
        assert len({x[:2] for x in some} & {x[:2] for x in want}) >= 0.9 * len(want)
    assert knn.knn_join_cells(qs, ps.limit(0), 5).count() == 0 and knn.knn_join_cells(qs.limit(0), ps, 5).count() == 0


def test_bm25_by_join_equals_bm25_by_document(spark):
    docs = spark.createDataFrame([(i, " ".join(f"t{(i * j) % 23}" for j in range(1, 3 + i % 17))) for i in range(300)] + [(999, None), (998, ""), (7, "t1 t1 t2")], "doc_id long, text string")
    qs = spark.createDataFrame([("a", "t1 t2 t2"), ("b", "t22"), ("c", "none"), ("d", None), (None, "t3")], "query_id string, text string")
    one = rows(bm25.bm25(docs, qs, 20))
    assert one == rows(bm25.bm25(docs, qs, 20, most_terms=0)) and len({r[0] for r in one}) == 3
    assert bm25.bm25(docs.limit(0), qs).count() == 0 and bm25.bm25(docs, qs.limit(0)).count() == 0


def test_russian_stems(spark):
    # words and stems of the public vocabulary of the algorithm
    known = "вавиловка вавиловк важная важн важнее важн важности важност важнейшие важн вагоны вагон валандался валанда валентином валентин веровали верова вечерний вечерн падение паден падшая падш пакостей пакост в в памятный памятн партии парт пасмурно пасмурн".split()
    assert [russian.stem(w) for w in known[::2]] == known[1::2]
    docs = spark.createDataFrame([(1, "Новые вагоны на станции"), (2, "важное"), (3, None)], "doc_id int, text string")
    qs = spark.createDataFrame([(1, "новый вагон"), (2, "на")], "query_id int, text string")
    assert [(r["query_id"], r["doc_id"]) for r in bm25.bm25(docs, qs, analyzer=russian.analyze_russian).collect()] == [(1, 1)]


def test_token_budget_batch_keys_and_distances(spark):
    class Words:
        def encode(self, t):
            return t.split()

        def decode(self, ids):
            return " ".join(ids)

    df = spark.createDataFrame([(1, "a b  c"), (2, "a  b"), (3, None), (4, "")], "row int, t string")
    assert [r[0] for r in df.orderBy("row").select(text.truncate_tokens("t", 2, Words)).collect()] == ["a b", "a  b", "", ""]
    k = spark.createDataFrame([(1, 7, "q", "x", None), (2, None, "q", "x", 5), (3, None, None, None, None)], "row int, query_key64 long, query string, positive string, positive_key64 long")
    assert [(r["anchor"], r["positive"]) for r in batches.batch_keys(k).orderBy("row").collect()] == [("7", "x"), ("q", "5"), ("row 3", "row 3")]
    v = spark.createDataFrame([([1.0, 2.0], [4.0, 6.0])], "a array<float>, b array<double>")
    assert v.select(vector.l2_squared("a", "b")).first()[0] == 25.0
