"""Nulls, empties, very long texts, ties, repeats, empty tables, clashing extra columns, and hot groups."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import charform, groups, leaks, lookalike, mixing, neighbours, overlap, packing, splits
from millrace.llm.hnsw import Hnsw

SAMPLES = "sample_id long, split string, dataset string, lang string, query string, positive array<string>, negative array<string>, set_id int, train string, key int"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# -- 1 --------------------------------------------------------------------------------------------------------
def samples(spark, data):
    return spark.createDataFrame([(i, s, d, None, q, p, None, 1, "x", 2) for i, s, d, q, p in data], SAMPLES)


def test_overlap_edges(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    data = [
        (1, " TRAIN", "a", "red ferry near town", ["one two three"]), (2, "Val ", "a", "Red  ferry, near town!", ["ONE two three", None]), (2, "Val ", "a", "Red  ferry, near town!", ["ONE two three", None]),
        (3, "test", "b", "red ferry near town", ["other words here"]), (4, "train", "a", None, ["x"]), (5, "test", "a", None, ["x"]), (6, "train", "a", " ", None), (7, "validation", "a", "", []),
        (8, "train", "a", long, [long, ""]), (9, "test", None, long + " extra", [long + " more"]), (10, "dev", "a", "red ferry near town", ["one two three"]), (None, "train", "a", "red ferry near town", ["one two three"]),
        (11, "train", "a", "solo", ["solo"]), (12, "test", "a", "SOLO.", ["solo?"]), (13, None, "a", "solo", ["solo"]),
    ]
    df = samples(spark, data)
    assert rows(overlap.overlap_pairs(spark, df)) == [(1, 2), (8, 9), (11, 12)]
    report = {(r["split"], r["dataset"]): (r["samples"], r["overlapping"], r["pairs"], r["equal_pairs"]) for r in overlap.overlap_report(spark, df).collect()}
    assert report == {("validation", "a"): (2, 1, 1, 1), ("test", "b"): (1, 0, 0, 0), ("test", "a"): (2, 1, 1, 1), ("test", None): (1, 1, 1, 0)}
    assert overlap.overlap_pairs(spark, df.limit(0)).count() == 0


def test_overlap_of_a_query_that_many_share(spark):
    rng = random.Random(1)
    data = [(i, "train" if i % 3 else "test", "a", "what is this", [f"text number {i // 2} {rng.random()}"]) for i in range(900)]
    data += [(2000, "train", "a", "what is this", ["twin text"]), (2001, "test", "a", "what is this", ["twin text"])]
    assert rows(overlap.overlap_pairs(spark, samples(spark, data))) == [(2000, 2001)]


@pytest.mark.parametrize("seed", range(2))
def test_agreeing_sets_lose_nothing(spark, seed, monkeypatch):
    """Sets of all sizes around the borders of the bands, made by changing some words of others."""
    rng = random.Random(seed)
    sets = []
    for n in [1, 2, 3, 4, 5, 9, 12, 16, 17, 18, 20, 23, 24, 25, 26, 30, 55, 56, 57, 79, 80, 81, 90, 120]:
        for _ in range(3):
            base = rng.sample(range(400), n)
            sets.append(base)
            for _ in range(4):
                s = list(base)
                for _ in range(rng.randint(0, max(1, n // 5))):
                    s[rng.randrange(n)] = rng.randrange(1000)
                sets.append(s[: max(1, n - rng.randint(0, n // 5))])
    sets = sorted({tuple(sorted(set(s))) for s in sets})
    df = spark.createDataFrame([(0, i, list(s), i % 2 == 0, i % 3 > 0) for i, s in enumerate(sets)], "scope long, set_id long, words array<bigint>, left boolean, right boolean")
    want = sorted((0, i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if i % 2 == 0 and j % 3 > 0 and len(set(a) & set(b)) * 10 >= 7 * len(set(a) | set(b)))
    assert rows(overlap.agreeing_sets(spark, df, 0.7)) == want and len(want) > 100
    monkeypatch.setattr(overlap, "HOT", 0)
    monkeypatch.setattr(overlap, "SHORT", 8)  # nearly all by parts, so small that many are empty
    assert rows(overlap.agreeing_sets(spark, df, 0.7)) == want
    monkeypatch.setattr(overlap, "SHORT", 12)  # every shared hash is hot and made longer
    small = {i for i, s in enumerate(sets) if len(s) <= 12}
    assert rows(overlap.agreeing_sets(spark, df.where("size(words) <= 12"), 0.7)) == [x for x in want if {x[1], x[2]} <= small]


def test_sets_of_few_scopes_are_compared_as_they_are(spark):
    data = [(i // 4, i, sorted({1, 2, 3, 4, 5, 6, 7, 8, i % 3}), i % 2 == 0, i % 2 == 1) for i in range(40)]
    df = spark.createDataFrame(data, "scope long, set_id long, words array<bigint>, left boolean, right boolean")
    assert rows(overlap.agreeing_sets(spark, df, 0.7)) == rows(overlap.agreeing_sets(spark, df, 0.7, few=0)) == sorted((s, a, b) for s, a, _, l, _ in data for t, b, _, _, r in data if s == t and l and r)


def test_long_sets_of_common_words_give_few_candidates(spark, tmp_path):
    """Sets of 150 of 30,000 words, of which none agree: candidates don't grow with the square of the sets."""
    from millrace.session import Scratch

    for n, template in ((2000, 0), (2000, 60)):
        rng = np.random.default_rng(5)
        data = [(0, i, sorted({*range(-template, 0), *rng.choice(30_000, 150 - template, replace=False).tolist()}), i % 2 == 0, i % 2 == 1) for i in range(n)]
        data += [(0, n, data[7][2][:140] + [90_000, 90_001], True, False)]
        df = spark.createDataFrame(data, "scope long, set_id long, words array<bigint>, left boolean, right boolean")
        found = overlap._long_candidates(spark, df, 700, Scratch(spark, "test"))
        assert found.where(f"a = {n} and b = 7").count() == 1 and found.count() < 2 * n


def test_a_phrase_that_many_queries_share(spark):
    """Two thousand queries differ in one word of four: none agree, and no hash leads to all pairs of them."""
    data = [(0, i, sorted([1, 2, 3, 100 + i]), i % 2 == 0, i % 2 == 1) for i in range(2000)] + [(0, 5000, [1, 2, 3], True, True)]
    df = spark.createDataFrame(data, "scope long, set_id long, words array<bigint>, left boolean, right boolean")
    want = [(0, i, 5000) for i in range(0, 2000, 2)] + [(0, 5000, i) for i in range(1, 2000, 2)] + [(0, 5000, 5000)]
    assert rows(overlap.agreeing_sets(spark, df, 0.7)) == sorted(want)


# -- 2 --------------------------------------------------------------------------------------------------------
ITEMS, CAPS = "item long, dataset string, size long", "dataset string, capacity long"


def test_packing_edges(spark):
    caps = spark.createDataFrame([("A ", 10), ("b", 0), ("c", None)], CAPS)
    items = spark.createDataFrame([(1, "a", 25), (2, "a", 10), (3, "a", None), (4, "a", -3), (5, "b", 7), (6, None, 7), (7, "a", 20), (8, "c", None)], ITEMS)
    got = packing.pack(spark, items, caps).collect()
    pieces = defaultdict(list)
    for r in got:
        pieces[r["item"]].append(r["size"])
    assert {k: sorted(v) for k, v in pieces.items()} == {1: [5, 10, 10], 2: [10], 3: [0], 4: [0], 5: [7], 6: [7], 7: [10, 10], 8: [0]}
    load = Counter()
    for r in got:
        if r["dataset"] == "a":
            load[r["bin_id"]] += r["size"]
    assert max(load.values()) <= 10 and sorted(load) == list(range(len(load))) and len(load) == 6
    assert packing.pack(spark, items.limit(0), caps).count() == 0
    assert packing.pack(spark, items, caps.limit(0)).count() == 8


def test_packing_in_many_rounds(spark):
    rng = random.Random(4)
    sizes = [rng.choice([1, 2, 3, 7, 12, 30, 51, 60, 99, 100, 250]) for _ in range(3000)]
    items = spark.createDataFrame([(i, "a" if i % 3 else "b", n) for i, n in enumerate(sizes)], ITEMS)
    got = packing.pack(spark, items, spark.createDataFrame([("a", 100), ("b", 120)], CAPS), chunk=50, fan_in=4).collect()
    load, of, parts = Counter(), Counter(), defaultdict(set)
    for r in got:
        load[r["dataset"], r["bin_id"]] += r["size"]
        of[r["item"]] += r["size"]
        parts[r["item"]].add(r["piece"])
    assert all(of[i] == n for i, n in enumerate(sizes))
    assert all(len(parts[i]) == 1 for i, n in enumerate(sizes) if n <= 100)
    for d, cap in (("a", 100), ("b", 120)):
        mine = [n for (x, _), n in load.items() if x == d]
        at_once = max(packing.best_fit([r["size"] for r in got if r["dataset"] == d], cap)) + 1
        assert max(mine) <= cap and len(mine) <= 1.03 * at_once + 1


@pytest.mark.parametrize("seed", range(3))
def test_packing_loses_nothing_by_sending_up_the_roomiest(spark, seed):
    """As few bins as if every underfull bin went up."""
    rng = random.Random(seed)
    sizes = [rng.choice([rng.randint(1, 30), rng.randint(30, 100), rng.randint(51, 70)]) for _ in range(2500)]
    items = spark.createDataFrame([(i, "a", n) for i, n in enumerate(sizes)], ITEMS)
    caps = spark.createDataFrame([("a", 100)], CAPS)
    count = lambda **o: packing.pack(spark, items, caps, chunk=40, fan_in=4, **o).select("bin_id").distinct().count()
    some = count()
    assert some <= count(all_up=True)


def test_current_row_ties(spark):
    a = spark.createDataFrame([(1, "A", 5, 0, None), (1, "a ", 9, 1, "2024-01-01"), (1, "a", 9, 2, "2024-01-01"), (2, None, None, None, None), (None, "a", 1, 1, None)], "root long, dataset string, row_count long, shard_id int, at string").withColumn("assigned_at", F.to_timestamp("at"))
    assert rows(packing.current_rows(a).select("root", "dataset", "row_count", "shard_id").where("root = 1")) == [(1, "a", 9, 2)]
    assert packing.current_rows(a).count() == 2


# -- 3, 4 -----------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("seed", range(2))
def test_groups_against_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(250)] + [(i, i + 1) for i in range(1000, 1100)] + [(2000, i) for i in range(2001, 2300)] + [(3, None), (None, 4), (9, 9), (9, 9)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges, "a long, b long")
    assert rows(groups.connected_groups(spark, df)) == sorted((x, find(x)) for x in list(parent))
    assert groups.connected_groups(spark, df.limit(0)).count() == 0


NODES, KEYS = "id long, parent long, size int, a string, grp int", "kind string, value string, lang string, dataset string, node_id long, node int"


def nodes(spark, data):
    return spark.createDataFrame([(i, p, 1, "x", 0) for i, p in data], NODES)


def scoped(spark, data):
    return spark.createDataFrame([(*k, n, 0) for *k, n in data], KEYS)


def test_node_groups_edges(spark):
    n = nodes(spark, [(1, 2), (2, 1), (3, 99), (4, None), (5, 5), (6, 3), (None, 1), (4, None), (7, None)])
    k = scoped(spark, [("q", " v", None, "d", 4), ("q", "v", "", "d", 5), ("q", "V", "", "d", 6), ("p", "v", "", "d", 7), ("q", "v", "", "d", None), ("q", "z", "", "d", 50), ("q", "z", "", "d", 7), ("q", "z", "", "d", 1)])
    assert rows(groups.node_groups(spark, n, k)) == [(1, 1), (2, 1), (3, 3), (4, 4), (5, 4), (6, 3), (7, 1)]
    assert groups.node_groups(spark, n.limit(0), k).count() == 0
    assert groups.node_groups(spark, n, k.limit(0)).count() == 7


def test_a_hot_key_gives_no_pairs(spark):
    n = nodes(spark, [(i, None) for i in range(3000)])
    k = scoped(spark, [("q", "hot", "en", "d", i) for i in range(1500)])
    links = groups.node_links(n, k)
    assert links.count() == 3000 + 1499
    got = dict(rows(groups.node_groups(spark, n, k)))
    assert all(got[i] == (0 if i < 1500 else i) for i in range(3000))


def test_splits_with_a_giant(spark):
    """A component with a third of the records, many small ones and rare labels: shares hold, nothing is torn."""
    rng = random.Random(6)
    n = nodes(spark, [(i, 0 if i < 600 else None) for i in range(1, 1800)] + [(0, None)])
    k = [("query", f"v{i}", rng.choice(["en", "en", "ru", None]), "d" if i % 50 else "rare", i) for i in range(1800)] + [("query", "v5", "de", "d", 1700)]
    t = spark.createDataFrame([("train", 0.8), ("validation", 0.1), ("test", 0.1)], "split_name string, target_share double")
    keys = scoped(spark, k)
    for chunk in (8192, 100):
        got = splits.grouped_split(spark, nodes=n, keys=keys, targets=t, chunk=chunk).collect()
        of = {r["value"]: r["split_name"] for r in got}
        assert len(of) == 1800 and len({of[f"v{i}"] for i in range(600)} | {of["v1700"]}) == 1
        share = Counter(of.values())
        assert all(abs(share[s] / 1800 - w) < 0.03 for s, w in (("train", 0.8), ("validation", 0.1), ("test", 0.1)))
        rare = Counter(of[f"v{i}"] for i in range(600, 1800, 50))
        assert rare["validation"] and rare["test"]
    assert splits.grouped_split(spark, n, keys, t.limit(0)).count() == 0
    assert splits.grouped_split(spark, n, keys.limit(0), t).count() == 0


def test_torn_edges(spark):
    n = nodes(spark, [(1, None), (2, None), (3, None)])
    k = scoped(spark, [("q", "v", "en", "d", 1), ("q", " v", "ru", "d", 2), ("q", "w", None, "d", 3), ("q", "gone", None, "d", 77)])
    a = spark.createDataFrame([(1, "d", 1, 0, "2024-01-01"), (2, "d", 1, 1, "2024-01-01"), (2, "d", 1, 0, "2023-01-01"), (3, "d", 1, None, "2024-01-01"), (88, "d", 1, 5, "2024-01-01")], "root long, dataset string, row_count long, shard_id int, at string").withColumn("assigned_at", F.to_timestamp("at"))
    t = spark.createDataFrame([("train", 0.5), ("test", 0.5)], "split_name string, target_share double")
    assert rows(splits.torn_entities(spark, n, k, a, t)) == [("d", "q", "v")]
    assert splits.torn_entities(spark, n, k, a.limit(0), t).count() == 0 and splits.torn_entities(spark, n, k, a, t.limit(0)).count() == 0
    placed = {r["value"]: (r["first_shard"], r["last_shard"]) for r in splits.grouped_split(spark, n, k, t, assignments=a).collect()}
    assert placed == {"v": (0, 1), "w": (None, None), "gone": (None, None)}


# -- 5 --------------------------------------------------------------------------------------------------------
VECTORS = "id string, lang string, dataset string, kind string, embedding array<float>, dim int, source_shard int, vec string, m int"


def vectors(spark, data):
    return spark.createDataFrame([(i, None, None, k, e, None, s, "x", 1) for i, k, e, s in data], VECTORS)


def test_neighbour_edges(spark):
    e = np.eye(4).tolist()
    data = [(f"c{i}", "q", e[0], 1) for i in range(9)] + [("near", "q", [1.0, 0.1, 0.0, 0.0], 1), ("c0", "q", e[3], 5), ("bad", "q", [0.0] * 4, 0), ("bad", "q", e[1], 3), ("null", "q", None, 0), ("short", "q", [1.0], 0), ("hole", "q", [1.0, None, 0.0, 0.0], 0), ("alone", "p", e[0], 0), (None, "q", e[0], 0), ("nan", "q", [float("nan"), 0.0, 0.0, 1.0], 0)]
    got = neighbours.most_similar(spark, vectors(spark, data), 5, 4).collect()
    near = defaultdict(list)
    for r in sorted(got, key=lambda r: r["rank"]):
        near[r["id"]].append(r["other"])
    assert set(near) == {*(f"c{i}" for i in range(9)), "near", "bad"}
    assert near["c0"] == ["c1", "c2", "c3", "c4", "c5"] and near["c3"] == ["c0", "c1", "c2", "c4", "c5"] and near["near"] == ["c0", "c1", "c2", "c3", "c4"]
    assert neighbours.most_similar(spark, vectors(spark, data).limit(0), 5, 4).count() == 0
    pairs = rows(neighbours.similar_pairs(spark, vectors(spark, data), dim=4))
    assert ("c0", "c1") in pairs and ("c7", "near") not in pairs and all(a < b for a, b in pairs)


def test_neighbour_recall_over_many_shards(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(300, 128))
    x = np.concatenate([rng.normal(size=(1500, 128)), *(c + 0.3 * rng.normal(size=(8, 128)) for c in centres), np.tile(centres[:1], (1500, 1))])
    df = vectors(spark, [(f"v{i:05d}", "q", v.tolist(), 0) for i, v in enumerate(x)])
    got = neighbours.most_similar(spark, df, 5, shard=400)
    found = defaultdict(set)
    for r in got.collect():
        found[r["id"]].add(r["other"])
    u = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)
    hit = total = 0
    for i in range(0, 3900, 7):
        s = u @ u[i]
        s[i] = -9
        for j in np.argsort(-s, kind="stable")[:5]:
            if s[j] >= 0.8:
                total += 1
                hit += f"v{j:05d}" in found[f"v{i:05d}"]
    assert total > 500 and hit / total >= 0.95


def test_a_large_kind_leaves_the_shards_of_the_others(spark, monkeypatch):
    """The width of shards is each kind's own, and stored graphs hold every vector once."""
    from millrace.session import Scratch

    monkeypatch.setattr(neighbours, "CENTROIDS", 4)
    rng = np.random.default_rng(2)
    df = vectors(spark, [(f"a{i}", "a", rng.normal(size=8).tolist(), 0) for i in range(1500)] + [(f"b{i}", "b", rng.normal(size=8).tolist(), 0) for i in range(150)])
    reps = neighbours.usable_vectors(df, 8).select("kind", F.md5("vec").alias("m"), "vec")
    graphs, _, plan = neighbours.build_graphs(spark, reps, 8, 2, 40, Scratch(spark, "test"))
    held = graphs.select("kind", F.size("names").alias("n"), F.octet_length("vectors").alias("bytes")).collect()
    assert all(r["bytes"] == r["n"] * 32 for r in held)
    assert sum(r["n"] for r in held if r["kind"] == "a") == 1500 and sum(r["n"] for r in held if r["kind"] == "b") == 150
    assert max(r["n"] for r in held if r["kind"] == "b") <= 80


def test_a_stored_graph_gives_the_same_neighbours():
    x = np.random.default_rng(1).normal(size=(700, 16)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1)[:, None]
    g = Hnsw(x)
    s = g.to_bytes()
    again = Hnsw.from_bytes(16, s["vectors"], s["neighbours"], s["degrees"], s["entry"], s["entry_level"])
    assert (again.search(x[:50], 6)[0] == g.search(x[:50], 6)[0]).all()


def test_graph_of_few_vectors():
    assert Hnsw(np.zeros((0, 4), np.float32)).search(np.zeros((2, 4), np.float32), 3)[0].tolist() == [[-1] * 3] * 2
    one = Hnsw(np.eye(4, dtype=np.float32)[:1])
    assert one.search(np.eye(4, dtype=np.float32), 2)[0][0].tolist() == [0, -1]


# -- 6 --------------------------------------------------------------------------------------------------------
def test_leak_edges(spark):
    item = " ".join(f"w{i}" for i in range(20))
    items = spark.createDataFrame([(1, item, "a"), (2, "short item", "b"), (3, None, "c"), (4, "", "d"), (5, "!!!", "e"), (1, item, "a"), (6, "rep rep rep", "f")], "item_id long, text string, id string")
    docs = [
        (10, "x " + " ".join(f"W{i}," for i in range(3, 15)) + " y"), (11, " ".join(f"w{i}" for i in range(3, 14))), (12, "a SHORT—item, b"), (13, "short b item"), (14, None), (15, ""), (16, "z " * 200_000 + item + " short item"),
        (17, " ".join(f"w{i}" for i in range(6)) + " gap " + " ".join(f"w{i}" for i in range(6, 20))), (18, "rep rep rep rep"), (19, "rep rep"), (12, "a SHORT—item, b"),
    ]
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in docs], "doc_id long, text string, item int, term string")
    got = leaks.leaked_passages(spark, df, items)
    assert rows(got.select("doc_id", "item_id")) == [(10, 1), (12, 2), (16, 1), (16, 2), (17, 1), (18, 6)]
    at = {(r["doc_id"], r["item_id"]): (r["doc_from"], r["item_from"], r["run"], r["item_words"]) for r in got.collect()}
    assert at[10, 1] == (1, 3, 12, 20) and at[16, 1] == (200_000, 0, 20, 20) and at[17, 1] == (7, 6, 14, 20)
    assert leaks.leaked_passages(spark, df.limit(0), items).count() == 0
    assert leaks.leaked_passages(spark, df, items.limit(0)).count() == 0


def test_proximity(spark):
    words = [f"w{i}" for i in range(20)]
    items = spark.createDataFrame([(1, " ".join(words)), (2, "red fox ran far away"), (3, "solo"), (4, None)], "item_id long, text string")
    insert = words[:6] + ["x"] + words[6:12] + ["y", "z"] + words[12:]
    docs = [
        (1, " ".join(insert)), (2, " ".join(w for i, w in enumerate(words) if i % 6 != 3)), (3, " ".join(w for i, w in enumerate(words) if i % 3)), (4, "a RED fox, ran away far b"),
        (5, "red fox ran a b c d e far away"), (6, " ".join(words[:13])), (7, "solo"), (8, None), (9, ""), (10, "q " * 1000 + "red fox x ran far away " + "q " * 1000), (11, "fox ran far " + "w0 " * 50),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["match"], r["run"], r["doc_from"]) for r in leaks.passages(spark, df, items).collect()}
    assert got == {(1, 1): ("proximity", 12, 0), (2, 1): ("proximity", 10, 0), (4, 2): ("proximity", 5, 1), (6, 1): ("exact", 13, 0), (7, 3): ("exact", 1, 0), (10, 2): ("proximity", 5, 1000)}
    assert leaks.passages(spark, df.limit(0), items).count() == 0 and leaks.passages(spark, df, items.limit(0)).count() == 0


def test_a_stored_index_serves_many_searches(spark, tmp_path):
    docs = spark.createDataFrame([(i, " ".join(f"t{(i * 7 + j) % 90}" for j in range(60))) for i in range(40)] + [(99, None)], "doc_id long, text string")
    index = leaks.store_index(docs, f"{tmp_path}/index", buckets=4)
    assert index.count() == 2400
    for at in (5, 30):
        items = spark.createDataFrame([(1, " ".join(f"t{j % 90}" for j in range(at, at + 15)))], "item_id long, text string")
        want = rows(leaks.leaked_passages(spark, docs, items))
        assert rows(leaks.leaked_passages(spark, None, items, index=index)) == want and want


def test_a_passage_in_a_third_of_all_documents(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen"
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("so "), F.lit(item), F.lit(" it is"))).otherwise(F.concat(F.lit("filler "), F.col("id").cast("string"))).alias("text"))
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert leaks.leaked_passages(spark, docs, items).count() == 1000


# -- 7 --------------------------------------------------------------------------------------------------------
DOCS, TARGETS = "doc_id long, text string, source string, size int, n int", "source string, target_share double, max_repeats int"


def test_mix_edges(spark):
    docs = spark.createDataFrame([(1, "a b c", " A", 0, 0), (2, None, "a", 0, 0), (3, "", "a", 0, 0), (4, "x y", "B", 0, 0), (5, "z", None, 0, 0), (6, "q r", "other", 0, 0)], DOCS)
    t = spark.createDataFrame([("a", 0.9, 1), ("b ", 0.05, 3), ("none", 0.05, None)], TARGETS)
    plan = {r["source"]: r for r in mixing.shares(spark, docs, t).collect()}
    assert (plan["a"]["size"], plan["a"]["taken"], plan["a"]["short"]) == (3, 3, True)
    assert (plan["b"]["size"], plan["b"]["short"]) == (2, False) and (plan["none"]["size"], plan["none"]["short"]) == (0, True)
    assert rows(mixing.mix(spark, docs, t).select("doc_id", "repeats")) == [(1, 1), (2, 1), (3, 1)]
    assert mixing.mix(spark, docs.limit(0), t).count() == 0 and mixing.shares(spark, docs, t.limit(0)).count() == 0


def test_mix_of_many_equal_lengths(spark, monkeypatch):
    """All documents of one length: the taken ones are ranked in chunks, and are as many as planned."""
    monkeypatch.setattr(mixing, "CHUNK", 100)
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.when(F.col("id") < 1500, "a").otherwise("b").alias("source"))
    t = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 3)], TARGETS)
    got = mixing.mix(spark, docs, t).groupBy("source").agg(F.sum(F.col("size") * F.col("repeats")).alias("n"), F.max("repeats").alias("r")).collect()
    assert {r["source"]: (r["n"], r["r"]) for r in got} == {"a": (3000, 1), "b": (3000, 2)}


def test_tokenizer_sizes(spark):
    df = spark.createDataFrame([(1, "hello world"), (2, None), (3, ""), (4, "слово " * 5000)], "i int, t string")
    got = {r[0]: r[1] for r in df.select("i", mixing.tokenizer_size()(F.col("t"))).collect()}
    assert 2 <= got[1] <= 3 and got[2] == got[3] == 0 and got[4] >= 5000


# -- 8 --------------------------------------------------------------------------------------------------------
def test_look_alike_edges(spark):
    data = [
        (1, "Мост 10 m"), (2, "Mоcт 10 m"), (3, "Мо­ст 10 ｍ"), (4, "Мост 1О m"), (5, "мост 10 m"), (6, "ёж й"), (7, "ёж й"), (8, "ëж й"), (9, "еж й"), (10, "m²"), (11, "m2"),
        (12, "a  b"), (13, "a b"), (14, "a b"), (15, ""), (16, "​"), (17, None), (18, "Мост 10 m"), (19, "e‍̈"), (20, "ё"), (21, "a\tb"),
    ]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in data], "doc_id long, text string, form string, raw string")
    want = {(1, 2), (1, 3), (2, 3), (2, 18), (3, 18), (6, 7), (6, 8), (7, 8), (13, 14), (15, 16), (19, 20)}
    assert set(rows(lookalike.look_alike_pairs(spark, df))) == want
    forms = {r["doc_id"]: r["text_form"] for r in lookalike.normalise_text(df).collect()}
    assert forms[17] is None and forms[1] == forms[2] == forms[3] == forms[18] and forms[16] == "" and forms[12] == forms[13].replace(" ", "  ")
    assert set(lookalike.normalise_text(df).columns) == {*df.columns, "text_form"}
    assert lookalike.look_alike_pairs(spark, df.limit(0)).count() == 0
    c = {r["doc_id"]: (r["class_id"], r["n_texts"], r["n_rows"]) for r in lookalike.form_classes(df).collect()}
    assert c[18] == (1, 3, 4) and 17 not in c


def test_copies_of_one_text_are_no_pairs(spark):
    df = spark.range(2000).select(F.col("id").alias("doc_id"), F.when(F.col("id") == 7, "cоpy").otherwise("copy").alias("text"))
    got = rows(lookalike.look_alike_pairs(spark, df))
    assert len(got) == 1999 and all(7 in p for p in got)


def test_pairs_of_a_frequent_and_some_rare_texts_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(lookalike, "BLOCK", 50)
    rows_ = [(i, "сору" if i % 5 else ("copy" if i % 2 else "coрy")) for i in range(600)]
    df = spark.createDataFrame(rows_, "doc_id long, text string")
    want = {(a, b) for a, x in rows_ for b, y in rows_ if a < b and x != y}
    got = rows(lookalike.look_alike_pairs(spark, df))
    assert len(got) == len(want) and set(got) == want


def test_letters_of_one_shape_where_case_is_set_aside():
    assert charform.words("lӏ") != charform.words("iӀ") and charform.words("Ӕther Ҽ") == charform.words("ÆTHER ҽ")
    assert len({tuple(charform.words(w)) for w in ("link", "iink", "van", "nan")}) == 4


def test_form_is_stable_under_rewriting():
    table = charform.rewrites({"е": 5, "a": 1, "о": 3})
    rewrite = charform.Rewriter(table)
    for t in ["Ångström é ё", "ｆｕｌｌ　ｗｉｄｔｈ", "а̣́ ạ́", "K Å"]:
        assert rewrite(rewrite(t)) == rewrite(t)
