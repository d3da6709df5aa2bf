"""The eight problems against brute force over whole small tables."""

import itertools
import re
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from millrace.llm import charform, queries


def rows(d, t):
    return pq.read_table(f"{d}/{t}.parquet").to_pylist()


def got(df):
    out = [tuple(r) for r in df.collect()]
    assert len(out) == len(set(out)), "rows are not distinct"
    return set(out)


# -- plain forms, written without the module's tables of rewrites --------------------------------------------
SHAPE = {}
for group in charform.SAME_SHAPE:
    for c in group:
        SHAPE[c] = group[0]


def plain_form(text):
    out = []
    for c in unicodedata.normalize("NFD", "".join(c for c in text if not any(a <= ord(c) <= b for a, b in charform.NO_WIDTH))):
        d = unicodedata.decomposition(c)
        if d.startswith(("<wide>", "<narrow>")):
            c = chr(int(d.split()[1], 16))
        if unicodedata.category(c) == "Zs":
            c = " "
        out.append(SHAPE.get(c, c))
    return unicodedata.normalize("NFD", "".join(out))


CASELESS = {}
for group in charform.SAME_SHAPE:  # letters that are reached by shape or case
    joined = {y for x in group if x not in charform.ONE_CASE for y in (x, x.lower())}
    joined = joined.union(*(CASELESS.get(x, set()) for x in joined))
    for x in joined:
        CASELESS[x] = joined


def plain_words(text):
    if not text:
        return []
    text = "".join(c for c in text if not any(a <= ord(c) <= b for a, b in charform.NO_WIDTH))
    text = unicodedata.normalize("NFC", text)
    out = []
    for w in re.findall(r"(?:[^\W_][̀-ͯ]*)+", text):
        chars = []
        for c in unicodedata.normalize("NFD", w):
            d = unicodedata.decomposition(c)
            if d.startswith(("<wide>", "<narrow>")):
                c = chr(int(d.split()[1], 16))
            c = c.lower()
            same = [x.lower() for x in CASELESS.get(c, {c}) if x not in charform.ONE_CASE] or [c]
            chars.append(min(same))
        out.append(unicodedata.normalize("NFD", "".join(chars)))
    return out


#: Confusable by Unicode's table, but a reader can tell them apart: letters of the table's classes that are no members of ours.
SEEN = set("ȜЗϴΘϒɎҰɑαƄЬƂБƀѣҍҽıɩɪιƖƞησϱrгɍғƽʋuυɯѡɣʏγɏұßβϐƿĸκϰкƅьЛȝɜзɸφϕфπϖптτɛεϵєԑυᴛӏү")


def test_shapes_are_those_of_the_public_table(spark):
    """Letters of one case and of different scripts with one skeleton in ICU are one class, and a class has one skeleton."""
    icu = spark._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
    blocks = ((0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x2AF), (0x370, 0x3FF), (0x400, 0x52F))
    skeleton = defaultdict(list)
    for c in (chr(cp) for lo, hi in blocks for cp in range(lo, hi + 1)):
        if unicodedata.category(c) in ("Lu", "Ll") and unicodedata.normalize("NFD", c) == c and c not in SEEN:
            skeleton[icu.getSkeleton(c), unicodedata.category(c)].append(c)
    table = charform.rewrites({})
    form = charform.Rewriter(table)
    for letters in skeleton.values():
        if len({unicodedata.name(c).split()[0] for c in letters}) > 1:
            assert len({form(c) for c in letters}) == 1, letters
    for shape in charform.SAME_SHAPE:
        assert len({icu.getSkeleton(c) for c in shape}) == 1 or shape in ("QԚ", "lӏ"), shape


def test_words_agree_with_the_plain_form(sf):
    seen = {}
    for t in [r["text"] for r in rows(sf, "documents")] + ["Bода ВОДА Βодa", "ëж ëж ЁЖ", "ў ў", "a­b ａｂ", "m² m2"]:
        mine, plain = charform.words(t), plain_words(t)
        assert len(mine) == len(plain)
        for m, p in zip(mine, plain):
            assert seen.setdefault(m, p) == p
    assert len(set(seen.values())) == len(seen)


def jaccard(a, b):
    return 0 if not a or not b else len(a & b) / len(a | b)


def test_p1(spark, sf, sf01):
    for d in (sf, sf01):
        samples = {}
        for r in rows(d, "reranking_samples"):
            s = r["split"].strip().lower()
            samples[r["sample_id"]] = ({"val": "validation"}.get(s, s), set(plain_words(r["query"])), [set(plain_words(p)) for p in r["positive"] or []])
        train = [(i, q, p) for i, (s, q, p) in samples.items() if s == "train"]
        held = [(i, q, p) for i, (s, q, p) in samples.items() if s in ("validation", "test")]
        want = set()
        for i, q, p in train:
            for j, r, o in held:
                if q & r and jaccard(q, r) >= 0.7 - 1e-12 and any(jaccard(x, y) >= 0.7 - 1e-12 for x in p for y in o):
                    want.add((min(i, j), max(i, j)))
        assert got(queries.p1_found(spark, d)) == want and want
    report = queries.p1_report(spark, d).collect()
    assert sum(r["pairs"] for r in report) == len(want)
    assert sum(r["samples"] for r in report) == len(held)


def current(d):
    best = {}
    for r in rows(d, "component_assignments"):
        k = (r["assigned_at"], -1 if r["row_count"] is None else r["row_count"], -1 if r["shard_id"] is None else r["shard_id"])
        if r["root"] not in best or k > best[r["root"]][0]:
            best[r["root"]] = (k, r)
    return {root: r for root, (_, r) in best.items()}


def test_p2(spark, sf01):
    caps = {r["dataset"]: r["capacity"] for r in rows(sf01, "shard_capacity")}
    now = current(sf01)
    want = {(root,) for root, r in now.items() if (r["row_count"] or 0) > caps[r["dataset"].strip().lower()]}
    assert got(queries.p2_found(spark, sf01)) == want and want
    packed = queries.p2_shards(spark, sf01).collect()
    load, of = Counter(), Counter()
    for p in packed:
        load[p["dataset"], p["shard_id"]] += p["rows"]
        of[p["root"]] += p["rows"]
    assert of.keys() == now.keys() and all(of[k] == (r["row_count"] or 0) for k, r in now.items())
    assert all(n <= caps[k[0]] for k, n in load.items())
    total, bins = Counter(), Counter()
    for (k, _), n in load.items():
        total[k] += n
        bins[k] += 1
    assert sum(bins[k] for k in total) <= 1.02 * sum(-(-total[k] // caps[k]) for k in total) + len(total)


def brute_groups(d):
    parent = {}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def union(a, b):
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)

    nodes = rows(d, "nodes")
    for r in nodes:
        parent[r["id"]] = r["id"]
    for r in nodes:
        if r["parent"] in parent:
            union(r["id"], r["parent"])
    keys = defaultdict(list)
    for r in rows(d, "scoped_keys"):
        keys[tuple((r[c] or "").strip() for c in ("kind", "value", "lang", "dataset"))].append(r["node_id"])
    for k in keys.values():
        for x in k[1:]:
            union(k[0], x)
    return {x: find(x) for x in parent}


def test_p3(spark, sf, sf01):
    for d in (sf, sf01):
        assert got(queries.p3_found(spark, d)) == set(brute_groups(d).items())


def test_p4(spark, sf01):
    grp = brute_groups(sf01)
    shards = defaultdict(set)
    for root, r in current(sf01).items():
        if r["shard_id"] is not None:
            shards[grp[root]].add(r["shard_id"])
    ent = defaultdict(set)
    for r in rows(sf01, "scoped_keys"):
        ent[r["dataset"], r["kind"], r["value"].strip()].add(grp[r["node_id"]])
    want = {e for e, gs in ent.items() if len(set().union(*(shards[g] for g in gs))) > 1}
    assert got(queries.p4_found(spark, sf01)) == want and want
    split = queries.p4_splits(spark, sf01).collect()
    of = {(r["dataset"], r["kind"], r["value"]): r["split_name"] for r in split}
    assert of.keys() == ent.keys()
    by_group = defaultdict(set)
    for e, gs in ent.items():
        for g in gs:
            by_group[g].add(of[e])
    assert all(len(s) == 1 for s in by_group.values())
    n = Counter(of[r["dataset"], r["kind"], r["value"].strip()] for r in rows(sf01, "scoped_keys"))
    total = sum(n.values())
    for t in rows(sf01, "split_targets"):
        assert abs(n[t["split_name"]] / total - t["target_share"]) < 0.02


def test_p5(spark, sf, sf01):
    for d in (sf, sf01):
        best = {}
        for r in rows(d, "vector_store"):
            e = r["embedding"]
            if e is not None and len(e) == 128 and any(e) and (r["id"] not in best or r["source_shard"] < best[r["id"]]["source_shard"]):
                best[r["id"]] = r
        want = set()
        for kind in ("query", "passage"):
            ids = sorted(i for i, r in best.items() if r["kind"] == kind)
            x = np.array([best[i]["embedding"] for i in ids], float)
            x /= np.linalg.norm(x, axis=1)[:, None]
            s = x @ x.T
            np.fill_diagonal(s, -9)
            for a in range(len(ids)):
                for b in np.argsort(-s[a], kind="stable")[:5]:
                    if s[a, b] >= 0.8:
                        want.add(tuple(sorted((ids[a], ids[b]))))
        mine = got(queries.p5_found(spark, d))
        assert len(mine & want) >= 0.97 * len(want) and len(mine - want) <= 0.03 * len(want) and want


def test_p6(spark, sf, sf01):
    for d in (sf, sf01):
        items = {r["item_id"]: plain_words(r["text"]) for r in rows(d, "heldout_items")}
        grams = defaultdict(set)
        for i, w in items.items():
            n = min(12, len(w))
            for at in range(len(w) - n + 1 if n else 0):
                grams[tuple(w[at : at + n])].add(i)
        sizes = {len(g) for g in grams}
        want = set()
        for r in rows(d, "documents"):
            w = plain_words(r["text"])
            for n in sizes:
                for at in range(len(w) - n + 1):
                    want.update((r["doc_id"], i) for i in grams.get(tuple(w[at : at + n]), ()))
        assert got(queries.p6_found(spark, d)) == want and want


def test_p6_passages(spark, sf):
    """Exact and proximity matches by brute force, over the places where two rare words meet."""
    import xxhash

    docs = {r["doc_id"]: charform.words(r["text"]) for r in rows(sf, "documents")}
    items = {r["item_id"]: charform.words(r["text"]) for r in rows(sf, "heldout_items")}
    used = {w for x in items.values() for w in x}
    df = Counter(w for x in docs.values() for w in x if w in used)
    exact = got(queries.p6_found(spark, sf))
    places = {i: defaultdict(list) for i in docs}
    for i, x in docs.items():
        for p, w in enumerate(x):
            places[i][w].append(p)
    want = {}
    for j, item in items.items():
        n = min(12, len(item))
        need = -(-8 * n // 10)
        rare = set()
        for o in range(len(item) - n + 1):
            rare |= {o_ for d, _, o_ in sorted((df[w], xxhash.xxh64_intdigest(w) - (1 << 63), o + k) for k, w in enumerate(item[o : o + n]))[: n - need + 2] if d}
        for i, at in places.items():
            spots = [(p - a, a) for a in rare for p in at.get(item[a], ())]
            shifts = {s for s, a in spots if any(a != b and abs(s - r) <= 3 for r, b in spots)}
            best = 0
            for s in shifts:
                hit = [any(abs(p - o - s) <= 3 for p in at.get(w, ())) for o, w in enumerate(item)]
                best = max(best, max(sum(hit[o : o + n]) for o in range(len(item) - n + 1)))
            if len(item) > 1 and best >= need and (i, j) not in exact:
                want[i, j] = best
    near = {}
    for r in queries.p6_passages(spark, sf).collect():
        doc, item = docs[r["doc_id"]], items[r["item_id"]]
        assert r["matched"] >= r["run"]
        if r["match"] == "exact":
            assert doc[r["doc_from"] :][: r["run"]] == item[r["item_from"] :][: r["run"]] and r["run"] >= min(12, len(item))
        else:
            assert doc[r["doc_from"]] == item[r["item_from"]]
            near[r["doc_id"], r["item_id"]] = r["run"]
    assert near == want and near


def test_p7(spark, sf01):
    size = Counter()
    for r in rows(sf01, "documents"):
        if r["source"] is not None:
            size[r["source"].strip().lower()] += len((r["text"] or "").split())
    targets = {r["source"]: r for r in rows(sf01, "mix_targets")}
    total = sum(size[s] for s in targets)
    want = {(s,) for s, t in targets.items() if t["max_repeats"] * size[s] < t["target_share"] * total}
    assert got(queries.p7_found(spark, sf01)) == want and want
    texts = {r["doc_id"]: r for r in rows(sf01, "documents")}
    took = Counter()
    for r in queries.p7_mix(spark, sf01).collect():
        doc = texts[r["doc_id"]]
        assert doc["source"].strip().lower() == r["source"] and r["size"] == len(doc["text"].split())
        assert 1 <= r["repeats"] <= targets[r["source"]]["max_repeats"]
        took[r["source"]] += r["size"] * r["repeats"]
    for s, t in targets.items():
        budget = t["target_share"] * total
        if (s,) in want:
            assert took[s] == t["max_repeats"] * size[s]
        else:
            assert budget - 1 <= took[s] <= budget  # the lengths here fill the budget to the unit
    assert {r["source"]: r["taken"] for r in queries.p7_shares(spark, sf01).collect()} == {s: took[s] for s in targets}


def test_p8(spark, sf, sf01):
    for d in (sf, sf01):
        by = defaultdict(list)
        for r in rows(d, "documents"):
            by[plain_form(r["text"])].append((r["doc_id"], r["text"]))
        want = {(min(a[0], b[0]), max(a[0], b[0])) for g in by.values() for a, b in itertools.combinations(g, 2) if a[1] != b[1]}
        assert got(queries.p8_found(spark, d)) == want
    assert want
    forms = {r["doc_id"]: r["text_form"] for r in queries.p8_forms(spark, d).collect()}
    of = {i: k for k, g in by.items() for i, _ in g}
    assert len(set(forms.values())) == len(by)
    assert all(plain_form(forms[i]) == of[i] for i in forms)
    classes = {r["doc_id"]: r["class_id"] for r in queries.p8_classes(spark, d).collect()}
    assert all(classes[i] == min(x for x, _ in by[of[i]]) for i in classes)


@pytest.mark.parametrize("seed", range(30))
def test_subset_sum_is_exact(seed):
    from millrace.llm.mixing import fit_lengths

    rng = np.random.default_rng(seed)
    lengths = sorted(rng.choice(np.arange(0, 30), 5, replace=False).tolist())
    counts = rng.integers(0, 5, 5).tolist()
    budget = int(rng.integers(0, 200))
    take = fit_lengths(lengths, counts, budget)
    sums = {0}
    for n, c in zip(lengths, counts):
        sums |= {s + n * k for s in sums for k in range(1, c + 1)}
    assert all(0 <= t <= c for t, c in zip(take, counts))
    assert sum(t * n for t, n in zip(take, lengths)) == max(s for s in sums if s <= budget)


def test_subset_sum_with_a_large_budget():
    from millrace.llm.mixing import fit_lengths

    rng = np.random.default_rng(1)
    lengths, counts = list(range(5, 3000)), rng.integers(1, 4000, 2995).tolist()
    total = sum(n * c for n, c in zip(lengths, counts))
    for budget in (total // 3, total - 7, 123_456_789):
        take = fit_lengths(lengths, counts, budget)
        assert all(0 <= t <= c for t, c in zip(take, counts))
        assert sum(t * n for t, n in zip(take, lengths)) == budget


def test_subset_sum_with_one_very_long_document():
    """Memory doesn't grow with the number of lengths times the longest: 8,000 lengths and one of two million units."""
    import tracemalloc

    from millrace.llm.mixing import fit_lengths

    lengths = [*range(400, 8400), 2_000_000]
    counts = [1] * len(lengths)
    tracemalloc.start()
    for budget in (3_333_333, 2_000_399, 30_000_001):
        take = fit_lengths(lengths, counts, budget)
        assert sum(t * n for t, n in zip(take, lengths)) == budget and all(0 <= t <= 1 for t in take)
    assert tracemalloc.get_traced_memory()[1] < 300e6
    tracemalloc.stop()
