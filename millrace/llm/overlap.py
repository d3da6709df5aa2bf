"""Problem 1: same or near-same records across splits.

Texts are canonicalised (case, punctuation, white space, character form) to sets of words. A hash of the whole set
finds equal records only, so near ones are found by hashes of parts of the sets, evaluation hashes are joined with
training hashes, and the candidates are compared exactly. There are two kinds of hashes:

* Short sets: subsets of words. With the words of a set in one order for all sets, frequent ones last, two sets
  that agree to the threshold share at least L of their first ``|set| - overlap + L`` words. A hash that many sets
  share is made longer, word by word.
* Long sets: parts of the universe of words (Deng, Li, Wen and Feng, "An efficient partition based method for exact set
  similarity joins", PVLDB 2015). Two sets that agree differ by at most D words; if the parts are given tolerances
  e with sum(e + 1) > D, in some part they differ by at most e words. Each set chooses its tolerances (none, 0 or 1) so
  that the hashes it looks up are the ones that fewest others hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Scratch
from . import charform

#: Words that make up at least this part of all words are ordered by frequency (there are at most 1 / FREQUENT of
#: them); the others come before them, ordered by hash. Any order gives the whole result.
FREQUENT = 1 / 20_000
#: Sets of 3 to SHORT words are hashed by subsets of WORDS words; pairs with a longer set are found by parts.
SHORT, WORDS = 24, 3
#: A hash that more sets than this hold on both sides is hot: its sets aren't compared but hashed by one more word.
HOT = 64
#: Rows that leave a task's Python in one batch, about.
ROWS = 80_000
#: A scope whose pairs are at most this many times its sets is compared as it is.
FEW = 16


def _hash(parts: bytes) -> int:
    return xxhash.xxh64_intdigest(parts) - (1 << 63)


def word_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last column, texts, becomes the sorted array of word hashes and the hash of that (null: no words)."""
    seen: dict[str, int] = {}
    for b in batches:
        sets, ids = [], []
        for t in b.column(b.num_columns - 1).to_pylist():
            if len(seen) > 1_000_000:
                seen.clear()
            w = set(charform.words(t))
            for x in w:
                if x not in seen:
                    seen[x] = _hash(x.encode("utf-8", "surrogatepass"))
            h = sorted({seen[x] for x in w})
            sets.append(h or None)
            ids.append(_hash(np.asarray(h, np.int64).tobytes()) if h else None)
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(ids, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], [*b.schema.names[:-1], "set_id", "words"])


def with_word_sets(df: DataFrame, text_col: str) -> DataFrame:
    """``df`` with ``text_col`` replaced by ``set_id`` and ``words``; rows without words are dropped."""
    others = [c for c in df.columns if c != text_col]
    schema = ", ".join(f"`{n}` {t}" for n, t in df.select(*others).dtypes) + ", set_id long, words array<bigint>"
    return df.select(*others, text_col).mapInArrow(word_sets, schema).where("set_id is not null")


# -- long sets: parts -------------------------------------------------------------------------------------------
@lru_cache(maxsize=None)
def bands(least: int, upto: int) -> tuple[tuple[int, int], ...]:
    """Ranges of set sizes from ``least`` on, each a fifth wider than its start, up to the one that holds ``upto``."""
    out, lo = [], least
    while lo <= upto:
        out.append((lo, lo + lo // 5))
        lo += lo // 5 + 1
    return tuple(out)


def may_differ(a: int, b: int, per_mille: int) -> int:
    """By so many words at most do agreeing sets of ``a`` and ``b`` words differ (words that one of them lacks)."""
    return (a + b) * (1000 - per_mille) // (1000 + per_mille)


def parts_of(band: tuple[int, int], per_mille: int) -> int:
    """Parts for the sets of a band: fewer than words may differ, so that a part holds about four words and most sets
    can leave their commonest parts out; enough for the longest set that may agree, with a tolerance of 1 each."""
    hi = band[1]
    return max(1, -(-3 * (may_differ(hi, hi, per_mille) + 1) // 4), -(-(may_differ(hi * 1000 // per_mille, hi, per_mille) + 1) // 2))


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of a public 64-bit generator (splitmix64), over unsigned numbers."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Parts:
    """The parts of some sets in the partition of a band each, and the hashes of the parts."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray, scopes: np.ndarray, lo: np.ndarray, parts: np.ndarray):
        of = np.repeat(np.arange(len(sizes)), sizes)
        self.mixed = _mix(words.view(np.uint64) ^ _mix(lo.astype(np.uint64))[of])
        base = np.cumsum(parts) - parts
        self.of_word = base[of] + ((self.mixed >> np.uint64(33)) % parts[of].astype(np.uint64)).astype(np.int64)
        self.set = np.repeat(np.arange(len(sizes)), parts)  # of each part
        self.number = np.arange(len(self.set)) - base[self.set]
        self.count = np.bincount(self.of_word, minlength=len(self.set))
        order = np.argsort(self.of_word, kind="stable")
        self.total = np.zeros(len(self.set), np.uint64)
        filled = np.nonzero(self.count)[0]
        if len(filled):
            self.total[filled] = np.add.reduceat(self.mixed[order], (np.cumsum(self.count) - self.count)[filled])
        self.salt = _mix(_mix(scopes.view(np.uint64) ^ lo.astype(np.uint64))[self.set] + self.number.astype(np.uint64))

    def whole(self, lacking: bool) -> np.ndarray:
        """The hash of each part: as it is, or as it is looked up among the hashes of parts that lack one word."""
        return _mix(self.total ^ self.salt ^ np.uint64(0x5851F42D4C957F2D if lacking else 0)).view(np.int64)

    def without_one(self, w: np.ndarray, lacking: bool) -> np.ndarray:
        """The hash of the part of each of the words numbered ``w`` without that word."""
        p = self.of_word[w]
        return _mix((self.total[p] - self.mixed[w]) ^ self.salt[p] ^ np.uint64(0x5851F42D4C957F2D if lacking else 0)).view(np.int64)


def _columns(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """``scope, set_id, sizes`` and the flat words of a batch, in slices of bounded words."""
    lists = b.column(2)
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    scope, ids = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    at = 0
    while at < len(sizes):
        to = at + max(1, int(np.searchsorted(np.cumsum(sizes[at : at + ROWS // 4]), ROWS // 4)))
        yield scope[at:to], ids[at:to], sizes[at:to].astype(np.int64), lists.slice(at, to - at).flatten().to_numpy(zero_copy_only=False)
        at = to


def stored_hashes(per_mille: int, least: int, empties: bool):
    """``(key, scope, set_id, n)``: each set's parts, and its parts that lack one of their words; the empty parts if wanted."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for scope, ids, sizes, words in _columns(b):
                los, his = np.array(bands(least, int(sizes.max()))).T
                band = np.searchsorted(los, sizes, side="right") - 1
                parts = np.array([parts_of((int(x), int(y)), per_mille) for x, y in zip(los, his)])
                p = _Parts(words, sizes, scope, los[band], parts[band])
                at = np.arange(len(p.set)) if empties else np.nonzero(p.count)[0]
                w = np.nonzero(p.count[p.of_word] >= (1 if empties else 2))[0]
                of = np.concatenate([p.set[at], p.set[p.of_word[w]]])
                key = np.concatenate([p.whole(False)[at], p.without_one(w, True)])
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(scope[of]), pa.array(ids[of]), pa.array(sizes[of].astype(np.int32))], ["key", "scope", "set_id", "n"])

    return f


def asked_hashes(per_mille: int, least: int, longer_than: int):
    """``(key, scope, set_id, n, band, part, more, one, room)``: what a set may look up in each band of sizes that it may agree
    with: for tolerance 0 (``more`` false) and in addition for 1. ``one``: the part holds one word and isn't given
    tolerance 1; ``room``: the sum of (tolerance + 1) over the set's parts at most. Sets up to ``longer_than`` ask the bands
    beyond it only. Where the filled parts don't give enough, the empty ones and tolerance 1 are asked, too (``room`` < 0)."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for scope, ids, sizes, words in _columns(b):
                every = bands(least, int(sizes.max()) * 1000 // per_mille)
                los, his = np.array(every).T
                parts = np.array([parts_of(x, per_mille) for x in every])
                small, large = -(-sizes * per_mille // 1000), sizes * 1000 // per_mille
                small = np.where(sizes <= longer_than, np.maximum(small, longer_than + 1), small)
                r, band = np.nonzero((his[None] >= small[:, None]) & (los[None] <= large[:, None]))
                if not len(r):
                    continue
                first = np.cumsum(sizes) - sizes
                flat = np.repeat(first[r] - (np.cumsum(sizes[r]) - sizes[r]), sizes[r]) + np.arange(int(sizes[r].sum()))
                p = _Parts(words[flat], sizes[r], scope[r], los[band], parts[band])
                needed = np.array([may_differ(int(n), min(int(hi), int(most)), per_mille) + 1 for n, hi, most in zip(sizes[r], his[band], large[r])])
                room = np.bincount(p.set, np.minimum(p.count, 2), minlength=len(r)).astype(np.int64)
                starved = room < needed
                at = np.nonzero((p.count > 0) | starved[p.set])[0]
                two = np.nonzero((p.count >= 2) | (starved[p.set] & (p.count >= 1)))[0]
                w = np.nonzero((p.count[p.of_word] >= 2) | starved[p.set[p.of_word]])[0]
                row = np.concatenate([at, two, p.of_word[w]])
                key = np.concatenate([p.whole(False)[at], p.whole(True)[two], p.without_one(w, False)])
                more = np.concatenate([np.zeros(len(at), bool), np.ones(len(two) + len(w), bool)])
                of = p.set[row]
                left = np.where(starved, -1, room)[of]
                out = [key, scope[r[of]], ids[r[of]], sizes[r[of]].astype(np.int32), los[band[of]].astype(np.int64), p.number[row].astype(np.int32), more, (p.count[row] < 2) & ~starved[of], left.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["key", "scope", "set_id", "n", "band", "part", "more", "one", "room"])

    return f


def choose(per_mille: int):
    """Of what each set may look up in a band (``asked``: part, more, one, key and how many sets hold it), the keys that suffice
    and that the fewest hold. Parts that hold nothing of what others hold are looked up for nothing."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, rows = [], []
            for at, (n, lo, room, asked) in enumerate(zip(*(b.column(i).to_pylist() for i in (2, 3, 4, 5)))):
                need = may_differ(n, min(lo + lo // 5, n * 1000 // per_mille), per_mille) + 1
                of: dict[int, list] = {}
                for x in asked:
                    p = of.setdefault(x["part"], [0, 0, x["one"], [], []])
                    p[1 if x["more"] else 0] += x["held"]
                    p[4 if x["more"] else 3].append(x["key"])
                if room < 0:  # everything that is held by someone
                    need = 1 << 60
                else:
                    need -= room - sum(1 if p[2] else 2 for p in of.values())
                steps = []  # (cost of a unit, units, keys)
                for part, (c0, c1, one, k0, k1) in of.items():
                    if one:
                        steps.append((c0, part, 0, 1, k0))
                    elif c0 <= c1:
                        steps += [(c0, part, 0, 1, k0), (c1, part, 1, 1, k1)]
                    else:  # the second unit is the cheaper one: both or none
                        steps.append(((c0 + c1) / 2, part, 0, 2, k0 + k1))
                for _, _, _, units, ks in sorted(steps, key=lambda s: s[:3]):
                    if need <= 0:
                        break
                    need -= units
                    keys += ks
                    rows += [at] * len(ks)
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *(b.column(i).take(take) for i in (0, 1, 2))], ["key", "scope", "set_id", "n"])

    return f


def _long_candidates(spark: SparkSession, sets: DataFrame, per_mille: int, tmp: Scratch) -> DataFrame | None:
    """``(scope, a, b)``: pairs of which one has more than SHORT words and which share a hash of parts; None if there are no long sets."""
    least = -(-(SHORT + 1) * per_mille // 1000)
    some = sets.where(F.size("words") >= least)
    if some.where(F.size("words") > SHORT).isEmpty():
        return None
    cols = ("scope", "set_id", "words")
    asked = "key long, scope long, set_id long, n int, band long, part int, more boolean, one boolean, room int"
    asked = tmp.cut(some.where("right").select(*cols).mapInArrow(asked_hashes(per_mille, least, SHORT), asked))
    starved = not asked.where("room < 0").isEmpty()
    held = tmp.cut(some.where("left").select(*cols).mapInArrow(stored_hashes(per_mille, least, starved), "key long, scope long, set_id long, n int"))
    counts = held.groupBy("key").agg(F.count("*").alias("held"))
    known = asked.join(counts, "key")
    of = known.groupBy("scope", "set_id", "n", "band", "room").agg(F.collect_list(F.struct("part", "more", "one", "key", "held")).alias("asked"))  # a set's own words bound it
    chosen = tmp.cut(of.mapInArrow(choose(per_mille), "key long, scope long, set_id long, n int"))
    a = held.select("key", "scope", F.col("set_id").alias("a"), F.col("n").alias("na"))
    b = chosen.select("key", "scope", F.col("set_id").alias("b"), F.col("n").alias("nb"))
    found = a.join(b, ["key", "scope"]).where(f"greatest(na, nb) > {SHORT} and na * 1000 >= nb * {per_mille} and nb * 1000 >= na * {per_mille}")
    return tmp.cut(found.select("scope", "a", "b").distinct())


# -- short sets: subsets ----------------------------------------------------------------------------------------
def _short_candidates(spark: SparkSession, sets: DataFrame, per_mille: int, tmp: Scratch) -> list[DataFrame]:
    """``(scope, a, b)``: pairs of at most SHORT words that share a hash of words which suffices or which isn't hot."""
    sets = sets.where(F.size("words") <= SHORT)
    # a total of words first; only those at or above the bound come to the driver
    df = tmp.cut(sets.select(F.explode("words").alias("w")).groupBy("w").agg(F.count("*").alias("n")))
    total = df.agg(F.sum("n")).first()[0] or 0
    often = sorted((r["w"], r["n"]) for r in df.where(F.col("n") >= max(2.0, FREQUENT * total)).collect())
    order = spark.sparkContext.broadcast(tuple(np.array([x[i] for x in often], np.int64) for i in (0, 1)))

    cols = ["key", "scope", "set_id", "n", "left", "right", "last", "level"]
    schema = "key long, scope long, set_id long, n int, left boolean, right boolean, last int, level int"
    spare = np.array([n - -(-n * per_mille // 1000) for n in range(SHORT + 1)])  # the first spare + L words of a set hold L of any that agrees with it

    def ordered(lists) -> tuple[np.ndarray, np.ndarray]:
        """The words of the sets one after the other, each set's in the common order; and where each begins."""
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        known, rank = order.value
        at = np.minimum(np.searchsorted(known, flat), max(0, len(known) - 1))
        often = np.where(known[at] == flat, rank[at], 0) if len(known) else np.zeros(len(flat), np.int64)
        return flat[np.lexsort((flat, often, np.repeat(np.arange(len(sizes)), sizes)))], np.cumsum(sizes) - sizes

    def chain(key: np.ndarray, word: np.ndarray) -> np.ndarray:
        return _mix(_mix(key.view(np.uint64)) + word.view(np.uint64)).view(np.int64)

    def rows(key, b, row, last, level) -> pa.RecordBatch:
        same = [b.column(i).take(pa.array(row)) for i in (0, 1)]
        sizes = pc.list_value_length(b.column(2)).cast(pa.int32()).take(pa.array(row))
        sides = [b.column(i).take(pa.array(row)) for i in (3, 4)]
        return pa.RecordBatch.from_arrays([pa.array(key), *same, sizes, *sides, pa.array(last.astype(np.int32)), pa.array(np.broadcast_to(level, key.shape).astype(np.int32))], cols)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, start = ordered(b.column(2))
            sizes = pc.list_value_length(b.column(2)).to_numpy(zero_copy_only=False)
            tiny = np.nonzero(sizes < WORDS)[0]  # agree with themselves only
            if len(tiny):
                yield rows(b.column(1).to_numpy(zero_copy_only=False)[tiny], b, tiny, sizes[tiny], sizes[tiny])
            for n in np.unique(sizes[sizes >= WORDS]):
                places = np.array(list(combinations(range(min(n, spare[n] + WORDS)), WORDS)))
                every = np.nonzero(sizes == n)[0]
                step = max(1, ROWS // len(places))
                for at in range(0, len(every), step):
                    some = every[at : at + step]
                    of = start[some][:, None, None] + places[None]  # set, subset, word
                    key = np.full(of.shape[:2], WORDS, np.int64)
                    for i in range(WORDS):
                        key = chain(key, flat[of[:, :, i]])
                    yield rows(key.ravel(), b, np.repeat(some, len(places)), np.tile(places[:, -1], len(some)), WORDS)

    def longer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The hashes of a hot one with one of the words after its last."""
        for b in batches:
            for at in range(0, b.num_rows, ROWS // SHORT):
                part = b.slice(at, ROWS // SHORT)
                key, n, last, level = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 3, 6, 7))
                flat, start = ordered(part.column(8))
                more = np.maximum(0, np.minimum(n, spare[n] + level + 1) - last - 1)
                row = np.repeat(np.arange(part.num_rows), more)
                p = last[row] + 1 + np.arange(len(row)) - np.repeat(np.cumsum(more) - more, more)
                out = [pa.array(chain(key[row], flat[start[row] + p])), *(part.column(i).take(pa.array(row)) for i in range(1, 6)), pa.array(p.astype(np.int32)), pa.array((level[row] + 1).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(out, cols)

    words = sets.select("scope", "set_id", "words")
    k = tmp.cut(sets.select("scope", "set_id", "words", "left", "right").mapInArrow(keys, schema))
    near = []
    while True:
        sides = k.groupBy("key", "scope").agg(F.count_if("left").alias("l"), F.count_if("right").alias("r"), F.min("n").alias("n")).where("l > 0 and r > 0")
        # sets of one or two words are equal if they share a hash: no words are left to make it longer
        sides = tmp.cut(sides.select("key", "scope", ((F.col("l") > HOT) & (F.col("r") > HOT) & (F.col("n") >= 3)).alias("hot")))
        some = k.join(sides, ["key", "scope"])
        cold, hot = some.where("not hot"), tmp.cut(some.where("hot").drop("hot"))
        a = cold.where("left").select("key", "scope", F.col("set_id").alias("a"), F.col("n").alias("na"))
        b = cold.where("right").select("key", "scope", F.col("set_id").alias("b"), F.col("n").alias("nb"))
        found = a.join(b, ["key", "scope"]).where(f"na * 1000 >= nb * {per_mille} and nb * 1000 >= na * {per_mille}").select("scope", "a", "b")
        any_hot = not hot.isEmpty()
        if any_hot:
            # sets so small that the words of the hash are all they need to share are joined by both sizes: these do agree
            sizes = F.expr(f"filter(sequence(cast(ceil(n * {per_mille} / 1000) as int), cast(floor(n * 1000 / {per_mille}) as int)), y -> {per_mille} * (n + y) <= level * {1000 + per_mille})")
            enough = hot.withColumn("other", F.explode(sizes))
            a = enough.where("left").select("key", "scope", F.col("set_id").alias("a"), F.col("n").alias("na"), F.col("other").alias("nb"))
            b = enough.where("right").select("key", "scope", F.col("set_id").alias("b"), F.col("other").alias("na"), F.col("n").alias("nb"))
            found = found.unionByName(a.join(b, ["key", "scope", "na", "nb"]).select("scope", "a", "b"))
        near.append(tmp.cut(found.distinct()))
        if not any_hot:
            return near
        k = tmp.cut(hot.join(words, ["scope", "set_id"]).select(*cols, "words").mapInArrow(longer, schema))


def agreeing_sets(spark: SparkSession, sets: DataFrame, threshold: float, few: int = FEW, tmp: Scratch | None = None) -> DataFrame:
    """``(scope, a, b)``: pairs of sets of ``sets(scope, set_id, words, left, right)`` in one scope, ``a`` marked left and
    ``b`` marked right, whose words agree to ``threshold`` (common / both together). A set agrees with itself.

    Exact for thresholds of at least 0.7 (the number of words of the short hashes rests on it). One row per set and
    scope is expected. Scopes with at most ``few`` pairs a set are compared as they are.

    A hash that many sets share doesn't lead to all pairs of them: short sets make it longer until few share it or its words
    alone make the sets agree; long sets look up other parts."""
    if threshold < 0.7:
        raise ValueError("the short hashes are made for thresholds of 0.7 and more")
    tmp = tmp or Scratch(spark, "p1")
    per_mille = round(threshold * 1000)
    words = sets.select("scope", "set_id", "words")
    sides = sets.groupBy("scope").agg(F.count_if("left").alias("l"), F.count_if("right").alias("r")).where("l > 0 and r > 0")
    sides = tmp.cut(sides.select("scope", (F.col("l") * F.col("r") <= few * (F.col("l") + F.col("r"))).alias("plain")))
    some = sets.join(sides, "scope")
    plain, many = some.where("plain"), tmp.cut(some.where("not plain").drop("plain"))
    a = plain.where("left").select("scope", F.col("set_id").alias("a"), F.size("words").alias("na"))
    b = plain.where("right").select("scope", F.col("set_id").alias("b"), F.size("words").alias("nb"))
    near = a.join(b, "scope").where(f"na * 1000 >= nb * {per_mille} and nb * 1000 >= na * {per_mille}").select("scope", "a", "b")
    if not many.isEmpty():
        for found in _short_candidates(spark, many, per_mille, tmp):
            near = near.unionByName(found)
        if (found := _long_candidates(spark, many, per_mille, tmp)) is not None:
            near = near.unionByName(found)
        near = near.distinct()
    near = near.join(words.select("scope", F.col("set_id").alias("a"), F.col("words").alias("wa")), ["scope", "a"])
    near = near.join(words.select("scope", F.col("set_id").alias("b"), F.col("words").alias("wb")), ["scope", "b"])
    both = F.size(F.array_intersect("wa", "wb"))
    near = near.withColumn("common", both).where(f"common * 1000 >= {per_mille} * (size(wa) + size(wb) - common)")
    return near.select("scope", "a", "b")


def canonical_split(col):
    """Case and outer blanks set aside; ``val`` is ``validation``."""
    s = F.lower(F.regexp_replace(col, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""))
    return F.when(s == "val", "validation").otherwise(s)


def split_overlaps(spark: SparkSession, samples: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``(train, held, equal)``: sample ids, one in train and one in validation or test, whose queries agree to
    ``threshold`` and so does at least one positive of each. ``equal``: the word sets agree wholly.

    Null or blank queries and positives agree with nothing; a sample delivered twice counts once; other splits
    take no part. Samples whose queries agree are compared by hashes of their positives within that pair of queries, so
    a query that many samples share leads to no comparison of all with all."""
    tmp = Scratch(spark, "p1")
    rows = samples.select("sample_id", canonical_split("split").alias("split"), F.col("query").cast("string").alias("query"))
    rows = rows.where("sample_id is not null and split in ('train', 'validation', 'test')").select("sample_id", (F.col("split") == "train").alias("train"), "query")
    queries = tmp.cut(with_word_sets(rows, "query"))
    sets = queries.groupBy("set_id").agg(F.min("words").alias("words"), F.max("train").alias("left"), F.max(~F.col("train")).alias("right"))
    sets = tmp.cut(sets.withColumn("scope", F.lit(0).cast("long")))
    agree = agreeing_sets(spark, sets, threshold, tmp=tmp).select("a", "b", F.xxhash64("a", "b").alias("scope"))
    agree = tmp.cut(agree)

    # the positives of samples whose query agrees with another's, in the scope of each such pair of queries
    q = queries.select("sample_id", "train", "set_id").distinct()
    on = q.where("train").join(agree.select(F.col("a").alias("set_id"), "scope"), "set_id").unionByName(q.where("not train").join(agree.select(F.col("b").alias("set_id"), "scope"), "set_id"))
    on = tmp.cut(on.select("sample_id", "train", "scope").distinct())
    texts = samples.join(on.select("sample_id").distinct(), "sample_id", "left_semi").select("sample_id", F.explode("positive").alias("text")).distinct()
    positives = tmp.cut(with_word_sets(texts, "text").distinct())
    held = on.join(positives, "sample_id")
    held = held.select("scope", "set_id", "train", "sample_id")
    scoped = on.join(positives, "sample_id").groupBy("scope", "set_id").agg(F.min("words").alias("words"), F.max("train").alias("left"), F.max(~F.col("train")).alias("right"))
    scoped = tmp.cut(scoped)
    same = agreeing_sets(spark, scoped, threshold, tmp=tmp)
    pairs = same.join(held.where("train").select("scope", F.col("set_id").alias("a"), F.col("sample_id").alias("train")), ["scope", "a"])
    pairs = pairs.join(held.where("not train").select("scope", F.col("set_id").alias("b"), F.col("sample_id").alias("held")), ["scope", "b"])
    exact = agree.select("scope", (F.col("a") == F.col("b")).alias("equal_query"))
    pairs = pairs.join(exact, "scope").select("train", "held", (F.col("equal_query") & (F.col("a") == F.col("b"))).alias("equal"))
    return pairs.where("train <> held").groupBy("train", "held").agg(F.max("equal").alias("equal"))


def overlap_pairs(spark: SparkSession, samples: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``(sample_a, sample_b)``: the pairs of :func:`split_overlaps`, the smaller id first."""
    p = split_overlaps(spark, samples, threshold)
    return p.select(F.least("train", "held").alias("sample_a"), F.greatest("train", "held").alias("sample_b")).distinct()


def overlap_report(spark: SparkSession, samples: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``(split, dataset, samples, overlapping, pairs, equal_pairs)`` for validation and test: all samples, those that
    overlap with training samples, and the pairs, by split and dataset (case and outer blanks set aside)."""
    tmp = Scratch(spark, "p1")
    p = tmp.cut(split_overlaps(spark, samples, threshold))
    per = p.groupBy(F.col("held").alias("sample_id")).agg(F.count("*").alias("pairs"), F.count_if("equal").alias("equal_pairs"))
    name = F.lower(F.regexp_replace("dataset", r"(?U)^\s+|\s+$", ""))
    rows = samples.select("sample_id", canonical_split("split").alias("split"), name.alias("dataset")).where("split in ('validation', 'test')").distinct()
    rows = rows.join(per, "sample_id", "left").fillna(0, ["pairs", "equal_pairs"])
    return rows.groupBy("split", "dataset").agg(F.count("*").alias("samples"), F.count_if(F.col("pairs") > 0).alias("overlapping"), F.sum("pairs").alias("pairs"), F.sum("equal_pairs").alias("equal_pairs"))
