"""Character form: one consistent form for texts that look alike.

Look-alike classes are the transitive closure (union-find) of a relation between strings and code
points: width variants, composed letters and their sequences with combining marks, kinds of space,
characters without width, and Latin, Cyrillic and Greek letters of one shape. Every class gets the
member that is most frequent in the corpus as its representative, and texts are rewritten greedily
(leftmost, longest) with an Aho-Corasick automaton over all other members.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterable, Mapping
from functools import lru_cache

import ahocorasick

# Letters of the same shape in Latin, Cyrillic and Greek script, a class per string. All of a class are confusable by
# Unicode's table (the tests read it from ICU; it lacks Q with Ԛ, and l with ӏ); what it also joins but a reader can tell apart is left out.
SAME_SHAPE = (
    "AАΑ", "BВΒ", "CСϹ", "EЕΕ", "FϜ", "GԌ", "HНΗ", "IІΙӀ", "JЈͿ", "KКΚ", "MМΜϺ", "NΝ", "OОΟ", "PРΡ", "SЅ", "TТΤ", "VѴ", "XХΧ",
    "YУΥҮ", "ZΖ", "QԚ", "WԜ", "ГΓ", "ПΠ", "ФΦ", "ΨѰ", "ИͶ", "ÆӔ", "ƏӘ", "ƷӠ", "ƟѲӨ", "ƐԐ", "ƩΣ", "ƆϽ", "ƧϨ", "ǶԊ", "ÞϷ", "ɅΛ",
    "aа", "cсϲ", "eе", "hһ", "iі", "jјϳ", "lӏ", "oоο", "pрρ", "sѕ", "xх", "yу", "qԛ", "wԝ", "dԁ", "vνѵ", "æӕ", "əәǝ", "ʒӡ", "ɵѳө",
    "ɔͻ", "ƨϩ", "þϸ", "ψѱ", "иͷ", "ɢԍ", "ʙв", "ʜн", "ʍм", "ħћ",
)
#: Letters that stand apart where case is set aside: Greek nu would join n and v, the Cyrillic palochka i and l.
ONE_CASE = "νΝӀӏ"
_PLACE = {c: i for shape in SAME_SHAPE for i, c in enumerate(shape)}

# Ranges of characters without width (default-ignorable code points; soft hyphen, zero-width
# spaces and joiners, direction marks, variation selectors).
NO_WIDTH = (
    (0x00AD, 0x00AD), (0x034F, 0x034F), (0x061C, 0x061C), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F),
    (0x202A, 0x202E), (0x2060, 0x206F), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xE0000, 0xE0FFF),
)


class UnionFind:
    """Over any hashable items; the smaller root wins, so the outcome doesn't depend on order."""

    def __init__(self) -> None:
        self.parent: dict[str, str] = {}

    def find(self, x: str) -> str:
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def union(self, a: str, b: str) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def classes(self) -> list[list[str]]:
        out: dict[str, list[str]] = {}
        for x in list(self.parent):
            out.setdefault(self.find(x), []).append(x)
        return [sorted(c) for c in out.values()]


@lru_cache(maxsize=2)
def look_alikes(caseless: bool = False) -> tuple[tuple[str, ...], ...]:
    """The classes as tuples of strings. ``caseless`` also joins the two cases of the same-shape
    letters (for words, where case is set aside; those of ONE_CASE are then left out)."""
    uf = UnionFind()
    for shape in SAME_SHAPE:
        if caseless:
            shape = "".join(c for c in shape if c not in ONE_CASE)
        for c in shape[1:]:
            uf.union(shape[0], c)
        if caseless:
            for c in shape:
                if len(c.lower()) == 1:
                    uf.union(c, c.lower())
    for lo, hi in NO_WIDTH:
        for cp in range(lo, hi + 1):
            uf.union("", chr(cp))
    composed: list[tuple[str, str]] = []
    for cp in range(sys.maxunicode + 1):
        c = chr(cp)
        kind = unicodedata.category(c)
        if kind == "Zs":
            uf.union(" ", c)
        d = unicodedata.decomposition(c)
        if d.startswith(("<wide>", "<narrow>")):
            uf.union(c, "".join(chr(int(x, 16)) for x in d.split()[1:]))
        elif d and d[0] != "<" and not 0xAC00 <= cp <= 0xD7A3:
            composed.append((c, unicodedata.normalize("NFD", c)))
    # a composed letter equals the sequences of any look-alike of its base with the same marks
    members: dict[str, list[str]] = {}
    for x in list(uf.parent):
        members.setdefault(uf.find(x), []).append(x)
    for c, seq in composed:
        uf.union(c, seq)
        for b in members.get(uf.find(seq[0]), []) if seq[0] in uf.parent else []:
            uf.union(c, b + seq[1:])
    return tuple(tuple(c) for c in uf.classes() if len(c) > 1)


@lru_cache(maxsize=1)
def counted() -> frozenset[str]:
    """The characters of look-alike classes; the corpus frequencies of those decide on representatives."""
    return frozenset(x for c in look_alikes() for m in c for x in m)


def rewrites(counts: Mapping[str, int], caseless: bool = False, only_counted: bool = False) -> dict[str, str]:
    """Each member of a class that isn't its representative, with the representative.

    The representative is the most frequent single character (ties: the first in SAME_SHAPE, then the smallest code point). Classes of
    letters with marks follow the representative of their base letter, so that any sequence of marks,
    listed or not, ends in one form. What has no width becomes nothing; any space becomes a space.
    ``only_counted`` leaves out members with a character that ``counts`` lacks: it occurs nowhere."""
    classes = look_alikes(caseless)
    rep: dict[str, str] = {}
    marked = []
    for c in classes:
        if "" in c:
            rep.update(dict.fromkeys(c, ""))
        elif " " in c:
            rep.update(dict.fromkeys(c, " "))
        elif any(len(x) > 1 for x in c):
            marked.append(c)
        else:
            rep.update(dict.fromkeys(c, max(c, key=lambda x: (counts.get(x, 0), -_PLACE.get(x, 99), -ord(x)))))
    for c in marked:
        seq = unicodedata.normalize("NFD", min(c, key=lambda x: (-len(x), x)))
        rep.update(dict.fromkeys(c, unicodedata.normalize("NFC", rep.get(seq[0], seq[0]) + seq[1:])))
    return {k: v for k, v in rep.items() if k != v and k and not (only_counted and any(x not in counts for x in k))}


class Rewriter:
    """Rewrites texts into one form. Made once per Python worker from the plain table."""

    def __init__(self, table: Mapping[str, str]):
        self.automaton = ahocorasick.Automaton()
        for k, v in table.items():  # edges are searched in the order added: frequent members first
            self.automaton.add_word(k, (len(k), v))
        self.automaton.make_automaton()

    def __call__(self, text: str) -> str:
        out, at = [], 0
        for end, (n, new) in self.automaton.iter_long(text):
            if end + 1 - n > at:
                out.append(text[at : end + 1 - n])
            out.append(new)
            at = end + 1
        if at:
            out.append(text[at:])
            text = "".join(out)
        return unicodedata.normalize("NFC", text)


@lru_cache(maxsize=1)
def _fold_table() -> dict[int, str]:
    # letters of one shape become the Cyrillic one, or the Latin where there is none; any fixed choice serves
    first = {chr(c): 2 for c in range(0x430, 0x450)} | {chr(c): 1 for c in range(0x61, 0x7B)}
    return {ord(k): v for k, v in rewrites(first, caseless=True).items() if len(k) == 1}


_INVISIBLE = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in NO_WIDTH) + "]+")
_MARK = re.compile("[\u0300-\u036f]")
_WORD = re.compile(r"[^\W_]+")
_MARKED_WORD = re.compile("[^\\W_](?:[^\\W_]|[\u0300-\u036f])*")
_folded: dict[str, str] = {}


def _fold(word: str) -> str:
    if len(_folded) > 1_000_000:
        _folded.clear()
    out = _folded[word] = unicodedata.normalize("NFC", word.lower().translate(_fold_table()))
    return out


def words(text: str | None) -> list[str]:
    """The runs of letters and digits of ``text``, with case and character form set aside. Null: none."""
    if not text:
        return []
    if _INVISIBLE.search(text):
        text = _INVISIBLE.sub("", text)
    text = unicodedata.normalize("NFC", text)
    runs = (_MARKED_WORD if _MARK.search(text) else _WORD).findall(text)
    known = _folded.get
    return [known(w) or _fold(w) for w in runs]


def count_characters(texts: Iterable[str | None]) -> dict[str, int]:
    """Occurrences of each character that belongs to a look-alike class."""
    from collections import Counter

    n: Counter[str] = Counter()
    for t in texts:
        if t:
            n.update(t)
    keep = counted()
    return {c: k for c, k in n.items() if c in keep}
