"""A Russian analyzer: lower case, stop words left out, stems by the public Snowball rules for Russian."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The public stop list for Russian
STOP = frozenset(
    """и в во не что он на я с со как а то все она так его но да ты к у же вы за бы по только ее мне было вот от меня еще нет о из ему теперь когда
    даже ну вдруг ли если уже или ни быть был него до вас нибудь опять уж вам сказал ведь там потом себя ничего ей может они тут где есть надо
    ней для мы тебя их чем была сам чтоб без будто человек чего раз тоже себе под жизнь будет ж тогда кто этот говорил того потому этого какой
    совсем ним здесь этом один почти мой тем чтобы нее кажется сейчас были куда зачем сказать всех никогда сегодня можно при наконец два об
    другой хоть после над больше тот через эти нас про всего них какая много разве сказала три эту моя впрочем хорошо свою этой перед иногда
    лучше чуть том нельзя такой им более всегда конечно всю между""".split()
)
# Endings; those of the first list count after а or я only, which stays
_GERUND = ("в вши вшись", "ив ивши ившись ыв ывши ывшись")
_ADJECTIVE = ("", "ее ие ые ое ими ыми ей ий ый ой ем им ым ом его ого ему ому их ых ую юю ая яя ою ею")
_PARTICIPLE = ("ем нн вш ющ щ", "ивш ывш ующ")
_REFLEXIVE = ("", "ся сь")
_VERB = (
    "ла на ете йте ли й л ем н ло но ет ют ны ть ешь нно",
    "ила ыла ена ейте уйте ите или ыли ей уй ил ыл им ым ен ило ыло ено ят ует уют ит ыт ены ить ыть ишь ую ю",
)
_NOUN = ("", "а ев ов ие ье е иями ями ами еи ии и ией ей ой ий й иям ям ием ем ам ом о у ах иях ях ы ь ию ью ю ия ья я")
_SUPERLATIVE, _DERIVATIONAL = ("", "ейш ейше"), ("", "ост ость")


def _ending(lists: tuple[str, str]) -> re.Pattern:
    after, plain = ("|".join(sorted(x.split(), key=len, reverse=True)) for x in lists)
    return re.compile("(?:" + "|".join(p for p in (f"(?<=[ая])(?:{after})" if after else "", plain) if p) + ")$")


_RULES = {n: _ending(x) for n, x in (("gerund", _GERUND), ("adjective", _ADJECTIVE), ("participle", _PARTICIPLE), ("reflexive", _REFLEXIVE), ("verb", _VERB), ("noun", _NOUN), ("superlative", _SUPERLATIVE), ("derivational", _DERIVATIONAL))}
_RV, _R = re.compile("[аеиоуыэюя]"), re.compile("[аеиоуыэюя][^аеиоуыэюя]")


def stem(word: str) -> str:
    """The stem of a word in lower case; words without a Russian vowel stay."""
    word = word.replace("ё", "е")
    first = _RV.search(word)
    if not first:
        return word
    at = first.end()
    head, rest = word[:at], word[at:]
    r1 = _R.search(word)
    r2 = _R.search(word, r1.end()) if r1 else None
    r2 = r2.end() if r2 else len(word)

    def cut(rule: str, text: str) -> str | None:
        # the longest ending wins: of what may follow а or я and of what may stand anywhere
        best = None
        for n in range(len(text)):
            if _RULES[rule].match(text, n):
                best = text[:n]
                break
        return best

    got = cut("gerund", rest)
    if got is None:
        rest = (lambda x: rest if x is None else x)(cut("reflexive", rest))
        got = cut("adjective", rest)
        if got is not None:
            got = (lambda x: got if x is None else x)(cut("participle", got))
        else:
            got = cut("verb", rest)
            if got is None:
                got = cut("noun", rest)
    rest = rest if got is None else got
    rest = rest.removesuffix("и")
    got = cut("derivational", rest)
    if got is not None and at + len(got) >= r2:
        rest = got
    if rest.endswith("нн"):
        rest = rest[:-1]
    else:
        got = cut("superlative", rest)
        if got is not None:
            rest = got[:-1] if got.endswith("нн") else got
        else:
            rest = rest.removesuffix("ь")
    return head + rest


_WORD = re.compile(r"[^\W_]+")
_stems: dict[str, str] = {}


def words(text: str | None) -> list[str]:
    """The stems of the words of ``text`` that aren't stop words. Null: none."""
    out = []
    for w in _WORD.findall((text or "").lower()):
        if w not in STOP:
            if w not in _stems:
                if len(_stems) > 1_000_000:
                    _stems.clear()
                _stems[w] = stem(w)
            out.append(_stems[w])
    return out


def analyze_russian(c) -> Column:
    """As an analyzer for :func:`millrace.operators.bm25.bm25`."""

    @F.pandas_udf("array<string>")
    def f(s: pd.Series) -> pd.Series:
        return pd.Series([words(t) for t in s], index=s.index)

    return f(F.col(c) if isinstance(c, str) else c)
