"""Text functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import normalize, strip


def clean(c) -> Column:
    """Null as empty, line breaks as blanks, stripped."""
    return strip(F.replace(normalize(c), F.lit("\n"), F.lit(" ")))


def short(c, limit: int) -> Column:
    """Cleaned and cut to ``limit`` characters, with an ellipsis if cut."""
    t = clean(c)
    return F.concat(F.substring(t, 1, limit), F.when(F.char_length(t) > limit, "...").otherwise(""))


def tokens(c) -> Column:
    """The distinct runs of letters, digits and underscores, in lower case. Null and blank: empty array."""
    return F.array_distinct(F.regexp_extract_all(F.lower(clean(c)), F.lit(r"([\p{L}\p{N}_]+)"), 1))


def jaccard(a: Column, b: Column) -> Column:
    """Of two token sets; 0 if either is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def truncate_chars(c, limit: int) -> Column:
    return F.substring(normalize(c), 1, limit)


def truncate_bytes(c, limit: int) -> Column:
    """Cut to ``limit`` code points if it has more than ``limit`` bytes: the test is on bytes, the cut on code points."""
    t = F.col(c) if isinstance(c, str) else c
    return F.when(F.octet_length(t) > limit, F.substring(t, 1, limit)).otherwise(t)


def truncate_words(c, limit: int) -> Column:
    """The first ``limit`` white-space tokens joined by blanks; texts within the limit stay as they are."""
    parts = F.split(strip(normalize(c)), r"(?U)\s+")
    return F.when(F.size(parts) <= limit, normalize(c)).otherwise(F.array_join(F.slice(parts, 1, limit), " "))


def truncate_tokens(c, limit: int, tokenizer: Callable[[], object]) -> Column:
    """Cut to a token budget. ``tokenizer()`` is called once per task and gives ``encode(text) -> ids`` and ``decode(ids)``. Null: empty."""

    @F.pandas_udf("string")
    def cut(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tok = tokenizer()
        for s in it:
            ids = [tok.encode(t or "") for t in s]
            yield pd.Series([(t or "") if len(i) <= limit else tok.decode(i[:limit]) for t, i in zip(s, ids)], index=s.index, dtype=object)

    return cut(F.col(c) if isinstance(c, str) else c)


def title_and_text(title="title", text="text") -> Column:
    """Title and text joined by a blank, stripped; nulls as empty."""
    return strip(F.concat_ws(" ", normalize(title), normalize(text)))


def prompt(template: str, **cols) -> Column:
    """Fill ``{name}`` places of ``template`` with columns, nulls as empty."""
    out, rest = [], template
    while "{" in rest:
        head, rest = rest.split("{", 1)
        name, rest = rest.split("}", 1)
        out += [F.lit(head), normalize(cols[name])]
    return F.concat(*out, F.lit(rest))
