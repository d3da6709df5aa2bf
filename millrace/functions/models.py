"""Embedding and reranking models as vectorised functions."""

from __future__ import annotations

import json
import os
import random
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def embed_with_retry(embed: Callable, texts: list[str], retryable: Callable[[Exception], bool], tries: int = 5, base: float = 1.0, sleep=time.sleep) -> list:
    """``embed(texts)`` in order; a failure is tried again after a growing pause (120 s at most), then in halves."""
    for n in range(tries):
        try:
            return list(embed(texts))
        except Exception as e:
            if not retryable(e) or (n == tries - 1 and len(texts) == 1):
                raise
            if n == tries - 1:
                break
            sleep(min(120.0, base * 2**n * random.uniform(0.8, 1.2)))
    half = len(texts) // 2
    return embed_with_retry(embed, texts[:half], retryable, tries, base, sleep) + embed_with_retry(embed, texts[half:], retryable, tries, base, sleep)


def embedder(make: Callable[[], Callable[[list[str]], list]], batch: int = 64, retryable: Callable[[Exception], bool] = lambda e: False) -> Callable[[Column], Column]:
    """A function of a text column that gives ``array<float>``. ``make()`` builds the model once per worker; blank and null
    texts give null."""

    @F.pandas_udf("array<float>")
    def f(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make()
        for s in it:
            out: list = [None] * len(s)
            where = [i for i, t in enumerate(s) if t is not None and t.strip()]
            texts = [s.iloc[i] for i in where]
            for at in range(0, len(texts), batch):
                vs = embed_with_retry(model, texts[at : at + batch], retryable)
                for i, v in zip(where[at : at + batch], vs, strict=True):
                    out[i] = [float(x) for x in v]
            yield pd.Series(out, index=s.index)

    return f


def overlap_scorer():
    """A model-free reranker: the Jaccard of the words of query and document."""
    import re

    word = re.compile(r"[^\W_]+")

    def score(queries: list[str], docs: list[str]) -> list[float]:
        out = []
        for q, d in zip(queries, docs):
            a, b = set(word.findall((q or "").lower())), set(word.findall((d or "").lower()))
            out.append(len(a & b) / len(a | b) if a and b else 0.0)
        return out

    return score


#: Makers of rerankers by kind: ``make(path, **options)`` gives what :func:`millrace.operators.metrics.rerank` takes.
BACKENDS: dict[str, Callable] = {"word-overlap": lambda path=None, **options: overlap_scorer}
# Kinds of rerankers that model files are recognised as
CROSS_ENCODER, QWEN, JINA = "cross-encoder", "qwen-reranker", "jina-v3"


def register_backend(kind: str, make: Callable) -> None:
    """Add a kind of reranker, or replace it."""
    BACKENDS[kind] = make


def model_kind(path: str, config: dict | None = None) -> str:
    """The kind of reranker at ``path``, by its name and its ``config.json`` (read if it is there and none is given)."""
    name = path.lower().replace("\\", "/")
    if config is None:
        file = os.path.join(path, "config.json")
        config = {}
        if os.path.isfile(file):
            with open(file, encoding="utf-8") as f:
                config = json.load(f)
    built = [str(x).lower() for x in config.get("architectures") or []] + [str(config.get("auto_map") or "").lower()]
    if "jina-reranker-v3" in name or any("jinaforranking" in x for x in built):
        return JINA
    generative = any("forcausal" in x for x in built[:-1]) or str(config.get("model_type") or "").lower() in ("qwen3", "qwen2", "llama")
    if (generative and "rerank" in name) or ("qwen" in name and "reranker" in name):
        return QWEN
    return CROSS_ENCODER


def reranker(path: str, kind: str = "auto", **options) -> Callable:
    """A maker of scorers for a model, by its registered kind; ``auto`` looks at the model. Raises for kinds that aren't registered."""
    kind = model_kind(path) if kind == "auto" else kind
    if kind not in BACKENDS:
        raise ValueError(f"no backend for {kind!r}; there are {sorted(BACKENDS)}")
    return BACKENDS[kind](path, **options)
