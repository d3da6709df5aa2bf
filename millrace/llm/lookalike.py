"""Problem 8: visually identical text with different characters."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Scratch
from . import charform


#: Rows of one text that meet those of another in one task.
BLOCK = 4096


def character_counts(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """``(character, n)`` of the characters of look-alike classes, over all texts. Partial counts leave
    Python once per batch, so what is shuffled is bounded by the alphabet."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = charform.count_characters(b.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], ["character", "n"])

    part = texts.select(F.col(text_col).cast("string").alias("t")).mapInArrow(count, "character string, n bigint")
    return part.groupBy("character").agg(F.sum("n").alias("n"))


def rewrite_table(texts: DataFrame, text_col: str = "text") -> dict[str, str]:
    """The rewriting rules with representatives by corpus frequency. What comes to the driver is one number
    for each character of the fixed relation (some ten thousand at most, whatever the corpus)."""
    counts = {r["character"]: r["n"] for r in character_counts(texts, text_col).collect()}
    table = charform.rewrites(counts, only_counted=True)
    return dict(sorted(table.items(), key=lambda kv: (-counts.get(kv[0], 0), kv[0])))


def normalise_text(texts: DataFrame, text_col: str = "text", out_col: str = "text_form", table: dict[str, str] | None = None) -> DataFrame:
    """Add ``out_col``: the text in the one consistent form. Equal-looking texts get equal forms.

    Null text: null form. Empty text: empty form. Other columns pass through; an existing ``out_col`` is
    replaced. The look-alike relation is fixed, representatives come from all rows of ``texts``."""
    table = rewrite_table(texts, text_col) if table is None else table

    @F.pandas_udf("string")
    def form(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        rewrite = charform.Rewriter(table)
        for s in batches:
            yield pd.Series([None if t is None else rewrite(t) for t in s], dtype=object)

    return texts.withColumn(out_col, form(F.col(text_col).cast("string")))


def form_hashes(texts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, form, raw)``: 128-bit hashes of the form and of the text itself; rows with null text are left out."""
    table = rewrite_table(texts, text_col)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rewrite = charform.Rewriter(table)
        for b in batches:
            ts = b.column(1).to_pylist()
            form = pa.array([xxhash.xxh3_128_digest(rewrite(t).encode("utf-8", "surrogatepass")) for t in ts], pa.binary())
            raw = pa.array([xxhash.xxh3_128_digest(t.encode("utf-8", "surrogatepass")) for t in ts], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), form, raw], ["id", "form", "raw"])

    known = texts.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")).where("t is not null and id is not null")
    kind = dict(known.dtypes)["id"]
    return known.mapInArrow(hashes, f"id {kind}, form binary, raw binary")


def look_alike_pairs(spark: SparkSession, texts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_a, doc_b)``: texts that differ, but only in character form; the smaller id first, rows distinct.

    Exact copies of one text are no case, so groups with one text only are dropped before the join. Different texts of
    a form are paired first, then the rows of the rarer text meet those of the more frequent one in blocks of BLOCK rows: a
    text with a third of all rows is spread over many tasks, and what is made is little more than the result. Null texts are
    no case; an empty text and one of nothing but characters without width are."""
    tmp = Scratch(spark, "p8")
    h = tmp.cut(form_hashes(texts, id_col, text_col))
    mixed = h.groupBy("form").agg(F.min("raw").alias("lo"), F.max("raw").alias("hi")).where("lo <> hi").select("form")
    rows = tmp.cut(h.join(mixed, "form", "left_semi").distinct())
    t = tmp.cut(rows.groupBy("form", "raw").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"), F.count("*").alias("n")))
    few = t.select("form", F.col("raw").alias("few"), F.col("n").alias("n_few"))
    many = t.select("form", F.col("raw").alias("many"), F.col("n").alias("n_many"), "blocks")
    two = few.join(many, "form").where("n_few < n_many or (n_few = n_many and few < many)").select("few", "many", "blocks")
    # the hash of a text is of 128 bits: it names the text without its form
    one = two.join(rows.select(F.col("raw").alias("few"), F.col("id").alias("a")), "few")
    one = one.select("many", "a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    other = rows.join(t.select("raw", "blocks"), "raw").select(F.col("raw").alias("many"), F.col("id").alias("b"), F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block"))
    pairs = one.join(other, ["many", "block"]).where("a <> b")
    return pairs.select(F.least("a", "b").alias("doc_a"), F.greatest("a", "b").alias("doc_b")).distinct()


def form_classes(texts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, class_id, n_texts, n_rows)``: every row with its class of equal-looking texts. ``class_id`` is the
    smallest id of the class, ``n_texts`` the number of different texts in it. Null texts are left out."""
    h = form_hashes(texts, id_col, text_col)
    t = h.groupBy("form", "raw").agg(F.min("id").alias("lo"), F.count("*").alias("n"))
    c = t.groupBy("form").agg(F.min("lo").alias("class_id"), F.count("*").alias("n_texts"), F.sum("n").alias("n_rows"))
    return h.select("id", "form").join(c, "form").select(F.col("id").alias(id_col), "class_id", "n_texts", "n_rows")
