"""Benchmark decontamination: test items found inside documents, in native functions only.

Containment of an item in a document is the share of the item's distinct
five-word shingles that the document has. A minimum of an item's shingles under a
random order is a uniformly drawn shingle, so it lies in a document with the
probability of the containment: minima are looked up among the document's
shingles, however long it is. Items are partitioned by size, in powers of two,
and each partition takes as many minima as make a miss at the threshold as
unlikely as asked; where that is no fewer than its items have, it takes them all.
What a minimum finds is verified by the exact containment.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludometry.llm.base import few, row_keys, written

WORDS, LEAST = 5, 0.8
# Chance to miss an item of a large partition at the threshold.
MISS = 1e-9


def words(text: Column) -> Column:
    """Runs of letters and digits, lower-cased."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda word: word != "")


def _names(size: int) -> list[str]:
    return [f"w{k}" for k in range(size)]


def shingles(rows: DataFrame, key: str, size: int = WORDS) -> DataFrame:
    """(key, w0, w1, ...): every ``size`` consecutive words of every text, repeats included.

    The words are a column of their own before they are shifted against each
    other, so that a text is split once; the rest is one pass of generated code.
    """
    split = rows.select(F.col(key).alias("key"), words(F.col("text")).alias("words"))
    count = F.greatest(F.size("words") - F.lit(size - 1), F.lit(0))
    shifted = [F.slice("words", k + 1, count).alias(name) for k, name in enumerate(_names(size))]
    return split.select("key", F.inline(F.arrays_zip(*shifted))).toDF(key, *_names(size))


def sketches(items: DataFrame, size: int = WORDS, least: float = LEAST, miss: float = MISS) -> DataFrame:
    """(item_id, hash): the hashes of the minima of items (item_id, w0, w1, ..., n).

    A partition holds the items of [2^k, 2^(k+1)) shingles. ``draws`` minima miss
    a document at the threshold with probability (1 - least)^draws.
    """
    names = _names(size)
    draws = math.ceil(math.log(miss) / math.log(1 - least))
    part = F.floor(F.log2("n"))
    # Small partitions take every shingle; their one order has a row of each.
    small = F.pow(F.lit(2), part) <= draws
    hashed = items.select("item_id", small.alias("small"), F.xxhash64(*names).alias("hash"))
    orders = F.when(F.col("small"), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(draws - 1)))
    drawn = hashed.withColumn("draw", F.explode(orders))
    own = F.when(F.col("small"), F.col("hash")).otherwise(F.lit(0))
    minima = drawn.groupBy("item_id", "draw", own.alias("own")).agg(
        F.min_by("hash", F.xxhash64("draw", "hash")).alias("hash")
    )
    return minima.select("item_id", "hash").distinct()


def contained(docs: DataFrame, benchmark: DataFrame, size: int = WORDS, least: float = LEAST) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment) wherever it is ``least`` or more.

    Documents are (doc_id, text), items (item_id, text), texts of any length.
    Null and empty texts, and items of fewer than ``size`` words, contain nothing
    and are found nowhere. Rows that share an item_id are one item, rows that
    share a doc_id, null among them, one document of all their shingles. Other
    columns are ignored; an empty table on either side gives an empty result.
    """
    names = _names(size)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    own = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    distinct = shingles(own, "item_id", size).distinct()
    sizes = distinct.groupBy(F.col("item_id").alias("sized")).agg(F.count(F.lit(1)).alias("n"))
    items = written(distinct.join(sizes, F.col("item_id").eqNullSafe(F.col("sized"))).drop("sized"), "items")
    sketch = few(written(sketches(items, size, least), "sketches"))
    probes = shingles(rows, "doc_id", size).select("doc_id", F.xxhash64(*names).alias("hash"))
    met = probes.join(sketch, "hash").select("doc_id", "item_id").distinct()
    pairs = written(met.select(F.col("doc_id").alias("met_doc"), F.col("item_id").alias("met_item")), "pairs")
    met_docs = few(written(pairs.select("met_doc").distinct(), "met"))
    candidates = rows.join(met_docs, F.col("doc_id").eqNullSafe(F.col("met_doc")), "left_semi")
    shared = shingles(candidates, "doc_id", size).join(few(items), names).select("doc_id", "item_id", "n", *names).distinct()
    counted = shared.groupBy("doc_id", "item_id").agg(
        F.count(F.lit(1)).alias("n_shared"), F.first("n").alias("n_item")
    )
    same = F.col("doc_id").eqNullSafe(F.col("met_doc")) & F.col("item_id").eqNullSafe(F.col("met_item"))
    found = counted.join(pairs, same, "left_semi").withColumn("containment", F.col("n_shared") / F.col("n_item"))
    return found.filter(F.col("containment") >= least)


def without_items(docs: DataFrame, benchmark: DataFrame, size: int = WORDS, least: float = LEAST) -> DataFrame:
    """The documents, all columns, that contain no item; rows that share a doc_id go together."""
    found = contained(docs, benchmark, size, least).select(F.col("doc_id").alias("_found")).distinct()
    found = written(found, "contaminated")
    return docs.join(few(found), docs["doc_id"].cast("long").eqNullSafe(found["_found"]), "left_anti")


def clean_rows(docs: DataFrame, benchmark: DataFrame, size: int = WORDS, least: float = LEAST) -> DataFrame:
    """The rows, all columns, whose own text contains no item.

    Rows that share a doc_id, or have none, are judged each on its own.
    """
    rows, key = row_keys(docs, "doc_id")
    own = rows.select(F.col(key).alias("doc_id"), "text")
    found = contained(own, benchmark, size, least).select(F.col("doc_id").alias("_found")).distinct()
    found = written(found, "contaminated")
    return rows.join(few(found), rows[key].cast("long") == found["_found"], "left_anti").select(*docs.columns)
