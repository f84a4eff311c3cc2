"""Benchmark items inside documents, by size-partitioned MinHash containment search.

Test items are put into size classes (powers of two of their shingles). For a
class of size L a document is read in windows of 2 L shingles that start every
L, so an item's passage lies whole inside one of them and is never a tiny share
of what it is compared with. Of a window only shingles that occur in items of
the class count; dropping the others changes no containment. A window and an
item that agree in one of the MinHash values become a candidate, and exact
shingle containment decides.

For a window that holds 0.8 of an item the Jaccard similarity is 0.19 or more
(at least 0.4 L shared of at most 2.1 L), so ``HASHES`` = 48 values miss it with
a probability below 0.00005; for a passage with nothing else of the class around
it the similarity is 0.8 and the probability practically zero.

Everything here is a DataFrame operation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored

WIDTH = 5
HASHES = 48
THRESHOLD = 0.8
#: Item shingles are broadcast up to this many rows (a long and an int each), and joined by shuffle beyond.
BROADCAST_ROWS = 2_000_000


def word_hashes(text: Column) -> Column:
    """Hash of each word; a word is a longest run of letters and digits, in lower case."""
    found = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.array_remove(found, F.lit("")), lambda w: F.xxhash64(w))


def shingle_hashes(words: str, width: int = WIDTH) -> Column:
    """Hashes of ``width`` words in a row, from a column of word hashes. Fewer words make
    one shingle of all, none make none."""
    w = F.col(words)
    many = F.transform(
        F.sequence(F.lit(0), F.size(w) - width), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)])
    )
    short = F.array(F.xxhash64(F.lit("short"), w))
    return F.when(F.size(w) >= width, many).when(F.size(w) > 0, short).otherwise(F.expr("array()").cast("array<bigint>"))


def item_shingles(items: DataFrame, key: str, text: str) -> DataFrame:
    """``item, shingle, n, size_class`` with the distinct shingles of each item; rows with
    equal keys are one item of all their shingles, rows without a key are left out."""
    words = items.filter(F.col(key).isNotNull()).select(F.col(key).alias("item"), word_hashes(F.col(text)).alias("w"))
    rows = words.select("item", F.explode(shingle_hashes("w")).alias("shingle")).distinct()
    sizes = rows.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.withColumn("size_class", F.ceil(F.log2(F.col("n"))).cast("int"))
    return rows.join(sizes, "item")


def content(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def find_items(
    docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``content, item, shared, n, containment`` for each distinct text of ``docs`` (by
    digest) and each item of which it holds ``THRESHOLD`` or more."""
    wanted = stored(item_shingles(items, item_key, item_text), "items")
    known = wanted.select("shingle", "size_class").distinct()
    if known.count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    words = docs.select(content(F.col(text)).alias("content"), word_hashes(F.col(text)).alias("w"))
    grams = words.select("content", F.posexplode(shingle_hashes("w")).alias("place", "shingle"))
    # Copies of a text, and shingles that repeat within a window, fall together before the shuffle.
    length = F.expr("shiftleft(1, size_class)")
    at = F.floor(F.col("place") / length)
    held = grams.join(known, "shingle").select("content", "size_class", at.alias("window"), "shingle").distinct()
    held = stored(held, "held")
    both = held.withColumn("window", F.explode(F.array("window", F.col("window") - 1)))
    sketch = [F.min(F.xxhash64("shingle", F.lit(i))).alias(f"h{i}") for i in range(HASHES)]
    values = F.array(*[f"h{i}" for i in range(HASHES)])
    windows = both.groupBy("content", "size_class", "window").agg(*sketch)
    windows = stored(
        windows.select("content", "size_class", values.alias("values")).withColumn(
            "sketch", F.md5(F.concat_ws(",", F.transform("values", lambda v: v.cast("string"))))
        ),
        "windows",
    )
    # Windows with the same sketch, such as those of a passage that many documents share, are searched once.
    distinct = windows.groupBy("size_class", "sketch").agg(F.any_value("values").alias("values"))
    bands = distinct.select("size_class", "sketch", F.posexplode("values").alias("i", "value"))
    asked = wanted.groupBy("item", "size_class").agg(*sketch).select("item", "size_class", F.posexplode(values).alias("i", "value"))
    similar = bands.join(asked, ["size_class", "i", "value"]).select("size_class", "sketch", "item").distinct()
    similar = stored(similar, "similar")
    pairs = windows.select("content", "size_class", "sketch").join(similar, ["size_class", "sketch"])
    pairs = stored(pairs.select("content", "item").distinct(), "pairs")
    there = held.select("content", "shingle").distinct()
    shared = (
        pairs.join(wanted.select("item", "shingle", "n"), "item")
        .join(there, ["content", "shingle"])
        .groupBy("content", "item")
        .agg(F.count(F.lit(1)).alias("shared"), F.max("n").alias("n"))
        .withColumn("containment", F.col("shared") / F.col("n"))
    )
    return shared.filter(F.col("containment") >= THRESHOLD)


def leaks(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``key, item_id, shared, containment``: one row for each row of ``docs`` and item it holds.

    NULL and empty texts and items hold nothing and are held by nothing; an item
    of fewer than five words is found only in a text of just these words. Rows
    with equal keys or a NULL key are judged by their own texts. Empty tables
    give an empty result; other columns are ignored.
    """
    found = stored(find_items(docs, items, text, item_key, item_text), "leaks")
    rows = docs.select(F.col(key), content(F.col(text)).alias("content"))
    return rows.join(found, "content").select(key, F.col("item").alias(item_key), "shared", "containment")


def without_leaks(docs: DataFrame, items: DataFrame, text: str = "text", **names: str) -> DataFrame:
    """The rows of ``docs`` whose text holds no item, with all their columns."""
    found = find_items(docs, items, text, **names)
    found = stored(found.select(F.unhex("content").alias("content")).distinct(), "leaks")
    rows = docs.select(F.struct("*").alias("d"), F.unhex(content(F.col(text))).alias("content"))
    return rows.join(found, "content", "left_anti").select("d.*")
