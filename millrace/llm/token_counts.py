"""Token counts through a cache of content digests.

A count depends on the normalised content and on the tokenizer's version only.
Counts are kept in a table with the digests of both; a run joins its contents
to that table, encodes each distinct content that is missing once, and appends
the new counts. The table only ever grows by whole Parquet commits, so a lost
executor or a failed run leaves it usable, and two runs that add the same
content add the same count.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import on_workers, stored

CACHE_SCHEMA = "content string, tokenizer string, n_tokens long"
MEMO_WORDS = 800_000
#: The tokenizer's own word pattern, for the letters in PLAIN.
PLAIN = re.compile(r"[\x00-\x7fÀ-ÖØ-öø-ÿ]*")
WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\t\n\x0b\x0c\r 0-9a-zß-öø-ÿ]+")


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def normalised(text: Column) -> Column:
    """Content without what cannot change a count: the tokenizer reads any run of
    white space as a break between words. NULL counts as empty."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t\n\r]+", " "))


class WordCounter:
    """Token counts of texts, with a bounded memory of words met before.

    The tokenizer breaks a text into words and encodes each on its own, so
    counts add up over words. Texts with letters outside ``PLAIN`` or with the
    beginning of a special token are given to the tokenizer as they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memo: dict[str, int] = {}

    def _learn(self, words: set[str]) -> None:
        fresh = sorted(words - self.memo.keys())
        for i in range(0, len(fresh), 20_000):
            part = fresh[i : i + 20_000]
            ids = self.tokenizer.encode(" ".join(part), add_special_tokens=False).word_ids
            counts = [0] * len(part)
            for w in ids:
                counts[w] += 1
            self.memo.update(zip(part, counts))

    def count(self, texts: list[str]) -> list[int]:
        out: list[int] = []
        for i in range(0, len(texts), 256):
            part = texts[i : i + 256]
            plain = [PLAIN.fullmatch(t) is not None and "<|" not in t for t in part]
            found = [WORD.findall(t.lower()) if p else None for t, p in zip(part, plain)]
            if len(self.memo) > MEMO_WORDS:
                self.memo = {}
            self._learn(set(chain.from_iterable(f for f in found if f)))
            rest = iter(
                self.tokenizer.encode_batch([t for t, p in zip(part, plain) if not p], add_special_tokens=False)
            )
            get = self.memo.__getitem__
            out += [len(next(rest).ids) if f is None else sum(map(get, f)) for f in found]
        return out


_counters: dict[str, WordCounter] = {}


def _encode(path: str, version: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if version not in _counters:
            _counters[version] = WordCounter(path)
        for b in batches:
            counts = _counters[version].count(b.column("body").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column("content"), pa.array([version] * len(b), pa.string()), pa.array(counts, pa.int64())],
                names=["content", "tokenizer", "n_tokens"],
            )

    return run


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Stored counts of one tokenizer, one row per content; empty if there is no cache yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        rows = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    else:
        rows = spark.createDataFrame([], CACHE_SCHEMA)
    return rows.filter(F.col("tokenizer") == version).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def add_missing(docs: DataFrame, cache: str, path: str, text: str = "text") -> None:
    """Encode each distinct content of ``docs`` that the cache lacks and append its count."""
    on_workers(docs)
    version = tokenizer_digest(path)
    body = normalised(F.col(text))
    # One row per content leaves each map task, so no group of copies meets in one place.
    distinct = (
        docs.select(body.alias("body"))
        .select(F.sha2("body", 256).alias("content"), "body")
        .groupBy("content")
        .agg(F.any_value("body").alias("body"))
    )
    known = read_cache(docs.sparkSession, cache, version)
    misses = distinct.join(known, "content", "left_anti")
    misses.mapInArrow(_encode(path, version), CACHE_SCHEMA).write.mode("append").parquet(cache)


def count_tokens(
    docs: DataFrame, cache: str, path: str, key: str = "doc_id", text: str = "text", limit: int = 2048
) -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` for every row of ``docs``.

    ``path`` is a tokenizer file that each executor can open, ``cache`` a folder
    all of them share. NULL and empty texts have no bytes and no tokens. Repeated
    rows, also with equal keys or a NULL key, each give a row; other columns are
    ignored. An empty table gives an empty result.
    """
    add_missing(docs, cache, path, text)
    # Stored, so that nothing but the join stands above its shuffle and Spark can split a much repeated content.
    counts = stored(read_cache(docs.sparkSession, cache, tokenizer_digest(path)), "counts")
    rows = docs.select(
        F.col(key),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        F.sha2(normalised(F.col(text)), 256).alias("content"),
    )
    return rows.join(counts, "content", "left").select(
        key, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
