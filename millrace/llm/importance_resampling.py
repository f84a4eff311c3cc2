"""Resampling of documents towards a target collection, by importance weights of hashed n-grams.

A feature is a run of one to three words. Every feature falls into one of a fixed
number of buckets by its checksum; the weight of a document is the sum, over its
features, of how much likelier their buckets are in the target than in the
documents. Noise drawn from the document's key turns weights into a sample without
replacement (the highest sums of weight and Gumbel noise).
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import on_workers, stored

BUCKETS = 10_000
LONGEST = 3

#: Digits, small letters and all bytes of letters beyond ASCII stay, capitals become small, the rest separates words.
_KEEP = bytes(b if chr(b).isdigit() or 97 <= b < 123 or b > 127 else b + 32 if 65 <= b < 91 else 32 for b in range(256))

#: At each word: the word, and the next two with the space before them. Matches overlap; the look-behind lets
#: them begin at a word only, and possessive runs end at a word's end.
_SPANS = regex.compile(rb"(?<![^ ])([^ ]++)" + rb"( [^ ]++)?" * (LONGEST - 1))

_HISTOGRAM = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_features", T.LongType()),
        T.StructField("buckets", T.BinaryType()),
        T.StructField("times", T.BinaryType()),
    ]
)


def feature_checksums(text: bytes) -> tuple[int, array]:
    """Number of words of a text, and the crc32 of each of its features."""
    line = b" ".join(text.translate(_KEEP).split())
    found, n_words, crc32 = array("I"), 0, zlib.crc32
    for match in _SPANS.finditer(line, overlapped=True):
        n_words += 1
        first, second, third = match.groups()
        crc = crc32(first)
        found.append(crc)
        if second is not None:
            crc = crc32(second, crc)  # a checksum can be continued, so each byte is read once a span
            found.append(crc)
            if third is not None:
                found.append(crc32(third, crc))
    return n_words, found


def _histogram(text: bytes | None, buckets: int) -> tuple[int, int, bytes, bytes]:
    n_words, found = feature_checksums(text or b"")
    held, times = np.unique(np.frombuffer(found, np.uint32) % buckets if found else np.empty(0, np.uint32), return_counts=True)
    gaps = np.diff(held.astype(np.int64), prepend=0).astype("<u4")
    return n_words, len(found), gaps.tobytes(), times.astype("<u4").tobytes()


def _held(gaps: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(gaps, "<u4").astype(np.int64))


def histograms(docs: DataFrame, text: str, kept: dict[str, Column], buckets: int = BUCKETS) -> DataFrame:
    """The columns ``kept`` and, for each row, words, features and its histogram over buckets: the gaps between the
    buckets that it holds and how often it holds them, at most ``buckets`` of each however long the text is."""
    on_workers(docs)
    rows = docs.select(*[c.alias(n) for n, c in kept.items()], F.col(text).cast("binary").alias("_text"))
    schema = T.StructType([*rows.drop("_text").schema.fields, *_HISTOGRAM.fields])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(zip(*[_histogram(x.as_py(), buckets) for x in batch.column("_text")])) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
            made = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=schema.names)

    return rows.mapInArrow(scan, schema)


def _bucket_totals(rows: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket. Each task sends at most one row a bucket, and so does the sum of them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for gaps, times in zip(batch.column(0), batch.column(1)):
                total[_held(gaps.as_py())] += np.frombuffer(times.as_py(), "<u4")
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    parts = rows.select("buckets", "times").mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[bucket] = n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 ln(p / q))`` of each bucket, with one more feature put into each bucket on both sides."""
    buckets = len(source)
    up = (target + 1).astype(float) * float(source.sum() + buckets)
    down = (source + 1).astype(float) * float(target.sum() + buckets)
    return np.floor(1000 * np.log(up / down)).astype(np.int64)


def _weights(rows: DataFrame, gains: np.ndarray) -> DataFrame:
    kept = [n for n in rows.columns if n not in ("buckets", "times")]
    schema = T.StructType([*rows.select(*kept).schema.fields, T.StructField("weight", T.LongType())])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [
                int(gains[_held(g.as_py())] @ np.frombuffer(t.as_py(), "<u4").astype(np.int64))
                for g, t in zip(batch.column(len(kept)), batch.column(len(kept) + 1))
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(sums, pa.int64())], names=schema.names)

    return rows.select(*kept, "buckets", "times").mapInArrow(weigh, schema)


def gumbel_score(weight: Column, key: Column, seed: str) -> Column:
    """Weight plus noise that only the key and the seed decide; NULL without a key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return weight + F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def with_ranks(rows: DataFrame, order: list[Column], upto: int, rank: str) -> DataFrame:
    """Global row number in ``order`` up to ``upto``, NULL beyond. Rows are dealt by range and numbered in each range;
    the table that is written holds both numbers, and only the sizes of the ranges reach the driver."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    dealt = stored(dealt.withColumns({"_part": F.spark_partition_id(), "_place": place}), "ranges")
    before, offsets = 0, []
    for part, n in sorted(dealt.groupBy("_part").count().collect()):
        offsets.append((part, before))
        before += n
    starts = spark.createDataFrame(offsets, "_part int, _before long")
    number = F.col("_before") + F.col("_place") + 1
    numbered = dealt.join(F.broadcast(starts), "_part")
    return numbered.withColumn(rank, F.when(number <= upto, number)).drop("_part", "_place", "_before")


def resampled(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    percent: int = 5,
    least_words: int = 20,
    seed: str = "42",
    buckets: int = BUCKETS,
) -> DataFrame:
    """``key, n_features, weight, score, rank`` for every row of ``docs``.

    ``rank`` numbers the ``percent`` of the rows with at least ``least_words`` words that have the highest score, equal
    scores by key; it is NULL for all others.

    Texts are read whole and once, whatever their length: of a very long one only its histogram is kept. A NULL or empty
    text has no features, weight 0 and a score, but too few words to be drawn. A row without a key has no score and does not
    count among those that are drawn from. Repeated rows are rows of their own with equal scores; all other columns of either
    table are ignored, whatever their names. Without a target text all buckets count as equally likely there. Empty ``docs``
    give no rows.
    """
    aim = _bucket_totals(histograms(target, target_text, {}, buckets), buckets)
    rows = stored(histograms(docs, text, {"_key": F.col(key)}, buckets), "histograms")
    weighed = _weights(rows, bucket_gains(_bucket_totals(rows, buckets), aim))
    scored = stored(weighed.withColumn("score", gumbel_score(F.col("weight"), F.col("_key"), seed)), "weights")
    fit = F.col("score").isNotNull() & (F.col("n_words") >= least_words)
    drawn = percent * scored.filter(fit).count() // 100
    order = [F.desc("score"), F.asc("_key"), F.desc("weight")]
    ranked = with_ranks(scored.filter(fit), order, drawn, "rank")
    rest = scored.filter(~fit).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select(F.col("_key").alias(key), "n_features", "weight", "score", "rank")
