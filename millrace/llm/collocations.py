"""Phrases whose words keep together, mined shard by shard (SON).

A phrase that occurs ``support`` times must occur ``ceil(support / shards)`` times in at least one of the shards. So
each shard is mined completely at that lowered support, level by level: longer phrases are only looked for where their
shorter ones are frequent in the same shard. The union of what the shards found is then counted exactly in all texts.
A shard is a share of the documents by hash and is itself spread over all tasks.

Mining compares 64-bit hashes and filters of a fixed size. Both can only let more phrases into the union, never fewer;
the exact count decides over them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import on_workers, stored
from millrace.llm.hashfilter import hash_filters, passes
from millrace.llm.textarrays import mix

U = np.uint64
SLICE_BYTES = 4_000_000
#: All ends of pieces become a full stop, tabs become spaces, capitals small letters.
_PLAIN = bytes(
    46 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b < 91 else b for b in range(256)
)
_STOP = b"."
_LEFT = U(0xD6E8FEB86659FD93)
#: Bits of each filter; there is one for each shard.
MINED_BITS = 26


class _Numbers(dict):
    """Words to consecutive numbers; the end of a piece is 0."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


class Words:
    """A slice of words as numbers. ``carried`` words before it give context and were counted in the slice before."""

    def __init__(self, tokens: list[bytes], carried: int, seed: int):
        numbers = _Numbers({_STOP: 0})
        self.tokens, self.carried = tokens, carried
        self.ids = np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens))
        self.size = len(numbers)
        self.hashes = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in numbers), U, self.size)

    def spans(self, width: int, context: bool = False) -> np.ndarray:
        """Last places of all runs of ``width`` words within a piece that end in the slice proper, or anywhere."""
        within = self.ids != 0
        whole = within[width - 1 :].copy()
        for k in range(width - 1):
            whole &= within[k : len(within) - width + 1 + k]
        last = np.flatnonzero(whole) + width - 1
        return last if context else last[np.searchsorted(last, self.carried) :]

    def hashed(self, last: np.ndarray, width: int) -> np.ndarray:
        """Hash of the run of ``width`` words that ends at each place."""
        h = self.hashes[self.ids[last - width + 1]]
        for k in range(width - 2, -1, -1):
            h = mix(h * _LEFT + self.hashes[self.ids[last - k]])
        return h

    def counted(self, last: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """A last place of each distinct run, and how often the run occurs. Runs are told apart by their words' numbers."""
        code = self.ids[last - width + 1]
        for k in range(width - 2, -1, -1):
            if self.size ** (width - k) >= 1 << 62:  # too many words to keep the numbers of all in one code
                code = np.unique(code, return_inverse=True)[1]
            code = code * self.size + self.ids[last - k]
        _, first, n = np.unique(code, return_index=True, return_counts=True)
        return last[first], n

    def phrase(self, last: int, width: int) -> bytes:
        return b" ".join(self.tokens[last - width + 1 : last + 1])


def word_slices(texts: list[bytes], longest: int, seed: int, size: int = SLICE_BYTES) -> Iterator[Words]:
    """The words of the texts, at most about ``size`` bytes at a time; pieces end where texts end."""
    line = (b" " + _STOP + b" ").join(x.translate(_PLAIN).replace(_STOP, b" . ") for x in texts)
    carry: list[bytes] = []
    start = 0
    while start < len(line):
        end = len(line)
        if end - start > size:
            cut = line.rfind(b" ", start, start + size)
            cut = cut if cut > start else line.find(b" ", start + size)
            end = cut if cut >= 0 else end
        tokens = line[start:end].split()
        start = max(end, start + 1)
        if tokens:
            yield Words(carry + tokens, len(carry), seed)
            carry = (carry + tokens)[-(longest - 1) :] if longest > 1 else []


Counts = Callable[[Words, int], Iterator[tuple[int, np.ndarray, np.ndarray]]]


def _scan(rows: DataFrame, longest: int, counts: Counts, named: bool) -> DataFrame:
    """Run ``counts`` over slices of words. It yields a width, last places of runs and their numbers; the result has
    ``shard, h, n`` or, if ``named``, ``lang, width, phrase, n`` (width 0: all words)."""
    on_workers(rows)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for lang in pc.unique(table["lang"]):
                for shard in pc.unique(table["shard"]):
                    mine = pc.and_(pc.equal(table["lang"], lang), pc.equal(table["shard"], shard))
                    texts = table.filter(mine)["text"].to_pylist()
                    seed = xxhash.xxh32_intdigest(lang.as_py().encode())
                    for words in word_slices(texts, longest, seed):
                        for width, last, n in counts(words, shard.as_py()):
                            if named:
                                phrases = [words.phrase(i, width) for i in last.tolist()]
                                columns = [pa.array([lang.as_py()] * len(n)), pa.array(np.full(len(n), width)),
                                           pa.array(phrases, pa.binary()), pa.array(n, pa.int64())]
                            else:
                                h = words.hashed(last, width).view(np.int64)
                                columns = [pa.array(np.full(len(n), shard.as_py())), pa.array(h), pa.array(n, pa.int64())]
                            if len(n):
                                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["lang", "width", "phrase", "n"] if named else ["shard", "h", "n"]
    return rows.mapInArrow(task, "lang string, width long, phrase binary, n long" if named else "shard long, h long, n long")


def mined(rows: DataFrame, longest: int, local_support: int, shards: int) -> DataFrame:
    """``h`` of all phrases of 1 to ``longest`` words that occur ``local_support`` times in one shard."""
    found, known = None, None
    for width in range(1, longest + 1):

        def counts(words: Words, shard: int, width=width, known=known):
            last = words.spans(width)
            if known is not None:  # both runs that are a word shorter must be frequent in this shard
                shorter = words.spans(width - 1, context=True)
                good = np.zeros(len(words.ids), bool)
                good[shorter] = passes(known.value[shard], words.hashed(shorter, width - 1))
                last = last[good[last] & good[last - 1]]
            yield width, *words.counted(last, width)

        local = _scan(rows, longest, counts, named=False).groupBy("shard", "h").agg(F.sum("n").alias("n"))
        local = stored(local.filter(F.col("n") >= local_support).select(F.col("shard").alias("part"), "h"), f"mined-{width}")
        if width < longest:
            known = rows.sparkSession.sparkContext.broadcast(hash_filters(local, shards, MINED_BITS))
        found = local if found is None else found.unionByName(local)
    return found.select("h")


def counted_globally(rows: DataFrame, longest: int, union: DataFrame) -> DataFrame:
    """``lang, width, phrase, n``: exact counts of the phrases of the union, and all words under width 0. The filter
    lets some other phrases through, whose counts are exact too."""
    known = rows.sparkSession.sparkContext.broadcast(hash_filters(union.withColumn("part", F.lit(0))))

    def counts(words: Words, shard: int):
        single = words.spans(1)
        yield 0, single[:1], np.array([len(single)])[: len(single)]
        good = np.ones(len(words.ids), bool)
        for width in range(1, longest + 1):
            last = words.spans(width, context=True)
            if width > 1:
                last = last[good[last] & good[last - 1]]
            last = last[passes(known.value[0], words.hashed(last, width))]
            good = np.zeros(len(words.ids), bool)
            good[last] = True
            yield width, *words.counted(last[np.searchsorted(last, words.carried) :], width)

    found = _scan(rows, longest, counts, named=True)
    phrase = F.when(F.col("width") > 0, F.col("phrase").cast("string")).otherwise("").alias("phrase")
    return found.groupBy("lang", "width", phrase).agg(F.sum("n").alias("n"))


def scored(counts: DataFrame, million: int = 1_000_000) -> DataFrame:
    """``lang, width, phrase, a, l, r, score`` of all phrases of at least two words, by their worst cut. Products are
    exact decimals; the quotient is at most a million, as no part is rarer than the whole."""
    single = counts.filter("width > 0").select("lang", F.col("phrase").alias("part"), "n")
    cuts = counts.filter("width > 1").select(
        "lang", "width", "phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("width") - 1)).alias("k")
    )
    words = F.split("phrase", " ")
    cuts = cuts.withColumns(
        {
            "left": F.array_join(F.slice(words, F.lit(1), F.col("k").cast("int")), " "),
            "right": F.array_join(F.slice(words, (F.col("k") + 1).cast("int"), (F.col("width") - F.col("k")).cast("int")), " "),
        }
    )
    cuts = cuts.join(single.select("lang", F.col("part").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cuts = cuts.join(single.select("lang", F.col("part").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    a, l, r = (f"cast({c} AS decimal(15, 0))" for c in "alr")
    score = F.expr(f"(cast({million} AS decimal(7, 0)) * {a} * {a}) div ({l} * {r})")
    worst = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("w")
    return cuts.groupBy("lang", "width", "phrase", "a").agg(worst).select("lang", "width", "phrase", "a", "w.l", "w.r", "w.score")


def covered(counts: DataFrame, percent: int) -> DataFrame:
    """``lang, phrase`` of those that lie inside a longer phrase with at least ``percent`` of their occurrences."""
    longer = counts.filter("width > 2").withColumn("words", F.split("phrase", " "))
    inner = longer.select("lang", F.col("n").alias("whole"), "words", F.explode(F.sequence(F.lit(2), F.col("width") - 1)).alias("w"))
    inner = inner.withColumn("at", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("w").cast("int") + 1)))
    phrase = F.array_join(F.slice("words", F.col("at"), F.col("w").cast("int")), " ").alias("phrase")
    most = inner.groupBy("lang", phrase).agg(F.max("whole").alias("whole"))
    held = counts.filter("width > 1").join(most, ["lang", "phrase"])
    return held.filter(100 * F.col("whole") >= percent * F.col("n")).select("lang", "phrase")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    longest: int = 3,
    support: int = 10,
    percent: int = 50,
    top: int = 2000,
    shards: int = 3,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of 2 to ``longest`` words of each language.

    Words are what blanks and tabs part; a phrase lies within a piece between stops, commas, colons, semicolons, marks and
    line ends. ``a`` counts the phrase, ``l`` and ``r`` the two parts of its worst cut, ``n`` all words of the language.

    A NULL language is ``und``; a NULL or empty text has no words. Very long texts are read whole, in slices that carry the
    last words over, so a task holds a batch of texts and one slice of words. Repeated rows count each time. Equal scores are
    ordered by count, then phrase. Other columns are ignored, whatever their names. Empty tables give no rows. With more than
    ``support`` - 1 shards the local support would be 1 and nothing would be pruned, so that is refused.
    """
    if not 1 <= shards < support or longest < 2:
        raise ValueError("phrases have two words or more, and there are fewer shards than the support")
    body = F.col(text).cast("binary")
    shard = F.pmod(F.xxhash64(body), F.lit(shards)).alias("shard")
    rows = docs.filter(body.isNotNull()).select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), shard, body.alias("text"))
    union = mined(rows, longest, -(-support // shards), shards)
    counts = stored(counted_globally(rows, longest, union).filter((F.col("n") >= support) | (F.col("width") == 0)), "phrases")
    kept = scored(counts).join(covered(counts, percent), ["lang", "phrase"], "left_anti")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First the best of each of many groups by hash, so that one language is not sorted in one task.
    group = kept.withColumn("group", F.pmod(F.xxhash64("phrase"), F.lit(256)))
    first = group.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "group").orderBy(*order))).filter(F.col("rank") <= top)
    best = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    totals = counts.filter("width = 0").select("lang", F.col("n").alias("words"))
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("words").alias("n"), "score")
