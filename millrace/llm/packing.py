"""Packing of token sequences as a cutting-stock problem.

A document's ids are cut into full sequences and one shorter rest. Rests are
packed by column generation: a linear program over patterns (how many rests of
each length class share a sequence) is solved on the histogram of classes, and
a knapsack by dynamic programming prices new patterns until none improves it.
The histogram has at most ``capacity`` entries whatever the input size, so the
program runs on the driver; documents never leave the executors. Rounded
patterns are handed out to documents by their rank within a class.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import on_workers, stored

PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
#: Rests are put into classes of this many lengths; more classes waste less and take the solver longer.
UNIT = 8
#: A linear program this close to its lower bound is good enough.
GAP = 5e-4
#: Steps of the method at most; patterns found by then are good, if not the best.
STEPS_PER_CLASS = 30
RANK_ROWS = 500_000
#: Letters on which every Unicode version agrees.
PLAIN = re.compile(r"[\x00-\x7fÀ-ÖØ-öø-ÿ]*")
#: Fixed value: the word pattern of the byte-level tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteEncoder:
    """Ids of a byte-level tokenizer as little-endian 32-bit numbers.

    With ``ranks``, the file of the same vocabulary for the faster of the two
    libraries, plain texts take that; texts with letters outside ``PLAIN`` or
    with the beginning of a special token always go to the tokenizer itself.
    """

    def __init__(self, path: str, ranks: str | None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.fast = None
        if ranks is not None:
            import tiktoken

            with open(ranks, "rb") as f:
                known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=known, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if self.fast is None or "<|" in text or not PLAIN.fullmatch(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        return self.fast.encode_to_numpy(text).astype("<u4", copy=False)


_encoders: dict[tuple[str, str | None], ByteEncoder] = {}


def _pieces(path: str, ranks: str | None, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if (path, ranks) not in _encoders:
            _encoders[path, ranks] = ByteEncoder(path, ranks)
        encoder, end = _encoders[path, ranks], np.array([end_id], "<u4")
        for b in batches:
            rows = []
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.concatenate([encoder.encode(text), end]).tobytes()
                n = len(ids) // 4
                rows += [
                    (key, s, min(capacity, n - s), zlib.crc32(ids[4 * s : 4 * (s + capacity)]), n)
                    for s in range(0, n, capacity)
                ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [()] * 5)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    return run


def best_pattern(size: np.ndarray, value: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Most valuable multiset of classes that fits (sizes ascending): the knapsack problem."""
    best = np.zeros(capacity + 1)
    took = np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        k = np.searchsorted(size, c, "right")
        if k:
            got = best[c - size[:k]] + value[:k]
            i = int(got.argmax())
            if got[i] > best[c] + 1e-12:
                best[c], took[c] = got[i], i
    pattern, c = np.zeros(len(size)), capacity
    while c > 0:
        if took[c] < 0:
            c -= 1
        else:
            pattern[took[c]] += 1
            c -= size[took[c]]
    return float(best[capacity]), pattern


def inverted(m: np.ndarray) -> np.ndarray:
    """Inverse by Gauss-Jordan elimination. Matrices are small here, and a threaded library
    routine spends its time waiting when the machine is busy."""
    n = len(m)
    both = np.hstack([m, np.eye(n)])
    for i in range(n):
        k = i + int(np.abs(both[i:, i]).argmax())
        both[[i, k]] = both[[k, i]]
        both[i] /= both[i, i]
        rest = both[:, i].copy()
        rest[i] = 0
        both -= np.outer(rest, both[i])
    return both[:, n:]


def cutting_stock(demand: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns ``{size: how many}`` and their numbers of uses that hold exactly ``demand``."""
    size = np.array(sorted(s for s, n in demand.items() if n > 0))
    if not len(size):
        return []
    want = np.array([demand[s] for s in size], float)
    first = capacity // size
    basis, inverse = np.diag(first.astype(float)), np.diag(1.0 / first)
    # Slightly different demands leave no ties, so that the method can't run in circles.
    apart = want * (1 + 1e-7 * np.arange(1, len(size) + 1))
    use = apart / first
    for step in range(1, STEPS_PER_CLASS * len(size)):
        if step % 500 == 0:  # rounding errors of the updates add up
            inverse = inverted(basis)
            use = np.maximum((inverse * apart).sum(1), 0)
        value, pattern = best_pattern(size, inverse.sum(0), capacity)
        if value <= 1 + GAP:
            break
        rate = (inverse * pattern).sum(1)
        ratio = np.where(rate > 1e-9, use / np.where(rate > 1e-9, rate, 1), np.inf)
        leave = int(ratio.argmin())
        use = np.maximum(use - ratio[leave] * rate, 0)
        use[leave] = ratio[leave]
        basis[:, leave] = pattern
        row = inverse[leave] / rate[leave]
        inverse -= np.outer(rate, row)
        inverse[leave] = row
    left = want.astype(int)
    found = []
    for j in np.argsort(-use, kind="stable"):
        column = basis[:, j].astype(int)
        held = column > 0
        times = int(min(use[j] + 1e-6, (left[held] // column[held]).min()))
        if times:
            found.append((column, times))
            left = left - times * column
    while left.any():  # what rounding leaves: longest first, as many as fit
        room, column = capacity, np.zeros(len(size), int)
        for i in range(len(size) - 1, -1, -1):
            n = min(int(left[i]), room // int(size[i]))
            column[i] += n
            room -= n * int(size[i])
        held = column > 0
        times = int((left[held] // column[held]).min())
        found.append((column, times))
        left = left - times * column
    return [({int(s): int(a) for s, a in zip(size, c) if a}, t) for c, t in found]


def _ranked(pieces: DataFrame, counts: dict[int, int]) -> DataFrame:
    """Number the pieces of each class from 0, without one task for a whole class.

    A class of many rows is dealt over parts by hash; rows are numbered within a
    part, and each part begins where the parts before it end.
    """
    parts = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, -(-n // RANK_ROWS))])
    # The input partition is part of the hash, so rows with equal keys spread too.
    row = F.xxhash64("doc_id", "start", F.spark_partition_id())
    dealt = pieces.withColumn("_part", F.pmod(row, parts[F.col("_class")]))
    within = Window.partitionBy("_class", "_part").orderBy("doc_id", "start", "ids_crc32")
    before = Window.partitionBy("_class").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    begins = (
        dealt.groupBy("_class", "_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_class", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_begin"))
    )
    numbered = dealt.withColumn("_at", F.row_number().over(within) - 1)
    return numbered.join(begins, ["_class", "_part"]).withColumn("_rank", F.col("_begin") + F.col("_at"))


def pack(
    docs: DataFrame,
    path: str,
    ranks: str | None = None,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = 1024,
    end_id: int = 0,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A NULL or empty text is the end id alone. Repeated rows are packed as often
    as they occur; a NULL key is kept. Other columns are ignored. An empty table
    gives an empty result. A sequence that ends up at a power of two needs no
    padding; every other one is padded to ``capacity``.
    """
    spark = on_workers(docs)
    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("body"))
    pieces = stored(narrow.mapInArrow(_pieces(path, ranks, capacity, end_id), PIECE_SCHEMA), "pieces")
    # Class 0 holds the full sequences.
    kind = F.when(F.col("length") == capacity, 0).otherwise(F.ceil(F.col("length") / UNIT)).cast("int")
    classed = pieces.withColumn("_class", kind)
    counts = {r[0]: r[1] for r in classed.groupBy("_class").count().collect()}
    patterns = cutting_stock({k: n for k, n in counts.items() if k}, capacity // UNIT)
    slots, taken, first = [], {}, 0
    for pattern, times in patterns:
        for k, a in pattern.items():
            low = taken.get(k, 0)
            slots.append((k, low, low + a * times, a, first))
            taken[k] = low + a * times
        first += times
    if 0 in counts:
        slots.append((0, 0, counts[0], 1, first))
    if not slots:
        return pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    # At most capacity / UNIT patterns and those of the remainder, each with few classes.
    rules = spark.createDataFrame(slots, "_class int, _low long, _high long, _each long, _first long")
    placed = _ranked(classed, counts).join(F.broadcast(rules), "_class")
    placed = placed.filter((F.col("_rank") >= F.col("_low")) & (F.col("_rank") < F.col("_high")))
    placed = placed.withColumn(
        "sequence_id", (F.col("_first") + F.floor((F.col("_rank") - F.col("_low")) / F.col("_each"))).cast("long")
    )
    within = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "_class", "_rank")
    upto = F.sum("length").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return placed.withColumn("offset", upto - F.col("length")).select(*pieces.columns, "sequence_id", "offset")
