"""A filter of hashes with a fixed number of bits: it never misses a member, and may pass others."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 2**27 bits are 16 MB, whatever is put in; a fuller filter passes more, which costs time and never a row.
FILTER_BITS = 27


def _probes(bits: int):
    h = F.col("h")
    mask = F.lit((1 << bits) - 1)
    return h.bitwiseAND(mask), F.shiftrightunsigned(h, 32).bitwiseAND(mask)


def hash_filters(hashes: DataFrame, parts: int = 1, bits: int = FILTER_BITS) -> np.ndarray:
    """A filter of the column ``h`` (long) for each ``part`` (0 to ``parts`` - 1). Bits are joined word by word in
    Spark; at most ``parts * 2 ** bits / 64`` words reach the driver."""
    if not 7 <= bits <= 32:
        raise ValueError("a filter has 2**7 to 2**32 bits")
    places = hashes.select("part", F.explode(F.array(*_probes(bits))).alias("p"))
    one = F.expr("shiftleft(1L, cast(p & 63 AS int))")
    words = places.groupBy("part", F.shiftright("p", 6).alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()
    out = np.zeros((parts, 1 << (bits - 6)), np.uint64)
    out[words["part"].to_numpy(), words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


def passes(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes (uint64) may be members."""
    mask = np.uint64(len(words) * 64 - 1)

    def held(p: np.ndarray) -> np.ndarray:
        return ((words[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1)).astype(bool)

    found = held(hashes & mask)
    at = np.flatnonzero(found)
    found[at] = held((hashes[at] >> np.uint64(32)) & mask)
    return found
