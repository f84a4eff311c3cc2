"""Change logs: rows with a key, a sequence and an operation letter I, U or D."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.cleansing import dedup_latest
from millrace.operators.skew import MAX_PIECES, MIN_PIECE_ROWS, OrderedSplit


def apply_cdc_log(log: DataFrame, keys: Sequence[str], seq: Sequence[str], op: str = "_op") -> DataFrame:
    """Current state: the last change per key, unless that is a delete."""
    last = dedup_latest(log, keys, [F.desc(s) for s in seq])
    return last.filter(F.col(op) != "D").drop(op)


def state_as_of(log: DataFrame, keys: Sequence[str], seq: Sequence[str], at: object, op: str = "_op") -> DataFrame:
    """State after all changes up to and including ``at`` in the first sequence column."""
    kind = log.schema[seq[0]].dataType
    return apply_cdc_log(log.filter(F.col(seq[0]) <= F.lit(at).cast(kind)), keys, seq, op)


def cdc_to_scd2(
    log: DataFrame,
    key: str,
    at: str,
    unique: str,
    columns: Sequence[str],
    op: str = "_op",
    min_piece_rows: int = MIN_PIECE_ROWS,
    max_pieces: int = MAX_PIECES,
) -> DataFrame:
    """Full history: each change is valid until the next one; a delete only closes."""
    split = OrderedSplit(log.select(key, at, unique, op, *columns), [key], [at, unique], min_piece_rows, max_pieces)
    rows = split.done(split.following(split.df, {"expires_at": at, "_next": unique}))
    return (
        rows.filter(F.col(op) != "D")
        .withColumn("is_current", F.col("_next").isNull())
        .withColumnRenamed(at, "effective_at")
        .drop(op, "_next")
    )


LEAVES, FAN_OUT = 1 << 16, 256


def _leaf(keys: Sequence[str], leaves: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(leaves))


def bucket_digests(df: DataFrame, keys: Sequence[str], leaves: int = LEAVES) -> DataFrame:
    """``leaf, n, first, second``: rows of a version by a hash of their key, and the sums of two 64-bit hashes of each row.
    Sums do not depend on order, so equal rows give equal digests however they are stored; keep them with a version and
    it need not be read again."""
    # A hash skips NULLs, so which columns are NULL is hashed too.
    row = [F.array(*[F.col(c).isNull() for c in df.columns]), *[F.col(c) for c in df.columns]]
    sums = [F.sum(F.xxhash64(F.lit(seed), *row).cast("decimal(38,0)")).alias(name) for seed, name in ((1, "first"), (2, "second"))]
    return df.groupBy(_leaf(keys, leaves).alias("leaf")).agg(F.count(F.lit(1)).alias("n"), *sums)


def differing_leaves(old: DataFrame, new: DataFrame, fan_out: int = FAN_OUT) -> DataFrame:
    """``leaf`` of the buckets whose digests differ, found from the top: first the sums of ``fan_out`` buckets each are
    compared, then the buckets below those that differ."""

    def unlike(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
        kept = [F.struct("n", "first", "second").alias("d")]
        both = a.select(key, *kept).join(b.select(key, F.struct("n", "first", "second").alias("e")), key, "full")
        return both.filter(~F.col("d").eqNullSafe(F.col("e"))).select(key)

    def above(leaves: DataFrame) -> DataFrame:
        node = F.floor(F.col("leaf") / fan_out).alias("node")
        return leaves.groupBy(node).agg(*[F.sum(c).alias(c) for c in ("n", "first", "second")])

    nodes = unlike(above(old), above(new), "node")
    below = lambda d: d.withColumn("node", F.floor(F.col("leaf") / fan_out)).join(nodes, "node", "left_semi")
    return unlike(below(old), below(new), "leaf")


def rows_in_leaves(df: DataFrame, keys: Sequence[str], unlike: DataFrame, leaves: int = LEAVES) -> DataFrame:
    """Rows in the buckets of ``unlike``, which has at most ``leaves`` rows and is broadcast for that reason."""
    return df.join(F.broadcast(unlike.select(F.col("leaf").alias("_leaf"))), _leaf(keys, leaves) == F.col("_leaf"), "left_semi")


def table_diff(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    old_digests: DataFrame | None = None,
    new_digests: DataFrame | None = None,
    leaves: int = LEAVES,
) -> DataFrame:
    """Change feed between two versions, as ``_op`` and ``is_update`` on the rows that differ.

    Inserted and updated rows carry the new values, deleted rows the old ones. Digests of buckets of both versions are
    compared first, so only buckets with a change are shuffled and joined; pass digests that were kept to save a
    read of a version. Keys are unique in each version, so no key can be heavy.
    """
    others = [c for c in new.columns if c not in keys]
    old, new = old.select(*keys, *others), new.select(*keys, *others)
    digests = [d if d is not None else bucket_digests(v, keys, leaves) for v, d in ((old, old_digests), (new, new_digests))]
    unlike = differing_leaves(*digests)
    a = rows_in_leaves(old, keys, unlike, leaves).select(*keys, F.struct(*others).alias("_a"))
    b = rows_in_leaves(new, keys, unlike, leaves).select(*keys, F.struct(*others).alias("_b"))
    pairs = a.join(b, list(keys), "full").filter(~F.col("_a").eqNullSafe(F.col("_b")))
    op = F.when(F.col("_a").isNull(), "I").when(F.col("_b").isNull(), "D").otherwise("U")
    row = F.coalesce("_b", "_a")
    return pairs.select(
        *keys, *[row[c].alias(c) for c in others], op.alias("_op"), (op == "U").alias("is_update")
    )


def history_report(log: DataFrame, version: str, op: str = "_op") -> DataFrame:
    """Rows written per version and operation."""
    return log.groupBy(version, op).agg(F.count(F.lit(1)).alias("n_rows"))
