"""Work on keys that hold a large share of the rows.

A window partition or a join key is handled by one task, so a key with a third
of all rows would keep one executor busy while the others wait. The helpers
here find such keys from counts and cut only those keys into pieces; ordinary
keys keep the ordinary plan.

Every table that is broadcast here is bounded by construction: a key is heavy
only if it holds more than ``1 / max_pieces`` of the rows, so there are fewer
than ``max_pieces`` heavy keys and fewer than ``max_pieces`` cut points in all,
whatever the input size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_PIECES = 20_000
MIN_PIECE_ROWS = 2_000_000
SAMPLES_PER_PIECE = 8

_HOT, _CHUNK = "_split_hot", "_split_chunk"


def _attach(df: DataFrame, small: DataFrame, names: Sequence[str], how: str) -> DataFrame:
    """Broadcast join on ``names``, NULL equal to NULL, without duplicate columns."""
    renamed = small.withColumnsRenamed({n: f"_r_{n}" for n in names})
    match = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"_r_{n}")) for n in names])
    return df.join(F.broadcast(renamed), match, how).drop(*[f"_r_{n}" for n in names])


def in_blocks(cuts: Column) -> Column:
    """Sorted, non-empty array of cut points as an array of about sqrt(n) blocks."""
    width = F.ceil(F.sqrt(F.size(cuts))).cast("int")
    starts = F.sequence(F.lit(1), F.size(cuts), width)
    return F.transform(starts, lambda i: F.slice(cuts, i, width))


def cuts_not_above(blocks: Column, value: Column) -> Column:
    """How many cut points are at or below ``value``: two short scans, one over
    the blocks and one inside the block found."""
    full = F.size(F.filter(blocks, lambda b: b[0] <= value))
    inside = F.size(F.filter(F.element_at(blocks, F.greatest(full, F.lit(1))), lambda c: c <= value))
    return F.greatest(full - 1, F.lit(0)) * F.size(blocks[0]) + inside


def row_hash(df: DataFrame, *more: Column) -> Column:
    """Hash of all columns; maps, which Spark does not hash, count as their text."""
    maps = {f.name for f in df.schema.fields if "map<" in f.dataType.simpleString()}
    return F.xxhash64(*[F.to_json(F.struct(F.col(c))) if c in maps else F.col(c) for c in df.columns], *more)


def heavy_keys(
    df: DataFrame,
    keys: Sequence[str],
    min_piece_rows: int = MIN_PIECE_ROWS,
    max_pieces: int = MAX_PIECES,
) -> DataFrame:
    """Keys with more than two pieces' worth of rows, as ``keys + (_rows, _piece)``."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    total = df.select(F.count(F.lit(1)).alias("n")).scalar()
    piece = F.greatest(F.lit(min_piece_rows).cast("long"), F.ceil(total / F.lit(max_pieces)).cast("long"))
    return counts.withColumn("_piece", piece).filter(F.col("_rows") > 2 * F.col("_piece"))


class OrderedSplit:
    """Ordered per-key calculations whose tasks stay small for heavy keys.

    Rows of a heavy key are cut into consecutive pieces of the sort order. Each
    piece is a window partition of its own; what earlier pieces contribute (a
    subtotal, a last row) is computed by one small aggregate over the heavy
    rows and joined back. ``order`` must be a total order within a key, sorted
    ascending with NULLs first.

    ``weigh`` may name a cheaper DataFrame with the same key and order columns
    to count and sample instead of ``df``, such as the input of a
    deduplication. It decides where pieces begin, never what the results are.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        min_piece_rows: int = MIN_PIECE_ROWS,
        max_pieces: int = MAX_PIECES,
        weigh: DataFrame | None = None,
    ):
        self.keys, self.order = list(keys), list(order)
        self.position = F.struct(*[F.col(c) for c in self.order])
        self.window = Window.partitionBy(*self.keys, _HOT, _CHUNK).orderBy(*self.order)
        self._pieces = Window.partitionBy(*self.keys).orderBy(_CHUNK)
        self.df = self._cut(df, df if weigh is None else weigh, min_piece_rows, max_pieces)

    def _cut(self, df: DataFrame, weigh: DataFrame, min_piece_rows: int, max_pieces: int) -> DataFrame:
        narrow = weigh.select(*dict.fromkeys(self.keys + self.order))
        hot = heavy_keys(narrow, self.keys, min_piece_rows, max_pieces)
        # A sample chosen by hash decides only where to cut, never which rows are used.
        sample = (
            _attach(narrow, hot, self.keys, "inner")
            .filter(F.pmod(F.xxhash64(*self.order), "_piece") < SAMPLES_PER_PIECE)
            .groupBy(*self.keys)
            .agg(F.sort_array(F.collect_set(self.position)).alias("_s"))
        )
        every = F.filter("_s", lambda _, i: i % SAMPLES_PER_PIECE == SAMPLES_PER_PIECE - 1)
        cuts = (
            sample.withColumn("_c", every)
            .filter(F.size("_c") > 0)
            .select(*self.keys, in_blocks(F.col("_c")).alias("_blocks"), F.lit(True).alias(_HOT))
        )
        chunk = F.when(F.col(_HOT), cuts_not_above(F.col("_blocks"), self.position))
        return _attach(df, cuts, self.keys, "left").withColumn(_CHUNK, chunk).drop("_blocks")

    def _carry(self, df: DataFrame, per_piece: Mapping[str, Column], over_pieces: Mapping[str, Column]) -> DataFrame:
        """Join values derived from other pieces of the same key; NULL for ordinary keys."""
        totals = df.filter(F.col(_HOT).isNotNull()).groupBy(*self.keys, _CHUNK).agg(
            *[c.alias(n) for n, c in per_piece.items()]
        )
        carried = totals.select(*self.keys, _CHUNK, *[c.alias(n) for n, c in over_pieces.items()])
        return _attach(df, carried, [*self.keys, _CHUNK], "left")

    def running_sum(self, df: DataFrame, sums: Mapping[str, str | Column]) -> DataFrame:
        """Sum from the key's first row to the current one."""
        upto = self.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        before = self._pieces.rowsBetween(Window.unboundedPreceding, -1)
        inputs = {f"_v_{n}": F.col(c) if isinstance(c, str) else c for n, c in sums.items()}
        df = df.withColumns(inputs)
        df = df.withColumns({n: F.sum(f"_v_{n}").over(upto) for n in sums})
        df = self._carry(
            df,
            {f"_p_{n}": F.sum(f"_v_{n}") for n in sums},
            {f"_o_{n}": F.sum(f"_p_{n}").over(before) for n in sums},
        )
        joined = {
            n: F.when(F.col(f"_o_{n}").isNull(), F.col(n)).otherwise(
                F.coalesce(F.col(n), F.lit(0)) + F.col(f"_o_{n}")
            )
            for n in sums
        }
        return df.withColumns(joined).drop(*inputs, *[f"_o_{n}" for n in sums])

    def row_number(self, df: DataFrame, name: str) -> DataFrame:
        return self.running_sum(df, {name: F.lit(1).cast("long")})

    def _neighbour(self, df: DataFrame, columns: Mapping[str, str], forward: bool) -> DataFrame:
        value = F.struct(*[F.col(c).alias(n) for n, c in columns.items()])
        shift, pick = (F.lead, F.min_by) if forward else (F.lag, F.max_by)
        edge = shift(F.lit(1)).over(self.window).isNull()
        df = df.withColumns({"_near": shift(value).over(self.window), "_edge": edge})
        df = self._carry(
            df,
            {"_p": pick(value, self.position)},
            {"_far": shift("_p").over(self._pieces)},
        )
        best = F.when(F.col("_edge") & F.col(_HOT), F.col("_far")).otherwise(F.col("_near"))
        return (
            df.withColumn("_best", best)
            .withColumns({n: F.col(f"_best.{n}") for n in columns})
            .drop("_near", "_edge", "_far", "_best")
        )

    def previous(self, df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
        """Values of the row before, as ``{new column: source column}``."""
        return self._neighbour(df, columns, forward=False)

    def following(self, df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
        """Values of the row after, as ``{new column: source column}``."""
        return self._neighbour(df, columns, forward=True)

    def last_known(self, df: DataFrame, name: str, column: str) -> DataFrame:
        """Latest non-NULL value of ``column`` up to and including the current row."""
        upto = self.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        before = self._pieces.rowsBetween(Window.unboundedPreceding, -1)
        df = df.withColumn("_near", F.last(column, ignorenulls=True).over(upto))
        present = F.when(F.col(column).isNotNull(), self.position)
        df = self._carry(
            df,
            {"_p": F.max_by(F.col(column), present)},
            {"_far": F.last("_p", ignorenulls=True).over(before)},
        )
        return df.withColumn(name, F.coalesce("_near", "_far")).drop("_near", "_far")

    @staticmethod
    def done(df: DataFrame) -> DataFrame:
        return df.drop(_HOT, _CHUNK)


def salted_join(
    big: DataFrame,
    other: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    min_piece_rows: int = MIN_PIECE_ROWS,
    max_pieces: int = MAX_PIECES,
) -> DataFrame:
    """Equi-join that spreads the heavy keys of ``big`` over salts.

    Only rows of ``other`` whose key is heavy are repeated, once per salt, so
    the copies number at most ``max_pieces`` per matching row of a heavy key.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    hot = heavy_keys(big.select(*keys), keys, min_piece_rows, max_pieces).select(
        *keys, F.ceil(F.col("_rows") / F.col("_piece")).cast("int").alias("_salts")
    )
    # The input partition is part of the hash so that exact copies of a row spread too,
    # and a retried task still gives every row the salt it had before.
    digest = row_hash(big, F.spark_partition_id())
    spread = F.coalesce(F.pmod(digest, F.col("_salts")).cast("int"), F.lit(0))
    left = _attach(big, hot, keys, "left").withColumn("_salt", spread).drop("_salts")
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    right = _attach(other, hot, keys, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")
