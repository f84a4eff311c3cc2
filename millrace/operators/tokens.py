"""Tokens that stand for personal values: a keyed permutation of digits, and a table of tokens for texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import checkpoint_root

#: An even number, so that both halves have their length again at the end.
ROUNDS = 8
MOST_DIGITS = 36
MAX_ATTEMPTS = 30


def _digest(key: str, *parts: Column) -> Column:
    """A number below 2**60 from a keyed digest."""
    text = F.concat_ws(":", F.lit(key), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it and in whatever loop."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _permuted(digits: Column, key: str, back: bool) -> Column:
    """A Feistel network over the two halves of a string of digits; each round adds a digest of one half to the other, modulo a
    power of ten, so it can be undone and never leaves the digits."""
    n = F.length(digits)
    low = F.floor(n / 2).cast("int")
    power = lambda m: F.pow(F.lit(10), m).cast("long")

    def step(s: Column, i: Column) -> Column:
        width = F.when(i % 2 == 0, low).otherwise(n - low)
        old, other = (s.b, s.a) if back else (s.a, s.b)
        mixed = _digest(key, i, n, other) * (-1 if back else 1)
        new = F.lpad(F.pmod(old.cast("long") + mixed, power(width)).cast("string"), width, "0")
        return F.struct((new if back else other).alias("a"), (other if back else new).alias("b"))

    start = F.struct(F.substring(digits, F.lit(1), low).alias("a"), F.substring(digits, low + 1, n - low).alias("b"))
    order = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if back else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    single = F.pmod(digits.cast("long") + _digest(key, n) * (-1 if back else 1), F.lit(10)).cast("string")
    made = F.aggregate(order, start, step, lambda s: F.concat(s.a, s.b))
    return F.when(n == 0, digits).when(n == 1, single).when(n <= MOST_DIGITS, made)


def digit_token(value: Column, key: str, back: bool = False) -> Column:
    """The text with its digits permuted under ``key``; all other characters stay where they are. Different values of one
    format have different tokens; ``back`` turns a token into its value. NULL for more than ``MOST_DIGITS`` digits."""

    def put_back(text: Column, new: Column) -> Column:
        """The new digits in the places of the old ones."""
        start = F.struct(F.lit("").alias("text"), F.lit(1).alias("next"))

        def put(s: Column, c: Column) -> Column:
            is_digit = c.between("0", "9")
            text = F.concat(s.text, F.when(is_digit, F.substring(new, s.next, F.lit(1))).otherwise(c))
            return F.struct(text.alias("text"), (s.next + is_digit.cast("int")).alias("next"))

        letters = F.filter(F.split(text, ""), lambda c: c != "")
        return F.aggregate(letters, start, put, lambda s: s.text)

    def changed(text: Column, digits: Column) -> Column:
        plain = F.length(digits) == F.length(text)
        return _once(_permuted(digits, key, back), lambda new: F.when(plain, new).otherwise(put_back(text, new)))

    return _once(value, lambda text: _once(F.regexp_replace(text, "[^0-9]", ""), lambda digits: changed(text, digits)))


def add_tokens(known: DataFrame | None, values: DataFrame, key: str, length: int = 12) -> DataFrame:
    """``value, token`` with a token for each different ``value`` that has none yet. Known tokens stay as they are.

    A token is the beginning of a keyed digest. Where it is taken, by a known value or by the smaller of two new ones, the
    digest of the next attempt is tried; only those values go into another round. NULL has no token.
    """
    spark = values.sparkSession
    checkpoint_root(spark)
    done = known.select("value", "token") if known is not None else spark.createDataFrame([], "value string, token string")
    left = values.select("value").filter(F.col("value").isNotNull()).distinct().join(done, "value", "left_anti").checkpoint()
    for attempt in range(MAX_ATTEMPTS):
        token = F.substring(F.sha2(F.concat_ws(":", F.lit(key), F.lit(attempt).cast("string"), "value"), 256), 1, length)
        tried = left.withColumn("token", token)
        first = tried.groupBy("token").agg(F.min("value").alias("value")).join(done.select("token"), "token", "left_anti")
        done = done.unionByName(first.select("value", "token")).checkpoint()
        left = left.join(done, "value", "left_anti").checkpoint()
        if left.isEmpty():
            return done
    raise RuntimeError(f"tokens of {length} digits are used up")
