"""Column masking, row filters, personal-data scan and retention."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.collections import explode_rows
from millrace.functions.columns import EMAIL_PATTERN
from millrace.operators.joins import rows_with_match, rows_without_match

# What the scan looks for.
PII_PATTERNS = {
    "email": EMAIL_PATTERN,
    "phone": r"\b[0-9]{3}[-. ][0-9]{3}[-. ][0-9]{4}\b",
    "ipv4": r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b",
}

# A literal without which a slow pattern cannot match.
MUST_CONTAIN = {"email": "@"}


def mask_columns(
    df: DataFrame, masks: Mapping[str, Column], groups: Collection[str], allowed: Mapping[str, str]
) -> DataFrame:
    """Show each column of ``masks`` in clear only to members of its ``allowed`` group."""
    hidden = {c: mask for c, mask in masks.items() if allowed.get(c) not in groups}
    return df.withColumns(hidden)


def row_filter(df: DataFrame, policy: DataFrame, column: str, role: str) -> DataFrame:
    """Rows whose ``column`` value the policy table grants to ``role``."""
    return rows_with_match(df, policy.filter(F.col("role") == role), [column])


def _has(column: str, name: str, pattern: str) -> Column:
    found = F.col(column).rlike(pattern)
    return F.contains(F.col(column), F.lit(MUST_CONTAIN[name])) & found if name in MUST_CONTAIN else found


def pii_scan(df: DataFrame, columns: Sequence[str], patterns: Mapping[str, str] = PII_PATTERNS) -> DataFrame:
    """Rows with a hit per column and pattern, in one pass."""
    names = [(c, p) for c in columns for p in patterns]
    hits = [F.count_if(_has(c, p, patterns[p])) for c, p in names]
    labels = [F.struct(F.lit(c).alias("column_name"), F.lit(p).alias("pattern")) for c, p in names]
    counted = df.agg(F.arrays_zip(F.array(*labels).alias("label"), F.array(*hits).alias("hits")).alias("_r"))
    return counted.select(F.explode("_r").alias("r")).select("r.label.*", "r.hits")


# What numbers with check digits look like.
CHECKED_PATTERNS = {"card": r"\b[0-9](?:[ -]?[0-9]){12,18}\b", "iban": r"\b[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}\b"}


def card_is_valid(number: Column) -> Column:
    """Luhn's rule: from the right, every second digit is doubled, and all digits add up to a multiple of ten."""
    digits = F.filter(F.split(F.reverse(F.regexp_replace(number, "[^0-9]", "")), ""), lambda d: d != "")
    weighed = F.transform(digits, lambda d, i: d.cast("int") * (1 + i % 2))
    return F.aggregate(weighed, F.lit(0), lambda s, d: s + d - F.when(d > 9, 9).otherwise(0)) % 10 == 0


def iban_is_valid(number: Column) -> Column:
    """The first four characters go to the end, letters count from ten, and the whole number is one modulo 97."""
    turned = F.concat(F.substring(number, F.lit(5), F.length(number)), F.substring(number, 1, 4))
    letters = F.filter(F.split(turned, ""), lambda c: c != "")

    def step(rest: Column, c: Column) -> Column:
        is_digit = c.between("0", "9")
        value = F.when(is_digit, F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return (rest * F.when(is_digit, 10).otherwise(100) + value) % 97

    return F.aggregate(letters, F.lit(0), step) == 1


CHECKS = {"card": card_is_valid, "iban": iban_is_valid}


def verified_scan(df: DataFrame, columns: Sequence[str], min_share: float = 0.5, min_distinct: int = 10) -> DataFrame:
    """Candidates for numbers with check digits in each column, how many are valid, and what the column is taken for.

    One in ten numbers fits Luhn's rule by chance and one in 97 the other, so a column is named after a kind only if at
    least ``min_share`` of its candidates are valid and ``min_distinct`` different ones are. A kind without
    candidates has no row.
    """

    def candidates(c: str, k: str) -> Column:
        numbers = F.coalesce(F.regexp_extract_all(F.col(c), F.lit(CHECKED_PATTERNS[k]), F.lit(0)), F.array())
        named = lambda v: F.struct(F.lit(c).alias("column_name"), F.lit(k).alias("kind"), v.alias("value"), CHECKS[k](v).alias("valid"))
        return F.transform(numbers, named)

    found = [candidates(c, k) for c in columns for k in CHECKED_PATTERNS]
    hits = explode_rows(df, F.concat(*found), "h").select("h.*")
    counts = hits.groupBy("column_name", "kind", "value", "valid").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("column_name", "kind").agg(
        F.sum("n").alias("n_candidates"),
        F.coalesce(F.sum(F.when(F.col("valid"), F.col("n"))), F.lit(0)).alias("n_valid"),
        F.count_if("valid").alias("n_distinct"),
    )
    sure = (F.col("n_valid") >= min_share * F.col("n_candidates")) & (F.col("n_distinct") >= min_distinct)
    return totals.withColumn("verdict", F.when(sure, F.col("kind")).otherwise("none"))


def retention_purge(df: DataFrame, date_column: str, keep_from: str) -> DataFrame:
    """Rows inside the retention period; the bare column lets partitions be skipped."""
    kind = df.schema[date_column].dataType
    return df.filter(F.col(date_column) >= F.lit(keep_from).cast(kind))


def erase_subjects(df: DataFrame, requests: DataFrame, key: str) -> DataFrame:
    """Rows of everyone who did not ask to be erased."""
    return rows_without_match(df, requests, [key])


def log_search(
    df: DataFrame, actor: str, who: object, ts: str, start: str, end: str, failed: Column
) -> DataFrame:
    """Failed events of one actor per day in ``[start, end)``."""
    kind = df.schema[ts].dataType
    hit = (F.col(actor) == F.lit(who)) & failed
    inside = (F.col(ts) >= F.lit(start).cast(kind)) & (F.col(ts) < F.lit(end).cast(kind))
    return df.filter(hit & inside).groupBy(F.col(ts).cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
