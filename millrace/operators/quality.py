"""Data-quality checks. A check is a row ``(check_name, failures, passed)``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.joins import rows_without_match


class QualityError(RuntimeError):
    """A check that must hold did not."""


def _check(counted: DataFrame, name: str) -> DataFrame:
    failures = F.coalesce(F.col("failures"), F.lit(0)).cast("long")
    return counted.select(F.lit(name).alias("check_name"), failures.alias("failures"), (failures == 0).alias("passed"))


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("failures"))


def row_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Violations of any number of row conditions in one scan; NULL is a violation."""
    broken = {n: F.count_if(~F.coalesce(ok, F.lit(False))) for n, ok in rules.items()}
    counts = df.agg(F.map_from_arrays(F.array(*[F.lit(n) for n in broken]), F.array(*broken.values())).alias("_m"))
    rows = counts.select(F.explode("_m").alias("check_name", "failures"))
    return rows.withColumn("passed", F.col("failures") == 0)


def dq_unique(df: DataFrame, keys: Sequence[str], name: str = "unique") -> DataFrame:
    return _check(_count(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")), name)


def dq_not_null(df: DataFrame, columns: Sequence[str], name: str = "not_null") -> DataFrame:
    return row_rules(df, {name: reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])})


def dq_positive(df: DataFrame, column: str, name: str = "positive") -> DataFrame:
    return row_rules(df, {name: F.col(column) > 0})


def dq_range(df: DataFrame, column: str, low: float, high: float, name: str = "range") -> DataFrame:
    return row_rules(df, {name: F.col(column).between(low, high)})


def dq_accepted_values(df: DataFrame, column: str, values: Sequence[object], name: str = "accepted") -> DataFrame:
    return row_rules(df, {name: F.col(column).isin(*values)})


def dq_relationship(
    df: DataFrame, column: str, parent: DataFrame, parent_column: str, name: str = "relationship"
) -> DataFrame:
    """Rows whose key is not in ``parent``. Keys are counted first, so the join sees each key once."""
    per_key = df.groupBy(F.col(column).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    orphans = per_key.join(parent.select(F.col(parent_column).alias("_k")), "_k", "left_anti")
    return _check(orphans.agg(F.sum("_n").alias("failures")), name)


def dq_status_only(facts: DataFrame, staged: DataFrame, key: str, keep: Column, name: str = "status") -> DataFrame:
    """Facts whose staged row does not satisfy ``keep``."""
    return _check(_count(rows_without_match(facts, staged.filter(keep), [key])), name)


def dq_reconcile(left: DataFrame, right: DataFrame, column: str, name: str = "reconcile") -> DataFrame:
    """Totals of two tables agree to the cent."""
    total = F.coalesce(F.sum(F.col(column).cast("decimal(18,2)")), F.lit(0))
    sums = left.agg(total.alias("_l")).withColumn("_r", right.select(total).scalar())
    return _check(sums.select((F.col("_l") != F.col("_r")).cast("long").alias("failures")), name)


def dq_freshness(df: DataFrame, ts: str, as_of: str, max_hours: int, name: str = "freshness") -> DataFrame:
    """Fails if the newest row is older than ``max_hours`` at ``as_of``, or there is none."""
    newest = df.agg(F.max(ts).cast("timestamp_ntz").alias("_m"))
    oldest_ok = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(hours=F.lit(max_hours))
    stale = F.coalesce(F.col("_m") < oldest_ok, F.lit(True))
    return _check(newest.select(stale.cast("long").alias("failures")), name)


def dq_singular(violations: DataFrame, name: str) -> DataFrame:
    """A query that must return no rows."""
    return _check(_count(violations), name)


def dq_suite(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def enforce(report: DataFrame) -> DataFrame:
    """Run the suite once and stop on failure. The report has one row per check."""
    rows = report.collect()
    failed = [f"{r.check_name}: {r.failures}" for r in rows if not r.passed]
    if failed:
        raise QualityError("; ".join(sorted(failed)))
    return report.sparkSession.createDataFrame(rows, report.schema)


def _holds(rules: Mapping[str, Column]) -> Column:
    return reduce(lambda a, b: a & b, [F.coalesce(ok, F.lit(False)) for ok in rules.values()])


def expect(df: DataFrame, rules: Mapping[str, Column], name: str = "expectations") -> tuple[DataFrame, Observation]:
    """Keep every row and count violations while the data passes by."""
    seen = Observation(name)
    counts = [F.count_if(~F.coalesce(ok, F.lit(False))).alias(n) for n, ok in rules.items()]
    return df.observe(seen, *counts), seen


def expect_or_drop(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    return df.filter(_holds(rules))


def expect_or_fail(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """The job fails on the first row that breaks a rule."""
    asserts = [F.assert_true(F.coalesce(ok, F.lit(False)), F.lit(f"expectation failed: {n}")) for n, ok in rules.items()]
    return df.filter(reduce(lambda a, b: a & b, [a.isNull() for a in asserts]))


def schema_contract(df: DataFrame, expected: T.StructType) -> DataFrame:
    """One row per column: ``ok``, ``missing``, ``extra`` or ``type``."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}

    def verdict(name: str) -> str:
        if name not in actual:
            return "missing"
        if name not in wanted:
            return "extra"
        return "ok" if actual[name] == wanted[name] else "type"

    names = list(dict.fromkeys([*wanted, *actual]))
    rows = [(n, wanted.get(n), actual.get(n), verdict(n)) for n in names]
    return df.sparkSession.createDataFrame(rows, "column_name string, expected string, actual string, verdict string")


def conform(df: DataFrame, expected: T.StructType, evolve: bool = False) -> DataFrame:
    """Enforce the contract, or with ``evolve`` add missing columns as NULL and keep extra ones."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    wrong = [f.name for f in expected.fields if f.name in actual and actual[f.name] != f.dataType]
    missing = [f.name for f in expected.fields if f.name not in actual]
    extra = [c for c in actual if c not in expected.names]
    if wrong or (not evolve and (missing or extra)):
        raise QualityError(f"schema differs: type {wrong}, missing {missing}, extra {extra}")
    filled = [
        F.col(f.name) if f.name in actual else F.lit(None).cast(f.dataType).alias(f.name) for f in expected.fields
    ]
    return df.select(*filled, *extra)
