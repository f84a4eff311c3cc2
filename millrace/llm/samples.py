"""Bounded samples of labelled rows to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sampled(rows: DataFrame, key: str, label: str, per_label: int) -> Column:
    """Condition that keeps about ``per_label`` rows of each label, or all if there are
    fewer: those whose key has a small hash. Labels are counted first, so the driver
    gets one row for each label. Rows without a key or label are left out."""
    known = rows.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
    place = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 40))
    keep = F.lit(False)
    for value, n in sorted(known.groupBy(label).count().collect()):
        upto = (per_label << 40) // max(n, per_label)
        keep = keep | ((F.col(label) == F.lit(value)) & (place < upto))
    return F.coalesce(keep & F.col(key).isNotNull(), F.lit(False))
