"""Golden records: match records of one entity across sources, keep one survivor."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.collections import explode_rows
from millrace.session import checkpoint_root

MAX_ROUNDS = 100


def match_entities(records: DataFrame, record_id: str, rules: Mapping[str, Column]) -> DataFrame:
    """``(record_id, entity_id)``: records that share a rule's key are one entity, transitively.

    A rule is a normalized key expression, or an array of several keys; NULL matches nothing. Records are
    linked to key values, never to each other, so a key shared by very many
    records costs one edge per record and no pair is ever formed. The smallest
    id spreads along the edges until nothing changes; each round also jumps to
    the label's own label, which keeps the number of rounds logarithmic.
    """
    kinds = records.select(*[k.alias(n) for n, k in rules.items()]).schema
    several = {n: k if isinstance(kinds[n].dataType, T.ArrayType) else F.array(k) for n, k in rules.items()}
    keyed = [
        F.transform(F.array_compact(F.coalesce(k, F.array())), lambda v, n=n: F.concat(F.lit(f"{n}:"), v.cast("string")))
        for n, k in several.items()
    ]
    edges = explode_rows(records, F.concat(*keyed), "_node", F.col(record_id).alias("_id"))
    return connected_records(records, record_id, edges)


def connected_records(records: DataFrame, record_id: str, edges: DataFrame) -> DataFrame:
    """``(record_id, entity_id)`` of records that edges from ``_id`` (a record) to ``_node`` (any key) connect."""
    checkpoint_root(records.sparkSession)
    edges = edges.distinct()
    shared = edges.groupBy("_node").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_low")).filter("_n > 1")
    # Edges are exploded rows, which Spark believes to be fewer: without the hint it may send them all to the driver.
    edges = edges.join(shared.select("_node", "_low").hint("merge"), "_node").checkpoint()

    labels = edges.groupBy("_id").agg(F.min("_low").alias("_label")).checkpoint()
    links = edges.select("_id", "_node")
    for _ in range(MAX_ROUNDS):
        lowest = links.join(labels, "_id").groupBy("_node").agg(F.min("_label").alias("_m"))
        pulled = links.join(lowest, "_node").groupBy("_id").agg(F.min("_m").alias("_m"))
        lower = labels.join(pulled, "_id").select("_id", "_label", F.least("_label", "_m").alias("_next"))
        root = labels.select(F.col("_id").alias("_next"), F.col("_label").alias("_root"))
        moved = (
            lower.join(root, "_next", "left")
            .select("_id", "_label", F.least("_next", F.coalesce("_root", "_next")).alias("_next"))
            .checkpoint()
        )
        changed = moved.filter("_next <> _label").count()
        labels = moved.select("_id", F.col("_next").alias("_label"))
        if changed == 0:
            break
    else:
        raise RuntimeError(f"entities did not settle in {MAX_ROUNDS} rounds")
    found = labels.select(F.col("_id").alias(record_id), F.col("_label").alias("entity_id"))
    return (
        records.select(record_id)
        .join(found, record_id, "left")
        .withColumn("entity_id", F.coalesce("entity_id", record_id))
    )


def survivorship(
    records: DataFrame, entity: str, preferred: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """One row per entity; every column takes its non-NULL value from the most
    preferred record, highest ``preferred`` columns first."""
    rank = F.struct(*preferred)
    best = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), rank)).alias(c) for c in columns]
    return records.groupBy(entity).agg(F.count(F.lit(1)).alias("n_records"), *best)


def golden_record(
    records: DataFrame,
    record_id: str,
    rules: Mapping[str, Column],
    preferred: Sequence[str],
    columns: Sequence[str],
) -> DataFrame:
    """``records`` should hold only what rules and survivors need: it is computed once and kept
    in the checkpoint folder."""
    checkpoint_root(records.sparkSession)
    keys = {f"_rule_{n}": k for n, k in rules.items()}
    named = dict.fromkeys([record_id, *preferred, *columns])
    kept = records.select(*named, *[k.alias(n) for n, k in keys.items()]).checkpoint()
    matched = kept.join(match_entities(kept, record_id, {n: F.col(n) for n in keys}), record_id)
    return survivorship(matched, "entity_id", preferred, columns)
