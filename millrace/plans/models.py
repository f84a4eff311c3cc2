"""Named transformations with declared inputs, built in dependency order."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.incremental import incremental_model
from millrace.operators.quality import enforce

Build = Callable[..., DataFrame]
Test = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Model:
    """``build`` gets its inputs as keyword arguments; ``tests`` return check rows.

    ``materialized`` is ``view`` (stays a plan), ``table`` (written to Parquet and
    read back, so that several consumers do not compute it again) or ``incremental``:
    a table whose first run builds it and whose later runs merge the rows not older
    than it by ``newer``, the latest row of each of ``keys`` winning.
    """

    name: str
    build: Build
    inputs: tuple[str, ...] = ()
    materialized: str = "view"
    keys: tuple[str, ...] = ()
    newer: str | None = None
    tests: tuple[Test, ...] = field(default=())


def build_order(models: Mapping[str, Model]) -> list[str]:
    graph = {m.name: [i for i in m.inputs if i in models] for m in models.values()}
    return list(TopologicalSorter(graph).static_order())


def run_models(
    sources: Mapping[str, DataFrame],
    models: list[Model],
    spark: SparkSession,
    root: str,
    previous: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """All models by name. A failed test stops the run before any consumer is built.

    ``root`` is a folder of this run; ``previous`` holds the models of the run before,
    which incremental models go on from.
    """
    by_name = {m.name: m for m in models}
    done = dict(sources)
    for name in build_order(by_name):
        model = by_name[name]
        df = model.build(**{i: done[i] for i in model.inputs})
        if model.materialized == "incremental":
            if not model.keys or model.newer is None:
                raise ValueError(f"incremental model {name!r} needs keys and newer")
            rest = [F.desc(c) for c in df.columns if c != model.newer]
            df = incremental_model((previous or {}).get(name), df, model.keys, model.newer, [F.desc(model.newer), *rest])
        if model.materialized in ("table", "incremental"):
            df.write.mode("errorifexists").parquet(f"{root}/{name}")
            df = spark.read.parquet(f"{root}/{name}")
        elif model.materialized != "view":
            raise ValueError(f"unknown materialization {model.materialized!r}")
        for test in model.tests:
            enforce(test(df))
        done[name] = df
    return {name: done[name] for name in by_name}


def lineage_report(spark: SparkSession, models: list[Model]) -> DataFrame:
    edges = [(i, m.name) for m in models for i in m.inputs]
    return spark.createDataFrame(edges, "upstream string, downstream string")
