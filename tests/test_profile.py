"""Profiles from sketches, samples by key."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from millrace.operators import cleansing
from millrace.sources import profile
from tests.conftest import rows


def values(n=30_000):
    r = random.Random(1)
    return [(i, r.randrange(20_000), r.lognormvariate(2, 1), r.choice(["a", "b", None]), f"v{int(r.paretovariate(1.2))}", f"p{i % 4}") for i in range(n)]


SCHEMA = "id long, k int, x double, t string, w string, p string"


def kept(spark, tmp_path, df):
    for p in ("p0", "p1", "p2", "p3"):
        profile.add_folders(df.filter(F.col("p") == p), str(tmp_path / "store"), ["p"])
    return spark.read.parquet(str(tmp_path / "store"))


def test_merged_sketches_are_within_their_error(spark, tmp_path):
    data = values()
    df = spark.createDataFrame(data, SCHEMA).repartition(7)
    found = {r.column_name: r for r in profile.merged_profile(kept(spark, tmp_path, df), shares=(0.1, 0.5, 0.9)).collect()}
    assert {(c, r.n_rows, r.n_nulls) for c, r in found.items()} == {
        (c, len(data), sum(row[i] is None for row in data)) for i, c in enumerate(["id", "k", "x", "t", "w"])
    }
    for i, c in enumerate(["id", "k", "x", "t", "w"]):
        exact = len({row[i] for row in data if row[i] is not None})
        assert abs(found[c].n_distinct - exact) <= 0.05 * exact
    for i, c in ((0, "id"), (1, "k"), (2, "x")):
        ordered = sorted(row[i] for row in data)
        for share, q in zip((0.1, 0.5, 0.9), found[c].quantiles):
            assert abs(sum(v <= q for v in ordered) / len(ordered) - share) < 0.03
    assert (found["id"].lowest, found["id"].highest, found["t"].lowest, found["t"].highest) == ("0", str(len(data) - 1), "a", "b")
    counts = {v: sum(row[4] == v for row in data) for v in ("v1", "v2", "v3")}
    assert [(f.item, f["count"]) for f in found["w"].frequent] == sorted(counts.items(), key=lambda x: -x[1])


def test_partition_columns_come_from_the_kept_rows(spark, tmp_path):
    sketches = kept(spark, tmp_path, spark.createDataFrame(values(400), SCHEMA))
    assert rows(profile.partition_profile(sketches, ["p"])) == [("p", 4, "p0", "p3", 400)]


def test_folders_and_files(spark, tmp_path):
    spark.createDataFrame(values(40), SCHEMA).coalesce(1).write.partitionBy("p").parquet(str(tmp_path / "t"))
    found = profile.folder_files(spark, str(tmp_path / "t")).first()
    assert (found.n_folders, found.n_files) == (4, 4) and found.n_bytes > 0


def test_profile_of_nothing(spark):
    assert profile.merged_profile(profile.folder_sketches(spark.createDataFrame([], SCHEMA), ["p"])).count() == 0


def test_samples_by_key_nest_and_hold_whole_keys(spark):
    df = spark.createDataFrame([(i // 3, str(i % 3) if i % 7 else None) for i in range(9000)], "k long, t string")
    few, more = (cleansing.sample_by_key(df, ["k"], f) for f in (0.1, 0.3))
    assert 200 < few.select("k").distinct().count() < 400
    assert few.exceptAll(more).isEmpty()
    assert few.groupBy("k").count().filter("count <> 3").isEmpty()
    assert few.repartition(5).exceptAll(few).isEmpty()
