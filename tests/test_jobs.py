"""Entities, layout, security, functions, models, session."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.functions import collections as L
from millrace.functions import columns as C
from millrace.functions import udfs
from millrace.operators import entities, joins, layout, quality, security, windows
from millrace.plans import q_quality
from millrace.plans.models import Model, build_order, lineage_report, run_models
from millrace.session import checkpoint_root, scratch_path
from tests.conftest import rows, same_rows


def brute_force_entities(records, keys):
    label = {r[0]: r[0] for r in records}
    moved = True
    while moved:
        moved = False
        for a in records:
            for b in records:
                if any(a[i] is not None and a[i] == b[i] for i in keys) and label[b[0]] < label[a[0]]:
                    label[a[0]], moved = label[b[0]], True
    return sorted(label.items())


def test_entities_against_brute_force(spark):
    data = [(i, f"p{i // 2}" if i % 5 else None, f"m{(i + 1) // 2}" if i % 7 else None) for i in range(60)]
    data += [(100 + i, "shared", None) for i in range(40)]
    df = spark.createDataFrame(data, "id bigint, phone string, mail string")
    found = entities.match_entities(df, "id", {"phone": F.col("phone"), "mail": F.col("mail")})
    assert rows(found, "id", "entity_id") == sorted(brute_force_entities(data, (1, 2)), key=lambda t: (str(t[0]), str(t[1])))


def test_long_chain_converges(spark):
    """Record i shares one key with i - 1 and another with i + 1."""
    df = spark.range(300).selectExpr("id", "CAST(id DIV 2 AS string) AS a", "CAST((id + 1) DIV 2 AS string) AS b")
    found = entities.match_entities(df, "id", {"a": F.col("a"), "b": F.col("b")})
    assert found.filter("entity_id <> 0").isEmpty()


def test_survivorship_takes_best_known_value(spark):
    df = spark.createDataFrame(
        [(1, 1, "old", "x@y.z"), (1, 2, None, None), (1, 3, "new", None)], "entity_id int, seen int, name string, mail string"
    )
    best = entities.survivorship(df, "entity_id", ["seen"], ["name", "mail"])
    assert rows(best) == [(1, 3, "new", "x@y.z")]


def test_compaction_keeps_rows_and_reduces_files(spark, tmp_path):
    small, big = str(tmp_path / "small"), str(tmp_path / "big")
    df = spark.range(5000).selectExpr("id", "CAST(IF(id % 10 < 8, 0, id % 10) AS int) AS p")
    df.repartition(20).write.partitionBy("p").parquet(small)
    before = layout.file_sizes(spark, small).count()
    layout.compact_files(spark, small, big, ["p"])
    assert layout.file_sizes(spark, big).count() < before / 5
    assert same_rows(df, spark.read.schema(df.schema).parquet(big))


def test_large_folder_gets_several_files(spark, tmp_path):
    small, big = str(tmp_path / "small"), str(tmp_path / "big")
    df = spark.range(20_000).selectExpr("id", "CAST(IF(id % 10 < 9, 0, 1) AS int) AS p")
    df.repartition(4).write.partitionBy("p").parquet(small)
    layout.compact_files(spark, small, big, ["p"], target_bytes=20_000)
    assert layout.file_sizes(spark, f"{big}/p=0").count() > layout.file_sizes(spark, f"{big}/p=1").count()


def test_zorder_narrows_both_columns(spark, tmp_path):
    df = spark.range(10_000).select("id", F.pmod(F.xxhash64("id"), F.lit(1000)).alias("x"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).alias("y"))
    path = str(tmp_path / "z")
    layout.zorder_layout(df, ["x", "y"], 16).write.parquet(path)
    back = spark.read.parquet(path)
    spans = back.groupBy(F.input_file_name()).agg((F.max("x") - F.min("x")).alias("dx"), (F.max("y") - F.min("y")).alias("dy"))
    widths = spans.agg(F.avg("dx"), F.avg("dy")).first()
    assert same_rows(df, back) and widths[0] < 450 and widths[1] < 450


def test_buckets_join_without_a_shuffle(spark, tmp_path):
    for t in ("a", "b"):
        layout.bucket_layout(spark.range(2000).withColumn("v", F.lit(t)), f"bucket_{t}", str(tmp_path / t), ["id"], 8)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counts = layout.plan_counts(spark.table("bucket_a").join(spark.table("bucket_b"), "id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert counts["Exchange"] == 0 and counts["SortMergeJoin"] == 1


def test_heavy_key_is_not_bucketed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layout, "MIN_PIECE_ROWS", 10)
    df = spark.range(1000).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id")
    with pytest.raises(ValueError, match=r"key \(0,\)"):
        layout.bucket_layout(df, "bucket_hot", str(tmp_path / "h"), ["k"], 8)
    layout.bucket_layout(df, "bucket_even", str(tmp_path / "e"), ["id"], 8)
    assert same_rows(df, spark.table("bucket_even"))


def test_layout_of_text_dates_maps_and_padded_folders(spark, tmp_path):
    df = spark.range(500).selectExpr(
        "lpad(id % 7, 2, '0') AS z", "concat('n', id) AS name", "date_add(DATE '2024-01-01', CAST(id AS INT)) AS d", "map('k', id) AS m"
    )
    df.write.partitionBy("z").parquet(str(tmp_path / "in"))
    layout.compact_files(spark, str(tmp_path / "in"), str(tmp_path / "out"), ["z"])
    assert {r.z for r in layout.read_as_written(spark, str(tmp_path / "out")).select("z").collect()} == {f"{i:02}" for i in range(7)}
    for laid in (layout.zorder_layout(df, ["d", "name"], 4), layout.sort_layout(df, ["d"], 4)):
        assert same_rows(df.drop("m"), laid.drop("m"))


def test_broadcast_only_below_the_limit(spark, sf_dir):
    big, small = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("orders", "customer"))
    small = small.withColumnRenamed("c_custkey", "o_custkey")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert layout.plan_counts(joins.join_broadcast(big, small, "o_custkey"))["BroadcastHashJoin"] == 1
        assert layout.plan_counts(joins.join_broadcast(big, small, "o_custkey", limit_bytes=100))["SortMergeJoin"] == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet").filter("l_quantity > 30").select("l_orderkey")
    plan = layout.plan_text(df)
    assert "GreaterThan(l_quantity,30.0)" in plan and "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_cached_is_released(spark):
    df = spark.range(10)
    with layout.cached(df) as kept:
        assert kept.count() == 10 and df.storageLevel.useMemory
    assert not df.storageLevel.useMemory


def test_masks_depend_on_groups(spark):
    df = spark.createDataFrame([(1, "mail me at a.b@c.org now", "4111111111111111")], "id int, note string, card string")
    masks = {"note": C.hide_emails("note"), "card": C.keep_last("card", 4)}
    allowed = {"note": "support", "card": "finance"}
    assert rows(security.mask_columns(df, masks, {"support"}, allowed)) == [(1, "mail me at a.b@c.org now", "*" * 12 + "1111")]
    assert rows(security.mask_columns(df, masks, set(), allowed), "note") == [("mail me at *** now",)]


def test_nth_values_with_ties(spark):
    df = spark.createDataFrame([("a", 1, 9), ("a", 2, 9), ("a", 3, 7), ("a", 4, 7), ("b", 5, 1)], "d string, id int, s int")
    assert rows(windows.nth_distinct_value(df, ["d"], "s", 2), "id") == [(3,), (4,)]
    assert rows(windows.nth_row(df, ["d"], [F.desc("s"), F.asc("id")], 2), "id") == [(2,)]


def test_map_inversion_keeps_the_last_key(spark):
    m = F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2), F.lit("c"), F.lit(1))
    assert spark.range(1).select(L.invert_map(m).alias("m")).first().m == {1: "c", 2: "b"}


def test_udf_twins_agree(spark):
    df = spark.createDataFrame([(None,), (999.9,), (1000.0,), (5000.0,)], "v double")
    out = df.select(udfs.bucket_udf()("v").alias("a"), udfs.bucket_pandas_udf()("v").alias("b"), udfs.bucket_builtin(F.col("v")).alias("c"))
    assert all(r.a == r.b == r.c for r in out.collect())


def test_incremental_model_merges_newer_rows(spark, tmp_path):
    model = Model("m", lambda a: a, ("a",), "incremental", ("k",), "t")
    data = "k int, t int, v string"
    first = run_models({"a": spark.createDataFrame([(1, 1, "x"), (2, 2, "y")], data)}, [model], spark, str(tmp_path / "1"))
    more = spark.createDataFrame([(1, 1, "ignored"), (2, 3, "new"), (3, 2, "tie")], data)
    second = run_models({"a": more}, [model], spark, str(tmp_path / "2"), first)
    assert rows(second["m"]) == [(1, 1, "x"), (2, 3, "new"), (3, 2, "tie")]


def test_safe_casts(spark):
    df = spark.createDataFrame([("",), ("12.5",), ("abc",), (None,)], "t string")
    assert [r[0] for r in df.select(C.text_to_number("t")).collect()] == [None, 12.5, None, None]
    dates = spark.createDataFrame([("2026-07-35 10:00:00",), ("2026-07-05 10:00:00",)], "t string")
    assert [str(r[0]) for r in dates.select(C.text_to_date("t")).collect()] == ["None", "2026-07-05"]


def test_models_run_in_order_and_stop_on_failure(spark, tmp_path):
    good = Model("b", lambda a: a.filter("id > 1"), ("a",), "table", tests=(lambda df: quality.dq_unique(df, ["id"]),))
    models = [Model("c", lambda b: b.limit(1), ("b",)), good]
    assert build_order({m.name: m for m in models}) == ["b", "c"]
    done = run_models({"a": spark.range(5)}, models, spark, str(tmp_path))
    assert done["b"].count() == 3 and done["c"].count() == 1
    assert rows(lineage_report(spark, models)) == [("a", "b"), ("b", "c")]
    bad = Model("b", lambda a: a.union(a), ("a",), tests=(lambda df: quality.dq_unique(df, ["id"]),))
    with pytest.raises(quality.QualityError):
        run_models({"a": spark.range(5)}, [bad], spark, str(tmp_path / "x"))


def test_scratch_paths_are_fresh(spark):
    assert scratch_path(spark, "x").startswith(checkpoint_root(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_large_files_grow_in_number_with_the_table(spark, tmp_path, monkeypatch):
    columns = ["CAST(id AS DOUBLE) AS l_discount", "id AS l_partkey", "CASE WHEN id % 4 < 2 THEN 'N' ELSE 'R' END AS l_returnflag"]
    lines = spark.range(0, 1000, 1, 4).selectExpr("id", *columns)
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    large, real = [], q_quality.layout.merge_partitions
    monkeypatch.setattr(q_quality.layout, "merge_partitions", lambda df, n: large.append(n) or real(df, n))
    monkeypatch.setattr(q_quality, "ROWS_PER_FILE", 400, raising=False)
    found = q_quality.compact_files(spark, str(tmp_path))
    assert large == [3] and same_rows(lines, found)
