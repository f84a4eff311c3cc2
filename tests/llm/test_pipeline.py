"""The registered queries of the package and the pipeline, stage by stage against brute force."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from millrace.llm import line_quality
from millrace.llm.common import held_out
from millrace.llm.queries import ORACLES, QUERIES
from tests.compare import connect, differences
from tests.llm.helpers import near_classes, shingles
from tests.llm.test_models import check_packing

OPERATORS = {f"op{n}" for n in range(1, 14)}


def test_one_query_for_each_operator_and_the_pipeline():
    assert {name.split("_")[0] for name in QUERIES} == OPERATORS
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "packing"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_with_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), ORACLES[name], connect(sf_dir)) == []


def sentence(rng, n):
    return " ".join(f"w{rng.randrange(3000)}" for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Good texts, junk, copies, altered copies, a shared passage and leaked items."""
    rng = random.Random(8)
    items = [(i, sentence(rng, n)) for i, n in enumerate((12, 25, 40))]
    passage = "\n".join(sentence(rng, 30) for _ in range(3))
    rows = []
    for i in range(120):
        body = [sentence(rng, rng.randrange(8, 30)) for _ in range(rng.randrange(3, 9))]
        if i % 4 == 1:
            body = [" ".join(f"{w}%%%" for w in line.upper().split()) for line in body]
        if i % 10 == 2:
            body.insert(1, passage)
        if i % 12 == 3:
            body.insert(1, items[i % 3][1].lower())
        rows.append((i, "\n".join(body)))
    rows += [(200, rows[0][1]), (201, " ".join(rows[4][1].split()[:-1])), (202, ""), (203, None), (None, rows[8][1]), (200, rows[0][1])]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    folder = str(tmp_path_factory.mktemp("small"))
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 0 if i % 4 == 1 else 1, 0) for i in range(100)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, items


def test_each_stage(spark, small, tmp_path):
    folder, items = small
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        out = stage(spark, docs, folder)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = ([(r.doc_id, r.text) for r in before.collect()], docs.collect())
        if name != "packing":
            assert docs.columns == before.columns
            assert all(r.n_chars == len(r.text or "") for r in seen[name][1])

    given, kept = seen["quality"]
    labels = spark.read.parquet(f"{folder}/labels.parquet").filter(~held_out())
    start = spark.read.parquet(f"{folder}/documents.parquet")
    scores = line_quality.score(start, line_quality.fit(start, labels)).collect()
    assert len(kept) == sum(r.predicted for r in scores)
    good = {k for k, _ in given if k is not None and k < 120 and k % 4 != 1}
    assert good <= {r.doc_id for r in kept} and not {r.doc_id for r in kept} & {k for k in range(120) if k % 4 == 1}

    given, kept = seen["line_dedup"]
    assert len(kept) == len(given)
    lines: dict = {}
    for r in sorted((r for r in kept if r.doc_id is not None), key=lambda r: r.doc_id):
        body = (r.text or "").split("\n")
        for a, b in zip(body, body[1:]):
            if len(a.split()) + len(b.split()) >= 40:
                assert lines.setdefault((a, b), r.doc_id) == r.doc_id
    first = {}
    for k, t in given:
        for line in (t or "").split("\n"):
            if k is not None:
                first[line] = min(first.get(line, k), k)
    left = {(r.doc_id, line) for r in kept for line in (r.text or "").split("\n")}
    assert all((k, line) in left for line, k in first.items())

    given, kept = seen["near_dedup"]
    texts = {k: t or "" for k, t in given if k is not None}
    keep = {k for k, c in near_classes(texts).items() if k == c}
    assert sorted((r.doc_id for r in kept), key=str) == sorted([*keep, *(k for k, _ in given if k is None)], key=str)

    given, kept = seen["decontamination"]
    held = [shingles(t) for _, t in items]
    clean = [k for k, t in given if not any(len(s & shingles(t)) / len(s) >= 0.8 for s in held)]
    assert sorted((r.doc_id for r in kept), key=str) == sorted(clean, key=str) and len(clean) < len(given)

    given, pieces = seen["packing"]
    check_packing(pieces, given, 1024)


def test_run_equals_the_stages(spark, small):
    folder, _ = small
    rows = corpus_pipeline.run(spark, folder)
    assert rows.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert rows.count() > 0
