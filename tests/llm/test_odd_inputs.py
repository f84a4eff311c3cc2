"""Columns whose names clash with any that an operator might use, and vectors of several lengths."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.llm import line_quality
from millrace.llm.decontamination import without_leaks
from millrace.llm.line_dedup import deduplicated_lines
from millrace.llm.near_duplicates import deduplicated
from millrace.llm.permutation_index import nearest_neighbours

CLASHING = "blocks _row _n _kept _content _label _k k h d n l e x y body label content id row class_id keep words hashes bucket".split()


def test_columns_may_have_any_name(spark):
    words = "one two three four five six seven eight nine ten".split()
    body = "\n".join(" ".join(words[i:] + words[:i]) for i in range(10))
    long = body + "\n" + "\n".join(f"{a} {b} other words here" for a in words for b in words)
    docs = spark.createDataFrame([(1, body), (2, body), (3, long), (3, long), (4, None), (None, ""), (5, "")], "doc_id long, text string")
    docs = docs.withColumns({c: F.lit(i) for i, c in enumerate(CLASHING)})
    extra = tuple(range(len(CLASHING)))

    def back(df):
        assert df.columns[: len(docs.columns)] == docs.columns
        found = df.collect()
        assert all(tuple(r)[2 : 2 + len(extra)] == extra for r in found)
        return sorted((r.doc_id is None, r.doc_id, r.text or "") for r in found)

    kept = back(deduplicated(docs))
    assert [k for _, k, _ in kept] == [1, 3, 4, None]
    tail = long[len(body) + 1 :]
    assert [t for _, _, t in back(deduplicated_lines(docs))] == [body, "", tail, tail, "", "", ""]
    items = spark.createDataFrame([(7, f"{words[0]} " + " ".join(words[1:]))], "item_id long, text string")
    assert [k for _, k, _ in back(without_leaks(docs, items))] == [4, 5, None]
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int").withColumns({c: F.lit(1) for c in CLASHING})
    model = line_quality.fit(docs, labels)
    assert line_quality.score(docs, model).count() == 7
    back(line_quality.accepted(docs, model))


def test_vectors_of_other_lengths_take_no_part(spark):
    rows = [(i, [1.0, i / 10, 0.5]) for i in range(10)] + [(100, [1.0, 2.0]), (101, [1.0] * 5), (102, [])]
    got = nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 2, 3).collect()
    assert {r.query_id for r in got} == {0, 2, 4, 6, 8} and all(r.vec_id < 10 for r in got) and len(got) == 15
