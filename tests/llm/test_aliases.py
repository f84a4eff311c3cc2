"""Targets as pages write them."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.llm.queries import RULES, URL_SQL
from millrace.llm.url_filters import judge_urls, resolved
from tests.compare import differences

PAGE = "https://Example.org/a/b/c.html?x=1#top"


@pytest.mark.parametrize(
    "target, want",
    [
        ("http://other.org/x?y=2", "http://other.org/x?y=2"),
        ("//other.org/x", "http://other.org/x"),
        ("/bad", "https://example.org/bad"),
        ("d.html?k=1", "https://example.org/a/b/d.html?k=1"),
        ("../d", "https://example.org/a/d"),
        ("./././../../../../d/./e", "https://example.org/d/e"),
        ("?p=2", "https://example.org/a/b/c.html?p=2"),
        ("#top", None),
        ("mailto:a@b.org", None),
    ],
)
def test_resolved(spark, target, want):
    df = spark.createDataFrame([(target, PAGE)], "t string, p string")
    assert df.select(resolved(F.col("t"), F.col("p")).alias("u")).first().u == want


PAGES = [
    (1, "http://a.net/es/bad", "<p>blocked</p>"),
    (2, "http://a.net/one", '<link rel="canonical" href="/es/bad">'),
    (3, "http://b.org/two", '<link href="//a.net/es/bad/" rel=canonical>'),
    (4, "http://a.net/es/x/three", "<meta http-equiv=refresh content='0; url=../../one?utm_source=q'>"),
    (5, "http://c.org/four", "<meta property='og:url' content='five.html?k=1&amp;m=2'>"),
    (6, "http://c.org/five.html?k=1&m=2", "<link rel=canonical href=mailto:x><link rel=stylesheet href=/one>"),
    (7, "http://c.org/six", "<link rel=canonical href='http://a.net/es/bad'><meta http-equiv=refresh content=5>"),
    (8, "http://d.com/seven", "<link rel=canonical href='http://c.org/eight'>"),
    (9, "http://c.org/eight", "<link rel=canonical href='http://a.net/es/bad?v=2'>"),
    (10, "http://a.net/es/bad?v=2", None),
    (11, None, "<link rel=canonical href='http://a.net/es/bad'>"),
    (12, "no address", "<link rel=canonical href='/es/bad'>"),
]


def test_relative_targets_are_aliases(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    found = judge_urls(df, RULES)
    assert {x.page_id for x in found.collect() if x.verdict == "block"} == {1, 2, 3, 4, 7, 10}
    con = duckdb.connect()
    pages = df.toPandas()  # noqa: F841  (read by name)
    con.execute("CREATE TABLE pages AS SELECT * FROM pages")
    assert differences(found, URL_SQL, con) == []
