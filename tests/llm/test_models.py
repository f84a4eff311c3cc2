"""Token counts, packing, nearest neighbours, URL filters, language and quality."""

from __future__ import annotations

import math
import os
import random
import subprocess
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import language_id, line_quality
from millrace.llm.packing import ByteEncoder, best_pattern, cutting_stock, inverted, pack
from millrace.llm.permutation_index import nearest_neighbours
from millrace.llm.samples import sampled
from millrace.llm.token_counts import WordCounter, count_tokens, read_cache, tokenizer_digest
from millrace.llm.url_filters import Rule, judge_urls
from millrace.session import scratch_path
from tests.llm.helpers import classes, docs_of

ODD = [
    "", " ", "\n\t x  y ", "it's the dog's", "'s's 've12 34", "naïve ÀÉ ß", "İstanbul Σίσυφος ΣΑΣ", "x² ½ ٣", "日本語 text",
    "<|endoftext|> a <|ENDOFTEXT|>", "<|startoftext|>", "a b c", "\x1c\x1d\x85", "é é", "!!!***&&& |||", "🙂🙂 ok",
    "a" * 3000, "tail  ", "A\r\nB\x0b\x0cC", "_under_score_ 1_000",
]
WORDS, BYTES, RANKS = map(public_tokenizers.path, ("word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))


def library_ids(path, texts):
    return [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def test_word_counter_equals_the_library(spark, sf_dir):
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(200).collect()]
    counter = WordCounter(WORDS)
    assert counter.count(texts) == [len(i) for i in library_ids(WORDS, texts)]
    assert counter.count(texts[::-1]) == [len(i) for i in library_ids(WORDS, texts[::-1])]


def test_token_counts_fill_and_use_the_cache(spark):
    cache = scratch_path(spark, "test-cache")
    rows = [*enumerate(ODD), (100, None), (0, ""), (0, ""), (None, "it's"), (101, " it's   the\ndog's ")]
    want = sorted(((k, len((t or "").encode()), len(i)) for (k, t), i in zip(rows, library_ids(WORDS, [t or "" for _, t in rows]))), key=str)
    got = count_tokens(docs_of(spark, rows), cache, WORDS, limit=4).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=str) == want
    assert all(r.over_limit == (r.n_tokens > 4) for r in got)
    files = spark.read.parquet(cache)
    first = files.count()
    assert first == files.select("content").distinct().count()
    count_tokens(docs_of(spark, rows), cache, WORDS).count()
    assert spark.read.parquet(cache).count() == first  # all hits
    # A stored count is used as it is; another tokenizer version is not.
    spark.createDataFrame([(files.first().content, "other", 99)], files.schema).write.mode("append").parquet(cache)
    assert read_cache(spark, cache, "other").count() == 1
    assert read_cache(spark, cache, tokenizer_digest(WORDS)).count() == first
    assert count_tokens(docs_of(spark, []), cache, WORDS).count() == 0


@pytest.mark.parametrize("ranks", [None, RANKS])
def test_byte_ids_equal_the_library(spark, sf_dir, ranks):
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(100).collect()]
    encoder = ByteEncoder(BYTES, ranks)
    assert [encoder.encode(t).tolist() for t in texts] == library_ids(BYTES, texts)


def test_knapsack_and_inverse():
    value, pattern = best_pattern(np.array([3, 4, 5]), np.array([0.4, 0.55, 0.6]), 12)
    assert value == pytest.approx(1.65) and pattern.tolist() == [0, 3, 0]
    m = np.random.default_rng(0).random((20, 20))
    assert np.allclose(inverted(m) @ m, np.eye(20))


@pytest.mark.parametrize("seed", range(4))
def test_patterns_hold_the_demand_exactly(seed):
    rng = random.Random(seed)
    demand = {s: rng.randrange(1, 400) for s in rng.sample(range(1, 32), 25)}
    used: dict = {}
    patterns = cutting_stock(demand, 64)
    for pattern, times in patterns:
        assert times > 0 and sum(s * a for s, a in pattern.items()) <= 64
        for s, a in pattern.items():
            used[s] = used.get(s, 0) + a * times
    assert used == demand
    bound = math.ceil(sum(s * n for s, n in demand.items()) / 64)
    assert sum(t for _, t in patterns) <= 1.03 * bound + 1
    assert cutting_stock({}, 64) == [] and cutting_stock({64: 3}, 64) == [({64: 1}, 3)]


def check_packing(pieces, rows, capacity):
    docs: dict = {}
    for (key, _), ids in zip(rows, library_ids(BYTES, [t or "" for _, t in rows])):
        docs.setdefault(key, []).append(np.array([*ids, 0], "<u4"))
    placed: dict = {}
    found: dict = {}
    for p in pieces:
        placed.setdefault(p.sequence_id, []).append((p.offset, p.length))
        found.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, p.length, p.ids_crc32))
    for parts in placed.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end <= capacity
    want: dict = {}
    for key, lists in docs.items():
        for ids in lists:
            want.setdefault((key, len(ids)), []).extend(
                (s, len(ids[s : s + capacity]), zlib.crc32(ids[s : s + capacity].tobytes())) for s in range(0, len(ids), capacity)
            )
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}
    return placed


def test_packing(spark, sf_dir):
    rows = [*enumerate(ODD), (0, ""), (100, None), (None, "x"), (None, "x")]
    rows += [(1000 + r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(300).collect()]
    placed = check_packing(pack(docs_of(spark, rows), BYTES, RANKS).collect(), rows, 1024)
    total = sum(n for parts in placed.values() for _, n in parts)
    assert len(placed) * 1024 < 1.03 * total + 2048
    check_packing(pack(docs_of(spark, rows[:6]), BYTES, capacity=16).collect(), rows[:6], 16)
    assert pack(docs_of(spark, []), BYTES).count() == 0


def brute_neighbours(vectors, every, k):
    good = {i: v / np.linalg.norm(v) for i, v in vectors.items()}
    out = {}
    for q in good:
        if q % every == 0:
            ranked = sorted((-round(float(good[q] @ good[i]), 12), i) for i in good if i != q)
            out[q] = [i for _, i in ranked[:k]]
    return out


def test_neighbours_are_exact_when_all_is_ranked(spark):
    rng = np.random.default_rng(6)
    vectors = {i: rng.normal(size=8) for i in range(120)}
    for i in range(40, 70):
        vectors[i] = vectors[40]  # many copies
    rows = [(i, v.tolist()) for i, v in vectors.items()] + [(10, vectors[10].tolist())]
    rows += [(500, None), (600, [0.0] * 8), (700, [float("nan")] * 8), (800, [None, *[1.0] * 7]), (None, [1.0] * 8)]
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, id int, query string")
    got: dict = {}
    for r in nearest_neighbours(table, every=5, rerank=1.0, shard=16, pivots=8, nearest=4).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == brute_neighbours(vectors, 5, 5)
    assert nearest_neighbours(table.limit(0), every=5).count() == 0
    one = spark.createDataFrame([(5, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert nearest_neighbours(one, every=5).count() == 0
    two = spark.createDataFrame([(5, [1.0, 2.0]), (6, [2.0, 1.0])], "vec_id long, embedding array<double>")
    assert [(r.query_id, r["rank"], r.vec_id, round(r.score, 12)) for r in nearest_neighbours(two, every=5).collect()] == [(5, 1, 6, 0.8)]


def test_neighbours_recall(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    vectors = {r.vec_id: np.array(r.embedding, float) for r in table.collect()}
    want = brute_neighbours(vectors, 50, 5)
    got: dict = {}
    for r in nearest_neighbours(table, every=50).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert sum(len(got[q] & set(w)) for q, w in want.items()) / (5 * len(want)) >= 0.9


def test_neighbours_are_found_where_pivots_tell_little(spark):
    """Many dimensions without structure, and vectors that are nearly at right angles to one another."""
    rng = np.random.default_rng(8)
    sparse = (rng.random((600, 300)) < 0.02) * rng.random((600, 300))
    for found in (rng.normal(size=(600, 500)), sparse + 1e-9 * rng.random((600, 300))):
        vectors = dict(enumerate(found))
        table = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "vec_id long, embedding array<double>")
        got: dict = {}
        for r in nearest_neighbours(table, every=20).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append(r.vec_id)
        assert got == brute_neighbours(vectors, 20, 5)


def test_url_rules_and_aliases(spark):
    rules = (Rule("block", "bad.com"), Rule("allow", "bad.com", "/ok/"), Rule("allow", "fine.org"))
    canonical = '<head><link href="http://bad.com/x/" rel="canonical"></head>'
    refresh = '<META http-equiv="Refresh" content="0; url=https://a.net/1?utm_source=q">'
    both = '<meta property="og:url" content="http://fine.org/a"><link rel=canonical href=https://bad.com/z>'
    rows = [
        (1, "http://www.BAD.com/x", None),
        (2, "http://sub.bad.com/ok/1", ""),
        (3, "https://notbad.com/", "<p>"),
        (4, "https://a.net/1#top", canonical),
        (5, "https://b.net/2", refresh),
        (6, "https://c.net/3", both),
        (7, None, None),
        (8, "no scheme", canonical),
        (9, "ftp://", None),
        (10, "https://a.net/1/", None),
        (10, "https://a.net/1/", None),
        (None, "http://fine.org?x=1", None),
    ]
    pages = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, host string, rule string")
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, rules).collect()), key=str)
    assert got == sorted(
        [
            (1, "www.bad.com", "/x", "bad.com/", "block"),
            (2, "sub.bad.com", "/ok/1", "bad.com/ok/", "allow"),
            (3, "notbad.com", "/", None, "allow"),
            (4, "a.net", "/1", None, "allow"),  # its canonical form bad.com/x is no page here
            (5, "b.net", "/2", None, "allow"),
            (6, "c.net", "/3", None, "allow"),
            (7, "", "", None, "allow"),
            (8, "", "", None, "allow"),
            (9, "", "", None, "allow"),
            (10, "a.net", "/1/", None, "allow"),
            (10, "a.net", "/1/", None, "allow"),
            (None, "fine.org", "", None, "allow"),
        ],
        key=str,
    )
    more = spark.createDataFrame(
        [(11, "http://bad.com/x", None, "", ""), (12, "http://bad.com/z", None, "", ""), (13, "http://fine.org/a/", None, "", "")],
        pages.schema,
    )
    verdicts = {r.page_id: r.verdict for r in judge_urls(pages.union(more), rules).collect()}
    # 4, 5 and 10 reach the blocked page 11; 6 reaches a blocked and an allowed page.
    assert [verdicts[i] for i in (4, 5, 10, 6, 3)] == ["block", "block", "block", "allow", "allow"]
    moved = spark.createDataFrame([("https://notbad.com/", "http://bad.com/x")], "source string, target string")
    assert {r.page_id: r.verdict for r in judge_urls(pages.union(more), rules, redirects=moved).collect()}[3] == "block"
    assert judge_urls(pages.limit(0), rules).count() == 0


def test_samples_are_bounded_and_complete_for_few(spark):
    rows = spark.createDataFrame([(i, "a" if i % 10 else "b") for i in range(3000)] + [(None, "a"), (5, None)], "k long, l string")
    kept = {r.l: r["count"] for r in rows.filter(sampled(rows, "k", "l", 500)).groupBy("l").count().collect()}
    assert kept["b"] == 300 and 350 < kept["a"] < 650


def test_language_held_out(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    test = (docs.doc_id % 4 == 2)
    model = language_id.fit(docs.filter(~test), per_label=300)
    rows = language_id.predict(docs, model, extra=test).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 200 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.98
    odd = language_id.predict(docs_of(spark, [(1, None), (2, ""), (3, "12 !?"), (3, "12 !?"), (None, "the " * 50_000), (4, "日")]), model).collect()
    assert sorted(r.lang_pred for r in odd if r.doc_id in (1, 2, 3)) == ["und"] * 4 and len(odd) == 6
    assert all(0 <= r.score <= 1 for r in odd)
    assert [r.rejected for r in odd if r.doc_id == 4] == [True]
    assert language_id.predict(docs_of(spark, []), model).count() == 0
    empty = language_id.fit(docs.limit(0))
    assert language_id.predict(docs_of(spark, [(1, "text")]), empty).first().lang_pred == "und"


def brute_marginals(emit, move):
    """Probability of good for each line, over all labellings."""
    n, total, good = len(emit), 0.0, [0.0] * len(emit)
    for mask in range(2**n):
        y = [mask >> i & 1 for i in range(n)]
        weight = math.exp(sum(e for e, v in zip(emit, y) if v) + sum(move[a][b] for a, b in zip(y, y[1:])))
        total += weight
        for i in range(n):
            good[i] += weight * y[i]
    return [g / total for g in good]


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(7)
    emit, move = rng.normal(size=11), rng.normal(size=(2, 2))
    bounds = np.array([0, 5, 6, 11])
    for at in line_quality._chains(bounds):
        odds, _, _ = line_quality.marginals(emit, at, move)
        for row, chain in zip(odds, at):
            chain = chain[chain >= 0]
            got = 1 / (1 + np.exp(-row[: len(chain)]))
            assert np.allclose(got, brute_marginals(emit[chain], move))
    lines = sorted(tuple(c[c >= 0].tolist()) for at in line_quality._chains(np.array([0, 7, 8, 20]), 3) for c in at)
    assert lines == [(0, 1, 2), (3, 4, 5), (6,), (7,), (8, 9, 10), (11, 12, 13), (14, 15, 16), (17, 18, 19)]


def test_quality_held_out(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    test = docs.doc_id % 4 == 2
    model = line_quality.fit(docs, labels.filter("doc_id % 4 <> 2"))
    rows = line_quality.score(docs, model, extra=test).join(labels, "doc_id").filter("held_out").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) > 0.97
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.94
    odd = docs_of(spark, [(1, None), (2, ""), (2, ""), (None, "x\n" * 20_000), (3, "y" * 100_000)])
    got = line_quality.score(odd, model).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    kept = line_quality.accepted(odd, model)
    assert kept.columns == odd.columns and kept.count() == sum(r.predicted for r in got)
    assert line_quality.score(odd.limit(0), model).count() == 0
    blank = line_quality.fit(docs, labels.limit(0))
    assert {r.score for r in line_quality.score(odd, blank).collect()} == {0.5}


def test_components_helper():
    assert classes([1, 2, 3], [(3, 2)]) == {1: 1, 2: 2, 3: 2}


def test_quality_learns_from_text_after_many_lines(spark):
    """Bad documents that begin with 600 good lines, as all good ones do."""
    rng = random.Random(3)
    names = "the river runs past old houses and people walk along its green banks every quiet morning".split()

    def good(n):
        return [" ".join(rng.choices(names, k=rng.randrange(8, 14))).capitalize() + "." for _ in range(n)]

    def bad(n):
        return [f"{rng.randrange(10**6)} | CLICK!!! | {rng.randrange(10**6)} $$$" for _ in range(n)]

    rows = [(i, "\n".join(good(600) + (bad(600) if i % 2 else good(600)))) for i in range(40)]
    docs = docs_of(spark, [*rows, (0, "x"), (1, "zzz")])
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(30)], "doc_id long, quality int")
    model = line_quality.fit(docs, labels)
    got = {r.doc_id: r for r in line_quality.score(docs.filter("doc_id > 1"), model).collect()}
    assert len(got) == 38 and all(r.predicted == 1 - k % 2 for k, r in got.items())
    assert all(550 <= r.bad_lines <= 650 if k % 2 else r.bad_lines < 50 for k, r in got.items())


def test_quality_features_in_pieces(monkeypatch):
    texts = ["a b c\nB B!\n\n x|y 12\na b c", "", "\n", "one line", "tail\n"] * 5
    w = np.random.default_rng(1).normal(size=3 * line_quality.OWN)
    whole = line_quality.emissions(texts, w)
    monkeypatch.setattr(line_quality, "CHUNK_CHARS", 150)
    for a, b in zip(whole, line_quality.emissions(texts, w)):
        assert np.allclose(a, b)
    ranges = line_quality._picked(64 * 20 + 5, "text")
    assert sum(e - s for s, e in ranges) <= 8 * 64 and line_quality._picked(100, "t") == [(0, 100)]


def test_quality_of_a_million_lines_in_bounded_memory():
    code = (
        "import resource, numpy as np\n"
        "from millrace.llm import line_quality as q\n"
        "m = {'w': np.ones(45) / 9, 'move': np.eye(2), 'curve': np.array([0.0, 1.0])}\n"
        "before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\n"
        "p, _, _ = q._scored(['some words 12\\n' * 1_000_000], m)\n"
        "assert 0 <= p[0] <= 1\n"
        "print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)"
    )
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    assert int(done.stdout) < 400
