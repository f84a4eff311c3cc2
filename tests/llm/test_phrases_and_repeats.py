"""Resampling, phrase mining and byte dedup against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm import collocations as C
from millrace.llm.hashfilter import hash_filters, passes
from millrace.llm.importance_resampling import resampled
from millrace.llm.queries import ORACLES, QUERIES
from millrace.llm.repeated_bytes import without_repeats
from millrace.llm.suffix_arrays import common_prefixes, suffix_array
from tests.compare import connect, differences

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Other columns, with names that the operators use inside.
MORE = "h long, text2 string, _key string, bucket long, buckets long, weight long, shard long, phrase string, doc long, digest long, spans long"


def table_of(spark, rows, schema="doc_id long, lang string, text string"):
    schema = f"{schema}, {MORE}"
    return spark.createDataFrame([(*r, 1, "x", "y", 2, 3, 4, 5, "z", 6, 7, 8) for r in rows], schema).repartition(3)


@pytest.mark.parametrize("name", ["op11_importance_resampling", "op12_collocations", "op13_suffix_array_dedup"])
def test_registered_query(spark, name):
    folder = "/root/testdata/sf0.001"
    assert differences(QUERIES[name](spark, folder), ORACLES[name], connect(folder)) == []


def features(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(SMALL))
    runs = [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]
    return len(w), [zlib.crc32(x.encode()) % 10_000 for x in runs]


def drawn(docs, target):
    found = [(k, *features(t)) for k, t in docs]
    s, t = Counter(b for _, _, f in found for b in f), Counter(b for x in target for b in features(x)[1])
    total, aim = sum(s.values()), sum(t.values())
    out = []
    for k, n, f in found:
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (total + 10_000) / ((s[b] + 1) * (aim + 10_000)))) for b in f)
        h = None if k is None else int(hashlib.sha256(f"42:{k}".encode()).hexdigest()[:8], 16)
        score = None if k is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((k, n, len(f), weight, score))
    fit = sorted((x for x in out if x[1] >= 20 and x[4] is not None), key=lambda x: (-x[4], x[0]))
    ranks = [(x, i + 1) for i, x in enumerate(fit[: 5 * len(fit) // 100])]
    return Counter((k, n, w, s) for k, _, n, w, s in out), [((x[0], x[2], x[3], x[4]), r) for x, r in ranks]


def test_resampling_equals_brute_force(spark):
    r = random.Random(1)
    vocab = ["Wort", "été", "naïve", "x1", "THE", "the", "_", "日本", "a-b"] + [f"w{i}" for i in range(60)]
    text = lambda n: r.choice([" ", ", ", "\n\n"]).join(r.choice(vocab) for _ in range(n))
    docs = [(i, text(r.randint(0, 60))) for i in range(150)] + [(200, None), (201, ""), (202, " .. "), (None, text(50)), (203, text(30_000))]
    docs += [docs[3], docs[3], (204, docs[7][1])]
    target = [text(20) for _ in range(10)] + [None, ""]
    got = resampled(table_of(spark, [(k, None, t) for k, t in docs]), spark.createDataFrame([(t,) for t in target], "text string")).collect()
    rows, ranks = drawn(docs, target)
    assert Counter((x.doc_id, x.n_features, x.weight, x.score) for x in got) == rows
    assert sorted(((x.doc_id, x.n_features, x.weight, x.score), x["rank"]) for x in got if x["rank"]) == sorted(ranks)


def test_resampling_of_empty_tables_and_text_keys(spark):
    none = table_of(spark, []).limit(0)
    assert resampled(none, none).count() == 0
    docs = spark.createDataFrame([(f"k{i}", "one two three " * 10) for i in range(40)], "doc_id string, text string")
    found = resampled(docs, none).collect()
    assert sorted(x["rank"] for x in found if x["rank"]) == [1, 2]


def mined(docs, support=10, percent=50, top=2000):
    counts, totals = {}, Counter()
    for _, lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(SMALL)):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            totals[lang] += len(w)
            for k in (1, 2, 3):
                counts.setdefault(lang, Counter()).update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        kept = []
        for p, a in f.items():
            if len(p) > 1 and a >= support:
                score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                inside = any(len(q) == 3 and len(p) == 2 and p in (q[:2], q[1:]) and n >= support and 100 * n >= percent * a for q, n in f.items())
                if not inside:
                    kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top]):
            out.append((lang, i + 1, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def phrase_docs(seed):
    r = random.Random(seed)
    vocab = ["New", "york", "city", "of", "the", "\x00", "é", "a|b", "日本"] + [f"w{i}" for i in range(8)]
    text = lambda n: "".join(r.choice(vocab) + r.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\r\n"]) for _ in range(n))
    docs = [(i, r.choice(["en", "de", None, "und", ""]), text(r.randint(0, 60))) for i in range(120)]
    return docs + [(200, "en", None), (201, "en", ""), (202, "fr", "a b"), docs[5], docs[5], (203, "en", text(6000))]


@pytest.mark.parametrize("support, shards", [(10, 3), (4, 1), (12, 5)])
def test_phrases_equal_brute_force(spark, support, shards):
    docs = phrase_docs(support)
    got = C.collocations(table_of(spark, docs), support=support, shards=shards, top=60).collect()
    want = mined(docs, support, top=60)
    assert sorted(tuple(x[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for x in got) == want


def test_slices_count_every_run_once():
    text = phrase_docs(9)[-1][2].encode()
    for width in (1, 2, 3):
        sums = []
        for size in (10**9, 40):
            sums.append(Counter())
            for words in C.word_slices([text, b"", text], 3, 0, size):
                for i, k in zip(*(x.tolist() for x in words.counted(words.spans(width), width))):
                    sums[-1][words.phrase(i, width)] += k
        assert sums[0] == sums[1] and len(sums[0]) > 5


def test_products_beyond_64_bits(spark):
    a, left, right = 3_000_000_019, 4_000_000_007, 5_000_000_029
    rows = [("en", 1, "x", left), ("en", 1, "y", right), ("en", 2, "x y", a)]
    found = C.scored(spark.createDataFrame(rows, "lang string, width long, phrase string, n long")).collect()
    assert [(x.a, x.l, x.r, x.score) for x in found] == [(a, left, right, 1_000_000 * a * a // (left * right))]


def test_phrases_of_an_empty_table(spark):
    assert C.collocations(table_of(spark, []).limit(0)).count() == 0
    with pytest.raises(ValueError):
        C.collocations(table_of(spark, []), support=3, shards=3)


def test_a_filter_never_misses(spark):
    hashes = np.random.default_rng(0).integers(0, 1 << 63, 5000).astype(np.uint64)
    df = spark.createDataFrame([(int(h), i % 2) for i, h in enumerate(hashes)], "h long, part int")
    filters = hash_filters(df, 2, 16)
    for part in (0, 1):
        assert passes(filters[part], hashes[part::2]).all()
        assert passes(filters[part], np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64)).mean() < 0.1


def test_suffix_arrays_and_prefixes():
    for trial in range(200):
        r = np.random.default_rng(trial)
        t = np.append(r.integers(1, r.integers(2, 6), r.integers(1, 80)), 0)
        order = suffix_array(t)
        letters = t.tolist()
        assert order.tolist() == suffix_array(t, top=False).tolist() == sorted(range(len(t)), key=lambda i: letters[i:])
        shared = common_prefixes(t, order)
        for a, b in zip(order, order[1:]):
            n = next(k for k in range(len(t)) if t[a + k] != t[b + k])
            assert shared[b] == n


def removed(rows, width):
    first, out = {}, []
    place = lambda k, i: ((k is not None, k or 0), i)
    for k, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - width + 1):
            first[b[i : i + width]] = min(first.get(b[i : i + width], place(k, i)), place(k, i))
    for k, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - width + 1):
            if first[b[i : i + width]] < place(k, i):
                gone[i : i + width] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((k, len(b), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0]), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def repeat_rows(seed):
    r = random.Random(seed)
    pool = ["".join(r.choice("ab é\n") for _ in range(r.randint(5, 90))) for _ in range(8)] + ["a" * r.randint(30, 400), "xy" * 100, "word " * 60]
    fresh = lambda: "".join(r.choice("abcdefgh ") for _ in range(60))
    rows = [(i, "".join(r.choice(pool) if r.random() < 0.7 else fresh() for _ in range(r.randint(0, 8)))) for i in range(25)]
    rows += [rows[3], (5, rows[7][1]), (None, rows[9][1]), (90, None), (91, ""), (92, "ab" * 9), (93, fresh() * 200)]
    return rows + [(100 + i, rows[4][1]) for i in range(10)]


@pytest.mark.parametrize("width, hot, size", [(100, 50_000, 1 << 16), (30, 50_000, 1 << 16), (100, 5, 500), (30, 8, 100)])
def test_removal_of_repeats_equals_brute_force(spark, width, hot, size):
    """Also with keys that are hot from few places on, and texts read in many slices."""
    rows = repeat_rows(width + hot)
    df = table_of(spark, [(k, "en", t) for k, t in rows])
    got = without_repeats(df, width=width, hot_places=hot, slice_bytes=size).collect()
    assert Counter((x.doc_id, x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in got) == removed(rows, width)
    assert all(hashlib.sha256(x.kept).hexdigest() == x.kept_sha256 for x in got)


def test_suffix_arrays_decide(spark):
    """Passages in different surroundings are found by the suffix arrays alone."""
    r = random.Random(3)
    text = lambda n: "".join(r.choice("abcdefghijkl ") for _ in range(n))
    passage = text(300)
    rows = [(i, text(200) + passage + text(200)) for i in range(5)]
    docs = table_of(spark, [(k, "en", t) for k, t in rows])
    assert [x.n_removed >= 300 for x in without_repeats(docs).orderBy("doc_id").collect()] == [False, True, True, True, True]


def test_no_rows_no_repeats(spark):
    assert without_repeats(table_of(spark, []).limit(0)).count() == 0
