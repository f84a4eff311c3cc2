"""Line dedup, near-duplicates, decontamination, license scans."""

from __future__ import annotations

import random

import numpy as np
import pytest

from millrace.llm import near_duplicates as nd
from millrace.llm.components import connected_components
from millrace.llm.decontamination import leaks, without_leaks
from millrace.llm.license_scan import TEMPLATES, prepared_templates, scan_licenses, values_needed
from millrace.llm.line_dedup import aligned_blocks, deduplicated_lines, patience
from millrace.llm.textarrays import shingles as hashed
from tests.llm.helpers import altered, classes, docs_of, jaccard, near_classes, shingles, words


def text(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def test_hashed_shingles_follow_words():
    texts = ["", "One two", "a b c d e", "A  b,c D-e f", "x_y z é ß Ω 1 2", "...", "a b c d e f"]
    hashes, starts = hashed(texts)
    held = [set(hashes[s:e].tolist()) for s, e in zip(starts, starts[1:])]
    for i, a in enumerate(texts):
        assert len(held[i]) == len(shingles(a))
        for j, b in enumerate(texts):
            assert len(held[i] & held[j]) == len(shingles(a) & shingles(b))


def test_patience_matches_in_order():
    a, b = list("abcxdefy"), list("abcdezef")
    got = patience(a, b)
    assert got == sorted(got) and all(a[i] == b[j] for i, j in got)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))
    assert patience([], [1]) == [] and patience([1, 1], [1, 1]) == [(0, 0), (1, 1)]
    assert aligned_blocks([9, 1, 2, 8], [1, 2, 7, 8], [30, 30, 5, 5], 40) == [(0, 1)]


def covered(a, b, words, least):
    """Places of ``b`` in a run of lines of ``least`` words that ``a`` holds too, by trying all runs."""
    held = {tuple(a[i:k]) for i in range(len(a)) for k in range(i + 1, len(a) + 1)}
    return {
        x
        for i in range(len(b))
        for k in range(i + 1, len(b) + 1)
        if sum(words[i:k]) >= least and tuple(b[i:k]) in held
        for x in range(i, k)
    }


def test_blocks_of_passages_held_twice_or_swapped():
    x, y, z, u, v, p, q = [1], [2], [3], [4], [5], [6, 7], [8, 9]
    for a, b, want in (
        (x + p + y + p + z, u + p + v, [(1, 2)]),
        (x + p + y, p + u + p + v, [(0, 1), (3, 4)]),
        (x + p + y + q, q + u + p + v, [(0, 1), (3, 4)]),
    ):
        assert aligned_blocks(a, b, [25] * len(b), 40) == want
    rng = random.Random(6)
    for _ in range(400):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(14))] for _ in "ab")
        words = [[3, 12, 39, 20, 45][line] for line in b]
        got = [x for i, j in aligned_blocks(a, b, words, 40) for x in range(i, j + 1)]
        assert got == sorted(covered(a, b, words, 40))


def test_line_dedup_finds_a_passage_that_its_first_holder_has_twice(spark):
    rng = random.Random(7)
    p, q = ([" ".join(text(rng, 25)) for _ in range(2)] for _ in "pq")
    own = [" ".join(text(rng, 30)) for _ in range(9)]
    rows = [
        (1, [own[0], *p, own[1], *p, own[2], *q]),
        (2, [own[3], *p, own[4]]),
        (3, [*q, own[5], *p, own[6], *p]),
    ]
    got = {r.doc_id: r.text for r in deduplicated_lines(docs_of(spark, [(k, "\n".join(t)) for k, t in rows])).collect()}
    assert got == {1: "\n".join(rows[0][1]), 2: "\n".join([own[3], own[4]]), 3: "\n".join([own[5], own[6]])}


def test_line_dedup_equals_brute_force(spark):
    """Of a passage, single lines occur in earlier documents than the first that holds it whole."""
    rng = random.Random(8)
    a, b = (" ".join(text(rng, 25)) for _ in "ab")
    own = [" ".join(text(rng, 30)) for _ in range(9)]
    rows = [(1, [a, own[0]]), (2, [own[1], b]), (5, [own[2], a, b, own[3]]), (9, [own[4], a, b])]
    line = [" ".join(text(rng, n)) for n in (3, 9, 20, 24, 39, 41)]
    rows += [(20 + k, [rng.choice(line) for _ in range(rng.randrange(1, 12))]) for k in range(60)]
    got = {r.doc_id: r.text for r in deduplicated_lines(docs_of(spark, [(k, "\n".join(t)) for k, t in rows])).collect()}
    assert got[9] == own[4]
    for k, mine in rows:
        count = [len(x.split()) for x in mine]
        gone = {j for other, lines in rows if other < k for j in covered(lines, mine, count, 40)}
        assert got[k] == "\n".join(x for j, x in enumerate(mine) if j not in gone)


def test_line_dedup_passes_blank_lines(spark):
    rng = random.Random(9)
    p, q, r, s = (" ".join(text(rng, n)) for n in (30, 30, 15, 15))
    own = [" ".join(text(rng, 30)) for _ in range(9)]
    rows = {
        1: f"{own[0]}\n\n{p}\n\n{q}\n\n{own[1]}",
        2: f"{own[2]}\n\n{p}\n\n{q}\n\n{own[3]}",
        3: f"{own[4]}\n{p}\n \n\n{q}\n{own[5]}",
        4: f"{r}\n\n{s}\n\n{p}",
        5: f"\n\n{r}\n\n{s}\n\n{p}\n\n",
        6: f"{r}\n\n{s}\n\n{own[6]}\n\n",
        7: "\n\n\n",
        8: "\n\n\n",
    }
    got = {r.doc_id: (r.text, r.removed_lines) for r in deduplicated_lines(docs_of(spark, rows.items())).collect()}
    changed = {2: (f"{own[2]}\n\n{own[3]}", 4), 3: (f"{own[4]}\n{own[5]}", 4), 5: ("", 9)}
    assert got == {k: changed.get(k, (t, 0)) for k, t in rows.items()}


def test_line_dedup_keeps_the_first_and_short_repeats(spark):
    rng = random.Random(1)
    passage = [" ".join(text(rng, 20)) for _ in range(3)]
    own = [[" ".join(text(rng, 30)) for _ in range(4)] for _ in range(4)]
    short = "All rights reserved."
    rows = [
        (1, "\n".join([own[0][0], *passage, own[0][1], short])),
        (2, "\n".join([own[1][0], short, *[f" {p} " for p in passage], own[1][1]])),
        (3, "\n".join(own[2])),
        (4, "\n".join(own[2])),
        (5, None),
        (6, ""),
        (None, "\n".join(passage)),
        (3, "\n".join(own[2])),
    ]
    got = deduplicated_lines(docs_of(spark, rows))
    assert got.columns == [*docs_of(spark, []).columns, "removed_lines"]
    found = [(r.doc_id, r.text, r.removed_lines) for r in got.collect()]
    assert sorted(found, key=str) == sorted(
        [
            (1, rows[0][1], 0),
            (2, "\n".join([own[1][0], short, own[1][1]]), 3),
            (3, rows[2][1], 0),
            (3, rows[2][1], 0),
            (4, "", 4),
            (5, None, 0),
            (6, "", 0),
            (None, rows[6][1], 0),
        ],
        key=str,
    )
    assert deduplicated_lines(docs_of(spark, [])).count() == 0


def test_line_dedup_leaves_no_long_passage_twice(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r.doc_id: r.text for r in deduplicated_lines(docs).collect()}
    seen: dict = {}
    for key, body in rows.items():
        lines = [x.strip() for x in body.split("\n")]
        for i in range(len(lines)):
            run, n = [], 0
            for line in lines[i:]:
                run.append(line)
                n += len(line.split())
                if n >= 50:
                    assert seen.setdefault(tuple(run), key) == key
                    break


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(1, 2), (2, 3), (9, 8), (8, 8), (None, 3)], [(i, i + 1) for i in range(40)]])
def test_components(spark, edges):
    rows = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    known = [e for e in edges if None not in e]
    assert {r.node: r.component for r in rows} == classes({n for e in known for n in e}, known)
    assert len(rows) == len({n for e in known for n in e})


def test_probminhash_estimates_the_weighted_similarity():
    a = {i: 1 + i % 3 for i in range(400)}
    b = {i: 1 + i % 3 for i in range(50, 420)}
    exact = sum(
        1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in a.keys() | b.keys()) for d in a.keys() & b.keys()
    )
    held = [np.sort(np.repeat(np.array(list(x), "<u4"), list(x.values()))) for x in (a, b)]
    plain = len(a.keys() & b.keys()) / len(a.keys() | b.keys())
    assert nd.similarity(*held) == pytest.approx(max(exact, plain))
    doc = np.repeat([0, 1], [len(a), len(b)])
    shingle = nd.mix(np.array([*a, *b], np.uint64))
    names = nd.signatures(doc, shingle, np.array([*a.values(), *b.values()]), 2, 4096)
    assert (names[0] == names[1]).mean() == pytest.approx(exact, abs=0.04)


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(6):  # groups with more and more changes, so that links form chains
        base = text(rng, 120)
        rows += [altered(base, rng.sample(range(120), k), f"m{len(rows)}x") for k in (0, 0, 1, 2, 3, 4, 5, 6, 8)]
    rows += ["", None, "...", "...", "a b", "a b", "A b", "one two three four five six " * 40]
    order = list(range(len(rows)))
    rng.shuffle(order)
    texts = {k: rows[i] for k, i in enumerate(order)}
    got = {r.doc_id: r.class_id for r in nd.near_duplicates(docs_of(spark, texts.items())).collect()}
    want = near_classes({k: t or "" for k, t in texts.items()})
    assert got == want


def test_near_duplicates_split_a_large_bucket(spark, monkeypatch):
    """Changed copies of one text, most of them too far from each other; blocks are made tiny."""
    monkeypatch.setattr(nd, "BLOCK", 8)
    rng = random.Random(3)
    base = text(rng, 100)
    texts = {i: altered(base, rng.sample(range(100), rng.choice([1, 2, 4, 6, 8, 10])), f"m{i}x") for i in range(90)}
    got = {r.doc_id: r.class_id for r in nd.near_duplicates(docs_of(spark, texts.items())).collect()}
    assert got == near_classes(texts)


def test_near_duplicates_with_unequal_repeats(spark, monkeypatch):
    """Pairs whose sets of shingles are nearly equal, while their counts are not."""
    monkeypatch.setattr(nd, "BLOCK", 8)
    rng = random.Random(5)
    texts = {}
    for _ in range(25):
        x, p = text(rng, 100), text(rng, 50)
        texts[len(texts)] = " ".join(x + p)
        texts[len(texts)] = " ".join(x + p * 10)
    got = {r.doc_id: r.class_id for r in nd.near_duplicates(docs_of(spark, texts.items())).collect()}
    assert got == near_classes(texts)


def test_blocks_compare_either_signature():
    rng = random.Random(6)
    x, p = text(rng, 100), text(rng, 50)
    body = [" ".join(x + p), " ".join(x + p * 10)]
    batch = nd.pa.RecordBatch.from_pydict({"id": [1, 2], "content": ["x", "y"], "body": body})
    marks = next(nd._sketch(iter([batch]))).column("marks").to_pylist()
    held = next(nd._multisets(iter([nd.pa.RecordBatch.from_pydict({"node": [1, 2], "body": body})]))).column("held").to_pylist()
    group = nd.pd.DataFrame({"node": [1, 2], "class": [1, 2], "marks": marks, "held": held})
    assert nd._links(group).values.tolist() == [[1, 2]]


def test_one_of_each_class_stays(spark):
    rows = [(3, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "other words are in this one"), (None, "a b c d e f")]
    kept = nd.deduplicated(docs_of(spark, rows))
    assert kept.columns == docs_of(spark, []).columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 2, None]
    assert nd.deduplicated(docs_of(spark, [])).count() == 0


def brute_leaks(texts, items):
    held = {i: shingles(t) for i, t in items}
    return sorted(
        (k, i) for k, t in texts for i, s in held.items() if s and len(s & shingles(t)) / len(s) >= 0.8
    )


def test_leaks_equal_brute_force(spark):
    rng = random.Random(4)
    items = [(i, " ".join(text(rng, n))) for i, n in enumerate([5, 6, 7, 9, 12, 20, 33, 70, 150])]
    items += [(20, "two words"), (21, ""), (22, None), (24, items[3][1])]
    docs = []
    for i, (_, body) in enumerate(items):
        body = body or ""
        long = text(rng, 3000)
        at = rng.randrange(3000)
        docs.append((i, " ".join([*long[:at], body.upper(), *long[at:]])))
        w = body.split()
        docs.append((100 + i, " ".join([*text(rng, 50), *w[: int(len(w) * 0.9)], *text(rng, 50)])))
        docs.append((200 + i, " ".join([*text(rng, 50), *w[: len(w) // 2], *text(rng, 50)])))
    docs += [(300, "Two  words!"), (301, None), (302, ""), (303, docs[9][1]), (303, docs[12][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = leaks(docs_of(spark, docs), bench)
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == brute_leaks(docs, items)
    kept = without_leaks(docs_of(spark, [*docs, (None, items[5][1])]), bench)
    bad = {k for k, _ in brute_leaks(docs, items)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, _ in docs if k not in bad)
    none = spark.createDataFrame([], bench.schema)
    assert leaks(docs_of(spark, docs), none).count() == 0
    assert leaks(docs_of(spark, []), bench).count() == 0


def test_licenses_equal_brute_force(spark, sf_dir):
    rng = random.Random(5)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(300).collect()]
    for i, body in enumerate(TEMPLATES.values()):
        at = rng.randrange(200)
        long = text(rng, 200)
        rows.append((10_000 + i, " ".join([*long[:at], body.lower(), *long[at:]])))
        w = body.split()
        rows.append((20_000 + i, " ".join([*long[:at], *w[: len(w) // 2], *long[at:]])))
    rows += [(30_000, None), (30_001, ""), (None, "All rights reserved."), (30_002, "all"), (30_000, None)]
    got = scan_licenses(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    width = {n: min(5, len(words(t))) for n, t in TEMPLATES.items()}
    want = []
    for key, body in rows:
        held = {w: shingles(body, w) for w in set(width.values())}
        names = [n for n, t in TEMPLATES.items() if len(shingles(t, width[n]) & held[width[n]]) / len(shingles(t, width[n])) >= 0.8]
        want.append((key, sorted(names)))
    assert sorted(((r.doc_id, list(r.licenses)) for r in got), key=str) == sorted(want, key=str)
    assert {tuple(r.licenses) for r in scan_licenses(docs_of(spark, rows[:3]), {}).collect()} == {()}
    assert scan_licenses(docs_of(spark, [])).count() == 0


def test_bands_suffice_for_every_template():
    for t in prepared_templates(TEMPLATES):
        n = len(t.shingles)
        shared = -(-4 * n // 5)
        least = shared / ((2 << t.level) + n - shared)
        assert (1 - least) ** values_needed(n, t.level) <= 1e-3
    assert jaccard({1}, {1}) == 1


def test_alignment_finds_nearly_all_that_line_dedup_deletes(spark, sf_dir):
    got = deduplicated_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"), counts=True)
    found = got.selectExpr("sum(removed_lines) r", "sum(aligned_lines) a", "sum(looked_up_lines) l").first()
    assert found.r == found.a + found.l and found.a >= 0.95 * found.r > 0


def test_line_dedup_with_rare_and_frequent_lines(spark):
    """Passages held by few and by many documents, parts of them in other documents, and odd columns."""
    rng = random.Random(11)
    line = [" ".join(text(rng, n)) for n in (12, 15, 18, 22, 45) * 6]
    rows = []
    for k in range(120):
        i = min(rng.randrange(30), rng.randrange(30))
        own = [" ".join(text(rng, 8)) for _ in range(2)]
        rows.append((f"d{k:03}", [own[0], *line[i : i + rng.randrange(1, 6)], own[1], *line[i % 7 : i % 7 + 2]]))
    given = spark.createDataFrame(
        [(k, "\n".join(t), 1, 2, 3, 4) for k, t in rows], "name string, body string, blocks int, id int, h int, d int"
    )
    out = deduplicated_lines(given, "name", "body")
    assert out.columns == [*given.columns, "removed_lines"]
    got = {r.name: (r.body, r.blocks, r.id, r.h, r.d) for r in out.collect()}
    for k, mine in rows:
        count = [len(x.split()) for x in mine]
        gone = {j for other, lines in rows if other < k for j in covered(lines, mine, count, 40)}
        assert got[k] == ("\n".join(x for j, x in enumerate(mine) if j not in gone), 1, 2, 3, 4)
