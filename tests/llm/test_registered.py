"""Registered queries without SQL, on the smallest folder, against brute force or the contract's rules."""

from __future__ import annotations

import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm.queries import QUERIES
from tests.llm.helpers import near_classes


@pytest.fixture(scope="module")
def folder(sf_dir):
    return os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")


@pytest.fixture(scope="module")
def texts(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in rows}


def named(name):
    return next(q for n, q in QUERIES.items() if n.split("_")[0] == name)


@pytest.mark.parametrize("name", ["op3", "op9"])
def test_predictions_cover_all_documents(spark, folder, texts, name):
    got = {r.doc_id: r for r in named(name)(spark, folder).collect()}
    assert set(got) == set(texts)
    for key, r in got.items():
        assert r.held_out == (zlib.crc32(str(key).encode()) % 4 == 2) and 0 <= r.score <= 1
        if name == "op9":
            assert r.predicted == int(r.score >= 0.7)
        else:
            assert r.lang_pred


def test_token_counts_equal_the_library(spark, folder, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {k: (len(t.encode()), len(library.encode(t, add_special_tokens=False).ids)) for k, t in texts.items()}
    got = named("op6")(spark, folder).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got} == want and len(got) == len(texts)
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got)


def test_packing_holds_every_token_once(spark, folder, texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, sequences = {}, {}
    for r in named("op7")(spark, folder).collect():
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(pieces) == set(texts)
    for key, rows in pieces.items():
        ids = [*library.encode(texts[key], add_special_tokens=False).ids, 0]
        at = 0
        for r in sorted(rows, key=lambda r: r.start):
            part = np.array(ids[at : at + r.length], "<u4")
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(part.tobytes()))
            at += r.length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024


def test_near_duplicate_classes(spark, folder, texts):
    got = {r.doc_id: r.class_id for r in named("op8")(spark, folder).select("doc_id", "class_id").collect()}
    assert got == near_classes(texts)


def test_neighbours_against_all_pairs(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    found = {}
    for r in named("op10")(spark, folder).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = total = 0
    for i in np.flatnonzero(ids % 50 == 0):
        score = x @ x[i]
        best = [k for k in np.lexsort((ids, -score)) if k != i][:5]
        mine = sorted(found[ids[i]])
        assert [m[0] for m in mine] == list(range(1, len(best) + 1))
        for _, vec, s in mine:
            assert abs(score[ids == vec][0] - s) < 1e-9
        hits += len({m[1] for m in mine} & set(ids[best]))
        total += len(best)
    assert hits >= 0.9 * total


@pytest.mark.parametrize("name", ["op1", "op4"])
def test_text_queries_run(spark, folder, texts, name):
    rows = named(name)(spark, folder).collect()
    assert {r.doc_id for r in rows} <= set(texts)
    if name == "op1":
        assert len(rows) == len(texts)
        assert all(r.removed_lines == r.aligned_lines + r.looked_up_lines for r in rows)
        assert all(r.text == texts[r.doc_id] for r in rows if r.text is not None and not r.removed_lines)
