"""Near-duplicate documents by ProbMinHash, banding and verification.

A document is the multiset of its five-word shingles. The signature has the
collision probability of the probability Jaccard similarity of the weighted
shingles: each shingle is a Poisson process whose rate is its weight, every
arrival picks a register, a register keeps the shingle of its first arrival,
and a document is done when no later arrival can be the first anywhere. A document
that repeats shingles has a second signature with all weights 1, whose collision
probability is the Jaccard similarity of the sets; both kinds of bands share buckets.

Documents that agree in all values of a band share a bucket. Buckets are never
expanded into all pairs: a first leader of each bucket is compared with the
members, then the member nearest to it, which in a group of altered copies is
the text that they are copies of. Where members of a bucket are still in several
classes afterwards, signatures are compared block by block, and pairs that
promise a new link are verified there; a block is small whatever the bucket, and
gives no more links than it has members. Comparisons are exact on shingles, and
links make connected components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import on_workers, slices, stored
from millrace.llm.components import connected_components
from millrace.llm.textarrays import CHUNK_CHARS, U, mix, shingles

#: At a similarity of 0.8 two texts share a band with a probability of 0.997 at 32 x 8 and 0.99998 at 48 x 7.
BANDS, ROWS = 48, 7
THRESHOLD = 0.8
#: Members of a block, where a bucket is still in several classes after two leaders.
BLOCK = 256
#: Agreement of the signatures from which a pair is compared exactly: five standard deviations below THRESHOLD.
WORTH = 0.69


def weighted(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text with their counts: ``text number, shingle, weight``."""
    doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(first)
    return doc[at], hashes[at], np.diff(np.append(at, len(doc)))


def signatures(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, docs: int, size: int) -> np.ndarray:
    """ProbMinHash of ``docs`` texts: in each of ``size`` registers the shingle that arrives first."""
    first = np.full(docs * size, np.inf)
    name = np.zeros(docs * size, U)
    time, state = np.zeros(len(doc)), shingle
    while len(doc):
        state = mix(state + U(0x9E3779B97F4A7C15))
        time = time - np.log(((state >> U(11)).astype(float) + 0.5) / 2.0**53) / weight
        at = doc * size + (mix(state ^ U(0xA0761D6478BD642F)) % U(size)).astype(np.int64)
        np.minimum.at(first, at, time)
        won = time == first[at]
        name[at[won]] = shingle[won]
        late = first.reshape(docs, size).max(1)  # nothing changes after this time; no limit while a register is empty
        on = time < late[doc]
        doc, shingle, weight, time, state = doc[on], shingle[on], weight[on], time[on], state[on]
    return name.reshape(docs, size)


def band_values(names: np.ndarray, bands: int, rows: int) -> np.ndarray:
    total = np.zeros((len(names), bands), U)
    parts = names.reshape(len(names), bands, rows)
    for i in range(rows):
        total = mix(total * U(0xD6E8FEB86659FD93) + parts[:, :, i])
    return mix(total + np.arange(1, bands + 1, dtype=U))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column("body").to_pylist()
        for i, j in slices(np.fromiter(map(len, texts), np.int64, len(texts)), CHUNK_CHARS):
            part = list(dict.fromkeys(texts[i:j]))  # copies within reach are sketched once
            doc, shingle, weight = weighted(*shingles(part))
            names = signatures(doc, shingle, weight, len(part), BANDS * ROWS)
            found, marks = band_values(names, BANDS, ROWS).view(np.int64), (names >> U(56)).astype(np.uint8)
            has = np.bincount(doc, minlength=len(part)) > 0
            of = {t: (found[k].tolist() if has[k] else [], marks[k].tobytes()) for k, t in enumerate(part)}
            repeats = np.unique(doc[weight > 1])
            if len(repeats):
                those = np.isin(doc, repeats)
                own = np.searchsorted(repeats, doc[those])
                names = signatures(own, shingle[those], np.ones(len(own)), len(repeats), BANDS * ROWS)
                found, marks = band_values(names, BANDS, ROWS).view(np.int64), (names >> U(56)).astype(np.uint8)
                for k, more, mark in zip(repeats, found.tolist(), marks):
                    bands, first = of[part[k]]
                    of[part[k]] = (list(dict.fromkeys(bands + more)), first + mark.tobytes())
            rows = b.slice(i, j - i)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("id"), rows.column("content"),
                    pa.array([of[t][0] for t in texts[i:j]], pa.list_(pa.int64())), pa.array([of[t][1] for t in texts[i:j]]),
                ],
                names=["id", "content", "bands", "marks"],
            )


def _multisets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column("body").to_pylist()
        for i, j in slices(np.fromiter(map(len, texts), np.int64, len(texts)), CHUNK_CHARS):
            hashes, starts = shingles(texts[i:j])
            short = (hashes >> U(32)).astype("<u4")
            held = [np.sort(short[s:e]).tobytes() for s, e in zip(starts, starts[1:])]
            yield pa.RecordBatch.from_arrays([b.column("node").slice(i, j - i), pa.array(held)], names=["node", "held"])


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted multisets the larger of the probability Jaccard similarity (counts as
    weights) and the Jaccard similarity of the sets; without repeats they are equal."""
    x, nx = np.unique(a, return_counts=True)
    y, ny = np.unique(b, return_counts=True)
    common, ix, iy = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    plain = len(common) / (len(x) + len(y) - len(common))
    if nx.max() == 1 and ny.max() == 1:
        return plain
    # For a shared d the term is 1 / sum over all e of max(x_e / x_d, y_e / y_d), from running sums by y_e / x_e.
    wx, wy = nx[ix].astype(float), ny[iy].astype(float)
    ratio = wy / wx
    order = np.argsort(ratio)
    ratio, wx, wy = ratio[order], wx[order], wy[order]
    upto = np.cumsum(wx)[np.searchsorted(ratio, ratio, "right") - 1] + nx.sum() - wx.sum()
    above = ny.sum() - wy.sum() + wy.sum() - np.cumsum(wy)[np.searchsorted(ratio, ratio, "right") - 1]
    return max(plain, float((1 / (upto / wx + above / wy)).sum()))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [
            similarity(np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4"))
            for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist())
        ]
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(got, pa.float64())], names=["a", "b", "sim"])


def _links(group: pd.DataFrame) -> pd.DataFrame:
    """Links between members of different classes in a block. Signatures tell which pairs
    are worth an exact comparison; classes that a link joins are not compared again."""
    group = group.drop_duplicates("node")
    # Of a text without repeats the one signature stands for both, weighted and plain.
    size = BANDS * ROWS
    marks = np.frombuffer(b"".join(m if len(m) > size else m * 2 for m in group["marks"]), np.uint8).reshape(-1, 2, size)
    node, held = group["node"].to_numpy(), [np.frombuffer(h, "<u4") for h in group["held"]]
    own, found = group["class"].to_numpy().copy(), []
    for i in range(len(group)):
        near = (marks[i + 1 :] == marks[i]).mean(2).max(1) >= WORTH
        for k in np.flatnonzero(near & (own[i + 1 :] != own[i])) + i + 1:
            if own[i] != own[k] and similarity(held[i], held[k]) >= THRESHOLD:
                found.append((node[i], node[k]))
                own[own == own[k]] = own[i]
    return pd.DataFrame(found, columns=["a", "b"]).astype("int64")


def _verified(pairs: DataFrame, sets: DataFrame, label: str) -> DataFrame:
    """``a, b, sim`` of distinct pairs, in the order given."""
    rows = pairs.join(sets.select(F.col("node").alias("b"), F.col("held").alias("y")), "b")
    rows = rows.join(sets.select(F.col("node").alias("a"), F.col("held").alias("x")), "a")
    return stored(rows.select("a", "b", "x", "y").mapInArrow(_compare, "a long, b long, sim double"), label)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, class_id, keep`` for every row whose key is not NULL: documents are of one
    class if links of a similarity of ``THRESHOLD`` or more connect them; a class has
    the name of its least key, and that document is the one to keep.

    NULL and empty texts are copies of each other. Rows with equal keys are one
    document, with one of its texts if they differ. Shingles are compared by 32 bits
    of their hashes. An empty table gives an empty result.
    """
    on_workers(docs)
    body = F.coalesce(F.col(text), F.lit(""))
    given = docs.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("id"), F.md5(body).alias("content"), body.alias("body")
    )
    rows = stored(given.mapInArrow(_sketch, "id long, content string, bands array<long>, marks binary"), "sketches")
    # One node for each distinct text, named by its least key.
    sketch = F.any_value(F.struct("bands", "marks")).alias("s")
    nodes = stored(rows.groupBy("content").agg(F.min("id").alias("node"), sketch).select("content", "node", "s.*"), "nodes")
    posted = nodes.select("node", F.explode("bands").alias("bucket"))
    buckets = posted.groupBy("bucket").agg(F.min("node").alias("leader"), F.max("node").alias("other"))
    buckets = stored(buckets.filter(F.col("leader") < F.col("other")).drop("other"), "buckets")
    members = stored(posted.join(buckets, "bucket").distinct(), "members")
    asked = stored(members.select("node").distinct().join(nodes.select("node", "content"), "node"), "asked")
    # The documents asked for grow with the input, so texts are shuffled at every size.
    wanted = asked.select("node", "content").hint("merge")
    texts = given.join(wanted, (F.col("id") == F.col("node")) & (given["content"] == asked["content"]))
    texts = texts.groupBy("node").agg(F.any_value("body").alias("body"))
    sets = stored(texts.mapInArrow(_multisets, "node long, held binary"), "multisets")

    pairs = members.filter(F.col("node") != F.col("leader")).select(F.col("leader").alias("a"), F.col("node").alias("b"))
    first = _verified(pairs.distinct(), sets, "pairs")
    linked = F.col("sim") >= THRESHOLD
    # The nearest member of a bucket leads it next, where the first leader leaves members apart.
    near = (
        members.join(first, (F.col("leader") == F.col("a")) & (F.col("node") == F.col("b")))
        .groupBy("bucket")
        .agg(F.max(F.struct("sim", "node")).alias("best"), F.min("sim").alias("worst"))
        .filter(F.col("worst") < THRESHOLD)
        .select("bucket", F.col("best.node").alias("second"))
    )
    near = stored(near, "second")
    again = members.join(near, "bucket").filter((F.col("node") != F.col("second")) & (F.col("node") != F.col("leader")))
    again = again.select(F.col("second").alias("a"), F.col("node").alias("b")).distinct()
    second = _verified(again, sets, "pairs")
    edges = first.filter(linked).unionByName(second.filter(linked)).select("a", "b")
    classes = stored(connected_components(edges), "classes")

    # Buckets whose members are still in several classes: members of different ones are compared in blocks.
    apart = members.join(near.select("bucket"), "bucket", "left_semi").join(
        classes.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left"
    )
    apart = stored(apart.select("bucket", "node", F.coalesce("component", "node").alias("class")), "apart")
    mixed = apart.groupBy("bucket").agg(
        F.min("class").alias("low"), F.max("class").alias("high"), F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
    )
    # Of buckets with the same members one is compared.
    mixed = mixed.filter("low < high").groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket"))
    mixed = stored(mixed.select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts")), "mixed")
    left = apart.join(mixed, "bucket").withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    left = left.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    left = left.join(nodes.select(F.col("node").alias("n"), "marks"), F.col("node") == F.col("n")).join(sets, "node")
    block = left.select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "class", "marks", "held")
    third = stored(block.groupBy("bucket", "i", "j").applyInPandas(_links, "a long, b long"), "links")
    if not third.isEmpty():
        classes = stored(connected_components(edges.unionByName(third)), "classes")

    named = nodes.select("content", "node").join(classes, "node", "left").select(
        "content", F.coalesce("component", "node").alias("class_id")
    )
    named = stored(named, "named")
    kind = docs.schema[key].dataType
    return rows.select("id", "content").join(named, "content").select(
        F.col("id").cast(kind).alias(key), F.col("class_id").cast(kind), (F.col("id") == F.col("class_id")).alias("keep")
    )


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class, with all columns; rows with a NULL key stay as they are."""
    kept = stored(near_duplicates(docs, key, text).filter("keep").select(F.col(key).alias("k")).distinct(), "kept")
    given = docs.select(F.struct("*").alias("d"), F.col(key).alias("k"), F.xxhash64(F.col(text)).alias("h"))
    rows = given.join(kept.hint("merge"), "k", "left_semi")
    first = rows.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("h"))).filter(F.col("n") == 1)
    return first.select("d.*").unionByName(docs.filter(F.col(key).isNull()))
