"""Language identification by the nearest of several centroids per language.

A text is a TF-IDF vector of its letter n-grams (one to three letters, words
set apart), hashed into a fixed number of dimensions and brought to length one.
The training texts of a language are clustered; a text gets the language of the
centroid with the largest cosine, and is rejected if it is farther from that
centroid than nearly all of the centroid's own training texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import on_workers, slices
from millrace.llm.samples import sampled
from millrace.llm.textarrays import CHUNK_CHARS, U, codes_of

DIMENSIONS = 2048
CLUSTERS = 4
#: Training texts per language, and the share of them that lie beyond the rejection distance.
PER_LANGUAGE = 1500
BEYOND = 0.002
UNKNOWN = "und"


@cache
def _alphabet() -> np.ndarray:
    """Lower-case code of each letter; 0 for what is not a letter."""
    chars = [chr(i) for i in range(0x110000)]
    return np.fromiter((ord(c.lower()[0]) if c.isalpha() else 0 for c in chars), np.uint64, len(chars))


def ngram_counts(texts: list[str], dimensions: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed n-grams, one row per text, and whether a text has letters."""
    codes, starts = codes_of(texts)
    letter = _alphabet()[codes]
    doc = np.repeat(np.arange(len(texts)), np.diff(starts))
    has = np.bincount(doc[letter > 0], minlength=len(texts)) > 0
    keep = letter > 0  # a run of other characters is one break
    keep[1:] |= letter[:-1] > 0
    letter, doc = letter[keep], doc[keep]
    total = np.zeros(len(texts) * dimensions)
    gram = np.zeros(len(letter), U)
    for n in range(3):
        if len(letter) <= n:
            break
        gram = gram[: len(letter) - n] * U(0x9E3779B97F4A7C15) + letter[n:]
        inside = doc[n:] == doc[: len(doc) - n]
        at = ((gram * U(0xD6E8FEB86659FD93)) >> U(40)) % U(dimensions)
        where = doc[: len(doc) - n] * dimensions + at.astype(np.int64)
        total += np.bincount(where[inside], minlength=len(total))
    return total.reshape(len(texts), dimensions), has


def unit_vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (np.log1p(counts) * idf).astype(np.float32)
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-12)


def cluster(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; it starts from texts far from each other."""
    centre = [x[np.argmax(x @ x.mean(0))]]
    while len(centre) < min(k, len(x)):
        centre.append(x[np.argmin((x @ np.array(centre).T).max(1))])
    c = np.array(centre)
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        for i in range(len(c)):
            if (own == i).any():
                m = x[own == i].mean(0)
                c[i] = m / max(np.sqrt((m * m).sum()), 1e-12)
    return c


def _counts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column("body").to_pylist()
        for i, j in slices(np.fromiter(map(len, texts), np.int64, len(texts)), CHUNK_CHARS):
            counts, has = ngram_counts(texts[i:j])
            vectors = pa.array(list(counts[has].astype(np.float32)), pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays(
                [b.column("label").slice(i, j - i).filter(pa.array(has)), vectors], names=["label", "counts"]
            )


def fit(
    rows: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", per_label: int = PER_LANGUAGE
) -> dict:
    """Learn centroids from a bounded sample: ``per_label`` rows of each language, by hash
    of the key. A language's sample is clustered in one task; the driver gets the
    document frequencies and the centroids."""
    on_workers(rows)
    picked = rows.filter(sampled(rows, key, label, per_label)).select(
        F.col(label).alias("label"), F.coalesce(F.col(text), F.lit("")).alias("body")
    )
    vectors = picked.mapInArrow(_counts_of, "label string, counts array<float>").persist()

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(DIMENSIONS), 0
        for b in batches:
            if len(b):
                total += (np.vstack(b["counts"]) > 0).sum(0)
                n += len(b)
        yield pd.DataFrame({"df": [total], "n": [n]})

    parts = vectors.mapInPandas(frequencies, "df array<double>, n long").toPandas()
    seen = int(parts["n"].sum())
    if not seen:
        vectors.unpersist()
        return {"labels": [], "centroids": np.zeros((0, DIMENSIONS), np.float32), "least": np.zeros(0), "idf": None}
    idf = np.log((1 + seen) / (1 + np.vstack(parts["df"]).sum(0))) + 1

    def centroids(group: pd.DataFrame) -> pd.DataFrame:
        x = unit_vectors(np.vstack(group["counts"]), idf)
        c = cluster(x, CLUSTERS)
        near = x @ c.T
        own = near.argmax(1)
        least = [float(np.quantile(near[own == i, i], BEYOND)) if (own == i).any() else 1.0 for i in range(len(c))]
        return pd.DataFrame({"label": group["label"].iloc[0], "centroid": list(c), "least": least})

    found = vectors.groupBy("label").applyInPandas(centroids, "label string, centroid array<float>, least double")
    found = found.toPandas().sort_values("label", kind="stable")
    vectors.unpersist()
    return {
        "labels": found["label"].tolist(),
        "centroids": np.vstack(found["centroid"]).astype(np.float32),
        "least": found["least"].to_numpy(),
        "idf": idf,
    }


def predict(rows: DataFrame, model: dict, key: str = "doc_id", text: str = "text", extra: Column | None = None) -> DataFrame:
    """``key, held_out, lang_pred, score, rejected`` for every row.

    ``score`` is the cosine to the nearest centroid. A text that is NULL or has no
    letter is ``und`` with score 0; so is every text if nothing could be learned.
    ``rejected`` marks texts too far from the language they are nearest to. Ties go
    to the first language in order of name. Repeated rows each get a row.
    """
    shared = on_workers(rows).sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            texts = b.column("body").to_pylist()
            for i, j in slices(np.fromiter(map(len, texts), np.int64, len(texts)), CHUNK_CHARS):
                labels, score, far = [UNKNOWN] * (j - i), np.zeros(j - i), np.zeros(j - i, bool)
                if m["labels"]:
                    counts, has = ngram_counts(texts[i:j])
                    near = unit_vectors(counts, m["idf"]) @ m["centroids"].T
                    best = near.argmax(1)
                    score = np.where(has, np.clip(near[np.arange(j - i), best], 0, 1), 0).astype(float)
                    far = has & (score < m["least"][best])
                    labels = [m["labels"][k] if h else UNKNOWN for k, h in zip(best, has)]
                part = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [part.column("k"), part.column("held_out"), pa.array(labels, pa.string()), pa.array(score), pa.array(far)],
                    names=[key, "held_out", "lang_pred", "score", "rejected"],
                )

    held = F.lit(False) if extra is None else extra
    given = rows.select(F.col(key).alias("k"), held.alias("held_out"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    kind = rows.schema[key].dataType.simpleString()
    return given.mapInArrow(run, f"{key} {kind}, held_out boolean, lang_pred string, score double, rejected boolean")
