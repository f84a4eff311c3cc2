"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. The field scores a line by its own features and by
those of the lines before and after it, and each step from line to line by
whether the label changes. Marginals from forward-backward, weighted by line
length, give the share of good text in a document, and a fitted curve turns
that share into the probability of the label 1.

Labels exist for documents only, so training starts with each line labelled as
its document; later rounds relabel the lines of bad documents which the field
itself finds good. It learns from whole chains of lines that a hash picks from all over
a document; the curve is fitted on the shares of whole texts.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import on_workers, slices, stored
from millrace.llm.samples import sampled
from millrace.llm.textarrays import CHUNK_CHARS, U, codes_of, mix
from millrace.llm.textarrays import words as word_hashes

#: Training documents per label, and chains of a training document at most: a longer one is learned
#: from the chains with the least hashes, wherever they are in it.
PER_LABEL = 1500
TRAIN_CHAINS = 8
#: Training cuts documents into chains of this many lines.
CHAIN = 64
#: What a line costs beside its characters, in characters, when work is cut into pieces.
LINE_COST = 64
STEPS, ROUNDS, RATE, RIDGE = 120, 2, 0.15, 1e-3
THRESHOLD = 0.7

LOWER, UPPER, DIGIT, SPACE, STOP, BANG, BAR, OTHER = range(8)
OWN = 15


@cache
def _classes() -> np.ndarray:
    chars = [chr(i) for i in range(0x110000)]
    kind = np.full(len(chars), OTHER, np.int64)
    for test, value in ((str.isalpha, LOWER), (str.isupper, UPPER), (str.isdigit, DIGIT), (str.isspace, SPACE)):
        kind[np.fromiter(map(test, chars), bool, len(chars))] = value
    kind[[ord(c) for c in ".,;:?'\"()-’“”«»¿¡…"]] = STOP
    kind[ord("!")] = BANG
    kind[[ord(c) for c in "|\t"]] = BAR
    return kind


def lines_of(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """All lines in a row, whether each is a repeated one of its text, and where each text's lines
    begin (with the end as last entry). A text has one line at least."""
    split = [t.split("\n") for t in texts]
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, split), np.int64, len(split)), out=bounds[1:])
    lines, again = [], np.zeros(bounds[-1], bool)
    for start, part in zip(bounds, split):
        if len(part) > 1:
            seen = Counter(part)
            again[start : start + len(part)] = [x != "" and seen[x] > 1 for x in part]
        lines += part
    return lines, again, bounds


def _own_features(lines: list[str], again: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of each line by itself, and its length."""
    codes, starts = codes_of(lines)
    kind = _classes()[codes]
    line = np.repeat(np.arange(len(lines)), np.diff(starts))
    count = np.bincount(line * 8 + kind, minlength=8 * len(lines)).reshape(-1, 8).astype(float)
    length = np.diff(starts).astype(float)
    spaces = kind == SPACE
    begins = ~spaces
    begins[1:] &= spaces[:-1] | (line[1:] != line[:-1])
    words = np.bincount(line[begins], minlength=len(lines))
    word, word_at = word_hashes(lines)
    twice = np.zeros(len(word) + 1)  # words that repeat the one before
    np.cumsum(np.append(False, word[1:] == word[:-1])[: len(word)], out=twice[1:])
    stutter = (twice[word_at[1:]] - twice[np.minimum(word_at[:-1] + 1, word_at[1:])]) / np.maximum(np.diff(word_at), 1)
    n, letters = np.maximum(length, 1), count[:, LOWER] + count[:, UPPER]
    own = np.column_stack(
        [
            np.ones(len(lines)), np.log1p(length) / 5, count[:, UPPER] / np.maximum(letters, 1), count[:, DIGIT] / n,
            count[:, OTHER] / n * 5, count[:, BAR] / n * 5, count[:, BANG] / n * 5, count[:, STOP] / n * 5,
            count[:, SPACE] / n, np.minimum(letters / np.maximum(words, 1), 20) / 5, letters / n,
            np.array(again, float), (words < 4).astype(float), (length == 0).astype(float), stutter * 2,
        ]
    )
    return own, length


def line_features(lines: list[str], again: np.ndarray, bounds: np.ndarray, s: int, e: int) -> tuple[np.ndarray, np.ndarray]:
    """Features of the lines from ``s`` to ``e``, neighbours included, and the weight of each."""
    left, right = max(s - 1, 0), min(e + 1, len(lines))
    own, length = _own_features(lines[left:right], again[left:right])
    mine = own[s - left : e - left]
    before, after = np.zeros_like(mine), np.zeros_like(mine)
    before[int(s == left) :] = own[: e - 1 - left]
    after[: right - 1 - s] = own[s + 1 - left :]
    # A missing neighbour also lacks the constant feature.
    before[np.isin(np.arange(s, e), bounds[:-1])] = 0
    after[np.isin(np.arange(s + 1, e + 1), bounds[1:])] = 0
    return np.hstack([mine, before, after]), length[s - left : e - left] + 1


def emissions(texts: list[str], w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Score and weight of each line, and where each text's lines begin. Features are worked out a
    piece at a time, so a line costs a few numbers of memory however many there are."""
    lines, again, bounds = lines_of(texts)
    cost = np.cumsum(np.fromiter(map(len, lines), np.int64, len(lines)) + LINE_COST)
    cuts = [0, *(np.flatnonzero(np.diff(cost // CHUNK_CHARS)) + 1), len(lines)]
    emit, weight = np.empty(len(lines)), np.empty(len(lines))
    for s, e in zip(cuts, cuts[1:]):
        x, weight[s:e] = line_features(lines, again, bounds, s, e)
        emit[s:e] = x @ w
    return emit, weight, bounds


def _chains(bounds: np.ndarray, most: int | None = None) -> list[np.ndarray]:
    """Line numbers of chains, as matrices of chains of similar length, padded with -1."""
    first, n = bounds[:-1], np.diff(bounds)
    if most:
        pieces = [(s, min(most, e - s)) for a, b in zip(first, bounds[1:]) for s in range(a, b, most) for e in (b,)]
        first, n = np.array([p[0] for p in pieces], np.int64), np.array([p[1] for p in pieces], np.int64)
    out = []
    width = np.int64(1)
    while len(n):
        mine = (n <= width) & (n > width // 2)
        if mine.any():
            at = first[mine][:, None] + np.arange(n[mine].max())
            at[np.arange(at.shape[1]) >= n[mine][:, None]] = -1
            out.append(at)
        if width >= n.max():
            break
        width *= 2
    return out


def _step(odds: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Log odds of good after one step, from those before it."""
    return np.logaddexp(odds + move[1, 1], move[0, 1]) - np.logaddexp(odds + move[1, 0], move[0, 0])


def marginals(emit: np.ndarray, at: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For a matrix of chains: log odds of good at each place, and the messages that came
    from before and from after it."""
    e = np.where(at >= 0, emit[at], 0.0)
    ahead, back = np.zeros_like(e), np.zeros_like(e)
    for t in range(1, e.shape[1]):
        ahead[:, t] = _step(ahead[:, t - 1] + e[:, t - 1], move)
    for t in range(e.shape[1] - 2, -1, -1):
        come = _step(back[:, t + 1] + e[:, t + 1], move.T)
        back[:, t] = np.where(at[:, t + 1] >= 0, come, 0.0)
    return ahead + e + back, ahead, back


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _train(x: np.ndarray, y: np.ndarray, weight: np.ndarray, chains: list[np.ndarray], model: dict) -> None:
    """Gradient ascent (Adam) on the likelihood of line labels ``y``; changes ``model``."""
    w, move = model["w"], model["move"]
    mean, square = np.zeros(len(w) + 4), np.zeros(len(w) + 4)
    total = weight.sum()
    for step in range(1, STEPS + 1):
        emit, good, pairs = x @ w, np.zeros(len(x)), np.zeros((2, 2))
        for at in chains:
            odds, ahead, back = marginals(emit, at, move)
            held = at >= 0
            good[at[held]] = _sigmoid(odds[held])
            if at.shape[1] == 1:
                continue
            # Expected moves between neighbours against those of the labels.
            e = np.where(held, emit[at], 0.0)
            left, right = ahead[:, :-1] + e[:, :-1], back[:, 1:] + e[:, 1:]
            score = np.stack([[move[i, j] + i * left + j * right for j in (0, 1)] for i in (0, 1)])
            score = np.exp(score - score.max((0, 1)))
            both = held[:, 1:] * weight[at[:, :-1]]
            expected = (score / score.sum((0, 1)) * both).sum((2, 3))
            label = y[at]
            a, b = label[:, :-1], label[:, 1:]
            seen = np.array([[((1 - a) * (1 - b) * both).sum(), ((1 - a) * b * both).sum()], [(a * (1 - b) * both).sum(), (a * b * both).sum()]])
            pairs += seen - expected
        grad = np.concatenate([x.T @ ((y - good) * weight) / total - RIDGE * w, (pairs / total).ravel() - RIDGE * move.ravel()])
        mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad * grad
        change = RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        w += change[:-4]
        move += change[-4:].reshape(2, 2)


def goodness(emit: np.ndarray, bounds: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Marginal of each line, for chains of lines that begin at ``bounds``."""
    good = np.zeros(len(emit))
    for at in _chains(bounds):
        odds, _, _ = marginals(emit, at, move)
        good[at[at >= 0]] = _sigmoid(odds[at >= 0])
    return good


def _calibrate(share: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic curve over the logit of the share, by Newton's method."""
    z = np.column_stack([np.ones(len(share)), np.log((share + 0.01) / (1.01 - share))])
    c = np.zeros(2)
    for _ in range(50):
        p = _sigmoid(z @ c)
        hessian = (z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(2)
        c += np.linalg.solve(hessian, z.T @ (y - p) - 1e-2 * c)
    return c


def _picked(n: int, text: str) -> list[tuple[int, int]]:
    """Line ranges to learn from in a text of ``n`` lines: at most ``TRAIN_CHAINS`` chains by hash,
    those in a row as one."""
    chains = np.arange(-(-n // CHAIN))
    if len(chains) > TRAIN_CHAINS:
        seed = U(zlib.crc32(text.encode("utf-8", "surrogatepass")))
        chains = np.sort(np.argsort(mix(chains.astype(U) + (seed << U(32))), kind="stable")[:TRAIN_CHAINS])
    parts = np.split(chains, np.flatnonzero(np.diff(chains) > 1) + 1)
    return [(int(p[0]) * CHAIN, min(n, (int(p[-1]) + 1) * CHAIN)) for p in parts]


def _training_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i, text in enumerate(b.column("body").to_pylist()):
            lines, again, bounds = lines_of([text])
            ranges = _picked(len(lines), text)
            xs, weights = zip(*(line_features(lines, again, bounds, s, e) for s, e in ranges))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("k").slice(i, 1),
                    pa.array([np.vstack(xs).astype(np.float32).tobytes()]),
                    pa.array([np.concatenate(weights).tolist()], pa.list_(pa.float64())),
                    pa.array([[e - s for s, e in ranges]], pa.list_(pa.int64())),
                    b.column("label").slice(i, 1),
                ],
                names=["k", "x", "weight", "ranges", "label"],
            )


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    per_label: int = PER_LABEL,
) -> dict:
    """Train on a bounded sample: ``per_label`` documents of each label, by hash of the
    key, with ``TRAIN_CHAINS`` chains of ``CHAIN`` lines each, by hash from the whole text. A key
    with several labels counts with the least, and one with several texts too. Features of the
    sample, not texts, go to the driver; the curve comes from a pass over the sample's whole texts.
    Without training rows every score is one half."""
    on_workers(docs)
    name = F.col(key).cast("string")
    one = labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(key).agg(F.min(label).alias("label"))
    picked = one.filter(sampled(one, key, "label", per_label)).select(name.alias("k"), F.col("label").cast("long").alias("label"))
    given = docs.select(name.alias("k"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    # At most 2 * per_label rows.
    given = given.join(F.broadcast(picked), "k").groupBy("k", "label").agg(F.min("body").alias("body"))
    given = stored(given, "labelled")
    kind = "k string, x binary, weight array<double>, ranges array<long>, label long"
    rows = given.mapInArrow(_training_lines, kind).toPandas().sort_values("k")
    model = {"w": np.zeros(3 * OWN), "move": np.zeros((2, 2)), "curve": np.zeros(2)}
    if not len(rows):
        return model
    parts = [np.frombuffer(b, np.float32).reshape(-1, 3 * OWN) for b in rows["x"]]
    x, line_weight = np.vstack(parts).astype(float), np.concatenate(rows["weight"].to_list())
    n = np.array([len(p) for p in parts])
    first = np.concatenate([[0], np.cumsum(n)[:-1]])
    bounds = np.concatenate([[0], np.cumsum(np.concatenate(rows["ranges"].to_list()))])
    doc_y = rows["label"].to_numpy().astype(float)
    y = np.repeat(doc_y, n)
    # Each label has half of the weight, each document of a label the same, each line by its length.
    doc_weight = np.where(doc_y == 1, 0.5 / max(1, (doc_y == 1).sum()), 0.5 / max(1, (doc_y == 0).sum()))
    weight = line_weight * np.repeat(doc_weight / np.add.reduceat(line_weight, first), n)
    chains = _chains(bounds, CHAIN)
    for turn in range(ROUNDS):
        _train(x, y, weight, chains, model)
        if turn < ROUNDS - 1:
            good = goodness(x @ model["w"], bounds, model["move"])
            y = np.where(np.repeat(doc_y, n) == 1, 1.0, (good > 0.9).astype(float))
    shares = score(given, model, "k", "body").select("k", "good_share").join(given.select("k", "label"), "k").toPandas().sort_values("k")
    model["curve"] = _calibrate(shares["good_share"].to_numpy(), shares["label"].to_numpy().astype(float))
    return model


def _scored(texts: list[str], model: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probability of the label 1, share of good text and number of bad lines, a chunk at a time."""
    out = []
    cost = np.fromiter((len(t) + LINE_COST * (t.count("\n") + 1) for t in texts), np.int64, len(texts))
    for i, j in slices(cost, CHUNK_CHARS):
        emit, weight, bounds = emissions(texts[i:j], model["w"])
        good = goodness(emit, bounds, model["move"])
        share = np.add.reduceat(good * weight, bounds[:-1]) / np.add.reduceat(weight, bounds[:-1])
        p = _sigmoid(model["curve"][0] + model["curve"][1] * np.log((share + 0.01) / (1.01 - share)))
        out.append((p, share, np.add.reduceat((good < 0.5).astype(np.int64), bounds[:-1])))
    if not out:
        return np.zeros(0), np.zeros(0), np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*out))


def score(
    docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text", extra: Column | None = None
) -> DataFrame:
    """``key, held_out, score, predicted, good_share, bad_lines`` for every row.

    A NULL or empty text is one empty line. Repeated rows each get a row; other
    columns are ignored; an empty table gives an empty result. Of a very long text
    one worker holds the lines and a few numbers for each.
    """
    shared = on_workers(docs).sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p, share, bad = _scored(b.column("body").to_pylist(), shared.value)
            found = [pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32)), pa.array(share), pa.array(bad)]
            yield pa.RecordBatch.from_arrays(
                [b.column("k"), b.column("held_out"), *found],
                names=[key, "held_out", "score", "predicted", "good_share", "bad_lines"],
            )

    held = F.lit(False) if extra is None else extra
    given = docs.select(F.col(key).alias("k"), held.alias("held_out"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    kind = docs.schema[key].dataType.simpleString()
    return given.mapInArrow(
        run, f"{key} {kind}, held_out boolean, score double, predicted int, good_share double, bad_lines long"
    )


def accepted(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is ``THRESHOLD`` or more."""
    shared = on_workers(docs).sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(text).to_pylist()]
            yield b.filter(pa.array(_scored(texts, shared.value)[0] >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
