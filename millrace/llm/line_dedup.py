"""Passages that repeat across documents, deleted by pairwise alignment of lines.

Documents are read as lists of line hashes, and every line gets its document
frequency. A passage that repeats lies in a run of lines of which each is in
another document too, so only such runs with enough words ask for a partner. Their rare
lines, those of at most ``RARE`` documents, pair each holder with the earlier
ones. What has frequent lines only (a passage that a million documents share)
is paired through the least windows of lines with enough words, each anchored at
the first document (least key) that holds it: one pair per document, never all.

The two documents of a pair are aligned by patience diff: lines that occur once
in both are matched along their longest increasing subsequence, then the gaps
between them in the same way. Aligned blocks of enough words are deleted from the
later document. Windows that reach into a gap of the alignment, because their
lines repeat or passages changed places, are looked up in the earlier document by
hash. The first document that holds a line always keeps it.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import on_workers, stored
from millrace.llm.textarrays import U, mix

MIN_WORDS = 40
#: A line in more documents than this is frequent: its holders are not paired with each other.
RARE = 4
#: Base of the rolling hashes of windows; 3 modulo 8, so that powers of it differ from each other in low bits.
BASE = U(0x9E3779B97F4A7C13)
INVERSE = U(pow(int(BASE), -1, 1 << 64))


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest part of ``pairs`` (ascending in the first) that ascends in the second."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        pile = bisect_left(tops, j)
        back.append(at[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(j)
            at.append(k)
        else:
            tops[pile], at[pile] = j, k
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def patience(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Matched places of two lists, ascending in both."""
    matched, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, i2, j, j2 = todo.pop()
        while i < i2 and j < j2 and a[i] == b[j]:
            matched.append((i, j))
            i, j = i + 1, j + 1
        while i < i2 and j < j2 and a[i2 - 1] == b[j2 - 1]:
            i2, j2 = i2 - 1, j2 - 1
            matched.append((i2, j2))
        if i == i2 or j == j2:
            continue
        in_a, in_b = Counter(a[i:i2]), Counter(b[j:j2])
        place = {b[k]: k for k in range(j, j2) if in_b[b[k]] == 1}
        both = [(k, place[a[k]]) for k in range(i, i2) if in_a[a[k]] == 1 and a[k] in place]
        anchors = _increasing(both)
        if anchors:
            ends = [*anchors, (i2, j2)]
            todo.append((i, ends[0][0], j, ends[0][1]))
            # Each gap begins at its anchor, which matches as the common beginning.
            todo += [(p, p2, q, q2) for (p, q), (p2, q2) in zip(anchors, ends[1:])]
    return sorted(matched)


def windows(
    hashes: np.ndarray, words: np.ndarray, starts: np.ndarray, least: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``document, first line, end, hash`` of the windows of lines that have ``least`` words or
    more, but fewer without their last line or without their first line.

    Document d is lines ``starts[d]`` to ``starts[d + 1]``. Each line of a passage of ``least``
    words is in a window that is inside the passage, and all who hold the passage have that window.
    """
    n = len(hashes)
    upto = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    least = max(least, 1)
    at = np.arange(n)
    end = np.searchsorted(upto, upto[:-1] + least, "left")
    ahead = end <= starts[doc + 1]
    begin = np.searchsorted(upto, upto[1:] - least, "right") - 1
    back = begin >= starts[doc]
    both = np.unique(np.concatenate([at[ahead] * (n + 1) + end[ahead], begin[back] * (n + 1) + at[back] + 1]))
    first, end = both // (n + 1), both % (n + 1)
    power, inverse = (np.cumprod(np.concatenate([np.ones(1, U), np.full(n, x)])) for x in (BASE, INVERSE))
    sums = np.concatenate([np.zeros(1, U), np.cumsum(mix(hashes.astype(np.int64).view(U) + BASE) * power[:n])])
    return doc[first], first, end, mix((sums[end] - sums[first]) * inverse[first] + (end - first).astype(U))


def shared_lines(a: Sequence[int], b: Sequence[int], words: Sequence[int], least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each line of ``b``: is it in an aligned block of ``least`` words or more, and is it in any
    run of so many words that ``a`` holds too."""
    aligned, run = np.zeros(len(b), bool), []
    for pair in [*patience(a, b), (-2, -2)]:
        if run and pair != (run[-1][0] + 1, run[-1][1] + 1):
            if sum(words[j] for _, j in run) >= least:
                aligned[run[0][1] : run[-1][1] + 1] = True
            run = []
        run.append(pair)
    shared = aligned.copy()
    mine = np.asarray(b, np.int64)
    if np.isin(mine[~aligned], np.asarray(a, np.int64)).any():
        _, first, end, name = windows(mine, np.asarray(words), np.array([0, len(b)]), least)
        gaps = np.concatenate([[0], np.cumsum(~aligned)])
        open_ = gaps[end] > gaps[first]
        # Lines have equal words wherever they are, so those of a are known as far as b has the line.
        of = dict(zip(b, words))
        known = np.array([of.get(x, least) for x in a], np.int64)
        held = windows(np.asarray(a), known, np.array([0, len(a)]), least)[3]
        found = open_ & np.isin(name, held)
        for i, j in zip(first[found], end[found]):
            shared[i:j] = True
    return aligned, shared


def _ranges(inside: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], inside, [0]])))
    return [(int(i), int(j) - 1) for i, j in edges.reshape(-1, 2)]


def aligned_blocks(a: Sequence[int], b: Sequence[int], words: Sequence[int], least: int) -> list[tuple[int, int]]:
    """Line ranges of ``b`` (last line included) that are lines in a row of ``a`` too and have
    ``least`` words or more: the aligned ones, and what the alignment leaves because lines
    repeat or passages changed places."""
    return _ranges(shared_lines(a, b, words, least)[1])


def _posts(least: int, rare: int):
    """``id, h, hot, name``: for the runs of repeated lines with ``least`` words, the rare lines and
    the windows that have no rare line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("lines")
            place, words, line, docs = (lists.flatten().field(k).to_numpy(zero_copy_only=False) for k in range(4))
            owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            begins = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (place[1:] != place[:-1] + 1)])[: len(line)])
            _, first, end, name = windows(line, words, np.append(begins, len(line)), least)
            rares = docs <= rare
            upto = np.concatenate([[0], np.cumsum(rares)])
            hot = upto[end] == upto[first]
            reach = np.zeros(len(line) + 1, np.int64)
            np.add.at(reach, first, 1)
            np.add.at(reach, end, -1)
            asks = np.flatnonzero(rares & (np.cumsum(reach)[: len(line)] > 0))
            at = np.concatenate([owner[asks], owner[first[hot]]])
            names = np.concatenate([line[asks], name[hot].view(np.int64)])
            kind = np.concatenate([np.zeros(len(asks), bool), np.ones(int(hot.sum()), bool)])
            order = np.lexsort((names, kind, at))
            at, names, kind = at[order], names[order], kind[order]
            new = np.ones(len(at), bool)
            new[1:] = (at[1:] != at[:-1]) | (names[1:] != names[:-1]) | (kind[1:] != kind[:-1])
            rows = pa.array(at[new])
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(rows), b.column("h").take(rows), pa.array(kind[new]), pa.array(names[new])],
                names=["id", "h", "hot", "name"],
            )

    return run


def _through_blanks(a: list[int], b: list[int], words: list[int], least: int) -> list[dict]:
    """Blocks of lines that are not blank, as places among all lines of ``b``, and whether they are
    aligned. The blank lines after a block go with it, and those at the beginning of ``b`` with a
    block that follows them."""
    places = [k for k, n in enumerate(words) if n]
    aligned, shared = shared_lines(a, [b[k] for k in places], [words[k] for k in places], least)
    after = [*places[1:], len(b)]
    return [
        {"first": places[i] if i else 0, "last": after[j] - 1, "aligned": kind}
        for kind, inside in ((True, aligned), (False, shared & ~aligned))
        for i, j in _ranges(inside)
    ]


BLOCKS = "array<struct<first:int,last:int,aligned:boolean>>"


def _align(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("aligned", pa.bool_())]))
        for b in batches:
            out = [_through_blanks(x, y, w, least) for x, y, w in zip(*(b.column(c).to_pylist() for c in ("a", "b", "words")))]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("h"), pa.array(out, kind)], names=["id", "h", "blocks"])

    return run


def _pairs(lines: DataFrame, kind: str, min_words: int) -> DataFrame:
    """``id, h, earlier, earlier_h``: each later row with the earlier rows that it is aligned with."""
    full = F.filter(F.arrays_zip("words", "hashes"), lambda x: x["words"] > 0)
    each = lines.select("id", "h", F.explode(F.array_distinct(F.transform(full, lambda x: x["hashes"]))).alias("line"))
    shared = stored(each.groupBy("line").agg(F.count("*").alias("docs")).filter("docs > 1"), "frequencies")
    placed = lines.select("id", "h", F.posexplode(full).alias("place", "x")).select("id", "h", "place", "x.words", F.col("x.hashes").alias("line"))
    runs = placed.join(shared, "line").groupBy("id", "h").agg(
        F.sort_array(F.collect_list(F.struct("place", "words", "line", "docs"))).alias("lines")
    )
    posts = stored(runs.mapInArrow(_posts(min_words, RARE), f"id {kind}, h long, hot boolean, name long"), "posts")
    row = F.struct("id", "h")
    # At most RARE rows hold a rare line.
    holders = posts.filter("NOT hot").groupBy("name").agg(F.collect_set(row).alias("rows"))
    near = holders.select("rows", F.explode("rows").alias("e")).select(
        "e", F.explode(F.filter("rows", lambda r: r["id"] > F.col("e")["id"])).alias("l")
    )
    frequent = posts.filter("hot")
    first = frequent.groupBy("name").agg(F.min(row).alias("e"), F.max("id").alias("last")).filter("e.id < last")
    anchored = frequent.join(first.select("name", "e"), "name").filter("e.id < id").select("e", row.alias("l"))
    return near.union(anchored).select("l.id", "l.h", F.col("e.id").alias("earlier"), F.col("e.h").alias("earlier_h")).distinct()


def repeated_blocks(docs: DataFrame, key: str, text: str, min_words: int) -> DataFrame:
    """``id, h, blocks``: the line ranges to delete from the documents that lose any. A document is
    known by its key and a hash of its text."""
    on_workers(docs)
    kind = docs.schema[key].dataType.simpleString()
    trimmed = F.transform(F.split(F.col(text), "\n"), lambda s: F.trim(s))
    lines = docs.filter(F.col(key).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).alias("id"), F.xxhash64(F.col(text)).alias("h"), trimmed.alias("t")
    )
    lines = lines.select(
        "id",
        "h",
        F.transform("t", lambda s: F.xxhash64(s)).alias("hashes"),
        F.transform("t", lambda s: F.when(s == "", 0).otherwise(F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit(""))) + 1)).alias("words"),
    )
    lines = stored(lines.dropDuplicates(["id", "h"]), "lines")
    asked = stored(_pairs(lines, kind, min_words), "asked")
    later = asked.join(lines.select("id", "h", F.col("hashes").alias("b"), "words"), ["id", "h"])
    full = F.filter("hashes", lambda h: h != F.xxhash64(F.lit("")))
    held = lines.select(F.col("id").alias("earlier"), F.col("h").alias("earlier_h"), full.alias("a"))
    found = later.join(held, ["earlier", "earlier_h"]).select("id", "h", "a", "b", "words").mapInArrow(
        _align(min_words), f"id {kind}, h long, blocks {BLOCKS}"
    )
    found = found.select("id", "h", F.explode("blocks").alias("block")).groupBy("id", "h")
    return found.agg(F.collect_set("block").alias("blocks"))


def deduplicated_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, counts: bool = False
) -> DataFrame:
    """All rows and columns of ``docs``, with ``text`` less its repeated blocks, and
    ``removed_lines``, the number of lines deleted. With ``counts`` also ``aligned_lines``, those
    of them in an aligned block, and ``looked_up_lines``, the others.

    Lines are compared without white space at their ends, and blank lines do not part
    or distinguish passages; those after a deleted block go with it. A document is earlier
    than another if its key, of any type with an order, is smaller; rows with equal keys are not
    compared with each other. Rows with a NULL key or text stay as they are, and texts that
    repeat an earlier document whole become empty. A text of any length is one list of line
    hashes. An empty table gives an empty result. Existing columns of the added names are
    replaced; other columns may have any name.
    """
    blocks = stored(repeated_blocks(docs, key, text, min_words), "blocks")
    added = ["removed_lines", "aligned_lines", "looked_up_lines"] if counts else ["removed_lines"]
    columns = [c for c in docs.columns if c not in added]
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("d"), F.col(key).alias("id"), F.xxhash64(F.col(text)).alias("h"))
    # Always a shuffle of the texts: what is joined grows with them, and the plan is the same at every size.
    rows = given.join(blocks.hint("merge"), ["id", "h"], "left")
    body = F.col("d")[text]
    split = F.split(body, "\n")

    def inside(i: Column, found: Column | str) -> Column:
        return F.exists(found, lambda b: (i >= b["first"]) & (i <= b["last"]))

    kept = F.filter(split, lambda s, i: ~inside(i, "blocks"))
    aligned = F.filter(split, lambda s, i: inside(i, F.filter("blocks", lambda b: b["aligned"])))
    none = F.col("blocks").isNull()
    removed = F.when(none, 0).otherwise(F.size(split) - F.size(kept))
    by_alignment = F.when(none, 0).otherwise(F.size(aligned))
    new = F.when(none, body).otherwise(F.array_join(kept, "\n"))
    done = rows.select("d", new.alias("new"), F.struct(removed.alias("col1"), by_alignment.alias("col2"), (removed - by_alignment).alias("col3")).alias("n"))
    return done.select(
        *[F.col("new").alias(c) if c == text else F.col("d")[c].alias(c) for c in columns],
        *[F.col("n")[f"col{i + 1}"].alias(c) for i, c in enumerate(added)],
    )
