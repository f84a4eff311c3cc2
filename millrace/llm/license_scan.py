"""License notices in documents: MinHash bands over text windows, then containment.

A template of n shingles belongs to the size class L, the least power of two not
below n. Documents are read in windows of 2 L shingles that start every L, so a
notice lies whole inside a window and makes up a good part of it. A window and a
template that agree in one MinHash value (bands of one row) become a candidate.
The number of values follows from the least similarity possible in the class, so
that a notice is missed with a probability below ``MISS``. Candidates are
verified by the exact share of the template's shingles that the window holds.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import on_workers, slices, stored
from millrace.llm.textarrays import CHUNK_CHARS, U, mix, shingles, words

WIDTH = 5
THRESHOLD = 0.8
MISS = 1e-3

#: Short notices and the headers of well-known licenses.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "mit": "Released under the MIT License.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved.",
    "mit-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction, including without "
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of the "
    "License at http://www.apache.org/licenses/LICENSE-2.0",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation",
    "bsd-header": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met",
    "isc-notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "mpl-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}


@dataclass
class Template:
    name: str
    width: int
    shingles: np.ndarray

    @property
    def level(self) -> int:
        return ceil(log(len(self.shingles), 2)) if len(self.shingles) > 1 else 0


def prepared_templates(texts: Mapping[str, str]) -> list[Template]:
    """Distinct shingles of each template; one of fewer than ``WIDTH`` words is one shingle
    of its own width. Templates without words are left out."""
    out = []
    for name, text in texts.items():
        n = len(words([text])[0])
        if n:
            width = min(WIDTH, n)
            out.append(Template(name, width, np.unique(shingles([text], width)[0])))
    return out


def values_needed(n: int, level: int) -> int:
    """MinHash values for which a window that holds ``THRESHOLD`` of a template with ``n``
    shingles is missed with a probability below ``MISS``."""
    shared = ceil(THRESHOLD * n)
    least = shared / ((2 << level) + n - shared)
    return ceil(log(MISS) / log(1 - least)) if least < 1 else 1


def _multipliers(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=U)) | U(1)


def candidates(hashes: np.ndarray, starts: np.ndarray, templates: list[Template]) -> Iterator[tuple[int, int, int, int]]:
    """``text number, template number, begin, end`` of the windows that share a MinHash value."""
    if not len(hashes):
        return
    needed = [values_needed(len(t.shingles), t.level) for t in templates]
    top = max(t.level for t in templates)
    # Blocks of 1, 2, 4, ... shingles: where each begins, and the number of the block each text begins with.
    begins, heads = [np.arange(len(hashes))], [starts]
    for _ in range(top):
        n = (np.diff(heads[-1]) + 1) // 2
        head = np.concatenate([[0], np.cumsum(n)])
        pick = np.repeat(heads[-1][:-1] - 2 * head[:-1], n) + 2 * np.arange(head[-1])
        begins.append(pick)
        heads.append(head)
    hit = [np.zeros(heads[t.level][-1], bool) for t in templates]
    for i, factor in enumerate(_multipliers(max(needed))):
        if not any(i < n for n in needed):
            break
        value = hashes * factor
        for level in range(top + 1):
            if level:
                value = np.minimum.reduceat(value, begins[level])
            mine = [k for k, t in enumerate(templates) if t.level == level and i < needed[k]]
            if mine:
                pair = value.copy()  # a window is a block and the next one of the same text
                pair[:-1] = np.minimum(value[:-1], value[1:])
                last = heads[level][1:][np.diff(heads[level]) > 0] - 1
                pair[last] = value[last]
                for k in mine:
                    hit[k] |= pair == (templates[k].shingles * factor).min()
    for k, t in enumerate(templates):
        for block in np.flatnonzero(hit[k]):
            doc = int(np.searchsorted(heads[t.level], block, "right")) - 1
            begin = int(starts[doc]) + (int(block) - int(heads[t.level][doc])) * (1 << t.level)
            yield doc, k, begin, min(int(starts[doc + 1]), begin + (2 << t.level))


def _windows(templates: list[Template]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("body").to_pylist()
            for i, j in slices(np.fromiter(map(len, texts), np.int64, len(texts)), CHUNK_CHARS):
                rows = b.column("row").slice(i, j - i).to_pylist()
                out = []
                for width in sorted({t.width for t in templates}):
                    hashes, starts = shingles(texts[i:j], width)
                    own = [t for t in templates if t.width == width]
                    for doc, k, begin, end in candidates(hashes, starts, own):
                        held = hashes[begin:end].view(np.int64).tolist()
                        out.append((rows[doc], own[k].name, begin - int(starts[doc]), held))
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[c] for o in out], kinds[c]) for c in range(4)], names=["row", "license", "place", "held"]
                )

    return run


def scan_licenses(
    docs: DataFrame, texts: Mapping[str, str] = TEMPLATES, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, licenses, matches`` for every row: names in order, and for each the largest
    containment and the first word of the earliest window that has it.

    A NULL or empty text matches nothing; neither does any text without templates.
    Repeated rows each get a row, NULL keys are kept, other columns are ignored.
    """
    spark = on_workers(docs)
    row = F.xxhash64(F.col(key), F.col(text))
    templates = prepared_templates(texts)
    matched = "row long, license string, containment double, place long"
    if templates:
        # A fixed list of a few templates.
        exact = spark.createDataFrame(
            [(t.name, t.shingles.view(np.int64).tolist()) for t in templates], "license string, wanted array<long>"
        )
        found = docs.select(row.alias("row"), F.coalesce(F.col(text), F.lit("")).alias("body")).mapInArrow(
            _windows(templates), "row long, license string, place long, held array<long>"
        )
        share = F.size(F.array_intersect("held", "wanted")) / F.size("wanted")
        best = (
            found.join(F.broadcast(exact), "license")
            .withColumn("containment", share)
            .filter(F.col("containment") >= THRESHOLD)
            .groupBy("row", "license")
            .agg(F.max(F.struct("containment", (-F.col("place")).alias("place"))).alias("m"))
            .select("row", "license", F.col("m.containment").alias("containment"), (-F.col("m.place")).alias("place"))
        )
    else:
        best = spark.createDataFrame([], matched)
    one = F.struct("license", "containment", "place")
    lists = stored(best.groupBy("row").agg(F.sort_array(F.collect_list(one)).alias("matches")), "licenses")
    empty = F.array().cast("array<struct<license:string,containment:double,place:bigint>>")
    rows = docs.select(F.col(key), row.alias("row")).join(lists, "row", "left")
    rows = rows.withColumn("matches", F.coalesce("matches", empty))
    return rows.select(key, F.col("matches.license").alias("licenses"), "matches")
