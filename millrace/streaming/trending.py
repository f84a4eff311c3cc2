"""What is trending, from summaries of slides that merge with each other.

The stream keeps the count of every item per slide: partial aggregation fills it before the state store, items of a slide are
spread over all tasks, and a slide leaves the state when the watermark has passed it. A sliding window is the merger of its
slides, and a decayed score weighs slides by age; both are made when they are read, and both are exact.

Only who gives ``tracked`` gets one sketch of frequent items per slide instead, whose state does not grow with the number of
different items. Of a window with N events an item's count is then off by at most 3.5 N / ``tracked``; with fewer than three
quarters of ``tracked`` different items per window all counts are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.windows import top_n_per_group

#: Items that are read from a sketch.
TRACKED = 1000


def slide_summaries(stream: DataFrame, ts: str, slide: str, delay: str, item: str, tracked: int | None = None) -> DataFrame:
    """``window_start, window_end, item, n``: all items of each slide with their exact counts, keyed by slide and item.

    With ``tracked`` it is ``window_start, window_end, summary``, a sketch and one state row per slide within the watermark."""
    window, watermarked = F.window(ts, slide).alias("w"), stream.withWatermark(ts, delay)
    if tracked is None:
        grouped, found = watermarked.groupBy(window, F.col(f"`{item}`").alias("item")).agg(F.count(F.lit(1)).alias("n")), ["item", "n"]
    else:
        summary = F.expr(f"approx_top_k_accumulate(`{item}`, {tracked})").alias("summary")
        grouped, found = watermarked.groupBy(window).agg(summary), ["summary"]
    return grouped.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *found)


def _items(summaries: DataFrame, keys: Sequence[str], item: str, tracked: int) -> DataFrame:
    """All items that the sketches hold, at most ``tracked`` of each."""
    found = F.inline(F.expr(f"approx_top_k_estimate(summary, {tracked})"))
    return summaries.select(*keys, found).withColumnsRenamed({"item": item, "count": "n"})


def sliding_top(summaries: DataFrame, slide: str, slides: int, item: str, n: int, tracked: int = TRACKED) -> DataFrame:
    """``window_start, window_end, item, n, rn``: the ``n`` most frequent items of every window of so many slides, one window
    for each slide, those at both ends included; equal counts by item."""
    step = F.expr(f"INTERVAL {slide}")
    starts = F.explode(F.array(*[F.col("window_start") - step * i for i in range(slides)])).alias("window_start")
    end = (F.col("window_start") + step * slides).alias("window_end")
    if "summary" in summaries.columns:
        merged = summaries.select(starts, "summary").groupBy("window_start")
        merged = merged.agg(F.expr(f"approx_top_k_combine(summary, {tracked})").alias("summary"))
        items = _items(merged, ["window_start", end], item, tracked)
    else:
        counts = summaries.select(starts, F.col("item").alias(item), "n").groupBy("window_start", item)
        items = counts.agg(F.sum("n").alias("n")).select("window_start", end, item, "n")
    return top_n_per_group(items, ["window_start"], [F.desc("n"), F.asc(item)], n)


def decayed_top(summaries: DataFrame, at: Column, half_life: str, item: str, n: int, tracked: int = TRACKED) -> DataFrame:
    """``item, score``: the items with the highest sum of counts, where a count loses half of its weight with every
    ``half_life`` between the end of its slide and ``at``. Slides that end after ``at`` do not count."""
    epoch = F.lit("2000-01-01").cast("timestamp")
    seconds = lambda t: F.unix_micros(t) / 1e6
    life = seconds(epoch + F.expr(f"INTERVAL {half_life}")) - seconds(epoch)
    age = seconds(at.cast("timestamp")) - seconds(F.col("window_end").cast("timestamp"))
    weight = F.pow(F.lit(0.5), age / life).alias("weight")
    past = summaries.filter(age >= 0)
    items = _items(past, [weight], item, tracked) if "summary" in summaries.columns else past.select(weight, F.col("item").alias(item), "n")
    scores = items.groupBy(item).agg(F.sum(F.col("n") * F.col("weight")).alias("score"))
    return scores.orderBy(F.desc("score"), F.asc(item)).limit(n)
