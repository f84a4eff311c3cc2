"""Matching of records whose names are similar, not equal.

A few edits leave at least one of a few more grams untouched that do not overlap, at nearly the same place. So a name is
filed under the rarest such grams only, the other name looks under its own rare grams, and no block of names is compared in
all pairs. Grams run over both ends of a name, so that its first and last letters count as others do. Short names, which
edits may leave without a common gram, meet under what is left of them after deletions. Equal names are one name before any
of this; records are linked to names and field values, never to each other.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain, combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.collections import explode_rows
from millrace.operators.entities import connected_records, survivorship
from millrace.session import checkpoint_root

GRAM = 5
#: Grams are counted by hash; at most so many counts are sent to every task. Fuller counts only make the order of grams coarser.
GRAM_COUNTS = 1 << 20


def _shuffled(df: DataFrame) -> DataFrame:
    """For a join with or of exploded rows: Spark's estimate leaves out how often a row is repeated, so it would send a table
    to the driver that is far larger than it believes."""
    return df.hint("merge")


def normal_name(name: Column) -> Column:
    """Small letters, single blanks; NULL if nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(F.lower(name), r"\s+", " ")), F.lit(""))


def _least_grams(edits: int) -> int:
    """So many letters have more grams than ``edits`` edits can spoil."""
    return (edits - 1) * GRAM + 2


def _apart(rare: Column, edits: int) -> Column:
    """One more of the grams than there are edits, none overlapping another, together the rarest. Of all grams that edits can
    spoil and one more there are always so many."""
    chains = F.transform(rare, lambda g: F.struct(g.often.alias("often"), g["at"].alias("at"), F.array(g).alias("grams")))

    def longer(found: Column, _: Column) -> Column:
        def best(first: Column) -> Column:
            rest = F.array_min(F.filter(found, lambda c: c["at"] >= first["at"] + GRAM))
            put = lambda c: F.struct((first.often + c.often).alias("often"), first["at"].alias("at"), F.concat(first.grams, c.grams).alias("grams"))
            return F.transform(F.array_compact(F.array(rest)), put)

        return F.flatten(F.transform(chains, best))

    steps = F.array(*[F.lit(i) for i in range(edits)]).cast("array<int>")
    return F.array_min(F.aggregate(steps, chains, longer))["grams"]


def _named_grams(names: DataFrame, edits: int) -> DataFrame:
    """``name, size, rare, apart``: the grams of a name by ascending frequency, as many as ``edits`` edits can spoil and one
    more, with all places of the last of them; and of these the rarest that do not overlap."""
    edge = F.lit("#" * (GRAM - 1))
    places = F.sequence(F.lit(1), F.length("name") + GRAM - 1)
    rows = names.filter(F.length("name") >= _least_grams(edits)).select("name", F.explode(places).alias("at"))
    gram = F.xxhash64(F.substring(F.concat(edge, "name", edge), F.col("at"), F.lit(GRAM)))
    rows = rows.select("name", "at", gram.alias("gram"), F.pmod(gram, F.lit(GRAM_COUNTS)).alias("slot"))
    often = rows.groupBy("slot").agg(F.count(F.lit(1)).alias("often")).checkpoint()
    ranked = F.array_sort(F.collect_list(F.struct("often", "gram", "at"))).alias("ranked")
    by_name = rows.join(F.broadcast(often), "slot").groupBy("name").agg(ranked)
    # One step a column: what a lambda looks up is then not worked out again for each element.
    by_name = by_name.select("name", "ranked", F.get("ranked", F.lit(edits * GRAM)).alias("last"))
    rare = F.filter("ranked", lambda g: F.struct(g.often, g.gram) <= F.struct("last.often", "last.gram"))
    by_name = by_name.select("name", F.length("name").alias("size"), rare.alias("rare"))
    return by_name.select("name", "size", "rare", _apart(F.col("rare"), edits).alias("apart"))


def _rare_grams(names: DataFrame, edits: int) -> DataFrame:
    """``name, size, gram, at``: the grams that names are filed under."""
    return _exploded(_named_grams(names, edits), "apart")


def _exploded(grams: DataFrame, column: str) -> DataFrame:
    return grams.select("name", "size", F.explode(column).alias("g")).select("name", "size", "g.gram", "g.at")


def _without_letters(name: Column, edits: int) -> Column:
    """All that is left of a name when up to ``edits`` letters go."""

    def shorter(word: Column) -> Column:
        place = F.sequence(F.lit(1), F.length(word))
        cut = lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word)))
        return F.when(F.length(word) > 0, F.transform(place, cut)).otherwise(F.array().cast("array<string>"))

    level, found = F.array(name), F.array(name)
    for _ in range(edits):
        level = F.array_distinct(F.flatten(F.transform(level, shorter)))
        found = F.array_union(found, level)
    return found


def similar_names(names: DataFrame, edits: int = 2) -> DataFrame:
    """``a, b, distance`` with ``a < b`` for all different values of the column ``name`` within ``edits`` edits; NULL is
    like no other."""
    names = names.select("name").filter(F.col("name").isNotNull()).distinct()
    checkpoint_root(names.sparkSession)
    grams = _named_grams(names, edits).checkpoint()
    # Grams are put in one order for all names. Of two names within the edits, the one whose rare grams end earlier has a
    # gram apart that the other has too, and there it is among the rare ones.
    filed = _exploded(grams, "apart").withColumnsRenamed({"name": "a", "size": "size_a", "at": "at_a"})
    sought = _exploded(grams, "rare").withColumnsRenamed({"name": "b", "size": "size_b", "at": "at_b"})
    moved = F.col("at_b") - F.col("at_a")
    near = F.abs(moved) + F.abs(F.col("size_b") - F.col("size_a") - moved) <= edits
    by_gram = filed.join(_shuffled(sought), "gram").filter(near & (F.col("a") != F.col("b"))).select("a", "b")
    short = names.filter(F.length("name") < _least_grams(edits) + edits)
    left = explode_rows(short, _without_letters(F.col("name"), edits), "left", "name")
    by_letters = left.withColumnRenamed("name", "a").join(_shuffled(left.withColumnRenamed("name", "b")), "left").filter("a < b")
    distance = F.levenshtein("a", "b", edits).cast("long").alias("distance")
    pairs = by_gram.unionByName(by_letters.select("a", "b"))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), distance).filter(F.col("distance") >= 0)
    return pairs.distinct()


def name_similarity(distance: Column, a: Column, b: Column) -> Column:
    """One minus edits per letter of the longer name."""
    return 1 - distance / F.greatest(F.length(a), F.length(b))


def match_similar(
    records: DataFrame,
    record_id: str,
    name: Column,
    fields: Mapping[str, tuple[Column, float]],
    name_weight: float,
    threshold: float,
    edits: int = 2,
) -> DataFrame:
    """``(record_id, entity_id)``: two records match if their names are within ``edits`` edits and ``name_weight`` times
    their similarity, plus the weights of the fields that are equal and known, reaches ``threshold``; matches are
    transitive. A record without a name matches nothing.

    For equal names some sets of fields suffice: records link to the values of each smallest such set. Two similar names
    need other sets, and the records of both names link where they agree on one. Links grow with records and with similar
    names, not with pairs of records.
    """
    checkpoint_root(records.sparkSession)
    weight = {n: w for n, (_, w) in fields.items()}
    sets = list(chain.from_iterable(combinations(sorted(fields), k) for k in range(len(fields) + 1)))
    kept = records.select(F.col(record_id).alias("_id"), normal_name(name).alias("name"), *[c.cast("string").alias(f"f_{n}") for n, (c, _) in fields.items()])
    kept = kept.filter(F.col("name").isNotNull()).checkpoint()

    def enough(similarity: Column, names: tuple[str, ...]) -> Column:
        """The set suffices, and without its lightest field it would not."""
        total = sum(weight[n] for n in names)
        need = F.lit(threshold) - F.lit(name_weight) * similarity
        full = F.lit(total) >= need - 1e-9
        return full & ~(F.lit(total - min(weight[n] for n in names)) >= need - 1e-9) if names else full

    values = F.array(*[
        F.when(
            F.lit(True) if not s else F.forall(F.array(*[F.col(f"f_{n}") for n in s]), lambda v: v.isNotNull()),
            F.struct(F.lit(i).alias("fields"), F.to_json(F.array(*[F.col(f"f_{n}") for n in s])).alias("values")),
        )
        for i, s in enumerate(sets)
    ])
    held = explode_rows(kept, values, "h", "_id", "name").select("_id", "name", "h.*").checkpoint()
    groups = held.groupBy("name", "fields", "values").agg(F.min("_id").alias("low"))
    alone = [i for i, s in enumerate(sets) if _suffices(name_weight, threshold, weight, s)]
    same = held.filter(F.col("fields").isin(alone))

    pairs = similar_names(kept, edits)
    similarity = name_similarity(F.col("distance"), F.col("a"), F.col("b"))
    usable = F.array(*[F.when(enough(similarity, s), F.lit(i)) for i, s in enumerate(sets)])
    pairs = explode_rows(pairs, usable, "fields", "a", "b")
    side = lambda c: groups.select(F.col("name").alias(c), "fields", "values", F.col("low").alias(f"low_{c}"))
    met = pairs.join(_shuffled(side("a")), ["a", "fields"]).join(_shuffled(side("b")), ["b", "fields", "values"])

    node = lambda n: F.to_json(F.array(F.col(n), F.col("fields").cast("string"), F.col("values")))
    # Sets that suffice for similar names suffice for equal ones, so all records of a group that is met belong together.
    touched = met.select(F.col("a").alias("name"), "fields", "values").union(met.select("b", "fields", "values")).distinct()
    members = held.join(_shuffled(touched), ["name", "fields", "values"], "left_semi").unionByName(same)
    links = members.select("_id", node("name").alias("_node")).unionByName(met.select(F.col("low_a").alias("_id"), node("b").alias("_node")))
    return connected_records(records, record_id, links)


def _suffices(name_weight: float, threshold: float, weight: Mapping[str, float], names: tuple[str, ...]) -> bool:
    total = name_weight + sum(weight[n] for n in names)
    return total >= threshold - 1e-9 and (not names or total - min(weight[n] for n in names) < threshold - 1e-9)


def golden_record_scored(
    records: DataFrame,
    record_id: str,
    name: Column,
    fields: Mapping[str, tuple[Column, float]],
    name_weight: float,
    threshold: float,
    preferred: list[str],
    columns: list[str],
    edits: int = 2,
) -> DataFrame:
    """One row per entity of similar records; every column takes its value from the most preferred record."""
    checkpoint_root(records.sparkSession)
    kept = records.checkpoint()
    found = match_similar(kept, record_id, name, fields, name_weight, threshold, edits)
    return survivorship(kept.join(_shuffled(found), record_id), "entity_id", preferred, columns)
