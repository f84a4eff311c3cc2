"""Similar records and maintained aggregates against brute force."""

from __future__ import annotations

import random
from itertools import combinations

from pyspark.sql import functions as F

from millrace.operators import layout, maintained, similarity
from millrace.operators.layout import plan_text
from tests.conftest import rows


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def spoilt(r: random.Random, name: str) -> str:
    for _ in range(r.randint(0, 3)):
        i = r.randint(0, len(name))
        name = r.choice([name[:i] + name[i + 1 :], name[:i] + "z" + name[i:], name[:i] + "z" + name[i + 1 :]])
    return name


def test_similar_names_are_all_pairs_within_the_edits(spark):
    r = random.Random(1)
    base = ["".join(r.choice("abcdé ") for _ in range(r.randint(1, 14))) for _ in range(40)] + ["", "a", "aa", "aaaaaaaaaa"]
    names = {spoilt(r, b) for b in base for _ in range(4)} | {f"the company {b}" for b in base}
    for limit in (1, 2):
        want = sorted((a, b, edits(a, b)) for a, b in combinations(sorted(names), 2) if edits(a, b) <= limit)
        df = spark.createDataFrame([(n,) for n in [*names, *names, None]], "name string")
        assert rows(similarity.similar_names(df, limit)) == sorted(want, key=lambda t: tuple((True, str(v)) for v in t))


def score(a, b, weights, name_weight, limit):
    if a[1] is None or b[1] is None or edits(a[1], b[1]) > limit:
        return 0.0
    equal = sum(w for i, w in enumerate(weights) if a[2 + i] is not None and a[2 + i] == b[2 + i])
    return name_weight * (1 - edits(a[1], b[1]) / max(len(a[1]), len(b[1]))) + equal


def test_match_similar_equals_all_pairs(spark):
    r = random.Random(2)
    base = ["the " + "".join(r.choice("abcdefgh") for _ in range(9)) for _ in range(15)]
    records = [(i, spoilt(r, r.choice(base)), r.choice([None, 1, 2]), r.choice(["x", "y", None])) for i in range(150)]
    records += [(200 + i, base[0], 1, None) for i in range(60)] + [(300, None, 1, "x"), (301, None, 1, "x")]
    weights, name_weight, threshold = (0.2, 0.15), 0.7, 0.85
    up = {x[0]: x[0] for x in records}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in combinations(records, 2):
        if score(a, b, weights, name_weight, 2) >= threshold - 1e-9:
            x, y = sorted((top(a[0]), top(b[0])))
            up[y] = x
    df = spark.createDataFrame(records, "id long, name string, nation long, segment string")
    fields = {"nation": (F.col("nation"), 0.2), "segment": (F.col("segment"), 0.15)}
    found = similarity.match_similar(df, "id", F.col("name"), fields, name_weight, threshold)
    assert {x.id: x.entity_id for x in found.collect()} == {x: top(x) for x in up}


def test_a_common_token_forms_no_block(spark):
    """All names share a long token; candidates stay near the number of names."""
    r = random.Random(3)
    names = ["international trading company " + "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(10)) for _ in range(3000)]
    grams = similarity._rare_grams(spark.createDataFrame([(n,) for n in names], "name string"), 2)
    assert grams.groupBy("gram", "size", "at").count().agg(F.max("count")).first()[0] < 100
    assert grams.count() < 8 * len(names)


KEYS, FACTS = ["k"], "k string, v double, id long"


def facts_of(r, n, first=0):
    return [(r.choice(["a", "b", None, "c"]), r.choice([None, 0.0, -1.5, 2.25, 7.0, round(r.uniform(-9, 9), 2)]), first + i) for i in range(n)]


def state_rows(state):
    return rows(state.select("k", "n", "n_values", "total", "lowest", "n_lowest", "highest", "n_highest", F.col("histogram").cast("string")))


def test_deltas_give_the_state_of_a_rebuild(spark):
    r = random.Random(4)
    facts = facts_of(r, 60)
    state = maintained.build_state(spark.createDataFrame(facts, FACTS), KEYS, "v")
    for step in range(4):
        gone = r.sample(facts, 15)
        came = facts_of(r, 10, 100 * (step + 1)) + [("new", float(step), 100 * step + 99)]
        facts = [f for f in facts if f not in gone] + came
        now = spark.createDataFrame(facts, FACTS)
        delta = maintained.signed(spark.createDataFrame(came, FACTS), spark.createDataFrame(gone, FACTS))
        state = maintained.apply_delta(state, delta, now, KEYS, "v")
        assert state_rows(state) == state_rows(maintained.build_state(now, KEYS, "v"))


def test_an_emptied_group_leaves(spark):
    facts = spark.createDataFrame([("a", 1.0, 1), ("b", None, 2)], FACTS)
    state = maintained.build_state(facts, KEYS, "v")
    after = maintained.apply_delta(state, maintained.signed(facts.limit(0), facts.filter("k = 'a'")), facts.filter("k = 'b'"), KEYS, "v")
    assert rows(after, "k", "n", "n_values", "lowest") == [("b", 1, 0, None)]


def test_facts_are_read_only_for_groups_that_lose_an_extreme(spark, tmp_path):
    spark.createDataFrame([("a", float(i), i) for i in range(9)] + [("b", 1.0, 10)], FACTS).write.parquet(f"{tmp_path}/facts")
    facts = spark.read.parquet(f"{tmp_path}/facts")
    state = maintained.build_state(facts, KEYS, "v").checkpoint()
    middle = maintained.apply_delta(state, maintained.signed(facts.limit(0), facts.filter("v = 4")), facts, KEYS, "v")
    assert f"{tmp_path}/facts" not in plan_text(middle).replace("\n", "")
    least = maintained.apply_delta(state, maintained.signed(facts.limit(0), facts.filter("v = 0")), facts.filter("v <> 0"), KEYS, "v")
    assert "facts" in plan_text(least)
    assert rows(least, "k", "lowest", "n") == [("a", 1.0, 8), ("b", 1.0, 1)]


def test_quantiles_are_within_the_error(spark):
    r = random.Random(5)
    values = [round(r.lognormvariate(3, 2), 2) + 0.01 for _ in range(2000)]
    state = maintained.build_state(spark.createDataFrame([("a", v, i) for i, v in enumerate(values)], FACTS), KEYS, "v")
    for share in (0.1, 0.5, 0.99):
        exact = sorted(values)[max(0, -int(-share * len(values) // 1) - 1)]
        assert abs(maintained.quantile(state, KEYS, share).first()["quantile"] - exact) <= 0.011 * exact


def test_rows_made_of_names_are_never_broadcast(spark):
    """Each name becomes a hundred rows and more, which Spark's estimate of a table leaves out."""
    names = spark.createDataFrame([("the river bank",), ("the river banks",), ("ab",), ("abc",)], "name string")
    found = similarity.similar_names(names)
    assert layout.plan_counts(found)["BroadcastHashJoin"] == 0
    assert rows(found) == [("ab", "abc", 1), ("the river bank", "the river banks", 1)]


def test_names_of_random_words_meet_few_others(spark):
    """Twenty thousand names in one frame of words, with two random words of sixteen letters' alphabet each."""
    r = random.Random(6)
    word = lambda n: "".join(r.choice("abcdefghiklmnopr") for _ in range(n))
    names = [f"the {word(8)} {word(6)} trading company" for _ in range(20_000)]
    grams = similarity._rare_grams(spark.createDataFrame([(n,) for n in names], "name string"), 2)
    met = grams.groupBy("gram").count().agg(F.sum(F.col("count") * F.col("count")).alias("n"), F.max("count").alias("most")).first()
    assert met.n < 10 * len(names) and met.most < 100


def test_names_around_the_length_of_a_gram_and_its_edges(spark):
    """Lengths at which pairs pass from the letters that are left to grams, edits at both ends, and the letter that fills grams up."""
    r = random.Random(7)
    base = ["".join(r.choice("ab#") for _ in range(n)) for n in range(3, 15) for _ in range(4)]
    names = {spoilt(r, b) for b in base for _ in range(4)} | {"x" + b for b in base} | {b + "#" for b in base} | {"#" * n for n in range(12)}
    for limit in (1, 2, 3):
        want = sorted((a, b, edits(a, b)) for a, b in combinations(sorted(names), 2) if edits(a, b) <= limit)
        found = similarity.similar_names(spark.createDataFrame([(n,) for n in names], "name string"), limit)
        assert rows(found) == sorted(want, key=lambda t: tuple((True, str(v)) for v in t))
