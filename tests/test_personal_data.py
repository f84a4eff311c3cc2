"""Tokens that can be turned back, numbers with check digits, late events served once."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import layout, security, tokens
from millrace.streaming import late
from millrace.streaming import streams as S
from tests.conftest import rows


def test_digit_tokens_keep_the_format_and_come_back(spark):
    values = ["", "7", "42", "123", "0000000000", "+49 (30) 1234-567", "no digits", "9" * 19, "1" * 36, "2" * 37, None]
    df = spark.createDataFrame([(v,) for v in values], "v string").withColumn("t", tokens.digit_token(F.col("v"), "k"))
    got = {r.v: (r.t, r.back) for r in df.withColumn("back", tokens.digit_token(F.col("t"), "k", back=True)).collect()}
    for v in values:
        token, back = got[v]
        if v is None or len(v) == 37:
            assert token is None
        else:
            assert back == v and "".join("0" if c.isdigit() else c for c in token) == "".join("0" if c.isdigit() else c for c in v)
    other = df.withColumn("o", tokens.digit_token(F.col("v"), "other")).filter("length(v) > 8 AND o = t AND t RLIKE '[0-9]'")
    assert other.isEmpty()


@pytest.mark.parametrize("digits", [1, 2, 3, 4])
def test_digit_tokens_are_a_permutation(spark, digits):
    df = spark.range(10**digits).select(F.lpad(F.col("id").cast("string"), digits, "0").alias("v"))
    found = df.select(tokens.digit_token(F.col("v"), "k").alias("t"))
    assert found.distinct().count() == 10**digits and found.filter(F.length("t") != digits).isEmpty()


def test_digits_are_permuted_once_for_a_value(spark):
    """Not once more for every character: the plan names the digest of a round and that of a single digit, no more."""
    plan = layout.plan_text(spark.range(1).select(tokens.digit_token(F.col("id").cast("string"), "k").alias("t")), "simple")
    assert plan.count("sha2(") == 2


def test_token_table_has_no_collisions_and_keeps_known_tokens(spark):
    first = spark.createDataFrame([(f"v{i}",) for i in range(150)] * 2 + [(None,)], "value string")
    known = tokens.add_tokens(None, first, "k", length=2)  # 256 tokens: most attempts meet a taken one
    more = tokens.add_tokens(known, spark.createDataFrame([(f"v{i}",) for i in range(100, 220)], "value string"), "k", length=2)
    assert more.count() == more.select("token").distinct().count() == more.select("value").distinct().count() == 220
    assert known.exceptAll(more).isEmpty()


def luhn(number):
    digits = [int(d) for d in number if d.isdigit()][::-1]
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0


def iban(number):
    turned = number[4:] + number[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def test_check_digits(spark):
    r = random.Random(1)
    cards = ["4111 1111 1111 1111", "5500-0000-0000-0004"] + ["".join(r.choice("0123456789") for _ in range(r.randint(13, 19))) for _ in range(200)]
    accounts = ["GB82WEST12345698765432", "DE89370400440532013000"] + [f"DE{r.randrange(10, 99)}{r.randrange(10**17, 10**18)}" for _ in range(300)]
    df = spark.createDataFrame([(c,) for c in cards], "v string").select("v", security.card_is_valid(F.col("v")).alias("ok"))
    assert {x.v: x.ok for x in df.collect()} == {c: luhn(c) for c in cards} and luhn(cards[0])
    df = spark.createDataFrame([(c,) for c in accounts], "v string").select("v", security.iban_is_valid(F.col("v")).alias("ok"))
    assert {x.v: x.ok for x in df.collect()} == {c: iban(c) for c in accounts} and iban(accounts[0])


def test_a_column_is_named_after_valid_numbers_only(spark):
    good = [c for c in (f"400000{i:010d}" for i in range(400)) if luhn(c)]
    data = [(f"pay {c} now", f"{i:014d}", None) for i, c in enumerate(good)] + [(None, "", "DE89370400440532013000")]
    found = rows(security.verified_scan(spark.createDataFrame(data, "a string, b string, c string"), ["a", "b", "c"]), "column_name", "kind", "verdict")
    assert found == [("a", "card", "card"), ("b", "card", "none"), ("c", "iban", "none")]


SCHEMA = "id long, ts timestamp_ntz, v long"


def test_only_days_with_new_events_are_served_again(spark, tmp_path):
    inbox, root = str(tmp_path / "inbox"), str(tmp_path / "root")
    schema = spark.createDataFrame([], SCHEMA).schema
    built = []

    def build(events):
        out = events.groupBy("event_date").agg(F.count("*").alias("n"), F.sum("v").alias("v"))
        built.append(sorted(str(r.event_date) for r in out.collect()))
        return out

    def deliver(*events):
        made = spark.createDataFrame([(i, t, v) for i, t, v in events], "id long, ts string, v long")
        made.withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.mode("append").parquet(inbox)
        S.run_to_end(S.split_late(S.stream_files(spark, inbox, schema), "ts", "1 hour", root), f"{root}/checkpoint")

    serve = lambda: late.serve_dates(spark, root, f"{root}/served", schema, "ts", build)
    deliver((1, "2024-01-01 10:00", 1), (2, "2024-01-02 10:00", 2))
    serve()
    serve()  # nothing new
    deliver((3, "2024-01-03 10:00", 4), (4, "2024-01-01 11:00", 8))  # the second is late
    serve()
    deliver((5, "2024-01-01 12:00", 16), (6, None, 32))
    with pytest.MonkeyPatch.context() as m:  # dies after the partitions are written, before the ledger is
        m.setattr(late, "overwrite_partitions", lambda *a: (S_overwrite(*a), (_ for _ in ()).throw(KeyboardInterrupt))[0])
        with pytest.raises(KeyboardInterrupt):
            serve()
    serve()
    assert built == [["2024-01-01", "2024-01-02"], ["2024-01-01", "2024-01-03"], ["2024-01-01", "None"], ["2024-01-01", "None"]]
    served = spark.read.parquet(f"{root}/served").select(F.col("event_date").cast("string"), "n", "v")
    assert rows(served) == [(None, 1, 32), ("2024-01-01", 3, 25), ("2024-01-02", 1, 2), ("2024-01-03", 1, 4)]
    last = late.ledger(spark, f"{root}/served_versions").groupBy(F.col("event_date").cast("string").alias("d")).agg(F.max("version").alias("v"))
    assert rows(last) == [(None, 1), ("2024-01-01", 3), ("2024-01-02", 1), ("2024-01-03", 1)]


S_overwrite = late.overwrite_partitions
