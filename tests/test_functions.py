"""Column expressions against Python on values picked to be awkward."""

from __future__ import annotations

import datetime
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tenantry.functions import surrogates as s
from tenantry.functions.numbers import duration_text, one_decimal, round_exact


def values():
    rng = random.Random(5)
    ties = [k / 8 for k in range(1, 800)] + [k / 20 for k in range(3, 400)] + [k / 200 for k in range(25, 4000, 7)]
    return ties + [rng.uniform(0.2, 100) for _ in range(500)] + [rng.uniform(1e3, 1e9) for _ in range(200)] + [0.0, 1e15, 2.675]


def test_rounding_equals_python(spark):
    data = [(x,) for x in values()]
    df = spark.createDataFrame(data, "x DOUBLE")
    got = df.select("x", round_exact(F.col("x"), 1).alias("a"), round_exact(F.col("x"), 2).alias("b"), one_decimal(F.col("x")).alias("t"))
    for row in got.collect():
        assert row.a == round(row.x, 1), row
        assert row.b == round(row.x, 2), row
        assert row.t == f"{row.x:.1f}", row


def test_rounding_is_odd_in_sign(spark):
    df = spark.createDataFrame([(-2.675,), (-0.25,)], "x DOUBLE")
    assert [tuple(r) for r in df.select(round_exact(F.col("x"), 2), round_exact(F.col("x"), 1)).collect()] == [(-2.67, -2.7), (-0.25, -0.2)]


def test_duration_text(spark):
    def expected(x):
        if x < 60:
            return f"{x:.1f} seconds"
        return f"{x / 60:.1f} minutes" if x < 3600 else f"{x / 3600:.1f} hours"

    data = [(x,) for x in [0.0, 59.94, 59.96, 60.0, 61.5, 3599.99, 3600.0, 15120.0, 0.25, 0.35, 12.25] + values()]
    df = spark.createDataFrame(data, "x DOUBLE").select("x", duration_text(F.col("x")).alias("t"))
    assert all(row.t == expected(row.x) for row in df.collect())


@pytest.mark.parametrize("algorithm,function", [("sha256", hashlib.sha256), ("sha512", hashlib.sha512), ("md4", hashlib.sha256)])
def test_salted_hash(spark, algorithm, function):
    df = spark.createDataFrame([("123-45-6789", 17, True), (None, None, None)], "t STRING, n INT, b BOOLEAN")
    hashed = df.select(
        s.salted_hash(F.col("t"), "salt", algorithm), s.salted_hash(F.col("n"), "salt", algorithm), s.salted_hash(F.col("b"), "salt", algorithm, "boolean")
    ).collect()
    want = [function(f"{v}salt".encode()).hexdigest()[:16] for v in ("123-45-6789", 17, True)]
    assert list(hashed[0]) == want
    assert list(hashed[1]) == [None, None, None]


def test_every_kind_is_stable_and_keeps_null(spark):
    kinds = [
        "email", "first_name", "last_name", "name", "phone_number", "street_address", "city", "zipcode", "date_of_birth",
        "user_name", "ipv4", "url", "shoe_size",
    ]
    df = spark.createDataFrame([("ann",), ("bob",), ("ann",), (None,)], "v STRING")
    made = df.select(*[s.surrogate(k, "r", F.col("v"), "salt", "2024-06-30").cast("string").alias(k) for k in kinds]).collect()
    assert made[0] == made[2] and made[0] != made[1]
    assert set(made[3]) == {None}
    assert made[0].email.endswith(".example.org") and "@" in made[0].email
    assert made[0].shoe_size == "FAKE_SHOE_SIZE"
    other = df.select(s.surrogate("email", "r", F.col("v"), "other").alias("e")).first().e
    assert other != made[0].email


def test_birth_dates_cover_the_ages_and_no_more(spark):
    df = spark.range(200_000).select(
        s.surrogate("date_of_birth", "r", F.col("id"), "salt", "2024-02-29", minimum_age=5, maximum_age=6).alias("d")
    )
    low, high = df.agg(F.min("d"), F.max("d")).first()
    assert low == datetime.date(2017, 3, 1) and high == datetime.date(2019, 2, 28)


def test_format_is_kept_over_long_texts(spark):
    texts = ["(555) 123-4567", "", "Ab-9 é", "x" * 40 + "-" + "7" * 4000, None]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    for before, row in zip(texts, df.select(s.format_preserving("r", F.col("t"), "k").alias("t")).collect(), strict=True):
        if before is None:
            assert row.t is None
            continue
        assert len(row.t) == len(before)
        for a, b in zip(before, row.t, strict=True):
            if a.isascii() and a.isdigit():
                assert b.isdigit()
            elif a.isascii() and a.isalpha():
                assert b.isalpha() and a.isupper() == b.isupper()
            else:
                assert a == b
        assert before == "" or row.t != before


def test_domain_is_kept_but_no_text_without_one(spark):
    df = spark.createDataFrame([("a@b@school.org",), ("secret",), (None,)], "t STRING")
    made = [r.t for r in df.select(s.domain_preserving_email("r", F.col("t"), "k").alias("t")).collect()]
    assert made[0].endswith("@school.org") and made[0].count("@") == 1
    assert "secret" not in made[1] and made[2] is None


def test_implausible_values(spark):
    df = spark.createDataFrame([(0,), (1,), (100,), (101,), (-3,), (None,)], "a INT")
    assert [r.a for r in df.select(s.implausible_to_null(F.col("a")).alias("a")).collect()] == [None, 1, 100, None, -3, None]
