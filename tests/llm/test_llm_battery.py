"""The randomness tests of the secret scan against their definitions, and what they lose."""

import math
import random
import string

from brute import text_chance as plain_chance
from pyspark.sql import functions as F

from tidemark.llm import secrets

PLAIN = string.ascii_letters + string.digits


def chances(spark, tokens):
    frame = spark.createDataFrame(list(enumerate(tokens)), "i int, token string")
    rows = frame.select("i", secrets.text_chance(F.col("token")).alias("p")).collect()
    return [p for _, p in sorted((r["i"], r["p"]) for r in rows)]


def test_the_battery_is_that_of_its_definitions(spark):
    made = random.Random(3)
    kinds = [PLAIN, "0123456789abcdef", string.ascii_lowercase, PLAIN + "+/", PLAIN + "-_/", "aeiouAB12"]
    tokens = ["".join(made.choices(made.choice(kinds), k=made.randint(20, 300))) for _ in range(150)]
    words = "internal update handler request value name count offset parser for with the".split()
    tokens += ["_".join(made.choices(words, k=made.randint(4, 30))) for _ in range(50)]
    tokens += [string.ascii_lowercase * 3, "0123456789abcdef" * 9, PLAIN * 4, "a" * 40, "ab" * 30, "1" * 30]
    for token, found in zip(tokens, chances(spark, tokens), strict=True):
        assert math.isclose(found, plain_chance(token), rel_tol=1e-6, abs_tol=1e-12), token


def test_long_random_tokens_are_not_lost(spark):
    made = random.Random(11)
    missed = []
    for size in (24, 40, 64, 128, 400):
        found = chances(spark, ["".join(made.choices(PLAIN, k=size)) for _ in range(1000)])
        missed.append(sum(p > 1e-4 for p in found))
    assert missed == sorted(missed, reverse=True) and missed[3:] == [0, 0]


def test_what_is_in_order_is_not_random(spark):
    made = random.Random(13)
    once = "".join(made.sample(PLAIN, k=62))
    tokens = [
        string.ascii_lowercase, string.ascii_lowercase * 20, "0123456789abcdef" * 40, PLAIN, PLAIN * 9,
        "".join(c * 5 for c in PLAIN), once * 8, "0123456789abcdefghij", "1234567890abcdef12345678",
    ]
    assert min(chances(spark, tokens)) > 0.01
