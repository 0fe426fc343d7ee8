"""Vector codes next to plain ones: odd rows, ties, few vectors, and what the bounds save."""

import numpy as np
import pytest
from brute import vector_codes as plain_codes
from pyspark.sql import functions as F

from tidemark.llm import vector_codes
from tidemark.llm.shared import workspace

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def coded(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    frame = frame.withColumns({c: F.lit("own") for c in ("_row", "ints", "apart", "part", "_label")})
    with workspace(spark) as work:
        codes = vector_codes.compress_vectors(frame.withColumn("code", F.lit(1)), work, **options)
        found = codes.rows.collect()
        assert all(r["ints"] == r["_row"] == "own" for r in found)
        rows = [(r["vec_id"], r["code"], r["error"], r["label_error"]) for r in found]
        return sorted(rows, key=str), codes


def vectors(n, seed, width=8, spread=0.4):
    draw = np.random.default_rng(seed)
    return [[float(x) for x in v] for v in np.float32(draw.normal(0, spread, (n, width)))]


def test_codes_equal_plain_ones(spark):
    rows = [(i * 3 - 50, v, (None, 1, 2)[i % 3]) for i, v in enumerate(vectors(120, 1))]
    got, codes = coded(spark, rows, entries=16, pivots=3)
    want, books = plain_codes(rows, entries=16)
    assert got == sorted(want, key=str)
    assert [b.tolist() for b in codes.codebooks] == books


def test_odd_vectors(spark):
    good = vectors(12, 2)
    rows = [(i, v, i % 2) for i, v in enumerate(good)]
    rows += [(5, good[0], None), (5, good[0], None), (None, good[3], 0), (None, good[3], None)]
    nan, inf = float("nan"), float("inf")
    dropped = [None, [nan] + good[0][1:], [None] + good[0][1:], good[0][:-1] + [-inf], [inf] * 8]
    everything = rows + [(-1 - i, v, 0) for i, v in enumerate(dropped)]
    got, _ = coded(spark, everything)
    want, books = plain_codes(rows)
    assert got == sorted(want, key=str)
    assert len(books[0]) == len(rows) == len(got)
    assert coded(spark, [(i, v, 0) for i, v in enumerate(dropped)])[0] == []
    assert coded(spark, [(1, good[0], None)])[0] == [(1, "00000000", 0, 0)]


def test_ties_go_to_the_lower_entry(spark):
    # Two equal entries, and parts half-way between two others.
    rows = [(0, [1.0] * 4, 0), (1, [1.0] * 4, 0), (2, [3.0] * 4, 0), (3, [2.0] * 4, 0), (4, [-0.0001] * 4, 0)]
    got, codes = coded(spark, rows, entries=3, rounds=0)
    assert [r[1] for r in got] == ["00000000", "00000000", "02020202", "00000000", "00000000"]
    assert got[4][2] == 4 * 1025**2


@pytest.mark.parametrize(
    "rows,message",
    [
        ([(0, [1.0] * 8, 0), (1, [1.0] * 4, 0)], "components"),
        ([(0, [1.0] * 6, 0)], "cannot be cut"),
        ([(0, [1e30] * 8, 0)], "beyond"),
    ],
)
def test_vectors_that_are_refused(spark, rows, message):
    with pytest.raises(Exception, match=message):
        coded(spark, rows)


def test_bounds_save_evaluations_and_change_nothing():
    draw = np.random.default_rng(4)
    centres = draw.integers(-900, 900, (32, 6))
    parts = centres[draw.integers(0, 32, 3000)] + draw.integers(-20, 20, (3000, 6))
    book = centres + draw.integers(-5, 5, centres.shape)
    book[7] = book[3]
    pivots = vector_codes.choose_pivots(book, 6)
    near = np.sqrt(vector_codes.squared(parts, pivots))
    entry, error, evaluated = vector_codes.nearest(parts, near, book, pivots)
    every = vector_codes.squared(parts, book)
    assert (entry == every.argmin(axis=1)).all() and (error == every.min(axis=1)).all()
    assert 7 not in entry
    assert evaluated < 0.4 * every.size
