"""Near copies by HyperMinHash next to all pairs; signatures, estimates and bands."""

import random

import numpy as np
import pytest
from brute import linked as plain_linked
from pyspark.sql import functions as F
from test_llm_cases import CLASH, TEXTS

from tidemark.llm import hyperminhash as hmh
from tidemark.llm.shared import workspace


def groups(spark, rows, size, percent, extra=()):
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    frame = frame.withColumns({c: F.lit(f"own {c}") for c in extra})
    with workspace(spark) as work:
        # Read twice: the partitions must be those of a table.
        docs = work.write(frame, "docs")
        found = hmh.near_copies(docs, work, size, percent).collect()
    assert all(r[c] == f"own {c}" for r in found for c in extra)
    return found


def check(found, rows, size, percent):
    plain = plain_linked([t for _, t in rows], size, percent)
    want = []
    for (doc_id, _), (n, members, _) in zip(rows, plain, strict=True):
        ids = [rows[m][0] for m in members if rows[m][0] is not None]
        least = min(ids) if ids else None
        want.append((doc_id, n, least, doc_id == least))
    got = [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in found]
    assert sorted(got, key=str) == sorted(want, key=str)
    components = {tuple(sorted(m)) for _, m, _ in plain}
    assert sum(r["first"] for r in found) == len(components)


@pytest.mark.parametrize("size,percent", [(2, 80), (5, 80), (3, 50)])
def test_groups_of_odd_rows(spark, size, percent):
    rows = [(i if i % 5 else (None if i else 0), t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3])]
    extra = [c for c in CLASH if c != "component_id"] + ["first", "kept", "level", "node", "cluster"]
    extra = [c for c in extra if c not in ("first", "kept")]
    check(groups(spark, rows, size, percent, extra), rows, size, percent)
    assert groups(spark, [], size, percent) == []


def test_groups_of_near_copies(spark):
    # Families of copies about the limit, of a few words to some hundred, and unrelated texts.
    draw = random.Random(7)
    rows, number = [], 0
    for family in range(60):
        length = draw.choice([2, 4, 6, 9, 14, 25, 60, 140, 400])
        words = [f"w{draw.randrange(3000)}" for _ in range(length)]
        for _ in range(draw.choice([1, 2, 3, 12])):
            own = list(words)
            for _ in range(draw.randrange(1 + max(1, length // 14))):
                own[draw.randrange(length)] = f"x{draw.randrange(10**6)}"
            rows.append((number * 7 % 1009, " ".join(own)))
            number += 1
    rows += [(5000 + k, " ".join(f"u{k}x{n}" for n in range(30))) for k in range(40)]
    rows += [(6000 + k, rows[3][1].upper()) for k in range(40)]
    check(groups(spark, rows, 2, 80), rows, 2, 80)


def test_sub_blocks_lose_no_link(spark, monkeypatch):
    # One family larger than a block, each text another one, and all in one cluster.
    monkeypatch.setattr(hmh, "SET_BLOCK", 8)
    monkeypatch.setattr(hmh, "BAND_BLOCK", 8)
    base = [f"w{n}" for n in range(120)]
    rows = []
    for k in range(60):
        own = list(base)
        own[k], own[(k * 7 + 3) % 120] = f"y{k}", f"z{k}"
        rows.append((100 - k, " ".join(own)))
    check(groups(spark, rows, 2, 80), rows, 2, 80)


def tokens(draw, n):
    return np.unique(draw.integers(0, 1 << 56, n, dtype=np.uint64))


def test_a_register_is_the_least_hash_as_a_small_float():
    draw = np.random.default_rng(1)
    for n in (1, 2, 5, 40, 700, 5000):
        at = hmh.level(n)
        own = hmh.registers(tokens(draw, n), at)
        assert len(own) == hmh.REGISTERS
        filled = own[own > 0]
        # Leading zeros and ten bits: half of the least hashes of k values lie below 0.7 / k.
        least = (2.0 ** (filled // 1024 - 1.0) * (1 + filled % 1024 / 1024)) / 2**52
        load = n / (1 << at)
        assert abs(np.median(least) * load - 0.7) < 0.2 + (load < 3) * 0.3
        assert len(filled) >= 0.7 * hmh.REGISTERS


def test_estimates_are_close_and_allow_for_collisions():
    draw = np.random.default_rng(2)
    for n in (8, 60, 900, 4000):
        for share in (0.0, 0.3, 0.8):
            errors = []
            for _ in range(12):
                both, at = tokens(draw, max(int(2 * n * share / (1 + share)), 1 if share else 0)), hmh.level(n)
                a, b = (np.union1d(both, tokens(draw, n - len(both))) for _ in range(2))
                true = hmh.overlap(a, b) / len(np.union1d(a, b))
                chance = hmh.collisions(len(a), np.array([len(b)]), at)
                found, used = hmh.estimates(hmh.registers(a, at), hmh.registers(b, at)[None, :], chance)
                errors.append(found[0] - true)
                assert abs(errors[-1]) < 6 * np.sqrt(0.25 / used[0])
            assert abs(np.mean(errors)) < 0.05


def test_collisions_are_as_frequent_as_computed():
    # With two bits of mantissa instead of ten, chance is large enough to be seen.
    draw = np.random.default_rng(3)
    for k, m in ((1, 1), (3, 2), (40, 50)):
        a = draw.random((200_000, k)).min(axis=1) if k < 40 else 1 - draw.random(200_000) ** (1 / k)
        b = draw.random((200_000, m)).min(axis=1) if m < 40 else 1 - draw.random(200_000) ** (1 / m)
        cells = [np.floor(np.ldexp(*((np.frexp(x)[0]), 3))) + 16 * np.frexp(x)[1] for x in (a, b)]
        seen = (cells[0] == cells[1]).mean()
        expected = hmh.collisions(k, np.array([m]), 0)[0] * 2**hmh.MANTISSA / 4
        assert abs(seen - expected) < 0.15 * expected


def test_bands_are_as_wide_as_the_similarity_allows():
    assert hmh.band_width(80) == 7 and hmh.band_width(50) < 4 < hmh.band_width(95)
    for percent in (30, 50, 80, 95):
        width = hmh.band_width(percent)
        assert (1 - (percent / 100) ** width) ** (hmh.REGISTERS // width) <= hmh.MISS
    with pytest.raises(ValueError, match="too low"):
        hmh.band_width(1)


def test_sets_that_link_share_a_level():
    for percent in (50, 80, 95):
        for small in range(1, 1500):
            for large in {small, 100 * small // percent}:
                assert hmh.level(large) in hmh.levels(small, percent)
