"""The prefix trie next to a plain one: odd rows, long and equal conversations, borders."""

import random

import pytest
from brute import sha, trie as plain_trie
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.llm import prefixes
from tidemark.llm.queries import rebuilt
from tidemark.llm.shared import workspace

COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
]


def plain(conversations):
    rows = [(*row[:-1], sha(row[-1])) for row in plain_trie(conversations)]
    return sorted(rows, key=str)


def nodes_of(spark, turns, convs=None):
    with workspace(spark) as work:
        steps = work.write(prefixes.turn_steps(turns, work), "steps")
        found = prefixes.prefix_trie(steps, steps.select("conv") if convs is None else convs, work)
        rows = prefixes.node_digests(found).select(*COLUMNS, "ends_sha256").collect()
        return sorted((tuple(r) for r in rows), key=str)


def frame(spark, conversations):
    rows = [(c, n, r, t) for c, turns in conversations.items() for n, (r, t) in enumerate(turns)]
    random.Random(5).shuffle(rows)
    made = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    return made.withColumns({c: F.lit("own") for c in ("pos", "part", "conv", "digest", "place")})


@pytest.fixture()
def many_parts(spark):
    """Small sorts are spread over several tasks, so that conversations meet across borders."""
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "5"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def test_nodes_across_borders_and_pieces(spark, many_parts, monkeypatch):
    # Pieces of 2 and 4 turns, then 4 each: equal starts need several rounds.
    monkeypatch.setattr(prefixes, "PIECE", 2)
    monkeypatch.setattr(prefixes, "DOUBLINGS", 1)
    monkeypatch.setattr(prefixes, "FAN_IN", 2)
    draw = random.Random(3)
    words = [("user", "hi"), ("assistant", "hé 日本"), ("user", "")]
    conversations = {}
    for c in range(60):
        turns = [draw.choice(words[: 1 + (d % 3 > 0)]) for d in range(draw.randrange(12))]
        conversations[c * 7 - 30] = turns or [("user", "hi")]
    for c in range(1000, 1040):
        conversations[c] = [("user", "x"), *[("assistant", "the same long answer")] * 12]
    conversations[1040] = [("user", "x"), *[("assistant", "the same long answer")] * 9]
    conversations[1041] = conversations[1000] + [("user", "and more")]
    assert nodes_of(spark, frame(spark, conversations)) == plain(conversations)


def test_odd_turns(spark):
    rows = [
        (1, None, "user", "first"), (1, 0, None, None), (1, 3, "user", "tie b"), (1, 3, "user", "tie a"),
        (2, None, "user", "first"), (2, 5, "", ""), (2, 9, "user", "long " * 200_000),
        (3, 0, "user", "twice"), (3, 0, "user", "twice"), (None, 0, "user", "nowhere"),
    ]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    ties = sorted([("user", "tie a"), ("user", "tie b")], key=lambda t: sha(f"4:{t[0]}{t[1]}"))
    conversations = {
        1: [("user", "first"), ("", ""), *ties],
        2: [("user", "first"), ("", ""), ("user", "long " * 200_000)],
        3: [("user", "twice")] * 2,
        9: [],
    }
    convs = spark.createDataFrame([(1,), (2,), (3,), (9,), (9,)], "conv bigint")
    assert nodes_of(spark, turns, convs) == plain(conversations)
    assert nodes_of(spark, turns.limit(0)) == []
    none = convs.filter("conv = 9")
    assert nodes_of(spark, turns.limit(0), none) == plain({9: []})


def test_rebuilt_conversations_begin_with_another_one(spark):
    from zlib import crc32

    draw = random.Random(1)
    own = {c: [("user", f"{c}-{n}") for n in range(draw.randrange(1, 9))] for c in [*range(40), 100, 205, 299, 300]}
    with workspace(spark) as work:
        steps = work.write(prefixes.turn_steps(frame(spark, own), work), "steps")
        got = {}
        for r in rebuilt(steps).orderBy("conv", "pos").collect():
            got.setdefault(r["conv"], []).append((r["pos"], r["digest"]))
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 6
        want = own.get(c - c % 100, [])[:h] + turns[h:]
        digests = [sha(f"{len(r)}:{r}{t}")[:32] for r, t in want]
        assert got.get(c, []) == list(enumerate(digests))


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.lists(st.integers(0, 2), max_size=6), min_size=1, max_size=14),
    st.lists(st.integers(0, 14), max_size=4),
    st.randoms(),
)
def test_stretches_merge_to_the_same_forest(sequences, cuts, draw):
    classes = sorted({tuple(s) for s in sequences})
    ids = list(range(len(classes)))
    draw.shuffle(ids)
    items = []
    for place, turns in enumerate(classes):
        lcp = -1
        if place:
            pairs = zip(classes[place - 1], turns)
            lcp = next((d for d, (a, b) in enumerate(pairs) if a != b), min(len(classes[place - 1]), len(turns)))
        row = {"n": 1, "rep": ids[place], "depth": len(turns), "chars": len(turns) * 2, "lcp": lcp, "lcp_chars": lcp * 2}
        items.append(prefixes._leaf(row, place))
    edges = sorted({0, len(items), *[c for c in cuts if c < len(items)]})
    left, closed, same = [], [], {}
    for a, b in zip(edges, edges[1:]):
        block = prefixes.Block(items[a:b], float("inf"))
        left += block.join()
        closed += block.closed
        same |= {s["id"]: s["parent"] for s in block.same}
    last = prefixes.Block(left, -1)
    (rest,) = last.join()
    last.root(rest)
    closed += last.closed
    later = {s["id"]: s["parent"] for s in last.same}
    reps = {c["id"]: c["rep"] for c in closed}
    conversations = {i: [(str(t), "xx") for t in c] for i, c in zip(ids, classes)}
    wanted = {(r[0], r[1]): r for r in plain_trie(conversations)}
    seen = set()
    for c in closed:
        parent = same.get(c["parent"], c["parent"])
        parent = later.get(parent, parent)
        for depth in range(c["top"] + 1, c["depth"] + 1):
            saved = c["saved"] + (c["n"] - 1) * (c["chars"] - 2 * (depth - 1)) if depth else c["saved"]
            above = None if depth == 0 else (reps[parent] if depth == c["top"] + 1 else c["rep"])
            children = c["children"] if depth == c["depth"] else 1
            assert (c["rep"], depth, above, c["n"], children, c["leaves"], saved) == wanted[c["rep"], depth][:7]
            seen.add((c["rep"], depth))
    assert seen == set(wanted)
