"""Lists of hot shingles and the filter of classes in the n-gram join."""

import random

import numpy as np
from brute import linked as plain_linked

from tidemark.llm import jaccard
from tidemark.llm.shared import workspace


def test_hot_lists_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "HOT_LEAST", 8)
    monkeypatch.setattr(jaccard, "HOT_MEANS", 0)
    monkeypatch.setattr(jaccard, "LIST_BLOCK", 16)
    made = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    base, texts = made.choices(vocabulary, k=60), []
    for _ in range(150):  # Near copies and unrelated texts that share a passage.
        copy = list(base)
        for _ in range(made.randint(0, 3)):
            copy[made.randrange(len(copy))] = made.choice(vocabulary)
        texts.append(" ".join(copy[: made.randint(50, 60)]))
    passage = " ".join(base[:12])
    texts += [f"{passage} {' '.join(made.choices(vocabulary, k=made.randint(1, 60)))}" for _ in range(80)]
    texts += [passage] * 20
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    with workspace(spark) as work:
        frame = work.write(frame, "documents")
        found = jaccard.link_documents(frame, work, size=3, percent=80).collect()
    found = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["n_links"]) for r in found)
    plain = [(i, n, min(group), links) for i, (n, group, links) in enumerate(plain_linked(texts, 3, 80))]
    assert found == plain


def test_slots_are_those_of_the_classes(spark):
    made = np.random.default_rng(1)
    nodes = made.integers(-(1 << 63), 1 << 63, 3000, dtype=np.int64)
    nodes[:3] = [0, -1, jaccard.SLOTS - 1]
    frame = spark.createDataFrame([(int(v),) for v in nodes], "v bigint")
    used = jaccard._slots(frame)
    assert len(used) == jaccard.SLOTS
    assert set(np.flatnonzero(used)) == set((nodes & (jaccard.SLOTS - 1)).tolist())
    assert not jaccard._slots(frame.limit(0)).any()
