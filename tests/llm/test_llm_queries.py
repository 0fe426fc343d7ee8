"""The registered queries over whole tables, next to SQL or a plain version."""

import zlib

import numpy as np
import pytest
from brute import base_spans, sha, written

import corpus_pipeline
from checks.compare import connect, difference
from tidemark.llm.oracles import ORACLES
from tidemark.llm.queries import QUERIES, table, vocabulary


@pytest.fixture(scope="module")
def docs(spark, small):
    return {r["doc_id"]: r for r in table(spark, small, "documents").collect()}


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


def test_all_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, small, name):
    assert difference(spark, connect(small), small, name, QUERIES, ORACLES) is None


def test_languages_of_held_out_rows(spark, small, docs):
    rows = QUERIES["op2_language_id"](spark, small).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    held = [r for r in rows if r["held_out"]]
    assert held and all(r["held_out"] == (zlib.crc32(b"%d" % r["doc_id"]) % 4 == 2) for r in rows)
    right = sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held)
    assert right >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_shards_have_equal_bytes(spark, small, docs):
    rows = QUERIES["op4_kd_shards"](spark, small).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    sizes, slots = {}, {}
    for r in rows:
        data = docs[r["doc_id"]]["text"].encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 16, zlib.crc32(data))
        assert (r["law"], r["grown_shard"]) == ("bytes", None)
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(sizes) == set(range(40))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r["size"] for r in rows)


def test_ids_and_round_trip_are_the_library_s(spark, small, docs, tokenizer):
    rows = QUERIES["op5_bpe"](spark, small).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = tokenizer.encode(docs[r["doc_id"]]["text"], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == sha(",".join(map(str, ids)))
        assert r["decoded_sha256"] == sha(tokenizer.decode(ids, skip_special_tokens=False))


def test_base_spans_and_added_spans(spark, small, docs):
    rows = QUERIES["op7_secret_scan"](spark, small).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = base_spans(docs[r["doc_id"]]["text"])
        assert r["base_sha256"] == sha(written(base))
        for kind in ("assign", "access", "hex"):
            assert r[f"n_{kind}"] == sum(s[3] == kind for s in base)
        spans = r["spans"].split(",") if r["spans"] else []
        assert [s for s in spans if not s.startswith("random")] == [
            s for s in written(base).split(",") if s
        ]


def test_files_hold_ids_in_order(spark, small, docs, tokenizer):
    rows = {r["doc_id"]: r for r in QUERIES["op8_token_files"](spark, small).collect()}
    start = 0
    for doc_id in sorted(docs):
        ids = [*tokenizer.encode(docs[doc_id]["text"], add_special_tokens=False).ids, 0]
        data = np.array(ids, dtype="<u4").tobytes()
        found = rows.pop(doc_id)
        assert (found["start"], found["n_tokens"]) == (start, len(ids))
        assert found["ids_crc32"] == zlib.crc32(data)
        start += len(ids)
    assert not rows
