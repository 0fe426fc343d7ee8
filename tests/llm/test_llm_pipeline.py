"""Each stage of the pipeline over whole tables, next to a plain version."""

import re

import pytest
from brute import ASSIGN, contamination, linked, sha

import corpus_pipeline
from tidemark.llm.queries import table, vocabulary
from tidemark.llm.shared import workspace


@pytest.fixture(scope="module")
def small():
    """The smallest scale has too few documents for a secret to reach the fourth stage."""
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, small):
    """Rows before the first stage and after each."""
    with workspace(spark) as work:
        docs = table(spark, small, "documents")
        out = [(docs.columns, docs.collect())]
        for name, stage in corpus_pipeline.STAGES:
            docs = work.write(stage(spark, docs, small), name)
            out.append((docs.columns, docs.collect()))
    return out


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_duplicates", "decontaminate", "secret_scan", "bpe_round_trip",
    ]
    columns = stages[0][0]
    assert all(c == columns for c, _ in stages[:-1])


def test_language_keeps_clean_documents(stages):
    before, after = stages[0][1], stages[1][1]
    texts = {r["doc_id"]: r["text"] for r in after}
    assert all(texts[r["doc_id"]] == r["text"] for r in before if re.search(r"[^\W\d_]", r["text"]))
    langs = {r["doc_id"]: r["lang"] for r in before}
    assert sum(langs[r["doc_id"]] == r["lang"] for r in after) >= 0.97 * len(after)


def test_one_of_each_group_stays(stages):
    before, after = stages[1][1], stages[2][1]
    kept = set()
    for row, (_, group, _) in zip(before, linked([r["text"] for r in before], 5, 80), strict=True):
        kept.add(min(before[m]["doc_id"] for m in group))
    assert sorted(r["doc_id"] for r in after) == sorted(kept)
    assert len(kept) < len(before)


def test_no_benchmark_window_stays(spark, small, stages):
    items = [tuple(r) for r in table(spark, small, "benchmark").select("item_id", "text").collect()]
    before, after = stages[2][1], stages[3][1]
    clean = [r["doc_id"] for r in before if not contamination(r["text"], items)[4]]
    assert sorted(r["doc_id"] for r in after) == sorted(clean)
    assert len(clean) < len(before)


def test_secrets_are_marked(stages):
    before, after = stages[3][1], {r["doc_id"]: r for r in stages[4][1]}
    assert len(before) == len(after)
    marked = 0
    for r in before:
        text = r["text"]
        text = ASSIGN.sub(lambda m: "[SECRET]" if len(m[2]) >= 6 else m[0], text)
        text = re.sub(r"AKIA[A-Z0-9]{16,}", "[SECRET]", text)
        text = re.sub(r"[0-9a-f]{24,}", "[SECRET]", text)
        found = after[r["doc_id"]]
        marked += found["text"] != r["text"]
        assert found["n_chars"] == len(found["text"])
        # Random tokens of what is left may be marked as well, and nothing else.
        parts = map(re.escape, re.split(r"[A-Za-z0-9+/_-]{20,}", text))
        assert re.fullmatch(r"(?:[A-Za-z0-9+/_-]{20,}|\[SECRET\])".join(parts), found["text"])
    assert 0 < marked < len(before) / 2


def test_round_trip(stages):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary())
    before, after = stages[4][1], {r["doc_id"]: r for r in stages[5][1]}
    assert len(before) == len(after)
    for r in before:
        ids = library.encode(r["text"], add_special_tokens=False).ids
        found = after[r["doc_id"]]
        assert (found["n_tokens"], found["ids_sha256"]) == (len(ids), sha(",".join(map(str, ids))))
        assert found["decoded_sha256"] == sha(r["text"])


def test_run_is_the_stages_in_a_row(spark, small, stages):
    rows = corpus_pipeline.run(spark, small).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, stages[5][1]))


def test_odd_documents(spark, tmp_path):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, extra string"
    rows = [
        (None, "plain words of a text without an id", "en", None, None, "x"),
        (1, None, "en", "s", 0, None),
        (1, "", None, "s", 0, None),
        (2, "12 34 !!", "en", "s", 8, None),
        (3, "the same words stand here twice, they do", "en", "s", 40, None),
        (3, "the same words stand here twice, they do", "en", "s", 40, None),
        (4, "der die das und nicht eine " * 9, "de", "s", 9, None),
    ]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, None)], "item_id bigint, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r["doc_id"] or 0 for r in found) == [0, 3, 4]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
