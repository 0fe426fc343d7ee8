"""Whole jobs: what an earlier version of an operator left out."""

import random
import string

import pytest

import corpus_pipeline
from tidemark.llm import chat, secrets
from tidemark.llm.queries import table
from tidemark.llm.shared import workspace

FOREIGN = [
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on "
    "annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni "
    "obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
    "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом.",
    "def f(x):\n    kwargs = dict(fmt='%s', idx=i+1)\n    np.zeros((n, k), dtype=np.float32)\n"
    "    while (ptr != NULL && ptr->next) { i++; buf[i] = 0x1f; }\n" * 3,
]


@pytest.mark.parametrize("languages", [("de", "en", "es", "fr"), ("de", "en"), ("en", "es"), ("fr",)])
def test_language_stage_rejects_unlearned_texts(spark, languages):
    made = random.Random(11)
    small = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in table(spark, small, "documents").collect()]
    clean = [r for r in rows if r[2] in languages]
    letters = string.ascii_lowercase
    noise = [" ".join("".join(made.choices(letters, k=made.randint(2, 9))) for _ in range(n))
             for n in (20, 40, 100, 400)]
    one, two = languages[0], languages[-1]
    firsts = [r[1][:300] for r in clean if r[2] == one and len(r[1]) > 600][:20]
    seconds = [r[1][:300] for r in clean if r[2] == two and len(r[1]) > 600][:20]
    mixed = [f"{a} {b}" for a, b in zip(firsts, seconds, strict=True)]
    odd = [(-1 - i, t, None, "s", len(t)) for i, t in enumerate(noise + FOREIGN)]
    fine = [(-100 - i, t, None, "s", len(t)) for i, t in enumerate(mixed)]
    schema = table(spark, small, "documents").schema
    docs = spark.createDataFrame(clean + odd + fine, schema)
    left = {r["doc_id"] for r in corpus_pipeline.language_id(spark, docs, small).collect()}
    assert not left & {r[0] for r in odd}
    assert {r[0] for r in fine} <= left
    assert len(left & {r[0] for r in clean}) >= 0.998 * len(clean)


def test_secrets_in_runs_of_both_alphabets(spark):
    made = random.Random(5)
    plain = string.ascii_letters + string.digits
    url = "".join(made.choices(plain + "-_", k=60))
    std = "".join(made.choices(plain + "+/", k=60))
    joint = "".join("".join(made.choices(plain, k=8)) + "/-"[i % 2] for i in range(14))
    assert set(url) & set("-_") and set(std) & set("+/")
    texts = [
        f"see https://é.example/reset/{url} now", f"it is key_{std} here",
        f"both /{url}/key-{std}, and more", joint, "a/long/path_of/some-plain/words_and/so-on_it/goes",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    with workspace(spark) as work:
        rows = {r["doc_id"]: r["spans"] for r in secrets.scan_secrets(frame, work).collect()}
    spans = [{t[int(a) : int(b)] for k, a, b in (s.split(":") for s in rows[i].split(",") if s)}
             for i, t in enumerate(texts)]
    assert url in spans[0] and std in spans[1] and joint in spans[3] and not spans[4]
    assert url in spans[2] and std in spans[2]
    clean = [r["text"] for r in secrets.redact_secrets(frame).orderBy("doc_id").collect()]
    assert clean[0] == "see https://é.example/reset/[SECRET] now"
    assert clean[1] == "it is key_[SECRET] here"
    assert url not in clean[2] and std not in clean[2] and clean[2].endswith(", and more")
    assert clean[3:] == ["[SECRET]", texts[4]]


EVENTS = (
    "conv_id bigint, turn int, kind string, role string, text string, call_id string, "
    "name string, arguments string, needs array<string>"
)


def in_order(spark, rows):
    frame = spark.createDataFrame(rows, EVENTS)
    with workspace(spark) as work:
        found = chat.format_chats(frame, {}, work).collect()
    assert len(found) == len(rows)
    return [(r["kind"], r["call_id"]) for r in sorted(found, key=lambda r: r["seq"])]


def event(turn, kind, name, needs=None):
    return (1, turn, kind, "assistant", "t", name, "f", None, needs)


def test_long_chains_are_ordered(spark):
    n = 200
    rows = []
    for i in range(n):  # Turns are the reverse of what the calls need.
        rows.append(event(2 * (n - i) + 1, "call", f"c{i}", [f"c{i - 1}"] if i else None))
        rows.append(event(2 * (n - i), "result", f"c{i}"))
    expected = [(kind, f"c{i}") for i in range(n) for kind in ("call", "result")]
    assert in_order(spark, rows) == expected
    # The first call has a late turn, all others are in order.
    rows = [event(10_000, "call", "c0"), event(1, "result", "c0")]
    for i in range(1, n):
        rows.append(event(2 * i, "call", f"c{i}", [f"c{i - 1}"]))
        rows.append(event(2 * i + 1, "result", f"c{i}"))
    assert in_order(spark, rows) == expected


def test_only_cycles_keep_the_order_of_turns(spark):
    rows = [
        event(0, "result", "z"), event(1, "call", "z", ["y"]),
        event(2, "result", "x"), event(3, "call", "x", ["y"]),
        event(4, "call", "y", ["x"]), event(5, "result", "y"),
        event(6, "result", "a"), event(7, "call", "a"),
    ]
    found = in_order(spark, rows)
    cycle = [e for e in found if e[1] in ("x", "y")]
    assert cycle == [("result", "x"), ("call", "x"), ("call", "y"), ("result", "y")]
    # What only follows a cycle, and what has nothing to do with it, is put in order.
    assert found.index(("result", "y")) < found.index(("call", "z")) < found.index(("result", "z"))
    assert found.index(("call", "a")) < found.index(("result", "a"))
