"""Cases that earlier versions of the operators got wrong."""

import json
import time
from datetime import date, datetime
from decimal import Decimal

import pytest
from brute import judged, linked as plain_linked
from hypothesis import given, settings, strategies as st

from tidemark.llm import chat, jaccard, language, shards, tokens, urls
from tidemark.llm.queries import vocabulary
from tidemark.llm.shared import workspace


def test_more_languages_than_can_be_told_apart_are_refused(spark):
    rows = [(n, f"l{n % 205}", f"some letters {n}") for n in range(410)]
    frame = spark.createDataFrame(rows, "id bigint, lang string, text string")
    with pytest.raises(ValueError, match="more than 200 languages"):
        language.learn(frame)


def test_a_repeated_id_keeps_the_sample_bounded(spark, monkeypatch):
    rows = [(7, "en", f"the words of row {n}") for n in range(2000)]
    rows += [(n, "en", f"other words {n}") for n in range(100, 4100)]
    rows += [(None, "de", "gleich")] * 500 + [(n, "de", f"andere Worte {n}") for n in range(30)]
    seen = []
    monkeypatch.setattr(language, "fit", lambda x, names, *_: seen.extend(names))
    language.learn(spark.createDataFrame(rows, "id bigint, lang string, text string"))
    assert 0 < seen.count("en") < 1.3 * language.SAMPLE_PER_LANGUAGE
    assert 0 < seen.count("de") <= 31


@pytest.mark.parametrize("percent", [12, 20, 45, 80])
def test_links_of_sets_of_very_different_sizes(spark, percent):
    long = [f"w{n}" for n in range(1802)]
    texts = [" ".join(long[:n]) for n in (150, 402, 700, 820, 1500, 1802)]
    rows = list(enumerate(texts))
    with workspace(spark) as work:
        frame = spark.createDataFrame(rows, "doc_id bigint, text string")
        found = {r["doc_id"]: r for r in jaccard.link_documents(frame, work, 3, percent).collect()}
    for i, (n, group, links) in enumerate(plain_linked(texts, 3, percent)):
        assert (found[i]["n_shingles"], found[i]["component_id"], found[i]["n_links"]) == (n, min(group), links)


@pytest.mark.parametrize("warm", [True, False])
def test_words_known_from_the_start_change_no_id(spark, monkeypatch, warm):
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokens, "FIRST_WORDS", 50 if warm else 0)
    library = Tokenizer.from_file(vocabulary())
    texts = [f"the word{n % 7} of number {n}, naïve  日本{n % 5}\n" * (n % 4) for n in range(300)] + [None, ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    with workspace(spark) as work:
        tokens.write_tokens(frame, f"{work.path}/t", vocabulary(), work)
        got = {r["doc_id"]: r["ids"] for r in tokens.read_tokens(spark, f"{work.path}/t").collect()}
    for n, text in enumerate(texts):
        assert got[n] == [*library.encode(text or "", add_special_tokens=False).ids, 0]


def plain_tree(points, sizes, count):
    """Sizes of the shards of a plain k-d tree, whose cuts are made one after the other."""
    if count == 1:
        return [sum(sizes)]
    spans = [max(p[d] for p in points) - min(p[d] for p in points) for d in range(len(points[0]))]
    at = spans.index(max(spans))
    order = sorted(range(len(points)), key=lambda i: points[i][at])
    want, got, cut = sum(sizes) * (count // 2) / count, 0, 0
    while cut < len(order) and got + sizes[order[cut]] - want <= want - got:
        got += sizes[order[cut]]
        cut += 1
    halves = (order[:cut], count // 2), (order[cut:], count - count // 2)
    return [s for half, k in halves for s in plain_tree([points[i] for i in half], [sizes[i] for i in half], k)]


def test_shards_are_those_of_a_plain_tree(spark):
    # Coordinates of one scale and no ties, so that both trees cut the same.
    rows = [(n, float(n * 7919 % 10007), float(n * 104729 % 10007), 1 + n % 5) for n in range(500)]
    rows += [(500, 0.0, 0.0, 1), (501, 10006.0, 10006.0, 1)]
    frame = spark.createDataFrame(rows, "id bigint, x double, y double, size bigint")
    with workspace(spark) as work:
        placed = shards.kd_shards(frame, "size", ["x", "y"], 8, work).collect()
    sums = [sum(r["size"] for r in placed if r["shard"] == k) for k in range(8)]
    assert sums == plain_tree([r[1:3] for r in rows], [r[3] for r in rows], 8)


def test_every_kind_of_number_is_a_dimension(spark):
    nan, inf = float("nan"), float("inf")
    doubles = [nan, inf, -inf, 1e308, -1e308, None, 0.0, 5e-324]
    rows = [
        (n, doubles[n % 8], float(n % 3), Decimal(n) / 7, date(2020, 1, 1 + n % 28),
         datetime(2020, 1, 1, n % 24), n % 2 == 0, f"t{n}")
        for n in range(96)
    ]
    schema = "size bigint, a double, b float, c decimal(20,6), d date, e timestamp, f boolean, g string"
    frame = spark.createDataFrame(rows, schema)
    with workspace(spark) as work:
        placed = shards.kd_shards(frame, "size", list("abcdefg"), 5, work).collect()
    assert len(placed) == 96 and {r["shard"] for r in placed} == set(range(5))
    for dim, kept in (("c", True), ("d", True), ("a", False)):
        with workspace(spark) as work:
            two = shards.kd_shards(frame, "size", [dim], 2, work).collect()
        low, high = ([r[dim] for r in two if r["shard"] == k] for k in (0, 1))
        if kept:
            assert max(low) <= min(high)
        else:
            assert None in low + high and any(v != v for v in high if v is not None)
    nothing = frame.selectExpr("size", "cast('nan' as double) AS a")
    with workspace(spark) as work:
        assert len(shards.kd_shards(nothing, "size", ["a"], 4, work).collect()) == 96


def test_hosts_of_very_many_labels(spark):
    long = "http://" + "a." * 100_000 + "example.org/es/x"
    made = [long, long.replace("org", "net"), "http://" + "." * 50_000 + "/de/", "http://b.c.d.com/de/1", "http://org/"]
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("com", "/de/", "block")]
    pages = spark.createDataFrame(list(enumerate(made)), "page_id bigint, url string")
    frame = spark.createDataFrame(rules, "host string, path string, action string")
    start = time.time()
    found = {r["page_id"]: r for r in urls.judge_urls(pages, frame).collect()}
    assert time.time() - start < 30
    for n, url in enumerate(made):
        row = found[n]
        assert (row["host"], row["path"], row["rule"], row["verdict"]) == judged(url, rules)


# -- arguments of calls ----------------------------------------------------------------

ODD_ARGUMENTS = {
    "[" * 200_000: "nested too deeply", "[" * 600 + "]" * 600: None, '{"a":"\\ud800"}': "half of a surrogate pair",
    '{"a":NaN}': "not JSON", "-Infinity": "not JSON", '{"a":1,"a":2}': "name given twice",
    "9" * 5000: "number too long", "1e999": "number too large", "{": "not JSON", '"\x01"': "not JSON",
}


def test_no_text_of_arguments_crashes(spark):
    rows = [(1, n, "call", "assistant", None, f"c{n}", "any", text, None) for n, text in enumerate(ODD_ARGUMENTS)]
    schema = (
        "conv_id bigint, turn int, kind string, role string, text string, call_id string, "
        "name string, arguments string, needs array<string>"
    )
    with workspace(spark) as work:
        frame = spark.createDataFrame(rows, schema)
        found = chat.format_chats(frame, {"any": {}}, work).collect()
    assert len(found) == len(rows)
    for r in found:
        error = ODD_ARGUMENTS[r["arguments"]]
        assert r["errors"] == ([f".: {error}"] if error else [])
        assert error is None or json.loads(r["json"])["arguments"] == r["arguments"]


@pytest.mark.parametrize(
    "value,schema,wrong",
    [
        (None, {"type": ["integer", "null"]}, 0), (1.0, {"type": "integer"}, 0), (1.5, {"type": "integer"}, 1),
        (True, {"type": ["integer", "number"]}, 1), (5, {"maximum": 4}, 1), (5, {"exclusiveMaximum": 5}, 1),
        (5, {"exclusiveMinimum": 5}, 1), ("abc", {"maxLength": 2}, 1), ("abc", {"pattern": "^b"}, 1),
        (1, {"enum": [True, "1"]}, 1), (1, {"const": 1.0}, 0), ([1], {"minItems": 2}, 1), ([1], {"maxItems": 0}, 1),
        ({"x": 1, "y": "2"}, {"additionalProperties": {"type": "integer"}}, 1), (True, {"minimum": 3}, 0),
    ],
)
def test_keywords_of_schemas(value, schema, wrong):
    chat.check_schema(schema)
    assert len(chat.schema_errors(value, schema)) == wrong


def test_a_schema_that_would_not_be_checked_is_refused(spark):
    for schema in ({"anyOf": []}, {"items": {"format": "date"}}, {"properties": {"x": {"type": "date"}}}):
        with pytest.raises(ValueError, match="not supported|not known"):
            chat.check_schema(schema)
    with pytest.raises(ValueError, match="'anyOf' is not supported"), workspace(spark) as work:
        chat.format_chats(spark.range(0), {"t": {"anyOf": []}}, work)


JSON = st.recursive(
    st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(),
    lambda inner: st.lists(inner, max_size=4) | st.dictionaries(st.text(), inner, max_size=4),
    max_leaves=12,
)


@settings(max_examples=200, deadline=None)
@given(JSON)
def test_what_is_read_is_written_canonically(value):
    try:
        text = json.dumps(value)
        text.encode().decode()
        json.dumps(value, ensure_ascii=False).encode()
    except UnicodeEncodeError:
        return
    read = chat.parsed_json(text)
    assert read == value
    assert chat.canonical(chat.parsed_json(chat.canonical(read))) == chat.canonical(read)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet='{}[]",:0123456789eE+-.truefalsn\\ u퟿xé', max_size=40))
def test_any_text_is_read_or_refused(text):
    try:
        value = chat.parsed_json(text)
    except chat.ArgumentError:
        return
    json.loads(chat.canonical(value).encode())


def test_order_equals_that_of_all_edges(spark):
    """Random dependencies: results in any turn, needs in any direction, cycles included."""
    import random

    draw = random.Random(11)
    rows, edges, turns = [], [], {}
    for conv in range(12):
        calls = draw.randrange(1, 14)
        at = draw.sample(range(10_000 if conv % 2 else 40), 2 * calls)
        for c in range(calls):
            needs = [f"c{draw.randrange(calls)}" for _ in range(draw.choice([0, 1, 1, 2]))]
            rows.append((conv, at[2 * c], "call", None, None, f"c{c}", "any", "1", needs))
            rows.append((conv, at[2 * c + 1], "result", None, None, f"c{c}", None, None, None))
            edges.append(((conv, c, "call"), (conv, c, "result")))
            edges += [((conv, int(n[1:]), "result"), (conv, c, "call")) for n in needs]
            turns[conv, c, "call"], turns[conv, c, "result"] = at[2 * c], at[2 * c + 1]
    numbers = {v: i for i, v in enumerate(turns)}
    placed = chat.places(
        sorted({(numbers[u], numbers[v]) for u, v in edges}), {numbers[v]: t for v, t in turns.items()}
    )
    schema = (
        "conv_id bigint, turn int, kind string, role string, text string, call_id string, "
        "name string, arguments string, needs array<string>"
    )
    with workspace(spark) as work:
        found = chat.format_chats(spark.createDataFrame(rows, schema), {"any": {}}, work).collect()
    got = {(r["conv_id"], int(r["call_id"][1:]), r["kind"]): r["seq"] for r in found}
    for conv in range(12):
        own = [v for v in turns if v[0] == conv]
        wanted = sorted(own, key=lambda v: (*placed[numbers[v]], turns[v]))
        assert sorted(own, key=got.get) == wanted
