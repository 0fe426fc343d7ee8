"""DuckDB SQL of the queries that SQL can express."""

ALNUM = r"regexp_extract_all(translate(text, '{A}', '{a}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')".format(
    A="ABCDEFGHIJKLMNOPQRSTUVWXYZ", a="abcdefghijklmnopqrstuvwxyz"
)
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACED = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"

OP1 = f"""
WITH items AS (
    SELECT item_id, {ALNUM} AS w FROM benchmark WHERE text IS NOT NULL
), windows AS (
    SELECT item_id, least(10, len(w)) AS size,
           array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS phrase
    FROM (SELECT *, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)
), docs AS (
    SELECT doc_id, coalesce({ALNUM}, []) AS w FROM documents
), sizes AS (
    SELECT DISTINCT size FROM windows
), spots AS (
    SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes
    WHERE len(w) >= size
), hits AS (
    SELECT doc_id, i, s.size, item_id
    FROM (SELECT *, array_to_string(list_slice(w, i, i + size - 1), ' ') AS phrase FROM spots) s
    JOIN windows USING (size, phrase)
), found AS (
    SELECT doc_id,
           count(DISTINCT item_id) AS n_items,
           array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS ids
    FROM hits GROUP BY doc_id
), covered AS (
    SELECT doc_id, count(DISTINCT word) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS word FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN found USING (doc_id) LEFT JOIN covered USING (doc_id)
"""

OP3 = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, coalesce({SPACED.format(text=LOWER)}, []) AS w FROM documents
), sets AS (
    SELECT doc_id, CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1),
                                          lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
    FROM words
), tokens AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS token FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id <> b.doc_id
         AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM sets
    UNION
    SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
), least AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a
), linked AS (
    SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id,
       coalesce(n_links, 0)::BIGINT AS n_links
FROM sets JOIN least USING (doc_id) LEFT JOIN linked USING (doc_id)
"""

OP6 = r"""
WITH parts AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0
                         THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), urls AS (
    SELECT page_id,
           translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM parts
), judged AS (
    SELECT *, CASE
        WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
        WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
        WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/') THEN 'org/'
        WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
        END AS rule
    FROM urls
)
SELECT *, CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/')
               THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""

OP9 = r"""
WITH turns AS (
    SELECT *, CASE role WHEN 'user' THEN 'call' WHEN 'assistant' THEN 'result'
                        ELSE 'message' END AS kind,
           CASE role WHEN 'user' THEN conv_id || '-' || turn
                     WHEN 'assistant' THEN conv_id || '-' || (turn - 1) END AS call_id,
           max(CASE WHEN role = 'user' THEN turn END) OVER (
               PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier,
           2 * turn + CASE WHEN role = 'assistant' AND turn % 4 IN (1, 2) THEN 5 ELSE 0 END AS place
    FROM conversations
), linked AS (
    SELECT t.*, CASE WHEN kind <> 'message' THEN EXISTS (
               SELECT 1 FROM turns o
               WHERE o.conv_id = t.conv_id AND o.call_id = t.call_id AND o.kind <> t.kind
                 AND o.kind <> 'message') END AS linked,
           kind = 'call' AND EXISTS (
               SELECT 1 FROM turns o WHERE o.conv_id = t.conv_id AND o.turn = t.earlier + 1
                 AND o.kind = 'result') AS waits
    FROM turns t
), chain AS (
    -- calls and their results in turn, cut where nothing is waited for
    SELECT *, sum(CASE WHEN kind = 'result' OR waits THEN 0 ELSE 1 END) OVER (
               PARTITION BY conv_id ORDER BY turn) AS part
    FROM linked WHERE kind = 'call' OR (kind = 'result' AND linked)
), ranked AS (
    SELECT *, row_number() OVER w AS k, max(place) OVER w AS rank
    FROM chain WINDOW w AS (PARTITION BY conv_id, part ORDER BY turn)
), placed AS (
    SELECT conv_id, turn, rank, k - min(k) OVER (PARTITION BY conv_id, part, rank) AS depth FROM ranked
), ordered AS (
    SELECT l.*, row_number() OVER (
               PARTITION BY l.conv_id ORDER BY coalesce(p.rank, l.place), coalesce(p.depth, 0), l.place) - 1 AS seq,
           l.conv_id % 7 = 3 AS plain
    FROM linked l LEFT JOIN placed p ON p.conv_id = l.conv_id AND p.turn = l.turn
)
SELECT conv_id, turn, kind, seq::BIGINT AS seq, call_id, linked,
       CASE WHEN kind = 'call' AND (plain OR length(text) = 0 OR length(text) > 1000) THEN 1 ELSE 0 END AS n_errors,
       CASE kind
           WHEN 'message' THEN '{"content":' || to_json(text) || ',"role":' || to_json(role) || '}'
           WHEN 'call' THEN '{"arguments":'
               || CASE WHEN plain AND text = '' THEN 'null' WHEN plain THEN to_json(text)::VARCHAR
                       ELSE '{"text":' || to_json(text) || ',"turn":' || turn || '}' END
               || ',"call_id":' || to_json(call_id) || ',"linked":' || linked
               || ',"name":"reply","role":"user"}'
           ELSE '{"call_id":' || to_json(call_id) || ',"content":' || to_json(text)
               || ',"linked":' || linked || ',"role":"assistant"}'
       END AS json
FROM ordered
"""

NOTICE = (
    "(?i)all rights reserved|copyright|©|cookie|privacy policy|terms of (?:use|service)|"
    "enable javascript|licen[sc]ed under|unsubscribe|powered by"
)
LINE_WORDS = r"len(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))"

SHORT_LINE = r"""regexp_matches(line, '(?i)\b(home|menu|log ?in|sign ?(in|up)|register|next|previous|back to top|read more|share|subscribe|contact us|about us|sitemap|search)\b')
             AND len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) <= 6"""

OP10 = rf"""
WITH words AS (
    SELECT doc_id, coalesce(text, '') AS text,
           {SPACED.format(text="coalesce(text, '')")} AS w FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') AS phrase
    FROM (SELECT *, unnest(range(1, len(w) - 6)) AS i FROM words)
), repeated AS (
    SELECT doc_id, count(DISTINCT word) AS n FROM (
        SELECT doc_id, unnest(range(i, i + 8)) AS word FROM (
            SELECT *, count(*) OVER (PARTITION BY doc_id, phrase) AS times FROM windows
        ) WHERE times > 1
    ) GROUP BY doc_id
), lines AS (
    SELECT doc_id, line, len(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS size,
           NOT regexp_matches(line, '[.!?;:…。！？；：｡।॥؟؛۔።፧។៕၊။]')
           OR len(regexp_extract_all(line, '[#*$%&|<>]')) * 100 > length(line) * 10
           OR (len(regexp_extract_all(line, '[|<>»•→]')) >= 2
               AND {LINE_WORDS} <= 8 * len(regexp_extract_all(line, '[|<>»•→]')))
           OR ({SHORT_LINE})
           OR (regexp_matches(line, '{NOTICE}')
               AND {LINE_WORDS} <= 20 * len(regexp_extract_all(line, '{NOTICE}'))) AS fails
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), of_lines AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines,
           sum(CASE WHEN fails THEN 0 ELSE size END) AS size_left
    FROM lines GROUP BY doc_id
), counted AS (
    SELECT doc_id, len(w)::BIGINT AS n_words,
           length(array_to_string(w, ''))::BIGINT AS word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
           coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
           coalesce(size_left, 0) AS size_left
    FROM words LEFT JOIN repeated USING (doc_id) LEFT JOIN of_lines USING (doc_id)
), failed AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * size_left >= 50 * word_chars AS kept
FROM failed
"""

# The bitwise CRC-32 of the decimal text of a number; SQL has no function of that name.
CRC32 = """xor(4294967295::BIGINT, list_reduce(
    list_transform(range(1, length({x}::VARCHAR) + 1), lambda i: ascii(substr({x}::VARCHAR, i, 1))::BIGINT),
    lambda crc, byte: list_reduce(
        [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
        lambda c, k: xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END),
        xor(crc, byte)),
    4294967295::BIGINT))"""

OP11 = f"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, conv_id - conv_id % 100 AS base, {CRC32.format(x="conv_id")} % 6 AS h
    FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
    SELECT c.conv_id, 0 AS own, t.pos, t.role, t.text
    FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos < c.h
    UNION ALL
    SELECT c.conv_id, 1, t.pos, t.role, t.text FROM convs c JOIN turns t USING (conv_id)
    WHERE t.pos >= c.h
), prefixes AS MATERIALIZED (
    SELECT conv_id, 0 AS d, '' AS key, 0 AS chars FROM convs
    UNION ALL
    SELECT conv_id, row_number() OVER w, sha256(string_agg(said, '') OVER w), chars
    FROM (SELECT *, length(text) AS chars, sha256(length(role) || ':' || role || text) AS said
          FROM rebuilt)
    WINDOW w AS (PARTITION BY conv_id ORDER BY own, pos)
), nodes AS MATERIALIZED (
    SELECT d, key, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars
    FROM prefixes GROUP BY d, key
), hung AS MATERIALIZED (
    SELECT n.*, p.key AS above_key, p.conv_id AS parent_conv_id
    FROM nodes n
    LEFT JOIN prefixes q ON q.conv_id = n.conv_id AND q.d = n.d - 1
    LEFT JOIN nodes p ON p.d = q.d AND p.key = q.key
), children AS (
    SELECT d - 1 AS d, above_key AS key, count(*) AS n_children FROM hung WHERE d > 0 GROUP BY ALL
), counted AS MATERIALIZED (
    SELECT h.*, coalesce(n_children, 0) AS n_children FROM hung h LEFT JOIN children USING (d, key)
), below AS (
    SELECT q.d, q.key, sum((c.n_convs - 1) * c.chars) AS saved, count_if(c.n_children = 0) AS leaves
    FROM counted c JOIN prefixes q ON q.conv_id = c.conv_id AND q.d <= c.d GROUP BY q.d, q.key
), ended AS (
    SELECT d, key, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
    FROM (SELECT * FROM prefixes QUALIFY d = max(d) OVER (PARTITION BY conv_id)) GROUP BY d, key
)
SELECT conv_id, d::BIGINT AS depth, parent_conv_id, n_convs::BIGINT AS n_convs,
       n_children::BIGINT AS n_children, leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM counted JOIN below USING (d, key) LEFT JOIN ended USING (d, key)
"""


def _op12() -> str:
    """Rounds of assignments and new entries, one after the other."""
    steps = ["""
WITH kept AS (
    SELECT row_number() OVER (ORDER BY vec_id) - 1 AS r, vec_id, label,
           list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
    SELECT r, vec_id, label, p, list_slice(v, p * len(v) // 4 + 1, (p + 1) * len(v) // 4) AS x
    FROM (SELECT *, unnest(range(4)) AS p FROM kept)
), book0 AS MATERIALIZED (
    SELECT p, r AS e, x AS c FROM parts WHERE r < 256
)"""]
    for k in range(5):
        steps.append(f""", near{k} AS MATERIALIZED (
    SELECT r, p, min({{'d': list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))),
                      'e': e}}) AS best
    FROM parts JOIN book{k} USING (p) GROUP BY r, p
)""")
        if k == 4:
            continue
        steps.append(f""", sums{k} AS (
    SELECT p, e, i, sum(x)::BIGINT AS s, count(*) AS n FROM (
        SELECT p, best.e AS e, unnest(x) AS x, generate_subscripts(x, 1) AS i
        FROM near{k} JOIN parts USING (r, p))
    GROUP BY p, e, i
), book{k + 1} AS MATERIALIZED (
    SELECT p, e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN (
        SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM sums{k} GROUP BY p, e
    ) m USING (p, e)
)""")
    steps.append(""", coded AS (
    SELECT r, vec_id, label, string_agg(format('{:02x}', best.e), '' ORDER BY p) AS code,
           sum(best.d)::BIGINT AS error
    FROM near4 JOIN parts USING (r, p) GROUP BY r, vec_id, label
), books AS (
    SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book4
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       codebooks_sha256
FROM coded, books
""")
    return "".join(steps)


OP13 = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, coalesce({SPACED.format(text=LOWER)}, []) AS w FROM documents
), sets AS (
    SELECT doc_id, CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 2 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
    FROM words
), tokens AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS token FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id <> b.doc_id
         AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM sets
    UNION
    SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
), least AS (
    SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op1_decontamination": OP1,
    "op3_ngram_jaccard": OP3,
    "op6_url_filters": OP6,
    "op9_chat_format": OP9,
    "op10_quality_rules": OP10,
    "op11_prefix_trie": OP11,
    "op12_vector_codes": _op12(),
    "op13_hyperminhash": OP13,
}
