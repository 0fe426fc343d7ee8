"""Plain versions of the operators, one text at a time, to compare with."""

from __future__ import annotations

import hashlib
import math
import re
import string

ASCII_LOWER = {i: i + 32 for i in range(65, 91)}


def lowered(text):
    return (text or "").translate(ASCII_LOWER)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def contamination(text, items):
    """(n_words, n_hit, n_items, items_sha256, contaminated) of a text."""
    words = alnum_words(text)
    hit, found = set(), set()
    for item_id, item in items:
        own = alnum_words(item)
        size = min(10, len(own))
        if not size:
            continue
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
                if item_id is not None:
                    found.add(str(item_id))
    ids = ",".join(sorted(found))
    return len(words), len(hit), len(found), sha(ids), bool(hit)


def shingle_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def linked(texts, size, percent):
    """Per position, (number of shingles, positions of the component, number of links)."""
    sets = [shingle_set(t, size) for t in texts]
    by_token = {}
    for n, s in enumerate(sets):
        for token in s:
            by_token.setdefault(token, []).append(n)
    root, n_links = list(range(len(sets))), [0] * len(sets)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, s in enumerate(sets):
        near = {m for token in s for m in by_token[token] if m > n}
        for m in near:
            both = len(s & sets[m])
            if 100 * both >= percent * len(s | sets[m]):
                root[find(m)] = find(n)
                n_links[n] += 1
                n_links[m] += 1
    groups = {}
    for n in range(len(sets)):
        groups.setdefault(find(n), []).append(n)
    return [(len(s), groups[find(n)], n_links[n]) for n, s in enumerate(sets)]


ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def base_spans(text):
    text = text or ""
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [
        (m.start(), 1, m.end(), "access")
        for m in re.finditer(r"AKIA[A-Z0-9]+", text)
        if len(m[0]) >= 20
    ]
    spans += [
        (m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24
    ]
    return sorted(spans)


def written(spans):
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in spans)


ALPHABETS = [
    "", "0123456789abcdef", "0123456789ABCDEF", string.ascii_lowercase,
    string.ascii_uppercase + "234567", string.digits + string.ascii_lowercase,
    string.digits + string.ascii_uppercase, string.ascii_uppercase + string.ascii_lowercase,
    string.ascii_uppercase + string.ascii_lowercase + string.digits,
    string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/",
    string.ascii_uppercase + string.ascii_lowercase + string.digits + "-_",
    string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/-_",
]


def text_chance(token):
    """The chance that text looks as random as the token: chi-squared, runs, serial correlation
    and evenness, by their definitions."""
    if token.isdecimal():
        return 1.0
    alphabet = next(a for a in ALPHABETS[1:] if set(token) <= set(a))
    k, n, values = len(alphabet), len(token), [alphabet.index(c) for c in token]

    def below(z):
        z = max(min(1.5976 * z + 0.07056 * z**3, 60.0), -60.0)
        return 1 / (1 + math.exp(-z))

    def against(z):
        variance = 1 + n / 4
        return max(z * z / 2 * (1 - 1 / variance) - math.log(variance) / 2, 0.0)

    chi = sum((values.count(v) - n / k) ** 2 / (n / k) for v in range(k))
    excess = k * (0.2 if k == 16 else 0.0667) - 1
    spread = math.sqrt(2 * (k - 1) + 4 * n * excess)
    chance = below((chi - (n - 1) * excess - (k - 1)) / spread)
    high = [2 * v >= k for v in values]
    ones, runs = sum(high), 1 + sum(a != b for a, b in zip(high, high[1:]))
    if ones in (0, n):
        return 1.0
    expected = 1 + 2 * ones * (n - ones) / n
    runs_z = (runs - expected) / math.sqrt((expected - 1) * (expected - 2) / (n - 1))
    mean = sum(values) / n
    serial = sum((a - mean) * (b - mean) for a, b in zip(values, values[1:]))
    serial_z = (serial / sum((v - mean) ** 2 for v in values) + 1 / n) * math.sqrt(n)
    step = 2 / (9 * (k - 1))
    even_z = min(((max(chi, 0.0) / (k - 1)) ** (1 / 3) - 1 + step) / math.sqrt(step), 0.0)
    return min(chance * math.exp(min(sum(map(against, (runs_z, serial_z, even_z))), 80)), 1.0)


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed) of a text."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
        len(words) < 20 or 100 * len(covered) > 30 * len(words),
    )


RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def judged(url, rules=RULES):
    """(host, path, rule, verdict) of a URL."""
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    host = lowered(re.match(r"[^/?#]*", rest)[0])
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    fits = [
        (len(h) + len(p), h + p, action)
        for h, p, action in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if not fits:
        return host, path, None, "allow"
    _, rule, action = max(fits)
    return host, path, rule, action


def trie(conversations):
    """Nodes of {conversation: [(role, text), …]} as (conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ids that end there)."""
    members = {}
    for conv, turns in conversations.items():
        for depth in range(len(turns) + 1):
            members.setdefault(tuple(turns[:depth]), []).append(conv)
    rows = []
    for prefix, own in members.items():
        depth = len(prefix)
        below = {p: m for p, m in members.items() if p[:depth] == prefix}
        parents = {p[:-1] for p in members if p}
        rows.append((
            min(own), depth, min(members[prefix[:-1]]) if prefix else None, len(own),
            sum(len(p) == depth + 1 for p in below), sum(p not in parents for p in below),
            sum((len(m) - 1) * len(p[-1][1]) for p, m in below.items() if p),
            ",".join(map(str, sorted(c for c in own if len(conversations[c]) == depth))),
        ))
    return rows


def vector_codes(rows, parts=4, entries=256, rounds=4, scale=1024):
    """Of (id, vector, label) rows: (id, code, error, label_error) each, and the codebooks."""
    whole = [[math.floor(scale * x) for x in v] for _, v, _ in rows]
    width = len(whole[0]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in whole]
    start = sorted(range(len(rows)), key=lambda r: (rows[r][0] is None, rows[r][0], rows[r][1]))
    books = [[cut[r][p] for r in start[:entries]] for p in range(parts)]

    def assign(p):
        apart = lambda x, e: sum((a - b) ** 2 for a, b in zip(x, e, strict=True))
        return [min((apart(v[p], e), n) for n, e in enumerate(books[p])) for v in cut]

    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for v, (_, entry) in zip(cut, assign(p), strict=True):
                held.setdefault(entry, []).append(v[p])
            for entry, some in held.items():
                books[p][entry] = [sum(c) // len(some) for c in zip(*some, strict=True)]
    found = [assign(p) for p in range(parts)]
    errors = [sum(f[r][0] for f in found) for r in range(len(rows))]
    codes = ["".join(f"{f[r][1]:02x}" for f in found) for r in range(len(rows))]
    by_label = {}
    for (_, _, label), error in zip(rows, errors, strict=True):
        by_label[label] = by_label.get(label, 0) + error
    out = [(r[0], c, e, by_label[r[2]]) for r, c, e in zip(rows, codes, errors, strict=True)]
    return out, books
