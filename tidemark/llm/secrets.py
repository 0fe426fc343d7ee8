"""Secret scans: fixed patterns, and long tokens that pass a battery of randomness tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import Work, let, packed, unpacked

# The base patterns. A match whose tested group is too short is dropped.
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"  # AKIA[A-Z0-9]+ of 20 characters or more
HEX = r"[0-9a-f]{24,}"  # [0-9a-f]+ of 24 characters or more
ASSIGN_LEAST = 6

# Tokens that are tested: runs of characters that encodings use. A run that mixes the signs of
# the two base64 alphabets is tested in parts, split at the signs of either one.
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
LEAST = 20
SIGNS = [r"[+/]", r"[_-]"]
# Encodings, smallest alphabet first. Digits alone are no encoding of secrets.
ENCODINGS = [
    (r"^[0-9]+$", ""),
    (r"^[0-9a-f]+$", "0123456789abcdef"),
    (r"^[0-9A-F]+$", "0123456789ABCDEF"),
    (r"^[a-z]+$", "abcdefghijklmnopqrstuvwxyz"),
    (r"^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    (r"^[a-z0-9]+$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    (r"^[A-Z0-9]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    (r"^[A-Za-z]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    (r"^[A-Za-z0-9]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    (r"^[A-Za-z0-9+/]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    (r"^[A-Za-z0-9_-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
    (r"^[A-Za-z0-9+/_-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"),
]
# How often two characters of ordinary text are the same, in letters and in what looks like hex.
COINCIDENCE, HEX_COINCIDENCE = 0.0667, 0.2
# Share of false finds, steps of p-values per power of ten. Of tokens in some order, the outcomes of
# the other tests spread as if neighbours were correlated by about ORDER.
FALSE_FINDS, STEPS, TOP = 0.01, 20, 400
ORDER = 0.5
CHUNK = 512

KINDS = ["assign", "access", "hex", "random"]


def _before(lengths: Column) -> Column:
    """For each length, the sum of those before it. Sums run inside chunks and over the chunks'
    totals, so the work grows with the number of lengths and not with its square."""

    def running(values: Column, start: Column) -> Column:
        # One value more than there are: the last is the total.
        return F.aggregate(
            values,
            F.array(start),
            lambda out, n: F.concat(out, F.array(F.get(out, F.size(out) - 1) + n)),
        )

    zero = F.lit(0).cast("long")

    def chunked(ls: Column) -> Column:
        number = F.floor((F.size(ls) + (CHUNK - 1)) / CHUNK).cast("int")
        places = F.sequence(F.lit(0), number - 1)
        parts = F.transform(places, lambda c: F.slice(ls, c * CHUNK + 1, F.lit(CHUNK)))
        return let(parts, lambda ps: let(
            running(
                F.transform(ps, lambda p: F.aggregate(p, zero, lambda a, n: a + n)), zero
            ),
            lambda firsts: F.flatten(F.transform(
                ps, lambda p, c: F.slice(running(p, F.get(firsts, c)), F.lit(1), F.size(p))
            )),
        ))

    return F.when(F.size(lengths) > 0, let(lengths, chunked)).otherwise(
        F.array().cast("array<bigint>")
    )


def _spans(text: Column, pattern: str, kind: str, value: Column) -> Column:
    """Matches of a pattern as (start, order, end, kind, value), in code points; ``value`` is
    what is told about each match, an array as long as the matches."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(matches: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        sizes = F.zip_with(
            F.slice(gaps, F.lit(1), F.size(matches)),
            matches,
            lambda gap, match: F.struct(
                F.length(gap).cast("long").alias("gap"), F.length(match).cast("long").alias("size")
            ),
        )
        return let(sizes, lambda ss: F.zip_with(
            F.zip_with(
                ss,
                _before(F.transform(ss, lambda s: s["gap"] + s["size"])),
                lambda s, at: F.struct(
                    (at + s["gap"]).alias("start"),
                    F.lit(KINDS.index(kind)).alias("order"),
                    (at + s["gap"] + s["size"]).alias("end"),
                    F.lit(kind).alias("kind"),
                ),
            ),
            value,
            lambda span, v: F.struct(
                span["start"].alias("start"), span["order"].alias("order"),
                span["end"].alias("end"), span["kind"].alias("kind"), v.alias("value"),
            ),
        ))

    none = "array<struct<start:bigint,order:int,end:bigint,kind:string,value:double>>"
    return let(
        found,
        lambda ms: F.when(F.size(ms) > 0, placed(ms).cast(none)).otherwise(F.array().cast(none)),
    )


def base_spans(text: Column) -> Column:
    """Spans of the base patterns that are long enough, unsorted."""
    sizes = F.transform(
        F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v).cast("double")
    )
    assign = F.filter(
        _spans(text, ASSIGN, "assign", sizes), lambda s: s["value"] >= ASSIGN_LEAST
    )

    def plain(pattern: str, kind: str) -> Column:
        none = F.transform(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.lit(0.0)
        )
        return _spans(text, pattern, kind, none)

    return F.concat(assign, plain(ACCESS, "access"), plain(HEX, "hex"))


# -- randomness ------------------------------------------------------------------------


def _below(z: Column) -> Column:
    """The normal distribution up to z, by a logistic curve that is right to two digits."""
    return 1 / (1 + F.exp(-F.greatest(F.least(1.5976 * z + 0.07056 * z * z * z, F.lit(60.0)), F.lit(-60.0))))


def _against(z: Column, n: Column) -> Column:
    """Logarithm of how much likelier the outcome z of a test of n characters is for tokens in
    some order than for random ones, or 0 if it is not likelier: at random z has variance 1, in
    order 1 + n * ORDER^2."""
    variance = 1 + n * ORDER * ORDER
    likelier = z * z / 2 * (1 - 1 / variance) - F.log(variance) / 2
    return F.when(z.isNotNull(), F.greatest(likelier, F.lit(0.0)))


def _alphabet(token: Column) -> Column:
    chosen = F.lit("")
    for pattern, alphabet in reversed(ENCODINGS):
        chosen = F.when(token.rlike(pattern), F.lit(alphabet)).otherwise(chosen)
    return chosen


def text_chance(token: Column) -> Column:
    """The chance that ordinary text of the token's length looks as random as the token, in its
    characters and in their order.

    The encoding is the smallest alphabet that holds all characters. Chi-squared of the
    characters' counts against a uniform alphabet of k is near k - 1 for random tokens; for
    text it grows with the length, by what the characters' coincidence exceeds 1/k. So a short
    token proves little and a long one much. The runs test (above and below the alphabet's
    middle), the serial correlation of neighbours and the evenness of the counts (a sequence is
    too even) weigh against it: each divides the evidence by how much likelier its outcome is
    in order than at random (:func:`_against`). A chance divided by such a ratio is a chance
    again, so one number goes into the false-discovery control, and a long random token outweighs
    whatever its order looks like by accident.
    """

    def tests(values: Column, k: Column, hexadecimal: Column) -> Column:
        n = F.size(values).cast("double")
        counts = F.transform(
            F.array_distinct(values), lambda v: F.size(values) - F.size(F.array_remove(values, v))
        )
        squares = F.aggregate(counts, F.lit(0.0), lambda a, c: a + c * c)
        high = F.transform(values, lambda v: (v * 2 >= k).cast("int"))
        mean = F.aggregate(values, F.lit(0.0), lambda a, v: a + v) / n
        sums = let(mean, lambda m: F.struct(
            F.aggregate(values, F.lit(0.0), lambda a, v: a + (v - m) * (v - m)).alias("all"),
            F.aggregate(
                F.zip_with(
                    F.slice(values, F.lit(1), F.size(values) - 1),
                    F.slice(values, F.lit(2), F.size(values) - 1),
                    lambda a, b: (a - m) * (b - m),
                ),
                F.lit(0.0),
                lambda a, v: a + v,
            ).alias("next"),
        ))
        runs = let(high, lambda h: F.struct(
            F.aggregate(h, F.lit(0.0), lambda a, b: a + b).alias("ones"),
            F.aggregate(
                F.zip_with(
                    F.slice(h, F.lit(1), F.size(h) - 1), F.slice(h, F.lit(2), F.size(h) - 1),
                    lambda a, b: (a != b).cast("int"),
                ),
                F.lit(1.0),
                lambda a, b: a + b,
            ).alias("runs"),
        ))
        facts = F.struct(
            n.alias("n"), squares.alias("squares"), sums.alias("sums"), runs.alias("runs"),
            k.cast("double").alias("k"), hexadecimal.alias("hex"),
        )
        return let(facts, _chance)

    def _chance(f: Column) -> Column:
        n, k = f["n"], f["k"]
        chi = f["squares"] * k / n - n
        excess = F.when(f["hex"], k * HEX_COINCIDENCE).otherwise(k * COINCIDENCE) - 1
        spread = F.sqrt(2 * (k - 1) + 4 * n * excess)
        chance = _below((chi - (n - 1) * excess - (k - 1)) / spread)
        ones = f["runs"]["ones"]
        expected = 2 * ones * (n - ones) / n + 1
        variance = (expected - 1) * (expected - 2) / (n - 1)
        runs_z = F.when(variance > 0, (f["runs"]["runs"] - expected) / F.sqrt(variance))
        serial_z = F.when(
            f["sums"]["all"] > 0, (f["sums"]["next"] / f["sums"]["all"] + 1 / n) * F.sqrt(n)
        )
        # Chi-squared as a normal variable (Wilson and Hilferty), of which the lower half counts.
        step = 2 / (9 * (k - 1))
        root = F.pow(F.greatest(chi, F.lit(0.0)) / (k - 1), F.lit(1 / 3))
        even_z = F.least((root - (1 - step)) / F.sqrt(step), F.lit(0.0))
        against = _against(runs_z, n) + _against(serial_z, n) + _against(even_z, n)
        # Tokens that stay on one side of the alphabet's middle have no runs to test.
        against = F.least(F.coalesce(against, F.lit(80.0)), F.lit(80.0))
        return F.least(chance * F.exp(against), F.lit(1.0))

    def tested(alphabet: Column) -> Column:
        k = F.length(alphabet)
        values = F.transform(
            F.split(token, ""), lambda c: (F.instr(alphabet, c) - 1).cast("double")
        )
        return F.when(k == 0, F.lit(1.0)).otherwise(
            let(values, lambda vs: tests(vs, k, k == 16))
        )

    return let(_alphabet(token), tested)


def run_parts(run: Column) -> Column:
    """What is tested of a run of token characters, as (at, end, value): place in the run and
    chance to be text. A run that holds signs of both base64 alphabets may be a secret of one of
    them beside a path or a name, so its longest parts within each alphabet are tested; of
    parts that overlap, all but the one least like text get chance 1. If no part is long
    enough, the whole run is tested, and so is any other run.
    """
    def part(at: Column, token: Column) -> Column:
        return F.struct(at.cast("long").alias("at"), token.alias("token"))

    def split(sign: str) -> Column:
        return let(F.split(run, sign, -1), lambda ps: F.filter(
            F.zip_with(
                _before(F.transform(ps, lambda p: F.length(p).cast("long") + 1)), ps, part
            ),
            lambda p: F.length(p["token"]) >= LEAST,
        ))

    mixed = run.rlike(SIGNS[0]) & run.rlike(SIGNS[1])
    whole = F.array(part(F.lit(0), run))
    several = let(F.concat(*[split(sign) for sign in SIGNS]), lambda ps: (
        F.when(F.size(ps) > 0, ps).otherwise(whole)
    ))
    tested = F.transform(F.when(mixed, several).otherwise(whole), lambda p: F.struct(
        text_chance(p["token"]).alias("value"),
        p["at"].alias("at"),
        (p["at"] + F.length(p["token"])).cast("long").alias("end"),
    ))

    def apart(done: Column, p: Column) -> Column:
        covered = F.exists(
            done, lambda q: (q["value"] < 1) & (q["at"] < p["end"]) & (p["at"] < q["end"])
        )
        value = F.when(covered, F.lit(1.0)).otherwise(p["value"])
        return F.concat(done, F.array(F.struct(
            p["at"].alias("at"), p["end"].alias("end"), value.alias("value")
        )))

    none = F.array().cast("array<struct<at:bigint,end:bigint,value:double>>")
    return F.aggregate(F.array_sort(tested), none, apart)


def _runs(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def token_spans(text: Column) -> Column:
    """Spans of all tokens that are long enough to be tested, with their chance to be text."""
    runs = _spans(text, TOKEN, "random", F.transform(_runs(text), lambda r: F.lit(0.0)))
    return F.flatten(F.zip_with(runs, F.transform(_runs(text), run_parts), lambda s, parts: (
        F.transform(parts, lambda p: F.struct(
            (s["start"] + p["at"]).alias("start"), s["order"].alias("order"),
            (s["start"] + p["end"]).alias("end"), s["kind"].alias("kind"),
            p["value"].alias("value"),
        ))
    )))


def limit(tokens: DataFrame) -> float:
    """The largest chance (column ``value``) at which, of all tokens up to it, a share of
    ``FALSE_FINDS`` is expected to be text (Benjamini and Hochberg). Chances are counted in
    ``TOP`` bins, so the driver sees a bounded table however many tokens there are."""
    power = F.floor(-F.log10(F.greatest("value", F.lit(1e-300))) * STEPS)
    bins = tokens.groupBy(F.least(power, F.lit(TOP)).cast("int").alias("bin")).count().collect()
    total = sum(r["count"] for r in bins)
    got, best = 0, -1.0
    for r in sorted(bins, key=lambda r: -r["bin"]):
        got += r["count"]
        largest = 10 ** (-r["bin"] / STEPS)
        if largest <= FALSE_FINDS * got / total:
            best = largest
    return best


# -- DataFrame operators ---------------------------------------------------------------


def _written(spans: Column) -> Column:
    def line(s: Column) -> Column:
        return F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))

    return F.array_join(F.transform(F.array_sort(spans), line), ",")


def scan_secrets(docs: DataFrame, work: Work, text_col: str = "text") -> DataFrame:
    """One row per document, without its text: n_assign, n_access, n_hex, base_sha256, spans.

    Spans are kind:start:end in code points, end exclusive, sorted by start and then kind,
    joined by commas. Base spans are the patterns' matches, without overlap in a kind. Random
    spans are tokens whose chance to be text passes the limit over all documents' tokens; they
    may overlap base spans. A null text has no spans. Repeated rows stay; columns named like
    the result are replaced.
    """
    added = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    rows = docs.select(
        packed(docs, [*added, text_col]).alias("_row"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
    )
    text = F.col("_text")
    found = work.write(
        rows.select("_row", base_spans(text).alias("_base"), token_spans(text).alias("_tokens")),
        "spans",
    )
    most = limit(found.select(F.explode("_tokens").alias("t")).select("t.value"))
    random = F.filter("_tokens", lambda t: t["value"] <= most)

    def number(kind: str) -> Column:
        return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        *unpacked(found),
        *[number(kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(F.encode(_written(F.col("_base")), "UTF-8"), 256).alias("base_sha256"),
        _written(F.concat("_base", random)).alias("spans"),
    )


def redact_secrets(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """Put ``mark`` in place of every secret in the text: first the base patterns' matches, then
    the random tokens of what is left. Rows and other columns stay as they are; a null text
    stays null."""

    def marked(match: Column, secret: Column) -> Column:
        return F.when(secret, F.lit(mark)).otherwise(match)

    def replaced(text: Column, pattern: str, secret, put=marked) -> Column:
        matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        marks = F.zip_with(matches, secret(text), put)
        whole = F.array_join(
            F.flatten(F.zip_with(
                F.split(text, pattern, -1), marks,
                lambda gap, m: F.array(gap, F.coalesce(m, F.lit(""))),
            )),
            "",
        )
        return F.when(text.rlike(pattern), whole).otherwise(text)

    def base(text: Column) -> Column:
        def long_enough(t: Column) -> Column:
            values = F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(2))
            return F.transform(values, lambda v: F.length(v) >= ASSIGN_LEAST)

        def always(pattern: str):
            return lambda t: F.transform(
                F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), lambda m: F.lit(True)
            )

        return let(replaced(text, ASSIGN, long_enough), lambda a: let(
            replaced(a, ACCESS, always(ACCESS)), lambda b: replaced(b, HEX, always(HEX))
        ))

    def parts(t: Column) -> Column:
        return F.transform(_runs(t), run_parts)

    text = base(F.col(text_col))
    tokens = docs.filter(F.col(text_col).rlike(TOKEN)).select(
        F.explode(F.flatten(let(text, parts))).alias("part")
    )
    most = limit(tokens.select("part.value"))

    def random(t: Column) -> Column:
        return F.transform(parts(t), lambda ps: F.filter(ps, lambda p: p["value"] <= most))

    def parts_marked(run: Column, secret: Column) -> Column:
        start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("to"))

        def put(done: Column, p: Column) -> Column:
            gap = F.substr(run, (done["to"] + 1).cast("int"), (p["at"] - done["to"]).cast("int"))
            return F.struct(
                F.concat(done["out"], gap, F.lit(mark)).alias("out"), p["end"].alias("to")
            )

        def end(done: Column) -> Column:
            return F.concat(done["out"], F.substr(run, (done["to"] + 1).cast("int")))

        return F.aggregate(F.array_sort(secret), start, put, end)

    clean = let(text, lambda t: replaced(t, TOKEN, random, parts_marked)) if most > 0 else text
    return docs.withColumn(text_col, F.when(F.col(text_col).isNotNull(), clean))
