"""Quality rules: clean line by line first, then judge the document by what it lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import SPACES, let, packed, unpacked

# Fixed values of the base rules.
WINDOW = 8
MIN_WORDS = 20
REPEATED_PER_CENT = 30
SYMBOLS = "[^#*$%&|<>]+"

# Fixed values of the line rules.
PUNCTUATION = "[.!?;:…。！？；：｡।॥؟؛۔።፧។៕၊။]"
SEPARATOR = "[|<>»•→]"
SEPARATORS = "[|<>»•→][^|<>»•→]*[|<>»•→]"
NAVIGATION = (
    r"(?i)\b(?:home|menu|log ?in|sign ?(?:in|up)|register|next|previous|back to top|"
    r"read more|share|subscribe|contact us|about us|sitemap|search)\b"
)
BOILERPLATE = (
    r"(?i)all rights reserved|copyright|©|cookie|privacy policy|terms of (?:use|service)|"
    r"enable javascript|licen[sc]ed under|unsubscribe|powered by"
)
NAVIGATION_WORDS = 6
SEPARATOR_WORDS = 8
BOILERPLATE_WORDS = 20
SYMBOLS_PER_CENT = 10
MIN_LEFT_PER_CENT = 50


def repeated_words(words: Column) -> Column:
    """Number of words in ``WINDOW``-word windows that occur twice or more, first included.

    Most texts have none: that shows when their windows' hashes are all distinct, and only the
    others are sorted.
    """
    windows = F.when(
        F.size(words) >= WINDOW,
        F.transform(
            F.sequence(F.lit(1), F.size(words) - WINDOW + 1),
            lambda i: F.xxhash64(F.slice(words, i, F.lit(WINDOW))),
        ),
    )
    return let(
        windows,
        lambda hashes: F.when(
            F.size(F.array_distinct(hashes)) < F.size(hashes), _covered(hashes)
        ).otherwise(F.lit(0)),
    )


def _covered(hashes: Column) -> Column:
    """Words under the windows whose hash is not the only one of its kind."""
    places = F.array_sort(
        F.transform(hashes, lambda h, i: F.struct(h.alias("hash"), i.alias("at")))
    )

    def like_next_to(places: Column) -> Column:
        return F.filter(
            places,
            lambda p, i: F.get(places, i - 1)["hash"].eqNullSafe(p["hash"])
            | F.get(places, i + 1)["hash"].eqNullSafe(p["hash"]),
        )

    repeated = F.array_sort(F.transform(let(places, like_next_to), lambda p: p["at"]))
    return let(
        repeated,
        lambda at: F.aggregate(
            F.transform(
                at,
                lambda p, i: F.least(
                    F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW))
                ),
            ),
            F.lit(0),
            lambda total, n: total + n,
        ),
    )


def line_fails(line: Column) -> Column:
    """A line with words fails if it has no punctuation of sentences (of any script) at all or is
    strewn with symbols, is a list of links or a short line of menu words, or is a licence or site
    notice.

    Separators and notices speak for a share of the line: ``SEPARATOR_WORDS`` words each (of two
    separators or more) and ``BOILERPLATE_WORDS`` words each. So a long line of prose that names
    cookies once, or holds two arrows, does not fail.
    """
    words = F.size(F.split(F.btrim(line, F.lit(" \t\n\x0b\f\r")), f"[{SPACES}]+"))

    def within(pattern: str, each: int) -> Column:
        return words <= F.size(F.regexp_extract_all(line, F.lit(pattern), F.lit(0))) * each

    return (
        ~line.rlike(PUNCTUATION)
        | (F.length(F.regexp_replace(line, SYMBOLS, "")) * 100 > F.length(line) * SYMBOLS_PER_CENT)
        | (line.rlike(SEPARATORS) & within(SEPARATOR, SEPARATOR_WORDS))
        | ((words <= NAVIGATION_WORDS) & line.rlike(NAVIGATION))
        | (line.rlike(BOILERPLATE) & within(BOILERPLATE, BOILERPLATE_WORDS))
    )


def judge_quality(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the counts, both verdicts and the cleaned text to each row.

    Words are runs without white space. ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines`` and ``n_repeat_words`` count in the whole text; ``base_failed`` follows from
    them. Lines that fail :func:`line_fails` are taken out of ``clean_text``; a text of whose
    characters less than half is left, or that has no word, is not ``kept``.

    A null text counts as none and stays null; texts of any length are judged whole, and an empty
    table gives an empty result. Repeated rows stay. Columns with the names of the result are
    replaced. Windows are compared by 64-bit hashes. No row moves: there is no exchange.
    """
    added = [
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", "clean_text",
    ]
    text = F.col("_text")
    words = F.filter(F.split(text, f"[{SPACES}]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACES}]"))
    counts = let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeated_words(w).cast("long").alias("n_repeat_words"),
        ),
    )
    line_counts = let(
        lines,
        lambda ls: F.struct(
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            F.array_join(F.filter(ls, lambda line: ~line_fails(line)), "\n").alias("clean_text"),
        ),
    )
    n_words, clean = F.col("_counts.n_words"), F.col("_lines.clean_text")
    failed = (n_words < MIN_WORDS) | (
        F.col("_counts.n_repeat_words") * 100 > n_words * REPEATED_PER_CENT
    )
    left = F.length(F.regexp_replace(clean, f"[{SPACES}]+", ""))
    enough = left * 100 >= F.col("_counts.word_chars") * MIN_LEFT_PER_CENT
    rows = docs.select(
        packed(docs, added).alias("_row"),
        F.col(text_col).isNull().alias("_null"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
    ).withColumns({"_counts": counts, "_lines": line_counts})
    return rows.select(
        *unpacked(rows),
        "_counts.n_words",
        "_counts.word_chars",
        F.length(F.regexp_replace(text, SYMBOLS, "")).cast("long").alias("n_symbols"),
        "_lines.n_dup_lines",
        "_counts.n_repeat_words",
        failed.alias("base_failed"),
        (~failed & enough).alias("kept"),
        F.when(~F.col("_null"), clean).alias("clean_text"),
    )
