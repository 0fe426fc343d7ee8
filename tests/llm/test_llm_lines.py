"""Which lines of a text fail, against plain rules."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality

NOTICE = (
    "all rights reserved|copyright|©|cookie|privacy policy|terms of (?:use|service)|"
    "enable javascript|licen[sc]ed under|unsubscribe|powered by"
)
MENU = (
    r"\b(?:home|menu|log ?in|sign ?(?:in|up)|register|next|previous|back to top|read more|share|"
    r"subscribe|contact us|about us|sitemap|search)\b"
)


def plain(line):
    words = len(re.findall(r"[^\x20\x09-\x0D]+", line))
    separators = sum(line.count(c) for c in "|<>»•→")
    notices = len(re.findall(NOTICE, line, re.I))
    return (
        not any(c in line for c in ".!?;:…。！？；：｡।॥؟؛۔።፧។៕၊။")
        or 100 * sum(line.count(c) for c in "#*$%&|<>") > 10 * len(line)
        or (separators >= 2 and words <= 8 * separators)
        or (words <= 6 and bool(re.search(MENU, line, re.I | re.A)))
        or (notices > 0 and words <= 20 * notices)
    )


def fails(spark, lines):
    frame = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    rows = frame.select("i", quality.line_fails(F.col("line")).alias("fails")).collect()
    return [f for _, f in sorted((r["i"], r["fails"]) for r in rows)]


def test_lines_fail_by_the_rules(spark):
    made = random.Random(2)
    pieces = ["river", "stone", "cookie", "Cookies", "©", "home", "log in", "|", ">", "→", "#", ".", "؟", "।", "été\t", "terms of use", "\r"]
    lines = [" ".join(made.choices(pieces[:2] * made.randint(1, 40) + pieces, k=made.randint(1, 60))) for _ in range(600)]
    lines = [line for line in lines if line.strip()]
    found = fails(spark, lines)
    assert found == [plain(line) for line in lines]
    assert 0 < sum(found) < len(found)


@pytest.mark.parametrize("line, bad", [
    ("Accept every cookie.", True),
    ("Home | News | Contact.", True),
    ("The baker put each cookie on a tray, let the whole batch cool by the window for an hour, and then "
     "carried the trays down to the shop before anyone else had come.", False),
    ("A path from a -> b -> c is as long as the sum of its edges, and of all paths between the same two "
     "points the search keeps the one whose sum is the least.", False),
    ("नदी पहाड़ से नीचे बहती है और गाँव के पास से गुज़रती है।", False),
    ("هل وصل القطار إلى المدينة في الصباح؟", False),
    ("河は静かに流れていた！", False),
])
def test_long_lines_and_other_scripts(spark, line, bad):
    assert fails(spark, [line]) == [bad]
