"""Language identification in two steps: the family, then the language within it.

Both steps are votes of one-versus-one linear support vector machines over the frequencies of
hashed letter n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import packed, piped, received, send, unpacked
from tidemark.llm.words import chunks, lowered_table

# Families of languages. A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs mk bg",
    "indic": "hi bn mr gu pa ur ne si",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz",
    "semitic": "ar he mt am",
    "baltic": "lt lv",
    "celtic": "ga cy br gd",
}
UNDETERMINED = "und"
# About so many labelled rows of each language are learned from, chosen by a hash of their id.
SAMPLE_PER_LANGUAGE = 400
# Rows with more languages than this are refused: a machine for each two would not fit a task.
MOST_LANGUAGES = 200
FEATURES = 1 << 12
SIZES = (1, 2, 3, 4)
# Rows whose counts a task holds at once.
ROWS = 256
ROUNDS, PENALTY = 300, 1e-4
# Evidence that a text is of a learned language: share of even chances mixed into a language's
# n-grams, and n-grams after which a longer text's likelihood is no surer.
SMOOTH, ENOUGH = 0.02, 200
# A text is unknown if it lies below its language's median by so many times as this quantile of
# the language's labelled rows does.
QUANTILE, MARGIN = 0.01, 2.5
LETTERS = lowered_table(bytes([*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def family(language: str) -> str:
    return next((f for f, langs in FAMILIES.items() if language in langs.split()), language)


def ngram_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of the hashed n-grams of bytes of each row, words parted by one space."""
    rows = len(offsets) - 1
    data = LETTERS[data]
    space = data == 0x20
    keep = np.ones(len(data), dtype=bool)
    keep[1:] = ~(space[1:] & space[:-1])
    offsets = np.r_[0, np.cumsum(keep)][offsets]
    data = data[keep].astype(np.uint32)
    row = np.repeat(np.arange(rows, dtype=np.int64) * FEATURES, np.diff(offsets))
    counts = np.zeros(rows * FEATURES)
    hashes = np.zeros(len(data), dtype=np.uint32)
    for size in range(1, max(SIZES) + 1):
        n = len(data) - size + 1
        if n <= 0:
            break
        hashes = hashes[:n] * np.uint32(0x01000193) + data[size - 1 :] + np.uint32(1)
        if size in SIZES:
            mixed = (hashes ^ (hashes >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            slot = (mixed >> np.uint32(20)).astype(np.int64) & (FEATURES - 1)
            inside = row[:n] == row[size - 1 :]
            counts += np.bincount((row[:n] + slot)[inside], minlength=rows * FEATURES)
    return counts.reshape(rows, FEATURES)


def frequencies(counts: np.ndarray) -> np.ndarray:
    return counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)


@dataclass(frozen=True)
class Machine:
    """A linear machine: a positive margin speaks for ``yes``, a negative one for ``no``."""

    yes: str
    no: str
    weights: np.ndarray
    bias: float


@dataclass(frozen=True)
class Evidence:
    """Chances of n-grams (a row per language), and the least fit of a text of each language."""

    chances: np.ndarray
    limits: np.ndarray


@dataclass(frozen=True)
class Model:
    languages: list[str]
    families: list[Machine]
    within: list[Machine]
    evidence: Evidence


def fit_machine(x: np.ndarray, positive: np.ndarray, yes: str, no: str) -> Machine:
    """A linear support vector machine with squared hinge loss, by accelerated gradient steps.
    Both sides weigh the same; features are scaled by their spread."""
    spread = (x.std(axis=0) + 1e-4) * np.float32(np.sqrt(x.shape[1]))
    mean = x.mean(axis=0)
    z = (x - mean) / spread
    y = np.where(positive, 1.0, -1.0)
    share = np.where(positive, 0.5 / max(positive.sum(), 1), 0.5 / max((~positive).sum(), 1))
    w, b = np.zeros(x.shape[1], dtype=x.dtype), 0.0
    vw, vb = w.copy(), b
    # The loss is smooth: its curvature is at most twice the largest squared length of a row.
    step = float(1 / (2 * (1 + np.einsum("ij,ij->i", z, z).max()) + PENALTY))
    for i in range(ROUNDS):
        gap = (np.maximum(0, 1 - y * (z @ vw + vb)) * share * y).astype(x.dtype)
        nw = vw - step * (PENALTY * vw - 2 * gap @ z)
        nb = vb + step * 2 * gap.sum()
        ahead = i / (i + 3)
        vw, vb = nw + ahead * (nw - w), nb + ahead * (nb - b)
        w, b = nw, nb
    weights = w / spread
    return Machine(yes, no, weights, float(b - mean @ weights))


def _gram_chances(x: np.ndarray, names: np.ndarray, kinds: list[str]) -> np.ndarray:
    mean = [x[names == k].mean(axis=0, dtype=np.float64) for k in kinds]
    return (1 - SMOOTH) * np.array(mean).reshape(len(kinds), FEATURES) + SMOOTH / FEATURES


def fitness(x: np.ndarray, grams: np.ndarray, chances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The likeliest language of each row, and how far the row's likelihood lies above what is
    expected of that language, in units that allow a short text more.

    The likelihood is that of the best language or of an even mixture of the best two, so a
    text in two languages is as likely as a text in one.
    """
    logs = np.log(chances)
    expected = (chances * logs).sum(axis=1)
    alone = x @ logs.T
    order = np.argsort(-alone, axis=1)
    first = order[:, 0]
    best = alone[np.arange(len(x)), first]
    if len(chances) > 1:
        pairs, at = np.unique(order[:, :2], axis=0, return_inverse=True)
        for i, (a, b) in enumerate(pairs):
            rows = at.reshape(-1) == i
            both = x[rows] @ np.log((chances[a] + chances[b]) / 2)
            best[rows] = np.maximum(best[rows], both)
    unit = np.sqrt(1 / np.maximum(grams, 1) + 1 / ENOUGH)
    return first, (best - expected[first]) / unit


def fit_evidence(
    x: np.ndarray, grams: np.ndarray, names: np.ndarray, held: np.ndarray, kinds: list[str]
) -> Evidence:
    """Limits come from rows that are not held out, each under chances of the other half of
    them, so that no row speaks for itself. A language without such rows has no limit."""
    half = np.zeros(len(names), dtype=bool)
    for k in kinds:
        half[np.flatnonzero((names == k) & ~held)[::2]] = True
    fits = np.full(len(names), np.nan)
    for side, other in ((half, ~half & ~held), (~half & ~held, half)):
        known = [k for k in kinds if (names[other] == k).any()]
        if known:
            chances = _gram_chances(x[other], names[other], known)
            rows = np.flatnonzero(side)
            for at in range(0, len(rows), ROWS):
                some = rows[at : at + ROWS]
                fits[some] = fitness(x[some], grams[some], chances)[1]
    limits = np.full(len(kinds), -np.inf)
    for i, k in enumerate(kinds):
        own = fits[(names == k) & ~np.isnan(fits)]
        if len(own):
            low, middle = np.quantile(own, [QUANTILE, 0.5])
            limits[i] = middle - MARGIN * (middle - low)
    return Evidence(_gram_chances(x, names, kinds), limits)


def is_known(x: np.ndarray, grams: np.ndarray, evidence: Evidence) -> np.ndarray:
    """Whether each row is likely enough under the learned languages."""
    language, fits = fitness(x, grams, evidence.chances)
    return fits >= evidence.limits[language]


def fit(x: np.ndarray, languages: list[str], grams: np.ndarray, held: np.ndarray) -> Model:
    """Machines between all pairs of families, and between all pairs of languages in each;
    evidence of the languages. ``grams`` is the number of n-grams of each row, ``held`` whether
    it is held out from setting limits."""
    names = np.array(languages, dtype=object)
    of = np.array([family(n) for n in languages], dtype=object)

    def pairs(labels: np.ndarray, kinds: list[str]) -> list[Machine]:
        machines = []
        for yes, no in combinations(kinds, 2):
            rows = (labels == yes) | (labels == no)
            machines.append(fit_machine(x[rows], labels[rows] == yes, yes, no))
        return machines

    kinds = sorted(set(names))
    within = []
    for group in sorted(set(of)):
        within += pairs(names, [k for k in kinds if family(k) == group])
    evidence = fit_evidence(x, grams, names, held, kinds)
    return Model(kinds, pairs(of, sorted(set(of))), within, evidence)


def _vote(
    x: np.ndarray, machines: list[Machine], kinds: list[str]
) -> tuple[np.ndarray, np.ndarray]:
    """The winner of each row, by its summed chances against the others, and its mean chance."""
    chances = np.zeros((len(x), len(kinds)))
    for m in machines:
        if m.yes in kinds and m.no in kinds:
            margin = np.clip(2 * (x @ m.weights + m.bias), -30, 30)
            yes = 1 / (1 + np.exp(-margin))
            chances[:, kinds.index(m.yes)] += yes
            chances[:, kinds.index(m.no)] += 1 - yes
    best = chances.argmax(axis=1)
    mean = chances.max(axis=1) / (len(kinds) - 1) if len(kinds) > 1 else np.ones(len(x))
    return best, mean


def predict(x: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Language and score (the family's chance times the language's within it) of each row."""
    groups = sorted({family(k) for k in model.languages})
    group, sure = _vote(x, model.families, groups)
    out, score = np.empty(len(x), dtype=object), np.zeros(len(x))
    for i, name in enumerate(groups):
        rows = group == i
        kinds = [k for k in model.languages if family(k) == name]
        best, chance = _vote(x[rows], model.within, kinds)
        out[rows] = np.array(kinds, dtype=object)[best]
        score[rows] = sure[rows] * chance
    return out, score


# -- DataFrame operators ---------------------------------------------------------------


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, offsets in chunks(batch.column(1), rows=ROWS):
            counts = ngram_counts(data, offsets)
            rows = frequencies(counts).astype(np.float32)
            names = batch.column(0).slice(first, last - first)
            vectors = pa.array([r.tobytes() for r in rows], pa.binary())
            held = batch.column(2).slice(first, last - first)
            yield pa.RecordBatch.from_arrays(
                [names, vectors, pa.array(counts.sum(axis=1)), held],
                ["lang", "features", "grams", "held"],
            )


def learn(rows: DataFrame) -> Model:
    """Learn from rows (id, lang, text): about ``SAMPLE_PER_LANGUAGE`` of each language.

    Rows whose language is null or whose text is null or has no letter are left out. Of rows with
    one id and language, one is taken, so the sample is bounded however often an id is repeated.
    Every language is learned; more than ``MOST_LANGUAGES`` raise ``ValueError``. Texts of any
    length are read whole; without rows nothing is learned. The driver gets the sample's ``FEATURES``
    frequencies, not its texts.
    """
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    known = sizes.orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES + 1).collect()
    if len(known) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages cannot be told apart by one model")
    size = F.lit(None).cast("long")
    for r in known:
        size = F.when(F.col("lang") == r["lang"], F.lit(r["n"])).otherwise(size)
    chosen = F.pmod(F.xxhash64("id"), size) < SAMPLE_PER_LANGUAGE
    sample = rows.filter(chosen).groupBy("lang", "id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    sample = sample.select("lang", "text", held_out(F.col("id")).alias("held"))
    schema = "lang string, features binary, grams double, held boolean"
    found = piped(sample, [_features], schema).toArrow()
    languages = found.column("lang").to_pylist()
    vectors = b"".join(v.as_py() for v in found.column("features"))
    grams = found.column("grams").to_numpy()
    held = found.column("held").to_numpy().astype(bool)
    del found
    x = np.frombuffer(vectors, dtype=np.float32).reshape(len(languages), FEATURES)
    return fit(x, languages, grams, held)


def _predicted(sent, evidence: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = received(sent)
        for batch in batches:
            for first, last, data, offsets in chunks(batch.column(2), rows=ROWS):
                lettered = batch.column(1).slice(first, last - first).to_numpy(zero_copy_only=False)
                languages = np.full(last - first, UNDETERMINED, dtype=object)
                scores = np.zeros(last - first)
                known = np.zeros(last - first, dtype=bool)
                if model.languages and lettered.any():
                    counts = ngram_counts(data, offsets)[lettered]
                    x = frequencies(counts)
                    languages[lettered], scores[lettered] = predict(x, model)
                    if evidence:
                        known[lettered] = is_known(x, counts.sum(axis=1), model.evidence)
                row = batch.column(0).slice(first, last - first)
                columns = [row, pa.array(languages, pa.string()), pa.array(scores)]
                names = ["_row", "lang_pred", "score"]
                if evidence:
                    columns.append(pa.array(known))
                    names.append("known")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def identify(
    docs: DataFrame, model: Model, text_col: str = "text", evidence: bool = False
) -> DataFrame:
    """Add lang_pred and score (0 to 1) to each row, from its whole text alone.

    A null text, or one without a letter, is ``und`` with score 0; so is every text if nothing
    was learned. Repeated rows stay; columns with the names of the result are replaced.

    With ``evidence``, ``known`` is added: whether the text's n-grams are likely enough under
    the learned languages, compared with their labelled rows. It does not depend on how many
    languages or families there are. A few letters prove little and are known; so is a text
    that is likeliest in a language of which a single row was learned.
    """
    added = ["lang_pred", "score"] + ["known"] * evidence
    lettered = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(
        packed(docs, added).alias("_row"),
        lettered.alias("_lettered"),
        F.col(text_col).alias("_text"),
    )
    schema = f"_row {rows.schema['_row'].dataType.simpleString()}, lang_pred string, score double"
    schema += ", known boolean" * evidence
    found = piped(rows, [_predicted(send(docs.sparkSession, model), evidence)], schema)
    return found.select(*unpacked(found), *added)


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from. A null id is not held out."""
    remainder = F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4
    return F.coalesce(remainder == 2, F.lit(False))
