"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding lower-cases, turns homoglyphs and digits or signs that stand for letters into
those letters, and cuts at everything else.  Lexicon entries are whole words or
word beginnings with a weight (log-odds of toxic over clean labelled documents);
exception phrases (two neighbouring words) suppress the hits inside them.  A text's
features are the summed weight, the weight normalised by length and the largest
weight; a logistic regression on them gives the score.

Lexicon, exceptions and regression are fitted on the labelled rows with the
``sample_rows`` smallest hashes of their id (all of them, if fewer), so what is collected
and broadcast is bounded by parameters whatever the size of the input: the lexicon keeps the ``lexicon_size``
entries of the highest weight, the exceptions the ``LEXICON_SIZE`` commonest in clean texts.  Within the
labelled rows every word and beginning counts, whatever its length and frequency.

Defined results: null and empty texts score as texts without hits.  Labels that are
null, or whose document is missing, are not used; a document labelled twice counts as toxic
if any label says so.  Without a toxic or without a clean label the lexicon is empty and
every score is 0.  Rows are scored one by one: repeated rows and null ids give one row each.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, raw_texts, slices, with_text_columns

SAMPLE_ROWS = 20_000
LEXICON_SIZE = 4_000
MIN_TOXIC = 5
MIN_WEIGHT = 2.5
STEMS = (4, 5, 6)

#: Characters that look like the letter they are listed under.
LOOKALIKES = {
    "a": "аαａ@4",
    "b": "Ьｂ8",
    "c": "сϲｃ",
    "d": "ԁｄ",
    "e": "еεｅ3",
    "g": "ɡｇ9",
    "h": "һｈ",
    "i": "іιｉ1!|",
    "j": "јｊ",
    "k": "кκｋ",
    "l": "ӏｌ",
    "m": "мｍ",
    "n": "ոｎ",
    "o": "оοｏ0",
    "p": "рρｐ",
    "s": "ѕｓ5$",
    "t": "тτｔ7",
    "u": "υսｕ",
    "v": "νｖ",
    "w": "ԝｗ",
    "x": "хχｘ",
    "y": "уγｙ",
    "z": "ᴢｚ2",
}
_FOLD = {ord(c): letter for letter, like in LOOKALIKES.items() for c in like}
_WORD = re.compile(r"[^\W\d_]+")
#: "!" and "|" stand for a letter only between letters; else they end a word.
_MARK = re.compile(r"(?<![^\W\d_])[!|]|[!|](?![^\W\d_])")


def folded_words(text: str) -> list[str]:
    low = text.lower()
    if "!" in low or "|" in low:
        low = _MARK.sub(" ", low)
    return _WORD.findall(low.translate(_FOLD))


def units(words: list[str]) -> set[str]:
    """Lexicon candidates of a text: ``word$`` for a whole word, ``stem`` for a beginning."""
    own = set(words)
    found = {f"{w}$" for w in own}
    for n in STEMS:
        found.update(w[:n] for w in own if len(w) > n)
    return found


def _text(raw: bytes | None) -> str:
    return raw.decode("utf-8", "replace") if raw else ""


def sample_labels(labels: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` labelled (doc_id, toxic), those with the smallest hashes."""
    one = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    )
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def _count_units(sample: DataFrame) -> DataFrame:
    """(unit, toxic_n, clean_n): in how many toxic and clean texts of ``sample`` it stands."""

    def run(batches):
        for part in slices(batches, 1024):
            counts: tuple[Counter, Counter] = Counter(), Counter()
            for raw, toxic in zip(raw_texts(part.column(0)), part.column(1).to_pylist(), strict=True):
                counts[toxic].update(units(folded_words(_text(raw))))
            every = sorted(counts[0] | counts[1])
            columns = [pa.array(every, pa.string()), *[pa.array([counts[t][u] for u in every], pa.int64()) for t in (1, 0)]]
            yield pa.RecordBatch.from_arrays(columns, names=["unit", "toxic_n", "clean_n"])

    counted = sample.select("text", "toxic").mapInArrow(run, "unit string, toxic_n bigint, clean_n bigint")
    return counted.groupBy("unit").agg(F.sum("toxic_n").alias("toxic_n"), F.sum("clean_n").alias("clean_n"))


class Lexicon:
    """Entries with weights, exception phrases and the regression on the features."""

    def __init__(self, weights: dict[str, float], exceptions: list[str], coefficients: list[float]):
        self.weights, self.exceptions, self.coefficients = weights, exceptions, coefficients
        self.digest = hashlib.sha256(repr((sorted(weights.items()), sorted(exceptions))).encode()).hexdigest()

    def automaton(self) -> ahocorasick.Automaton:
        """Patterns over words that are set off by blanks: " word ", " stem" and " two words "."""
        found = ahocorasick.Automaton()
        for unit, weight in self.weights.items():
            pattern = f" {unit[:-1]} " if unit.endswith("$") else f" {unit}"
            found.add_word(pattern, (len(pattern), weight))
        for phrase in self.exceptions:
            found.add_word(f" {phrase} ", (len(phrase) + 2, None))
        found.make_automaton()
        return found


_built: dict[str, ahocorasick.Automaton] = {}


def _automaton(lexicon: Lexicon) -> ahocorasick.Automaton | None:
    if not lexicon.weights:
        return None
    if lexicon.digest not in _built:
        _built.clear()
        _built[lexicon.digest] = lexicon.automaton()
    return _built[lexicon.digest]


def hits(words: list[str], automaton) -> dict[int, float]:
    """Place of a word's leading blank -> the largest weight of the entries that match there."""
    found: dict[int, float] = {}
    if automaton is None or not words:
        return found
    line = f" {' '.join(words)} "
    spared = []
    for end, (n, weight) in automaton.iter(line):
        at = end - n + 1
        if weight is None:
            spared.append((at, end))
        elif weight > found.get(at, 0.0):
            found[at] = weight
    return {at: w for at, w in found.items() if not any(a <= at < b for a, b in spared)} if spared else found


def features(words: list[str], automaton) -> list[float]:
    found = hits(words, automaton)
    total = sum(found.values())
    return [total, total / math.sqrt(len(words) + 1), max(found.values(), default=0.0)]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> list[float]:
    """Newton's method with a ridge; the intercept comes first.  Columns are scaled inside."""
    scale = np.maximum(np.abs(x).max(axis=0, initial=0.0), 1e-9)
    a = np.column_stack([np.ones(len(x)), x / scale])
    w = np.zeros(a.shape[1])
    keep = np.eye(len(w)) * ridge
    keep[0, 0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + keep, a.T @ (p - y) + keep @ w)
        w -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return [float(w[0]), *map(float, w[1:] / scale)]


def fit_lexicon(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    lexicon_size: int = LEXICON_SIZE,
    min_toxic: int = MIN_TOXIC,
    exceptions: tuple[str, ...] = (),
) -> Lexicon:
    """Fit on ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    chosen = F.broadcast(sample_labels(labels, sample_rows))  # bounded by sample_rows
    sample = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(chosen, "doc_id").select("text", "toxic")
    sample = materialize(sample, "toxicity-sample")
    seen = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(seen) < 2:
        return Lexicon({}, [], [-30.0, 0.0, 0.0, 0.0])
    odds = lambda c, of: F.ln((F.col(c) + 0.5) / (F.lit(of) - F.col(c) + 0.5))
    weight = odds("toxic_n", seen[1]) - odds("clean_n", seen[0])
    # a rare unit in no clean text is weak evidence: its weight must stand out from its standard error
    error = F.sqrt(1 / (F.col("toxic_n") + 0.5) + 1 / (F.col("clean_n") + 0.5))
    entries = _count_units(sample).where(F.col("toxic_n") >= min_toxic).select("unit", weight.alias("weight"), error.alias("error"))
    entries = entries.where((F.col("weight") >= MIN_WEIGHT) & (F.col("weight") > 2 * F.col("error")))
    best = entries.orderBy(F.desc(F.round("weight", 9)), "unit").limit(lexicon_size)
    sure = {r["unit"]: r["weight"] for r in best.collect()}
    lexicon = Lexicon(sure, sorted(exceptions), [])
    lexicon.exceptions = sorted({*exceptions, *_fit_exceptions(sample, lexicon)})
    lexicon = Lexicon(sure, lexicon.exceptions, [])
    rows = _sample_features(sample, lexicon).collect()
    discard(sample)
    x = np.array([[r["a"], r["b"], r["c"]] for r in rows])
    lexicon.coefficients = fit_logistic(x, np.array([r["toxic"] for r in rows], float))
    return lexicon


def _fit_exceptions(sample: DataFrame, lexicon: Lexicon, least: int = 3) -> list[str]:
    """Pairs of neighbouring words around a hit that stand in clean texts much more often than in toxic ones."""
    shared = sample.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches):
        automaton = _automaton(shared.value)
        for part in slices(batches):
            rows: list[tuple[str, int]] = []
            for raw, toxic in zip(raw_texts(part.column(0)), part.column(1).to_pylist(), strict=True):
                words = folded_words(_text(raw))
                found = hits(words, automaton)
                starts, at = {}, 0
                for i, w in enumerate(words if found else []):
                    starts[at] = i
                    at += len(w) + 1
                pairs = {" ".join(words[j : j + 2]) for p in found for j in (starts[p] - 1, starts[p]) if 0 <= j < len(words) - 1}
                rows += [(pair, toxic) for pair in pairs]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32())], names=["pair", "toxic"])

    pairs = sample.select("text", "toxic").mapInArrow(run, "pair string, toxic int")
    counted = pairs.groupBy("pair").agg(F.sum(F.lit(1) - F.col("toxic")).alias("clean"), F.sum("toxic").alias("toxic"))
    kept = counted.where((F.col("clean") >= least) & (F.col("clean") > 9 * F.col("toxic"))).orderBy(F.desc("clean"), "pair").limit(LEXICON_SIZE)
    return [r["pair"] for r in kept.collect()]


def _sample_features(sample: DataFrame, lexicon: Lexicon) -> DataFrame:
    shared = sample.sparkSession.sparkContext.broadcast(lexicon)

    def make():
        automaton = _automaton(shared.value)

        def compute(raws):
            rows = [features(folded_words(_text(raw)), automaton) for raw in raws]
            return [list(c) for c in zip(*rows, strict=True)] or [[], [], []]

        return compute

    fields = [(n, "double", pa.float64()) for n in ("a", "b", "c")]
    return with_text_columns(sample, "text", make, fields, drop_text=True)


def score_toxicity(docs: DataFrame, lexicon: Lexicon, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``__score`` (0 to 1) and ``__hits`` (number of lexicon hits)."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def make():
        automaton, c = _automaton(shared.value), shared.value.coefficients

        def compute(raws):
            scores, counts = [], []
            for raw in raws:
                words = folded_words(_text(raw))
                found = hits(words, automaton)
                total = sum(found.values())
                z = c[0] + c[1] * total + c[2] * total / math.sqrt(len(words) + 1) + c[3] * max(found.values(), default=0.0)
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
                counts.append(len(found))
            return [scores, counts]

        return compute

    return with_text_columns(docs, text, make, [("__score", "double", pa.float64()), ("__hits", "bigint", pa.int64())], drop_text=not keep_text)
