"""Quality classifier by co-training two views.

The text view sees counts from the text only (letter case, digits, marks, repeated words and
lines, lengths); the metadata view sees language, source and length class.  Both are logistic
regressions.  In each round each view labels all unlabelled rows it is sure of and hands them to
the other view's training set; rows are handed over once.  How sure
it must be is measured: the labels it would give to held-back rows must be right in
``PRECISION`` of the cases, so a view that only knows the base rate teaches nothing.  Each view
is then calibrated (Platt) on the rows held back, and a last logistic regression on the two
calibrated log-odds, fitted on the same rows, gives the score of all documents.

Labelled rows are a bounded sample: the ``sample_rows`` with the smallest hashes of their id; their
features reach the driver.  Unlabelled documents all take part and stay in Spark: a row's
pseudo-label follows from its features and the teachers so far, the metadata view is fitted on
counts by its slots (bounded), the text view by Newton steps whose gradients and
Hessians each task sums up.  All documents are scored, without a shuffle.

Defined results: null counts as the empty text, null metadata as values of their own.
Rows that repeat an id count once in the fit (the least features), rows with a null id
are unlabelled ones each.  Labels that are null or without a document aren't used; a document labelled twice counts as good only
if all its labels say so.  Without labels of both kinds every score is the share of good
labels (1 without labels).  Rows are scored one by one; other columns pass through.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, with_text_columns
from .toxicity import fit_logistic

SAMPLE_ROWS = 20_000
ROUNDS = 5
#: How often a view must be right on rows held back.
PRECISION = 0.99
#: Rows held back on which that is measured, at least.
SUPPORT = 5
KEEP = 0.5

BUCKETS = 64
LENGTHS = 24
TEXT_FEATURES = ["upper", "digit", "bang", "bar", "symbol", "beyond_ascii", "distinct_words", "distinct_lines", "word_length", "log_length"]
_SYMBOLS = list(b"%$&*#@^~<>{}[]\\")
#: Log-odds are cut here, so no view outweighs all else.
_CUT = 12.0
_BLOCK = 4_096


def text_features(raw: bytes | None) -> list[float]:
    raw = raw or b""
    n = max(1, len(raw))
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words, lines = raw.split(), raw.split(b"\n")
    return [
        float(counts[65:91].sum()) / n,
        float(counts[48:58].sum()) / n,
        float(counts[33]) / n,
        float(counts[124]) / n,
        float(counts[_SYMBOLS].sum()) / n,
        float(counts[128:].sum()) / n,
        len(set(words)) / max(1, len(words)),
        len(set(lines)) / len(lines),
        n / max(1, len(words)) / 10,
        math.log(n) / 10,
    ]


def with_features(docs: DataFrame, text: str, keep_text: bool) -> DataFrame:
    def make():
        return lambda raws: [[text_features(raw) for raw in raws]]

    return with_text_columns(docs, text, make, [("__features", "array<double>", pa.list_(pa.float64()))], drop_text=not keep_text)


def _meta_slots(lang: Column, source: Column, n_chars: Column) -> list[Column]:
    """The metadata as three slots of one weight vector: language, source, length class."""
    bucket = lambda c, salt: F.pmod(F.crc32(F.concat(F.lit(salt), F.coalesce(c.cast("string"), F.lit("\0")))), F.lit(BUCKETS))
    length = F.least(F.floor(F.log2(F.greatest(F.coalesce(n_chars.cast("double"), F.lit(0.0)), F.lit(0.0)) + 1)), F.lit(LENGTHS - 1))
    return [
        bucket(lang, "lang:").cast("int"),
        (bucket(source, "source:") + BUCKETS).cast("int"),
        (length + 2 * BUCKETS).cast("int"),
    ]


def _odds(w: list[float], x: np.ndarray) -> np.ndarray:
    """Log-odds of rows; whole numbers are the slots of ones (see ``_meta_slots``)."""
    w = np.asarray(w)
    z = w[1:][x].sum(axis=1) if x.dtype.kind == "i" else x @ w[1:]
    return np.clip(w[0] + z, -_CUT, _CUT)


def _width(x: np.ndarray) -> int:
    return 2 * BUCKETS + LENGTHS if x.dtype.kind == "i" else x.shape[1]


def _sums(w: np.ndarray, x: np.ndarray, y: np.ndarray, weight: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and Hessian of the logistic loss at ``w`` (of scaled columns, the intercept first)."""
    gradient, hessian = np.zeros(len(w)), np.zeros((len(w), len(w)))
    for at in range(0, len(x), _BLOCK):
        part = x[at : at + _BLOCK]
        a = np.zeros((len(part), len(w)))
        a[:, 0] = 1.0
        if x.dtype.kind == "i":
            a[np.arange(len(part))[:, None], part + 1] = 1.0
        else:
            a[:, 1:] = part / scale
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        own = weight[at : at + _BLOCK]
        gradient += a.T @ (own * (p - y[at : at + _BLOCK]))
        hessian += (a * (own * p * (1 - p))[:, None]).T @ a
    return gradient, hessian


def _newton(sums, width: int, scale: np.ndarray, ridge: float, steps: int = 50) -> list[float]:
    """Newton's method with a ridge, as ``fit_logistic``, on the gradients and Hessians that ``sums`` gives."""
    w, keep = np.zeros(width + 1), np.eye(width + 1) * ridge
    keep[0, 0] = 1e-6
    for _ in range(steps):
        gradient, hessian = sums(w)
        step = np.linalg.solve(hessian + keep, gradient + keep @ w)
        w -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return [float(w[0]), *map(float, w[1:] / scale)]


def _pseudo_labels(x: np.ndarray, teachers: list[tuple]) -> np.ndarray:
    """1 or 0 by the first of the ``teachers`` (weights, sure of good from, sure of bad from) that is sure, else -1."""
    out = np.full(len(x), -1)
    for w, good, bad in teachers:
        p = 1 / (1 + np.exp(-_odds(w, x)))
        free = out < 0
        out[free & (p >= good)] = 1
        out[free & (1 - p >= bad)] = 0
    return out


class LocalPool:
    """Unlabelled rows as two matrices."""

    def __init__(self, text: np.ndarray, meta: np.ndarray):
        self.views = {"text": text, "meta": meta}

    def peaks(self) -> np.ndarray:
        return np.abs(self.views["text"]).max(axis=0, initial=0.0)

    def taught(self, pupil: str, teachers: list[tuple], scale: np.ndarray):
        """(rows with pseudo-labels, their sums at given weights)."""
        label = _pseudo_labels(self.views["meta" if pupil == "text" else "text"], teachers)
        x, y = self.views[pupil][label >= 0], label[label >= 0]
        return len(x), lambda w: _sums(w, x, y, np.ones(len(x)), scale)


def _views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(text features, slots) of a batch of the pool."""
    columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
    return np.column_stack(columns[3:]), np.column_stack(columns[:3]).astype(np.int64)


class SparkPool:
    """Unlabelled rows in Spark: the columns ``__m0`` to ``__m2`` and the text features."""

    def __init__(self, rows: DataFrame):
        self.rows = rows.select("__m0", "__m1", "__m2", *TEXT_FEATURES)

    def peaks(self) -> np.ndarray:
        row = self.rows.agg(*[F.max(F.abs(c)) for c in TEXT_FEATURES]).first()
        return np.array([0.0 if v is None else v for v in row])

    def taught(self, pupil: str, teachers: list[tuple], scale: np.ndarray):
        return (self._by_slots if pupil == "meta" else self._by_rows)(teachers, scale)

    def _by_slots(self, teachers, scale):
        top = 1 << 10

        def run(batches):
            for batch in batches:
                text, slots = _views(batch)
                label = _pseudo_labels(text, teachers)
                codes, place = np.unique((slots[:, 0] * top + slots[:, 1]) * top + slots[:, 2], return_inverse=True)
                counts = [np.bincount(place[label == k], minlength=len(codes)) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in (codes, *counts)], names=["code", "bad", "good"])

        found = self.rows.mapInArrow(run, "code bigint, bad bigint, good bigint").where("bad + good > 0")
        found = found.groupBy("code").agg(F.sum("bad"), F.sum("good")).collect()  # at most one row for each three slots
        code, bad, good = np.array(sorted(map(tuple, found)), np.int64).reshape(-1, 3).T
        slots = np.column_stack([code // top**2, code // top % top, code % top])
        x, y = np.concatenate([slots, slots]), np.repeat([0.0, 1.0], len(slots))
        weight = np.concatenate([bad, good]).astype(float)
        return int(weight.sum()), lambda w: _sums(w, x, y, weight, scale)

    def _by_rows(self, teachers, scale):
        rows, width = self.rows, len(TEXT_FEATURES) + 1

        def at(w):
            def run(batches):
                out = np.zeros(1 + width + width**2)
                for batch in batches:
                    text, slots = _views(batch)
                    label = _pseudo_labels(slots, teachers)
                    x, y = text[label >= 0], label[label >= 0]
                    gradient, hessian = _sums(w, x, y, np.ones(len(x)), scale)
                    out += np.concatenate(([len(x)], gradient, hessian.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["sums"])

            parts = [np.frombuffer(r["sums"]) for r in rows.mapInArrow(run, "sums binary").collect()]  # one a task
            return np.sum(parts, axis=0) if parts else np.zeros(1 + width + width**2)

        first = at(np.zeros(width))  # where Newton's method begins

        def sums(w):
            own = at(w) if w.any() else first
            return own[1 : 1 + width], own[1 + width :].reshape(width, width)

        return int(first[0]), sums


def _sure_from(chance: np.ndarray, right: np.ndarray, precision: float) -> float:
    """The least chance from which a view's labels of the held-back rows are right often enough (2: none)."""
    order = np.argsort(-chance, kind="stable")
    hits = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    last_of_tie = np.append(np.diff(chance[order]) != 0, True)
    able = np.flatnonzero((hits >= precision) & last_of_tie & (np.arange(1, len(order) + 1) >= SUPPORT) & (chance[order] > 0.5))
    return float(chance[order][able[-1]]) if len(able) else 2.0


class QualityModel:
    """Weights of both views, their calibrations and the combination."""

    def __init__(self, prior: float, text=None, meta=None, platt=None, mix=None):
        self.prior, self.text, self.meta, self.platt, self.mix = prior, text, meta, platt, mix


def co_train(xt, xm, y, held, ut, um, rounds: int = ROUNDS, precision: float = PRECISION) -> QualityModel:
    """Features and labels of labelled rows (``held``: kept for calibration), features of unlabelled ones."""
    return co_train_over(LocalPool(ut, um), xt, xm, y, held, rounds, precision)


def co_train_over(pool, xt, xm, y, held, rounds: int = ROUNDS, precision: float = PRECISION) -> QualityModel:
    """As ``co_train``, with the unlabelled rows in a pool."""
    prior = float(y.mean()) if len(y) else 1.0
    if not (~held).any() or len(set(y[~held])) < 2 or len(set(y[held])) < 2:
        return QualityModel(prior)
    x, own = {"text": xt, "meta": xm}, y[~held]
    scale = {"text": np.maximum(np.maximum(np.abs(xt).max(axis=0), pool.peaks()), 1e-9), "meta": np.ones(_width(xm))}
    teachers: dict[str, list[tuple]] = {"text": [], "meta": []}  # by pupil
    taught = {"text": (0, None), "meta": (0, None)}

    def fit(v: str) -> list[float]:
        def sums(w):
            mine = _sums(w, x[v][~held], own, np.ones(len(own)), scale[v])
            if not taught[v][0]:
                return mine
            return tuple(a + b for a, b in zip(mine, taught[v][1](w), strict=True))

        return _newton(sums, _width(x[v]), scale[v], ridge=1.0 if v == "meta" else 1e-2)

    for _ in range(rounds):
        moved = 0
        for teacher, pupil in (("text", "meta"), ("meta", "text")):
            w = fit(teacher)
            p = 1 / (1 + np.exp(-_odds(w, x[teacher][held])))
            sure = [_sure_from(chance, y[held] == label, precision) for label, chance in ((1.0, p), (0.0, 1 - p))]
            if min(sure) > 1:
                continue
            before = taught[pupil][0]
            teachers[pupil].append((w, *sure))
            taught[pupil] = pool.taught(pupil, list(teachers[pupil]), scale[pupil])
            moved += taught[pupil][0] - before
        if not moved:
            break
    text, meta = fit("text"), fit("meta")
    platt = []
    for w, v in ((text, xt), (meta, xm)):
        platt.append(fit_logistic(_odds(w, v[held])[:, None], y[held]))
    both = np.column_stack([_odds(c, _odds(w, v[held])[:, None]) for c, w, v in zip(platt, (text, meta), (xt, xm), strict=True)])
    return QualityModel(prior, text, meta, platt, fit_logistic(both, y[held]))


def fit_quality(docs: DataFrame, labels: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS, rounds: int = ROUNDS) -> QualityModel:
    """Fit on ``docs`` (doc_id, the text, lang, source, n_chars) and ``labels`` (doc_id, quality)."""
    one = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min((F.col("quality") > 0).cast("int")).alias("quality"))
    )
    body = docs.select("doc_id", F.col(text).cast("string").alias("text"), *_meta_slots_of(docs))
    flat = [F.col("__features")[i].alias(name) for i, name in enumerate(TEXT_FEATURES)]
    single = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).alias("__row")  # null ids aren't one document
    rows = with_features(body, "text", keep_text=False).select("doc_id", single, F.struct("__m0", "__m1", "__m2", *flat).alias("own"))
    rows = rows.groupBy("doc_id", "__row").agg(F.min("own").alias("own")).join(one, "doc_id", "left").select("doc_id", "quality", "own.*")
    rows = materialize(rows, "quality-features")
    known = rows.where("quality IS NOT NULL").orderBy(F.xxhash64("doc_id"), F.col("doc_id")).limit(sample_rows).toPandas()
    known = known.sort_values("doc_id")
    xt = known[TEXT_FEATURES].to_numpy(float)
    xm = known[["__m0", "__m1", "__m2"]].to_numpy(np.int64)
    held = np.arange(len(known)) % 4 == 0
    return co_train_over(SparkPool(rows.where("quality IS NULL")), xt, xm, known["quality"].to_numpy(float), held, rounds)


def _meta_slots_of(docs: DataFrame) -> list[Column]:
    own = [F.col(c) if c in docs.columns else F.lit(None) for c in ("lang", "source", "n_chars")]
    return [c.alias(f"__m{i}") for i, c in enumerate(_meta_slots(*own))]


def score_quality(docs: DataFrame, model: QualityModel, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``__p_text`` and ``__p_meta`` (calibrated views) and ``__score``, the chance of being good."""
    chance = lambda z: F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    if model.text is None:
        flat = [F.lit(model.prior).alias(c) for c in ("__p_text", "__p_meta", "__score")]
        return docs.select(*[c for c in docs.columns if keep_text or c != text], *flat)
    cut = lambda z: F.least(F.greatest(z, F.lit(-_CUT)), F.lit(_CUT))
    names = [c for c in docs.columns if keep_text or c != text]
    out = with_features(docs.select("*", *_meta_slots_of(docs)), text, keep_text)
    z_text = F.lit(model.text[0])
    for i, w in enumerate(model.text[1:]):
        z_text = z_text + F.lit(w) * F.col("__features")[i]
    weights = F.array(*[F.lit(w) for w in model.meta[1:]])
    z_meta = F.lit(model.meta[0]) + sum((weights[F.col(f"__m{i}")] for i in range(3)), F.lit(0.0))
    calibrated = [cut(F.lit(c[0]) + F.lit(c[1]) * cut(z)) for c, z in zip(model.platt, (z_text, z_meta), strict=True)]
    out = out.select(*names, calibrated[0].alias("__zt"), calibrated[1].alias("__zm"))
    score = chance(F.lit(model.mix[0]) + F.lit(model.mix[1]) * F.col("__zt") + F.lit(model.mix[2]) * F.col("__zm"))
    return out.select(*names, chance(F.col("__zt")).alias("__p_text"), chance(F.col("__zm")).alias("__p_meta"), score.alias("__score"))
