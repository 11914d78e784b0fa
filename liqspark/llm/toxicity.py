"""Toxic passages as maximum-scoring segments.

Words and their beginnings get log-odds of the toxic against the other labelled
documents, with a Dirichlet prior from the counts of the whole corpus; a word
scores by the surer of the two. One linear scan over a
document's words finds all its maximal segments, and the extreme-value
distribution of the best segment of clean text says how likely a segment is by
chance in a text of that length. The document's best segments are aggregated
by the sum statistic of that distribution, and its score is the calibrated
probability of the label given how unlikely they are together.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, stored

BEGINNING = 4  # letters
# Labelled documents the weights and the calibration are fitted on (the
# smallest hashes of their ids); corpus counts cover all documents.
TRAIN_DOCS = 50_000
PRIOR_WORDS = 2_000.0  # weight of the corpus prior, in words
FLOOR = 0.5  # documents added to each of a word's counts; bounds the error of rare words
CONFIDENCE = 3.0  # standard errors a word's log-odds are moved towards zero
DRIFT = 0.5  # each word's cost; makes the expected score of clean text negative
# Beyond this surprise more evidence is no more certainty: it is the greatest
# input of the calibration. So many segments above the level reach it whatever
# their scores, so a further one changes nothing.
SATURATION = 12.0
BEST_SEGMENTS = 40
SUM_STEP, SUM_END = 0.25, 120.0  # places the law of the sums is tabled at
MAX_P = 0.05  # chance a significant passage may have in clean text of that length
THRESHOLD = 0.3  # fixed value
CACHE_WORDS = 100_000  # of which a task keeps counts or scores at a time

WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    """Word weights and the constants of calibration."""

    weights: np.ndarray  # float32, of ``features``
    rate: float = 1.0  # of the exponential tail of clean text's best segment
    scale: float = 1.0  # expected segments a word that reach score zero
    slope: float = 0.0
    intercept: float = 0.0
    features: tuple[str, ...] = ()  # words, and beginnings with "-"; all others weigh nothing

    @cached_property
    def by_feature(self) -> dict[str, float]:
        return dict(zip(self.features, self.weights.tolist()))

    @cached_property
    def by_word(self) -> dict[str, float]:
        return {}

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("by_feature", "by_word")}

    def weigh(self, word: str) -> float:
        """The surer of the weights of a word and its beginning."""
        if len(self.by_word) > CACHE_WORDS:
            self.by_word.clear()
        whole, start = self.by_feature.get(word, 0.0), self.by_feature.get(beginning(word), 0.0)
        got = self.by_word[word] = whole if abs(whole) >= abs(start) else start
        return got


def beginning(word: str) -> str:
    """A word's first letters as a feature that equals no word."""
    return word[:BEGINNING] + "-"


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def log_odds(toxic: np.ndarray, clean: np.ndarray, corpus: np.ndarray, prior: float = PRIOR_WORDS,
             confidence: float = CONFIDENCE, sums: tuple[float, float, float] | None = None) -> np.ndarray:
    """Log-odds of each word with a Dirichlet prior in proportion to the corpus
    counts, moved towards zero by ``confidence`` standard errors. ``sums`` are
    those of the three counts, the last with 0.01 more a word, if the words are
    only a part of all."""
    all_toxic, all_clean, all_corpus = sums or (toxic.sum(), clean.sum(), (corpus + 0.01).sum())
    alpha = prior * (corpus + 0.01) / all_corpus
    a, b = toxic + alpha + FLOOR, clean + alpha + FLOOR
    delta = np.log(a / (all_toxic + prior - a)) - np.log(b / (all_clean + prior - b))
    error = np.sqrt(1 / a + 1 / b)
    return (np.sign(delta) * np.maximum(np.abs(delta) - confidence * error, 0)).astype(np.float32)


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in order, by one scan:
    a stack of candidates with the running sum before and after each. Only
    positive scores begin candidates, so the scan touches those alone."""
    total = np.concatenate([[0.0], np.cumsum(scores, dtype=np.float64)])
    stack: list[tuple[int, int, float, float]] = []
    for i in np.flatnonzero(scores > 0).tolist():
        start, end, left, right = i, i + 1, total[i], total[i + 1]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j -= 1
            if j < 0 or stack[j][3] >= right:
                break
            start, left = stack[j][0], stack[j][2]
            del stack[j:]
        stack.append((start, end, left, right))
    return [(s, e, float(r - x)) for s, e, x, r in stack]


def fit_extreme_value(best: np.ndarray, words: np.ndarray) -> tuple[float, float]:
    """Rate and scale of P(best > x) = 1 - exp(-scale words e^(-rate x)) by
    maximum likelihood on clean texts that have a segment; the top hundredth is
    left out, as labels err."""
    use = (words > 0) & (best > 0)
    if use.sum() < 10:
        return 1.0, 1.0
    x, n = best[use].astype(float), words[use].astype(float)
    kept = x <= np.quantile(x, 0.99)
    x, n = x[kept], n[kept]
    n_all = max(float(words.sum()), 1.0)

    def slack(rate: float) -> float:
        e = n * np.exp(-rate * (x - x.min()))
        return 1 / rate - x.mean() + (x * e).sum() / e.sum()

    low, high = 1e-3, 50.0
    for _ in range(80):
        mid = math.sqrt(low * high)
        low, high = (mid, high) if slack(mid) > 0 else (low, mid)
    rate = math.sqrt(low * high)
    # texts without a segment count by their words: their best lies at zero or below
    return rate, float(len(x) / (n * np.exp(-rate * x)).sum()) * float(n.sum() / n_all)


def best_scores(scores: np.ndarray) -> list[float]:
    """Scores of the best segments, best first."""
    return sorted((x[2] for x in segments(scores)), reverse=True)[:BEST_SEGMENTS]


@lru_cache(maxsize=1)
def sum_surprise() -> np.ndarray:
    """-log10 P(sum of the r best normalised scores of clean text >= t), a row
    for r = 2 to ``BEST_SEGMENTS``, a column for t = 0 to ``SUM_END``.

    Clean text's segments beyond the level are a Poisson process of intensity
    e^-x; the density of the sum of its r best points is
    e^-t / (r! (r-2)!) times the integral of y^(r-2) exp(-e^((y-t)/r)) over y."""
    t = np.arange(0.0, SUM_END + SUM_STEP, SUM_STEP)
    rows = []
    for r in range(2, BEST_SEGMENTS + 1):
        y = np.arange(0.0, SUM_END + 5 * r, SUM_STEP)
        inner = np.trapezoid(y ** (r - 2) * np.exp(-np.exp((y[None, :] - t[:, None]) / r)), dx=SUM_STEP, axis=1)
        density = np.exp(np.log(inner) - t - math.lgamma(r + 1) - math.lgamma(r - 1))
        steps = (density[1:] + density[:-1]) * SUM_STEP / 2
        tail = density[-1] + np.concatenate([np.cumsum(steps[::-1])[::-1], [0.0]])
        rows.append(-np.log10(tail))
    return np.stack(rows)


def joint_surprise(best: list[float], words: int, model: Model) -> float:
    """-log10 of the chance of the best segments of a text together, at most
    ``SATURATION``: the smallest over r of the chance that clean text's r best
    normalised scores have such a sum, times r (r + 1) for the choice of r (the
    inverses add up to one). All segments that score above the level count,
    those of which clean text of that length is expected to have less than one.
    A better or a further segment never lowers it."""
    if not best or not words:
        return 0.0
    level, total = math.log(model.scale * words), 0.0
    most = surprise(best[0], words, model) - math.log10(2)
    for r, score in enumerate(best, 1):
        over = model.rate * score - level
        if over <= 0 or most >= SATURATION:
            break
        total += over
        if r > BEST_SEGMENTS or total >= SUM_END:
            return SATURATION
        if r > 1:
            row, (at, part) = sum_surprise()[r - 2], divmod(total / SUM_STEP, 1)
            known = row[int(at)] + part * (row[int(at) + 1] - row[int(at)])
            most = max(most, float(known) - math.log10(r * (r + 1)))
    return min(max(most, 0.0), SATURATION)


def surprise(score: float, words: int, model: Model) -> float:
    """-log10 of the chance that clean text of so many words has such a segment."""
    if score <= 0 or not words:
        return 0.0
    log_expected = math.log(model.scale * words) - model.rate * score
    if log_expected < -30:
        return min(-log_expected / math.log(10), 300.0)
    return -math.log10(-math.expm1(-math.exp(min(log_expected, 50.0))) or 1e-300)


def fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope (never negative) and intercept of P(y = 1 | x), with smoothed targets."""
    pos, neg = y.sum(), len(y) - y.sum()
    if not pos or not neg:
        return 0.0, math.log((pos + 0.5) / (neg + 0.5))
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    w = np.array([0.0, math.log(pos / neg)])
    design = np.stack([x, np.ones_like(x)], 1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (target - p) - 1e-6 * w
        hess = (design * (p * (1 - p))[:, None]).T @ design + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w = w + step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    return max(0.0, float(w[0])), float(w[1])


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Rows whose labels are never learnt from: crc32(doc_id as text) mod 4 is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _word_scores(text: str | None, model: Model) -> np.ndarray:
    if not text:
        return np.zeros(0, np.float32)
    known = model.by_word
    scores = [x if (x := known.get(w)) is not None else model.weigh(w) for w in words_of(text)]
    return np.array(scores, np.float32) - np.float32(DRIFT)


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> Model:
    """Weights and calibration from the labelled rows that aren't held out.

    Of those, the ``train_docs`` with the smallest hash of their id are used;
    their ids are the only thing broadcast. Words of all documents are counted by
    the word itself, in a table in the shared folder; only features whose weight
    isn't zero come back, and they are among those of the training rows. Rows with a null label or doc_id are
    skipped, an id with several labels counts as toxic if one says so. Of
    several texts with one id the calibration takes that with the best segment.
    """
    spark = docs.sparkSession
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy(
        F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
    marked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(known), "doc_id", "left").select("doc_id", "text", "toxic")
    names = ["feature", "n", "clean", "toxic"]

    def counted(n: Counter, labelled: list[Counter]) -> pa.RecordBatch:
        starts: Counter = Counter()
        for word, times in n.items():
            starts[beginning(word)] += times
        keys = [*n, *starts]
        columns = [[*n.values(), *starts.values()], *([x[k] for k in keys] for x in labelled)]
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(pa.array(c, pa.int64()) for c in columns)], names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, labelled = Counter(), [Counter(), Counter()]
        for b in slices(batches):
            for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                words = words_of(text or "")
                n.update(words)
                if toxic is not None:  # documents with the feature
                    labelled[toxic].update({*words, *map(beginning, words)})
                if len(n) > CACHE_WORDS:
                    yield counted(n, labelled)
                    n, labelled = Counter(), [Counter(), Counter()]
        yield counted(n, labelled)

    counts = stored(marked.mapInArrow(count, "feature string, n bigint, clean bigint, toxic bigint").groupBy("feature").agg(
        *[F.sum(c).alias(c) for c in names[1:]]), "words")
    total = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names[1:]], F.count(F.lit(1)).alias("v")).first()
    sums = float(total["toxic"]), float(total["clean"]), total["n"] + 0.01 * total["v"]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            toxic, clean, n = (b.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("toxic", "clean", "n"))
            w = log_odds(toxic, clean, n, sums=sums)
            yield pa.RecordBatch.from_arrays([b.column("feature"), pa.array(w)], ["feature", "w"]).filter(pa.array(w != 0))

    # a feature no training row has weighs nothing
    found = counts.where("clean + toxic > 0").mapInArrow(weigh, "feature string, w float").toPandas().sort_values("feature")
    weights, features = found["w"].to_numpy(np.float32), tuple(found["feature"])
    shared = spark.sparkContext.broadcast(Model(weights, features=features))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = []
            for text in b.column("text").to_pylist():
                s = _word_scores(text, shared.value)
                rows.append((best_scores(s), len(s)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([r[0] for r in rows], pa.list_(pa.float64())), pa.array(
                [r[1] for r in rows], pa.int64()), b.column("toxic")], ["doc_id", "best", "words", "toxic"])

    # at most train_docs rows of at most BEST_SEGMENTS numbers
    seen = (marked.where("toxic is not null").mapInArrow(best, "doc_id bigint, best array<double>, words bigint, toxic int")
            .groupBy("doc_id").agg(F.max(F.struct("best", "words", "toxic")).alias("top")).select("top.*")
            .sort(F.xxhash64("best", "words", "toxic"), "words").toPandas())
    tops = [list(b) for b in seen["best"]]
    x = np.array([b[0] if b else 0.0 for b in tops])
    n, y = seen["words"].to_numpy(np.int64), seen["toxic"].to_numpy(int)
    rate, scale = fit_extreme_value(x[y == 0], n[y == 0])
    model = Model(weights, rate, scale, features=features)
    t = np.array([joint_surprise(a, b, model) for a, b in zip(tops, n.tolist())])
    slope, intercept = fit_logistic(t, y) if len(y) else (0.0, math.log(0.5 / 10))
    return Model(weights, rate, scale, slope, intercept, features)


def judge(text: str | None, model: Model, max_p: float = MAX_P) -> tuple[float, list[tuple[int, int, float]]]:
    """Score of a text and its significant passages (first word, word after
    the last, surprise)."""
    s = _word_scores(text, model)
    every = segments(s)
    best = sorted((x for _, _, x in every), reverse=True)[:BEST_SEGMENTS]
    t = joint_surprise(best, len(s), model)
    found = [(a, b, surprise(x, len(s), model)) for a, b, x in every]
    return 1 / (1 + math.exp(-(model.slope * t + model.intercept))), [x for x in found if x[2] >= -math.log10(max_p)]


def score(docs: DataFrame, model: Model, max_p: float = MAX_P) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``score`` (0 to 1) and ``passages``
    (first word, word after the last, -log10 of the chance).

    No shuffle. Repeated rows and null doc_ids keep a row each; null and empty
    texts have the score of a text without a passage; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("surprise", pa.float64())]))
        for b in slices(batches):
            rows = [judge(t, shared.value, max_p) for t in b.column("text").to_pylist()]
            spans = [[{"first": a, "end": e, "surprise": s} for a, e, s in p] for _, p in rows]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([r[0] for r in rows], pa.float64()),
                                              pa.array(spans, kind)], ["doc_id", "score", "passages"])

    kept = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return kept.mapInArrow(run, "doc_id bigint, score double, passages array<struct<first:bigint,end:bigint,surprise:double>>")


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield b.filter(pa.array([judge(t, shared.value)[0] < threshold for t in b.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
