"""Toxicity by maximum-scoring segments.

Method. Every word has a score: its log-odds in toxic against clean documents under a Dirichlet prior that follows all labelled
text, drawn towards 0 by its standard error, less a small drift. A document counts a word once, however often it repeats it,
copies of a text count as one document, and a word without a score of its own has that of its first letters, which are counted in the same way. A linear-time scan finds every maximal-scoring segment of
a document: the passages where toxic words are dense. Scores of chance segments follow an extreme-value law, whose decay comes from
the word scores' distribution in clean text and whose size from the best segments of clean documents; it turns segment scores into
expected numbers of chance segments, corrected for the document's length. The sum over the best r segments
gives the evidence of the whole text, which a logistic curve fitted on labelled documents turns into a probability.

The classifier is fitted on a bounded sample of the labelled documents in the training folds, ``sample_per_class`` of each class by a
hash of the id, and keeps at most ``max_words`` words. Scoring covers whole texts.

Defined results: a null or empty text has no segments and the lowest score; if either class has no labelled document, every score
is the share of toxic labels, kept below 0.5; a label for a null id or a null label counts for nothing, and of several labels of one id
the largest holds; a null id is not held out; rows that repeat an id are scored each by itself; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_spark.llm.common import crc_mod, share, written

WORD = re.compile(r"[^\W_]+")
THRESHOLD = 0.7
DRIFT, ERRORS, LEAST_WEIGHT, PRIOR_SHARE, PRIOR_FLAT = 0.25, 2.0, 1.0, 0.01, 0.5
#: A word that comes again within so many words adds nothing.
AGAIN = 50
EULER = 0.5772156649015329
HELD_WORDS = 150_000
#: Words of at least so many letters back off to their first ``STEM`` letters.
STEM, STEM_FROM = 5, 6


class Scores(dict):
    """Scores by word, filled from the model's words and stems as words come up; bounded by forgetting them all."""

    def __init__(self, known: dict[str, float]):
        super().__init__()
        self.known = known

    def __missing__(self, word: str) -> float:
        if len(self) >= HELD_WORDS:
            self.clear()
        value = self.known.get(word)
        if value is None:
            value = self.known.get(word[:STEM] + "~", 0.0) if len(word) >= STEM_FROM else 0.0
        self[word] = value
        return value


@dataclass
class Model:
    """Word scores, the extreme-value law's decay and log size, and the logistic curve over a text's evidence."""

    scores: dict[str, float] = field(default_factory=dict)
    decay: float = 1.0
    log_size: float = 0.0
    slope: float = 0.0
    offset: float = -5.0


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (begin, end, score) of a sequence, in order, by the scan of Ruzzo and Tompa.

    Only positions with a positive score open a candidate, so the scan costs little beyond the running sum.
    """
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    stack: list[tuple[int, int, float, float, int]] = []  # begin, end, sum before, sum at the end, last with a smaller sum before
    for at in np.flatnonzero(scores > 0).tolist():
        begin, end, low, high = at, at + 1, float(sums[at]), float(sums[at + 1])
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= low:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= high:
                break
            begin, low = stack[j][0], stack[j][2]
            del stack[j:]
        stack.append((begin, end, low, high, j))
    return [(b, e, high - low) for b, e, low, high, _ in stack]


def tokens_of(text: str | None) -> set[str]:
    """A text's distinct words, and stems marked as such."""
    words = set(WORD.findall(text.lower())) if text else set()
    return words | {w[:STEM] + "~" for w in words if len(w) >= STEM_FROM}


def word_scores(text: str | None, scores: Scores) -> np.ndarray:
    """Scores of a text's words in order, less the drift; one that comes again soon scores nothing."""
    words = WORD.findall(text.lower()) if text else []
    out, last = np.fromiter(map(scores.__getitem__, words), float, len(words)), {}
    for at in np.flatnonzero(out > 0).tolist():
        if at - last.get(words[at], -AGAIN) < AGAIN:
            out[at] = 0.0
        last[words[at]] = at
    return out - DRIFT


def evidence(segments: list[tuple[int, int, float]], n: int, model: Model) -> float:
    """Minus the log of the chance that n clean words hold r segments as good as the best r, for the r where it is least."""
    best, total = 0.0, 0.0
    excess = sorted((model.decay * s - model.log_size - math.log(n) for _, _, s in segments), reverse=True)
    for r, x in enumerate(excess, 1):
        total += x
        if x <= 0 and r > 1:
            break
        t = total + math.lgamma(r + 1)
        if t > 0:
            best = max(best, t - (r - 1) * math.log(max(t, 1.0)) + math.lgamma(r + 1) + math.lgamma(r) - 2 * math.lgamma(r + 1))
        elif r == 1:
            best = math.log1p(math.exp(min(t, 0.0)))
    return best


def count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How many clean and how many toxic texts have each word or stem, passed on whenever many are held."""
    counts = (Counter(), Counter())

    def held() -> pd.DataFrame:
        rows = [(w, counts[0][w], counts[1][w]) for w in {*counts[0], *counts[1]}]
        return pd.DataFrame(rows, columns=["word", "clean", "toxic"])

    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
            counts[int(toxic)].update(tokens_of(text))
            if len(counts[0]) + len(counts[1]) > HELD_WORDS:
                yield held()
                for c in counts:
                    c.clear()
    yield held()


def training_documents(
    docs: DataFrame, labels: DataFrame, sample_per_class: int, id_col: str, text_col: str, label_col: str
) -> tuple[DataFrame, dict[int, float]]:
    """A bounded sample of labelled documents of the training folds, and the share taken of each class."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (crc_mod(F.col(id_col), 3) != 1))
    known = known.groupBy(F.col(id_col).alias("__id")).agg((F.max(label_col) > 0).alias("toxic"))
    sizes = {int(t): n for t, n in known.groupBy("toxic").count().collect()}
    shares = {t: min(1.0, sample_per_class / n) for t, n in sizes.items()}
    picked = F.lit(False)
    for t, part in shares.items():
        picked = picked | ((F.col("toxic").cast("int") == t) & share(F.col("__id"), part, 5))
    # At most about 2 * sample_per_class ids: small enough for every executor, by the sample's bound.
    sample = F.broadcast(known.where(picked))
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).join(sample, "__id")
    return rows.select("text", "toxic", share(F.col("__id"), 2 / 3, 6).alias("first")), shares


def fit(
    docs: DataFrame, labels: DataFrame, sample_per_class: int = 20_000, max_words: int = 200_000,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
) -> Model:
    """Word scores from two thirds of the sample, the extreme-value law and the logistic curve from the other third."""
    rows, shares = training_documents(docs, labels, sample_per_class, id_col, text_col, label_col)
    # Copies of one text are one witness.
    sample = written(rows.dropDuplicates(["text"]), "toxicity-sample")
    counts = sample.where("first").mapInPandas(count_words, "word string, clean bigint, toxic bigint")
    words = written(counts.groupBy("word").agg(*(F.sum(c).alias(c) for c in ("clean", "toxic"))), "toxicity-words")
    n0, n1 = words.agg(F.coalesce(F.sum("clean"), F.lit(0)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not n0 or not n1:
        toxic = {t: 0 for t in (0, 1)} | {int(t): n for t, n in sample.groupBy("toxic").count().collect()}
        rate = min(0.49, (toxic[1] + 0.5) / (toxic[0] + toxic[1] + 1)) if toxic[0] + toxic[1] else 0.01
        return Model(offset=math.log(rate / (1 - rate)))
    strength = PRIOR_SHARE * (n0 + n1)
    prior = (F.col("clean") + F.col("toxic")) * F.lit(strength / (n0 + n1)) + PRIOR_FLAT
    one, zero = F.col("toxic") + prior, F.col("clean") + prior
    odds = F.log(one / (n1 + strength - one + 1)) - F.log(zero / (n0 + strength - zero + 1))
    error = F.sqrt(1 / one + 1 / zero)
    drawn = F.signum(odds) * F.greatest(F.abs(odds) - ERRORS * error, F.lit(0.0))
    scored = words.select("word", (zero / (n0 + strength)).alias("p0"), drawn.alias("score"), "toxic")
    kept = scored.where((F.abs("score") >= LEAST_WEIGHT) & ((F.col("score") < 0) | (F.col("toxic") > 1)))
    table = kept.orderBy(F.abs("score").desc(), "word").limit(max_words).toPandas()
    model = Model(scores=dict(zip(table["word"], table["score"], strict=True)))
    model.decay = decay(table["score"].to_numpy(), table["p0"].to_numpy())
    return calibrated(sample.where("not first"), model, shares)


def decay(scores: np.ndarray, p0: np.ndarray) -> float:
    """The positive root of ``sum p0 * exp(decay * score) = 1`` over clean text, words without a score included."""
    scores, p0 = np.append(scores, 0.0) - DRIFT, np.append(p0, max(0.0, 1 - p0.sum()))
    low, high = 1e-6, 1e-6
    while high < 50 and (p0 * np.exp(np.minimum(high * scores, 700))).sum() < 1:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (p0 * np.exp(np.minimum(middle * scores, 700))).sum() < 1 else (low, middle)
    return high


def calibrated(sample: DataFrame, model: Model, shares: dict[int, float]) -> Model:
    """Fit the extreme-value law's size to the best segments of clean documents, then the logistic curve."""

    def best_segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Scores(model.scores)
        for batch in batches:
            rows = []
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                scores = word_scores(text, known)
                segments = sorted((s for _, _, s in maximal_segments(scores)), reverse=True)[:200]
                rows.append((bool(toxic), len(scores), segments))
            yield pd.DataFrame(rows, columns=["toxic", "n", "segments"])

    # A row for each document of the bounded sample. The segments past the 200 best add nothing to a curve that is flat by then.
    found = sample.mapInPandas(best_segments, "toxic boolean, n bigint, segments array<double>").toPandas()
    clean = found[~found["toxic"] & (found["n"] > 0)]
    if len(clean):
        best = np.array([max(s, default=0.0) for s in clean["segments"]])
        model.log_size = float(np.mean(model.decay * best - np.log(clean["n"].to_numpy()))) - EULER
    x = np.array([evidence([(0, 0, s) for s in own], max(1, n), model) for n, own in zip(found["n"], found["segments"], strict=True)])
    y = found["toxic"].to_numpy().astype(float)
    if 0 < y.sum() < len(y):
        weight = np.where(y > 0, 1 / shares.get(1, 1.0), 1 / shares.get(0, 1.0))
        model.slope, model.offset = logistic(np.minimum(x, 60.0), y, weight)
    return model


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, with targets kept a little away from 0 and 1."""
    n1, n0 = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    design, beta = np.stack([x, np.ones_like(x)], axis=1), np.array([0.5, -2.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (target - p)) - 1e-3 * beta
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(beta[0], 0.0)), float(beta[1])


def probability(x: float, model: Model) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, model.slope * min(x, 60.0) + model.offset))))


def annotated(docs: DataFrame, model: Model, column: str, text_col: str = "text", max_chance: float = 0.01) -> DataFrame:
    """Add ``struct(score, passages)``: passages are the segments (first word, word after the last, score, expected number by
    chance) of which fewer than ``max_chance`` are expected in a clean text of that length."""

    @F.pandas_udf("score double, passages array<struct<begin:int,end:int,score:double,chance:double>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = Scores(model.scores)
        for texts in batches:
            rows = []
            for text in texts:
                scores = word_scores(text, known)
                segments, n = maximal_segments(scores), max(1, len(scores))
                chances = [math.exp(min(50.0, model.log_size + math.log(n) - model.decay * s)) for _, _, s in segments]
                passages = [(b, e, s, c) for (b, e, s), c in zip(segments, chances, strict=True) if c < max_chance]
                rows.append((probability(evidence(segments, n, model) if segments else 0.0, model), passages))
            yield pd.DataFrame(rows, columns=["score", "passages"])

    return docs.withColumn(column, run(F.col(text_col)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted, passages`` for each document."""
    held_out = F.coalesce(crc_mod(F.col(id_col), 3) == 1, F.lit(False))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), held_out.alias("held_out"), F.col(text_col).alias("text"))
    predicted = (F.col("found.score") >= THRESHOLD).cast("int").alias("predicted")
    return annotated(rows, model, "found").select("doc_id", "held_out", "found.score", predicted, "found.passages")
