"""Quality scores by naive-Bayes support vectors over n-gram indicators.

A text's n-grams are those of its words, of the words' shapes (letter case, digits and marks), and
a few of the text as a whole (length, variety, share of the commonest shapes). Each indicator is
scaled by its class log-count ratio; on these a linear hinge-loss model is trained by dual coordinate
descent, and a logistic curve turns margins of rows outside its training folds into scores.

The classifier is fitted on at most SAMPLE_ROWS labelled rows per class, those with the smallest
hashes of doc_id; ``held_out`` rows, whose crc32(doc_id) mod FOLDS is 0, are never among them. All
texts are scored whole. Labels, language, source and doc_id are no inputs of a score.

Null text counts as empty; empty texts have a score, too. Null labels and labels of absent documents
are ignored; a document with conflicting labels counts once with each. Repeated rows get equal
scores. Without labelled rows of both classes every text scores the rate of class 1 (1 if unknown).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.scratch import find_package, over_texts

FOLDS = 5
#: The classifier is fitted on at most so many labelled rows of each class.
SAMPLE_ROWS = 600
ACCEPT = 0.3
MIN_TEXTS = 3
COST = 0.1
ROUNDS = 20
SMOOTHING = 1.0
_RUN = re.compile(r"(.)\1+", re.DOTALL)


@lru_cache(maxsize=200_000)
def shape(word: str) -> str:
    """X, x and 9 for runs of capitals, other letters and digits; marks stay, at most three alike."""
    if len(word) > 60:
        return "long"
    marks = "".join("X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c for c in word)
    return _RUN.sub(lambda m: m[1] if m[1] in "Xx9" else m[0][:3], marks)


def level(share: float) -> int:
    """0 for none, 1 to 7 for doubling shares from under 1/64."""
    return 0 if share <= 0 else int(np.clip(8 + np.floor(np.log2(share)), 1, 7))


def grams(text: str) -> set:
    words = text.split()
    if not words:
        return {"empty"}
    shapes = [shape(w) for w in words]
    found = set(words)
    found.update(zip(words, words[1:]))
    counts = Counter(shapes)
    found.update(f"{s} {level(n / len(words))}" for s, n in counts.items())
    found.update(zip("s" * len(shapes), shapes, shapes[1:], strict=False))
    found.update(zip("t" * len(shapes), shapes, shapes[1:], shapes[2:], strict=False))
    again = sum(a == b for a, b in zip(words, words[1:]))
    found.update((f"again {level(again / len(words))}", f"words {len(words).bit_length()}"))
    found.add(f"variety {level(len(set(words)) / len(words))} {min(10, len(words).bit_length())}")
    return found


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % FOLDS, F.lit(0)) == 0


def margins_of(weights: dict, intercept: float, texts: list[str]) -> np.ndarray:
    get = weights.get
    out = np.empty(len(texts))
    for i, text in enumerate(texts):
        out[i] = intercept + sum([x for g in grams(text) if (x := get(g)) is not None])
    return out


@dataclass(frozen=True)
class Classifier:
    weights: dict
    intercept: float
    slope: float
    shift: float

    def scores(self, texts: list[str]) -> np.ndarray:
        margin = margins_of(self.weights, self.intercept, texts)
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -40, 40)))


def dual_descent(rows: list[np.ndarray], scale: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Weights of the L1-loss support vector machine; ``rows`` lists the indicators of each text."""
    w, alpha = np.zeros(len(scale)), np.zeros(len(rows))
    square = np.array([np.sum(scale[r] ** 2) for r in rows])
    random = np.random.default_rng(0)
    for _ in range(ROUNDS):
        moved = 0.0
        for i in random.permutation(len(rows)).tolist():
            if square[i] == 0:
                continue
            r = rows[i]
            slope = y[i] * (w[r] @ scale[r]) - 1
            new = min(max(alpha[i] - slope / square[i], 0.0), cost[i])
            if new != alpha[i]:
                w[r] += (new - alpha[i]) * y[i] * scale[r]
                moved += abs(new - alpha[i])
                alpha[i] = new
        if moved < 1e-4 * cost.sum():
            break
    return w


def support_vectors(bags: list[set], y: np.ndarray) -> tuple[dict, float]:
    """(weight of each n-gram, intercept): log-count ratios times hinge-loss weights."""
    seen = Counter(g for bag in bags for g in bag)
    place = {g: i for i, g in enumerate(sorted((g for g, n in seen.items() if n >= MIN_TEXTS), key=repr))}
    bias = len(place)
    rows = [np.array(sorted([place[g] for g in bag if g in place] + [bias]), np.int64) for bag in bags]
    counts = {s: np.full(bias + 1, SMOOTHING) for s in (1, -1)}
    for r, s in zip(rows, y.tolist(), strict=True):
        counts[s][r] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[-1] / counts[-1].sum())
    ratio[bias] = 1.0
    # Both classes weigh alike, however rare one is.
    share = np.where(y > 0, (y > 0).mean(), (y < 0).mean())
    w = dual_descent(rows, ratio, y, COST * 0.5 / share) * ratio
    return {g: float(w[i]) for g, i in place.items() if w[i] != 0}, float(w[bias])


def train(texts: list[str], labels: list[int]) -> Classifier:
    y = np.where(np.array(labels, int) > 0, 1, -1)
    if not len(y) or abs(y.sum()) == len(y):
        rate = (y > 0).mean() if len(y) else 1.0
        return Classifier({}, 0.0, 0.0, 40.0 if rate else -40.0)
    bags = [grams(t) for t in texts]
    fold = np.array([zlib.crc32(t.encode()) % 3 for t in texts])
    margin = np.zeros(len(y))
    for f in range(3):
        inside = np.flatnonzero(fold != f)
        if len(inside) and abs(y[inside].sum()) < len(inside):
            weights, intercept = support_vectors([bags[i] for i in inside], y[inside])
            for i in np.flatnonzero(fold == f).tolist():
                margin[i] = intercept + sum(weights.get(g, 0.0) for g in bags[i])
    slope, shift = curve(margin, y)
    return Classifier(*support_vectors(bags, y), slope, shift)


def curve(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic curve through (margin, label), by Newton steps with a small ridge."""
    x, w = np.stack([margin, np.ones(len(margin))], 1), np.array([1.0, 0.0])
    weight = np.where(y > 0, 0.5 / (y > 0).mean(), 0.5 / (y < 0).mean())
    goal = np.where(y > 0, 1.0, 0.0)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = x.T @ (weight * (goal - p)) - 1e-3 * w
        w = w + np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2), step)
    return float(max(w[0], 1e-6)), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Classifier:
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(~held_out(F.col("doc_id"))).distinct()
    order = F.xxhash64("doc_id")
    parts = [known.where(F.col("quality") == q).orderBy(order, "doc_id").limit(sample_rows) for q in (0, 1)]
    chosen = parts[0].unionByName(parts[1])
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # Two times sample_rows rows at most: a broadcast of that size, and as many texts.
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    rows = sorted((r["doc_id"], r["quality"], r["text"]) for r in rows.collect())
    return train([r[2] for r in rows], [r[1] for r in rows])


def score(docs: DataFrame, model: Classifier) -> DataFrame:
    """(doc_id, held_out, score, predicted)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(ids: list, texts: list[str]) -> dict:
        return {"doc_id": ids, "score": shared.value.scores(texts)}

    scored = over_texts(docs, work, "doc_id long, score double")
    predicted = F.when(F.col("score") >= ACCEPT, 1).otherwise(0)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def accepted(docs: DataFrame, model: Classifier) -> DataFrame:
    """The documents, with all their columns, that the classifier predicts to be of class 1."""
    find_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = part.column(part.schema.get_field_index("text")).fill_null("").to_pylist()
                yield part.filter(pa.array(shared.value.scores(texts) >= ACCEPT))

    return docs.mapInArrow(run, docs.schema)
