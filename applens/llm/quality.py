"""Quality classifier: a linear hinge-loss model over n-gram indicators scaled by naive Bayes weights.

Indicators are the text's byte 2- and 3-grams and its patterns of repeated
words (which of the last few words equal the present one), each counted once a
text.  On the training rows every indicator gets the ratio of its smoothed log
counts in the two classes; scaled by it, the indicators are the support
vectors of a linear model with L2-regularised hinge loss, fitted by dual
coordinate descent.  A logistic curve fitted to margins of held-out folds turns
margins into scores between 0 and 1.

The fit sees at most ``max_train`` labelled texts, in the order of a hash of
their ids, so what reaches the driver has a fixed bound.  Scoring reads every
whole text where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from applens.llm.common import byte_texts, id_and_text, tidy

MAX_TRAIN = 6_000
TRIGRAM_BITS = 17
REACH = 4                       # words that a repetition pattern looks back over
FOLDS = 5                       # of which fold 0, by crc32 of the id, is never learnt from
THRESHOLD = 0.3
_PAIRS, _TRIPLES = 1 << 16, 1 << TRIGRAM_BITS
N_FEATURES = _PAIRS + _TRIPLES + (1 << REACH)


def indicators(text: bytes, seen: np.ndarray) -> np.ndarray:
    """Sorted features of a text; ``seen`` is a zeroed scratch array, left zeroed."""
    b = np.frombuffer(text, np.uint8)
    if len(b) > 1:
        wide = b.astype(np.uint32)
        pairs = (wide[:-1] << 8) | wide[1:]
        seen[pairs] = 1
        if len(b) > 2:
            triples = ((pairs[:-1] << 8) | wide[2:]) * np.uint32(2654435761)
            seen[_PAIRS + (triples >> np.uint32(32 - TRIGRAM_BITS))] = 1
    words = text.split()
    if len(words) > 1:
        h = np.fromiter(map(hash, words), np.int64, len(words))
        pattern = np.zeros(len(words), np.int64)
        for k in range(1, min(REACH, len(words) - 1) + 1):
            pattern[k:] |= (h[k:] == h[:-k]).astype(np.int64) << (k - 1)
        seen[_PAIRS + _TRIPLES + pattern] = 1
    found = np.flatnonzero(seen)
    seen[found] = 0
    return found


@dataclass
class QualityModel:
    """Feature weights (naive Bayes ratios already multiplied in), bias, and the curve from margin to score."""
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, found: np.ndarray) -> float:
        n = len(found)
        return float(self.weights[found].sum()) / max(n, 1) ** 0.5 + self.bias

    def score(self, margin: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30))))


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """log of (share of the feature among class 1's indicators / among the other class's)."""
    counts = np.full((2, N_FEATURES), smoothing)
    for found, label in zip(rows, y):
        counts[int(label > 0), found] += 1
    share = counts / counts.sum(axis=1, keepdims=True)
    return np.log(share[1] / share[0])


def hinge_dual_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, c: np.ndarray, epochs: int = 20,
                       tolerance: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and bias of the L1-loss linear SVM with cost ``c`` per row, one dual variable at a time."""
    w, bias = np.zeros(N_FEATURES), 0.0
    alpha = np.zeros(len(y))
    norm = np.array([v @ v + 1.0 for v in values])
    rng = np.random.default_rng(11)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(y)):
            g = y[i] * (w[rows[i]] @ values[i] + bias) - 1
            projected = min(g, 0.0) if alpha[i] == 0 else max(g, 0.0) if alpha[i] == c[i] else g
            worst = max(worst, abs(projected))
            if projected:
                new = min(max(alpha[i] - g / norm[i], 0.0), c[i])
                step = (new - alpha[i]) * y[i]
                w[rows[i]] += step * values[i]
                bias += step
                alpha[i] = new
        if worst < tolerance:
            break
    return w, bias


def _logistic(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(y = 1 | margin), by Newton steps on smoothed targets."""
    n1, n0 = (y > 0).sum(), (y <= 0).sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        r, s = p - t, np.maximum(p * (1 - p), 1e-9)
        grad = np.array([(r * margins).sum() + 1e-3 * a, r.sum()])
        hess = np.array([[(s * margins ** 2).sum() + 1e-3, (s * margins).sum()], [(s * margins).sum(), s.sum() + 1e-6]])
        step = np.linalg.solve(hess, grad)
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
        if abs(step).max() < 1e-6:
            break
    return max(float(a), 1e-3), float(b)


def fit(rows: list[np.ndarray], labels: np.ndarray, cost: float = 1.0, folds: int = 3) -> QualityModel:
    """The model for feature rows and 0/1 labels; the rarer class weighs as much as the other one."""
    y = np.where(np.asarray(labels) > 0, 1.0, -1.0)
    if len(y) == 0 or (y == y[0]).all():
        return QualityModel(np.zeros(N_FEATURES), 0.0, 1.0, 0.0 if len(y) == 0 else 3.0 * y[0])

    def learn(keep: np.ndarray) -> tuple[np.ndarray, float]:
        use = [rows[i] for i in keep]
        ratios = log_count_ratios(use, y[keep])
        values = [ratios[f] / max(len(f), 1) ** 0.5 for f in use]
        share = np.where(y[keep] > 0, (y[keep] > 0).mean(), (y[keep] <= 0).mean())
        w, bias = hinge_dual_descent(use, values, y[keep], cost * 0.5 / share)
        return w * ratios, bias

    order = np.arange(len(y))
    margins = np.zeros(len(y))
    for k in range(folds):
        out, keep = order[order % folds == k], order[order % folds != k]
        if not len(out) or len(set(y[keep])) < 2:
            continue
        model = QualityModel(*learn(keep), 1.0, 0.0)
        margins[out] = [model.margin(rows[i]) for i in out]
    slope, offset = _logistic(margins, y)
    return QualityModel(*learn(order), slope, offset)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros(N_FEATURES, np.uint8)
    for batch in batches:
        found = [indicators(t, seen).astype(np.int32) for t in byte_texts(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(found, pa.list_(pa.int32()))],
                                         names=["doc_id", "label", "found"])


def held_out(id_col: str = "doc_id"):
    """Whether an id is in the fold that is never learnt from; false for null ids."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
          max_train: int = MAX_TRAIN) -> QualityModel:
    """Fits the model on labelled texts outside the held-out fold.

    Null ids and labels are left out; an id labelled both ways counts as both.  Of an id's texts the least is learnt from.
    Half of the bound is kept for each class, so a rare class is not crowded out.
    """
    marked = (labels.select(F.col(id_col).cast("bigint").alias("id"), (F.col(label_col) > 0).cast("int").alias("label"))
              .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out("id")).distinct())
    order = F.xxhash64(F.lit(17), "id")
    chosen = [r for label in (0, 1)
              for r in marked.filter(F.col("label") == label).orderBy(order, "id").limit(max_train // 2).collect()]
    spark = docs.sparkSession
    picked = spark.createDataFrame([(r["id"], r["label"]) for r in chosen], "id bigint, label int")
    texts = id_and_text(docs, id_col, text_col).join(F.broadcast(picked), F.col("doc_id") == F.col("id"))
    # one text an id, so that repeated ids do not pass the bound
    texts = texts.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    rows = texts.mapInArrow(tidy(_features), "doc_id bigint, label int, found array<int>").toArrow()
    found = [np.asarray(x, np.int32) for x in rows.column("found").to_pylist()]
    ids, y = rows.column("doc_id").to_numpy(), rows.column("label").to_numpy()
    order = sorted(range(len(ids)), key=lambda i: (ids[i], y[i], found[i].tobytes()))
    return fit([found[i] for i in order], y[order])


def _score(model, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, m = np.zeros(N_FEATURES, np.uint8), model.value
        for batch in batches:
            scores = [m.score(m.margin(indicators(t, seen))) for t in byte_texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()),
                 pa.array([int(s >= threshold) for s in scores], pa.int32())], names=["doc_id", "held_out", "score", "predicted"])
    return run


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, max_train: int = MAX_TRAIN,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, score, predicted.

    The score depends on the text alone: null counts as empty, an empty text has no
    indicators and gets the score of the bias, repeated rows get equal scores.  Without labels of both classes the
    model is constant.  An empty table gives no rows; other columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col=id_col, text_col=text_col, max_train=max_train))
    return (id_and_text(docs, id_col, text_col).select("doc_id", held_out().alias("held_out"), "text")
            .mapInArrow(tidy(_score(model, threshold)), "doc_id bigint, held_out boolean, score double, predicted int"))


def _keep(model, threshold: float, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, m = np.zeros(N_FEATURES, np.uint8), model.value
        for batch in batches:
            texts = byte_texts(batch.column(text_at).cast(pa.string()))
            yield batch.filter(pa.array([m.score(m.margin(indicators(t, seen))) >= threshold for t in texts], pa.bool_()))
    return run


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, max_train: int = MAX_TRAIN,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that the classifier accepts."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col=id_col, text_col=text_col, max_train=max_train))
    return docs.mapInArrow(tidy(_keep(model, threshold, docs.columns.index(text_col))), docs.schema)
