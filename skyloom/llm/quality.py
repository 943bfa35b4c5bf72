"""Quality classifier: naive Bayes support vectors (Wang and Manning, 2012)."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skyloom.llm.common import Store
from skyloom.operators.lookup import sized

BUCKETS = 1 << 17
#: Labelled rows that the support vectors are fitted on at most; the log-count ratios use all.
MAX_FIT_ROWS = 8000
#: Bytes of a text that are turned into n-grams at once.
CHUNK = 1 << 22
MIX = np.uint64(0x9E3779B97F4A7C15)


def _bucket(codes: np.ndarray, kind: int) -> np.ndarray:
    return (((codes + np.uint64(kind << 40)) * MIX) >> np.uint64(64 - 17)).astype(np.int32)


def _piece(data: np.ndarray) -> list[np.ndarray]:
    """Buckets of byte trigrams, and of unigrams to trigrams of word shapes, of a stretch of text."""
    codes = data.astype(np.uint64)
    found = [_bucket(codes[:-2] << np.uint64(16) | codes[1:-1] << np.uint64(8) | codes[2:], 1)] if len(data) > 2 else []
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    inside = np.flatnonzero(~blank)
    if not len(inside):
        return found
    first = np.flatnonzero(np.diff(inside, prepend=-2) > 1)
    own = data[inside]
    upper, lower = (own >= 65) & (own <= 90), ((own >= 97) & (own <= 122)) | (own >= 128)
    digit = (own >= 48) & (own <= 57)
    has = lambda mask: np.logical_or.reduceat(mask, first).astype(np.uint64)
    length = np.diff(np.append(first, len(own)))
    # A word equals the one before if its hash does: bytes weighted by their place in the word.
    place = np.arange(len(own)) - np.repeat(first, length)
    words = np.add.reduceat((own.astype(np.uint64) + np.uint64(1)) * (place.astype(np.uint64) * MIX + np.uint64(7919)), first)
    again = np.concatenate([[0], words[1:] == words[:-1]]).astype(np.uint64)
    size = np.digitize(length, [2, 4, 8, 16]).astype(np.uint64)
    shape = again | has(upper) << np.uint64(1) | has(lower) << np.uint64(2) | has(digit) << np.uint64(3) | has(~(upper | lower | digit)) << np.uint64(4) | size << np.uint64(5)
    shape += np.uint64(1)
    found.append(_bucket(shape, 2))
    if len(shape) > 1:
        found.append(_bucket(shape[:-1] << np.uint64(8) | shape[1:], 3))
    if len(shape) > 2:
        found.append(_bucket(shape[:-2] << np.uint64(16) | shape[1:-1] << np.uint64(8) | shape[2:], 4))
    return found


def indicators(text: str | None) -> np.ndarray:
    """Sorted buckets of the n-grams that occur in a text; none for null or empty texts."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    pieces = [np.unique(np.concatenate(p)) for at in range(0, len(data), CHUNK) if (p := _piece(data[at : at + CHUNK + 2]))]
    return np.unique(np.concatenate(pieces)) if pieces else np.empty(0, np.int32)


def log_ratios(labelled: DataFrame, smoothing: float = 1.0) -> np.ndarray:
    """Log-count ratio of each bucket from all labelled rows (text, label 0/1).

    A text counts once for a bucket. Counts are added up within a task, then by Spark; at most ``BUCKETS`` rows reach the
    driver.
    """

    def run(batches):
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for text, label in zip(batch.column("text"), batch.column("label")):
                counts[label.as_py(), indicators(text.as_py())] += 1
        seen = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(counts[0, seen]), pa.array(counts[1, seen])], ["bucket", "bad", "good"])

    counted = labelled.select("text", "label").mapInArrow(run, "bucket int, bad long, good long")
    table = counted.groupBy("bucket").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).toArrow()
    counts = np.full((2, BUCKETS), smoothing)
    for row, name in enumerate(("bad", "good")):
        counts[row, table["bucket"].to_numpy()] += table[name].to_numpy()
    rates = counts / counts.sum(axis=1, keepdims=True)
    return np.log(rates[1] / rates[0]).astype(np.float32)


def dual_descent(rows: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, cost: float, epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """Weights and bias of min |w|^2/2 + cost * sum of hinge losses, by dual coordinate descent (Hsieh et al., 2008)."""
    rng, weights, bias = np.random.default_rng(seed), np.zeros(BUCKETS), 0.0
    alpha, norms = np.zeros(len(rows)), np.array([float(v @ v) + 1.0 for v in values])
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            gradient = labels[i] * (weights[rows[i]] @ values[i] + bias) - 1.0
            step = min(max(alpha[i] - gradient / norms[i], 0.0), cost) - alpha[i]
            if step:
                alpha[i] += step
                weights[rows[i]] += step * labels[i] * values[i]
                bias += step * labels[i]
                moved = max(moved, abs(step))
        if moved < 1e-3 * cost:
            break
    return weights, bias


def sigmoid_fit(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Platt's slope and offset: Newton steps on the log-loss with smoothed targets."""
    good = max(int((labels > 0).sum()), 0)
    target = np.where(labels > 0, (good + 1) / (good + 2), 1 / (len(labels) - good + 2))
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -30, 30)))
        error, weight = p - target, np.maximum(p * (1 - p), 1e-9)
        gradient = np.array([error @ margins + 1e-3 * slope, error.sum()])
        hessian = np.array([[weight @ margins**2 + 1e-3, weight @ margins], [weight @ margins, weight.sum() + 1e-9]])
        step = np.linalg.solve(hessian, gradient)
        slope, offset = slope - step[0], offset - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(slope), float(offset)


def scaled(row: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """Indicators scaled by their ratios, brought to length one so that long texts do not outweigh short ones."""
    values = ratios[row].astype(np.float64)
    return values / (np.sqrt(values @ values) or 1.0)


class Model:
    def __init__(self, ratios: np.ndarray, weights: np.ndarray, bias: float, slope: float, offset: float):
        self.ratios, self.weights, self.bias, self.slope, self.offset = ratios, weights.astype(np.float32), bias, slope, offset

    def score(self, text: str | None) -> float:
        row = indicators(text)
        margin = float(self.weights[row] @ scaled(row, self.ratios)) + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30))))


def train(labelled: DataFrame, cost: float = 1.0, epochs: int = 20, mix: float = 0.9, max_fit_rows: int = MAX_FIT_ROWS, seed: int = 11) -> Model:
    """Fit on rows (doc_id, text, label): ratios on all rows, support vectors on at most ``max_fit_rows`` of them.

    Those rows are drawn by a hash of id and text; their texts become bucket numbers, at most ``BUCKETS`` a row, before one
    task fits them. The weights are ``mix`` of the fitted ones and the rest their mean size, as the method has it. Null labels are left out; with one
    label only, or none, every text scores that label's share, or 1/2.
    """
    store = Store(labelled.sparkSession)
    labelled = labelled.where("label is not null").select("doc_id", "text", F.col("label").cast("int").alias("label"))
    count = labelled.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("good")).first()
    n, good = count["n"], count["good"] or 0
    if not n or good in (0, n):
        share = good / n if n else 0.5
        return Model(np.zeros(BUCKETS, np.float32), np.zeros(BUCKETS), 0.0, 0.0, float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    ratios = log_ratios(labelled)
    shared = labelled.sparkSession.sparkContext.broadcast(ratios)
    drawn = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")), F.lit(1 << 30))
    draw = drawn < int(min(1.0, max_fit_rows / n) * (1 << 30))

    def encode(batches):
        for batch in batches:
            rows = [indicators(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array([r.tobytes() for r in rows], pa.binary())], ["label", "buckets"])

    def fit(frames):
        held = pd.concat(list(frames))
        ratios, rows = shared.value, [np.frombuffer(b, np.int32) for b in held["buckets"]]
        labels = np.where(held["label"].to_numpy() == 1, 1.0, -1.0)
        values = [scaled(r, ratios) for r in rows]
        weights, bias = dual_descent(rows, values, labels, cost, epochs, seed)
        weights = (1 - mix) * np.abs(weights).mean() + mix * weights
        margins = np.array([weights[r] @ v + bias for r, v in zip(rows, values)])
        slope, offset = sigmoid_fit(margins, labels)
        yield pd.DataFrame({"weights": [weights.astype(np.float32).tobytes()], "bias": [bias], "slope": [slope], "offset": [offset]})

    # The rows of least hash, whatever the partitioning: a rerun fits the same rows.
    kept = labelled.where(draw).withColumn("__h", drawn).orderBy("__h", "doc_id", "label", "text").limit(max_fit_rows)
    sample = kept.select("label", "text").mapInArrow(encode, "label int, buckets binary")
    fitted = store.keep(sample).repartition(1).mapInPandas(fit, "weights binary, bias double, slope double, offset double").first()
    return Model(ratios, np.frombuffer(fitted["weights"], np.float32), fitted["bias"], fitted["slope"], fitted["offset"])


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, label) for each labelled document; the labels are broadcast when they are measured to be small."""
    own = sized(labels.where("doc_id is not null and label is not null").select("doc_id", "label"))
    return docs.select("doc_id", "text").join(own, "doc_id")


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """One row per document: doc_id, score (0 to 1, higher: label 1 likelier), predicted (1 from ``threshold`` on).

    Null and empty texts have no n-gram and get the score of the bias. Texts are read whole; repeated rows and null ids stay;
    other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = [shared.value.score(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
