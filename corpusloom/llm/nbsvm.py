"""Quality classifier: Naive Bayes support vectors.

Indicators of n-grams, over bytes (2 to 4), words (1 and 2) and word forms (1 to 4), are scaled by the log ratio of their
class counts; a linear hinge-loss model on the scaled indicators is fitted by dual coordinate descent. A word's form
tells its case, its trailing symbol and whether it repeats the word before. Indicators are hashed into a fixed
number of columns, so the model's size does not grow with the corpus. Margins become probabilities by a logistic
curve fitted on margins of folds that the model had not seen.

Null texts are empty; an empty text gets the score of the bias alone; without two classes of labels every score is
the share of label 1. Texts of any length are scored whole, repeated rows and equal texts alike; an empty table gives an
empty result; other columns pass through, but those named as a result column (in any case) are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.arrow import slices, texts, wider, without
from corpusloom.llm.training import class_shares, held_out, labelled_sample

BITS = 16
COLUMNS = 5 << BITS
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_CASE = np.full(256, 3, dtype=np.uint8)  # 0 lower, 1 upper, 2 digit, 3 other
_CASE[97:123] = 0
_CASE[128:] = 0
_CASE[65:91] = 1
_CASE[48:58] = 2
_TAIL = np.zeros(256, dtype=np.uint8)  # the last byte of a word
for _i, _chars in enumerate((b".,;:?", b"!", b"#$%&*<>|", b")]}'\""), 1):
    _TAIL[list(_chars)] = _i
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: A number for each byte, the same for both cases of a letter and zero for white space.
_MIXED = (np.arange(1, 257, dtype=np.uint32) * np.uint32(2654435761)) ^ np.uint32(0x5BD1E995)
_MIXED[65:91] = _MIXED[97:123]
_MIXED[_SPACE] = 0


def word_forms(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word of UTF-8 bytes a small number (case of its first two bytes, kind of its last, equal to the word before) and a hash of it in lower case."""
    space = _SPACE[b]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]])))
    start, end = edge[::2], edge[1::2] - 1
    if not len(start):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
    length = end - start + 1
    second = _CASE[b[np.minimum(start + 1, end)]]
    # words are taken as equal if their lengths and the sums of a mix of each two neighbouring bytes are
    mix = _MIXED[b]
    mix[:-1] += (mix[1:] >> np.uint32(7)) * mix[:-1]
    mixed = np.add.reduceat(mix, start)
    same = np.zeros(len(start), dtype=np.uint64)
    same[1:] = (mixed[1:] == mixed[:-1]) & (length[1:] == length[:-1])
    return ((_CASE[b[start]].astype(np.uint64) * 4 + second) * 5 + _TAIL[b[end]]) * 2 + same, mixed.astype(np.uint64) << np.uint64(16) | length.astype(np.uint64) & np.uint64(0xFFFF)


def indicators(text: bytes) -> np.ndarray:
    """Distinct columns of a text's n-grams."""
    b = np.frombuffer(text, dtype=np.uint8)
    out = []
    wide = b.astype(np.uint32)
    shift = np.uint32(32 - BITS)
    gram = wide
    for n in (2, 3, 4):
        if len(b) < n:
            break
        gram = gram[:-1] << np.uint32(8) | wide[n - 1 :]
        out.append((gram * np.uint32(2654435761 + 2 * n) >> shift) + np.uint32((n - 2) << BITS))
    forms, words = word_forms(b)
    code = np.zeros(len(words), dtype=np.uint64)
    for n in (1, 2):
        if len(words) < n:
            break
        code = (code[: len(words) - n + 1] + words[n - 1 :]) * _ODD
        out.append((code >> np.uint64(64 - BITS)).astype(np.uint32) + np.uint32(4 << BITS))
    code = np.zeros(len(forms), dtype=np.uint64)
    for n in (1, 2, 3, 4):
        if len(forms) < n:
            break
        code = code[: len(forms) - n + 1] * np.uint64(211) + forms[n - 1 :] + np.uint64(1)
        out.append(((code * _ODD) >> np.uint64(64 - BITS)).astype(np.uint32) + np.uint32(3 << BITS))
    if not out:
        return np.zeros(0, dtype=np.int64)
    every = np.concatenate(out)
    every.sort()
    return every[np.concatenate([[True], every[1:] != every[:-1]])].astype(np.int64)


def dual_coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: np.ndarray, epochs: int = 30, tolerance: float = 1e-3, seed: int = 1) -> tuple[np.ndarray, float]:
    """Weights and bias of the L1-loss linear support vector machine over sparse rows (columns, values)."""
    w, bias, alpha = np.zeros(COLUMNS, dtype=np.float64), 0.0, np.zeros(len(rows))
    norm = np.array([float(v @ v) + 1.0 for _, v in rows])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            columns, values = rows[i]
            gradient = y[i] * (float(w[columns] @ values) + bias) - 1
            projected = min(gradient, 0) if alpha[i] <= 0 else max(gradient, 0) if alpha[i] >= cost[i] else gradient
            worst = max(worst, abs(projected))
            if projected:
                new = min(max(alpha[i] - gradient / norm[i], 0), cost[i])
                step = (new - alpha[i]) * y[i]
                alpha[i] = new
                w[columns] += step * values
                bias += step
        if worst < tolerance:
            break
    return w, bias


def logistic_curve(margins: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """slope, intercept of P(1 | margin), by Newton steps with smoothed targets."""
    pos, neg = weight[y > 0].sum(), weight[y <= 0].sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g, h = weight * (p - target), np.maximum(weight * p * (1 - p), 1e-9)
        grad = np.array([g @ margins + 1e-3 * a, g.sum()])
        hess = np.array([[h @ margins**2 + 1e-3, h @ margins], [h @ margins, h.sum() + 1e-6]])
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return max(a, 1e-3), b


@dataclass
class Model:
    weights: np.ndarray  # ratio times support-vector weight, of each column
    squares: np.ndarray  # of the ratios: a row's length
    bias: float
    slope: float
    intercept: float

    def score(self, text: bytes) -> float:
        at = indicators(text)
        length = float(self.squares[at].sum()) ** 0.5 or 1.0
        z = self.slope * (float(self.weights[at].sum()) / length + self.bias) + self.intercept
        return float(1 / (1 + np.exp(-min(max(z, -30.0), 30.0))))


def fit(sample: list[tuple[bytes, int]], share: float, cost: float = 0.1, smoothing: float = 1.0, folds: int = 4) -> Model:
    """``share``: of label 1 among all labelled rows; weighs the balanced sample back for the curve."""
    y = np.array([1 if q else -1 for _, q in sample])
    if len(set(y.tolist())) < 2:
        share = min(max(share, 1e-3), 1 - 1e-3)
        return Model(np.zeros(COLUMNS, dtype=np.float32), np.zeros(COLUMNS, dtype=np.float32), 0.0, 1.0, float(np.log(share / (1 - share))))
    features = [indicators(t) for t, _ in sample]

    def train(use: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        p, q = np.full(COLUMNS, smoothing), np.full(COLUMNS, smoothing)
        for i in use:
            (p if y[i] > 0 else q)[features[i]] += 1
        ratio = np.log(p / (smoothing + (y[use] > 0).sum())) - np.log(q / (smoothing + (y[use] < 0).sum()))
        rows = []
        for i in use:
            v = ratio[features[i]]
            rows.append((features[i], v / (np.sqrt(float(v @ v)) or 1.0)))
        n = (y[use] > 0).sum(), (y[use] < 0).sum()
        balance = np.where(y[use] > 0, len(use) / (2 * n[0]), len(use) / (2 * n[1]))
        w, bias = dual_coordinate_descent(rows, y[use], 10 * cost * balance)
        return w * ratio, ratio * ratio, bias

    def margin(w: np.ndarray, squares: np.ndarray, bias: float, i: int) -> float:
        return float(w[features[i]].sum()) / (float(squares[features[i]].sum()) ** 0.5 or 1.0) + bias

    fold = np.arange(len(y)) % folds
    margins = np.zeros(len(y))
    for k in range(folds):
        use = np.flatnonzero(fold != k)
        if len(set(y[use].tolist())) < 2:
            use = np.arange(len(y))
        fitted = train(use)
        for i in np.flatnonzero(fold == k):
            margins[i] = margin(*fitted, i)
    w, squares, bias = train(np.arange(len(y)))
    weight = np.where(y > 0, share / max((y > 0).mean(), 1e-9), (1 - share) / max((y < 0).mean(), 1e-9))
    slope, intercept = logistic_curve(margins, y, weight)
    return Model(w.astype(np.float32), squares.astype(np.float32), bias, slope, intercept)


def score_quality(docs: DataFrame, labels: DataFrame, modulus: int = 4, remainder: int = 2, most: int = 3000, most_chars: int = 20_000, threshold: float = 0.7) -> DataFrame:
    """doc_id, text, held_out, score, predicted, one row for each row of ``docs``; one pass without a shuffle.

    The model is fitted on at most ``most`` labelled rows outside the fold ``modulus``/``remainder``; see
    ``labelled_sample``. Its five hashed blocks of columns take 1.3 MB, whatever the corpus.
    """
    sample = labelled_sample(docs, labels, "quality", modulus, remainder, most, most_chars).collect()
    sample.sort(key=lambda r: (r.doc_id, r.text))
    rng = np.random.default_rng(3)
    sample = [sample[i] for i in rng.permutation(len(sample))]
    model = fit([(r.text.encode(), r.label) for r in sample], class_shares(labels, "quality", modulus, remainder))

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for part in slices(batch, at):
                scores = pa.array([model.score(t) for t in texts(part.column(at))], type=pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, scores], names=[*part.schema.names, "score"])

    kept = without(docs, "held_out", "score", "predicted").withColumn("held_out", held_out(modulus, remainder))
    scored = kept.mapInArrow(run, wider(kept, "score double"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
