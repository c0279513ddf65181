"""Quality classification by naive Bayes support vectors.

Features are indicators of hashed n-grams: bytes (2 to 4), words by their shape, and pairs of words in which an
equal word is written as a back-reference, so that stuttering shows whatever the word is. Each indicator is scaled by
its log-count ratio between the classes; a linear hinge-loss model on the scaled indicators (each row of length one) is fitted by dual
coordinate descent; margins become probabilities by a logistic fit on rows held back from the descent.

The classifier is fitted on at most `per_class` labelled documents a class, picked by a hash of their id, those of at
most `longest` characters among them: a documented bound. Their features are taken on the executors, from whole texts; every document is scored by its whole text.

Defined results: null and empty texts have no features and get the model's bias; with fewer than two classes to learn
from every score is the share of label 1, or 0.5 if nothing is labelled; null labels are left out; of a document labelled
twice each distinct label counts; repeated rows are scored alike; ids may be of any type; extra columns, whatever their
names, are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import slices, utf8, word_hashes, words

BITS = 18
SHAPE = np.zeros(256, np.uint8)
SHAPE[ord("a") : ord("z") + 1] = 1
SHAPE[ord("A") : ord("Z") + 1] = 2
SHAPE[ord("0") : ord("9") + 1] = 3
SHAPE[128:] = 1
for _c in range(33, 127):
    if not SHAPE[_c]:
        SHAPE[_c] = _c


def bucket(x: np.ndarray) -> np.ndarray:
    return ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64)


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers row by row, and n + 1 offsets into them."""
    rows = len(off) - 1
    value, grams = data.astype(np.uint64), []
    gram = value
    for n in (2, 3, 4):
        gram = gram[:-1] * np.uint64(257) + value[n - 1 :] + np.uint64(1) if len(value) >= n else gram[:0]
        grams.append((n, bucket(gram * np.uint64(8) + np.uint64(n))))
    start, end, at = words(data, off)
    single = pair = np.zeros(0, np.int64)
    if len(start):
        shape = SHAPE[data]
        squeezed = np.ones(len(data), bool)
        squeezed[1:] = shape[1:] != shape[:-1]
        squeezed[start] = True
        # a word's shape without repeats: hash of the first of each run of equal shapes
        kept = np.flatnonzero(squeezed)
        place = np.cumsum(squeezed) - squeezed
        short, begin = shape[kept], place[start]
        shapes = word_hashes(short, begin, np.maximum(place[end - 1] + squeezed[end - 1], begin + 1))
        hashes = word_hashes(data, start, end)
        second = np.where(hashes[1:] == hashes[:-1], np.uint64(1), shapes[1:])
        single, pair = bucket(shapes + np.uint64(11)), bucket(shapes[:-1] * np.uint64(3) + second)
    present, found = np.zeros(1 << BITS, bool), []
    for s, e, i, j in zip(off[:-1].tolist(), off[1:].tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
        for n, own in grams:
            if e - s >= n:
                present[own[s : e - n + 1]] = True
        if j > i:
            present[single[i:j]] = True
            present[pair[i : j - 1]] = True
        found.append(own := np.flatnonzero(present))
        present[own] = False
    return np.concatenate([np.zeros(0, np.int64), *found]), np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)


class Model:
    """score = logistic(slope * (bias + sum of weights / sqrt(sum of squares)) + shift), over a row's features."""

    def __init__(self, rows: list[np.ndarray], y: np.ndarray, rounds: int = 12, cost: float = 1.0, smooth: float = 1.0, seed: int = 7):
        self.weight, self.square = np.zeros(1 << BITS, np.float32), np.zeros(1 << BITS, np.float32)
        self.bias, self.slope = 0.0, 1.0
        share = float(y.mean()) if len(y) else 0.5
        if not len(y) or share in (0.0, 1.0):
            self.slope, self.shift = 0.0, float(np.log((share + 1e-3) / (1 - share + 1e-3)))
            return
        rng = np.random.default_rng(seed)
        back = np.zeros(len(y), bool)  # a fifth of each class is held back, for the logistic fit
        for c in (0, 1):
            back[np.flatnonzero(y == c)[::5]] = True
        counts = []
        for c in (1, 0):
            own = [rows[i] for i in np.flatnonzero((y == c) & ~back)]
            n = np.bincount(np.concatenate([*own, np.zeros(0, np.int64)]).astype(np.int64), minlength=1 << BITS) + smooth
            counts.append(n / (len(own) + 2 * smooth))
        ratio = np.log(counts[0] / counts[1])
        self.square = (ratio**2).astype(np.float32)
        norms = np.array([max(1e-9, float(np.sqrt((ratio[r] ** 2).sum()))) for r in rows])
        w, b, sign = np.zeros(1 << BITS), 0.0, np.where(y == 1, 1.0, -1.0)
        part = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) * cost  # classes weigh the same
        alpha, fit = np.zeros(len(y)), np.flatnonzero(~back)
        for _ in range(rounds):
            for i in rng.permutation(fit):
                r = rows[i]
                x = ratio[r] / norms[i]
                q = 2.0 if len(r) else 1.0  # |x|^2 is 1, and the bias's feature is 1
                g = sign[i] * (w[r] @ x + b) - 1
                new = min(max(alpha[i] - g / q, 0.0), part[i])
                if (step := (new - alpha[i]) * sign[i]) != 0:
                    w[r] += step * x
                    b += step
                    alpha[i] = new
        self.weight, self.bias, self.shift = (w * ratio).astype(np.float32), float(b), 0.0
        margin = np.array([self.margin_of(rows[i]) for i in np.flatnonzero(back)])
        self.slope, self.shift = logistic(margin, y[back], np.where(y[back] == 1, 0.5 / share, 0.5 / (1 - share)))

    def margin_of(self, r: np.ndarray) -> float:
        return self.bias + float(self.weight[r].sum()) / max(1e-9, float(np.sqrt(self.square[r].sum())))

    def scores(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        found, at = features(data, off)
        w = np.concatenate([[0.0], np.cumsum(self.weight[found], dtype=np.float64)])
        q = np.concatenate([[0.0], np.cumsum(self.square[found], dtype=np.float64)])
        margin = self.bias + (w[at[1:]] - w[at[:-1]]) / np.sqrt(np.maximum(q[at[1:]] - q[at[:-1]], 1e-18))
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of a weighted logistic fit by Newton's method, with targets drawn in a little."""
    up, down = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g, h = weight * (p - target), weight * p * (1 - p) + 1e-9
        haa, hab, hbb = (h * x * x).sum() + 1e-6, (h * x).sum(), h.sum() + 1e-6
        ga, gb = (g * x).sum() + 1e-6 * a, g.sum()
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        size = max(1.0, abs(da) / 5, abs(db) / 5)
        a, b = a - da / size, b - db / size
    return float(max(a, 1e-3)), float(b)


def sampled_ids(labels: DataFrame, label: str, per_class: int, key: str = "doc_id") -> DataFrame:
    """At most per_class distinct ids of each of the labels 0 and 1, by a hash of the id."""
    own = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("__id"), F.col(label).cast("int").alias("__y")).distinct()
    rank = F.row_number().over(Window.partitionBy("__y").orderBy(F.xxhash64(F.col("__id").cast("string")), "__id"))
    return own.withColumn("__r", rank).where(F.col("__r") <= per_class).drop("__r")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = 1500, longest: int = 100_000, key: str = "doc_id", text: str = "text") -> Model:
    """docs and labels: what may be learnt from. The ids, two times per_class at most, are broadcast."""
    picked = docs.join(F.broadcast(sampled_ids(labels, label, per_class, key)), docs[key] == F.col("__id")).where(F.length(text) <= longest).select(F.col("__id").cast("string"), "__y", F.col(text).alias("__text"))

    def run(batches):
        for batch in batches:
            data, off = utf8(batch, 2)
            for a, b in slices(off):
                found, at = features(data[off[a] : off[b]], off[a : b + 1] - off[a])
                lists = [found[s:e].astype(np.int32).tobytes() for s, e in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(lists, pa.binary())], ["id", "y", "found"])

    rows = sorted((r["id"], r["y"], bytes(r["found"])) for r in picked.mapInArrow(run, "id string, y int, found binary").toLocalIterator())
    return Model([np.frombuffer(f, np.int32) for _, _, f in rows], np.array([y for _, y, _ in rows], np.int64))


def score(docs: DataFrame, model, keep: list[Column | str], threshold: float, text: str = "text") -> DataFrame:
    """Columns keep, then score and predicted (1 from the threshold on). model: has scores(data, offsets)."""
    frame = docs.select(*keep, F.col(text).alias("__text"))
    names = frame.columns[:-1]
    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields[:-1]), "score double, predicted int"])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size

    def run(batches):
        own = shared.value
        for batch in batches:
            data, off = utf8(batch, len(names))
            got = np.concatenate([np.zeros(0), *(own.scores(data[off[a] : off[b]], off[a : b + 1] - off[a]) for a, b in slices(off))])
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(got, pa.float64()), pa.array((got >= threshold).astype(np.int32))], [*names, "score", "predicted"])

    return frame.mapInArrow(run, fields)
