"""Toxicity by subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (3 to 5 bytes, with word borders) and itself; its vector is the mean of their
embeddings, and a linear softmax scores it. Unseen misspellings share most n-grams with what was seen. A text's label
says only that some of its words are toxic, and a few words wash out in the average of a whole text or of a window (the
README gives held-out figures of both), so a text is as toxic as its most toxic word: training picks, in each
round, the words of a toxic text that the model holds likeliest (at first those with the highest log-odds between the
classes) against all words of the other texts, and a logistic fit on held back texts turns the text's top margin into
a probability.

The classifier is fitted on at most `per_class` labelled documents a class, picked by a hash of their id, those of at
most `longest` characters among them: a documented bound. All texts are scored whole. As the softmax is linear, each n-gram's part of the margin is tabled once.

Defined results: null and empty texts have no words and get the lowest margin; with fewer than two classes to learn
from every score is the share of label 1, or 0.5 if nothing is labelled; null labels are left out; extra columns,
whatever their names, are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import mix, trimmed, word_hashes
from quire.llm.nbsvm import logistic, sampled_ids

BITS, DIM = 18, 16
NO_WORD = -20.0


def bags(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of each word's n-grams and of the word, word by word, and n + 1 offsets."""
    # words with a border byte on each side, one after another
    size = end - start + 2
    first = np.concatenate([[0], np.cumsum(size)])
    padded = np.full(int(first[-1]), 1, np.uint8)
    inner = np.arange(int((end - start).sum())) - np.repeat(np.concatenate([[0], np.cumsum(end - start)])[:-1], end - start)
    padded[np.repeat(first[:-1] + 1, end - start) + inner] = low[np.repeat(start, end - start) + inner]
    owner = np.repeat(np.arange(len(start)), size)
    value = padded.astype(np.uint64)
    keys, owners = [mix(word_hashes(padded, first[:-1], first[1:]))], [np.arange(len(start))]
    gram = value.copy()
    for n in range(2, 6):
        gram = gram[:-1] * np.uint64(257) + value[n - 1 :] if len(value) >= n else gram[:0]
        if n >= 3:
            inside = owner[: len(gram)] == owner[n - 1 : n - 1 + len(gram)]
            keys.append(mix(gram[inside] * np.uint64(8) + np.uint64(n)))
            owners.append(owner[: len(gram)][inside])
    key, own = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(own, kind="stable")
    return (key[order] & np.uint64((1 << BITS) - 1)).astype(np.int64), np.searchsorted(own[order], np.arange(len(start) + 1))


class Model:
    def __init__(self, texts: list[bytes], y: np.ndarray, epochs: int = 4, rate: float = 0.5, seed: int = 11):
        self.margins = np.zeros(1 << BITS, np.float32)  # each n-gram's part of the log-odds
        self.bias, self.slope = 0.0, 1.0
        share = float(y.mean()) if len(y) else 0.5
        if not len(y) or share in (0.0, 1.0):
            self.slope, self.shift = 0.0, float(np.log((share + 1e-3) / (1 - share + 1e-3)))
            return
        rng = np.random.default_rng(seed)
        data = np.frombuffer(b"".join(texts), np.uint8)
        off = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        low, start, end, at = trimmed(data, off)
        text = np.repeat(np.arange(len(texts)), np.diff(at))
        ids = word_hashes(low, start, end)
        _, first, word = np.unique(ids, return_index=True, return_inverse=True)
        grams, edge = bags(low, start[first], end[first])  # of distinct words
        seen = np.unique(text.astype(np.int64) * len(first) + word)
        text, word = seen // len(first), seen % len(first)  # a word once a text
        back = np.zeros(len(y), bool)
        for c in (0, 1):
            back[np.flatnonzero(y == c)[::5]] = True
        fit = ~back[text]
        toxic = y[text] == 1
        n1 = np.bincount(word[fit & toxic], minlength=len(first)).astype(float)
        n0 = np.bincount(word[fit & ~toxic], minlength=len(first)).astype(float)
        texts1, texts0 = max(1, (y[~back] == 1).sum()), max(1, (y[~back] == 0).sum())
        # at first a word's log-odds are the mean over its n-grams of theirs, so rare words lean on their parts
        size = np.diff(edge)
        own = np.repeat(np.arange(len(first)), size)
        g1 = np.bincount(grams, weights=n1[own], minlength=1 << BITS)
        g0 = np.bincount(grams, weights=n0[own], minlength=1 << BITS)
        odds = np.log((g1 + 0.5) / texts1) - np.log((g0 + 0.5) / texts0)
        margin = np.bincount(own, weights=odds[grams], minlength=len(first)) / size
        margin += np.log((n1 + 0.5) / texts1) - np.log((n0 + 0.5) / texts0)
        vectors = rng.normal(0, 1 / DIM, (1 << BITS, DIM)).astype(np.float32)
        soft, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
        negative = np.flatnonzero(n0 > 0)
        weight0 = np.log1p(n0[negative])
        for epoch in range(epochs):
            picked = fit & toxic
            top = np.full(len(texts), -np.inf)
            np.maximum.at(top, text[picked], margin[word[picked]])
            chosen = word[picked][margin[word[picked]] >= np.maximum(top[text[picked]] - 0.5, 0)]
            positive, times = np.unique(chosen[n0[chosen] <= 0.02 * texts0 * np.maximum(1, n1[chosen] / texts1)], return_counts=True)
            if not len(positive):
                break
            weight1 = np.log1p(times)
            x = np.concatenate([positive, negative])
            target = np.concatenate([np.ones(len(positive), int), np.zeros(len(negative), int)])
            chance = np.concatenate([0.5 * weight1 / weight1.sum(), 0.5 * weight0 / weight0.sum()])
            for step in range(400):
                lr = rate * (1 - (epoch * 400 + step) / (epochs * 400))
                batch = rng.choice(len(x), 256, p=chance)
                w = x[batch]
                n = size[w]
                flat = np.arange(n.sum()) + np.repeat(edge[w] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
                g = grams[flat]
                who = np.repeat(np.arange(256), n)
                h = np.add.reduceat(vectors[g], np.concatenate([[0], np.cumsum(n)[:-1]]), axis=0) / n[:, None]
                z = h @ soft + bias
                z -= z.max(1, keepdims=True)
                p = np.exp(z)
                p /= p.sum(1, keepdims=True)
                p[np.arange(256), target[batch]] -= 1
                back_h = p @ soft.T
                soft -= lr * (h.T @ p) / 16
                bias -= lr * p.mean(0)
                np.add.at(vectors, g, -lr * (back_h / n[:, None])[who].astype(np.float32) * 4)
            self.margins = (vectors @ (soft[:, 1] - soft[:, 0])).astype(np.float32)
            self.bias = float(bias[1] - bias[0])
            margin = np.bincount(own, weights=self.margins[grams].astype(float), minlength=len(first)) / size + self.bias
        self.shift = 0.0
        top = np.full(len(texts), NO_WORD)
        np.maximum.at(top, text, margin[word])
        self.slope, self.shift = logistic(top[back], y[back], np.ones(int(back.sum())))

    def scores(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        low, start, end, at = trimmed(data, off)
        top = np.full(len(off) - 1, NO_WORD)
        if len(start):
            ids = word_hashes(low, start, end)
            _, first, word = np.unique(ids, return_index=True, return_inverse=True)
            grams, edge = bags(low, start[first], end[first])
            sums = np.add.reduceat(self.margins[grams].astype(np.float64), edge[:-1])
            margin = (sums / np.diff(edge) + self.bias)[word]
            full = at[:-1] < at[1:]
            top[full] = np.maximum.reduceat(margin, at[:-1][full])
        return 1 / (1 + np.exp(-np.clip(self.slope * top + self.shift, -500, 500)))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = 1500, longest: int = 20_000, key: str = "doc_id", text: str = "text") -> Model:
    """docs and labels: what may be learnt from; of the sampled texts those of at most `longest` characters, whole."""
    picked = docs.join(F.broadcast(sampled_ids(labels, label, per_class, key)), docs[key] == F.col("__id")).where(F.length(text) <= longest)
    rows = sorted((r["__id"], r["__y"], r["__text"].encode()) for r in picked.select("__id", "__y", F.col(text).alias("__text")).toLocalIterator())
    return Model([t for _, _, t in rows], np.array([y for _, y, _ in rows], np.int64))
