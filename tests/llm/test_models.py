"""Classifiers: held-out accuracy, properties of the models, defined results at the edges."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import nbsvm, ppm, subword
from quire.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, score double, predicted int, lang_pred string"


def bytes_of(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64)


def naive_ppm(texts, order):
    """Probability of a byte after some bytes, by dicts, escapes and exclusion as they are defined."""
    seen = {}
    for t in texts:
        for i in range(len(t)):
            for k in range(min(i, order) + 1):
                at = seen.setdefault(t[i - k : i], {})
                at[t[i]] = at.get(t[i], 0) + 1

    def chance(before, byte):
        if len(before) > order:
            before = before[-order:] if order else b""
        own = seen.get(before)
        shorter = lambda c: chance(before[1:], c) if before else 1 / 256
        if own is None:
            return shorter(byte)
        n, d = sum(own.values()), len(own)
        if byte in own:
            return own[byte] / (n + d)
        return d / (n + d) * shorter(byte) / (1 - sum(shorter(c) for c in own))

    return chance


@pytest.mark.parametrize("order", [0, 2, 4])
def test_ppm_code_lengths_are_those_of_a_naive_version(order):
    rng = random.Random(4)
    own = {lang: ["".join(rng.choice(chars) for _ in range(rng.randint(1, 60))).encode() for _ in range(8)] for lang, chars in (("x", "abcab "), ("y", "abzé "), ("w", "b"))}
    model = ppm.Model(own, order)
    texts = ["", "a", "abcabcab", "zzz b\x00a", "é a b", "qqqqabcabqqq", "bbbbbbbbb"] + ["".join(rng.choice("abcé z") for _ in range(30)) for _ in range(20)]
    data, off = bytes_of(texts)
    got = model.code_lengths(data, off)
    for j, lang in enumerate(model.langs):
        chance = naive_ppm(own[lang], order)
        assert abs(sum(chance(b"ab", c) for c in range(256)) - 1) < 1e-9
        for i, t in enumerate(texts):
            raw = t.encode()
            assert got[i, j] == pytest.approx(-sum(np.log2(chance(raw[:k], c)) for k, c in enumerate(raw)), abs=1e-3)


def test_ppm_of_a_long_text_in_pieces(monkeypatch):
    rng = random.Random(5)
    model = ppm.Model({"x": [b"abracadabra abracadabra"], "y": [b"zzzz yyyy"]})
    data, off = bytes_of(["ab", "".join(rng.choice("abrz cd") for _ in range(40_000)), "", "zz"])
    whole = model.code_lengths(data, off)
    monkeypatch.setattr(ppm, "PIECE", 1 << 12)
    assert np.allclose(model.code_lengths(data, off), whole)
    assert ppm.Model({"x": [b"abracadabra abracadabra"]}, 4, most_values=40).order < 4


def test_ppm_edges(spark):
    rows = [(1, None, "en", "s"), (2, "", "en", "s"), (3, "123 !?", "en", "s"), (4, "hello there world", "en", "s"), (5, "guten tag welt", "de", "s"), (None, "hello world", None, "s"), (4, "hello there world", "en", "s"), (9, "hello there " * 30_000, None, "s")]
    docs = spark.createDataFrame([(*r, 9.0, 9, "zz") for r in rows], SCHEMA)
    model = ppm.Model(ppm.sample(docs))
    got = ppm.identify(docs, model, ["doc_id"]).collect()
    assert sorted((r.doc_id or 0, r.lang_pred) for r in got) == [(0, "en"), (1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (5, "de"), (9, "en")]
    assert all(0 <= r.score <= 1 for r in got) and all(r.score == 0 for r in got if r.lang_pred == "und")
    untaught = ppm.Model(ppm.sample(docs.where("false")))
    assert {(r.lang_pred, r.score) for r in ppm.identify(docs, untaught, ["doc_id"]).collect()} == {("und", 0.0)}
    assert ppm.identify(docs.where("false"), model, ["doc_id"]).count() == 0


def test_ppm_held_out(spark):
    own = QUERIES["op6_ppm"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text"), "doc_id")
    r = own.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("a"), F.count("*").alias("n")).first()
    assert r.n > 100 and r.a > 0.97
    assert own.count() == 1000


@pytest.mark.parametrize(("name", "label", "least"), [("op2_nbsvm", "quality", 0.95), ("op4_subword", "toxic", 0.9)])
def test_held_out(spark, name, label, least):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    own = QUERIES[name](spark, SF)
    assert own.count() == docs.count() and own.where("score < 0 or score > 1 or score is null").count() == 0
    r = own.join(labels, "doc_id").where("held_out").groupBy(label).agg(F.avg((F.col("predicted") == F.col(label)).cast("int")).alias("a")).collect()
    assert len(r) == 2 and sum(x.a for x in r) / 2 > least - 0.1 and own.join(labels, "doc_id").where("held_out").agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0] > least


@pytest.mark.parametrize("module", [nbsvm, subword])
def test_classifier_edges(spark, module):
    rng = random.Random(1)
    good = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(20)) for _ in range(60)]
    bad = [" ".join(rng.choice(["alpha", "beta", "grrr", "delta", "grrrr"]) for _ in range(20)) for _ in range(60)]
    rows = [(i, t, "en", "s", 1.0, 1, "x") for i, t in enumerate(good + bad)] + [(500, None, None, None, None, None, None), (501, "", "en", "s", 1.0, 1, "x"), (None, "grrr", "en", "s", 1.0, 1, "x"), (502, "a" * 200_000, "en", "s", 1.0, 1, "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, int(i >= 60)) for i in range(120)] + [(500, 1), (501, 0), (None, 1), (7, None), (3, 0), (3, 0)], "doc_id long, label int")
    model = module.train(docs, labels, "label")
    got = {r.doc_id: r for r in nbsvm.score(docs, model, ["doc_id"], 0.5).collect()}
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert np.mean([got[i].predicted == (i >= 60) for i in range(120)]) > 0.95
    for some in (labels.where("false"), labels.where("label = 1")):
        flat = {r.score for r in nbsvm.score(docs, module.train(docs, some, "label"), ["doc_id"], 0.5).collect()}
        assert len(flat) == 1 and 0 <= flat.pop() <= 1
    assert nbsvm.score(docs.where("false"), model, ["doc_id"], 0.5).count() == 0


def test_unseen_misspellings_share_ngrams(spark):
    rng = random.Random(3)
    vocab = ["".join(rng.choice("abcdefghijklm") for _ in range(6)) for _ in range(400)]
    texts, y = [], []
    for i in range(400):
        w = [rng.choice(vocab) for _ in range(40)]
        if i % 2:
            w[rng.randrange(40)] = rng.choice(["zorgwix", "zorgwixx", "zorgwick"])
        texts.append(" ".join(w).encode())
        y.append(i % 2)
    model = subword.Model(texts, np.array(y))
    data, off = bytes_of([" ".join([*vocab[:30], "zorgwixy", *vocab[30:60]]), " ".join(vocab[:60])])
    toxic, clean = model.scores(data, off)
    assert toxic > 0.5 > clean


M64 = (1 << 64) - 1


def naive_mix(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & M64
    x = (x ^ x >> 27) * 0x94D049BB133111EB & M64
    return x ^ x >> 31


def naive_word_hash(raw):
    return naive_mix((sum((b + 1) * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, b in enumerate(raw)) + len(raw)) & M64)


def naive_subword_score(model, text):
    """Each word a list of n-grams and the mean of their margins; the top word's margin through the logistic."""
    edge = ".,;:!?()[]\"'|*&%$#<>-_=+~`^/\\@{}"
    words = [w for w in (x.strip(edge) for x in text.lower().split(" ")) if w]
    if not words:
        top = subword.NO_WORD
    else:
        margins = []
        for w in words:
            raw = b"\x01" + w.encode() + b"\x01"
            keys = [naive_mix(naive_word_hash(raw))]
            for n in (3, 4, 5):
                for i in range(len(raw) - n + 1):
                    value = 0
                    for b in raw[i : i + n]:
                        value = value * 257 + b
                    keys.append(naive_mix((value * 8 + n) & M64))
            margins.append(sum(float(model.margins[k & (1 << subword.BITS) - 1]) for k in keys) / len(keys) + model.bias)
        top = max(margins)
    return 1 / (1 + np.exp(-(model.slope * top + model.shift)))


def test_subword_scores_are_those_of_a_naive_version():
    rng = random.Random(9)
    vocab = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    texts = [" ".join(rng.choice([*vocab, "grr"] if i % 2 else vocab) for _ in range(rng.randint(1, 30))) for i in range(120)]
    model = subword.Model([t.encode() for t in texts], np.arange(120) % 2)
    some = ["", " ", "a", "grr", "one grr, Two! (three) -- x", "... !!", *texts[:20], " ".join(texts[:5])]
    data, off = bytes_of(some)
    assert np.allclose(model.scores(data, off), [naive_subword_score(model, t) for t in some], atol=1e-4)
    assert model.margins.any()


def naive_features(text):
    """Buckets of byte n-grams, words by shape, and pairs with back-references, as a set."""
    raw, out = text.encode(), set()
    bucket = lambda x: (x * 0x9E3779B97F4A7C15 & M64) >> (64 - nbsvm.BITS)
    for n in (2, 3, 4):
        for i in range(len(raw) - n + 1):
            value = raw[i]
            for b in raw[i + 1 : i + n]:
                value = value * 257 + b + 1
            out.add(bucket((value & M64) * 8 + n & M64))
    words = [w for w in raw.translate(bytes(32 if c in range(9, 14) else c for c in range(256))).split(b" ") if w]
    shapes = []
    for w in words:
        own = [int(nbsvm.SHAPE[b]) for b in w]
        shapes.append(naive_word_hash([c for i, c in enumerate(own) if not i or c != own[i - 1]]))
    out |= {bucket(s + 11 & M64) for s in shapes}
    out |= {bucket(shapes[i] * 3 + (1 if words[i] == words[i + 1] else shapes[i + 1]) & M64) for i in range(len(words) - 1)}
    return out


def test_nbsvm_is_that_of_a_naive_version():
    rng = random.Random(10)
    vocab = ["Alpha", "beta", "g4mma", "delta,", "é", "ii", "jj.", "12"]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 12))) for _ in range(60)] + ["", "a", "x x x", "\ta  b\n"]
    data, off = bytes_of(texts)
    found, at = nbsvm.features(data, off)
    rows = [found[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
    sets = [naive_features(t) for t in texts]
    assert [set(r.tolist()) for r in rows] == sets
    y = np.array([int("beta" in t) for t in texts])
    model = nbsvm.Model(rows, y)
    fit = [i for c in (0, 1) for k, i in enumerate(np.flatnonzero(y == c)) if k % 5]
    n1, n0 = (sum(y[i] == c for i in fit) for c in (1, 0))
    weights = {}
    for f in set().union(*sets):
        c1, c0 = (sum(f in sets[i] for i in fit if y[i] == c) for c in (1, 0))
        ratio = np.log((c1 + 1) / (n1 + 2) / ((c0 + 1) / (n0 + 2)))
        assert np.sqrt(model.square[f]) == pytest.approx(abs(ratio), abs=1e-5)
        weights[f] = float(model.weight[f])
    scores = model.scores(data, off)
    for i, own in enumerate(sets):
        norm = np.sqrt(sum(float(model.square[f]) for f in own))
        margin = model.bias + (sum(weights[f] for f in own) / norm if norm else 0.0)
        assert scores[i] == pytest.approx(1 / (1 + np.exp(-(model.slope * margin + model.shift))), abs=1e-4)


def test_ids_of_texts_and_clashing_columns(spark):
    rows = [(f"d{i}", ("good fine day " if i % 2 else "bad!! poor?? ") * (1 + i % 7), i, "x", 0.5) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, id int, found string, score double")
    marks = spark.createDataFrame([(f"d{i}", i % 2) for i in range(40)], "doc_id string, label int")
    for module in (nbsvm, subword):
        got = {r.doc_id: r.predicted for r in nbsvm.score(docs, module.train(docs, marks, "label"), ["doc_id"], 0.5).collect()}
        assert got == {f"d{i}": i % 2 for i in range(40)}


def test_scores_do_not_depend_on_batches():
    texts = ["one two!! three", "", "ALL CAPS!!", "x x x x", "é è", "a|b | c"]
    data, off = bytes_of(texts)
    found, at = nbsvm.features(data, off)
    for i, t in enumerate(texts):
        d, o = bytes_of([t])
        assert nbsvm.features(d, o)[0].tolist() == found[at[i] : at[i + 1]].tolist()
