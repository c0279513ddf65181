"""Language identification by prediction by partial matching.

For each language a context tree over bytes holds what follows the last 0 to `order` bytes of a text. A symbol's
probability comes from the longest context that has seen it; every longer context costs its escape, d / (n + d) with d
distinct symbols among n, and symbols of the longer context are excluded from the shorter ones' mass. Below order 0 all
256 byte values are equal. A text's first bytes have only the contexts that they have; a context that was never seen
costs nothing. Statistics are frozen after training, so each node's code length is computed once, for all languages:
the tree is a hash table from byte strings to rows of code lengths, and a text's code length is a sum of rows.

Training takes at most `docs_per_lang` labelled documents a language, whole texts of at most `longest` characters,
picked by a hash of their id: a documented bound, the same for any input. The tree has as many orders, up to `order`, as
fit in `most_values` code lengths over all languages, so that what is broadcast has a bound. Everything else covers whole
texts of all rows, a very long text piece by piece.

Defined results: null texts and texts without a letter are `und` with score 0; so is everything if nothing is labelled;
ties go to the first language by name; null ids and repeated rows are scored like any other; extra columns, whatever
their names, are neither read nor returned unless asked for.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import lean, slices, small_batches, utf8

UNKNOWN = "und"
#: Code lengths that are held at once: bytes times languages.
PIECE = 1 << 18


ODD = np.uint64(0x9E3779B97F4A7C15)


class Index:
    """A hash table: keys sorted by the bucket that their hash gives, and a row of values for each."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray):
        self.shift = np.uint64(64 - max(1, (2 * len(keys)).bit_length()))
        bucket = (keys * ODD) >> self.shift
        order = np.argsort(bucket, kind="stable")
        self.keys, self.rows, bucket = keys[order], rows[order], bucket[order]
        self.start = np.searchsorted(bucket, np.arange((1 << (64 - int(self.shift))) + 1, dtype=np.uint64)).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Each key's place in the table; -1 if it isn't there."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int32)
        bucket = ((keys * ODD) >> self.shift).astype(np.int64)
        spot = np.minimum(self.start[bucket], len(self.keys) - 1)
        out = np.where(self.keys[spot] == keys, spot, np.int32(-1))
        todo = np.flatnonzero(out < 0)  # most keys are the first of their bucket
        at, end = self.start[bucket[todo]] + 1, self.start[bucket[todo] + 1]
        live = at < end
        while live.any():
            todo, at, end = todo[live], at[live], end[live]
            hit = self.keys[at] == keys[todo]
            out[todo[hit]] = at[hit]
            at += 1
            live = ~hit & (at < end)
        return out


def grams(data: np.ndarray, longest: int) -> list[np.ndarray]:
    """For k from 0: the last k + 1 bytes at each place from k on, as a number times 8 plus k."""
    value = data.astype(np.uint64)
    out, gram = [], np.zeros(len(data), np.uint64)
    for k in range(longest + 1):
        gram = gram[1:] if k else gram
        gram = gram + (value[: len(value) - k] << np.uint64(8 * k)) if len(value) > k else gram[:0]
        out.append(gram * np.uint64(8) + np.uint64(k))
    return out


def suffix(keys: np.ndarray, k: int) -> np.ndarray:
    """Keys of order k without their first byte."""
    return ((keys >> np.uint64(3)) & np.uint64((1 << 8 * k) - 1)) * np.uint64(8) + np.uint64(k - 1)


def context(keys: np.ndarray, k: int) -> np.ndarray:
    """Keys of order k without their last byte, which names a context of k bytes."""
    return (keys >> np.uint64(11)) * np.uint64(8) + np.uint64(k)


class Model:
    """strings[k - 1]: code lengths of a string of k + 1 bytes' last byte after the others, a language a column; contexts[k - 1]:
    escapes of contexts of k bytes, 0 where a language never saw one; base: code lengths of single bytes."""

    def __init__(self, texts: dict[str, list[bytes]], order: int = 4, most_values: int = 1 << 25):
        self.langs = sorted(texts)
        width = max(1, len(self.langs))
        counted = [self._counted([np.frombuffer(t, np.uint8) for t in texts[lang] if t], order) for lang in self.langs]
        self.base = np.full((256, width), 8, np.float32)  # of single bytes: a language's own, or its escape and a share of the rest
        shares = []
        for i, c in enumerate(counted):
            keys, times = c[0]
            byte, n, d = (keys >> np.uint64(3)).astype(np.int64), times.sum(), max(1, len(keys))
            shares.append(times / (n + d))
            if len(keys):
                self.base[:, i] += -np.log2(d / (n + d) / max(1e-9, 1 - d / 256))
                self.base[byte, i] = -np.log2(shares[i])
        self.strings, self.contexts = [], []
        shorter, lower, size = np.arange(256, dtype=np.uint64) * np.uint64(8), self.base, 0
        for k in range(1, order + 1):
            union = np.unique(np.concatenate([np.zeros(0, np.uint64), *(c[k][0] for c in counted)]))
            above = np.unique(context(union, k))
            size += (len(union) + len(above)) * width
            if not len(union) or size > most_values:
                break
            rows, escapes = lower[np.searchsorted(shorter, suffix(union, k))], np.zeros((len(above), width), np.float32)
            for i, c in enumerate(counted):
                keys, times = c[k]
                own, which, d = np.unique(context(keys, k), return_inverse=True, return_counts=True)
                n = np.bincount(which, weights=times, minlength=len(own))
                # a string that was seen was seen without its first byte too, so exclusion takes those shares off
                taken = shares[i][np.searchsorted(c[k - 1][0], suffix(keys, k))]
                rest = np.maximum(1 - np.bincount(which, weights=taken, minlength=len(own)), 1e-9)
                escapes[np.searchsorted(above, own), i] = -np.log2(d / (n + d) / rest)
                rows[:, i] += escapes[np.searchsorted(above, context(union, k)), i]
                shares[i] = times / (n + d)[which]
                rows[np.searchsorted(union, keys), i] = -np.log2(shares[i])
            self.strings.append(Index(union, rows))
            self.contexts.append(Index(above, escapes))
            shorter, lower = union, rows
        self.order = len(self.strings)

    @staticmethod
    def _counted(texts: list[np.ndarray], order: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """By order: the sorted strings that were seen, and how often."""
        found = [grams(t, order) for t in texts]
        return [np.unique(np.concatenate([np.zeros(0, np.uint64), *(g[k] for g in found)]), return_counts=True) for k in range(order + 1)]

    def code_lengths(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Bits of each row under each language."""
        out = np.zeros((len(off) - 1, len(self.langs)))
        if not len(data) or not self.langs:
            return out
        step = max(1 << 12, PIECE // max(4, len(self.langs)))
        for s in range(0, len(data), step):
            e = min(len(data), s + step)
            row = np.searchsorted(off, np.arange(s, e), "right") - 1
            bits = self._bits(data[max(0, s - self.order) : e], np.arange(s, e) - off[row])[-(e - s) :]
            edge = np.flatnonzero(np.diff(row, prepend=-1))
            out[row[edge]] += np.add.reduceat(bits, edge, axis=0, dtype=np.float64)
        return out

    def _bits(self, data: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Code lengths of the last len(place) bytes; place: how many bytes of its row stand before each."""
        n, have, least = len(place), len(data) - len(place), int(place.min())
        out = np.zeros((n, len(self.langs)), np.float32)
        keys = grams(data, self.order)
        todo = np.arange(n)
        for k in range(self.order, 0, -1):
            able = place[todo] >= k if k > least else None
            own = todo if able is None else todo[able]
            string = keys[k][own + have - k]
            found = self.strings[k - 1].find(string)
            lost = found < 0
            if not lost.any():
                out[own] += self.strings[k - 1].rows[found]
                rest = own[:0]
            else:
                out[own[~lost]] += self.strings[k - 1].rows[found[~lost]]
                rest = own[lost]
                spot = self.contexts[k - 1].find(context(string[lost], k))
                known = spot >= 0
                out[rest[known]] += self.contexts[k - 1].rows[spot[known]]
            todo = rest if able is None else np.sort(np.concatenate([todo[~able], rest]))
        out[todo] += self.base[data[todo + have]]
        return out


def sample(docs: DataFrame, docs_per_lang: int = 150, longest: int = 20_000, key: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, list[bytes]]:
    """At most docs_per_lang labelled texts a language; the window keeps that many rows a task before the shuffle."""
    own = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.length(text) <= longest))
    own = own.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(key).cast("string")).alias("at"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("at", F.xxhash64("text")))
    out: dict[str, list[bytes]] = {}
    for row in own.withColumn("rank", rank).where(F.col("rank") <= docs_per_lang).drop("rank").toLocalIterator():
        out.setdefault(row["lang"], []).append(row["text"].encode())
    return {k: sorted(v) for k, v in out.items()}


def identify(docs: DataFrame, model: Model, keep: list[Column | str], text: str = "text") -> DataFrame:
    """Columns keep, then lang_pred, score, and bits (the best code length a byte; null for `und`)."""
    small_batches(docs.sparkSession)
    frame = docs.select(*keep, F.col(text).alias("__text"), F.coalesce(F.col(text).rlike("\\p{L}"), F.lit(False)).alias("__letters"))
    names = frame.columns[:-2]
    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields[:-2]), "lang_pred string, score double, bits double"])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # most_values code lengths at most, however large the input

    def run(batches):
        own = shared.value
        for batch in batches:
            data, off = utf8(batch, len(names))
            bits = np.concatenate([np.zeros((0, len(own.langs))), *(own.code_lengths(data[off[a] : off[b]], off[a : b + 1] - off[a]) for a, b in slices(off))])
            able = np.array(batch.column(len(names) + 1).to_pylist(), bool) & bool(own.langs)
            best = bits.argmin(1) if own.langs else np.zeros(len(bits), int)
            least = bits[np.arange(len(bits)), best] if own.langs else np.zeros(len(bits))
            share = 1 / np.exp2(np.minimum(0, least[:, None] - bits)).sum(1) if own.langs else np.zeros(len(bits))
            per = least / np.maximum(np.diff(off), 1)
            pred = [own.langs[i] if ok else UNKNOWN for i, ok in zip(best, able, strict=True)]
            made = [pa.array(pred, pa.string()), pa.array(np.where(able, share, 0.0), pa.float64()), pa.array(per, pa.float64(), mask=~able)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *made], [*names, "lang_pred", "score", "bits"])

    return frame.mapInArrow(lean(run), fields)
