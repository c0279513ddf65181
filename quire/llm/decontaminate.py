"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment of words.

Words are lower-cased and lose punctuation at their ends. Seeds are an item's word trigrams, all of them, however many
documents hold them: an edited or partial leak that is in many documents has no others. Every place where a document
holds a seed gives a window of the document, windows that meet are one, and each whose words could reach the threshold is
aligned with the item: match 2, mismatch -1, gap -1, local. The score is the best alignment's part of the item's perfect
score; from `threshold` on the document is contaminated by the item.

The items are taken in blocks of `block` rows and `block_bytes` of text at most (a longer item is a block of its own), so
what is broadcast has a bound; all documents are read for each block. Lower case is made where words are taken, by Python:
the JVM's first call of its own fills its heap with some GB of garbage, and each text would be sent twice.

Defined results: null and empty texts and items have no words and match nothing; items of fewer than three words use
their whole sequence as the seed; equal items are scored each; among equal alignments the first in the document counts;
repeated documents give repeated rows; extra columns, whatever their names, are not read, and stay where documents do.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quire.llm.common import gram_hashes, lean, slices, small_batches, trimmed, utf8, word_hashes

MATCH, MISMATCH, GAP = 2, -1, -1
SEED = 3
FILTER_BITS = 20


class Index:
    """A block of items: their words, and their seeds sorted by hash with a bit filter before them."""

    def __init__(self, ids: list, texts: list[bytes]):
        data = np.frombuffer(b"".join(texts), np.uint8)
        off = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        low, start, end, at = trimmed(data, off)
        hashes = word_hashes(low, start, end)
        self.ids, self.words = ids, [hashes[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        seeds, items, places = [], [], []
        for i, w in enumerate(self.words):
            for n in {min(SEED, len(w))} - {0}:
                g = gram_hashes(w, n) + np.uint64(n)
                seeds.append(g)
                items.append(np.full(len(g), i))
                places.append(np.arange(len(g)))
        self.sizes = sorted({min(SEED, len(w)) for w in self.words} - {0}, reverse=True)
        own = np.concatenate([np.zeros(0, np.uint64), *seeds])
        order = np.argsort(own, kind="stable")
        self.seeds, self.items, self.places = own[order], np.concatenate([np.zeros(0, np.int64), *items])[order], np.concatenate([np.zeros(0, np.int64), *places])[order]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[(self.seeds & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)] = True

    def hits(self, hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word positions whose n-gram, within its row, is a seed, and the seeds' hashes."""
        found, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        row = np.repeat(np.arange(len(at) - 1), np.diff(at))
        for n in self.sizes:
            g = gram_hashes(hashes, n) + np.uint64(n)
            near = np.flatnonzero(self.filter[(g & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)])
            near = near[row[near] == row[near + n - 1]]
            spot = np.searchsorted(self.seeds, g[near])
            near = near[(spot < len(self.seeds)) & (self.seeds[np.minimum(spot, len(self.seeds) - 1)] == g[near])] if len(self.seeds) else near[:0]
            found.append(near)
            keys.append(g[near])
        return np.concatenate(found), np.concatenate(keys)


def align(docs: list[np.ndarray], items: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of each pair, and the end in the document of the first that reaches it."""
    n, m = max(map(len, docs)), max(map(len, items))
    d = np.zeros((len(docs), n), np.uint64)
    for i, x in enumerate(docs):
        d[i, : len(x)] = x
    full = np.array([len(x) for x in docs])
    over = np.arange(n)[None, :] >= full[:, None]
    score, end = np.zeros(len(docs), np.int32), np.zeros(len(docs), np.int64)
    line, place = np.zeros((len(docs), n + 1), np.int32), np.arange(n + 1, dtype=np.int32)
    who = np.arange(len(docs))
    for j in range(m):
        word = np.array([x[j] if j < len(x) else 0 for x in items], np.uint64)
        able = np.array([j < len(x) for x in items])
        equal = (d == word[:, None]) & ~over & able[:, None]
        new = np.zeros_like(line)
        new[:, 1:] = np.maximum(line[:, :-1] + np.where(equal, MATCH, MISMATCH), line[:, 1:] + GAP)
        np.maximum(new, 0, out=new)
        new = np.maximum.accumulate(new - GAP * place, axis=1) + GAP * place  # gaps in the item
        line = np.where(able[:, None], new, line)
        at = line.argmax(1)
        best = line[who, at]
        better = (best > score) | (best == score) & (at < end) & (best > 0)
        score, end = np.where(better, best, score), np.where(better, at, end)
    return score, end


def windows(index: Index, hashes: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Row, item, and the words from and to of each window to align, in the rows' joined words."""
    pos, key = index.hits(hashes, at)
    if not len(pos):
        return
    lo, hi = np.searchsorted(index.seeds, key, "left"), np.searchsorted(index.seeds, key, "right")
    many = hi - lo
    entry = np.arange(many.sum()) + np.repeat(lo - np.concatenate([[0], np.cumsum(many)[:-1]]), many)
    p, item = np.repeat(pos, many), index.items[entry]
    size = np.array([len(w) for w in index.words])[item]
    row = np.searchsorted(at, p, "right") - 1
    a = np.maximum(p - index.places[entry] - size // 2, at[row])
    b = np.minimum(p - index.places[entry] + size + size // 2, at[row + 1])
    order = np.lexsort((a, item, row))
    last = None
    for r, i, s, e in zip(row[order].tolist(), item[order].tolist(), a[order].tolist(), b[order].tolist(), strict=True):
        if last is not None and last[:2] == (r, i) and s <= last[3]:
            last = (r, i, last[2], max(last[3], e))
        else:
            if last is not None:
                yield last
            last = (r, i, s, e)
    yield last


def matches(index: Index, data: np.ndarray, off: np.ndarray, threshold: float) -> list[tuple[int, int, float, int, int]]:
    """Row, item, score, first word and number of words of the row's part; the best of each row and item."""
    low, start, end, at = trimmed(data, off)
    hashes = word_hashes(low, start, end)
    todo = []
    for r, i, s, e in windows(index, hashes, at):
        w = index.words[i]
        # no alignment has more matches than the window has words of the item, each as often as the item at most
        if np.isin(w, hashes[s:e]).sum() >= threshold * len(w):
            todo.append((r, i, s, e))
    todo.sort(key=lambda x: (len(index.words[x[1]]), x[3] - x[2]))
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    while todo:
        n = max(1, min(256, (1 << 20) // max(1, todo[-1][3] - todo[-1][2])))
        some, todo = todo[-n:], todo[:-n]
        own = [index.words[i] for _, i, _, _ in some]
        score, stop = align([hashes[s:e] for _, _, s, e in some], own)
        for (r, i, s, _), x, t, w in zip(some, score.tolist(), stop.tolist(), own, strict=True):
            part = x / (MATCH * len(w))
            if part >= threshold:
                # the reversed texts' alignment that ends first begins where this one does
                back = align([hashes[s : s + t][::-1]], [w[::-1]])[1][0]
                new = (part, s + t - int(back) - int(at[r]), int(back))
                if (r, i) not in best or (-new[0], new[1]) < (-best[r, i][0], best[r, i][1]):
                    best[r, i] = new
    return [(r, i, *x) for (r, i), x in sorted(best.items())]


def lowered(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A slice's texts in lower case, each by itself; an ASCII text stays, as trimmed() does the same."""
    raw, at = data.tobytes(), off.tolist()
    texts = [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
    texts = [t if t.isascii() else t.decode("utf-8", "replace").lower().encode() for t in texts]
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def indexes(items: DataFrame, block: int, block_bytes: int, item_key: str, item_text: str) -> Iterator[Index]:
    ids, texts, size = [], [], 0
    for row in items.where(F.col(item_text).isNotNull()).select(F.col(item_key).alias("i"), F.col(item_text).alias("t")).orderBy("i", "t").toLocalIterator():
        text = row["t"].lower().encode()
        if ids and (len(ids) == block or size + len(text) > block_bytes):
            yield Index(ids, texts)
            ids, texts, size = [], [], 0
        ids.append(row["i"])
        texts.append(text)
        size += len(text)
    if ids:
        yield Index(ids, texts)


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = 0.4, block: int = 20_000, block_bytes: int = 8 << 20, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """Rows key, item_id, score, start_word, n_words: documents that hold an item, as a copy, edited or paraphrased."""
    spark = small_batches(docs.sparkSession)
    kind, item_kind = docs.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    schema = f"`{key}` {kind}, item_id {item_kind}, score double, start_word long, n_words long"
    own = docs.select(docs[key].alias(key), docs[text].alias("__text"))
    kinds = to_arrow_type(items.schema[item_key].dataType)

    def found_by(index: Index) -> DataFrame:
        shared = spark.sparkContext.broadcast(index)

        def run(batches):
            idx = shared.value
            for batch in batches:
                data, off = utf8(batch, 1)
                for a, b in slices(off):
                    found = matches(idx, *lowered(data[off[a] : off[b]], off[a : b + 1] - off[a]), threshold)
                    rows = pa.array([a + f[0] for f in found], pa.int64())
                    made = [pa.array([f[k] for f in found], t) for k, t in ((2, pa.float64()), (3, pa.int64()), (4, pa.int64()))]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), pa.array([idx.ids[f[1]] for f in found], kinds), *made], [key, "item_id", "score", "start_word", "n_words"])

        return own.mapInArrow(lean(run), schema)

    parts = [found_by(i) for i in indexes(items, block, block_bytes, item_key, item_text)]
    return reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], schema)


def without_contaminated(docs: DataFrame, items: DataFrame, threshold: float = 0.4, block: int = 20_000, block_bytes: int = 8 << 20, text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """docs without the rows whose text holds an item: each row by its own text, so ids may be missing or repeated."""
    spark = small_batches(docs.sparkSession)
    names, schema = docs.columns, docs.schema
    place = [n.lower() for n in names].index(text.lower())

    def kept_by(rows: DataFrame, index: Index) -> DataFrame:
        shared = spark.sparkContext.broadcast(index)

        def run(batches):
            idx = shared.value
            for batch in batches:
                data, off = utf8(batch, place)
                keep = np.ones(batch.num_rows, bool)
                for a, b in slices(off):
                    keep[[a + f[0] for f in matches(idx, *lowered(data[off[a] : off[b]], off[a : b + 1] - off[a]), threshold)]] = False
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep)) for c in batch.columns], names)

        return rows.mapInArrow(lean(run), schema)

    for index in indexes(items, block, block_bytes, item_key, item_text):
        docs = kept_by(docs, index)
    return docs
