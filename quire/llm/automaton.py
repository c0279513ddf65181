"""Substring dedup by suffix automata of reference shards.

The reference is the corpus's repeated spans, in shards by anchor (see passages). Of each shard an automaton over words
is built, whose states count in how many places, with their weights, a window ends. Spans are streamed through the
automata: the matching statistic at each word is the longest suffix that the reference holds, cut at the window's
length; where it reaches the length, and the state's count says that the window also starts elsewhere, the window is
repeated. Removed are the maximal stretches of words that repeated windows cover.

The shards go to where their spans are, by the shuffle, since the corpus as its own reference has no bounded size to
broadcast; a shard has one.

Defined results: words are maximal runs of other bytes than space and \\t to \\r, unchanged; null texts have none; texts
shorter than a window lose nothing; rows of equal id and text are copies of each other, so lose all that is long enough;
windows are judged on the input, and overlapping equal windows of one document count.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import lean, materialize, slices, utf8
from quire.llm.passages import classes_of, covered, decided, intervals_of, keyed, repeated_runs, with_words


class Automaton:
    """A suffix automaton of several word sequences. count[state]: the weight of the places where its words of at least `length` end."""

    def __init__(self, length: int):
        self.length = length
        self.next: list[dict] = [{}]
        self.link, self.size, self.count = [-1], [0], [0]

    def add(self, sequence: list, weight: int) -> None:
        nxt, link, size, count, last = self.next, self.link, self.size, self.count, 0
        for i, c in enumerate(sequence, 1):
            to = nxt[last].get(c)
            if to is not None and size[to] == size[last] + 1:
                last = to
            else:
                if to is not None:
                    cur = self._split(last, c, to)
                else:
                    cur = len(nxt)
                    nxt.append({})
                    size.append(size[last] + 1)
                    link.append(0)
                    count.append(0)
                    p = last
                    while p >= 0 and c not in nxt[p]:
                        nxt[p][c] = cur
                        p = link[p]
                    if p >= 0:
                        q = nxt[p][c]
                        link[cur] = q if size[q] == size[p] + 1 else self._split(p, c, q)
                last = cur
            if i >= self.length:
                count[last] += weight

    def _split(self, p: int, c, q: int) -> int:
        nxt, link = self.next, self.link
        new = len(nxt)
        nxt.append(nxt[q].copy())
        self.size.append(self.size[p] + 1)
        link.append(link[q])
        self.count.append(0)
        link[q] = new
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = new
            p = link[p]
        return new

    def settle(self) -> None:
        """Counts flow to the suffixes."""
        for s in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            if self.count[s] and self.link[s] > 0:
                self.count[self.link[s]] += self.count[s]

    def repeated(self, sequence: list, least: int) -> list[int]:
        """Starts of the windows that end in states of a count of `least` or more."""
        nxt, link, size, count, length = self.next, self.link, self.size, self.count, self.length
        state, have, out = 0, 0, []
        for i, c in enumerate(sequence):
            while state and c not in nxt[state]:
                state = link[state]
                have = size[state]
            to = nxt[state].get(c)
            if to is None:
                continue
            state, have = to, have + 1
            while size[link[state]] >= length:
                state = link[state]
            if have > length:
                have = length
            if have == length and count[state] >= least:
                out.append(i - length + 1)
        return out


def judge(length: int):
    def decide(homes: list[dict]):
        own = Automaton(length)
        for row in homes:
            own.add(row["words"].split(), row["weight"])
        own.settle()
        # at home a span finds itself, so it takes two places; elsewhere one
        return lambda row, home: [*intervals_of(own.repeated(row["words"].split(), 2 if home else 1))]

    return decide


def repeated_ranges(own: DataFrame, length: int, gram: int) -> DataFrame:
    """uid and cuts: ranges of words [a, b) that repeated windows cover."""
    runs = repeated_runs(own, length, gram)
    found = decided(with_words(classes_of(runs), own, length), judge(length), "a:int, b:int", ["a", "b"])
    each = runs.join(materialize(found, "windows"), ["anchor", "span"]).select("uid", "s", F.explode("intervals").alias("i"))
    cut = F.struct((F.col("s") + F.col("i.a")).alias("a"), (F.col("s") + F.col("i.b") + length).alias("b"))
    return each.select("uid", cut.alias("cut")).groupBy("uid").agg(F.collect_set("cut").alias("cuts"))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 35, gram: int = 8, with_text: bool = False) -> DataFrame:
    """Columns key, n_words, n_removed, kept_sha256 (of the kept words, joined by one space), and kept text if asked for."""
    own = keyed(docs, key, text)
    kind = own.schema["id"].dataType.simpleString()
    joined = own.join(repeated_ranges(own, length, gram), "uid", "left").select("id", "text", "cuts")
    names = [key, "n_words", "n_removed", "kept_sha256", *["kept"] * with_text]

    def run(batches):
        for batch in batches:
            data, off = utf8(batch, 1)
            cuts = batch.column(2)
            for a, b in slices(off):
                part, at = data[off[a] : off[b]], off[a : b + 1] - off[a]
                raw, bounds = part.tobytes(), at.tolist()
                n, removed, digest, kept = [], [], [], []
                for i in range(b - a):
                    mine = raw[bounds[i] : bounds[i + 1]].split()
                    n.append(len(mine))
                    if (own_cuts := cuts[a + i].as_py()) is not None:
                        gone = covered(len(mine), [(c["a"], c["b"]) for c in own_cuts])
                        mine = [w for w, g in zip(mine, gone.tolist(), strict=True) if not g]
                    removed.append(n[-1] - len(mine))
                    joined_words = b" ".join(mine)
                    digest.append(hashlib.sha256(joined_words).hexdigest())
                    if with_text:
                        kept.append(joined_words.decode())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string()), *[pa.array(kept, pa.string())] * with_text], names)

    return joined.mapInArrow(lean(run), f"`{key}` {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text)
