"""Passage dedup by sparse suffix arrays.

Suffixes are retained at content-selected positions only: the minimiser anchors of passages. An anchor's suffixes (one a
class of equal contexts) are sorted; neighbours' common prefixes give those of any two by running minima; matches are
then extended to the left of the anchor. A window of `length` words is repeated where left and right extension
together reach it, which covers every repeated passage of that length or more, as each has an anchor that all its places
share. Each window belongs to the first document that holds it (smallest id, then position); at all other places it is
removed.

Defined results: words are maximal runs of other bytes than space and \\t to \\r, unchanged; null texts stay null and
have none; a repeat within one document is removed after its first place; rows of equal id and text are one document's,
so each keeps what is first there; null ids come before all others; extra columns stay as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import lean, materialize, slices, utf8, words
from quire.llm.passages import classes_of, covered, decided, keyed, repeated_runs, with_words


class SuffixArray:
    """The sorted suffixes of one anchor's classes at home here, with what stands left of them."""

    def __init__(self, homes: list[dict], length: int, gram: int):
        self.length, self.left_most = length, length - gram
        self.names: dict[bytes, int] = {}
        rows = [self.coded(r, True) for r in homes]
        order = sorted(range(len(rows)), key=lambda i: rows[i][1].tolist())
        self.left, self.right = (np.array([rows[i][k] for i in order], np.int64).reshape(len(order), n) for k, n in ((0, self.left_most), (1, length)))
        self.place = {homes[i]["span"]: at for at, i in enumerate(order)}
        same = (self.right[1:] == self.right[:-1]) & (self.right[1:] > 0)
        self.common = np.logical_and.accumulate(same, axis=1).sum(1) if len(order) > 1 else np.zeros(0, np.int64)
        self.owner = [self.owner_of(homes[i]) for i in order]
        self.rank = np.array(sorted(range(len(order)), key=lambda i: self.owner[i]))

    @staticmethod
    def owner_of(row: dict) -> tuple:
        return (row["id"] is not None, row["id"] if row["id"] is not None else 0, row["s"] + row["j"])

    def coded(self, row: dict, new: bool) -> tuple[np.ndarray, np.ndarray]:
        """Words to the left of the anchor, nearest first, and from the anchor on, as numbers; 0: none, -1: unknown here."""
        own = row["words"].split()
        if new:
            ids = [self.names.setdefault(w, len(self.names) + 1) for w in own]
        else:
            ids = [self.names.get(w, -1) for w in own]
        left, right = np.zeros(self.left_most, np.int64), np.zeros(self.length, np.int64)
        before, after = ids[: row["j"]][::-1][: self.left_most], ids[row["j"] :][: self.length]
        left[: len(before)], right[: len(after)] = before, after
        return left, right

    def prefixes(self, row: dict, right: np.ndarray, home: bool) -> np.ndarray:
        """Length of the common prefix with each suffix."""
        if not home:
            return np.logical_and.accumulate((self.right == right) & (right > 0), axis=1).sum(1)
        at = self.place[row["span"]]
        out = np.full(len(self.right), self.length, np.int64)
        out[at + 1 :] = np.minimum.accumulate(self.common[at:])
        out[:at] = np.minimum.accumulate(self.common[:at][::-1])[::-1]
        return out

    def repeated(self, row: dict, home: bool) -> list[tuple]:
        """Intervals of the class's windows that occur elsewhere: a, b, then the first document and its place of window a."""
        j, m, mine = row["j"], row["m"], self.owner_of(row)
        if not self.place:  # no class is at home in this shard
            return []
        if home and len(self.right) == 1:
            return [(0, m - 1, row["id"], row["s"])] if row["weight"] > 1 else []
        left, right = self.coded(row, False)
        prefix = self.prefixes(row, right, home)
        suffix = np.logical_and.accumulate((self.left == left) & (left > 0), axis=1).sum(1)
        if home:
            suffix[self.place[row["span"]]] = j
            prefix[self.place[row["span"]]] = self.length
        back = j - np.arange(m)  # words left of the anchor in each window
        reach = (suffix[self.rank] >= back[:, None]) & (prefix[self.rank] >= (self.length - back)[:, None])
        found = reach.sum(1) + (0 if home else 1) + (row["weight"] > 1)
        best = reach.argmax(1)
        out: list[tuple] = []
        last = None
        for t in np.flatnonzero(found > 1).tolist():
            owner = self.owner[self.rank[best[t]]] if reach[t, best[t]] else mine
            owner = min(owner, mine)
            if out and last == (t - 1, owner):
                out[-1] = (out[-1][0], t, *out[-1][2:])
            else:
                out.append((t, t, owner[1] if owner[0] else None, owner[2] - j + t))
            last = (t, owner)
        return out


def judge(length: int, gram: int):
    def decide(homes: list[dict]):
        own = SuffixArray(homes, length, gram)
        return own.repeated

    return decide


def repeats(own: DataFrame, length: int, gram: int) -> DataFrame:
    """Removed ranges: uid, id, a, b (words [a, b)), first_id, first_a. Ranges of one document may overlap."""
    kind = own.schema["id"].dataType.simpleString()
    runs = repeated_runs(own, length, gram)
    found = decided(with_words(classes_of(runs), own, length), judge(length, gram), f"a:int, b:int, first_id:{kind}, first_a:int", ["a", "b", "first_id", "first_a"])
    each = runs.join(materialize(found, "windows"), ["anchor", "span"]).select("uid", "id", "s", F.explode("intervals").alias("i"))
    each = each.where(~(F.col("id").eqNullSafe(F.col("i.first_id")) & (F.col("s") + F.col("i.a") == F.col("i.first_a"))))
    return each.select("uid", "id", (F.col("s") + F.col("i.a")).alias("a"), (F.col("s") + F.col("i.b") + length).alias("b"), F.col("i.first_id").alias("first_id"), F.col("i.first_a").alias("first_a"))


def removed_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 50, gram: int = 8) -> DataFrame:
    """A row for each maximal removed stretch: key, start_word, n_words, and where its first window stands first."""
    own = keyed(docs, key, text)
    cuts = repeats(own, length, gram)
    # stretches that meet are one: a new one begins where no earlier range of the document reaches
    order = Window.partitionBy("uid", "id").orderBy("a", "b", "first_id", "first_a")
    reach = F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    cuts = cuts.withColumn("begins", (reach.isNull() | (F.col("a") > reach)).cast("int")).withColumn("stretch", F.sum("begins").over(order))
    first = F.min(F.struct("a", "b", "first_id", "first_a")).alias("first")
    rows = cuts.groupBy("uid", "id", "stretch").agg(first, F.max("b").alias("end"))
    start = F.col("first.a")
    return rows.select(F.col("id").alias(key), start.cast("long").alias("start_word"), (F.col("end") - start).cast("long").alias("n_words"), F.col("first.first_id").alias(f"first_{key}"), F.col("first.first_a").cast("long").alias("first_start_word"))


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 50, gram: int = 8) -> DataFrame:
    """docs with the repeated stretches cut out of their texts, white space around kept words as it was."""
    own = keyed(docs, key, text)
    cuts = repeats(own, length, gram).groupBy(F.col("uid").alias("__of")).agg(F.collect_set(F.struct("a", "b")).alias("__cuts"))
    whole = docs.withColumn("__uid", F.xxhash64(docs[key].alias("id"), F.coalesce(docs[text], F.lit(""))))
    joined = whole.join(cuts, F.col("__uid") == F.col("__of"), "left").drop("__of", "__uid")
    spot = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            data, off = utf8(batch, spot)
            lists, made = batch.column(len(docs_columns)), []
            nulls = batch.column(spot).is_null().to_pylist()
            for a, b in slices(off):
                part, at = data[off[a] : off[b]], off[a : b + 1] - off[a]
                start, end, word = words(part, at)
                raw, bounds = part.tobytes(), at.tolist()
                for i in range(b - a):
                    whole_text = raw[bounds[i] : bounds[i + 1]]
                    if (own_cuts := lists[a + i].as_py()) is None:
                        made.append(None if nulls[a + i] else whole_text)
                        continue
                    first = start[word[i] : word[i + 1]]
                    gone = covered(len(first), [(c["a"], c["b"]) for c in own_cuts])
                    edge = np.flatnonzero(np.diff(np.concatenate([[True], gone, [True]]).astype(np.int8)))
                    # kept stretches go from a word's start to the next removed word's start, or to the end
                    kept = [raw[bounds[i] if x == 0 else first[x] : bounds[i + 1] if y == len(first) else first[y]] for x, y in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]
                    made.append(b"".join(kept).rstrip())
            columns = [pa.array([None if m is None else m.decode() for m in made], pa.string()) if i == spot else c for i, c in enumerate(batch.columns[: len(docs_columns)])]
            yield pa.RecordBatch.from_arrays(columns, docs_columns)

    docs_columns = docs.columns
    return joined.mapInArrow(lean(run), docs.schema)
