"""Repeated passages: content-selected anchors that bring equal windows together, shared by the passage dedups.

A window is `length` consecutive words of a document. Its anchor is the leftmost of its `gram`-word sequences with the
smallest hash, so equal windows have equal anchors at equal offsets. Consecutive windows with the same anchor are a run,
and a run's words its span. Windows of different anchors differ; windows of one anchor are compared by an operator of
its own, exactly, on words. Anchors that occur once are dropped before any text moves, and equal spans are one class
with a count, so copies cost no more than their keys. Anchors of more than CHUNK classes are dealt to several shards:
each class is at home in one of them, and is compared with the homes of all.

Rows are known by `uid`, a hash of id and text; spans are checked against their hash wherever they are cut out of a text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quire.llm.common import give_back, gram_hashes, lean, materialize, mix, power_table, slices, utf8, word_hashes, words

CHUNK = 1000
SPAN_BASE = np.uint64(0xA24BAED4963EE407)


def leftmost_least(g: np.ndarray, w: int) -> np.ndarray:
    """For each start of w consecutive values, the place of the leftmost smallest one."""
    at = np.arange(len(g))
    have = 1
    while have < w:
        step = min(have, w - have)
        right = at[step:]
        at = at[: len(right)]
        at = np.where(g[right] < g[at], right, at)
        have += step
    return at


class Spans:
    """Hashes of any words from a to b of joined rows, by prefix sums."""

    def __init__(self, hashes: np.ndarray):
        self.down = power_table(np.uint64(pow(int(SPAN_BASE), -1, 1 << 64)), len(hashes))
        self.sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * power_table(SPAN_BASE, len(hashes))[: len(hashes)], out=self.sums[1:])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self.sums[b] - self.sums[a]) * self.down[a] + (b - a).astype(np.uint64)).view(np.int64)


def runs_of(data: np.ndarray, off: np.ndarray, length: int, gram: int):
    """Row, anchor's hash, span's hash, first window, number of windows, anchor's offset in the span, for each run."""
    start, end, at = words(data, off)
    hashes = word_hashes(data, start, end)
    n = len(hashes) - length + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 6
    g = gram_hashes(hashes, gram)
    anchor = leftmost_least(g, length - gram + 1)[:n]
    row = np.repeat(np.arange(len(off) - 1), np.diff(at))
    whole = row[:n] == row[length - 1 :]
    edge = np.ones(n, bool)
    edge[1:] = (anchor[1:] != anchor[:-1]) | ~whole[:-1] | (row[1:n] != row[: n - 1])
    first = np.flatnonzero(edge & whole)
    over = np.append(np.flatnonzero(edge | ~whole), n)
    count = over[np.searchsorted(over, first, "right")] - first
    return row[first], g[anchor[first]].view(np.int64), Spans(hashes).of(first, first + count + length - 1), first - at[row[first]], count, anchor[first] - first


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    own = docs.select(docs[key].alias("id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    return own.select(F.xxhash64("id", "text").alias("uid"), "id", "text")


def repeated_runs(own: DataFrame, length: int, gram: int) -> DataFrame:
    """Runs (uid, id, anchor, span, s, m, j) whose anchor occurs more than once, written to the shared folder."""
    kind = own.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            data, off = utf8(batch, 2)
            for a, b in slices(off):
                row, anchor, span, s, m, j = runs_of(data[off[a] : off[b]], off[a : b + 1] - off[a], length, gram)
                rows = pa.array(row + a, pa.int64())
                made = [pa.array(anchor), pa.array(span), *(pa.array(x, pa.int32()) for x in (s.astype(np.int32), m.astype(np.int32), j.astype(np.int32)))]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), *made], ["uid", "id", "anchor", "span", "s", "m", "j"])

    every = materialize(own.mapInArrow(lean(run), f"uid long, id {kind}, anchor long, span long, s int, m int, j int"), "runs")
    # written, so the join reads two plain shuffles, and a hot anchor's rows are split among tasks
    many = materialize(every.groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1").select("anchor"), "anchors")
    return materialize(every.join(many, "anchor", "left_semi"), "repeated")


def classes_of(runs: DataFrame) -> DataFrame:
    """One row a distinct span: anchor, span, how often (weight), its first place (id, s, uid), m, j, and its anchor's shards."""
    first = F.min(F.struct("id", "s", "uid", "m", "j")).alias("first")
    own = materialize(runs.groupBy("anchor", "span").agg(F.count("*").alias("weight"), first).select("anchor", "span", "weight", "first.*"), "classes")
    sizes = materialize(own.groupBy("anchor").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("shards")).where("shards > 1"), "sizes")
    return own.join(sizes, "anchor", "left").withColumn("shards", F.coalesce("shards", F.lit(1)))


def with_words(classes: DataFrame, own: DataFrame, length: int) -> DataFrame:
    """Classes with the bytes of their span, cut out of the document of their first place."""
    kind = own.schema["id"].dataType.simpleString()
    fields = ["anchor", "span", "weight", "s", "m", "j", "shards"]
    lists = classes.groupBy("uid").agg(F.collect_list(F.struct(*fields)).alias("spans"))
    joined = own.join(lists, "uid").select("uid", "id", "text", "spans")
    schema = pa.schema([("anchor", pa.int64()), ("span", pa.int64()), ("weight", pa.int64()), ("s", pa.int32()), ("m", pa.int32()), ("j", pa.int32()), ("shards", pa.int32())])

    def run(batches):
        for batch in batches:
            data, off = utf8(batch, 2)
            lists = batch.column(3)
            for a, b in slices(off):
                part, at = data[off[a] : off[b]], off[a : b + 1] - off[a]
                start, end, word = words(part, at)
                spans, raw = Spans(word_hashes(part, start, end)), part.tobytes()
                some = lists.slice(a, b - a)
                flat = some.flatten()
                row = np.repeat(np.arange(b - a), np.diff(some.offsets.to_numpy()))
                cols = {f: flat.field(f).to_numpy(zero_copy_only=False) for f in fields}
                first = word[row] + cols["s"]
                last = first + cols["m"] + length - 1
                ok = last <= word[row + 1]
                ok[ok] = spans.of(first[ok], last[ok]) == cols["span"][ok]
                pick = np.flatnonzero(ok)
                cut = [raw[x:y] for x, y in zip(start[first[pick]].tolist(), end[last[pick] - 1].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(row[pick] + a)), *(pa.array(cols[f][pick], schema.field(f).type) for f in fields), pa.array(cut, pa.binary())], ["id", *fields, "words"])

    found = joined.mapInArrow(lean(run), f"id {kind}, anchor long, span long, weight long, s int, m int, j int, shards int, words binary")
    return found


def decided(classes: DataFrame, decide: Callable[[list[dict]], Callable[[dict, bool], list[tuple]]], out: str, names: list[str]) -> DataFrame:
    """decide(homes) gives a function of (class, whether it is one of the homes) to intervals of its windows.

    Rows: anchor, span, intervals (array of struct of `out`). Within a task, an anchor's homes come first, then the
    classes at home elsewhere one by one, so a task holds CHUNK classes at most.
    """
    dealt = classes.withColumn("own", F.pmod(F.xxhash64("span"), F.col("shards")).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    dealt = dealt.withColumn("visits", F.col("own") != F.col("shard")).drop("shards", "own")
    dealt = dealt.repartition("anchor", "shard").sortWithinPartitions("anchor", "shard", "visits", "span")
    struct = pa.struct(list(to_arrow_schema(T.StructType.fromDDL(out))))  # ids may be of any type

    def run(batches):
        key, homes, judge = None, [], None
        anchors, spans, found = [], [], []

        def give(row: dict, home: bool) -> None:
            if got := judge(row, home):
                anchors.append(row["anchor"])
                spans.append(row["span"])
                found.append([dict(zip(names, x, strict=True)) for x in got])

        def settle() -> None:
            nonlocal judge
            judge = decide(homes)
            for row in homes:
                give(row, True)

        def batch_out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(anchors, pa.int64()), pa.array(spans, pa.int64()), pa.array(found, pa.list_(struct))], ["anchor", "span", "intervals"])
            anchors.clear(), spans.clear(), found.clear()
            return made

        last = None
        for batch in batches:
            for row in batch.to_pylist():
                now = (row["anchor"], row["shard"])
                if (now, row["span"]) == last:  # rows of equal id and text cut out the same span
                    continue
                last = (now, row["span"])
                if now != key:
                    if homes and judge is None:
                        settle()
                    key, homes, judge = now, [], None
                if not row["visits"]:
                    homes.append(row)
                    continue
                if judge is None:
                    settle()
                give(row, False)
            if len(anchors) > 5000:
                yield batch_out()
        if homes and judge is None:
            settle()
        yield batch_out()
        homes = []
        give_back()

    return dealt.mapInArrow(lean(run), f"anchor long, span long, intervals array<struct<{out}>>")


def intervals_of(numbers: list[int]) -> Iterator[tuple[int, int]]:
    """Ascending numbers as runs from a to b, both included."""
    a = b = None
    for x in numbers:
        if b is not None and x == b + 1:
            b = x
            continue
        if a is not None:
            yield a, b
        a = b = x
    if a is not None:
        yield a, b


def covered(n: int, cuts: list[tuple[int, int]]) -> np.ndarray:
    """Which of n words lie in one of the ranges [a, b)."""
    step = np.zeros(n + 1, np.int64)
    for a, b in cuts:
        step[min(a, n)] += 1
        step[min(b, n)] -= 1
    return np.cumsum(step[:n]) > 0
