"""What is left to services: interfaces, with mocks that give the same results everywhere.

A service is a Python callable over a list of values, made once a task by a factory, so clients and models are opened on the
executors and needn't travel. Rows go to it in Arrow batches, and only those that ask for it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts to texts, in order; None leaves a text as it is.
Corrector = Callable[[list[str]], list[str | None]]
#: Pictures to their words: text, confidence, x, y, w, h.
Reader = Callable[[list[bytes]], list[list[tuple[str, float, int, int, int, int]]]]
WORDS = "array<struct<text:string,conf:double,x:int,y:int,w:int,h:int>>"


def mock_corrector() -> Corrector:
    """Takes marks of unreadable characters out."""
    return lambda texts: [t.replace("\ufffd", "") if "\ufffd" in t else None for t in texts]


def mock_reader() -> Reader:
    """One word a picture: how many bytes it has, with a confidence of 100."""
    return lambda pictures: [[(f"bytes {len(p)}", 100.0, 0, 0, 10, 10)] if p else [] for p in pictures]


def _with(rows: DataFrame, given: Column, out: str, kind: str, run: Callable[[list], list]) -> DataFrame:
    """rows with a column out: run()'s result for the values of given that aren't null."""
    names = rows.columns
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rows.schema.fields)}, `{out}` {kind}"

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(len(names)).to_pylist()
            at = [i for i, v in enumerate(values) if v is not None]
            made: list = [None] * len(values)
            for i, v in zip(at, run([values[i] for i in at]) if at else [], strict=True):
                made[i] = v
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(made, types[kind])], [*names, out])

    word = pa.struct([("text", pa.string()), ("conf", pa.float64()), *((c, pa.int32()) for c in "xywh")])
    types = {"string": pa.string(), WORDS: pa.list_(word)}
    return rows.select("*", given.alias("__given")).mapInArrow(walk, schema)


def once(factory: Callable[[], Callable]) -> Callable[[list], list]:
    """The factory's callable, made when a task first needs it."""
    made: list[Callable] = []

    def run(values: list) -> list:
        if not made:
            made.append(factory())
        return made[0](values)

    return run


def corrected(rows: DataFrame, asks: Column, text: str = "text", factory: Callable[[], Corrector] = mock_corrector) -> DataFrame:
    """Texts of rows that ask are corrected; corrected says which changed."""
    own = _with(rows, F.when(asks, F.col(text)), "__new", "string", once(factory))
    changed = F.col("__new").isNotNull() & (F.col("__new") != F.col(text))
    return own.withColumn("corrected", F.coalesce(changed, F.lit(False))).withColumn(text, F.when(F.col("corrected"), F.col("__new")).otherwise(F.col(text))).drop("__new")


def recognised(pictures: DataFrame, content: str = "content", factory: Callable[[], Reader] = mock_reader) -> DataFrame:
    """Pictures with words, as metrics.lines_of_words() and metrics.adjudicated() take them once they are exploded."""
    def words(values: list) -> list:
        return [[dict(zip(("text", "conf", "x", "y", "w", "h"), w, strict=True)) for w in own] for own in run(values)]

    run = once(factory)
    return _with(pictures, F.col(content), "words", WORDS, words)
