"""Steps that depend on earlier ones of their group, one group of rows at a time, many groups a batch.

The rows are dealt by key and sorted, and a task walks its groups in plain Python over Arrow columns, which costs no
per-group call between the JVM and Python. A group (a page, a table) is held in memory, and is small by nature.
"""

from __future__ import annotations

import math
from collections import namedtuple
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

ROWS = 20_000


def dealt(rows: DataFrame, *keys: str, mb: float = 8) -> DataFrame:
    """The rows by key, over as many partitions as the session's setting says, or one for each `mb` MB of the files they are
    read from, if those are more. Spark doesn't join such partitions; its own rule joins those that are small while compressed,
    and one task then sorts a share of the rows that grows with the input."""
    leaves = rows._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    read = sum(x for x in sizes if x < 1 << 50)  # more is Spark's word for not known
    return rows.repartition(max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(read / (mb * 1e6))), *keys)


def by_group(rows: DataFrame, keys: list[str], order: list[str], run: Callable[[list], Iterable[tuple]], schema: str) -> DataFrame:
    """run: from a group's rows (named tuples, in the given order) to rows of the schema, whose first columns are the keys,
    which run leaves out."""
    names, out = rows.columns, to_arrow_schema(T.StructType.fromDDL(schema))
    at = [names.index(k) for k in keys]

    def walk(batches):
        row_of = namedtuple("Row", names)
        held, key, made = [], None, []
        for batch in batches:
            for values in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                now = tuple(values[i] for i in at)
                if held and now != key:
                    made += [key + tuple(x) for x in run(held)]
                    held = []
                    if len(made) >= ROWS:
                        yield emitted(made, out)
                        made = []
                key = now
                held.append(row_of(*values))
        if held:
            made += [key + tuple(x) for x in run(held)]
        yield emitted(made, out)

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(walk, schema)


def emitted(made: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*made, strict=True) if made else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
