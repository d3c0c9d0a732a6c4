"""Row functions over Arrow batches, for what built-in expressions cannot say."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import batched
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def map_rows(df: DataFrame, columns: list[str], schema: str | T.StructType, make: Callable[[], Callable[..., Any]], each: int = 512) -> DataFrame:
    """Apply a generator of tuples over column lists, batch by batch, through Arrow.

    `make()` runs once a task and gives `f(*column_lists) -> iterable of tuples` in the order of `schema`.
    At most `each` rows are Python objects at a time; results are sent in batches of some thousand rows.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, held = make(), []
        for big in batches:
            for at in range(0, big.num_rows, each):
                b = big.slice(at, each)
                held.extend(f(*(c.to_pylist() for c in b.columns)))
                if len(held) >= 4096:
                    yield to_batch(held, arrow)
                    held = []
        if held:
            yield to_batch(held, arrow)

    return df.select(*columns).mapInArrow(run, schema)


def fold_tasks(df: DataFrame, columns: list[str], schema: str | T.StructType, make: Callable[[], tuple[Callable[..., bool], Callable[[], Iterable[tuple]]]], each: int = 512) -> DataFrame:
    """Sums over the rows of a task: `make()` gives `add(*column_lists)`, called on at most `each` rows at a time, and
    `drain()`, which gives what was summed as tuples and starts afresh.

    It is drained at the end of the task, and before that whenever `add` says that enough is held.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        add, drain = make()
        for big in batches:
            for at in range(0, big.num_rows, each):
                if add(*(c.to_pylist() for c in big.slice(at, each).columns)):
                    yield from (to_batch(list(x), arrow) for x in batched(drain(), 8192))
        yield from (to_batch(list(x), arrow) for x in batched(drain(), 8192))

    return df.select(*columns).mapInArrow(run, schema)


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)
