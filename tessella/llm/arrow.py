"""Batches of rows through Python, column-wise by Arrow."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def through(df: DataFrame, make: Callable[[], Callable[[dict[str, list]], dict[str, list]]], schema: str) -> DataFrame:
    """mapInArrow with columns as lists. make() runs once in a task and returns what maps a batch's columns
    to the output's columns, which may have another number of rows."""
    kind = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for b in batches:
            out = f({n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)})
            yield pa.RecordBatch.from_arrays([out[n] if isinstance(out[n], pa.Array) else pa.array(out[n], t) for n, t in zip(arrow.names, arrow.types)], schema=arrow)

    return df.mapInArrow(run, schema)


def lists(flat: np.ndarray, ends: list[int], kind: pa.DataType) -> pa.Array:
    """list<kind> from the values of all rows, one after another, and each row's end."""
    return pa.ListArray.from_arrays(pa.array(np.array([0, *ends], dtype=np.int32)), pa.array(flat, kind))
