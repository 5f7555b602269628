"""Texts to rows in Arrow batches: what a function finds in many texts at once, beside the keys of the row each came from."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

Found = tuple[Sequence[int], dict[str, Sequence]]


def expand(df: DataFrame, columns: dict[str, str], keys: Sequence[str], schema: str, find: Callable[[dict[str, list]], Found], rows: int = 128) -> DataFrame:
    """keys and the columns of schema, a row for each find. columns: argument of find -> column of df. find gives, of the lists of
    `rows` rows, the row that each find is from, and the finds' columns. Keys never leave Arrow."""
    kind = T.StructType([df.schema[k] for k in keys] + T._parse_datatype_string(schema).fields)
    arrow = to_arrow_schema(kind)
    names = [f"__{n}" for n in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, rows):
                part = b.slice(at, rows)
                of, found = find({n: part.column(len(keys) + i).to_pylist() for i, n in enumerate(columns)})
                take = pa.array(of, pa.int32())
                held = [part.column(i).take(take).cast(arrow.field(i).type) for i in range(len(keys))]
                yield pa.RecordBatch.from_arrays([*held, *[pa.array(found[f.name], f.type) for f in list(arrow)[len(keys) :]]], schema=arrow)

    return df.select(*[F.col(k) for k in keys], *[F.col(c).alias(n) for n, c in zip(names, columns.values())]).mapInArrow(run, kind)
