"""Helpers to run a Python function over Arrow batches inside Spark tasks."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
BATCH_BYTES = 8 << 20

_KEPT: dict[Hashable, object] = {}


def worker_kept(key: Hashable, make: Callable[[], object]) -> object:
    """What an operator keeps in a worker from task to task; whatever another operator has kept there goes."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose Arrow batches hold ``BATCH_BYTES`` or one row from now on."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def with_values(
    df: DataFrame, reads: list[str], added: str | StructType, start: Callable[[], Callable[..., list]], keep: list[str]
) -> DataFrame:
    """The columns ``keep`` of ``df`` and the added ones, one output row per input row.

    ``start()`` runs once per task and returns the row function, which takes the values of the columns
    ``reads`` and returns those of the added columns. An added column of a kept one's name takes its
    place. Only the columns read become Python objects, a few hundred rows at a time; the others
    pass as they are, and none is sent twice.
    """
    new = StructType.fromDDL(added) if isinstance(added, str) else added
    sent = list(dict.fromkeys([*reads, *keep]))
    place = {c: i for i, c in enumerate(sent)}
    types = {f.name: f.type for f in to_arrow_schema(new)}
    names = [*keep, *(c for c in new.names if c not in keep)]
    out = StructType([new[c] if c in types else df.schema[c] for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = start()
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                values = [row(*x) for x in zip(*(part.column(place[c]).to_pylist() for c in reads))]
                made = {c: pa.array(v, type=types[c]) for c, v in zip(new.names, zip(*values))}
                yield pa.RecordBatch.from_arrays([made[c] if c in made else part.column(place[c]) for c in names], names)

    return small_batches(df).select(*sent).mapInArrow(run, out)


def map_rows(df: DataFrame, schema: str | StructType, start: Callable[[], Callable[[list], list]]) -> DataFrame:
    """One output row per input row: ``start()`` runs once per task and returns the row function.

    The row function takes the values of a row and returns the values of the output
    columns. Whole texts stay with their row; only one batch is held at a time.
    """
    out = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = start()
        for batch in batches:
            columns = [column.to_pylist() for column in batch.columns]
            for begin in range(0, batch.num_rows, 1024):
                part = [row(*values) for values in zip(*(c[begin : begin + 1024] for c in columns))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(zip(*part), arrow)], schema=arrow
                )

    return df.mapInArrow(run, out)


def emit(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def word_count(text: str) -> F.Column:
    """Words of a text column between ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
