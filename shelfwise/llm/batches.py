"""Passing Arrow batches through Python: what is not computed there stays as it came, nulls and types included."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType, _parse_datatype_string


def with_computed(df: DataFrame, added: str, arrays: Callable[[pa.RecordBatch], list], drop: list[str] = ()) -> DataFrame:
    """``df`` without ``drop`` and with the columns ``added`` ("name type, ..."), filled by ``arrays`` batch by batch.

    ``arrays`` gets a whole batch and returns one list or Arrow array for each
    added column; an added column replaces one of the same name.
    """
    new = _parse_datatype_string(added)
    gone = {*drop, *new.names}
    kept = [f for f in df.schema.fields if f.name not in gone]
    types = [_arrow_type(f) for f in new.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(arrays(batch), types)]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *values],
                                             names=[*(f.name for f in kept), *new.names])

    return df.mapInArrow(run, StructType([*kept, *new.fields]))


def _arrow_type(field: StructField) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(field.dataType)


def texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[str | None]:
    """The texts of a batch one by one, so that only one is held as a Python string."""
    return (t.as_py() for t in batch.column(name))
