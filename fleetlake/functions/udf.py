"""Python functions on a column, for what built-in functions cannot say."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def map_elements(column: Column, fn: Callable[[Any], Any], return_type: T.DataType) -> Column:
    """Apply ``fn`` to every non-null value; nulls stay null.

    Values travel in Arrow batches, and ``fn`` is called once per distinct value of a batch, so
    it must depend on its argument alone. Values of nested types are handed over one by one.
    """
    arrow_type = to_arrow_type(return_type)

    def mapped(values):
        def results(items: list) -> pa.Array:
            return pa.array([None if v is None else fn(v) for v in items], arrow_type)

        if pa.types.is_nested(values.type):
            return results(values.to_pylist())
        coded = values.dictionary_encode()
        return results(coded.dictionary.to_pylist()).take(coded.indices)

    # ArrowEvalPython hands over plain Arrow arrays.
    mapped.__annotations__ = {"values": pa.Array, "return": pa.Array}
    return F.arrow_udf(mapped, return_type)(column)
