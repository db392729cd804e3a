"""Restricting a frame to a set of keys.

Operators of the reference take user ids, movie ids, titles, genres or years from
the command line. Here such a selection is either

* ``None``: no restriction (all keys);
* a scalar or a Python collection of any length and of any mixture of types: every key is first
  read as a value of the column (:func:`as_column_value`), then a short list becomes ``IN``,
  which Catalyst pushes into the Parquet/CSV scan as a data filter, and a long one a frame; or
* a one-column ``DataFrame`` of any size: a ``left_semi`` join. Spark keeps it a
  sort-merge semi join unless the runtime size of the key side is under the AQE
  broadcast threshold, so no unchecked broadcast happens.
"""

from __future__ import annotations

import math
from decimal import Decimal, InvalidOperation
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Keys up to here become an IN list, which reaches the scan; a longer list becomes a
# one-column frame, as a plan of very many literals is slow to build. Both give the same rows.
INLINE_KEYS = 200

# None, a scalar, a collection of scalars, or a one-column DataFrame.
Keys = Any


def _as_list(keys: Any) -> list[Any]:
    if isinstance(keys, (str, bytes, int, float)):
        return [keys]
    return list(keys)


def _whole(key: Any) -> int | None:
    """The integer that ``key`` stands for: 7, 7.0, "7" and " 7 " are 7; 7.5 and "x" are none."""
    try:
        number = Decimal(key.strip()) if isinstance(key, str) else Decimal(key)
    except (InvalidOperation, TypeError, ValueError):
        return None
    return int(number) if number.is_finite() and number == number.to_integral_value() else None


def as_column_value(key: Any, kind: T.DataType) -> Any:
    """``key`` as a value of a column of type ``kind``, or None if it is no such value.

    Numbers may come as text and text as numbers, whatever the length of the key list: keys of
    integral columns must be whole and in range, those of floating columns numbers; a string
    column takes text as it is and numbers by their shortest text. Other types take keys as they are.
    """
    if key is None:
        return None
    if isinstance(kind, T.IntegralType):
        whole = _whole(key)
        bits = {"tinyint": 7, "smallint": 15, "int": 31}.get(kind.simpleString(), 63)
        return whole if whole is not None and -(1 << bits) <= whole < (1 << bits) else None
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        try:
            number = float(key)
        except (TypeError, ValueError):
            return None
        return None if math.isnan(number) else number
    if isinstance(kind, T.StringType):
        whole = _whole(key) if isinstance(key, (float, Decimal)) else None
        return str(key if whole is None else whole)
    return key


def restrict(
    df: DataFrame,
    column: str,
    keys: Keys,
    transform=None,
) -> DataFrame:
    """Keep the rows of ``df`` whose ``column`` is one of ``keys``.

    ``transform`` maps each literal key on the driver (e.g. title normalisation);
    for a key DataFrame the caller passes an already normalised column.
    """
    if keys is None:
        return df
    if isinstance(keys, DataFrame):
        if len(keys.columns) != 1:
            raise ValueError(f"key frame must have one column, got {keys.columns}")
        key_col = keys.columns[0]
        key_frame = keys.select(F.col(key_col).alias(column)).where(F.col(column).isNotNull())
        return df.join(key_frame, on=column, how="left_semi")
    values = _as_list(keys)
    if transform is not None:
        values = [transform(v) for v in values]
    kind = df.schema[column].dataType
    values = list(dict.fromkeys(v for v in (as_column_value(v, kind) for v in values) if v is not None))
    if len(values) > INLINE_KEYS:
        frame = df.sparkSession.createDataFrame([(v,) for v in values], T.StructType([T.StructField(column, kind)]))
        return df.join(frame, on=column, how="left_semi")
    return df.where(F.col(column).isin([F.lit(v).cast(kind) for v in values]))
