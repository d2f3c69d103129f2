"""Looking columns up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def column_type(df: DataFrame, column: str) -> T.DataType:
    """Type of a column or nested field, resolved as ``F.col`` resolves it."""
    if column in df.columns and "." not in column:
        return df.schema[column].dataType
    return df.select(column).schema[0].dataType
