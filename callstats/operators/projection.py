"""Fixed output layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType, renames: dict[str, str] | None = None) -> DataFrame:
    """Select ``schema``'s columns in order, renamed and cast to its types.

    A value that does not fit its type becomes NULL, in any ANSI mode;
    fractions are cut off. ``renames`` maps output name to input column where they differ.
    """
    renames = renames or {}
    return df.select(
        *[F.col(renames.get(f.name, f.name)).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )
