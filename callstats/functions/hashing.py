"""Deterministic key placement."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def crc32_bucket(key: str | Column, n_buckets: int, null_bucket: int = 0) -> Column:
    """CRC-32 of the key's UTF-8 text, modulo ``n_buckets``, as int.

    Equals ``zlib.crc32(str(key).encode('utf-8')) % n_buckets``. A NULL key
    goes to ``null_bucket``.
    """
    c = F.col(key) if isinstance(key, str) else key
    bucket = F.pmod(F.crc32(F.encode(c.cast("string"), "UTF-8")), F.lit(n_buckets))
    return F.coalesce(bucket, F.lit(null_bucket)).cast("int")
