"""The cast fast path of ``parse_timestamp`` equals the formatter path."""

import random

from pyspark.sql import functions as F

from callstats.functions import parse_timestamp


def canonical_strings(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        y = rng.choice([0, 1, 999, 1582, 1970, 2023, 2024, 2100, 9999, rng.randint(0, 9999)])
        s = f"{y:04d}-{rng.randint(0, 19):02d}-{rng.randint(0, 39):02d}T"
        s += f"{rng.randint(0, 29):02d}:{rng.randint(0, 69):02d}:{rng.randint(0, 69):02d}"
        k = rng.choice([0, 0, 1, 3, 6])
        if k:
            s += "." + "".join(rng.choice("0123456789") for _ in range(k))
        out.append(s)
    return out


OTHER = [
    "2024-02-29T10:00:00",
    "2023-02-29T10:00:00",
    "12023-10-01T10:00:00",
    " 2023-10-01T10:00:00",
    "2023-10-01T10:00:00 ",
    "2023-10-01 10:00:00",
    "2023-10-01T10:00:00.1234567",
    "2023-10-01T10:00:00Z",
    "2023-10-01T10:00",
    "2023-10-01",
    "2023-1-01T10:00:00",
    "２０２３-10-01T10:00:00",
    "garbage",
    "",
    None,
]


def test_fast_path_equals_formatters(spark):
    vals = canonical_strings(20000, 5) + OTHER
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    both = df.select(parse_timestamp("t").alias("a"), parse_timestamp("t", fast=False).alias("b"))
    assert both.where(~F.col("a").eqNullSafe(F.col("b"))).count() == 0
    assert both.where("a is not null").count() > 4000
