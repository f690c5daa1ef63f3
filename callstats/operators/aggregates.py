"""Grouped and global aggregates.

All of them plan as partial (map-side) + final hash aggregates, so a key with a
third of all rows still shuffles one row per map task, not its rows.

``top_by_sum`` and ``total`` can also report how many input rows they read
(``input_rows``, metric ``rows``). The count is carried by the aggregate itself
(a per-group row count) and observed where Spark applies metric updates once
per partition, even when tasks are re-run after an executor loss: in a result
stage. So the input is read once, and the count is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from callstats.functions.money import exact_sum
from callstats.schema import TOP_N

# Names of the per-group counts carried for ``input_rows``: rows, and rows with
# a value the aggregate can use.
ROWS_SEEN, ROWS_USED = "_rows_seen", "_rows_used"


def count_rows(used: str) -> list[Column]:
    """Aggregates behind ``input_rows``: rows, and rows in which ``used`` is not NULL."""
    return [F.count(F.lit(1)).alias(ROWS_SEEN), F.count(used).alias(ROWS_USED)]


def observe_rows_seen(df: DataFrame, input_rows: Observation) -> DataFrame:
    """Attach ``input_rows`` as the sums of the per-group counts of ``df``: ``rows``,
    and of these ``rejected``, which had no usable value."""
    rejected = F.sum(F.col(ROWS_SEEN) - F.col(ROWS_USED))
    return df.observe(
        input_rows,
        F.coalesce(F.sum(ROWS_SEEN), F.lit(0)).alias("rows"),
        F.coalesce(rejected, F.lit(0)).alias("rejected"),
    )


def top_by_sum(
    df: DataFrame,
    key: str,
    value: str,
    n: int = TOP_N,
    out_key: str | None = None,
    out_value: str = "total",
    input_rows: Observation | None = None,
) -> DataFrame:
    """The ``n`` keys with the largest exact sum of ``value``.

    Ties are broken by key (ascending, NULL last) so the cut at rank ``n`` is
    deterministic. Sort + limit plans as a distributed top-k
    (``TakeOrderedAndProject``): each task keeps its best ``n``.

    With ``input_rows`` the counts carried by all per-key sums are added up in a
    scalar subquery and observed above the top-k, in the result stage. Both read
    the same shuffled partial sums (one reused exchange): one pass over ``df``,
    nothing written. The subquery's value comes from finished shuffle data, so a
    re-run task counts nothing twice.
    """
    out_key = out_key or key
    aggs = [exact_sum(value).alias(out_value)]
    if input_rows is not None:
        aggs += count_rows(value)
    sums = df.groupBy(F.col(key).alias(out_key)).agg(*aggs)
    order = [F.col(out_value).desc_nulls_last(), F.col(out_key).asc_nulls_last()]
    if input_rows is None:
        return sums.orderBy(*order).limit(n)
    # Both sides use every column, so that they plan the same exchange.
    whole = sums.agg(
        F.struct(
            F.sum(ROWS_SEEN).alias("rows"),
            F.sum(F.col(ROWS_SEEN) - F.col(ROWS_USED)).alias("rejected"),
            F.sum(out_value).alias("total"),
        )
    ).scalar()
    top = sums.orderBy(*order).limit(n).withColumn("_whole", whole)
    return top.observe(
        input_rows,
        F.max("_whole.rows").alias("rows"),
        F.max("_whole.rejected").alias("rejected"),
        F.max("_whole.total").alias("total"),
        F.sum(ROWS_SEEN).alias("rows_of_top"),
        F.sum(ROWS_USED).alias("used_of_top"),
    ).select(out_key, out_value)


def total(df: DataFrame, value: str, out: str = "total", input_rows: Observation | None = None) -> DataFrame:
    """One row: the exact sum of ``value`` (NULL on empty input).

    With ``input_rows`` the row count is computed by the same aggregate and
    observed in its final (single-task, result) stage.
    """
    if input_rows is None:
        return df.agg(exact_sum(value).alias(out))
    both = df.agg(exact_sum(value).alias(out), *count_rows(value)).coalesce(1)
    return observe_rows_seen(both, input_rows).select(out)


def count_by(df: DataFrame, keys: list[str], out: str = "count") -> DataFrame:
    """Row count per combination of ``keys``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def group_stats(df: DataFrame, key: str, value: str) -> DataFrame:
    """Per key: row count ``n``, ``mean`` and sample ``stddev`` of ``value``.

    ``stddev`` is NULL for a one-row group and 0.0 for a constant group. NULL
    values are ignored by the mean and stddev but counted in ``n``.
    """
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("stddev"),
    )


def heavy_hitters(df: DataFrame, key: str, threshold: int, out: str = "n") -> DataFrame:
    """Keys with strictly more than ``threshold`` rows, with their row count."""
    return count_by(df, [key], out).where(F.col(out) > F.lit(threshold))


def heavy_group_stats(df: DataFrame, key: str, value: str, threshold: int) -> DataFrame:
    """Mean and sample stddev of the keys with more than ``threshold`` rows.

    One aggregation pass with the count as a HAVING filter; no key list is
    collected. A NULL stddev is reported as 0.0.
    """
    stats = group_stats(df, key, value).where(F.col("n") > F.lit(threshold))
    return stats.select(key, "mean", F.coalesce(F.col("stddev"), F.lit(0.0)).alias("stddev"))
