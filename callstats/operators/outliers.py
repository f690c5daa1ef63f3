"""Per-key k-sigma outlier detection.

A row is an outlier when ``|value - mean| > k * stddev`` of its key, with the
sample standard deviation; keys whose stddev is 0 or undefined yield nothing.

Plan (both strategies): one partial+final aggregation for the per-key stats,
a materialised stats table, then the rows are joined to it. No group is ever
gathered in one task, which is what a per-key window or a grouped Python
function would do for a hot key.

Only keys that hold an outlier are kept in the stats table. Within a key the
largest deviation from the mean is at its minimum or maximum, and the same
floating-point test applied to those two values decides whether any row can
pass (``fl(|v - mean|)`` is monotonic in ``v``). So the lookup side is bounded
by the keys that appear in the output, not by all keys, and it is usually
small enough to broadcast: the rows then never move.

``strategy="auto"``  stats broadcast when their row count is small, otherwise
                     a sort-merge join that AQE skew-splits on the row side.
                     Before it, rows within the bounds of their key's hash cell
                     are dropped in place (``beyond_bounds``).
``strategy="split"`` as ``auto`` while the stats can be broadcast; beyond that the
                     keys above ``heavy_threshold`` rows (if they are at most
                     ``max_heavy_keys``) are judged against their own broadcast
                     and do not move, and the other rows take the sort-merge
                     join. Either way the input is read twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from callstats.operators.heavy import cell_of
from callstats.operators.lookup import DEFAULT_BROADCAST_ROWS, sided, size_columns
from callstats.operators.materialize import materialize
from callstats.schema import HEAVY_THRESHOLD, SIGMAS

STRATEGIES = ("auto", "split")

# Upper bound on the number of keys the split strategy broadcasts.
DEFAULT_MAX_HEAVY_KEYS = 10_000


def can_exceed(n: Column, k: float) -> Column:
    """False when a group of ``n`` values cannot hold a k-sigma outlier.

    With the sample stddev no value is farther than ``(n - 1) / sqrt(n)``
    stddevs from its group mean, so groups at or under ``k`` are dropped before
    the join (for k = 3 that is every group below 11 values). The relative
    margin keeps groups that are within float rounding of the bound.
    """
    return (n - F.lit(1)) > F.lit(k * (1 - 1e-9)) * F.sqrt(n.cast("double"))


# Names of the statistics while they are joined to the rows, whose columns may
# have any name.
MEAN, SPREAD = "_zscore_mean", "_zscore_spread"


def _stats(rows: DataFrame, key: str, value: str) -> DataFrame:
    return rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count(value).alias("_n"),
        F.avg(value).alias(MEAN),
        F.stddev_samp(value).alias(SPREAD),
        F.min(value).alias("_min"),
        F.max(value).alias("_max"),
    )


def _deviates(value: str, k: float) -> Column:
    return F.abs(F.col(value) - F.col(MEAN)) > F.lit(k) * F.col(SPREAD)


def _candidates(k: float) -> Column:
    """Keys with at least one outlier: spread, enough values, and an extreme
    value that passes the same test the rows get."""
    spread = (F.col(SPREAD) > F.lit(0.0)) & can_exceed(F.col("_n"), k)
    return spread & (_deviates("_max", k) | _deviates("_min", k))


def _loosest(k: float) -> list[Column]:
    """Aggregates ``low`` and ``high`` of the candidates: every outlier lies below
    the one or above the other. The margin covers float rounding."""
    reach = F.lit(k) * F.col(SPREAD)
    margin = (F.abs(F.col(MEAN)) + reach) * 1e-9
    of = _candidates(k)
    return [
        F.max(F.when(of, F.col(MEAN) - reach + margin)).alias("low"),
        F.min(F.when(of, F.col(MEAN) + reach - margin)).alias("high"),
    ]


#: Most cells of the bounds that are broadcast to the rows of a sort-merge join.
MAX_CELLS = 1 << 20


def bounds_by_cell(stats: DataFrame, key: str, k: float, cells: int) -> DataFrame:
    """Bounds of the candidates per hash of the key: a Bloom filter with one hash
    that also knows between which values its keys have no outlier."""
    return stats.where(_candidates(k)).groupBy(cell_of(key, cells).alias("_cell")).agg(*_loosest(k))


def beyond_bounds(rows: DataFrame, stats: DataFrame, key: str, value: str, k: float, candidates: int) -> DataFrame:
    """The rows that can be outliers by the bounds of their key's cell.

    Joined in place: the cells are at most ``MAX_CELLS`` rows of three numbers,
    whatever the number of keys. With fewer candidates than cells most rows meet
    their own key's bounds or none, so one narrow key lets no others pass.
    """
    cells = min(MAX_CELLS, 1 << max(10, (4 * candidates).bit_length()))
    bounds = bounds_by_cell(stats, key, k, cells).select("_cell", F.col("low").alias("_low"), F.col("high").alias("_high"))
    there = rows.withColumn("_cell", cell_of(key, cells)).join(F.broadcast(bounds), "_cell")
    kept = there.where((F.col(value) < F.col("_low")) | (F.col(value) > F.col("_high")))
    return kept.select(*rows.columns)


def zscore_outliers(
    df: DataFrame,
    key: str,
    value: str,
    keep: list[str] | None = None,
    k: float = SIGMAS,
    strategy: str = "auto",
    heavy_threshold: int = HEAVY_THRESHOLD,
    max_heavy_keys: int = DEFAULT_MAX_HEAVY_KEYS,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    input_rows: Observation | None = None,
    out_mean: str = "mean",
    out_stddev: str = "stddev",
) -> DataFrame:
    """Rows of ``df`` more than ``k`` sample stddevs from their key's mean.

    Returns ``key``, the ``keep`` columns, ``value``, ``out_mean`` and
    ``out_stddev`` (unrounded). Rows with a NULL key or value are never outliers.

    ``input_rows`` receives the number of rows of ``df``, NULL keys included
    (metric ``rows``), and of those without a key or value (``rejected``). It is summed from the per-key counts of the stats
    aggregate in the job that writes the stats to the checkpoint folder, whose
    result stage counts each row once: no extra pass over ``df``.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, got {strategy!r}")
    keep = [c for c in (keep or []) if c not in (key, value)]
    cols = df.select(key, *keep, value)
    rows = cols.where(F.col(key).isNotNull())

    # Stats over every row; the NULL-key group only adds to the row total.
    # The observation sits between the aggregate and the key filter, so the
    # filter stays above it and the total sees all rows.
    all_stats = _stats(cols, key, value)
    if input_rows is not None:
        used = F.when(F.col(key).isNotNull(), F.col("_n")).otherwise(F.lit(0))
        all_stats = all_stats.observe(
            input_rows,
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.col("_rows") - used), F.lit(0)).alias("rejected"),
        )
    is_heavy = F.col("_rows") > F.lit(int(heavy_threshold))
    wanted = _candidates(k) | is_heavy if strategy == "split" else _candidates(k)
    stats = materialize(all_stats.where(F.col(key).isNotNull()).where(wanted))
    found = stats.agg(*size_columns(stats), F.count_if(is_heavy).alias("heavy"), *_loosest(k)).first()
    # Literal bounds on the value: they reach the scan, prune its row groups and
    # keep most rows out of a shuffle. Which rows are outliers is decided below.
    if found["low"] is None:
        rows = rows.where(F.lit(False))
    else:
        rows = rows.where((F.col(value) < F.lit(found["low"])) | (F.col(value) > F.lit(found["high"])))

    lookup = stats.where(_candidates(k)).select(key, MEAN, SPREAD)
    side, fits = sided(lookup, found["rows"], found["bytes"], max_broadcast_rows)
    if fits or strategy == "auto" or found["heavy"] > max_heavy_keys:
        if not fits:
            rows = beyond_bounds(rows, stats, key, value, k, found["rows"])
        hits = rows.join(side, key).where(_deviates(value, k))
    else:
        rows = beyond_bounds(rows, stats, key, value, k, found["rows"])
        # Heavy keys are few: their statistics are broadcast and their rows
        # judged in place, so only outliers of theirs reach the shuffle.
        heavy = stats.where(is_heavy).select(
            F.col(key).alias("_heavy"), F.when(_candidates(k), F.col(MEAN)).alias(MEAN), F.col(SPREAD)
        )
        tagged = rows.join(F.broadcast(heavy), F.col(key) == F.col("_heavy"), "left")
        judged = tagged.where(F.col("_heavy").isNull() | _deviates(value, k)).drop("_heavy")
        light = stats.where(~is_heavy & _candidates(k)).select(
            F.col(key).alias("_light"), F.col(MEAN).alias("_light_mean"), F.col(SPREAD).alias("_light_spread")
        )
        both = judged.join(light.hint("merge"), F.col(key) == F.col("_light"), "left")
        hits = both.select(
            key,
            *keep,
            value,
            F.coalesce(MEAN, "_light_mean").alias(MEAN),
            F.coalesce(SPREAD, "_light_spread").alias(SPREAD),
        ).where(_deviates(value, k))
    return hits.select(key, *keep, value, F.col(MEAN).alias(out_mean), F.col(SPREAD).alias(out_stddev))
