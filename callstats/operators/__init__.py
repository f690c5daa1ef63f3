"""DataFrame operators: each takes frames and column names, returns a lazy frame."""

from callstats.operators.aggregates import (
    count_by,
    group_stats,
    heavy_group_stats,
    heavy_hitters,
    top_by_sum,
    total,
)
from callstats.operators.heavy import candidate_rows, heavy_hitters_sketched
from callstats.operators.lookup import (
    DEFAULT_BROADCAST_ROWS,
    lookup_join,
    sized_lookup,
    stats_lookup,
)
from callstats.operators.materialize import materialize
from callstats.operators.outliers import STRATEGIES, can_exceed, zscore_outliers
from callstats.operators.partitioning import DEFAULT_BUCKETS, heavy_layout, key_bucket, repartition_by_key, spread_by_key
from callstats.operators.projection import conform

__all__ = [
    "DEFAULT_BROADCAST_ROWS",
    "DEFAULT_BUCKETS",
    "STRATEGIES",
    "can_exceed",
    "candidate_rows",
    "conform",
    "count_by",
    "group_stats",
    "heavy_group_stats",
    "heavy_hitters",
    "heavy_hitters_sketched",
    "heavy_layout",
    "key_bucket",
    "lookup_join",
    "materialize",
    "repartition_by_key",
    "sized_lookup",
    "spread_by_key",
    "stats_lookup",
    "top_by_sum",
    "total",
    "zscore_outliers",
]
