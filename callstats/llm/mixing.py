"""Mixing sources to target weights by Pfair scheduling (DataFrame functions only).

Time is cut into slots of one block. A stream with weight w (in units of a
period) releases its j-th block at floor((j-1) / w) and must have placed it by
ceil(j / w). Giving each slot to the released block with the earliest deadline
keeps every stream's number of placed blocks within less than one block of
w times the slots passed. Weights are whole units of a period, so the schedule
repeats, and one period of it, a table of bounded size, places any number of
rows.
"""

from __future__ import annotations

import heapq
import json
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callstats.llm.common import ordered, with_place

#: Slots of a period: the unit in which weights are given (at least one a stream).
PERIOD = 1000
#: Rows of a block.
BLOCK_ROWS = 32
#: The stream of all sources that the weights do not name, NULL included.
OTHER = "*"


def units_of(weights: dict[str, float], period: int = PERIOD) -> dict[str, int]:
    """Weights as whole units that add up to the period (at least the number of
    streams), by largest remainder, each stream at least one."""
    if not weights or any(w <= 0 for w in weights.values()):
        raise ValueError("weights must be positive")
    period = max(period, len(weights))
    total = sum(map(Fraction, weights.values()))
    spare = period - len(weights)
    exact = {s: Fraction(w) / total * spare for s, w in weights.items()}
    units = {s: 1 + int(x) for s, x in exact.items()}
    left = period - sum(units.values())
    for s in sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))[:left]:
        units[s] += 1
    return units


def period_table(units: dict[str, int]) -> list[tuple[str, int, int]]:
    """(stream, block number in the period, slot) of one period, by earliest
    deadline among the released blocks; ties by stream."""
    period = sum(units.values())
    release = {s: [(j * period) // n for j in range(n)] for s, n in units.items()}
    due = {s: [-(-(j + 1) * period // n) for j in range(n)] for s, n in units.items()}
    waiting: list[list] = [[] for _ in range(period)]
    for s, times in release.items():
        for j, t in enumerate(times):
            waiting[t].append((due[s][j], s, j))
    ready, table = [], []
    for slot in range(period):
        for block in waiting[slot]:
            heapq.heappush(ready, block)
        deadline, s, j = heapq.heappop(ready)
        assert slot < deadline
        table.append((s, j, slot))
    return table


def stream_of(source: Column, units: dict[str, int]) -> Column:
    """The stream of a source: itself if it has a weight, else OTHER."""
    return F.when(source.isin([s for s in units if s != OTHER]), source).otherwise(F.lit(OTHER))


def mix(
    rows: DataFrame,
    weights: dict[str, float],
    order: list[str],
    source: str = "source",
    block_rows: int = BLOCK_ROWS,
    period: int = PERIOD,
) -> DataFrame:
    """``rows`` with their place in the mix: stream, block (of the stream, from
    0), slot, release and deadline of the block, and position.

    A stream's rows are taken in ``order`` (rows that tie on it in any order),
    ``block_rows`` at a time; position = slot * block_rows + row in the block.
    Every row is placed exactly once. As long as no stream is used up, each has
    less than one block more or less than its weight; when a stream ends, its
    slots stay empty and the others go on in their proportions. OTHER needs a
    weight of its own; it gets the smallest of ``weights`` if none is given.

    A column of ``rows`` with the name of a result gives way to the result.
    Pass only the columns that are needed: the rows are sorted once by stream
    and order. A hot stream is spread over many partitions by that sort, and
    only one row per partition and stream is gathered for the offsets.
    """
    units = units_of({OTHER: min(weights.values()), **weights}, period)
    total = sum(units.values())
    results = ["stream", "block", "slot", "release", "deadline", "position"]
    carried = [c for c in rows.columns if c.lower() not in results]
    packed = rows.select(
        stream_of(F.col(source), units).alias("stream"), F.struct(*order).alias("_order"), F.struct(*carried).alias("_row")
    )
    stored = with_place(ordered(packed, ["stream", "_order"]))
    parts = stored.groupBy("stream", "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    # A row per partition and stream: the partitions are sorted by stream, so
    # there are at most as many as partitions and weights together.
    before = F.expr("sum(_n) over (partition by stream order by _part) - _n")
    starts = F.broadcast(parts.select("stream", "_part", (before - F.col("_first")).alias("_start")))
    rank = F.col("_start") + F.col("_at")
    n = F.create_map(*[F.lit(x) for s, u in units.items() for x in (s, u)])[F.col("stream")].cast("long")
    ranked = stored.join(starts, ["stream", "_part"]).select(
        "_row", "stream", rank.alias("_rank"), F.floor(rank / block_rows).cast("long").alias("block"), n.alias("_n")
    )
    # One period: as many rows as it has slots.
    entries = [{"s": s, "j": j, "slot_in": slot} for s, j, slot in period_table(units)]
    table = rows.sparkSession.range(1).select(
        F.inline(F.from_json(F.lit(json.dumps(entries)), "array<struct<s:string,j:long,slot_in:long>>"))
    )
    here = (F.col("stream") == F.col("s")) & (F.col("block") % F.col("_n") == F.col("j"))
    slot = F.floor(F.col("block") / F.col("_n")) * total + F.col("slot_in")
    return ranked.join(F.broadcast(table), here).select(
        "_row.*",
        "stream",
        "block",
        slot.alias("slot"),
        F.floor(F.col("block") * total / F.col("_n")).alias("release"),
        F.ceil((F.col("block") + 1) * total / F.col("_n")).alias("deadline"),
        (slot * block_rows + F.col("_rank") % block_rows).alias("position"),
    )
