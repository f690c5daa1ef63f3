"""Near-duplicates by SimHash: fingerprints, vantage-point trees, components.

1. Every document gets a 64-bit fingerprint over its word shingles.
2. The distinct fingerprints are routed through the top of a vantage-point
   tree to shards. A point within the link distance beyond a boundary is also
   sent, as a guest, to the shard on the other side.
3. Each shard builds its own vantage-point tree, finds every pair within the
   distance by triangle bounds, and emits one link per point of a group that
   it joined, not the pairs.
4. The links of all shards are merged into components by distributed label
   propagation with pointer jumping.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from callstats.llm.common import map_texts
from callstats.operators.materialize import materialize

SEED = 42
#: Distinct fingerprints that a shard is meant to hold, and that are sampled to
#: place the boundaries of the top tree (any boundaries give the same pairs): so
#: many in all, or so many a shard if that is more.
SHARD_POINTS = 1 << 14
SAMPLE_POINTS = 1 << 15
SAMPLE_PER_SHARD = 8
LEAF_POINTS = 64


def fingerprint(text: str | bytes, shingle: int = 3) -> int:
    """SimHash of the text, or of its UTF-8 bytes, as an unsigned integer.

    A-Z are lower-cased, words are split at space, tab, line feed, vertical
    tab, form feed and carriage return. Every ``shingle``-word sequence counts,
    repeats included; a shorter text is one shingle, a text without words has
    fingerprint 0. A bit is set if it is set in over half of the hashes. Bytes
    that are not valid UTF-8 are hashed as they are.
    """
    raw = text.encode("utf-8") if isinstance(text, str) else text
    # bytes.lower and bytes.split know ASCII only, which is what is asked for.
    words = raw.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    grams = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
    n = len(words) - shingle + 1
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, n, 1 << 16):
        block = min(1 << 16, n - start)
        h = np.fromiter((xxhash.xxh64_intdigest(next(grams), SEED) for _ in range(block)), np.uint64, block)
        ones += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", shingle: int = 3) -> DataFrame:
    """``keep`` and ``fp``, the fingerprint as a signed long. NULL texts count as
    empty; an empty table gives no rows. Only ``keep`` (any names but ``fp``) and
    ``text`` are read. A text that is not valid UTF-8 counts byte by byte."""

    def signed(texts: list[bytes]) -> list[pa.Array]:
        fps = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
        return [pa.array(fps.view(np.int64))]

    return map_texts(docs, keep, text, signed, [StructField("fp", LongType())], as_bytes=True)


def split(points: np.ndarray) -> tuple[np.uint64, int, np.ndarray] | None:
    """Vantage point, median distance and all distances; None if no vantage
    point tried separates the points."""
    for k in (0, len(points) // 2, len(points) - 1):
        d = np.bitwise_count(points ^ points[k])
        cut = int(np.partition(d, len(d) // 2)[len(d) // 2])
        while cut >= 0 and not (0 < (n := int((d <= cut).sum())) < len(d)):
            cut -= 1
        if cut >= 0 and 0 < n < len(d):
            return points[k], cut, d
    return None


def grow_top(sample: np.ndarray, levels: int, first: int = 0):
    """The top tree over a sample: nested (point, cut, near, far), where points
    at most ``cut`` away from ``point`` are near; a leaf is a shard number."""
    cutting = split(sample) if levels and len(sample) > 1 else None
    if cutting is None:
        return first
    v, cut, d = cutting
    near = grow_top(sample[d <= cut], levels - 1, first)
    far = grow_top(sample[d > cut], levels - 1, first + (1 << (levels - 1)))
    return v, cut, near, far


def route(tree, points: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, row numbers of its points, whether each is at home there).

    Of two points within ``radius`` of each other on different sides of a
    boundary, the far one is also sent to the near side, if it is at most
    ``radius`` beyond the cut: by the triangle inequality no others can pair
    up. A guest goes to every side its ball touches. So each pair meets in the
    home shard of at least one of its points.
    """
    stack = [(tree, np.arange(len(points)), np.ones(len(points), dtype=bool))]
    while stack:
        node, rows, home = stack.pop()
        if not len(rows):
            continue
        if isinstance(node, int):
            yield node, rows, home
            continue
        point, cut, near_side, far_side = node
        d = np.bitwise_count(points[rows] ^ point).astype(np.int16)
        near, far = d <= cut, d > cut
        to_near = d <= cut + radius
        to_far = (far & home) | (~home & (d > cut - radius))
        stack.append((near_side, rows[to_near], home[to_near] & near[to_near]))
        stack.append((far_side, rows[to_far], home[to_far]))


def components_of(n: int, i: np.ndarray, j: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """Smallest index reachable from each of n points over links (i, j)."""
    label = np.arange(n) if label is None else label
    while True:
        a, b = label[i], label[j]
        differ = a != b
        if not differ.any():
            return label
        np.minimum.at(label, np.maximum(a, b)[differ], np.minimum(a, b)[differ])
        while not np.array_equal(up := label[label], label):
            label = up


def link_shard(points: np.ndarray, home: np.ndarray, radius: int) -> np.ndarray:
    """Group label (an index) of each point of a shard, after joining all pairs
    within ``radius`` of which at least one point is at home.

    The vantage-point tree is walked for all points at once. Links are folded
    into the labels as they come, so a large group of near copies is never
    held as pairs.
    """
    n = len(points)
    label = np.arange(n)
    order = np.argsort(~home, kind="stable")  # homes first
    points, home = points[order], home[order]
    mine = np.flatnonzero(home)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    # Each entry: the home points of a subtree, and guests that may pair with them.
    stack = [(mine, np.flatnonzero(~home))]
    while stack:
        own, guests = stack.pop()
        if not len(own):
            continue
        cutting = split(points[own]) if len(own) > LEAF_POINTS else None
        if cutting is None:
            i, j = _leaf(points, own, guests, radius)
            held.append((i, j))
            size += len(i)
            if size > 1 << 20:
                label = components_of(n, *map(np.concatenate, zip(*held)), label)
                held, size = [], 0
            continue
        v, cut, d = cutting
        d = d.astype(np.int16)
        near, far = own[d <= cut], own[d > cut]
        g = np.bitwise_count(points[guests] ^ v).astype(np.int16)
        stack.append((near, np.concatenate([guests[g <= cut + radius], own[(d > cut) & (d <= cut + radius)]])))
        stack.append((far, guests[g > cut - radius]))
    if held:
        label = components_of(n, *map(np.concatenate, zip(*held)), label)
    out = np.empty(n, dtype=np.int64)
    out[order] = order[label]
    return out


def _leaf(points: np.ndarray, own: np.ndarray, guests: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links from the points of a leaf to each other and to its guests, which
    are compared in blocks."""
    found_i, found_j = [], []
    both = np.concatenate([own, guests])
    for a in range(0, len(own), 1024):
        mine = own[a : a + 1024]
        for b in range(0, len(both), 4096):
            other = both[b : b + 4096]
            i, j = np.nonzero(np.bitwise_count(points[mine][:, None] ^ points[other][None, :]) <= radius)
            i, j = mine[i], other[j]
            keep = i != j
            found_i.append(i[keep])
            found_j.append(j[keep])
    return np.concatenate(found_i), np.concatenate(found_j)


def near_links(distinct: DataFrame, radius: int, shard_points: int = SHARD_POINTS) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that join exactly the
    groups reachable by steps of at most ``radius`` bits.

    The top tree is grown on the driver from a sample of ``SAMPLE_POINTS``
    fingerprints, or ``SAMPLE_PER_SHARD`` a shard if that is more (8 bytes each:
    a 2,000th part of the fingerprints), and broadcast; it has about one node per
    ``shard_points`` fingerprints, so shards keep their size in any table.
    """
    spark = distinct.sparkSession
    n = distinct.count()
    levels = max(0, int(np.ceil(np.log2(max(n, 1) / shard_points))))
    wanted = max(SAMPLE_POINTS, SAMPLE_PER_SHARD << levels) if levels else 0
    sample = distinct.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(wanted).toArrow()
    points = sample.column(0).to_numpy().astype(np.int64).view(np.uint64)
    tree = spark.sparkContext.broadcast(grow_top(points, levels))
    names = ["shard", "fp", "home"]

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for shard, rows, home in route(tree.value, fps, radius):
                cols = [pa.array(np.full(len(rows), shard, np.int32)), pa.array(fps[rows].view(np.int64)), pa.array(home)]
                yield pa.RecordBatch.from_arrays(cols, names)

    def linked(table: pa.Table) -> pa.Table:
        # Rows arrive in any order; sorted, a re-run task gives the same links.
        table = table.sort_by("fp")
        fps = table.column("fp").to_numpy()
        label = link_shard(fps.view(np.uint64), table.column("home").to_numpy(), radius)
        moved = np.flatnonzero(label != np.arange(len(label)))
        return pa.table({"a": fps[moved], "b": fps[label[moved]]})

    sent = distinct.select("fp").mapInArrow(routed, "shard int, fp long, home boolean")
    return sent.groupBy("shard").applyInArrow(linked, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable over ``links`` (a, b), for
    every node that has a link.

    Each round takes the smallest label among a node and its neighbours, then
    the label of that label. Rounds are checkpointed and end when nothing
    changes; pointer jumping keeps their number logarithmic on chains. ``links``
    are stored first: computed once for each direction, they could name other
    representatives each time, and a link would hold one way only.
    """
    links = materialize(links)
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    both = materialize(both)
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")))
    while True:
        n = labels.select(F.col("node").alias("b"), F.col("label").alias("other"))
        lower = both.join(n, "b").groupBy(F.col("a").alias("node")).agg(F.min("other").alias("other"))
        least = labels.join(lower, "node").select("node", "label", F.least("label", "other").alias("low"))
        up = labels.select(F.col("node").alias("low"), F.col("label").alias("up"))
        jumped = least.join(up, "low").select("node", F.least("low", "up").alias("next"), "label")
        after = materialize(jumped)
        changed = after.where("next <> label").limit(1).count()
        labels = after.select("node", F.col("next").alias("label"))
        if not changed:
            return labels


def near_duplicates(
    docs: DataFrame,
    shingle: int = 3,
    radius: int = 3,
    shard_points: int = SHARD_POINTS,
    keep: list[str] | None = None,
) -> DataFrame:
    """``keep`` columns (doc_id by default), fp, component and component_id of
    every row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id reachable over links of at most
    ``radius`` differing bits, the document's own included; component is the
    smallest fingerprint. Equal fingerprints are one point, so copies cost one
    pre-aggregated row each map task; texts without words (NULL and empty too)
    share fingerprint 0. NULL doc_ids are no candidates for component_id; a
    group of them only has a NULL one.
    """
    hashed = materialize(fingerprints(docs, keep or ["doc_id"], shingle=shingle))
    points = materialize(hashed.groupBy("fp").agg(F.min("doc_id").alias("first")))
    labels = components(near_links(points, radius, shard_points))
    grouped = points.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("label", "fp")
    )
    lowest = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    by_point = grouped.join(lowest, "component").select("fp", "component", "component_id")
    return hashed.join(by_point, "fp").select(*(keep or ["doc_id"]), "fp", "component", "component_id")
