"""Quality rules: base counts, then robust multivariate outliers.

Per language and source a minimum-covariance-determinant (MCD) estimate of the
transformed statistic vectors is found by concentration steps over all
documents of the group, and documents are rejected by Mahalanobis distance.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from callstats.llm.common import map_texts
from callstats.operators.materialize import materialize

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"

#: Share of a group's documents that the estimate rests on.
CORE_SHARE = 0.75
#: A concentration step that lowers the log determinant by no more than this
#: (rounding of the sums) has settled.
SETTLED = 1e-9
#: Smallest group with an estimate of its own. ``judge_quality`` says by what
#: the documents of smaller groups are judged.
MIN_GROUP = 30
#: Squared distance beyond which a document is rejected: the 0.999 quantile of
#: chi-square with 5 degrees of freedom, so that of the documents that follow
#: their group's shape one in a thousand is.
CUTOFF = 20.515
#: Spread that is added to each dimension. A statistic that is nearly constant
#: in a group (most documents repeat no line) would else reject every document
#: that differs from it at all. Each is small enough that its statistic alone
#: can exceed CUTOFF: x_repeat, which the base bounds by the root of 0.5, has
#: the tightest room.
FLOOR = {"x_len": 0.20, "x_word": 0.10, "x_symbol": 0.035, "x_lines": 0.20, "x_repeat": 0.10}
DIMS = list(FLOOR)
PAIRS = [(i, j) for i in range(len(DIMS)) for j in range(i, len(DIMS))]


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text.

    Words are runs of anything but space and the characters 9 to 13. A line
    counts as repeated if it has a word and an earlier line is equal to it. A
    word is repeated if it stands in a window of 3 words that occurs twice or
    more in the text.
    """
    words = text.encode("utf-8").split()
    n = len(words)
    word_chars = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    dups = 0
    if "\n" in text:
        lines = [x for x in text.split("\n") if x.strip(BLANKS)]
        dups = len(lines) - len(set(lines))
    repeats = 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) < len(windows):
        first: dict = {}
        again = np.zeros(n, dtype=bool)
        for k, w in enumerate(windows):
            at = first.setdefault(w, k)
            if at != k:
                again[at] = again[k] = True
        covered = again.copy()
        covered[1:] |= again[:-1]
        covered[2:] |= again[:-2]
        repeats = int(covered.sum())
    return n, word_chars, symbols, dups, repeats


def counted(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the base counts of every document (NULL text: no words)."""

    def counts(texts: list[str]) -> list[pa.Array]:
        rows = np.array([base_counts(t) for t in texts], dtype=np.int64).reshape(-1, len(COUNTS))
        return [pa.array(rows[:, k]) for k in range(len(COUNTS))]

    return map_texts(docs, keep, "text", counts, [StructField(c, LongType()) for c in COUNTS])


def base_failed() -> Column:
    """Too short, or more than half of the words in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def statistics() -> dict[str, Column]:
    """The statistic vector, on scales that are roughly normal: log length, log
    mean word length, and square roots of the shares of symbols (per word
    character), repeated lines (per 50 words) and repeated words."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    return {
        "x_len": F.log(words),
        "x_word": F.log(chars / words),
        "x_symbol": F.sqrt(F.col("n_symbols") / chars),
        "x_lines": F.sqrt(F.col("n_dup_lines") * 50 / words),
        "x_repeat": F.sqrt(F.col("n_repeat_words") / words),
    }


def _moments(rows: DataFrame, group: list[str]) -> DataFrame:
    """Count, means and covariances of the vectors per group: one pass with
    partial sums, so a hot group costs one row per map task."""
    sums = [F.count(F.lit(1)).alias("n")]
    sums += [F.avg(x).alias(f"m_{x}") for x in DIMS]
    sums += [F.covar_pop(DIMS[i], DIMS[j]).alias(f"c_{i}_{j}") for i, j in PAIRS]
    return rows.groupBy(*group).agg(*sums)


def _weighed(rows: DataFrame, group: list[str]) -> DataFrame:
    """``_moments`` of rows that count ``_w`` each."""
    weight = F.sum("_w")
    sums = [weight.alias("n"), *[(F.sum(F.col("_w") * F.col(x)) / weight).alias(f"m_{x}") for x in DIMS]]
    sums += [(F.sum(F.col("_w") * F.col(DIMS[i]) * F.col(DIMS[j])) / weight).alias(f"c_{i}_{j}") for i, j in PAIRS]
    return (
        rows.groupBy(*group)
        .agg(*sums)
        .withColumns({f"c_{i}_{j}": F.col(f"c_{i}_{j}") - F.col(f"m_{DIMS[i]}") * F.col(f"m_{DIMS[j]}") for i, j in PAIRS})
    )


def _shapes(moments: DataFrame, group: list[str]) -> DataFrame:
    """Per group the means, the inverse of the floored covariance (p_i_j) and
    its log determinant, from a frame with one row per group."""
    means, covs = [f"m_{x}" for x in DIMS], [f"c_{i}_{j}" for i, j in PAIRS]
    inverse = [f"p_{i}_{j}" for i, j in PAIRS]
    k = len(DIMS)
    keep = [*group, "n", *means]
    schema = moments.select(*keep).schema
    for name in [*inverse, "logdet"]:
        schema = schema.add(name, "double")

    def invert(batches):
        for b in batches:
            cov = np.zeros((b.num_rows, k, k))
            for (i, j), c in zip(PAIRS, covs):
                cov[:, i, j] = cov[:, j, i] = b.column(c).to_numpy(zero_copy_only=False)
            cov += np.diag([f * f for f in FLOOR.values()])
            inv = np.linalg.inv(cov)
            logdet = np.linalg.slogdet(cov)[1]
            out = [b.column(c) for c in keep] + [pa.array(inv[:, i, j].copy()) for i, j in PAIRS] + [pa.array(logdet)]
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return moments.select(*keep, *covs).mapInArrow(invert, schema)


def squared_distance() -> Column:
    """Squared Mahalanobis distance of the row's vector to its group's shape."""
    d = [F.col(x) - F.col(f"m_{x}") for x in DIMS]
    total = F.lit(0.0)
    for i, j in PAIRS:
        total = total + (1 if i == j else 2) * d[i] * d[j] * F.col(f"p_{i}_{j}")
    return F.greatest(total, F.lit(0.0))


def _with_shape(rows: DataFrame, shapes: DataFrame, group: list[str], how: str = "inner") -> DataFrame:
    right = shapes.select(*[F.col(c).alias(f"_of{c}" if c in group else c) for c in shapes.columns])
    on = [F.col(g).eqNullSafe(F.col(f"_of{g}")) for g in group]
    return rows.join(right, on, how).drop(*[f"_of{g}" for g in group])


def _first(name: str, columns: list[str]) -> list[str]:
    return [name, *[c for c in columns if c != name]]


#: Distances are ranked by the bin of their logarithm, this many bins a factor e.
BINS = 64


def _concentrate(rows: DataFrame, shapes: DataFrame, group: list[str]) -> DataFrame:
    """One concentration step from each start (``_start`` of ``shapes``): the
    moments of each group's CORE_SHARE nearest documents. The share is cut at a
    bin of the distance (of width 1/BINS in its logarithm), and the documents in
    the last bin count in part, each as much, so that the step does not depend
    on the order of the rows and cores of all steps weigh the same."""
    near = _with_shape(rows, shapes, group).withColumn(
        "_bin", F.floor(F.log(squared_distance() + 1e-6) * BINS).cast("int")
    )
    by = [*group, "_start"]
    bins = near.groupBy(*by, "_bin").agg(F.count(F.lit(1)).alias("_c"))
    over = Window.partitionBy(*by)
    running = F.sum("_c").over(over.orderBy("_bin"))
    total = F.sum("_c").over(over)
    cuts = (
        bins.withColumns({"_upto": running, "_total": total})
        .where(F.col("_upto") >= F.ceil(CORE_SHARE * F.col("_total")))
        .groupBy(*by)
        .agg(F.min(F.struct(F.col("_bin").alias("_cut"), "_upto", "_c", "_total")).alias("s"))
        .select(*by, "s.*")
    )
    core = _with_shape(near.select(*by, *DIMS, "_bin"), cuts, by).where("_bin <= _cut")
    last = (F.ceil(CORE_SHARE * F.col("_total")) - F.col("_upto") + F.col("_c")) / F.col("_c")
    return _shapes(_weighed(core.withColumn("_w", F.when(F.col("_bin") < F.col("_cut"), 1.0).otherwise(last)), by), by)


def _lower(before: DataFrame, after: DataFrame, by: list[str]) -> DataFrame:
    """Of each key's shapes the one with the smaller determinant; ``_falls`` if
    that is the later one, by more than rounding."""
    columns = [c for c in before.columns if c not in by]
    stages = before.withColumn("_late", F.lit(0)).unionByName(after.withColumn("_late", F.lit(1)))
    of = [F.min(F.when(F.col("_late") == k, F.col("logdet"))) for k in (0, 1)]
    least = F.min(F.struct(F.col("logdet").alias("_det"), *_first("_late", columns)))
    found = stages.groupBy(*by).agg(least.alias("s"), F.coalesce(of[1] < of[0] - SETTLED, F.lit(False)).alias("_falls"))
    return found.select(*by, *[f"s.{c}" for c in columns], "_falls")


def mcd_shapes(rows: DataFrame, group: list[str]) -> DataFrame:
    """MCD location and shape per group, from all its rows.

    Two starts: the classical moments, and the spread around the medians (by
    percentile of each dimension, each scaled by its quartile range). From both,
    concentration steps go on, for the groups and starts whose determinant still
    falls, until none does; per group the estimate with the smallest determinant
    stays. Covariances are scaled up by the core's consistency factor.
    """
    rows = materialize(rows.select(*group, *DIMS))
    classical = _shapes(_moments(rows, group), group)
    quart = [F.percentile_approx(x, [0.25, 0.5, 0.75], 1000).alias(f"q_{x}") for x in DIMS]
    spread = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), *quart)
    robust = _shapes(
        spread.select(
            *group,
            "n",
            *[F.col(f"q_{x}")[1].alias(f"m_{x}") for x in DIMS],
            *[
                (F.pow((F.col(f"q_{DIMS[i]}")[2] - F.col(f"q_{DIMS[i]}")[0]) / 1.349, 2) if i == j else F.lit(0.0)).alias(
                    f"c_{i}_{j}"
                )
                for i, j in PAIRS
            ],
        ),
        group,
    )
    starts = classical.withColumn("_start", F.lit(0)).unionByName(robust.withColumn("_start", F.lit(1)))
    both = materialize(_concentrate(rows, starts, group).withColumn("_falls", F.lit(True)))
    # One row a group and start.
    while both.where("_falls").limit(1).count():
        after = _concentrate(rows, both.where("_falls").drop("_falls"), group)
        both = materialize(_lower(both.drop("_falls"), after, [*group, "_start"]))
    both = both.drop("_falls")
    columns = [c for c in both.columns if c not in group]
    best = both.groupBy(*group).agg(F.min(F.struct(F.col("logdet").alias("_det"), *_first("_start", columns))).alias("s"))
    return best.select(*group, *[f"s.{c}" for c in columns if c != "_start"])


def _chi2_cdf(x: float, degrees: int) -> float:
    """Chi-square distribution function for an odd number of degrees."""
    total = math.erf(math.sqrt(x / 2))
    term = math.sqrt(2 * x / math.pi) * math.exp(-x / 2)
    for k in range(1, degrees, 2):
        total -= term
        term *= x / (k + 2)
    return total


#: Consistency factor of the covariance of the nearest CORE_SHARE of a normal
#: sample in 5 dimensions; 6.6257 is the 0.75 quantile of chi-square with 5
#: degrees of freedom.
CONSISTENCY = CORE_SHARE / _chi2_cdf(6.6257, 7)


def judge_quality(docs: DataFrame, group: tuple[str, ...] = ("lang", "source"), cutoff: float = CUTOFF) -> DataFrame:
    """doc_id, the counts, base_failed, distance and kept of every document.

    base_failed documents are not kept and take no part in the estimates. The
    others are kept unless their squared distance to their group's shape
    exceeds ``cutoff``. Documents of groups of fewer than MIN_GROUP such documents
    are judged by the shape of all documents with their value of ``group[0]``, or
    of all documents if those are too few as well. If fewer than MIN_GROUP of the
    whole table pass the base, these are kept (distance NULL). NULL groups are
    groups like any other; a NULL or empty text has no words and fails the base.
    """
    group = list(group)
    keyed = docs.select("doc_id", "text", *[F.col(g).alias(f"_g{k}") for k, g in enumerate(group)])
    keys = [f"_g{k}" for k in range(len(group))]
    rows = counted(keyed, ["doc_id", *keys]).withColumn("base_failed", base_failed())
    rows = materialize(rows.withColumns(statistics()))
    sizes = rows.where(~F.col("base_failed")).groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    rows, keys, evidence = _levels(rows, sizes, keys)
    shapes = mcd_shapes(evidence, keys)
    judged = _with_shape(rows, shapes, keys, "left")
    enough = (F.col("n") >= CORE_SHARE * MIN_GROUP) & ~F.col("base_failed")
    distance = F.when(enough, squared_distance() / F.lit(CONSISTENCY))
    return judged.withColumn("distance", distance).select(
        "doc_id",
        *COUNTS,
        "base_failed",
        (~F.col("base_failed") & ~F.coalesce(F.col("distance") > cutoff, F.lit(False))).alias("kept"),
        F.round("distance", 6).alias("distance"),
    )


def _levels(rows: DataFrame, sizes: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str], DataFrame]:
    """``rows`` with the keys of the group that judges each (its own: ``_level``
    0, all of its first key: 1, all documents: 2), these keys, and the rows each
    such group is estimated from. Levels no row needs have no rows there."""
    sizes = materialize(sizes)
    small = F.col("_size") < MIN_GROUP
    wide = sizes.groupBy(keys[0]).agg(F.sum("_size").alias("_wide"), F.max(small).alias("_asked"))
    few = wide.where(F.col("_wide") < MIN_GROUP).limit(1).count() > 0
    sized = _with_shape(_with_shape(rows, sizes, keys, "left"), wide, keys[:1], "left")
    own, first = F.col("_size") >= MIN_GROUP, F.col("_wide") >= MIN_GROUP

    def at(frame: DataFrame) -> DataFrame:
        cols = {k: F.when(F.col("_level") <= (1 if k == keys[0] else 0), F.col(k)) for k in keys}
        return frame.withColumns(cols).drop("_size", "_wide", "_asked")

    judged = at(sized.withColumn("_level", F.when(own, 0).when(first, 1).otherwise(2)))
    levels = [F.when(own, 0), F.when(first & F.col("_asked"), 1), F.lit(2 if few else None).cast("int")]
    evidence = sized.where(~F.col("base_failed")).withColumn("_level", F.explode(F.array_compact(F.array(*levels))))
    return judged, [*keys, "_level"], at(evidence)
