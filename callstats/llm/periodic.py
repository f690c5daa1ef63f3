"""Maximal periodic runs of words, by longest-common-extension queries.

The extension structure sorts only the suffixes at the positions of a
difference cover: any two positions have one small shift that takes both to
sampled positions, so a query compares a few words directly and finds the rest
as a range minimum over the samples' common prefixes. Runs come from a grid:
for every period p, each run of it covers a multiple of a step that grows with
p, so that all periods together need n log n pairs.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A run has at least so many words and so many periods.
MIN_WORDS, MIN_PERIODS = 24, 3
#: A perfect difference set: each residue but 0 is a difference exactly once.
MODULUS, COVER = 21, (0, 1, 4, 14, 16)
#: Words and grid pairs handled at once.
WORDS_AT_ONCE, PAIRS_AT_ONCE = 300_000, 3_000_000

_SHIFT = np.full((MODULUS, MODULUS), MODULUS, np.int64)
for _a in COVER:
    for _b in COVER:
        for _d in range(MODULUS):
            _at = (_a - _d) % MODULUS, (_b - _d) % MODULUS
            _SHIFT[_at] = min(_SHIFT[_at], _d)


class Extensions:
    """Longest common extensions to the right between positions of ``words``
    (positive integers)."""

    def __init__(self, words: np.ndarray):
        self.n = n = len(words)
        self.words = np.concatenate([words, np.zeros(MODULUS, words.dtype)])
        at = np.flatnonzero(np.isin(np.arange(n) % MODULUS, COVER))
        m = len(at)
        self.sample = np.full(n + 2 * MODULUS, m, np.int64)
        self.sample[at] = np.arange(m)
        windows = np.lib.stride_tricks.sliding_window_view(self.words, MODULUS)
        # Big-endian, so that the order of the bytes is that of the words.
        packed = np.ascontiguousarray(windows[at].astype(">u4")).view(f"V{4 * MODULUS}").ravel()
        rank = np.unique(packed, return_inverse=True)[1].astype(np.int64)
        # Ranks of the sampled suffixes by 1, 2, 4, ... windows of MODULUS words.
        after = np.append(self.sample[at + MODULUS], m)
        levels = [(np.append(rank, -1), after)]
        while m and rank.max() + 1 < m:
            ranks, after = levels[-1]
            pair = ranks[:m] * (m + 1) + ranks[after[:m]] + 1
            rank = np.unique(pair, return_inverse=True)[1].astype(np.int64)
            levels.append((np.append(rank, -1), after[after]))
        self.rank = rank
        order = np.argsort(rank, kind="stable")
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            ranks, after = levels[k]
            same = ranks[a] == ranks[b]
            common += same * (MODULUS << k)
            a, b = np.where(same, after[a], a), np.where(same, after[b], b)
        place = np.append(at, n)
        differ = windows[place[a]] != windows[place[b]]
        common += np.where(differ.any(axis=1), differ.argmax(axis=1), MODULUS)
        self.least = [common]
        step = 1
        while 2 * step <= len(common):
            last = self.least[-1]
            self.least.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from i and j (i < j) on."""
        longest = self.n - j
        shift = np.minimum(_SHIFT[i % MODULUS, j % MODULUS], longest)
        out = np.zeros(len(i), np.int64)
        live = np.flatnonzero(shift > 0)
        for k in range(MODULUS):
            live = live[(shift[live] > k)]
            live = live[self.words[i[live] + k] == self.words[j[live] + k]]
            out[live] += 1
        synced = np.flatnonzero((out == shift) & (shift < longest))
        if len(synced):
            a = self.rank[self.sample[i[synced] + shift[synced]]]
            b = self.rank[self.sample[j[synced] + shift[synced]]]
            low, high = np.minimum(a, b), np.maximum(a, b)
            level = np.frexp((high - low).astype(np.float64))[1] - 1
            found = np.empty(len(synced), np.int64)
            for k in np.unique(level):
                of = level == k
                table = self.least[k]
                found[of] = np.minimum(table[low[of]], table[high[of] - (1 << int(k))])
            out[synced] += found
        return np.minimum(out, longest)


def grid(sizes: np.ndarray, bases: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, position, period) of the grid pairs of all texts, in slices.

    In a run of period p the words p apart are equal over at least
    max(MIN_WORDS - p, (MIN_PERIODS - 1) * p) positions: one of them is a
    multiple of that step.
    """
    most = sizes // MIN_PERIODS
    text = np.repeat(np.arange(len(sizes)), most)
    period = np.arange(most.sum()) - np.repeat(np.cumsum(most) - most, most) + 1
    step = np.maximum(MIN_WORDS - period, (MIN_PERIODS - 1) * period)
    pairs = (sizes[text] - period - 1) // step + 1
    upto = np.cumsum(pairs)
    start = 0
    while start < len(pairs):
        done = upto[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(upto, done + PAIRS_AT_ONCE, side="right")))
        of, n = slice(start, stop), pairs[start:stop]
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        t = np.repeat(text[of], n)
        yield t, bases[t] + k * np.repeat(step[of], n), np.repeat(period[of], n)
        start = stop


def promising(words: np.ndarray, i: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Indexes of the grid pairs around which enough words next to each other
    equal those p later, as far as a run of any period has at least."""
    least = MIN_WORDS * (MIN_PERIODS - 1) // MIN_PERIODS
    live = np.flatnonzero(words[i] == words[i + p])
    total = np.zeros(len(i), np.int64)
    for way in (1, -1):
        left = live
        for k in range(0 if way == 1 else 1, least + (way == -1)):
            a, b = i[left] + way * k, i[left] + p[left] + way * k
            ok = (a >= 0) & (b < len(words))
            left = left[ok]
            left = left[words[a[ok]] == words[b[ok]]]
            if not len(left):
                break
            total[left] += 1
    return live[total[live] >= least]


def joined(texts: list[np.ndarray], distinct: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array, an own separator after each; sizes and bases."""
    sizes = np.array([len(t) for t in texts], np.int64)
    bases = np.cumsum(sizes + 1) - sizes - 1
    words = np.empty(int((sizes + 1).sum()), np.int64)
    for k, (t, base) in enumerate(zip(texts, bases)):
        words[base : base + len(t)] = t
        words[base + len(t)] = distinct + 1 + k
    return words, sizes, bases


def runs_of(texts: list[np.ndarray], distinct: int) -> list[np.ndarray]:
    """Per text its runs as rows (start, length, period), by start, then period.
    ``texts`` are arrays of word numbers from 1 to ``distinct``."""
    words, sizes, bases = joined(texts, distinct)
    hit = np.zeros(len(texts), bool)
    for t, i, p in grid(sizes, bases):
        hit[t[promising(words, i, p)]] = True
    found = [np.empty((0, 3), np.int64)] * len(texts)
    some = np.flatnonzero(hit)
    if not len(some):
        return found
    words, sizes, bases = joined([texts[k] for k in some], distinct)
    n = len(words)
    right, left = Extensions(words), Extensions(words[::-1].copy())
    rows = [np.empty((0, 4), np.int64)]
    for t, i, p in grid(sizes, bases):
        of = promising(words, i, p)
        t, i, p = t[of], i[of], p[of]
        # To the left: the mirrored positions, in the order (smaller, larger).
        start = i - left(n - i - p, n - i)
        end = i + p + right(i, i + p)
        ok = end - start >= np.maximum(MIN_WORDS, MIN_PERIODS * p)
        rows.append(smallest_periods(np.stack([t[ok], start[ok] - bases[t[ok]], (end - start)[ok], p[ok]], axis=1)))
    runs = smallest_periods(np.concatenate(rows))
    for k, of in enumerate(np.split(runs[:, 1:], np.searchsorted(runs[:, 0], np.arange(1, len(some))))):
        found[some[k]] = of
    return found


def smallest_periods(runs: np.ndarray) -> np.ndarray:
    """Of rows (text, start, length, period) with one stretch that with the
    smallest period; the others are multiples of it."""
    runs = runs[np.lexsort((runs[:, 3], runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :3] != runs[:-1, :3]).any(axis=1)
    runs = runs[new]
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def strongest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run with the greatest length / period; ties go to the smallest start,
    then the smallest period."""
    best = None
    for start, length, period in runs.tolist():
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    return best


def repeat_words(n: int, doc_id) -> np.ndarray | None:
    """Which word stands at each place of a text of ``n`` words after the
    contract's rewriting; None if it stays as it is. A NULL id is never rewritten."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


FIELDS = T.StructType()
for _name in ("n_runs", "start", "length", "period", "exponent_milli"):
    FIELDS.add(_name, "long")
FIELDS.add("runs_sha256", "string").add("collapsed_sha256", "string")


def _digests(words: list[bytes], runs: np.ndarray) -> tuple:
    best = strongest(runs)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs.tolist())
    if len(runs):
        kept = np.ones(len(words), bool)
        for start, length, period in runs.tolist():
            kept[start + period : start + length] = False
        words = [words[k] for k in np.flatnonzero(kept)]
    text = hashlib.sha256(b" ".join(words)).hexdigest()
    milli = 1000 * best[1] // best[2] if best else None
    return (len(runs), *(best or (None, None, None)), milli, hashlib.sha256(listed.encode()).hexdigest(), text)


def periodic_runs(docs: DataFrame, keep: list[str], text: str = "text", rewrite_by: str | None = None) -> DataFrame:
    """Runs of every document: ``keep``, ``n_runs``, the strongest run's
    ``start``, ``length``, ``period`` and ``exponent_milli`` (NULL without runs),
    ``runs_sha256`` and ``collapsed_sha256`` (the text without repetitions).

    Words are split at ASCII white space. NULL and empty texts have no words;
    a text of any length is searched whole; equal rows get equal results; an
    empty table gives no rows. With ``rewrite_by`` (an integer column of
    ``keep``) texts are first rewritten by ``repeat_words``. Only ``keep`` (any
    names but those of the results) and ``text`` are read. No shuffle.
    """
    slim = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    schema = T.StructType([*(slim.schema[c] for c in keep), *FIELDS.fields])
    n_keep, by = len(keep), keep.index(rewrite_by) if rewrite_by else None
    kinds = [pa.int64()] * 5 + [pa.string()] * 2

    def done(words: list[list[bytes]]) -> list[tuple]:
        known: dict[bytes, int] = {}
        numbered = []
        for w in words:
            numbered.append(np.fromiter((known.setdefault(x, len(known) + 1) for x in w), np.int64, len(w)))
        return [_digests(w, r) for w, r in zip(words, runs_of(numbered, len(known)))]

    def run(batches):
        for batch in batches:
            ids = batch.column(by).to_pylist() if by is not None else [None] * batch.num_rows
            out, held, size = [], [], 0
            for doc_id, body in zip(ids, batch.column(n_keep)):
                words = body.as_py().encode().split()  # bytes.split: ASCII white space
                order = repeat_words(len(words), doc_id)
                held.append(words if order is None else [words[k] for k in order.tolist()])
                size += len(words)
                if size >= WORDS_AT_ONCE:
                    out += done(held)
                    held, size = [], 0
            out += done(held)
            results = [pa.array(list(c), kind) for c, kind in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(n_keep)] + results, names=schema.names)

    return slim.mapInArrow(run, schema)
