"""Best-fit packing of tokenised documents into sequences of a fixed length.

Documents are cut into pieces of at most ``capacity`` tokens. A packing depends
only on how many pieces there are of each length, so it is planned on that
histogram (``capacity`` numbers, whatever the table's size): exact-complement
hashing first, then best fit for what is left. The plan lists patterns of
lengths with the number of sequences filled by each; a piece finds its
sequence by its rank among the pieces of its length. Token ids never move.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callstats.operators.lookup import sized_lookup
from callstats.operators.materialize import materialize

CAPACITY = 1024
#: Id put after every document.
END_ID = 2
#: Pre-tokens whose ids are remembered by a worker; beyond it the memory starts anew.
REMEMBERED = 1_000_000
#: Characters handed to the tokenizer library at once.
AT_ONCE = 1 << 18

# Fixed value: the split of byte-level vocabularies (public pattern), for texts
# of ASCII and Latin letters, where these classes mean the same in every library.
SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
OTHER_LETTERS = re.compile("[^\t\n\r\x20-\x7eÀ-ɏ]")
#: A token never reaches over a lone space from the left.
CUT = re.compile(r"(?<=\S) (?=\S)")


def byte_letters() -> dict[int, str]:
    """How byte-level vocabularies spell a byte: as its Latin-1 character if that
    is printable, else as the next character from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(256 + k) for k, b in enumerate(rest)}


class Remembered(dict):
    """Values of a function by argument, forgotten all at once when there are
    ``REMEMBERED`` of them."""

    def __init__(self, of):
        super().__init__()
        self.of = of

    def __missing__(self, key):
        if len(self) >= REMEMBERED:
            self.clear()
        self[key] = value = self.of(key)
        return value


class Encoder:
    """Token ids of texts, as little-endian unsigned 32-bit words.

    The ids are those of the tokenizers library. With a byte-level vocabulary
    that has no normalizer, a token never crosses a pre-token, so the ids of a
    pre-token are asked for once and remembered. Texts with other letters and
    other vocabularies go to the library as they are; with a byte-level one
    long texts go in blocks, cut where no token can cross.
    """

    def __init__(self, path: str):
        # One thread a task: Spark has a task on every core already.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before = spec.get("pre_tokenizer") or {}
        self.by_word = (
            before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not spec.get("normalizer")
        )
        self.tokenizer = Tokenizer.from_file(path)
        # The names of special tokens are ordinary text inside a document.
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.spelling = byte_letters()
        self.known = Remembered(self._word)

    def _word(self, word: str) -> bytes:
        """Ids of one pre-token."""
        spelled = word.encode().decode("latin-1").translate(self.spelling)
        return np.array([t.id for t in self.model.tokenize(spelled)], "<u4").tobytes()

    def _ids(self, texts: list[str]) -> list[bytes]:
        out, start, size = [], 0, 0
        for k, text in enumerate(texts):
            size += len(text)
            if size >= AT_ONCE or k + 1 == len(texts):
                found = self.tokenizer.encode_batch_fast(texts[start : k + 1], add_special_tokens=False)
                out += [np.asarray(e.ids, "<u4").tobytes() for e in found]
                start, size = k + 1, 0
        return out

    def __call__(self, text: str) -> bytes:
        if not self.by_word:
            return self._ids([text])[0]
        if OTHER_LETTERS.search(text):
            return b"".join(self._ids(blocks(text)))
        return b"".join(map(self.known.__getitem__, SPLIT.findall(text)))


def blocks(text: str, size: int = AT_ONCE) -> list[str]:
    """``text`` in parts of about ``size`` characters, cut before lone spaces."""
    parts, start = [], 0
    while len(text) - start > size:
        cut = CUT.search(text, start + size)
        if cut is None:
            break
        parts.append(text[start : cut.start()])
        start = cut.start()
    return [*parts, text[start:]]


def pieces(
    docs: DataFrame,
    tokenizer: str,
    keep: list[str],
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of every document: ``keep``, ``piece`` (from 0), ``start`` (ids
    of the document before it), ``length``, ``ids_crc32`` and, on request, the
    ids. A document is its ids and ``end_id``; one of more than ``capacity`` ids
    is cut so that only its first piece can be shorter. NULL is an empty text.

    ``_part`` and ``_rank`` number the pieces of a length within their task:
    they are stable once the frame is stored.
    """
    slim = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    fields = [("piece", "integer"), ("start", "long"), ("length", "long"), ("ids_crc32", "long")]
    fields += [("ids", T.ArrayType(T.IntegerType()))] if with_ids else []
    fields += [("_part", "integer"), ("_rank", "long")]
    schema = T.StructType([slim.schema[c] for c in keep])
    for name, kind in fields:
        schema.add(name, kind)
    names, n_keep = schema.names, len(keep)
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), *([pa.list_(pa.int32())] if with_ids else []), pa.int32(), pa.int64()]
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encode, seen, part = Encoder(tokenizer), [0] * (capacity + 1), TaskContext.get().partitionId()
        for batch in batches:
            held, of, rows = 0, [], []

            def flush():
                columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
                kept = [batch.column(i).take(pa.array(of, pa.int64())) for i in range(n_keep)]
                return pa.RecordBatch.from_arrays(kept + columns, names=names)

            for at, body in enumerate(batch.column(n_keep)):
                ids = encode(body.as_py()) + end
                total = len(ids) // 4
                first = (total - 1) % capacity + 1
                for k, upto in enumerate(range(first, total + 1, capacity)):
                    begin = 0 if k == 0 else upto - capacity
                    size, raw = upto - begin, ids[4 * begin : 4 * upto]
                    out = [k, begin, size, zlib.crc32(raw)]
                    if with_ids:
                        out.append(np.frombuffer(raw, "<u4").astype("int32"))
                    rows.append((*out, part, seen[size]))
                    of.append(at)
                    seen[size] += 1
                held += total if with_ids else 1
                if held >= 1 << 20:
                    yield flush()
                    held, of, rows = 0, [], []
            if rows:
                yield flush()

    return slim.mapInArrow(run, schema)


def exact_combination(left: np.ndarray, big: int, gap: int, most: int = 3) -> tuple[int, ...] | None:
    """Lengths still there, besides one ``big``, that fill ``gap`` exactly: one,
    two or three (at most ``most``), the longest first; None if there are none."""
    left = left.copy()
    left[big] -= 1
    if gap == 0:
        return ()
    if left[gap] > 0:
        return (gap,)
    if most < 2:
        return None

    def pair(total: int, free: np.ndarray) -> tuple[int, int] | None:
        a = np.arange(total - 1, (total + 1) // 2 - 1, -1)
        b = total - a
        fits = np.flatnonzero((free[a] > 0) & (free[b] > (a == b)))
        return (int(a[fits[0]]), int(b[fits[0]])) if len(fits) else None

    if found := pair(gap, left):
        return found
    if most < 3:
        return None
    # Sums that some pair makes, as an index over all gaps; availability of a
    # length used twice is checked when the pair is taken.
    there = (left[: gap + 1] > 0).astype(np.int64)
    sums = np.convolve(there, there)[: gap + 1]
    for c in np.flatnonzero(there[1:gap])[::-1] + 1:
        if sums[gap - c]:
            left[c] -= 1
            if found := pair(gap - int(c), left):
                return (int(c), *found)
            left[c] += 1
    return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how many sequences each fills.

    Lengths are completed by exact complements as often as the counts allow: all
    lengths, from the longest down, by one piece, then by two, then by three.
    What has none is packed by best fit, longest first: into the fullest
    sequence it still fits. Every step uses up a length or a kind of gap, so the
    work depends on ``capacity`` alone. Complements of many pieces can take what
    the long ones need, so plans with complements of up to one, two and three
    pieces are made and the one with the fewest sequences is taken.
    """
    plans = [_plan(counts, capacity, most) for most in (1, 2, 3)]
    return min(plans, key=lambda patterns: sum(times for _, times in patterns))


def _plan(counts: dict[int, int], capacity: int, most: int) -> list[tuple[tuple[int, ...], int]]:
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    patterns: list[tuple[tuple[int, ...], int]] = []
    for pieces_of, big in ((k, big) for k in range(1, most + 1) for big in range(capacity, 0, -1)):
        while left[big]:
            combination = exact_combination(left, big, capacity - big, pieces_of)
            if combination is None:
                break
            need = Counter((big, *combination))
            times = min(int(left[length]) // k for length, k in need.items())
            for length, k in need.items():
                left[length] -= k * times
            patterns.append(((big, *combination), times))
    gaps: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(capacity + 1)]
    gaps[capacity].append(((), int(left.sum())))
    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            gap = next(g for g in range(length, capacity + 1) if gaps[g])
            pattern, open_now = gaps[gap].pop()
            # Best fit goes on with the sequence just used while it fits.
            each = min(gap // length, n)
            times = min(n // each, open_now)
            if open_now > times:
                gaps[gap].append((pattern, open_now - times))
            gaps[gap - each * length].append((pattern + (length,) * each, times))
            n -= each * times
    return patterns + [p for of in gaps for p in of if p[0]]


def places(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, ...]:
    """Where the pieces of a length go: sorted arrays of length, first rank,
    first sequence and offset. The piece of rank r goes to the last entry of its
    length with first rank <= r, and to the (r - first rank)-th sequence of it."""
    ranks: Counter = Counter()
    rows, base = [], 0
    for pattern, times in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, ranks[length], base, offset))
            ranks[length] += times
            offset += length
        base += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return table[:, 0], table[:, 1], table[:, 2], table[:, 3]


def pack(stored: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``stored`` pieces with ``sequence_id`` and ``offset``.

    ``stored`` is a materialised frame of ``pieces``. The driver sees one count
    per length. A length that a third of all pieces have is spread over its
    tasks: a task's pieces start at the count of the earlier tasks' pieces of
    that length, one row per task and length. No pieces: no rows.
    """
    per_task = stored.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("_n"))
    before = F.expr("sum(_n) over (partition by length order by _part) - _n")
    starts, _ = sized_lookup(per_task.select("_part", "length", "_n", before.alias("_start")))
    counts = {r["length"]: r["n"] for r in starts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    of_length, first, sequence, offset = places(plan(counts, capacity))
    # Length and rank in one sortable number: ranks stay under 2^52.
    key = (of_length << 52) | first
    ranked = stored.join(starts.drop("_n"), ["_part", "length"]).withColumn("_rank", F.col("_start") + F.col("_rank"))
    slim = ranked.select(*[c for c in stored.columns if c not in ("_part", "_rank")], "_rank")
    names = slim.columns[:-1]
    schema = T.StructType([slim.schema[c] for c in names]).add("sequence_id", "long").add("offset", "long")
    at_length = names.index("length")

    def run(batches):
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (at_length, len(names)))
            at = np.searchsorted(key, (length << 52) | rank, side="right") - 1
            placed = [pa.array(sequence[at] + rank - first[at]), pa.array(offset[at])]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(names))] + placed, names=schema.names)

    return slim.mapInArrow(run, schema)


def pack_documents(
    docs: DataFrame, tokenizer: str, keep: list[str], text: str = "text", capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """Every document's pieces with the sequence and the offset they go to.

    ``tokenizer`` is the path of a tokenizers file that all executors can open.
    Each text is tokenised once; the pieces' lengths and checksums (and ids on
    request) are stored in the shared folder. NULL and empty texts are one piece
    with the end id alone; long texts are tokenised whole, in blocks; repeated
    rows are packed as often as they occur; an empty table gives no rows. Only
    ``keep`` (any names but those of the results) and ``text`` are read.
    """
    return pack(materialize(pieces(docs, tokenizer, keep, text, capacity, with_ids=with_ids)), capacity)
