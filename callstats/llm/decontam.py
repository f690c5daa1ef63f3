"""Benchmark decontamination: benchmark items in documents, up to some edits.

An item with an error budget of k edits is split into k + 1 pieces. If a
passage is within k edits of the item, at least one piece is in it unchanged
(pigeonhole), so an Aho-Corasick automaton over all pieces finds every place
that can hold one. Each place is verified with Myers' bit-parallel distance.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callstats.session import scratch_path

#: Edits allowed per character of an item.
ERROR_RATE = 0.08
#: Shortest piece. The budget of a short item is cut so that its pieces are no
#: shorter; an item of less than two pieces must occur unchanged.
MIN_PIECE = 12
#: Largest text of benchmark items in one broadcast automaton. A larger
#: benchmark is searched in several passes over the documents.
MAX_BLOCK_CHARS = 4_000_000

BLANKS = str.maketrans(dict.fromkeys("\t\n\x0b\x0c\r", " "))


def normalize(text: str) -> str:
    """Lower case, every white-space character a space. The length stays, so
    offsets are those of the text (U+0130 is the one letter that would grow)."""
    return text.replace("İ", "i").lower().translate(BLANKS)


def budget(length: int) -> int:
    """Edits allowed for an item of this length."""
    return max(0, min(int(length * ERROR_RATE), length // MIN_PIECE - 1))


def pieces_of(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 pieces of nearly equal length that make up the item, with offsets."""
    bounds = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]


def myers(pattern: str, text: str, k: int) -> tuple[int, int] | None:
    """Smallest edit distance of the pattern to any part of the text and the end
    of the first such part; None if it is above k."""
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | (1 << i)
    pv, mv, score, best, at = full, 0, m, k + 1, -1
    if m <= k:
        best, at = m, 0
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = ((((eq & pv) + pv) ^ pv) | eq) & full
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        pv = mh | (full & ~(xv | ph))
        mv = ph & xv
        if score < best:
            best, at = score, j + 1
    return (best, at) if best <= k else None


def build_automaton(items: Iterable[tuple[int, str]]) -> tuple:
    """Automaton over the pieces of the normalized items, and the items by
    number: (item_id, text, k). Items without any character but blanks are in
    every text and in none; they are left out."""
    table, where = [], {}
    for item_id, text in items:
        norm = normalize(text or "").strip(" ")
        if not norm:
            continue
        k = budget(len(norm))
        number = len(table)
        table.append((item_id, norm, k))
        for offset, piece in pieces_of(norm, k):
            where.setdefault(piece, []).append((number, offset))
    automaton = ahocorasick.Automaton()
    for piece, uses in where.items():
        automaton.add_word(piece, (len(piece), tuple(uses)))
    automaton.make_automaton()
    return automaton, table


def find_items(automaton, table: list, text: str) -> list[tuple[int, int, int, int]]:
    """(item_id, distance, start, end) for each item within its budget of some
    part of the text: the best part, the first of equally good ones. ``start``
    is that of the part, found by running the distance backwards."""
    norm = normalize(text)
    places: dict[int, list[tuple[int, int]]] = {}
    for end, (size, uses) in automaton.iter(norm):
        for number, offset in uses:
            _, item, k = table[number]
            a = max(0, end + 1 - size - offset - k)
            b = min(len(norm), end + 1 - size - offset + len(item) + k)
            spans = places.setdefault(number, [])
            if spans and a <= spans[-1][1] and a >= spans[-1][0]:
                spans[-1] = (spans[-1][0], max(b, spans[-1][1]))
            else:
                spans.append((a, b))
    found = []
    for number, spans in places.items():
        item_id, item, k = table[number]
        best = None
        for a, b in spans:
            hit = myers(item, norm[a:b], k)
            if hit and (best is None or hit[0] < best[1]):
                end = a + hit[1]
                back = myers(item[::-1], norm[max(a, end - len(item) - k) : end][::-1], k)
                best = (item_id, hit[0], end - back[1] if back else max(a, end - len(item)), end)
        if best:
            found.append(best)
    return sorted(found, key=lambda f: (f[0] is not None, f[0], f[1:]))


def blocks_of(rows: Iterator, limit: int) -> Iterator[list[tuple[int, str]]]:
    """Benchmark rows (item_id, text) in blocks of at most ``limit`` characters,
    or one item."""
    block, size = [], 0
    for item_id, text in rows:
        if block and size + len(text or "") > limit:
            yield block
            block, size = [], 0
        block.append((item_id, text))
        size += len(text or "")
    yield block


HIT = "array<struct<item_id:bigint,distance:int,start:int,end:int>>"


def _with_hits(docs: DataFrame, keep: list[str], block: list[tuple[int, str]]) -> DataFrame:
    """The ``keep`` columns as one struct ``_row``, then ``hits`` of the block's items."""
    shared = docs.sparkSession.sparkContext.broadcast(build_automaton(block))
    kept = docs.select(
        F.struct(*[F.col(c) for c in keep]).alias("_row"), F.coalesce(F.col("text"), F.lit("")).alias("_text")
    )
    schema = kept.select("_row", F.lit(None).cast(HIT).alias("hits")).schema
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        automaton, table = shared.value
        names = ("item_id", "distance", "start", "end")
        for b in batches:
            hits = [
                [dict(zip(names, h)) for h in find_items(automaton, table, t)] if table else []
                for t in b.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(hits, kind)], ["_row", "hits"])

    return kept.mapInArrow(run, schema)


def contaminations(docs: DataFrame, benchmark: DataFrame, max_block_chars: int = MAX_BLOCK_CHARS) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id,
    distance, start, end (code points of the text).

    The benchmark (item_id, text) is read block by block; each block's
    automaton is broadcast, its size bounded by ``max_block_chars``. The result
    of every block but the last is written to the shared folder, so the blocks
    never meet in memory. NULL and empty texts hold no item; NULL, empty and
    blank items are in no text. A row that is repeated is reported for each
    repetition, on either side.
    """
    out: DataFrame | None = None
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long"), "text").orderBy("item_id", "text")
    previous = None
    for block in blocks_of(items.toLocalIterator(), max_block_chars):
        if previous is not None:
            path = scratch_path(spark, "contaminations")
            previous.write.parquet(path)
            stored = spark.read.parquet(path)
            out = stored if out is None else out.unionByName(stored)
        hits = _with_hits(docs, ["doc_id"], block)
        previous = hits.select("_row.doc_id", F.explode("hits").alias("h")).select("doc_id", "h.*")
    return previous if out is None else out.unionByName(previous)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, max_block_chars: int = MAX_BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found, all columns kept.
    With several blocks each pass is stored and read again by the next."""
    spark, kept = docs.sparkSession, docs
    items = benchmark.select(F.col("item_id").cast("long"), "text").orderBy("item_id", "text")
    blocks = blocks_of(items.toLocalIterator(), max_block_chars)
    block = next(blocks)
    while True:
        clean = _with_hits(kept, docs.columns, block).where(F.size("hits") == 0).select("_row.*")
        block = next(blocks, None)
        if block is None:
            return clean
        path = scratch_path(spark, "clean")
        clean.write.parquet(path)
        kept = spark.read.parquet(path)
