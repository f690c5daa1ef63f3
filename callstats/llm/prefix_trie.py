"""Trie of shared conversation prefixes, built from adaptive radix trees.

A turn's id is the first 16 bytes of the SHA-256 of its role and text, so equal
turns have equal ids wherever they are and no text is moved. A conversation's
key is its turn ids one after another, big-endian. Keys are sorted over the
whole cluster; every task builds radix trees over consecutive blocks of them
and emits the nodes that lie on a whole turn. Only the prefixes that the last
key of a block shares with the next key lie in several trees: these nodes are
emitted in parts and put together in a second, small shuffle.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callstats.llm.common import ordered, with_place
from callstats.operators.lookup import sized_lookup
from callstats.operators.materialize import materialize

ID_BYTES = 16
#: Turns in one key. A longer conversation has several, each in the trees of the
#: prefix before it.
SEGMENT_TURNS = 1024
#: Turns in one block of keys: bounds the trees a task holds at a time.
BLOCK_TURNS = 65_536


class Sparse:
    """Children by key byte, in sorted order: up to 4, later up to 16."""

    __slots__ = ("keys", "kids")

    def __init__(self):
        self.keys, self.kids = bytearray(), []

    def get(self, byte):
        at = self.keys.find(byte)
        return self.kids[at] if at >= 0 else None

    def add(self, byte, kid):
        if len(self.kids) == 16:
            return Indexed(self).add(byte, kid)
        at = bisect_left(self.keys, byte)
        self.keys.insert(at, byte)
        self.kids.insert(at, kid)
        return self

    def __iter__(self):
        return iter(self.kids)


class Indexed:
    """Up to 48 children: a table from the byte to the child's slot."""

    __slots__ = ("slots", "kids")

    def __init__(self, smaller: Sparse):
        self.slots, self.kids = bytearray(256), list(smaller.kids)
        for slot, byte in enumerate(smaller.keys):
            self.slots[byte] = slot + 1

    def get(self, byte):
        slot = self.slots[byte]
        return self.kids[slot - 1] if slot else None

    def add(self, byte, kid):
        if len(self.kids) == 48:
            return Direct(self).add(byte, kid)
        self.kids.append(kid)
        self.slots[byte] = len(self.kids)
        return self

    def __iter__(self):
        return (self.kids[slot - 1] for slot in self.slots if slot)


class Direct:
    """A child for each of the 256 bytes."""

    __slots__ = ("kids",)

    def __init__(self, smaller: Indexed):
        self.kids = [smaller.get(byte) for byte in range(256)]

    def get(self, byte):
        return self.kids[byte]

    def add(self, byte, kid):
        self.kids[byte] = kid
        return self

    def __iter__(self):
        return (kid for kid in self.kids if kid is not None)


class Node:
    """The bytes from the parent's end to this node's, the keys that end here,
    and the children, whose layout grows with their number."""

    __slots__ = ("path", "rows", "kids")

    def __init__(self, path: bytes, rows: list[int], kids=None):
        self.path, self.rows, self.kids = path, rows, kids

    def insert(self, key: bytes, row: int) -> None:
        node, at = self, 0
        while True:
            common = shared(node.path, key[at : at + len(node.path)])
            if common < len(node.path):
                lower = Node(node.path[common:], node.rows, node.kids)
                node.path, node.rows, node.kids = node.path[:common], [], Sparse().add(lower.path[0], lower)
            at += common
            if at == len(key):
                node.rows.append(row)
                return
            kid = node.kids.get(key[at]) if node.kids is not None else None
            if kid is None:
                node.kids = (node.kids if node.kids is not None else Sparse()).add(key[at], Node(key[at:], [row]))
                return
            node = kid


def shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def shared_turns(a, b) -> int:
    """Bytes of whole turns two (group, key) rows share; -1 in different groups."""
    if a is None or b is None or a[0] != b[0]:
        return -1
    return shared(a[1], b[1]) // ID_BYTES * ID_BYTES


def segment_words(level: int, key: bytes) -> tuple[int, int]:
    """Two 60-bit words of a segment; a prefix is known by their sums."""
    digest = hashlib.sha256(b"%d:" % level + key).hexdigest()
    return int(digest[:15], 16), int(digest[15:30], 16)


def tree_nodes(group, rows: list[tuple], before: int, after: int, segment_turns: int) -> list[list]:
    """The nodes of one block's tree, as lists of the fields of ``PART``.

    ``group`` is (level, two prefix sums); ``rows`` are (key, goes on, conv,
    text bytes by turn, saved and leaves beyond the segment), sorted; ``before``
    and ``after`` are the bytes that the first row shares with the row before the
    block and the last with the row after it.
    """
    root = Node(b"", [])
    for row, (key, *_) in enumerate(rows):
        root.insert(key, row)
    # Parents before children.
    nodes, ends_at, parent = [root], [0], [-1]
    for at, node in enumerate(nodes):
        for kid in node.kids or ():
            nodes.append(kid)
            ends_at.append(ends_at[at] + len(kid.path))
            parent.append(at)
    total, level, last = len(nodes), group[0], len(rows) - 1
    n, conv, leaves, saved = [0] * total, [None] * total, [0] * total, [0] * total
    first, final, kids = [len(rows)] * total, [-1] * total, [0] * total
    found: list[list] = []
    deepest, topmost = [-1] * total, [-1] * total
    for at in range(total - 1, -1, -1):
        node, end = nodes[at], ends_at[at]
        for row in node.rows:
            _, more, c, _, saved_on, leaves_on = rows[row]
            n[at] += 1
            conv[at] = c if conv[at] is None else min(conv[at], c)
            first[at], final[at] = min(first[at], row), max(final[at], row)
            saved[at] += saved_on
            leaves[at] += leaves_on
        ends = [rows[row][2] for row in node.rows if not rows[row][1]]
        open_right = final[at] == last and end <= after
        # The last of equal keys counts as the leaf: the next key decides it.
        if ends and len(ends) == len(node.rows) and node.kids is None and not open_right:
            leaves[at] += 1
        sizes = rows[first[at]][3]
        for depth in range(end // ID_BYTES, (end - len(node.path)) // ID_BYTES if at else -1, -1):
            to = depth * ID_BYTES
            here = not (first[at] == 0 and to <= before)
            if depth:
                saved[at] += (n[at] - here) * sizes[depth - 1]
            parts = (
                not here
                or (final[at] == last and to <= after)
                or depth == segment_turns
                or (level > 0 and depth == 0)
            )
            found.append([
                rows[first[at]][0][:to] if parts else None, level * segment_turns + depth, n[at], conv[at],
                kids[at], leaves[at], saved[at], ends if to == end else [], -1,
            ])
            if deepest[at] < 0:
                deepest[at] = len(found) - 1
            elif topmost[at] >= 0:
                found[topmost[at]][-1] = len(found) - 1
            topmost[at] = len(found) - 1
            kids[at] = int(here)
        if at:
            up = parent[at]
            n[up] += n[at]
            conv[up] = conv[at] if conv[up] is None else min(conv[up], conv[at])
            first[up], final[up] = min(first[up], first[at]), max(final[up], final[at])
            leaves[up] += leaves[at]
            saved[up] += saved[at]
            kids[up] += kids[at]
    for at in range(1, total):
        above = deepest[parent[at]]
        if topmost[at] >= 0:
            found[topmost[at]][-1] = above
        if deepest[at] < 0:
            deepest[at] = above
    return _parts(group, found, segment_turns)


def _parts(group, found: list[list], segment_turns: int) -> list[list]:
    """Fields of ``PART`` of every node: a part has an id, what a part has for a
    parent is named by its id, any other parent by its smallest member."""
    level, *sums = group

    def name(prefix: bytes) -> bytes:
        at, words = level, sums
        if len(prefix) == segment_turns * ID_BYTES:  # the root of the next level's trees
            at, words, prefix = level + 1, [s + w for s, w in zip(sums, segment_words(level, prefix))], b""
        return hashlib.sha256(b"%d:%d:%d:" % (at, *words) + prefix).digest()[:ID_BYTES]

    names = [None if f[0] is None else name(f[0]) for f in found]
    out = []
    for own, (prefix, depth, n, conv, kids, leaves, saved, ends, above) in zip(names, found):
        parent_name = names[above] if above >= 0 else None
        parent_conv = found[above][3] if above >= 0 and parent_name is None else None
        listed = ",".join(map(str, ends))
        if level > 0 and depth == level * segment_turns:  # told by the level above, but for the children
            out.append([own, depth, 0, None, None, None, kids, 0, 0, ""])
        elif own is not None:
            out.append([own, depth, n, conv, parent_name, parent_conv, kids, leaves, saved, listed])
        else:
            digest = hashlib.sha256(listed.encode()).hexdigest()
            out.append([own, depth, n, conv, parent_name, parent_conv, kids, leaves, saved, digest])
    return out


NODE = T.StructType()
for _name, _kind in (
    ("depth", "long"), ("n_convs", "long"), ("conv_id", "long"), ("_parent", "binary"), ("parent_conv_id", "long"),
    ("n_children", "long"), ("n_leaves", "long"), ("saved_tokens", "long"), ("ends_sha256", "string"),
):
    NODE.add(_name, _kind)
#: A node or a part of one: with an id, ``ends_sha256`` is still the list of ids.
PART = T.StructType([T.StructField("_id", T.BinaryType()), T.StructField("_order", T.LongType()), *NODE.fields])
_ARROW = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}


def _batch(rows: list, schema: T.StructType) -> pa.RecordBatch:
    columns = [pa.array(list(c), _ARROW[f.dataType.typeName()]) for c, f in zip(zip(*rows), schema.fields)]
    return pa.RecordBatch.from_arrays(columns, names=schema.names)


def _sorted_rows(batches):
    """Rows of sorted segments as (group, key, the rest)."""
    for b in batches:
        for part, level, s1, s2, key, more, conv, sizes, saved, leaves in zip(*(c.to_pylist() for c in b.columns)):
            yield part, (level, s1, s2), (key, more, conv, sizes, saved, leaves)


def _blocks(batches, bounds: dict, block_turns: int):
    """(group, rows, row before, row after) of consecutive blocks of one group."""
    held, group, turns, before, part = [], None, 0, None, None
    for part, of, row in _sorted_rows(batches):
        if group is None:
            before = bounds[part][0]
        elif of != group or turns >= block_turns:
            yield group, held, before, (of, row[0])
            before, held, turns = (group, held[-1][0]), [], 0
        group = of
        held.append(row)
        turns += 1 + len(row[3])
    if held:
        yield group, held, before, bounds[part][1]


COLUMNS = ["_part", "level", "s1", "s2", "key", "more", "conv_id", "sizes", "saved", "leaves"]


def _bounds(stored: DataFrame) -> dict:
    """Per partition the rows before and after it: one row per partition and at
    most one segment's key each are gathered."""
    edge = F.struct("level", "s1", "s2", "key")
    ends = stored.groupBy("_part").agg(F.min_by(edge, "_at").alias("a"), F.max_by(edge, "_at").alias("z")).collect()
    ends.sort(key=lambda r: r["_part"])
    row = lambda e: ((e["level"], e["s1"], e["s2"]), bytes(e["key"]))
    return {
        r["_part"]: (row(ends[k - 1]["z"]) if k else None, row(ends[k + 1]["a"]) if k + 1 < len(ends) else None)
        for k, r in enumerate(ends)
    }


def _trees(stored: DataFrame, segment_turns: int, block_turns: int) -> DataFrame:
    """Nodes and parts of nodes of all blocks."""
    bounds = _bounds(stored)

    def run(batches):
        block, out = 0, []
        for group, rows, before, after in _blocks(batches, bounds, block_turns):
            left, right = shared_turns(before, (group, rows[0][0])), shared_turns((group, rows[-1][0]), after)
            for own, *rest in tree_nodes(group, rows, left, right, segment_turns):
                out.append((own, block, *rest))
            block += 1
            if len(out) >= 20_000:
                yield _batch(out, PART)
                out = []
        if out:
            yield _batch(out, PART)

    order = F.shiftleft(F.spark_partition_id().cast("long"), 40) + F.col("_order")
    return stored.select(*COLUMNS).mapInArrow(run, PART).withColumn("_order", order)


def _credits(stored: DataFrame) -> DataFrame:
    """Per later segment of a conversation what it adds to all nodes above it:
    bytes of turns that the row before has too, and 1 if a leaf ends here."""
    bounds = _bounds(stored)
    schema = T.StructType().add("conv_id", "long").add("level", "long").add("saved", "long").add("leaves", "long")

    def run(batches):
        out = []
        for group, rows, before, after in _blocks(batches, bounds, 1):
            # Blocks of one row: neighbours are the rows before and after.
            key, more, conv, sizes, *_ = rows[0]
            same = max(0, shared_turns(before, (group, key))) // ID_BYTES
            goes_on = after is not None and after[0] == group and after[1].startswith(key)
            if group[0]:
                out.append((conv, group[0], sum(sizes[:same]), int(not more and not goes_on)))
            if len(out) >= 20_000:
                yield _batch(out, schema)
                out = []
        if out:
            yield _batch(out, schema)

    return stored.select(*COLUMNS).mapInArrow(run, schema)


def _merged(parts: DataFrame) -> DataFrame:
    """Parts of the same node added up, in their order, as a stream: a node that
    many conversations end at is hashed without holding its list."""
    schema = T.StructType([PART["_id"], *NODE.fields])

    def run(batches):
        state, digest, empty, out = None, None, True, []
        for b in batches:
            for own, _, depth, n, conv, parent, parent_conv, kids, leaves, saved, listed in zip(*(c.to_pylist() for c in b.columns)):
                if state is None or own != state[0]:
                    if state is not None:
                        out.append((*state, digest.hexdigest()))
                    state, digest, empty = [own, depth, 0, None, None, None, 0, 0, 0], hashlib.sha256(), True
                state[2] += n
                if conv is not None:
                    state[3] = conv if state[3] is None else min(state[3], conv)
                state[4] = state[4] or parent
                state[5] = parent_conv if state[5] is None else state[5]
                state[6], state[7], state[8] = state[6] + kids, state[7] + leaves, state[8] + saved
                if listed:
                    digest.update(listed.encode() if empty else b"," + listed.encode())
                    empty = False
            if len(out) >= 20_000:
                yield _batch(out, schema)
                out = []
        if state is not None:
            out.append((*state, digest.hexdigest()))
        if out:
            yield _batch(out, schema)

    return parts.repartition("_id").sortWithinPartitions("_id", "_order").mapInArrow(run, schema)


def segments(turns: DataFrame, segment_turns: int = SEGMENT_TURNS) -> DataFrame:
    """One row per conversation and ``segment_turns`` turns: key, text bytes by
    turn, whether the conversation goes on, and its prefix's level and sums."""
    one = F.struct("pos", F.hex("turn_id").alias("id"), "n_bytes")
    listed = F.sort_array(F.collect_list(F.when(F.col("turn_id").isNotNull(), one)))
    level = F.floor(F.coalesce(F.col("pos"), F.lit(0)) / segment_turns)
    grouped = turns.groupBy("conv_id", level.cast("long").alias("level")).agg(
        listed.alias("_list"), F.max("n_turns").alias("_turns")
    )
    keyed = materialize(
        grouped.select(
            "conv_id",
            "level",
            F.unhex(F.array_join(F.transform("_list", lambda x: x["id"]), "")).alias("key"),
            F.transform("_list", lambda x: x["n_bytes"]).alias("sizes"),
            ((F.col("level") + 1) * segment_turns < F.col("_turns")).alias("more"),
            (F.col("_turns") > segment_turns).alias("_long"),
        )
    )
    zero = F.lit(0).cast("decimal(38,0)")
    short = keyed.where(~F.col("_long")).withColumns({"s1": zero, "s2": zero})
    digest = F.sha2(F.concat(F.concat(F.col("level").cast("string"), F.lit(":")).cast("binary"), F.col("key")), 256)
    # A row per segment, not per turn: a conversation of a million turns has a
    # thousand of them in this window.
    sums = {
        f"s{k + 1}": F.expr(
            f"coalesce(sum(cast(conv(substr(_digest, {15 * k + 1}, 15), 16, 10) as decimal(38,0))) over "
            "(partition by conv_id order by level rows between unbounded preceding and 1 preceding), 0)"
        ).cast("decimal(38,0)")
        for k in range(2)
    }
    long = keyed.where("_long").withColumn("_digest", digest).withColumns(sums).drop("_digest")
    both = short.unionByName(long).drop("_long")
    return both.withColumns({"saved": F.lit(0).cast("long"), "leaves": F.lit(0).cast("long")})


def prefix_trie(turns: DataFrame, segment_turns: int = SEGMENT_TURNS, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per distinct conversation prefix.

    ``turns`` has ``conv_id``, ``n_turns`` (of the whole conversation), ``pos``
    (from 0), ``turn_id`` and ``n_bytes``; a row with a NULL ``turn_id`` names a
    conversation, so that one without turns counts as well. Returns ``conv_id``
    (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` and ``ends_sha256``. No conversations: no rows.

    A prefix that a third of all conversations share is spread over many blocks,
    and so is one conversation of very many turns. The list of a node's ends is
    hashed as a stream in one task, as SHA-256 demands, from one row per block.
    """
    order = ["level", "s1", "s2", "key", "more", "conv_id"]
    found = segments(turns, segment_turns)
    stored = with_place(ordered(found, order))
    if stored.where(F.col("level") > 0).limit(1).count():
        # What lies beyond a segment counts for every node above it.
        beyond = F.expr("sum({0}) over (partition by conv_id order by level desc) ".format("saved"))
        carried = _credits(stored).select(
            "conv_id", (F.col("level") - 1).alias("level"), beyond.alias("_saved"),
            F.expr("sum(leaves) over (partition by conv_id order by level desc)").alias("_leaves"),
        )
        joined = stored.drop("_part", "_at").join(carried, ["conv_id", "level"], "left").withColumns(
            {"saved": F.coalesce("_saved", "saved"), "leaves": F.coalesce("_leaves", "leaves")}
        )
        stored = with_place(ordered(joined.drop("_saved", "_leaves"), order))
    parts = materialize(_trees(stored, segment_turns, block_turns))
    whole = parts.where(F.col("_id").isNull()).drop("_order")
    merged, _ = sized_lookup(_merged(parts.where(F.col("_id").isNotNull())))
    nodes = whole.unionByName(merged)
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    done = nodes.where(F.col("_parent").isNull()).select(*names)
    above = merged.select(F.col("_id").alias("_parent"), F.col("conv_id").alias("_above"))
    rest = nodes.where(F.col("_parent").isNotNull()).join(above, "_parent", "left")
    return done.unionByName(rest.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above")).select(*names))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``pos``, ``turn_id`` and ``n_bytes`` of every turn.

    Turns are numbered by ``turn`` (NULL first), those that tie on it by id; a
    repeated row is a turn of its own. NULL roles and texts are empty. Rows
    without a ``conv_id`` belong to no conversation and are left out. The order
    comes from one global sort, so that a conversation of any length is numbered
    by many tasks; one row per partition is gathered for their offsets.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    slim = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.unhex(F.substring(digest, 1, 2 * ID_BYTES)).alias("turn_id"),
        F.octet_length(text).alias("n_bytes"),
    )
    stored = with_place(ordered(slim, ["conv_id", "turn", "turn_id"]))
    runs = stored.groupBy("_part").agg(F.min("conv_id").alias("a"), F.max("conv_id").alias("z")).alias("e")
    edges = stored.alias("s").join(F.broadcast(runs), "_part").groupBy("_part", "a", "z").agg(
        F.count_if(F.col("conv_id") == F.col("z")).alias("n_z"),
    )
    start, carried, on = {}, 0, None
    for r in sorted(edges.collect(), key=lambda r: r["_part"]):
        here = carried if r["a"] == on else 0
        start[r["_part"]] = here
        on, carried = r["z"], r["n_z"] + (here if r["a"] == r["z"] else 0)
    schema = T.StructType().add("conv_id", "long").add("pos", "long").add("turn_id", "binary").add("n_bytes", "integer")

    def run(batches):
        last, seen = None, 0
        for b in batches:
            part, conv = b.column(0).to_numpy(), b.column(1).to_numpy()
            if not len(conv):
                continue
            starts = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
            runs_of = np.diff(np.r_[starts, len(conv)])
            base = np.zeros(len(starts), np.int64)
            if last is None:
                base[0] = start[int(part[0])]
            elif conv[0] == last:
                base[0] = seen
            pos = np.arange(len(conv)) - np.repeat(starts, runs_of) + np.repeat(base, runs_of)
            last, seen = conv[-1], int(pos[-1]) + 1
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(pos), b.column(2), b.column(3)], names=schema.names)

    return stored.select("_part", "conv_id", "turn_id", "n_bytes").mapInArrow(run, schema)


def rebuilt(turns: DataFrame, block: int = 5, heads: int = 9) -> DataFrame:
    """Every conversation c as the first h turns of conversation c - c % ``block``
    and its own after its first h; h = crc32(decimal c) % ``heads``.

    Of the giver there are all turns if it has fewer, none if it is absent.
    Numbered ``turns`` in, ``turns`` of ``prefix_trie`` out: with the rebuilt
    ``n_turns``, and one row without a turn per conversation.
    """
    turns = materialize(turns)
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    counts = turns.groupBy("conv_id").agg((F.max("pos") + 1).alias("_n"))
    givers = counts.select(F.col("conv_id").alias("_giver"), F.col("_n").alias("_given"))
    convs = counts.withColumns({"_h": h, "_giver": F.col("conv_id") - F.col("conv_id") % block})
    given = F.least("_h", F.coalesce("_given", F.lit(0)))
    convs = materialize(
        convs.join(givers, "_giver", "left").select(
            "conv_id", "_giver", "_h", given.alias("_given"), (given + F.greatest(F.col("_n") - F.col("_h"), F.lit(0))).alias("n_turns")
        )
    )
    columns = ["conv_id", "n_turns", "pos", "turn_id", "n_bytes"]
    named = convs.select("conv_id", "n_turns").withColumns(
        {"pos": F.lit(None).cast("long"), "turn_id": F.lit(None).cast("binary"), "n_bytes": F.lit(None).cast("int")}
    )
    first = turns.where(F.col("pos") < heads - 1).withColumnRenamed("conv_id", "_giver")
    donated = convs.join(first, "_giver").where(F.col("pos") < F.col("_h")).select(*columns)
    own = turns.where(F.col("pos") >= h).join(convs, "conv_id")
    own = own.withColumn("pos", F.col("pos") - F.col("_h") + F.col("_given")).select(*columns)
    return named.unionByName(donated).unionByName(own)
