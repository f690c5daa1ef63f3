"""Prefix trie, periodic runs and packing, against brute force and round trips."""

import hashlib
import itertools
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from callstats.llm import packing, periodic, prefix_trie
from callstats.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def by_value(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


# ---------------------------------------------------------------- prefix trie

NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute_trie(rows):
    """The contract, read literally, over (conv_id, turn, role, text) rows."""

    def turn_id(role, text):
        return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()

    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, turn_id(role or "", text or ""), role or "", text or ""))
    plain = {c: [t[3:] for t in sorted(v)] for c, v in convs.items()}
    whole = {}
    for c, turns in plain.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = plain.get(c - c % 5, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in sorted(members, key=len, reverse=True):
        leaves[p] += not kids[p]
        if p:
            saved[p] += (len(members[p]) - 1) * len(p[-1][1].encode())
            kids[p[:-1]] += 1
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(whole[c]) == len(p))
        up = min(members[p[:-1]]) if p else None
        out.append((min(m), len(p), up, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def random_conversations(seed):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(150), 90):
        for turn in range(rng.choice([1, 2, 3, 5, 9, 14, 30])):
            for _ in range(rng.choice([1, 1, 1, 2])):  # repeated rows and ties
                text = rng.choice(["x", "y", "é", None]) if rng.random() < 0.9 else str(rng.random())
                rows.append((conv, rng.choice([None, turn, turn, turn]), rng.choice(["u", "a", None]), text))
    return rows + [(None, 1, "u", "of no conversation")]


def trie_of(spark, rows, **sizes):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth string, pos string")
    turns = prefix_trie.numbered_turns(df.repartition(5))
    return [tuple(r) for r in prefix_trie.prefix_trie(prefix_trie.rebuilt(turns), **sizes).select(*NODE).collect()]


@pytest.mark.parametrize("segment, block", [(1024, 65_536), (4, 10), (2, 1), (3, 50)])
def test_trie_equals_brute_force_whatever_the_blocks(spark, segment, block):
    rows = random_conversations(segment)
    got = trie_of(spark, [(*r, "a", "b") for r in rows], segment_turns=segment, block_turns=block)
    assert by_value(got) == by_value(brute_trie(rows))


def test_trie_of_a_long_conversation_and_a_hot_prefix(spark):
    # One conversation holds over a third of all turns; all others are equal.
    rows = [(0, t, "u", f"t{t % 7}") for t in range(700)]
    rows += [(5 * c, t, "u", "same") for c in range(1, 151) for t in range(8)]
    got = trie_of(spark, [(*r, None, None) for r in rows], segment_turns=64, block_turns=100)
    assert by_value(got) == by_value(brute_trie(rows))


def test_trie_without_conversations(spark):
    assert trie_of(spark, []) == []


def test_trie_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    got = [tuple(r) for r in QUERIES["op11_prefix_trie"](spark, SF).select(*NODE).collect()]
    assert by_value(got) == by_value(brute_trie(rows))


def test_radix_tree_layouts_grow_and_keep_every_key():
    rng = random.Random(3)
    for fan_out, layout in ((4, "Sparse"), (17, "Indexed"), (49, "Direct"), (256, "Direct")):
        root = prefix_trie.Node(b"", [])
        keys = [bytes([b]) + rng.randbytes(3) + b"tail" for b in rng.sample(range(256), fan_out)]
        keys += [k + b"more" for k in keys[:3]]
        for row, key in enumerate(keys):
            root.insert(key, row)
        assert type(root.kids).__name__ == layout
        found = {}

        def walk(node, before):
            for row in node.rows:
                found[row] = before + node.path
            for kid in node.kids or ():
                walk(kid, before + node.path)

        walk(root, b"")
        assert found == dict(enumerate(keys))
        assert [k.path[0] for k in root.kids] == sorted(k[0] for k in keys[:fan_out])


# ---------------------------------------------------------------- periodic runs


def brute_runs(words):
    n, found = len(words), {}
    for p in range(1, n // 3 + 1):
        i = 0
        while i + p < n:
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            if i > start and i - start + p >= max(24, 3 * p):
                found.setdefault((start, i - start + p), p)
            i += 1
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def random_words(rng):
    words = []
    for _ in range(rng.randint(0, 6)):
        if rng.random() < 0.5:
            words += [rng.randint(1, rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(0, 60))]
        else:
            unit = [rng.randint(1, rng.choice([1, 2, 5])) for _ in range(rng.randint(1, 20))]
            unit += unit[: rng.choice([0, len(unit) // 2])]
            words += unit * rng.randint(2, 9)
    return words


@pytest.mark.parametrize("pairs", [50, 3_000_000])
def test_runs_equal_brute_force(monkeypatch, pairs):
    monkeypatch.setattr(periodic, "PAIRS_AT_ONCE", pairs)
    rng, seen = random.Random(pairs), 0
    for _ in range(150):
        texts = [random_words(rng) for _ in range(rng.randint(1, 8))]
        for words, runs in zip(texts, periodic.runs_of([np.array(t, np.int64) for t in texts], 10)):
            want = brute_runs(words)
            assert [tuple(r) for r in runs.tolist()] == want
            seen += len(want)
    assert seen > 300


def test_extensions_equal_direct_comparison():
    rng = random.Random(1)
    for _ in range(40):
        words = [rng.randint(1, 2) for _ in range(rng.randint(2, 300))] * rng.randint(1, 4)
        longest = periodic.Extensions(np.array(words, np.int64))
        pairs = [sorted(rng.sample(range(len(words) + 1), 2)) for _ in range(200)]
        i, j = np.array(pairs).T
        for (a, b), got in zip(pairs, longest(i, j)):
            want = sum(1 for _ in itertools.takewhile(lambda k: words[a + k] == words[b + k], range(len(words) - b)))
            assert got == want


def expected_runs(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else (None, None, None)
    dropped = {k for s, n, p in runs for k in range(s + p, s + n)}
    kept = b" ".join(w for k, w in enumerate(words) if k not in dropped)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


RUNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_runs_of_odd_documents(spark):
    nbsp = "a b c "  # not ASCII white space: one word
    texts = [None, "", " \t\n\x0b\f\r", "a", "a " * 23, "a " * 24, "a b " * 400, nbsp * 30, "x\ny " * 5, "é " * 2000, "same", "same"]
    rows = [(k, t, "n", 1) for k, t in enumerate(texts)] + [(None, "b " * 30, None, None), (5, "a " * 24, "n", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_runs string, start long")
    got = [tuple(r) for r in periodic.periodic_runs(docs, ["doc_id"], rewrite_by="doc_id").select(*RUNS).collect()]
    assert by_value(got) == by_value([expected_runs(r[0], r[1]) for r in rows])
    assert periodic.periodic_runs(docs.limit(0), ["doc_id"]).collect() == []


def test_runs_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where(F.length("text") < 12_000)
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op12_periodic_runs"](spark, SF).select(*RUNS).collect()}
    rows = docs.collect()
    assert len(rows) > 150
    for r in rows:
        assert got[r["doc_id"]] == expected_runs(r["doc_id"], r["text"])


def test_time_of_a_long_periodic_text_is_not_quadratic():
    def seconds(n):
        times = []
        for _ in range(3):
            start = time.process_time()
            assert periodic.runs_of([np.ones(n, np.int64)], 1)[0].tolist() == [[0, n, 1]]
            times.append(time.process_time() - start)
        return min(times)

    assert seconds(80_000) < 9 * seconds(20_000)  # 16 times if quadratic


# ---------------------------------------------------------------- packing


@pytest.fixture(scope="module")
def tokenizer():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path("byte_bpe_50k.json")


def library_ids(tokenizer, text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer)
    t.encode_special_tokens = True
    return t.encode(text, add_special_tokens=False).ids


def test_remembered_words_give_the_librarys_ids(tokenizer, monkeypatch):
    rng = random.Random(5)
    alphabet = "aB9_' \n\t.,!-éÀɏ×÷²½ßğ  \x1ćдж中文🙂"
    encode = packing.Encoder(tokenizer)
    for k in range(400):
        letters = alphabet if k % 2 else alphabet[:20]
        text = "".join(rng.choice(letters) * rng.choice([1, 1, 1, 3]) for _ in range(rng.randint(0, 80)))
        text += rng.choice(["", "it's we'll I'd  x", "<|endoftext|>", "  \n "])
        assert np.frombuffer(encode(text), "<u4").tolist() == library_ids(tokenizer, text), repr(text)
    # A memory that starts anew, and long texts in blocks.
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    monkeypatch.setattr(packing, "AT_ONCE", 50)
    encode = packing.Encoder(tokenizer)
    for text in ("one two three four five " * 20, "中文 and дж  mixed\n words " * 40, "🙂" * 300, ""):
        assert np.frombuffer(encode(text), "<u4").tolist() == library_ids(tokenizer, text)


def check_packing(rows, lengths, capacity):
    """Gapless sequences within capacity; pieces that rebuild every document."""
    sequences, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        docs[r["doc_id"]].append((r["piece"], r["start"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    for doc_id, total in lengths.items():
        found = sorted(docs[doc_id])
        assert [p for p, _, _ in found] == list(range(-(-total // capacity)))
        assert [s for _, s, _ in found] == list(itertools.accumulate([0] + [n for _, _, n in found[:-1]]))
        assert sum(n for _, _, n in found) == total and all(n == capacity for _, _, n in found[1:])
    return len(sequences)


def test_packing_query_is_a_dense_round_trip(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    ids = {r["doc_id"]: library_ids(tokenizer, r["text"] or "") + [2] for r in docs}
    rows = QUERIES["op13_packing"](spark, SF).collect()
    n = check_packing(rows, {d: len(x) for d, x in ids.items()}, 1024)
    assert n <= 1.02 * -(-sum(map(len, ids.values())) // 1024) + 1
    for r in rows:
        part = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4")
        assert r["ids_crc32"] == zlib.crc32(part.tobytes())


def test_packing_odd_documents(spark, tokenizer):
    texts = [None, "", "a", "word " * 5000, "same text", "same text", "é" * 3000, "中 " * 4000]
    docs = spark.createDataFrame([(k, t, 7, "s") for k, t in enumerate(texts)], "doc_id long, text string, length long, offset string")
    rows = packing.pack_documents(docs.repartition(3), tokenizer, ["doc_id"], capacity=64, with_ids=True).collect()
    want = {k: library_ids(tokenizer, t or "") + [2] for k, t in enumerate(texts)}
    check_packing(rows, {k: len(x) for k, x in want.items()}, 64)
    for k, ids in want.items():
        assert [i for r in sorted((r for r in rows if r["doc_id"] == k), key=lambda r: r["piece"]) for i in r["ids"]] == ids
    none = spark.createDataFrame([(None, "no id"), (None, "no id")], "doc_id long, text string")
    assert len(packing.pack_documents(none, tokenizer, ["doc_id"]).collect()) == 2
    assert packing.pack_documents(docs.limit(0), tokenizer, ["doc_id"]).collect() == []


def fewest(lengths, capacity):
    """Smallest number of sequences, by trying all ways."""
    best = len(lengths)

    def put(k, room):
        nonlocal best
        if len(room) >= best:
            return
        if k == len(lengths):
            best = len(room)
            return
        for r in {x for x in room if x >= lengths[k]}:
            at = room.index(r)
            put(k + 1, room[:at] + [r - lengths[k]] + room[at + 1 :])
        put(k + 1, [*room, capacity - lengths[k]])

    put(0, [])
    return best


def test_plans_use_every_piece_and_few_sequences():
    rng = random.Random(2)
    for _ in range(60):
        lengths = sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 9))), reverse=True)
        plan = packing.plan(Counter(lengths), 20)
        assert Counter(x for pattern, times in plan for x in pattern * times) == Counter(lengths)
        assert all(sum(pattern) <= 20 for pattern, _ in plan)
        assert sum(times for _, times in plan) <= fewest(lengths, 20) + 1
    for n in (2_000, 2_000_000):  # the work does not grow with the number of pieces
        counts = Counter(rng.choices(range(1, 1025), k=2_000))
        counts = Counter({k: v * n // 2_000 for k, v in counts.items()})
        plan = packing.plan(counts)
        bound = -(-sum(k * v for k, v in counts.items()) // 1024)
        assert len(plan) < 5_000 and sum(times for _, times in plan) <= 1.03 * bound


def test_exact_complements_of_one_two_and_three():
    left = np.zeros(101, np.int64)
    left[[60, 40]] = 1
    assert packing.exact_combination(left, 60, 40) == (40,)
    left[40], left[25], left[15] = 0, 1, 1
    assert packing.exact_combination(left, 60, 40) == (25, 15)
    left[15], left[10], left[5] = 0, 1, 1
    assert packing.exact_combination(left, 60, 40) == (25, 10, 5)
    assert packing.exact_combination(left, 60, 40, most=2) is None
    left[[25, 10, 5]] = 0
    left[20] = 1
    assert packing.exact_combination(left, 60, 40) is None  # it would need 20 twice
