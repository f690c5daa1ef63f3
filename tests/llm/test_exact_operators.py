"""Operators with one right answer, against brute force on small fixtures."""

import base64
import binascii
import gzip
import hashlib
import random
import time

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from callstats.llm import decontam, mixing, sharding, simhash, urlfilter, warc
from callstats.llm.queries import QUERIES
from callstats.session import scratch_path

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard string, fp string, score string"
ODD_TEXTS = [None, "", " \t\n", "a", "a b", "word " * 30_000, "é" * 5000, "same text here", "same text here", "x\ny\nx\ny"]


def odd_docs(spark):
    """NULLs, empty and long texts, repeated rows and columns named like results."""
    rows = [(k, t, "en" if k % 2 else None, f"src{k % 3}" if k else None, 1, "s", "f", "z") for k, t in enumerate(ODD_TEXTS)]
    rows += [rows[7], rows[7], (None, "no id", None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


# ---------------------------------------------------------------- sharding


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 1000, 4097])
def test_feistel_is_a_permutation_and_inverts(n):
    x = np.arange(n)
    y = sharding.feistel(x, n, 5)
    assert sorted(y) == list(range(n))
    assert (sharding.feistel(y, n, 5, inverse=True) == x).all()


@pytest.mark.parametrize("n, window", [(1, 4), (10, 4), (12, 4), (1000, 64), (1000, 2000)])
def test_permutation_in_windows(n, window):
    x = np.random.default_rng(0).permutation(n)
    y = sharding.permute(x, n, 5, window)
    assert sorted(y) == list(range(n))
    assert (y // window == x // window).all() or window >= n


def test_shards_are_even_gapless_and_reproducible(spark):
    docs = odd_docs(spark)
    got = sharding.shard_documents(docs, shards=4).collect()
    again = sharding.shard_documents(docs.repartition(5), shards=4).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == docs.count()
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in got:
        body = text[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(body) + 1, binascii.crc32(body))
    assert sharding.shard_documents(empty_docs(spark)).count() == 0


def test_sharding_follows_the_permutation(spark):
    got = QUERIES["op5_sharding"](spark, SF).collect()
    ids = sorted(r["doc_id"] for r in got)
    moved = sharding.feistel(np.arange(len(ids)), len(ids), sharding.SEED)
    want = {d: (m % 16, m // 16) for d, m in zip(ids, moved)}
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in got} == want


# ---------------------------------------------------------------- mixing


def test_units_add_up():
    units = mixing.units_of({"a": 1, "b": 2.5, "c": 1e-9}, 100)
    assert sum(units.values()) == 100 and min(units.values()) >= 1
    with pytest.raises(ValueError):
        mixing.units_of({"a": 0})


@pytest.mark.parametrize("seed", range(5))
def test_schedule_stays_within_a_block(seed):
    rng = random.Random(seed)
    units = mixing.units_of({str(k): rng.random() + 0.01 for k in range(rng.randint(1, 12))}, 200)
    table = mixing.period_table(units)
    period = sum(units.values())
    assert [slot for _, _, slot in table] == list(range(period))
    placed = dict.fromkeys(units, 0)
    for s, j, slot in table:
        assert j == placed[s]
        placed[s] += 1
        assert all(abs(n * period - units[x] * (slot + 1)) < period for x, n in placed.items())
    assert placed == units


def test_mix_places_every_row_once(spark):
    docs = odd_docs(spark).withColumn("slot", F.lit("mine"))
    got = mixing.mix(docs, {"src0": 1, "src1": 2}, ["doc_id"], block_rows=2, period=7)
    assert got.columns.count("slot") == 1
    rows = got.collect()
    assert len(rows) == docs.count() and len({r["position"] for r in rows}) == len(rows)
    assert {r["stream"] for r in rows} == {"src0", "src1", "*"}
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in rows)
    assert mixing.mix(empty_docs(spark), {"src0": 1}, ["doc_id"]).count() == 0


# ---------------------------------------------------------------- WARC


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, reason string")


def test_warc_round_trip(spark):
    rows = [(1, "http://a/ b\r\n", "<p>é</p>", "x"), (2, None, "<p>é</p>", None), (3, "u", None, None), (4, "u", "", None)]
    rows += [(5, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 50, None), (6, "u", "z" * 3_000_000, None), (None, "u", "q", None)]
    for members in (True, False):
        path = scratch_path(spark, "warc-test")
        warc.write_archives(pages(spark, rows), path, members=members)
        got = {r["page_id"]: r for r in warc.read_archives(spark, path).collect()}
        assert len(got) == len(rows) and {r["found"] for r in got.values()} == {"record"}
        for k, _, html, _ in rows:
            body = (html or "").encode()
            r = got[k]
            assert r["payload_bytes"] == len(body)
            assert r["payload_digest"] == base64.b32encode(hashlib.sha1(body).digest()).decode()
            same = [x for x, _, h, _ in rows if (h or "") == (html or "") and x is not None]
            last = max(same, default=None)
            assert (r["record_type"], r["refers_to"]) == (("response", None) if k == last else ("revisit", last))
            assert r["payload"] is None if r["record_type"] == "revisit" else bytes(r["payload"]) == body
    path = scratch_path(spark, "warc-empty")
    warc.write_archives(pages(spark, []), path)
    assert warc.read_archives(spark, path).count() == 0


def test_small_payloads_are_all_responses(spark):
    path = scratch_path(spark, "warc-small")
    warc.write_archives(pages(spark, [(1, "u", "ab", None), (2, "u", "ab", None)]), path, min_bytes=3)
    assert {r["record_type"] for r in warc.read_archives(spark, path).collect()} == {"response"}


@pytest.mark.parametrize("members", [True, False])
@pytest.mark.parametrize("harm", ["cut", "flip", "junk", "tail"])
def test_salvage_recovers_what_follows(members, harm):
    recs = [
        warc.record_bytes(k, "http://x/", b"payload %d " % k * 40, warc.base32_sha1(b"payload %d " % k * 40), None, False)
        for k in range(5)
    ]
    parts = [gzip.compress(r, mtime=0) if members else r for r in recs]
    start = len(b"".join(parts[:2]))
    if harm == "cut":
        parts[2] = parts[2][: len(parts[2]) // 2]
    elif harm == "flip":
        k = len(parts[2]) - 30
        parts[2] = parts[2][:k] + bytes([parts[2][k] ^ 255]) + parts[2][k + 1 :]
    elif harm == "junk":
        parts.insert(2, b"\x00junk\x1f\x8b\x08junk WARC/1.1\r\n more")
    else:
        parts[4] = parts[4][:-40]
    data = b"".join(parts)
    found = list(warc.salvage(data))
    ids = [r["page_id"] for r in found if r["found"] == "record"]
    gaps = [r for r in found if r["found"] == "gap"]
    lost = {"cut": {2}, "flip": {2}, "junk": set(), "tail": {4}}[harm]
    assert ids == [k for k in range(5) if k not in lost]
    assert len(gaps) == 1 and gaps[0]["reason"]
    assert gaps[0]["at"] == (start if harm != "tail" else len(b"".join(parts[:4])))
    # Records and gaps cover the archive.
    spans = sorted((r["at"], r["at"] + r["length"]) for r in found)
    assert spans[0][0] == 0 and all(a[1] >= b[0] for a, b in zip(spans, spans[1:])) and spans[-1][1] == len(data)


def archive_of(n=5, size=40):
    recs = []
    for k in range(n):
        body = random.Random(k).randbytes(size * 10).hex().encode()
        recs.append(warc.record_bytes(k, "http://x/", body, warc.base32_sha1(body), None, False))
    return recs


def ids_and_gaps(data):
    found = list(warc.salvage(data))
    return [r["page_id"] for r in found if r["found"] == "record"], [r for r in found if r["found"] == "gap"]


@pytest.mark.parametrize("level", [0, 6])
def test_salvage_inside_a_member_of_several_records(level):
    recs = archive_of()
    whole = b"".join(recs)
    at = len(recs[0]) + len(recs[1])
    # One damaged record in a sound member: the others are read, one gap.
    harmed = whole[: at + 400] + b"#" + whole[at + 401 :]
    ids, gaps = ids_and_gaps(gzip.compress(harmed, level, mtime=0))
    assert ids == [0, 1, 3, 4] and len(gaps) == 1
    assert f"unpacked bytes {at} to {at + len(recs[2])}" in gaps[0]["reason"]
    # A member that is cut off: its whole records, and a gap for it.
    packed = gzip.compress(whole, level, mtime=0)
    ids, gaps = ids_and_gaps(packed[: len(packed) * 9 // 10])
    assert ids == [0, 1, 2, 3] and [g["reason"] for g in gaps] == ["member is cut off"]
    # A wrong byte in the compressed data: what came before is kept, members after are read.
    k = len(packed) // 2
    broken = packed[:k] + bytes([packed[k] ^ 255]) + packed[k + 1 :]
    later = gzip.compress(archive_of(7)[6], mtime=0)
    ids, gaps = ids_and_gaps(broken + later)
    assert ids[:2] == [0, 1] and ids[-1] == 6 and len(ids) == len(set(ids)) and gaps
    assert all(g["at"] + g["length"] <= len(broken) for g in gaps)


def test_salvage_of_a_large_member_keeps_what_unpacked_before_the_error():
    recs = archive_of(40, 1000)
    packed = gzip.compress(b"".join(recs), mtime=0)
    for share in (0.2, 0.55, 0.97):
        k = int(len(packed) * share)
        ids, gaps = ids_and_gaps(packed[:k] + bytes([packed[k] ^ 255]) + packed[k + 1 :])
        assert ids[: int(40 * share) - 1] == list(range(int(40 * share) - 1)) and len(gaps) >= 1


def seconds(call, *args):
    times = []
    for _ in range(3):
        start = time.process_time()
        call(*args)
        times.append(time.process_time() - start)
    return min(times)


def test_damaged_archives_take_linear_time():
    def bare(n):
        return list(warc.salvage(b"WARC/1.1\r\n" * n))

    assert [r["found"] for r in bare(1000)] == ["gap"]
    assert seconds(bare, 80_000) < 6 * seconds(bare, 20_000) and seconds(bare, 100_000) < 5
    # A long header and a long payload are no damage.
    rec = warc.record_bytes(1, "http://x/" + "a" * 300_000, b"\nWARC/1.1\r\n" * 30_000, warc.base32_sha1(b"\nWARC/1.1\r\n" * 30_000), None, False)
    ids, gaps = ids_and_gaps(rec * 3)
    assert ids == [1, 1, 1] and gaps == []


def test_salvage_of_nothing():
    assert list(warc.salvage(b"")) == []
    assert [r["found"] for r in warc.salvage(b"no archive")] == ["gap"]


# ---------------------------------------------------------------- SimHash shards


def test_shards_keep_their_size_beyond_the_sample(spark, monkeypatch):
    """More shards than SAMPLE_POINTS: the sample grows, and the links are exact."""
    monkeypatch.setattr(simhash, "SAMPLE_POINTS", 4)
    rng = random.Random(9)
    points = [rng.getrandbits(64) for _ in range(1500)]
    points += [p ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for p in points[:300]]
    signed = [p - (1 << 64) if p >> 63 else p for p in set(points)]
    distinct = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = simhash.near_links(distinct, 3, shard_points=64).collect()
    parent = {p: p for p in signed}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for r in links:
        parent[root(r["a"])] = root(r["b"])
    x = np.array(signed, dtype=np.int64).view(np.uint64)
    for k, p in enumerate(signed):
        for j in np.flatnonzero(np.bitwise_count(x ^ x[k]) <= 3):
            assert root(p) == root(signed[j])
    assert len({root(p) for p in signed}) >= 1400


# ---------------------------------------------------------------- URL filter


def brute_rule(rules, host, path):
    best = None
    for verdict, h, p in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            rank = (h.count("."), len(p), verdict == "block")
            if best is None or rank > best[0]:
                best = (rank, h + p, verdict)
    return best and best[1:]


def test_long_urls_take_linear_time():
    trie = urlfilter.build_trie([("block", "a", "/x"), ("allow", "a", "/x/yy"), ("allow", "a", "/x/yyyyyyyy")])

    def judge(n):
        return urlfilter.lookup(trie, "a", "/x/" + "y" * n), urlfilter.lookup(trie, "a", "/" + "x/" * n)

    assert judge(1000)[0][1:] == ("a/x/yyyyyyyy", "allow") and judge(1000)[1][1:] == ("a/x", "block")
    assert seconds(judge, 1_000_000) < 1 and seconds(judge, 800_000) < 8 * seconds(judge, 200_000) + 0.05


def test_trie_equals_brute_force():
    rng = random.Random(1)
    hosts = ["a", "b.a", "c.b.a", "x", ".a", "a.", "", "aa", "b..a"]
    paths = ["", "/", "/e", "/en", "/en/", "/en/x", "/en/x/", "/enx", "//", "/en//x"]
    for _ in range(300):
        rules = [(rng.choice(["allow", "block"]), rng.choice(hosts[:4]), rng.choice(paths)) for _ in range(rng.randint(0, 8))]
        trie = urlfilter.build_trie(rules)
        for host in hosts:
            for path in paths:
                got = urlfilter.lookup(trie, host, path)
                assert (got and got[1:]) == brute_rule(rules, host, path), (rules, host, path)


def test_judged_urls(spark):
    urls = [None, "", "no scheme", "://", "http://A.NET", "http://a.net?x/", "http://EXAMPLE.net/en/é#f", "x://y.org/fr/?q", "h://z.com://b.net/"]
    rows = spark.createDataFrame([(k, u, "mine") for k, u in enumerate(urls)], "page_id long, url string, host string")
    whole = urlfilter.judge_urls(rows).collect()
    in_blocks = urlfilter.judge_urls(rows, max_trie_chars=1).collect()
    assert sorted(map(str, whole)) == sorted(map(str, in_blocks))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in whole}
    assert got[0] == got[1] == got[2] == got[3] == ("", "", None, "allow")
    assert got[4] == ("a.net", "", None, "allow") and got[5] == ("a.net", "", None, "allow")
    assert got[6] == ("example.net", "/en/é", "example.net/en/", "allow")
    assert got[7] == ("y.org", "/fr/", "org/fr/", "allow") and got[8] == ("z.com:", "//b.net/", None, "allow")
    assert urlfilter.judge_urls(rows.limit(0)).count() == 0


# ---------------------------------------------------------------- SimHash


def brute_fingerprint(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    grams = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [t for t in ODD_TEXTS if t is not None] + ["É A b\x0bC\x1cd e", "One two three four FIVE six"])
def test_fingerprint_equals_brute_force(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def brute_components(points, radius):
    label = list(range(len(points)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for i in range(len(points)):
        for j in range(i):
            if bin(points[i] ^ points[j]).count("1") <= radius:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return [root(k) for k in range(len(points))]


def clustered(n, seed):
    """Fingerprints with chains and balls of near ones, across all boundaries."""
    rng = random.Random(seed)
    points = [rng.getrandbits(64) for _ in range(n // 3)]
    while len(points) < n:
        p = rng.choice(points)
        for _ in range(rng.randint(1, 5)):
            p ^= 1 << rng.randrange(64)
        points.append(p)
    return list(dict.fromkeys(points))


@pytest.mark.parametrize("seed", range(4))
def test_shard_links_equal_brute_force(seed):
    points = clustered(700, seed)
    want = brute_components(points, 3)
    got = simhash.link_shard(np.array(points, dtype=np.uint64), np.ones(len(points), bool), 3)
    assert {(a, b) for a, b in zip(got, want)} == {(got[k], want[k]) for k in {want.index(w) for w in set(want)}}


def test_near_links_over_many_shards_equal_brute_force(spark):
    points = clustered(1500, 9)
    signed = np.array(points, dtype=np.uint64).view(np.int64)
    table = spark.createDataFrame([(int(p),) for p in signed], "fp long")
    labels = {r["node"]: r["label"] for r in simhash.components(simhash.near_links(table, 3, shard_points=40)).collect()}
    got = {}
    for k, p in enumerate(signed):
        got.setdefault(labels.get(int(p), int(p)), set()).add(k)
    want = {}
    for k, c in enumerate(brute_components(points, 3)):
        want.setdefault(c, set()).add(k)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_a_long_chain_is_one_component(spark):
    links = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r["label"] for r in simhash.components(links).collect()} == {0}


def test_links_that_name_other_representatives_when_run_again(spark):
    """As in shards whose rows arrive in another order: each run of the links
    joins the same groups of ten, through a point drawn anew."""

    def star(batches):
        for b in batches:
            for first in b.column(0).to_pylist():
                hub = first + random.SystemRandom().randrange(10)
                rest = [p for p in range(first, first + 10) if p != hub]
                yield pa.RecordBatch.from_arrays([pa.array(rest), pa.array([hub] * 9)], names=["a", "b"])

    links = spark.range(0, 400, 10).mapInArrow(star, "a long, b long")
    got = {r["node"]: r["label"] for r in simhash.components(links).collect()}
    assert got == {p: p // 10 * 10 for p in range(400)}


def test_links_do_not_depend_on_the_order_of_rows(spark):
    points = [int(p) for p in np.array(clustered(600, 3), dtype=np.uint64).view(np.int64)]
    runs = []
    for rows in (points, points[::-1]):
        table = spark.createDataFrame([(p,) for p in rows], "fp long")
        runs.append(sorted(map(tuple, simhash.near_links(table, 3, shard_points=100).collect())))
    assert runs[0] == runs[1] and runs[0]


def test_near_duplicates_of_odd_documents(spark):
    got = simhash.near_duplicates(odd_docs(spark)).collect()
    assert len(got) == len(ODD_TEXTS) + 3
    of = {r["doc_id"]: r["component_id"] for r in got}
    assert of[0] == of[1] == of[2] == 0 and of[7] == of[8] == 7 and of[None] is None
    assert simhash.near_duplicates(empty_docs(spark)).count() == 0


def brute_byte_fingerprint(raw):
    words = __import__("re").findall(rb"[^\x20\x09-\x0D]+", bytes(c + 32 if 65 <= c <= 90 else c for c in raw or b""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[k : k + 3]), 42) for k in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_query_equals_brute_force_on_odd_rows(spark, tmp_out):
    """Any separators, malformed UTF-8, fingerprints near zero and chains of near copies."""
    rng = random.Random(6)
    seps = [b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r", b"\x1c", b"\x85", b"\xc2\xa0", b"\xe3\x80\x80", b"\x00"]
    words = [b"a", b"B", "É".encode(), "İ".encode(), "K".encode(), "😀".encode(), b"\xff", b"\xc3", b"\xed\xa0\x80", b"[", b"Z"]
    raws = [None, b"", b" \t\n\r\x0b\x0c", b"\x1c", b"\xff", b"Same \xff TEXT here", b"same \xff text HERE"]
    raws += [b"".join(rng.choice(words) + rng.choice(seps) for _ in range(n)) for n in range(1, 12) for _ in range(12)]
    # Fingerprints of three bits, which links to texts without words, and of four.
    raws += [b"p%d q%d r%d s%d" % (k, k, k, k) for k in (165570, 13418, 18947)]
    assert [brute_byte_fingerprint(r).bit_count() for r in raws[-3:]] == [3, 4, 4]
    base = [b"v%d" % rng.randrange(3000) for _ in range(300)]
    for _ in range(60):
        base[rng.randrange(300)] = b"v%d" % rng.randrange(3000)
        raws.append(b" ".join(base))
    ids = list(range(len(raws)))
    rng.shuffle(ids)
    rows = spark.createDataFrame([(i, r and bytearray(r)) for i, r in zip(ids, raws)], "doc_id long, raw binary")
    rows.select("doc_id", F.col("raw").cast("string").alias("text")).write.parquet(f"{tmp_out}/documents.parquet")
    points = [brute_byte_fingerprint(r) for r in raws]
    groups = {}
    for i, c in zip(ids, component := brute_components(points, 3)):
        groups[c] = min(groups.get(c, i), i)
    want = {(i, f"{p:016x}", groups[c]) for i, p, c in zip(ids, points, component)}
    got = [tuple(r) for r in QUERIES["op9_simhash"](spark, tmp_out).collect()]
    assert len(got) == len(raws) and set(got) == want


# ---------------------------------------------------------------- decontamination


def brute_distance(pattern, text):
    """Smallest edit distance of the pattern to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        before, row = row, [i]
        for j, d in enumerate(text, 1):
            row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (c != d)))
    return min(row)


def test_myers_equals_brute_force():
    rng = random.Random(3)
    for _ in range(400):
        pattern = "".join(rng.choice("ab ") for _ in range(rng.randint(1, 70)))
        text = "".join(rng.choice("abc") for _ in range(rng.randint(0, 90)))
        if rng.random() < 0.6:
            k = rng.randint(0, len(pattern))
            text += pattern[:k] + rng.choice(["", "c", "cc"]) + pattern[k + rng.randint(0, 2) :] + text
        best = brute_distance(pattern, text)
        got = decontam.myers(pattern, text, best)
        assert got is not None and got[0] == best
        assert best == 0 or decontam.myers(pattern, text, best - 1) is None


def edited(text, k, rng):
    out = list(text)
    for _ in range(k):
        at = rng.randrange(len(out))
        out[at : at + 1] = rng.choice(["", "#", out[at] + "#"])
    return "".join(out)


def test_items_within_budget_are_found_and_others_not():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.choice([2, 6, 15, 40])))) for k in range(40)]
    automaton, table = decontam.build_automaton([*items, (98, None), (99, "  ")])
    assert len(table) == 40
    for item_id, text in items:
        k = decontam.budget(len(text))
        for edits in (0, k, k + 6):
            noise = " ".join(rng.choice(words) for _ in range(30))
            doc = f"{noise} {edited(text, edits, rng).upper()}\n{noise}"
            got = {f[0]: f for f in decontam.find_items(automaton, table, doc)}
            want = brute_distance(text, decontam.normalize(doc))
            assert (item_id in got) == (want <= k)
            if item_id in got:
                _, distance, start, end = got[item_id]
                assert distance == want
                assert brute_distance(decontam.normalize(doc)[start:end], text) <= k


def test_contaminations_in_blocks_and_odd_documents(spark):
    benchmark = spark.createDataFrame(
        [(1, "the quick brown fox jumps over the lazy dog"), (2, "same text here"), (3, None), (4, ""), (5, "same text here")],
        "item_id int, text string",
    )
    docs = odd_docs(spark).unionByName(odd_docs(spark).limit(1).selectExpr(
        "77L as doc_id", "concat('xx The quick brown fox jumps ovr the lazy dog', repeat(' y', 20000)) as text",
        "lang", "source", "n_chars", "shard", "fp", "score"))
    one = decontam.contaminations(docs, benchmark).collect()
    blocks = decontam.contaminations(docs, benchmark, max_block_chars=20).collect()
    assert sorted(map(str, one)) == sorted(map(str, blocks))
    assert {(r["doc_id"], r["item_id"], r["distance"]) for r in one} == {(77, 1, 1), (7, 2, 0), (7, 5, 0), (8, 2, 0), (8, 5, 0)}
    assert sum(r["doc_id"] == 7 for r in one) == 6  # the row is there three times
    for chars in (10_000, 20):
        clean = decontam.drop_contaminated(docs, benchmark, chars)
        assert clean.columns == docs.columns
        assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in docs.collect()} - {7, 8, 77}
    assert decontam.contaminations(docs, benchmark.limit(0)).count() == 0
    assert decontam.contaminations(empty_docs(spark), benchmark).count() == 0
