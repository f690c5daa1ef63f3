"""The registered queries of this subpackage, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callstats.llm import (
    decontam,
    mixing,
    packing,
    periodic,
    pii,
    prefix_trie,
    quality,
    secret_scan,
    sharding,
    simhash,
    stages,
    toxicity,
    urlfilter,
    warc,
)
from callstats.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: base findings and candidates the network accepts."""
    docs = _table(spark, sf_dir, "documents")
    net = secret_scan.train(secret_scan.labelled_findings(secret_scan.sample_texts(docs)))
    return secret_scan.scan(docs, net, ["doc_id"])


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base findings and candidates the trees accept."""
    docs = _table(spark, sf_dir, "documents")
    return pii.find_personal_data(docs, pii.train(docs), ["doc_id"])


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document in the mix of the sources."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs, stages.WEIGHTS, ["doc_id"])


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to WARC archives and read back by the salvage reader."""
    path = scratch_path(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    records = warc.read_archives(spark, path, payloads=False).where("found = 'record'")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document by the Feistel permutation."""
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return urlfilter.judge_urls(_table(spark, sf_dir, "pages"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and robust outlier verdict of every document."""
    return quality.judge_quality(_table(spark, sf_dir, "documents")).select(
        "doc_id", *quality.COUNTS, "base_failed", "kept", "distance"
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score and offending spans of every document."""
    docs = _table(spark, sf_dir, "documents")
    crf = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    held_out = F.coalesce(toxicity.fold_of() == 1, F.lit(False))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return toxicity.tag(docs, crf, ["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted", spans.alias("spans")
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", hexed.alias("fingerprint"), "component_id")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in a document, within its edit budget."""
    return decontam.contaminations(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every shared prefix of the rebuilt conversations."""
    turns = prefix_trie.numbered_turns(_table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(turns))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, rewritten by its id."""
    return periodic.periodic_runs(_table(spark, sf_dir, "documents"), ["doc_id"], rewrite_by="doc_id")


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces with their place in the packed sequences."""
    import public_tokenizers

    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer, ["doc_id"])


QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_pii": op2_pii,
    "op3_mixing": op3_mixing,
    "op4_warc": op4_warc,
    "op5_sharding": op5_sharding,
    "op6_url_filter": op6_url_filter,
    "op7_quality": op7_quality,
    "op8_toxicity": op8_toxicity,
    "op9_simhash": op9_simhash,
    "op10_decontamination": op10_decontamination,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_packing": op13_packing,
}

_UNITS = mixing.units_of(stages.WEIGHTS)
_PERIOD = ", ".join(f"('{s}', {j}, {slot}, {_UNITS[s]})" for s, j, slot in mixing.period_table(_UNITS))

_ROUND_KEYS = ", ".join(f"{k}::UHUGEINT" for k in sharding.round_keys(sharding.SEED))

ORACLE_SQL = {
    "op4_warc": r"""
WITH digests AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), encoded AS (
  -- Five hex digits are four letters of base32.
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda k:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  1 + ((('0x' || substr(hex, 5 * (k // 4) + 1, 5))::INT >> (15 - 5 * (k % 4))::INT) & 31), 1)), '') AS payload_digest
  FROM digests
), grouped AS (SELECT *, max(page_id) OVER (PARTITION BY payload_bytes, payload_digest) AS top FROM encoded)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM grouped
""",
    # list_transform([x], ...)[1] names an intermediate value.
    "op5_sharding": f"""
WITH RECURSIVE bytes AS (
  SELECT b, list_reduce([b] || range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS t
  FROM (SELECT unnest(range(256)) AS b)
), crc_table AS (SELECT list(t ORDER BY b) AS t FROM bytes), sums AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
         xor(4294967295, list_reduce(
           [4294967295::BIGINT] || list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT),
           lambda c, v: xor(c >> 8, t[xor(c & 255, v) + 1]))) AS text_crc32
  FROM documents, crc_table
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS number, count(*) OVER () AS n FROM sums
), sized AS (
  -- Half of the bits of the next even power of two, as a factor.
  SELECT *, (1::BIGINT << greatest(1, (length(bin(n - 1)) + 1) // 2)::BIGINT)::UHUGEINT AS half FROM numbered
), walk AS (
  SELECT number, n, half, number::UHUGEINT AS x, n <= 1 AS done FROM sized
  UNION ALL
  SELECT number, n, half, y, y < n FROM (
    SELECT number, n, half, list_reduce([x, {_ROUND_KEYS}], lambda s, k:
      (s % half) * half + xor(s // half, list_transform(list_transform(list_transform(
        [(s % half + k) % 18446744073709551616::UHUGEINT],
        lambda v: xor(v, v // 1073741824) * 13787848793156543929::UHUGEINT % 18446744073709551616::UHUGEINT),
        lambda v: xor(v, v // 134217728) * 10723151780598845931::UHUGEINT % 18446744073709551616::UHUGEINT),
        lambda v: xor(v, v // 2147483648))[1] % half)) AS y
    FROM walk WHERE NOT done)
), moved AS (SELECT number, x FROM walk WHERE done)
SELECT doc_id, size, text_crc32, 'rows' AS law, (x % {stages.SHARDS})::INT AS shard,
       (x // {stages.SHARDS})::BIGINT AS slot, NULL::INT AS grown_shard
FROM numbered JOIN moved USING (number)
""",
    # One period of the schedule is a fixed table of the weights; the tests
    # check it against the definition of the windows.
    "op3_mixing": f"""
WITH period(s, j, slot_in, n) AS (VALUES {_PERIOD}),
streams AS (SELECT DISTINCT s FROM period),
ranked AS (
  SELECT doc_id, source, coalesce(s, '*') AS stream,
         row_number() OVER (PARTITION BY coalesce(s, '*') ORDER BY doc_id NULLS FIRST) - 1 AS rank
  FROM documents LEFT JOIN streams ON source = s
), blocks AS (SELECT *, rank // {mixing.BLOCK_ROWS} AS block FROM ranked)
SELECT doc_id, source, stream, block, (block // n) * {mixing.PERIOD} + slot_in AS slot,
       (block * {mixing.PERIOD}) // n AS release, ((block + 1) * {mixing.PERIOD} + n - 1) // n AS deadline,
       ((block // n) * {mixing.PERIOD} + slot_in) * {mixing.BLOCK_ROWS} + rank % {mixing.BLOCK_ROWS} AS position
FROM blocks JOIN period ON stream = s AND block % n = j
""",
    "op6_url_filter": r"""
WITH u AS (
  SELECT page_id, coalesce(regexp_extract(url, '^.*?://(.*)$', 1, 's'), '') AS rest FROM pages
), hp AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), r(verdict, rule_host, rule_path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), fit AS (
  SELECT page_id, max(struct_pack(len := length(rule_host) + length(rule_path), rule := rule_host || rule_path, verdict := r.verdict)) AS best
  FROM hp JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id
)
SELECT hp.page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
FROM hp LEFT JOIN fit ON hp.page_id = fit.page_id
""",
    # Prefixes are named by the digests of their turns, joined; the smallest
    # member of a node owns it, so that each is counted once.
    "op11_prefix_trie": r"""
WITH bytes AS (
  SELECT b, list_reduce([b] || range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS t
  FROM (SELECT unnest(range(256)) AS b)
), crc_table AS (SELECT list(t ORDER BY b) AS t FROM bytes), slim AS (
  SELECT conv_id, turn, octet_length(encode(coalesce(text, ''))) AS n_bytes,
         sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS id
  FROM conversations WHERE conv_id IS NOT NULL
), turns AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) - 1 AS pos FROM slim
), convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS giver, xor(4294967295, list_reduce(
           [4294967295::BIGINT] || list_transform(regexp_extract_all(hex(encode(conv_id::VARCHAR)), '..'), lambda x: ('0x' || x)::BIGINT),
           lambda c, v: xor(c >> 8, t[xor(c & 255, v) + 1]))) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), crc_table
), path AS (
  SELECT c.conv_id, 0 AS part, t.pos, t.id, t.n_bytes FROM convs c JOIN turns t ON t.conv_id = c.giver AND t.pos < c.h
  UNION ALL
  SELECT c.conv_id, 1, t.pos, t.id, t.n_bytes FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos >= c.h
), steps AS (
  SELECT conv_id, n_bytes, row_number() OVER w AS depth, string_agg(id, '') OVER w AS prefix
  FROM path WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), sized AS (SELECT *, max(depth) OVER (PARTITION BY conv_id) AS len FROM steps),
nodes AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = len) AS ends
  FROM sized GROUP BY prefix, depth
), kids AS (SELECT substr(prefix, 1, length(prefix) - 64) AS prefix, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
known AS (
  SELECT s.*, s.conv_id = n.conv_id AS own, coalesce(k.n, 0) AS n_children
  FROM sized s JOIN nodes n ON s.prefix = n.prefix LEFT JOIN kids k ON s.prefix = k.prefix
), summed AS (
  SELECT prefix, sum(CASE WHEN own THEN 0 ELSE n_bytes END) OVER (PARTITION BY conv_id ORDER BY depth DESC) AS saved,
         max((depth = len AND own AND n_children = 0)::INT) OVER (PARTITION BY conv_id) AS leaf
  FROM known
), totals AS (SELECT prefix, sum(saved) AS saved, sum(leaf) AS leaves FROM summed GROUP BY prefix)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0)::BIGINT AS n_children,
       t.leaves::BIGINT AS n_leaves, t.saved::BIGINT AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n JOIN totals t ON n.prefix = t.prefix LEFT JOIN kids k ON n.prefix = k.prefix
LEFT JOIN nodes p ON n.depth > 0 AND p.prefix = substr(n.prefix, 1, length(n.prefix) - 64)
""",
}
