"""Registered queries of this package: each applies one operator to its whole
table with production parameters and derives the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as tokenizer_file
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, exact_dedup, huffman, license_scan, merkle, packing, prefix_trie, quality, simhash, token_counts, toxicity, url_filter, warc
from tidemark.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]

# (verdict, host, path prefix): the longest fitting rule decides
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
# globs over host and path, for urls that no rule fits
URL_ALLOW = ["**.html"]
URL_BLOCK = ["m.*/**", "*.example.net/*/?", "*.example.net/*/??", "**.exe", "**.zip", "**/wp-login*", "**/admin/**"]


def op1_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = huffman.encode_and_read(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), end_id=1)
    return ids.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its score, expected grade, P(grade >= 1) and whether it is kept."""
    return quality.select(table(spark, sf_dir, "documents"), quality.ratings(table(spark, sf_dir, "labels")))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.url_verdicts(table(spark, sf_dir, "pages"), URL_RULES, URL_ALLOW, URL_BLOCK, default="allow")
    return judged.select("page_id", "host", "path", "rule", "verdict")


def pieces(docs: DataFrame) -> DataFrame:
    packed = packing.pack(docs, tokenizer_file("word_bpe_49k.json"), end_id=2, capacity=4096)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each benchmark item that a document holds; clean documents have none."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.write_and_read(table(spark, sf_dir, "pages"), min_revisit=100)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), limit=1024)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations."""
    turns, convs = prefix_trie.rebuilt(prefix_trie.turns_of(table(spark, sf_dir, "conversations")), block=20, most=4)
    return prefix_trie.trie(turns, convs)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents; those whose crc32 of the id is divisible by 7 are checked with n_chars + 1."""
    def tampered(fields: dict[str, Column]) -> dict[str, Column]:
        more = fields["n_chars"].cast("decimal(20,0)") + 1
        return {**fields, "n_chars": F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, more).otherwise(fields["n_chars"])}

    return merkle.verified(merkle.manifest(table(spark, sf_dir, "documents"), tampered))


LICENSE_PHRASES = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"), LICENSE_PHRASES)


QUERIES: dict[str, Query] = {
    "op1_huffman_ids": op1_huffman_ids,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_quality": op3_quality,
    "op4_url_filter": op4_url_filter,
    "op5_packing": op5_packing,
    "op6_simhash": op6_simhash,
    "op7_decontaminate": op7_decontaminate,
    "op8_toxicity": op8_toxicity,
    "op9_warc": op9_warc,
    "op10_token_counts": op10_token_counts,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_license_scan": op13_license_scan,
}

# unsigned crc32 of a number's decimal text
CRC32 = """xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST({} AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))))"""

# a row's fields with their lengths
LEAF = " || ".join(f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", "text"))

# the templates of the license scan: text, label, whether a phrase
TEMPLATES = ", ".join("('{}', '{}', {})".format(text.replace("'", "''"), label, phrase) for phrase, pairs in
                      ((True, LICENSE_PHRASES), (False, [(t, name) for name, t in license_scan.LICENSES])) for text, label in pairs)
LICENSE_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLE_SQL: dict[str, str] = {
    "op2_exact_dedup": """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
     n AS (SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) AS nth FROM d)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size, nth = 1 AS kept, text_sha256
FROM n
""",
    "op4_url_filter": r"""
WITH parts AS (SELECT page_id,
           CASE WHEN contains(url, '://') THEN translate(regexp_extract(url, '^(.*?)://([^/?#]*)', 2, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
           CASE WHEN contains(url, '://') THEN regexp_extract(url, '^(.*?)://([^/?#]*)([^?#]*)', 3, 's') ELSE '' END AS path
         FROM pages),
     ruled AS (SELECT *, CASE
           WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
           WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
           WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
           WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
           WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule,
           host || path AS place FROM parts)
SELECT page_id, host, path, rule, CASE
       WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN ends_with(place, '.html') THEN 'allow'
       WHEN regexp_full_match(place, 'm\.[^/]*/.*', 's') OR regexp_full_match(place, '[^/]*\.example\.net/[^/]*/[^/]{1,2}', 's')
            OR ends_with(place, '.exe') OR ends_with(place, '.zip') OR regexp_full_match(place, '.*/wp-login[^/]*', 's') OR contains(place, '/admin/') THEN 'block'
       ELSE 'allow' END AS verdict
FROM ruled
""",
    "op9_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
     d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
     n AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id,
                  row_number() OVER (PARTITION BY payload_digest ORDER BY page_id NULLS LAST) AS nth FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND nth > 1 AND first_id IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND nth > 1 THEN first_id END AS refers_to
FROM n
""",
    "op11_prefix_trie": """
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text)) - 1 AS place FROM t),
c AS (SELECT conv_id, coalesce(""" + CRC32.format("conv_id") + """ % 4, 0) AS h, conv_id - conv_id % 20 AS base FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, 0 AS own, o.place, o.role, o.text FROM c JOIN o ON o.conv_id = c.base AND o.place < c.h
      UNION ALL SELECT c.conv_id, 1, o.place, o.role, o.text FROM c JOIN o ON o.conv_id IS NOT DISTINCT FROM c.conv_id AND o.place >= c.h),
s AS (SELECT c.conv_id, coalesce(list(struct_pack(role := r.role, text := r.text) ORDER BY own, place) FILTER (WHERE r.place IS NOT NULL), []) AS turns
      FROM c LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY c.conv_id),
m AS (SELECT conv_id, d, turns[1:d] AS node, d = len(turns) AS ends FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM s)),
n AS (SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ends FROM m GROUP BY node, d),
k AS (SELECT node[1:d - 1] AS node, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
u AS (SELECT n.*, coalesce(n_children, 0) AS n_children,
             CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(node[d].text, '[^\x20\x09-\x0D]+')) END AS save FROM n LEFT JOIN k USING (node)),
b AS (SELECT node[1:j] AS node, CAST(count_if(n_children = 0) AS BIGINT) AS n_leaves, CAST(sum(save) AS BIGINT) AS saved_tokens
      FROM (SELECT *, unnest(range(0, d + 1)) AS j FROM u) GROUP BY 1)
SELECT u.conv_id, u.d AS depth, p.conv_id AS parent_conv_id, u.n_convs, u.n_children, b.n_leaves, b.saved_tokens, sha256(u.ends) AS ends_sha256
FROM u JOIN b USING (node) LEFT JOIN n p ON u.d > 0 AND p.node = u.node[1:u.d - 1]
""",
    "op12_merkle_manifest": """
WITH RECURSIVE f AS (SELECT *, """ + CRC32.format("doc_id") + """ % 7 = 0 AS tampered FROM documents),
d AS (SELECT doc_id, lang, sha256({own}) AS leaf, CASE WHEN tampered THEN sha256({other}) END AS other FROM f),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n FROM d),
t AS (SELECT lang, 0 AS level, idx, n, leaf AS digest FROM o
      UNION ALL SELECT lang, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx)) FROM t WHERE n > 1 GROUP BY lang, level, idx // 2, n),
s AS (SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS level, idx, n, subroot AS digest FROM s
      UNION ALL SELECT level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx)) FROM u WHERE n > 1 GROUP BY level, idx // 2, n),
r AS (SELECT digest AS root FROM u WHERE n = 1),
steps AS (SELECT o.doc_id, o.leaf, t.level, t.digest AS sibling, t.idx % 2 = 0 AS on_left
          FROM o JOIN t ON t.lang IS NOT DISTINCT FROM o.lang AND t.n > 1 AND t.idx = xor(o.idx >> t.level, 1)
          UNION ALL SELECT o.doc_id, o.leaf, 100 + u.level, u.digest, u.idx % 2 = 0
          FROM o JOIN s ON s.lang IS NOT DISTINCT FROM o.lang JOIN u ON u.n > 1 AND u.idx = xor(s.idx >> u.level, 1)),
levels AS (SELECT DISTINCT lang, level FROM t WHERE n > 1),
path AS (SELECT o.doc_id, o.leaf, l.level FROM o JOIN levels l ON l.lang IS NOT DISTINCT FROM o.lang
         UNION ALL SELECT o.doc_id, o.leaf, 100 + level FROM o, (SELECT DISTINCT level FROM u WHERE n > 1)),
whole AS (SELECT p.doc_id, p.leaf, p.level, s.sibling, s.on_left FROM path p
          LEFT JOIN steps s ON s.doc_id IS NOT DISTINCT FROM p.doc_id AND s.leaf = p.leaf AND s.level = p.level),
way AS (SELECT doc_id, leaf, list(struct_pack(sibling := sibling, on_left := on_left) ORDER BY level) AS up, coalesce(string_agg(sibling, '' ORDER BY level), '') AS proof
        FROM whole GROUP BY doc_id, leaf),
v AS (SELECT o.doc_id, o.leaf, s.subroot, r.root, coalesce(w.proof, '') AS proof, list_reduce(list_prepend(struct_pack(sibling := coalesce(o.other, o.leaf), on_left := true), coalesce(w.up, [])),
        lambda a, b: struct_pack(sibling := sha256(CASE WHEN b.sibling IS NULL THEN a.sibling WHEN b.on_left THEN b.sibling || a.sibling ELSE a.sibling || b.sibling END), on_left := true)).sibling AS folded
      FROM o JOIN s ON s.lang IS NOT DISTINCT FROM o.lang CROSS JOIN r LEFT JOIN way w ON w.doc_id IS NOT DISTINCT FROM o.doc_id AND w.leaf = o.leaf)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified FROM v
""".replace("{own}", LEAF).replace("{other}", LEAF.replace("CAST(n_chars AS VARCHAR)", "CAST(n_chars::HUGEINT + 1 AS VARCHAR)")),
    "op13_license_scan": f"""
WITH f AS (SELECT row_number() OVER () AS t, label, phrase, CASE WHEN phrase THEN 2 ELSE 5 END AS k, {LICENSE_WORDS} AS ws FROM (VALUES {TEMPLATES}) AS v(text, label, phrase)),
tg AS (SELECT t, k, p - 1 AS position, list_aggregate(ws[p:p + k - 1], 'string_agg', ' ') AS gram FROM (SELECT *, unnest(range(1, len(ws) - k + 2)) AS p FROM f)),
d AS (SELECT row_number() OVER () AS r, doc_id, {LICENSE_WORDS} AS ws FROM documents),
w AS (SELECT r, p - 1 AS word, ws[p] AS a, ws[p + 1] AS b, ws[p + 2] AS c, ws[p + 3] AS e, ws[p + 4] AS g FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS p FROM d)),
h AS (SELECT r, t, word - position AS start, position FROM w JOIN tg ON k = 2 AND gram = a || ' ' || b
      UNION ALL SELECT r, t, word - position, position FROM w JOIN tg ON k = 5 AND gram = a || ' ' || b || ' ' || c || ' ' || e || ' ' || g),
v AS (SELECT r, t, start, list(DISTINCT position) AS positions FROM h GROUP BY r, t, start),
places AS (SELECT r, label, true AS phrase, start, 1.0::DOUBLE AS share FROM v JOIN f USING (t) WHERE phrase AND len(positions) = len(ws) - 1),
texts AS (SELECT x.r, label, false AS phrase, x.start, len(list_distinct(flatten(list_transform(flatten(list(y.positions)), lambda p: range(p, p + 5))))) / len(any_value(ws)) AS share
          FROM v x JOIN f ON f.t = x.t AND NOT phrase JOIN v y ON y.r = x.r AND y.t = x.t AND abs(y.start - x.start) <= {license_scan.SLACK} GROUP BY x.r, x.t, label, x.start),
s AS (SELECT * FROM places UNION ALL SELECT * FROM texts),
g AS (SELECT r, count_if(phrase) AS n_base, min(start) FILTER (WHERE phrase) AS first_word, max(start) FILTER (WHERE phrase) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE phrase) AS base_labels,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE phrase OR share >= {license_scan.LEAST_SHARE}) AS labels, max(share) AS score FROM s GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM d LEFT JOIN g USING (r)
""",
}
