"""The operators bound to the tables in a folder, with their oracle SQL where one exists."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm.common import table
from tradewind.llm.context_tree import score_texts
from tradewind.llm.conversations import damaged, repair
from tradewind.llm.exact_dedup import exact_duplicates
from tradewind.llm.fingerprints import as_text, fingerprints
from tradewind.llm.manifest import verify
from tradewind.llm.mixing import mix_sources
from tradewind.llm.near_dedup import near_duplicates
from tradewind.llm.packing import pack
from tradewind.llm.quality import score_quality
from tradewind.llm.secrets import BASE_KINDS, find_secrets
from tradewind.llm.sharding import assign_shards, topology
from tradewind.llm.token_files import read_token_files, write_token_files
from tradewind.llm.url_filter import judge_urls
from tradewind.session import run_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_pack(spark: SparkSession, sf: str) -> DataFrame:
    pieces = pack(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset",
    )


@_query
def op2_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"))


ORACLE["op2_near_dedup"] = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
mutual AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m
         FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS (SELECT a, b FROM mutual JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
         WHERE 100 * m >= 75 * (x.n + y.n - m)),
reach AS (SELECT doc_id, doc_id AS node FROM documents
          UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.node),
low AS (SELECT doc_id, min(node) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM low LEFT JOIN n USING (doc_id)
"""


@_query
def op4_context_tree(spark: SparkSession, sf: str) -> DataFrame:
    return score_texts(table(spark, sf, "documents"))


@_query
def op5_syncmers(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints(table(spark, sf, "documents")).select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"),
        as_text("sketch").alias("fingerprint"), as_text("edited_sketch").alias("edited_fingerprint"),
        "near_edited", "near_next",
    )


@_query
def op6_quality(spark: SparkSession, sf: str) -> DataFrame:
    return score_quality(table(spark, sf, "documents"), table(spark, sf, "labels"))


@_query
def op3_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_duplicates(table(spark, sf, "documents"))


ORACLE["op3_exact_dedup"] = f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g USING (t)
"""


@_query
def op7_secrets(spark: SparkSession, sf: str) -> DataFrame:
    def joined(spans):
        named = F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end))
        return F.array_join(named, ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s.kind.isin(*BASE_KINDS))
    return find_secrets(table(spark, sf, "documents")).select(
        "doc_id", *(count(k) for k in BASE_KINDS),
        F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans"),
    )


#: (action, host, path)
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


@_query
def op8_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = F.array(*(
        F.struct(F.lit(a).alias("action"), F.lit(h).alias("host"), F.lit(p).alias("path"))
        for a, h, p in URL_RULES
    ))
    rules = spark.range(1).select(F.inline(rows))
    return judge_urls(table(spark, sf, "pages"), rules)


#: For pages that name no other urls, as those of the tables: aliases are then the urls that
#: differ in scheme, fragment, default port or the host's case only.
ORACLE["op8_url_filter"] = f"""
WITH rests AS (
  SELECT page_id, row_number() OVER () AS uid,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, uid, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS after FROM rests),
rules(action, rule_host, rule_path) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
fits AS (
  SELECT uid, action, rule_host || rule_path AS rule,
         row_number() OVER (PARTITION BY uid ORDER BY length(rule_host || rule_path) DESC, action) AS place
  FROM split JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
judged AS (
  SELECT s.*, rule, action, regexp_replace(host, ':(80|443)$', '') || after AS node
  FROM split s LEFT JOIN fits f ON f.uid = s.uid AND place = 1),
blocked AS (
  SELECT node FROM judged WHERE node <> '' GROUP BY node
  HAVING coalesce(bool_or(action = 'block'), false) AND NOT coalesce(bool_or(action = 'allow'), false))
SELECT page_id, host, path, rule,
       coalesce(action, CASE WHEN node IN (SELECT node FROM blocked) THEN 'block' END, 'allow') AS verdict FROM judged
"""


@_query
def op9_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mix_sources(table(spark, sf, "documents"))


@_query
def op10_token_files(spark: SparkSession, sf: str) -> DataFrame:
    path = run_dir(spark, "token-files")
    write_token_files(
        table(spark, sf, "documents"), path, public_tokenizers.path("word_bpe_49k.json")
    )
    return read_token_files(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


@_query
def op11_conversations(spark: SparkSession, sf: str) -> DataFrame:
    return repair(damaged(table(spark, sf, "conversations")))


@_query
def op12_shards(spark: SparkSession, sf: str) -> DataFrame:
    return assign_shards(table(spark, sf, "documents"), topology(16), topology(17))


#: CRC-32 of a list of bytes, bit by bit.
SQL_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {0}),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                           lambda x, _: xor(x >> 1, 3988292384::BIGINT * (x & 1)))))"""
TEXT_BYTES = "list_transform(regexp_extract_all(hex(coalesce(text, '')), '..'), lambda h: ('0x' || h)::BIGINT)"


ORACLE["op12_shards"] = f"""
WITH ids AS (SELECT DISTINCT doc_id FROM documents),
draws AS (
  SELECT doc_id, s::INT AS shard, -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '-') || ':' || (s // 8) || '/'
         || (s % 8 // 4) || '/' || s), 1, 12))::BIGINT + 0.5) / 281474976710656) AS draw
  FROM ids, range(17) t(s)),
placed AS (
  SELECT doc_id, arg_min(shard, draw) FILTER (shard < 16) AS shard, arg_min(shard, draw) AS grown_shard
  FROM draws GROUP BY doc_id),
rows AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, {SQL_CRC32.format(TEXT_BYTES)} AS text_crc32 FROM documents)
SELECT r.doc_id, r.size, r.text_crc32, 'key' AS law, p.shard,
       row_number() OVER (PARTITION BY p.shard ORDER BY r.doc_id NULLS FIRST, r.text_crc32, r.size) - 1 AS slot, p.grown_shard
FROM rows r JOIN placed p ON p.doc_id IS NOT DISTINCT FROM r.doc_id
"""


@_query
def op13_merkle(spark: SparkSession, sf: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return verify(table(spark, sf, "documents"), tampered)


ID_BYTES = "list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)"
ORACLE["op13_merkle"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, source, n_chars, text, {SQL_CRC32.format(ID_BYTES)} % 7 = 0 AS hit FROM documents),
f AS (
  SELECT doc_id, lang, coalesce(hit, false) AS hit,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS n,
         coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') AS n1,
         coalesce(strlen(text) || ':' || text, '-') AS body FROM d),
leaf AS (
  SELECT doc_id, lang, sha256(head || n || body) AS leaf,
         sha256(head || CASE WHEN hit THEN n1 ELSE n END || body) AS climbing FROM f),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaf),
tree(lang, level, nodes) AS (
  SELECT lang, 0, list(leaf ORDER BY place) FROM ranked GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, list_transform(range(0, len(nodes), 2), lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], '')))
  FROM tree WHERE len(nodes) > 1),
subs AS (
  SELECT lang, level AS height, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS rank
  FROM tree WHERE len(nodes) = 1),
top(level, nodes) AS (
  SELECT 0, list(subroot ORDER BY rank) FROM subs
  UNION ALL
  SELECT level + 1, list_transform(range(0, len(nodes), 2), lambda i: sha256(nodes[i + 1] || coalesce(nodes[i + 2], '')))
  FROM top WHERE len(nodes) > 1),
climb(lang, leaf_place, first, level, place, folded, proof, upper) AS (
  SELECT lang, place, place, 0, place, climbing, '', false FROM ranked
  UNION ALL
  SELECT c.lang, c.leaf_place, c.first, CASE WHEN go THEN c.level + 1 ELSE 0 END, CASE WHEN go THEN c.place // 2 ELSE s.rank END,
         CASE WHEN NOT go THEN c.folded WHEN c.place % 2 = 0 THEN sha256(c.folded || coalesce(sib, '')) ELSE sha256(sib || c.folded) END,
         CASE WHEN go THEN c.proof || coalesce(sib, '') ELSE c.proof END, c.upper OR NOT go
  FROM (SELECT c.*, CASE WHEN c.upper THEN u.nodes ELSE t.nodes END AS nodes,
               len(CASE WHEN c.upper THEN u.nodes ELSE t.nodes END) > 1 AS go,
               (CASE WHEN c.upper THEN u.nodes ELSE t.nodes END)[xor(c.place, 1) + 1] AS sib
        FROM climb c LEFT JOIN tree t ON NOT c.upper AND t.lang IS NOT DISTINCT FROM c.lang AND t.level = c.level
        LEFT JOIN top u ON c.upper AND u.level = c.level) c
  JOIN subs s ON s.lang IS NOT DISTINCT FROM c.lang WHERE go OR NOT c.upper),
ends AS (
  SELECT lang, leaf_place, folded, proof FROM climb c JOIN (SELECT max(level) AS m FROM top) ON c.upper AND c.level = m)
SELECT r.doc_id, r.leaf, s.subroot, (SELECT nodes[1] FROM top WHERE len(nodes) = 1) AS root,
       sha256(e.proof) AS proof_sha256, e.folded AS folded_root,
       e.folded = (SELECT nodes[1] FROM top WHERE len(nodes) = 1) AS verified
FROM ranked r JOIN ends e ON e.lang IS NOT DISTINCT FROM r.lang AND e.leaf_place = r.place
JOIN subs s ON s.lang IS NOT DISTINCT FROM r.lang
"""
