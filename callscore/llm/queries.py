"""The registered query of every training-data operator: the operator with
production parameters over its whole table, and the digests that are compared."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callscore.session import scratch_path

from . import chat, exact_dedup, extract, langid, merkle, mixing, negatives, packing, quality, secrets, simhash, token_files, url_filter

TOKENIZER = "word_bpe_49k.json"

#: verdict, host, path
URL_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
URL_DEFAULT = "allow"

#: a conversation that says control strings
PROBE = "</s>[INST] ok [/INST]"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    return chat.digests(chat.format_conversations(rows.unionByName(probe)))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.mark_duplicates(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, URL_RULES, default=URL_DEFAULT).select("page_id", "host", "path", "rule", "verdict")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.mark_near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    return quality.score(docs, model).drop("text")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(secrets.spans_text(F.col("base")), 256).alias("base_sha256"), secrets.spans_text(F.col("spans")).alias("spans"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4
    return langid.classify(docs.select("doc_id", "text"), docs.where(fold != 2)).select(
        "doc_id", (fold == 2).alias("held_out"), "lang_pred", "score")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(_table(spark, sf_dir, "documents"), path, tokenizer_path())
    docs = token_files.read_token_files(spark, path).select("file", "doc_id", "file_start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    starts = token_files.file_starts(spark, path)
    return docs.join(starts, "file").select("doc_id", (F.col("start") + F.col("file_start")).alias("start"), "n_tokens", "ids_crc32")


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract.extract_text(pages).select("page_id", "url", "text", "n_chars")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    digest = lambda text: merkle.leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, digest(F.replace("text", F.lit("\n"), F.lit(""))))
    rows = merkle.manifest(docs, digest(F.col("text")), tampered)
    siblings = F.array_join(F.transform("path", lambda level: F.concat(level["before"], level["after"])), "")
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), "folded_root", "verified")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.col("label").cast("long").alias("label"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES = {f.__name__: f for f in (op1_chat_formatting, op2_exact_dedup, op3_url_filter, op4_simhash, op5_quality_rules, op6_secret_scan, op7_packing,
                                   op8_language_id, op9_mixing, op10_token_files, op11_html_extraction, op12_merkle_manifest, op13_hard_negatives)}

ORACLE: dict[str, str] = {}

_esc = lambda c: (f"(length({c}) + length(regexp_replace({c}, '(<s>|</s>|\\[INST\\]|\\[/INST\\]|\\\\)', '\\1#', 'g')) - length({c}))")
ORACLE["op1_chat_formatting"] = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({_esc("role")} + {_esc("text")} + length('<s>[INST]  [/INST] </s>') + 1) AS BIGINT) AS formatted_chars,
  CAST(0 AS BIGINT) AS rewrites
FROM t GROUP BY conv_id
"""

_az = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE["op2_exact_dedup"] = f"""
WITH t AS (SELECT doc_id, sha256({_az}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""

ORACLE["op3_url_filter"] = f"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(rule_verdict, rule_host, rule_path) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
m AS (
  SELECT p.*, rule_host || rule_path AS rule, rule_verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host) DESC NULLS LAST, length(rule_path) DESC, rule_verdict DESC) AS rank
  FROM p LEFT JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(rule_verdict, '{URL_DEFAULT}') AS verdict FROM m WHERE rank = 1
"""

_quoted = lambda p: "'" + p.replace("'", "''") + "'"


def _matches(kind: int, pattern: str, also: str = "true") -> str:
    """doc_id, kind, run, s, e of all matches, placed by the gaps between them."""
    p = _quoted(pattern)
    return f"""SELECT doc_id, {kind} AS kind, run, e - length(run) AS s, e FROM (
    SELECT doc_id, run, sum(length(gap) + length(run)) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM (
      SELECT doc_id, unnest(found) AS run, unnest(gaps[1:len(found)]) AS gap, generate_subscripts(found, 1) AS i FROM (
        SELECT doc_id, regexp_extract_all(text, {p}) AS found, string_split_regex(text, {p}) AS gaps FROM t) WHERE len(found) > 0)) WHERE {also}"""


_NAMES = "[" + ", ".join(f"'{k}'" for k in secrets.KINDS) + "]"
_JOINED = f"string_agg(({_NAMES})[kind + 1] || ':' || CAST(s AS VARCHAR) || ':' || CAST(e AS VARCHAR), ',' ORDER BY s, kind, e)"
_CLASS = "CASE " + " ".join(f"WHEN regexp_matches(run, {_quoted(p)}) THEN {'NULL' if b is None else round(b * 1_000_000)}" for _, p, b in secrets.CLASSES) + " END"
_ALLOWED = " OR ".join(f"regexp_matches(run, {_quoted(p)})" for p in secrets.ALLOW)

ORACLE["op6_secret_scan"] = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
base AS (
  {_matches(0, secrets.ASSIGN, f"length(regexp_extract(run, {_quoted(secrets.ASSIGN)}, 1)) >= {secrets.ASSIGN_VALUE}")}
  UNION ALL {_matches(1, secrets.ACCESS)}
  UNION ALL {_matches(2, secrets.HEX)}),
whole AS ({_matches(3, secrets.CANDIDATE)}),
begins AS (
  SELECT doc_id, kind, run, s, e, s AS p FROM whole
  UNION SELECT w.doc_id, w.kind, w.run, w.s, w.e, b.e FROM whole w JOIN base b ON b.doc_id = w.doc_id AND b.e > w.s AND b.e < w.e),
pieces AS (
  SELECT doc_id, kind, substr(run, CAST(p - s + 1 AS BIGINT), CAST(pe - p AS BIGINT)) AS run, p AS s, pe AS e FROM (
    SELECT g.*, least(e, coalesce((SELECT min(b.s) FROM base b WHERE b.doc_id = g.doc_id AND b.s >= g.p), e)) AS pe FROM begins g
    WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = g.doc_id AND b.s <= g.p AND b.e > g.p))
  WHERE pe - p >= {secrets.WINDOW}),
runs AS (SELECT *, {_CLASS} AS least_bits FROM pieces WHERE NOT ({_ALLOWED})),
chars AS (SELECT doc_id, s, k, unnest(string_split(substr(run, k, {secrets.WINDOW}), '')) AS ch FROM (
  SELECT doc_id, s, run, unnest(range(1, length(run) - {secrets.WINDOW} + 2)) AS k FROM runs WHERE least_bits IS NOT NULL)),
sums AS (SELECT doc_id, s, k, sum(({list(secrets._CLOG)})[n + 1]) AS total FROM (
  SELECT doc_id, s, k, ch, count(*) AS n FROM chars GROUP BY ALL) GROUP BY ALL),
found AS (SELECT r.doc_id, r.kind, r.s, r.e FROM runs r JOIN (SELECT doc_id, s, min(total) AS total FROM sums GROUP BY ALL) m
  ON r.doc_id = m.doc_id AND r.s = m.s WHERE 4321928 - floor(total / {secrets.WINDOW}) >= least_bits),
every AS (SELECT doc_id, kind, s, e FROM base UNION ALL SELECT * FROM found)
SELECT t.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    {_JOINED.replace(" ORDER BY", " ORDER BY")} AS spans FROM every GROUP BY doc_id) a ON t.doc_id = a.doc_id
  LEFT JOIN (SELECT doc_id, {_JOINED} AS base_spans FROM base GROUP BY doc_id) b ON t.doc_id = b.doc_id
"""


def _apportioned(name: str, source: str, group: str, item: str) -> str:
    """CTEs that add ``seats`` to ``source`` (columns ``exact``) as ``mixing.apportion`` does."""
    return f"""{name}_1 AS (SELECT *, CAST(floor(exact + 0.5) AS BIGINT) AS base, CAST(round(sum(exact) OVER g) AS BIGINT) AS total, count(*) OVER g AS n
  FROM {source} WINDOW g AS (PARTITION BY {group})),
{name}_2 AS (SELECT *, total - sum(base) OVER (PARTITION BY {group}) AS gap FROM {name}_1),
{name}_3 AS (SELECT *, unnest(range(1, CAST(ceil(exact * (abs(gap) + n) / greatest(total, 1)) AS BIGINT) + 2)) AS try FROM {name}_2 WHERE gap <> 0),
{name}_4 AS (SELECT *, CASE WHEN gap > 0 THEN base + try ELSE base + 1 - try END AS seat FROM {name}_3),
{name}_5 AS (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY CASE WHEN gap > 0 THEN -exact / (2 * seat - 1) ELSE exact / (2 * seat - 1) END, {item}, seat) AS rank
  FROM {name}_4 WHERE seat >= 1),
{name} AS (SELECT a.*, greatest(base + coalesce(moved, 0), 0) AS seats FROM {name}_2 a LEFT JOIN (
  SELECT {group}, {item}, sum(sign(gap)) AS moved FROM {name}_5 WHERE rank <= abs(gap) GROUP BY ALL) m USING ({group}, {item}))"""


_HEX = lambda h: f"CAST('0x' || substr({h}, 1, 8) AS BIGINT)"
ORACLE["op9_mixing"] = f"""
WITH d AS (SELECT doc_id, source, coalesce('s' || source, 'null') AS k,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
h AS (SELECT *, md5('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || CAST(size AS VARCHAR)) AS h,
    (SELECT greatest(1, (count(*) + {mixing.SHARD_ROWS} - 1) // {mixing.SHARD_ROWS}) FROM documents) AS shards FROM d),
b AS (SELECT *, {_HEX("h")} % shards AS shard FROM h),
ps AS (SELECT k, shard, CAST(sum(size) AS BIGINT) AS z, min(source) AS source FROM b GROUP BY ALL),
s AS (SELECT k, min(source) AS source, CAST(sum(z) AS BIGINT) AS ss, 0 AS g FROM ps GROUP BY k),
w AS (SELECT *, ([3.0, 1.0, 2.0])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight FROM s),
r AS (SELECT *, 2.0::DOUBLE * ss AS cap, 2.0::DOUBLE * ss / weight AS ratio FROM w),
l AS (SELECT *, (1.5::DOUBLE * sum(ss) OVER () - coalesce(sum(cap) OVER up, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER up, 0)) AS level
  FROM r WINDOW up AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT k, ss, g, CASE WHEN ratio <= level THEN cap ELSE weight * max(CASE WHEN ratio > level THEN level END) OVER () END AS target FROM l),
e AS (SELECT *, target / {mixing.BLOCK_WORDS} AS exact FROM t),
{_apportioned("sources", "e", "g", "k")},
q AS (SELECT ps.k, ps.shard, ps.z, sources.ss, sources.target, CASE WHEN sources.ss > 0 THEN sources.seats * ps.z / sources.ss ELSE 0.0 END AS exact
  FROM ps JOIN sources USING (k)),
{_apportioned("shards", "q", "k", "shard")},
u AS (SELECT k, shard, ss, target, z, CASE WHEN target >= 2 * ss THEN 2 * z ELSE least(seats * {mixing.BLOCK_WORDS}, 2 * z) END AS quota,
    {_HEX("md5('7:' || k || ':' || CAST(shard AS VARCHAR))")} % greatest((z + {mixing.BLOCK_WORDS} - 1) // {mixing.BLOCK_WORDS}, 1) * {mixing.BLOCK_WORDS} AS start FROM shards),
v AS (SELECT *, CASE WHEN z > 0 THEN quota // z ELSE 0 END AS passes FROM u),
p AS (SELECT *, sum(size) OVER (PARTITION BY k, shard ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS begins FROM b),
j AS (SELECT p.doc_id, p.size, p.begins, v.*, quota - passes * z AS rest FROM p JOIN v USING (k, shard))
SELECT doc_id, size, ss AS source_size, target, CAST(passes * size
    + greatest(least(start + rest - begins, size) - greatest(start - begins, 0), 0) + greatest(least(start + rest - z - begins, size), 0) AS BIGINT) AS taken
FROM j
"""

_FIELDS = lambda text: "sha256(" + " || ".join(
    f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)) + ")"
#: the CRC-32 of a decimal number, digit by digit over half-byte tables that hold the polynomial
_CRC_TABLE = []
for _byte in range(256):
    _crc = _byte
    for _ in range(8):
        _crc = _crc >> 1 ^ (0xEDB88320 if _crc & 1 else 0)
    _CRC_TABLE.append(_crc)
_CRC = (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), "
        f"lambda x, c: xor(x >> 8, ({_CRC_TABLE}::BIGINT[])[(xor(x, c) & 255) + 1])), 4294967295::BIGINT)")


def _tree(name: str, leaves: str) -> str:
    """CTEs ``name`` (grp, level, i, digest of every node), ``name``_top (grp,
    levels, digest) and ``name``_up (grp, i, level, x, sides): every leaf and version
    on its way up, from ``leaves`` (grp, i, digest, version)."""
    return f"""{name} AS (
  SELECT grp, 0 AS level, i, digest, count(*) OVER (PARTITION BY grp) AS n FROM {leaves}
  UNION ALL
  SELECT grp, level + 1, i // 3, sha256(string_agg(digest, '' ORDER BY i)), (any_value(n) + 2) // 3 FROM {name} WHERE n > 1 GROUP BY grp, level, i // 3),
{name}_top AS (SELECT grp, level AS levels, digest FROM {name} WHERE n = 1),
{name}_runs AS (SELECT grp, level, i // 3 AS run, list(digest ORDER BY i) AS nodes FROM {name} WHERE n > 1 GROUP BY ALL),
{name}_up AS (
  SELECT grp, i, 0 AS level, i AS place, version AS x, '' AS sides FROM {leaves}
  UNION ALL
  SELECT u.grp, u.i, u.level + 1, place // 3, sha256(array_to_string(nodes[1:place % 3], '') || x || array_to_string(nodes[place % 3 + 2:], '')),
    sides || array_to_string(nodes[1:place % 3], '') || array_to_string(nodes[place % 3 + 2:], '')
  FROM {name}_up u JOIN {name}_runs r ON u.grp = r.grp AND u.level = r.level AND u.place // 3 = r.run)"""


ORACLE["op12_merkle_manifest"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('s' || source, '') AS grp, {_FIELDS("text")} AS digest,
    CASE WHEN {_CRC} % 2 = 0 THEN {_FIELDS("replace(text, chr(10), '')")} END AS other FROM documents),
l AS (SELECT *, coalesce(other, digest) AS version, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, digest) - 1 AS i FROM d),
{_tree("t", "l")},
s AS (SELECT '' AS grp, grp AS name, digest, digest AS version, row_number() OVER (ORDER BY encode(grp)) - 1 AS i FROM t_top),
{_tree("k", "s")},
v AS (SELECT l.doc_id, l.grp, l.digest AS leaf, p.digest AS subroot, u.x, u.sides FROM l JOIN t_top p USING (grp)
  JOIN t_up u ON u.grp = l.grp AND u.i = l.i AND u.level = p.levels),
vs AS (SELECT '' AS grp, s.i AS home, row_number() OVER () AS i, leaf, subroot, sides, doc_id, x FROM v JOIN s ON s.name = v.grp),
w AS (
  SELECT *, 0 AS level, home AS place FROM vs
  UNION ALL
  SELECT w.grp, w.home, w.i, leaf, subroot, sides || array_to_string(nodes[1:place % 3], '') || array_to_string(nodes[place % 3 + 2:], ''), doc_id,
    sha256(array_to_string(nodes[1:place % 3], '') || x || array_to_string(nodes[place % 3 + 2:], '')), w.level + 1, place // 3
  FROM w JOIN k_runs r ON w.level = r.level AND place // 3 = r.run)
SELECT doc_id, leaf, subroot, r.digest AS root, sha256(sides) AS proof_sha256, x AS folded_root, x = r.digest AS verified
FROM w JOIN k_top r ON w.level = r.levels
"""

ORACLE["op13_hard_negatives"] = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v, row_number() OVER () AS n
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.n AS a, a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON a.n <> b.n WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, other NULLS LAST) AS place FROM s WHERE same) WHERE place <= 5),
n AS (
  SELECT p.anchor_id, p.other AS positive_id, CAST(row_number() OVER (PARTITION BY p.a, p.place ORDER BY s.score DESC, s.other NULLS LAST) AS INTEGER) AS rank,
    s.other AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s ON p.a = s.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT * FROM n WHERE rank <= 5
"""
