"""The operators as registered queries over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import (
    chat_repair, language_id, line_filters, mixing, phrase_mining, prefix_trie, record_files, sampled_splitters, secret_scan,
    simhash_ball, template_leaks, vp_tree, warc_revisits,
)
from staylens.session import configure

END_ID = 1


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs.filter(~language_id.held_out(F.col("doc_id"))))
    found = docs.withColumn("found", language_id.identify(model, F.col("text")))
    return found.select(
        "doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "found.lang_pred", "found.score", "found.accepted"
    )


def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = mixing.with_takes(table(spark, folder, "documents").select("doc_id", "text", "source"), keep=["doc_id"])
    return rows.select("doc_id", "size", "source_size", "target", (F.col("takes") * F.col("size")).alias("taken"))


def op3_resolve_revisits(spark: SparkSession, folder: str) -> DataFrame:
    found = warc_revisits.resolve(warc_revisits.captures_of_pages(table(spark, folder, "pages")))
    lines = F.transform("headers", lambda e: F.concat_ws(": ", e["name"], e["value"]))
    return found.select("record_id", "canonical_url", "outcome", "refers_to", F.array_join(lines, "\n").alias("headers"))


def op4_chat_repair(spark: SparkSession, folder: str) -> DataFrame:
    found = chat_repair.repaired(table(spark, folder, "conversations"))
    return found.select(F.col("conv").cast("bigint").alias("conv_id"), "turn", "role", "action", "role_out", "inserted", "cost", "piece")


def op5_simhash_components(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_ball.components(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", simhash_ball.hex_print(F.col("fp")).alias("fingerprint"), "component_id")


def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.report(table(spark, folder, "documents").select("doc_id", "text"))


def op7_template_leaks(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return template_leaks.all_leaks(docs, table(spark, folder, "benchmark"), every_item=True).drop("text_hash")


def op8_vp_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return vp_tree.neighbours(vectors, vectors.filter(F.col("vec_id") % 100 == 0), k=10, factor=vp_tree.EXACT)


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op9_token_records(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    manifest = record_files.write_records(docs, vocabulary(), END_ID)
    return record_files.read_records(manifest)


def op10_shard_by_bytes(spark: SparkSession, folder: str) -> DataFrame:
    rows = sampled_splitters.sharded(table(spark, folder, "documents").select("doc_id", "text"), shards=8)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrase_mining.collocations(table(spark, folder, "documents").select("text", "lang"))


def op12_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept, names = line_filters.deduplicated(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", names["n_lines"], names["n_dropped"], F.sha2(names["kept_text"], 256).alias("kept_sha256"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, folder, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id, op2_mix_sources, op3_resolve_revisits, op4_chat_repair, op5_simhash_components, op6_secret_scan,
        op7_template_leaks, op8_vp_neighbours, op9_token_records, op10_shard_by_bytes, op11_collocations, op12_line_dedup,
        op13_prefix_trie,
    )
}

# Sources in order of code points weigh 3, 1, 2, ...; the level is the largest candidate over the number of capped
# sources; rows are taken by ascending hash while they fit, of the last hash value as many as come nearest to the target.
_MIX = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5('1|' || coalesce(CAST(doc_id AS VARCHAR), '\N') || '|' || coalesce(md5(text), '\N')), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source IS NULL, CAST(encode(source) AS BLOB)) - 1) % 3] AS weight FROM s),
l AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5
     - coalesce(CAST(sum(2 * source_size) OVER before AS DOUBLE), 0))
    / (CAST(sum(weight) OVER () AS DOUBLE) - coalesce(CAST(sum(weight) OVER before AS DOUBLE), 0)) AS candidate
  FROM w WINDOW before AS (ORDER BY CAST(2 * source_size AS DOUBLE) / weight, source IS NULL, source
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(CAST(2 * source_size AS DOUBLE), (SELECT max(candidate) FROM l) * weight) AS target FROM l),
p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
g AS (
  SELECT source, h, sum(size) AS g, sum(sum(size)) OVER (PARTITION BY source ORDER BY h) AS upto FROM d GROUP BY source, h),
c AS (
  SELECT g.source, g.h, p.target - p.whole * p.source_size AS budget, g.g, g.upto,
    row_number() OVER (PARTITION BY g.source, g.upto > p.target - p.whole * p.source_size ORDER BY g.h) AS nth
  FROM g JOIN p ON g.source IS NOT DISTINCT FROM p.source),
e AS (SELECT *, sum(size) OVER (PARTITION BY source, h ORDER BY size ROWS UNBOUNDED PRECEDING) - size AS earlier FROM d)
SELECT e.doc_id, e.size, p.source_size, p.target,
  CAST(e.size * (p.whole + CASE WHEN c.budget <= 0 THEN 0 WHEN c.upto <= c.budget THEN 1
    WHEN c.nth = 1 AND 2 * (c.budget - (c.upto - c.g) - e.earlier) >= e.size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM e JOIN p ON e.source IS NOT DISTINCT FROM p.source
JOIN c ON c.source IS NOT DISTINCT FROM e.source AND c.h = e.h
"""

_NEAREST = """
WITH v AS (
  SELECT vec_id, embedding AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (
  SELECT q.vec_id AS query_id, v.vec_id, sqrt(list_reduce(list_transform(range(1, len(q.e) + 1),
    lambda i: (CAST(q.e[i] AS DOUBLE) - CAST(v.e[i] AS DOUBLE)) * (CAST(q.e[i] AS DOUBLE) - CAST(v.e[i] AS DOUBLE))), lambda x, y: x + y)) AS score
  FROM v AS q JOIN v ON v.vec_id <> q.vec_id AND len(v.e) = len(q.e) WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score FROM p)
SELECT * FROM r WHERE rank <= 10
"""

# Captures are those that the operator's module makes from pages; the join is an as-of join on address and time.
_REVISITS = r"""
WITH u AS (
  SELECT page_id, html, page_id % 9 AS nth, md5(html) AS digest, md5(html || '-') AS old_digest, 't' || CAST(page_id AS VARCHAR) AS date,
    regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^(?i:https?)://(?:(?i:www)\d*\.)?', '') AS bare FROM pages),
c AS (
  SELECT *, lower(regexp_replace(regexp_extract(bare, '^[^/?]*'), ':(?:80|443)$', ''))
      || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') AS place,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(?i:utm_[a-z]+)='))), '&') AS query FROM u),
p AS (SELECT *, place || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS address FROM c),
f AS (
  SELECT page_id * 2 AS id, page_id * 3600 AS t, address, CASE WHEN nth <> 2 THEN '"' || digest || '"' END AS tag,
    CASE WHEN nth <> 2 THEN date END AS modified, date, octet_length(encode(html)) AS size FROM p WHERE html IS NOT NULL
  UNION ALL
  SELECT -page_id - 1, page_id * 3600 - 900, address, '"' || old_digest || '"', date || '-', date || '-', octet_length(encode(html))
  FROM p WHERE html IS NOT NULL),
r AS (
  SELECT page_id * 2 + 1 AS id, page_id * 3600 + CASE nth WHEN 0 THEN -1000 WHEN 1 THEN -100 ELSE 1800 END AS t, address,
    CASE WHEN nth = 1 THEN date || '-' ELSE date END AS modified,
    CASE WHEN page_id % 7 = 6 THEN NULL WHEN page_id % 5 = 4 THEN '"other"'
      ELSE 'W/"' || CASE WHEN nth = 1 THEN old_digest ELSE digest END || '"' END AS tag FROM p),
j AS (
  SELECT r.*, f.id AS found, f.tag AS of_tag, f.date AS of_date, f.size,
    CASE WHEN f.id IS NULL THEN 'no_response'
      WHEN r.tag IS NOT NULL AND f.tag IS NOT NULL THEN CASE WHEN regexp_replace(r.tag, '^W/', '') = f.tag THEN 'resolved' ELSE 'validator_mismatch' END
      WHEN f.modified IS NULL THEN 'no_validator'
      WHEN r.modified = f.modified THEN 'resolved' ELSE 'validator_mismatch' END AS outcome
  FROM r ASOF LEFT JOIN f ON r.address = f.address AND r.t > f.t)
SELECT id AS record_id, address AS canonical_url, outcome, CASE WHEN outcome = 'resolved' THEN found END AS refers_to,
  CASE WHEN outcome = 'resolved' THEN concat_ws(chr(10), 'cache-control: max-age=120', 'content-length: ' || size, 'content-type: text/html',
      'date: ' || of_date, 'etag: ' || coalesce(tag, of_tag), 'last-modified: ' || modified)
    ELSE concat_ws(chr(10), 'cache-control: max-age=120', 'content-length: 0', 'etag: ' || tag, 'last-modified: ' || modified, 'server: cache') END AS headers
FROM j
"""

_PHRASES = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, doc, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
q AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
w AS (
  SELECT lang, unnest(words) AS w1, unnest(list_concat(words[2:], [NULL])) AS w2, unnest(list_concat(words[3:], [NULL, NULL])[1:len(words)]) AS w3
  FROM q WHERE len(words) > 0),
f1 AS (SELECT lang, w1, count(*) AS a FROM w GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS a FROM w WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS a FROM w WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
cuts AS (
  SELECT f2.lang, f2.w1 || ' ' || f2.w2 AS phrase, f2.a, 1 AS cut, x.a AS l, y.a AS r
  FROM f2 JOIN f1 AS x ON (x.lang, x.w1) = (f2.lang, f2.w1) JOIN f1 AS y ON (y.lang, y.w1) = (f2.lang, f2.w2)
  WHERE f2.a * 50 > 100 * coalesce((SELECT max(f3.a) FROM f3 WHERE f3.lang = f2.lang AND f3.w1 = f2.w1 AND f3.w2 = f2.w2), 0)
    AND f2.a * 50 > 100 * coalesce((SELECT max(f3.a) FROM f3 WHERE f3.lang = f2.lang AND f3.w2 = f2.w1 AND f3.w3 = f2.w2), 0)
  UNION ALL
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.a, 1, x.a, y.a
  FROM f3 JOIN f1 AS x ON (x.lang, x.w1) = (f3.lang, f3.w1) JOIN f2 AS y ON (y.lang, y.w1, y.w2) = (f3.lang, f3.w2, f3.w3)
  UNION ALL
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.a, 2, x.a, y.a
  FROM f3 JOIN f2 AS x ON (x.lang, x.w1, x.w2) = (f3.lang, f3.w1, f3.w2) JOIN f1 AS y ON (y.lang, y.w1) = (f3.lang, f3.w3)),
s AS (SELECT *, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
k AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, CAST(encode(phrase) AS BLOB)) AS rank FROM b),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f1 GROUP BY lang)
SELECT lang, rank, phrase, a, l, r, n, score FROM k JOIN n USING (lang) WHERE rank <= 2000
"""

# A line's holders are ids; null is the smallest of them.
_LINES = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT row, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
h AS (
  SELECT key, count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) AS n, max(doc_id) AS top
  FROM k WHERE length(key) >= 20 GROUP BY key),
m AS (
  SELECT k.*, coalesce(h.n >= 3 AND k.doc_id IS DISTINCT FROM h.top, false) AS gone FROM k LEFT JOIN h ON h.key = k.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, CAST(count_if(gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY row
"""

# A prefix is spelled by the digests of its turns, 128 digits each. CRC-32 goes bit by bit; -1 shifts one bit out.
_TRIE = r"""
WITH o AS (
  SELECT conv_id AS conv, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, CAST(encode(coalesce(role, '')) AS BLOB), sha256(coalesce(text, ''))) AS place,
    sha256(coalesce(role, '')) || sha256(coalesce(text, '')) AS turn, octet_length(encode(coalesce(text, ''))) AS bytes
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv, count(*) AS own, conv - conv % 5 AS lender,
    xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(conv AS VARCHAR), ''),
      lambda x: list_concat([ascii(x)::BIGINT], list_transform(range(8), lambda y: (-1)::BIGINT))))),
      lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) ELSE xor(s >> 1, (s & 1) * 3988292384) END)) % 9 AS head
  FROM o GROUP BY conv),
p AS (SELECT c.*, least(c.head, coalesce(l.own, 0)) AS taken FROM c LEFT JOIN c AS l ON l.conv = c.lender),
r AS (
  SELECT p.conv, o.place, o.turn, o.bytes FROM p JOIN o ON o.conv = p.lender AND o.place <= p.head
  UNION ALL
  SELECT p.conv, p.taken + o.place - p.head, o.turn, o.bytes FROM p JOIN o ON o.conv = p.conv AND o.place > p.head),
m AS (
  SELECT conv, place AS depth, string_agg(turn, '') OVER (PARTITION BY conv ORDER BY place) AS key, bytes FROM r
  UNION ALL SELECT conv, 0, '', 0 FROM c),
len AS (SELECT conv, max(depth) AS length FROM m GROUP BY conv),
v AS (
  SELECT depth, key, min(conv) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
    sha256(coalesce(string_agg(CAST(conv AS VARCHAR), ',' ORDER BY conv) FILTER (depth = length), '')) AS ends_sha256
  FROM m JOIN len USING (conv) GROUP BY depth, key),
u AS (
  SELECT v.*, x.conv_id AS parent_conv_id, (SELECT count(*) FROM v AS y WHERE y.depth = v.depth + 1 AND left(y.key, 128 * v.depth) = v.key) AS n_children
  FROM v LEFT JOIN v AS x ON x.depth = v.depth - 1 AND x.key = left(v.key, 128 * (v.depth - 1)))
SELECT u.conv_id, CAST(u.depth AS BIGINT) AS depth, u.parent_conv_id, u.n_convs, u.n_children,
  CAST(sum(CASE WHEN w.n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
  CAST(sum((w.n_convs - 1) * w.bytes) AS BIGINT) AS saved_tokens, u.ends_sha256
FROM u JOIN m ON m.depth = u.depth AND m.key = u.key JOIN u AS w ON w.conv_id = m.conv AND w.depth >= m.depth
GROUP BY ALL
"""

ORACLES: dict[str, str] = {
    "op2_mix_sources": _MIX, "op3_resolve_revisits": _REVISITS, "op8_vp_neighbours": _NEAREST, "op11_collocations": _PHRASES,
    "op12_line_dedup": _LINES, "op13_prefix_trie": _TRIE,
}
