"""Named queries of the corpus operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm import (
    block_max_search, language_spans, link_trust, ngram_trie, odd_minhash, order_minhash, sentencepiece_bpe, source_mix,
    spelling_tiles, substring_dedup, swap_packing, turn_repair, warc_fixity,
)
from flowlens.session import staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(query):
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query
    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def sha256_hex(column) -> F.Column:
    return F.sha2(F.encode(column, "UTF-8"), 256)


def in_fold(mod: int, rest: int) -> F.Column:
    """crc32 of the id as text has remainder ``rest``; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % mod == rest, F.lit(False))


@register("op1_order_minhash")
def op1(spark, sf_dir):
    signed = order_minhash.fingerprints(documents(spark, sf_dir))
    return signed.select(
        "doc_id", "n_chars", sha256_hex(F.col("edited")).alias("edited_sha256"),
        order_minhash.as_text("signature").alias("fingerprint"),
        order_minhash.as_text("edited_signature").alias("edited_fingerprint"),
        order_minhash.likeness("signature", "edited_signature").alias("near_edited"),
        order_minhash.likeness("signature", "next_signature").alias("near_next"))


@register("op2_block_max_search", r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')) AS term FROM documents),
lengths AS (SELECT doc_id, count(*) AS len FROM words GROUP BY doc_id),
totals AS (SELECT (SELECT count(*) FROM documents) AS n, (SELECT count(*) FROM words) AS all_words),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
impacts AS (
  SELECT doc_id, term, CAST(floor(1000000 * ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * (tf * (1.2::DOUBLE + 1)
    / (tf + 1.2::DOUBLE * (1 - 0.75::DOUBLE + 0.75::DOUBLE * len / (all_words / n::DOUBLE))))) AS BIGINT) AS impact
  FROM tf JOIN df USING (term) JOIN lengths USING (doc_id), totals),
scores AS (
  SELECT q.doc_id AS query_id, d.doc_id, CAST(sum(impact) AS BIGINT) AS score
  FROM tf q JOIN impacts d USING (term) WHERE q.doc_id % 100 = 0 GROUP BY 1, 2),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10""")
def op2(spark, sf_dir):
    docs = documents(spark, sf_dir)
    index = block_max_search.build(docs)
    queries = block_max_search.query_terms(docs.where(block_max_search.every(F.col("doc_id"))))
    return block_max_search.search(index, queries).select(
        F.col("query").alias("query_id"), "rank", F.col("key").alias("doc_id"), "score")


@register("op3_sentencepiece")
def op3(spark, sf_dir):
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return sentencepiece_bpe.round_trip(docs, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        sha256_hex(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        sha256_hex(F.col("decoded")).alias("decoded_sha256"))


@register("op4_source_mix")
def op4(spark, sf_dir):
    sizes, plan, blocks = source_mix.mix(documents(spark, sf_dir))
    taken = blocks.groupBy("row").agg(
        F.sum("words").alias("words"), F.count("*").alias("n_blocks"), F.min("shard").alias("first_shard"),
        F.max("shard").alias("last_shard"))
    named = plan.select(F.col("source").alias("of"), "source_size", "target")
    return (sizes.join(named, F.col("source").eqNullSafe(F.col("of"))).join(taken, "row", "left")
            .select("doc_id", "size", "source_size", "target",
                    F.coalesce("words", F.lit(0).cast("long")).alias("taken"),
                    F.coalesce("n_blocks", F.lit(0).cast("long")).alias("n_blocks"), "first_shard", "last_shard"))


@register("op6_ngram_trie")
def op6(spark, sf_dir):
    return ngram_trie.score(documents(spark, sf_dir), in_fold(7, 2))


@register("op8_language_spans")
def op8(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang").withColumn("held_out", in_fold(4, 2))
    fitted = language_spans.fit(docs.where(~F.col("held_out")), F.col("doc_id"))
    return language_spans.label(docs.drop("lang"), fitted).select(
        "doc_id", "held_out", F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


@register("op9_substring_dedup", r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS w
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM words WHERE len(ws) >= 50)),
firsts AS (SELECT w, min(doc_id) AS first_doc FROM windows GROUP BY w),
gone AS (
  SELECT DISTINCT doc_id, i + j AS pos
  FROM windows JOIN firsts USING (w), range(0, 50) AS r(j) WHERE first_doc < doc_id),
tokens AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM words),
marked AS (SELECT t.doc_id, t.word, t.pos, g.pos IS NOT NULL AS removed FROM tokens t LEFT JOIN gone g USING (doc_id, pos)),
summed AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (removed) AS n_removed,
    string_agg(word, ' ' ORDER BY pos) FILTER (NOT removed) AS kept FROM marked GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN summed USING (doc_id)""")
def op9(spark, sf_dir):
    return substring_dedup.without_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", sha256_hex(F.col("kept")).alias("kept_sha256"))


@register("op10_odd_minhash", r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(ws) >= 2 THEN list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])
      ELSE ws END) AS s FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * n_both >= 80 * (a.n + b.n - n_both)),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.y FROM reach r JOIN edges e ON e.x = r.other),
comps AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT c.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, c.doc_id = component_id AS kept
FROM comps c LEFT JOIN sizes USING (doc_id)""")
def op10(spark, sf_dir):
    found = odd_minhash.near_duplicates(documents(spark, sf_dir), k=2)
    return found.select("doc_id", "n_shingles", F.col("component").alias("component_id"),
                        F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"))


@register("op7_link_trust", r"""
WITH RECURSIVE parsed AS (
  SELECT page_id, html, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
rules(rhost, rpath, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
ruled AS (
  SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS ruling
  FROM parsed JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id),
counted AS (SELECT ruling, host, count(*) AS n FROM ruled JOIN parsed USING (page_id) GROUP BY 1, 2),
seeds AS (SELECT CASE ruling WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host,
  n / sum(n) OVER (PARTITION BY ruling) AS seed FROM counted),
links AS (SELECT DISTINCT page_id, host, unnest(regexp_extract_all(
  coalesce(html, ''), '(?i)\shref\s*=\s*["'']?\s*(?:https?:)?//([^/?#"''\s>]+)', 1)) AS dst FROM parsed),
edges AS (SELECT host, lower(dst) AS dst, count(DISTINCT page_id) AS n FROM links
  WHERE host <> '' AND lower(dst) <> host GROUP BY 1, 2),
steps AS (
  SELECT 'trust' AS kind, host, dst, n / sum(n) OVER (PARTITION BY host) AS share FROM edges UNION ALL
  SELECT 'distrust', dst, host, n / sum(n) OVER (PARTITION BY dst) FROM edges),
arrived(kind, host, score) AS (
  SELECT kind, host, CAST(seed * 0.2 AS DOUBLE) FROM seeds UNION ALL
  SELECT a.kind, s.dst, sum(a.score * s.share) * 0.8::DOUBLE FROM arrived a JOIN steps s ON s.kind = a.kind AND s.host = a.host
  GROUP BY 1, 2 HAVING sum(a.score * s.share) > 1e-14),
scores AS (SELECT host, coalesce(sum(score) FILTER (kind = 'trust'), 0) AS trust,
  coalesce(sum(score) FILTER (kind = 'distrust'), 0) AS distrust FROM arrived GROUP BY host)
SELECT page_id, p.host, p.path, rule, coalesce(ruling, CASE WHEN coalesce(distrust, 0) > coalesce(trust, 0)
  AND coalesce(distrust, 0) > 1e-9 THEN 'block' ELSE 'allow' END) AS verdict
FROM parsed p LEFT JOIN ruled USING (page_id) LEFT JOIN scores s ON s.host = p.host""")
def op7(spark, sf_dir):
    return link_trust.judge(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "host", "path", "rule", "verdict")


@register("op5_warc_fixity", r"""
WITH records AS (
  SELECT page_id, page_id // 500 AS file, strlen(
    'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
    || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10) || 'Content-Length: '
    || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)) + strlen(coalesce(html, '')) + 4 AS size
  FROM pages),
placed AS (
  SELECT *, sum(size) OVER w AS finish, row_number() OVER (PARTITION BY file ORDER BY page_id DESC) AS from_end
  FROM records WINDOW w AS (PARTITION BY file ORDER BY page_id))
SELECT file, page_id AS seq, CAST(finish - size AS BIGINT) AS begin_byte, CAST(finish AS BIGINT) AS end_byte,
  CASE WHEN file % 7 = 3 AND from_end = 1 THEN 'missing' ELSE 'changed' END AS damage
FROM placed
WHERE file % 7 = 3 AND from_end = 1 OR page_id % 211 = 7 OR page_id % 503 = 11
UNION ALL
SELECT file, page_id + 1, CAST(finish AS BIGINT), CAST(finish + 6 AS BIGINT), 'extra'
FROM placed WHERE file % 11 = 2 AND from_end = 1""")
def op5(spark, sf_dir):
    """A drill: the second replica is the first with planted damage, of which the audit knows nothing. One byte of a record
    is changed, a record is blank, the last record of a file is cut off, or a file has bytes at its end."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    good = pages.select(
        F.expr("page_id div 500").alias("file"), F.col("page_id").alias("seq"),
        warc_fixity.response_record(F.col("url"), F.col("html"), F.col("page_id")).alias("record"))
    # Which record is the last of its file is found on the keys alone.
    last = good.groupBy("file").agg(F.max("seq").alias("seq"))
    cut = last.where("file % 7 = 3").select("file", "seq")
    more = last.where("file % 11 = 2").select("file", F.col("seq") + 1, F.lit(b"\0" * 6).alias("record"))
    size = F.length("record")
    record = (F.when(F.col("seq") % 503 == 11, F.encode(F.repeat(F.lit(" "), size), "UTF-8"))
              .when(F.col("seq") % 211 == 7, F.concat(F.substring("record", 1, 40), F.lit(b"~"),
                                                      F.substring(F.col("record"), F.lit(42), size)))
              .otherwise(F.col("record")))
    bad = good.withColumn("record", record).join(cut, ["file", "seq"], "left_anti").unionByName(
        more.toDF("file", "seq", "record"))
    return warc_fixity.audit(good, bad)


#: The table of crc32 (reflected polynomial 0xEDB88320), which DuckDB lacks.
CRC_TABLE_SQL = """crc_table AS MATERIALIZED (SELECT list_transform(range(256), lambda i:
  list_reduce(range(8), lambda c, j: xor(c >> 1, (c & 1) * 3988292384), i)) AS t)"""


def _crc32_sql(points: str) -> str:
    """crc32 of the UTF-8 bytes of a list of code points that are ASCII or from U+00C0 to U+00FF."""
    return f"""xor(4294967295, list_reduce(flatten(list_transform({points}, lambda p: CASE WHEN p < 128 THEN [p] ELSE [195, p - 64] END)),
    lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INTEGER) + 1]), 4294967295))"""


@register("op11_turn_repair", rf"""
WITH RECURSIVE {CRC_TABLE_SQL},
hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32_sql("list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),"
                " lambda ch: CAST(unicode(ch) AS BIGINT))")} % 20 AS h
  FROM conversations, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed, range(CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM damaged),
faulty AS (
  SELECT conv_id, turn, role, text, pos, left(role, 1) AS ini,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM placed),
inserts(s, q, price, pre) AS (VALUES (0, 0, 0, ''), (0, 2, 2, 'I'), (0, 3, 4, 'II'), (1, 1, 0, ''), (1, 2, 2, 'I'), (1, 3, 4, 'II'),
  (2, 2, 0, ''), (2, 3, 2, 'I'), (3, 3, 0, ''), (3, 2, 2, 'I')),
edits(letter, ini, q, t, price) AS (VALUES ('D', NULL, 0, 0, 3), ('D', NULL, 1, 1, 3), ('D', NULL, 2, 2, 3), ('D', NULL, 3, 3, 3),
  ('K', 's', 0, 1, 0), ('K', 'u', 0, 2, 0), ('K', 'u', 1, 2, 0), ('K', 'u', 3, 2, 0), ('K', 'a', 2, 3, 0),
  ('R', NULL, 0, 2, 2), ('R', NULL, 1, 2, 2), ('R', NULL, 2, 3, 2), ('R', NULL, 3, 2, 2)),
paths(conv_id, pos, s, best) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 0, {{'cost': CAST(0 AS BIGINT), 'audit': ''}} FROM faulty
  UNION ALL
  SELECT p.conv_id, p.pos + 1, e.t, min({{'cost': CAST(p.best.cost + i.price + e.price
      + CASE WHEN e.letter <> 'D' AND f.fault = 'truncated' THEN 1 ELSE 0 END AS BIGINT), 'audit': p.best.audit || i.pre || e.letter}})
  FROM paths p JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.pos = p.pos + 1
    JOIN inserts i ON i.s = p.s JOIN edits e ON e.q = i.q AND (e.ini IS NULL OR e.ini = f.ini)
  WHERE e.letter = 'D' OR f.fault IS NULL OR f.fault = 'truncated'
  GROUP BY p.conv_id, p.pos + 1, e.t),
lengths AS (SELECT conv_id, max(pos) AS n FROM faulty GROUP BY conv_id),
solved AS (
  SELECT p.conv_id, min({{'cost': p.best.cost + z.price, 'audit': p.best.audit || z.post}}) AS best
  FROM paths p JOIN lengths l ON l.conv_id IS NOT DISTINCT FROM p.conv_id AND l.n = p.pos
    JOIN (VALUES (0, 0, ''), (1, 4, 'II'), (2, 2, 'I'), (3, 0, '')) AS z(s, price, post) ON z.s = p.s
  GROUP BY p.conv_id),
letters AS (
  SELECT conv_id, i, best.audit[i] AS letter FROM (SELECT conv_id, best, unnest(range(1, length(best.audit) + 1)) AS i FROM solved)),
numbered AS (
  SELECT conv_id, i, letter, sum(CASE WHEN letter <> 'I' THEN 1 ELSE 0 END) OVER w AS pos,
    sum(CASE WHEN letter <> 'D' THEN 1 ELSE 0 END) OVER w AS out
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
joined AS (
  SELECT m.*, CASE WHEN letter = 'I' THEN '' ELSE f.text END AS text, f.role AS own, f.ini
  FROM numbered m LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM m.conv_id AND f.pos = m.pos WHERE letter <> 'D'),
systems AS (SELECT conv_id, count(*) AS n_system FROM joined WHERE out = 1 AND letter = 'K' AND ini = 's' GROUP BY conv_id),
texts AS (
  SELECT j.conv_id, string_agg(CASE WHEN letter = 'K' THEN own WHEN (out - coalesce(n_system, 0)) % 2 = 1 THEN 'user'
    ELSE 'assistant' END || ':' || text, chr(10) ORDER BY i) AS repaired
  FROM joined j LEFT JOIN systems y ON y.conv_id IS NOT DISTINCT FROM j.conv_id GROUP BY j.conv_id),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY conv_id)
SELECT d.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(s.best.cost, 0) AS BIGINT) AS cost,
  coalesce(s.best.audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d
  LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM d.conv_id
  LEFT JOIN solved s ON s.conv_id IS NOT DISTINCT FROM d.conv_id
  LEFT JOIN texts x ON x.conv_id IS NOT DISTINCT FROM d.conv_id""")
def op11(spark, sf_dir):
    """A drill: turns are lost, emptied, cut, repeated or given to the user by a hash of their keys, then repaired."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    spoken = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    h = F.crc32(F.encode(F.concat_ws(":", *spoken[:2]), "UTF-8")) % 20
    damaged = turns.select(
        "conv_id", "turn", F.when(h == 4, "user").otherwise(spoken[2]).alias("role"),
        F.when(h == 1, "").when(h == 2, F.regexp_replace(spoken[3], "[.!?]", "")).otherwise(spoken[3]).alias("text"),
        h.alias("h")).where("h <> 0")
    edited = staged(turn_repair.repair(turn_repair.records(damaged, copies=F.when(F.col("h") == 3, 2).otherwise(1))), "edited")
    found = {"measures": turn_repair.measures(edited), "digests": turn_repair.digests(edited)}
    out = turns.select("conv_id").distinct()
    for name, part in found.items():
        out = out.join(part.withColumnRenamed("key", name), F.col("conv_id").eqNullSafe(F.col(name)), "left")
    zero = F.lit(0).cast("long")
    return out.select(
        "conv_id", *[F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("digest", sha256_hex(F.lit(""))).alias("repaired_sha256"))


@register("op12_spelling_tiles", rf"""
WITH RECURSIVE {CRC_TABLE_SQL},
runs AS (
  SELECT doc_id, run, count(*) AS times FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents) GROUP BY ALL),
hashed AS (
  SELECT run, times, {_crc32_sql("list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),"
                                 " lambda ch: CAST(unicode(ch) AS BIGINT))")} AS h FROM runs, crc_table),
results AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM hashed),
words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM results WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
cut AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (
    SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
near AS (
  SELECT word, count(*) AS n_near, min({{'less': -other_n, 'form': other}}) AS best FROM pairs GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.less >= 2 * w.n THEN best.form END AS form,
    CASE WHEN -best.less >= 2 * w.n THEN -best.less END AS form_n FROM words w LEFT JOIN near USING (word)),
chains(word, place) AS (
  SELECT word, word FROM forms UNION SELECT c.word, f.form FROM chains c JOIN forms f ON f.word = c.place WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.place AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM forms f JOIN chains c USING (word) JOIN forms e ON e.word = c.place AND e.form IS NULL""")
def op12(spark, sf_dir):
    return spelling_tiles.variants(spelling_tiles.vocabulary(documents(spark, sf_dir), damage=97))


@register("op13_swap_packing")
def op13(spark, sf_dir):
    return swap_packing.packed_pieces(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
