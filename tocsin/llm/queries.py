"""The contract queries of the operators, next to their SQL where it can be written.

Each query applies its operator to the whole table and derives the digest columns.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tocsin.llm import fair_mix, license_scan, line_crf, line_dedup, ngram_join, packing, phrase_index, phrase_mining, pu_toxicity, subword_quality, substring_dedup, turn_repair, url_filter
from tocsin.llm.common import ID, NO_ID

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_id() -> Column:
    return F.when(F.col(ID) != NO_ID, F.col(ID)).alias("doc_id")


LINES_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents),
keyed AS (
  SELECT doc_id, i, line,
         translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
frequent AS (
  SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10),
marked AS (
  SELECT doc_id, i, line, keyed.k IN (SELECT k FROM frequent) AS gone FROM keyed)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query("op10_line_dedup", LINES_SQL)
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_frequent_lines(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return out.select(doc_id(), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op2_substring_dedup")
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), width=20)
    return out.select(doc_id(), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op9_ngram_jaccard_join")
def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ngram_join.link_groups(table(spark, sf_dir, "documents"), width=5, threshold=0.75)
    return out.select(doc_id(), F.col("n").alias("n_shingles"), "component_id")


LEAKS_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, w[i:i + least(10, len(w)) - 1] AS w
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
place AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
hit AS (
  SELECT p.doc_id, p.i, win.n, win.item_id
  FROM (SELECT doc_id, i, n, w[i:i + n - 1] AS w FROM place, (SELECT DISTINCT n FROM win) WHERE i + n - 1 <= len(w)) p
  JOIN win ON p.w = win.w),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op4_decontamination", LEAKS_SQL)
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = phrase_index.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10)
    return out.select(
        doc_id(), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op1_license_scan", license_scan.scan_sql())
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan.scan(table(spark, sf_dir, "documents"))
    return out.select(
        doc_id(), "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )


@query("op5_pu_toxicity")
def op5_pu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = pu_toxicity.train(docs, labels, pu_toxicity.fold("doc_id", 3) != 1)
    out = pu_toxicity.score(docs, model).withColumn("doc_id", doc_id())
    held = pu_toxicity.fold("doc_id", 3) == 1
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op6_subword_quality")
def op6_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = subword_quality.train(docs, labels, pu_toxicity.fold("doc_id", 5) != 0)
    out = subword_quality.score(docs, model).withColumn("doc_id", doc_id())
    held = pu_toxicity.fold("doc_id", 5) == 0
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@query("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents"), VOCABULARY, window=2048))


@query("op7_line_crf")
def op7_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = line_crf.judge(docs, line_crf.train(docs, table(spark, sf_dir, "labels")))
    return out.select(
        doc_id(), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content"
    )


@query("op8_url_filter")
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "score")


MIX_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('0:' || coalesce(doc_id::VARCHAR, '')) AS shuffled
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM d GROUP BY source),
w AS (SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM src),
level(k, x) AS (
  SELECT 0, (SELECT (1.5::DOUBLE * sum(source_size)::DOUBLE) / sum(weight)::DOUBLE FROM w)
  UNION ALL
  SELECT k + 1, (1.5::DOUBLE * sum(source_size)::DOUBLE - coalesce(sum(2 * source_size) FILTER (WHERE weight * x > 2 * source_size), 0)::DOUBLE)
                / nullif(sum(weight) FILTER (WHERE weight * x <= 2 * source_size), 0)::DOUBLE
  FROM level, w WHERE k < (SELECT count(*) FROM w) GROUP BY k, x),
t AS (
  SELECT source, source_size, place, coalesce(least(2 * source_size, weight * x), 2 * source_size)::DOUBLE AS target
  FROM w, (SELECT x FROM level ORDER BY k DESC LIMIT 1)),
q AS (
  SELECT d.*, source_size, place, target,
         sum(size) OVER (PARTITION BY d.source ORDER BY shuffled, size ROWS UNBOUNDED PRECEDING)::BIGINT AS cum,
         row_number() OVER () AS id
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
turn AS (
  SELECT id, size, place, cum + c * source_size AS reached, (cum + c * source_size)::DOUBLE / target AS finish
  FROM q, (VALUES (0), (1)) AS copies(c) WHERE size > 0),
cut AS (SELECT id, size, sum(size) OVER (ORDER BY finish, place, reached ROWS UNBOUNDED PRECEDING) AS total FROM turn),
got AS (SELECT id, sum(size)::BIGINT AS taken FROM cut WHERE total <= 1.5::DOUBLE * (SELECT sum(size) FROM d)::DOUBLE GROUP BY id)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM q LEFT JOIN got USING (id)
"""


@query("op13_fair_mix", MIX_SQL)
def op13_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = fair_mix.plan(table(spark, sf_dir, "documents"), share=1.5, most=2, weights=(5, 2, 1))
    return fair_mix.accounts(mix).select("doc_id", "size", "source_size", "target", "taken")


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations as the contract damages them; nulls are one space."""
    convs = table(spark, sf_dir, "conversations")
    spaced = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in convs.columns}
    kind = F.crc32(F.concat_ws(":", spaced["conv_id"], spaced["turn"]).cast("binary")) % 20
    rows = convs.select(
        "conv_id", "turn", kind.alias("kind"), F.when(kind == 4, "user").otherwise(spaced["role"]).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(spaced["text"], "[.!?]", "")).otherwise(spaced["text"]).alias("text"),
    )
    twice = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return rows.filter("kind != 0").select("conv_id", "turn", "role", "text", twice)


REPAIR_SQL = r"""
WITH RECURSIVE
tab AS (
  SELECT list(c ORDER BY i) AS t
  FROM (SELECT i, list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
                              lambda x, y: CASE WHEN x & 1 = 1 THEN xor(3988292384::BIGINT, x >> 1) ELSE x >> 1 END) AS c
        FROM (SELECT unnest(range(256)) AS i))),
spaced AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
crc AS (
  SELECT conv_id, turn, role, text,
         xor(4294967295::BIGINT,
             list_reduce([4294967295::BIGINT] || list_transform(string_split(name, ''), lambda x: ascii(x)::BIGINT),
                         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 AS kind
  FROM spaced, tab),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM crc WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
         rtrim(text, E' \t\n\x0b\f\r') AS trimmed FROM damaged),
marked AS (
  SELECT *, trimmed = '' AS blank, trimmed <> '' AND row_number() OVER (PARTITION BY conv_id, role, md5(text) ORDER BY i) > 1 AS again,
         left(role, 1) AS r, lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS next_r FROM placed),
rows AS (
  SELECT *, blank OR again AS must_go, NOT blank AND NOT again AND right(trimmed, 1) NOT IN ('.', '!', '?') AS cut FROM marked),
faults AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE again) AS duplicate, count(*) FILTER (WHERE cut) AS truncated,
         count(*) FILTER (WHERE next_r IS NOT NULL AND r || next_r NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM rows GROUP BY conv_id),
moves(q, ins, op, r, to_q, cost, emits) AS (
  SELECT a.q, a.ins, b.op, b.r, b.to_q, a.cost + b.cost, a.emits || b.emits
  FROM (VALUES (0, '', 0, 0, ''), (1, '', 1, 0, ''), (2, '', 2, 0, ''), (3, '', 3, 0, ''),
               (0, 'I', 2, 2, 'u'), (1, 'I', 2, 2, 'u'), (2, 'I', 3, 2, 'a'), (3, 'I', 2, 2, 'u'),
               (0, 'II', 3, 4, 'ua'), (1, 'II', 3, 4, 'ua')) AS a(q, ins, q2, cost, emits)
  JOIN (VALUES (0, 'D', NULL, 0, 3, ''), (1, 'D', NULL, 1, 3, ''), (2, 'D', NULL, 2, 3, ''), (3, 'D', NULL, 3, 3, ''),
               (0, 'K', 's', 1, 0, 'k'), (0, 'K', 'u', 2, 0, 'k'), (1, 'K', 'u', 2, 0, 'k'), (2, 'K', 'a', 3, 0, 'k'), (3, 'K', 'u', 2, 0, 'k'),
               (0, 'R', NULL, 2, 2, 'U'), (1, 'R', NULL, 2, 2, 'U'), (2, 'R', NULL, 3, 2, 'A'), (3, 'R', NULL, 2, 2, 'U')
       ) AS b(q, op, r, to_q, cost, emits) ON a.q2 = b.q),
walk(conv_id, i, q, best) AS (
  SELECT conv_id, 0::BIGINT, 0, {'cost': 0::BIGINT, 'audit': '', 'emits': []::VARCHAR[]} FROM faults
  UNION ALL
  SELECT w.conv_id, w.i + 1, m.to_q,
         min({'cost': w.best.cost + m.cost + CASE WHEN cut AND m.op <> 'D' THEN 1 ELSE 0 END,
              'audit': w.best.audit || m.ins || m.op,
              'emits': w.best.emits || list_transform(string_split(m.emits, ''), lambda e:
                         CASE e WHEN 'u' THEN 'user:' WHEN 'a' THEN 'assistant:' WHEN 'U' THEN 'user:' || text
                                WHEN 'A' THEN 'assistant:' || text WHEN 'k' THEN role || ':' || text END)})
  FROM walk w JOIN rows x ON w.conv_id IS NOT DISTINCT FROM x.conv_id AND x.i = w.i + 1
  JOIN moves m ON m.q = w.q AND (m.op = 'D' OR NOT must_go) AND (m.r IS NULL OR m.r = x.r)
  GROUP BY w.conv_id, w.i, m.to_q),
ends AS (
  SELECT f.conv_id, min({'cost': best.cost + e.cost, 'audit': best.audit || e.ins, 'emits': best.emits || e.emits}) AS best
  FROM faults f JOIN walk w ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND w.i = f.n
  JOIN (VALUES (0, 0, '', []::VARCHAR[]), (3, 0, '', []), (2, 2, 'I', ['assistant:']), (1, 4, 'II', ['user:', 'assistant:'])) AS e(q, cost, ins, emits) ON e.q = w.q
  GROUP BY f.conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
       coalesce(best.audit, '') AS audit,
       sha256(coalesce(array_to_string(list_filter(best.emits, lambda e: e IS NOT NULL), chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@query("op12_turn_repair", REPAIR_SQL)
def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = turn_repair.repair(_damaged(spark, sf_dir))
    named = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.lit(1).alias("one")).select("conv_id", turn_repair.conversation().alias("c"))
    out = named.join(found.summary(), "c", "left").join(found.digests(), "c", "left")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(
        "conv_id", *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


PHRASES_SQL = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)),
sizes AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
grams AS (
  SELECT lang, w[i:i + m - 1] AS g, m
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM pieces, (VALUES (1), (2), (3), (4), (5)) AS widths(m) WHERE len(w) >= m)),
f AS (SELECT lang, g, m, count(*) AS f FROM grams GROUP BY lang, g, m HAVING count(*) >= 100),
inner_parts AS (
  SELECT lang, g[i:i + k - 1] AS g, max(f) AS longer
  FROM (SELECT lang, g, f, m, k, unnest(range(1, m - k + 2)) AS i FROM f, (VALUES (2), (3), (4)) AS widths(k) WHERE k < m)
  GROUP BY 1, 2),
kept AS (
  SELECT f.* FROM f LEFT JOIN inner_parts p ON p.lang = f.lang AND p.g = f.g WHERE m >= 2 AND (longer IS NULL OR 100 * longer < 100 * f)),
cuts AS (
  SELECT c.lang, c.g, c.f AS a, n, k, x.f AS l, y.f AS r,
         (1000::HUGEINT * c.f::HUGEINT * n::HUGEINT) // (x.f::HUGEINT * y.f::HUGEINT) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM kept) c JOIN sizes USING (lang)
  JOIN f x ON x.lang = c.lang AND x.g = c.g[1:k] JOIN f y ON y.lang = c.lang AND y.g = c.g[k + 1:]),
least_cut AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank,
         array_to_string(g, ' ') AS phrase, a, l, r, n, score::BIGINT AS score FROM least_cut)
SELECT * FROM ranked WHERE rank <= 2000
"""


@query("op11_phrase_mining", PHRASES_SQL)
def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrase_mining.mine(table(spark, sf_dir, "documents"), min_count=100, most_words=5)
    return phrase_mining.top(found, 2000).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
