"""Queries that apply the corpus operators to the driver's tables, and their SQL."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import conversations, infilling, language, mixing, packing, repetition, secrets, sharding, surrogates, token_files, url_filter
from .common import shared_folder, table
from .near_duplicates import near_duplicates
from .neighbours import neighbours


#: Host, path and action of each rule.
URL_RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return url_filter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


OP1_SQL = """
WITH rules(host, path, action) AS (
  VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')
), rest AS (
  SELECT page_id, row_number() OVER () AS r, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, r, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), fit AS (
  SELECT p.r, rules.host || rules.path AS rule, action,
         row_number() OVER (PARTITION BY p.r ORDER BY length(rules.host || rules.path) DESC, length(rules.host) DESC, action DESC) AS k
  FROM p JOIN rules ON (p.host = rules.host OR ends_with(p.host, '.' || rules.host)) AND starts_with(p.path, rules.path)
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM p LEFT JOIN fit ON fit.r = p.r AND fit.k = 1
"""


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, by models fitted on documents outside fold 2; a null id counts as fold 0."""
    fold = F.coalesce(language.remainder(F.col("doc_id")), F.lit(0))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", fold.alias("fold"))
    model = language.train(docs.filter("fold <> 2").select("text", "lang", "fold"))
    return language.identify(docs.select("doc_id", "text", (F.col("fold") == 2).alias("held_out")), model)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word, line and repetition statistics of every document, and whether it is kept."""
    return repetition.quality(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("longest_repeat")


OP3_SQL = """
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM d
), five AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM (
    SELECT r, i, array_to_string(words[i:i + 4], ' ') AS g FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5))
), eight AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM (
    SELECT r, i, array_to_string(words[i:i + 7], ' ') AS g FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8))
), long AS (
  SELECT DISTINCT r FROM (
    SELECT r, md5(array_to_string(words[i:i + n - 1], ' ')) AS g FROM (
      SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM (
        SELECT r, words, greatest(20, len(words) // 20 + 1) AS n FROM w WHERE r IN (SELECT r FROM eight WHERE c > 1)) WHERE len(words) > n))
  GROUP BY r, g HAVING count(*) > 1
), in_five AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM five WHERE c > 1) GROUP BY r
), in_eight AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM eight WHERE c > 1) GROUP BY r
), line AS (
  SELECT r, count(*) - count(DISTINCT l) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM w)
  WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY r
), s AS (
  SELECT w.r, doc_id, len(words)::BIGINT AS n_words, coalesce(length(array_to_string(words, '')), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(line.n, 0)::BIGINT AS n_dup_lines,
         coalesce(in_five.n, 0)::BIGINT AS n_repeat_words, coalesce(in_eight.n, 0)::BIGINT AS covered_words, long.r IS NOT NULL AS too_long
  FROM w LEFT JOIN line ON line.r = w.r LEFT JOIN in_five ON in_five.r = w.r LEFT JOIN in_eight ON in_eight.r = w.r LEFT JOIN long ON long.r = w.r
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * covered_words <= 15 * n_words AND NOT too_long AS kept
FROM s
"""


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of nearly equal bytes that keep equal texts together."""
    shards = sharding.kd_shards(table(spark, sf_dir, "documents"), 8)
    return shards.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, with what the whole corpus says about them."""
    return secrets.digest_columns(secrets.scan(table(spark, sf_dir, "documents")))


#: The patterns of secrets for an engine without look-behind: border, pattern, group of the value, fewest characters.
_EITHER = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
_SQL_KINDS = {
    "assign": ("()", rf"(?:{_EITHER})[\"\x27]?\x20*[:=]\x20*[\"\x27]?([A-Za-z0-9+/_.=-]+)", 2, 12),
    "access": ("()", "(AKIA[A-Z0-9]{14,})", 2, 18),
    "hex": ("()", "([0-9a-f]{16,})", 2, 16),
    "service": ("(^|[^A-Za-z0-9])", "((?:gh[pousr]_[A-Za-z0-9]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}|(?:sk|pk|rk)_(?:live|test)_[A-Za-z0-9]{10,}|AIza[A-Za-z0-9_-]{30,}))", 2, 14),
    "jwt": ("(^|[^A-Za-z0-9_-])", r"(eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})", 2, 27),
    "pem": ("()", "(-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----)", 2, 27),
}
OP5_SQL = (
    "WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents), k(kind, name, pattern, grp, fewest) AS (VALUES "
    + ", ".join(f"({i}, '{n}', '{border}{pattern}', {g}, {fewest})" for i, (n, (border, pattern, g, fewest)) in enumerate(_SQL_KINDS.items()))
    + """), found AS ("""
    + " UNION ALL ".join(
        f"SELECT r, {i} AS kind, regexp_extract_all(text, '{border}{pattern}', 0) AS f, regexp_extract_all(text, '{border}{pattern}', 1) AS b, regexp_extract_all(text, '{border}{pattern}', {g}) AS v, string_split_regex(text, '{border}{pattern}') AS gaps FROM d WHERE regexp_matches(text, '{border}{pattern}')"
        for i, (border, pattern, g, _) in enumerate(_SQL_KINDS.values())
    )
    + """), each AS (
  SELECT r, kind, unnest(f) AS f, unnest(b) AS b, unnest(v) AS v, unnest(gaps[1:len(f)]) AS g, unnest(range(1, len(f) + 1)) AS i FROM found
), placed AS (
  SELECT *, sum(length(g) + length(f)) OVER (PARTITION BY r, kind ORDER BY i) AS e FROM each
), span AS (
  SELECT r, kind, name, CAST(e - length(f) + length(b) AS BIGINT) AS s, CAST(e AS BIGINT) AS e, v, text, coalesce(source, chr(0)) AS owner FROM placed JOIN k USING (kind) JOIN d USING (r) WHERE length(v) >= fewest
), own AS (
  SELECT v, count(DISTINCT owner) AS owners, count(DISTINCT text) AS repositories FROM span GROUP BY v
), judged AS (
  SELECT *, name || ':' || s || ':' || e AS shown, CASE WHEN owners >= 3 AND repositories >= 3 THEN 'example'
    WHEN name = 'pem' OR (len(list_distinct(string_split(v, ''))) >= 6 AND ((regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')) OR length(v) >= 20)
         AND NOT regexp_matches(lower(v), 'example|sample|placeholder|changeme|dummy|xxxx|0{8}|12345678')) THEN 'live' ELSE 'weak' END AS verdict
  FROM span JOIN own USING (v)
), text_of AS (
  SELECT r, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex,
    string_agg(shown, ',' ORDER BY s, kind) FILTER (WHERE kind < 3) AS base, string_agg(shown, ',' ORDER BY s, kind, e) FILTER (WHERE kind < 3 OR verdict = 'live') AS spans,
    count(*) FILTER (WHERE verdict = 'live') AS n_live, count(*) FILTER (WHERE kind < 3 AND verdict = 'example') AS n_example FROM judged GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_example, 0)::BIGINT AS n_example FROM d LEFT JOIN text_of USING (r)
"""
)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources by weights 5, 2, 1 takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.0, most=3.0).drop("source")


OP6_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM d GROUP BY source
), w AS (
  SELECT *, CAST([5, 2, 1][(place - 1) % 3 + 1] AS DOUBLE) AS weight, source_size * 3.0::DOUBLE AS bound FROM s
), o AS (
  SELECT *, bound / weight AS ratio, sum(source_size) OVER () * 1.0::DOUBLE - coalesce(sum(bound) OVER before, 0) AS rest, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS open_weight FROM w
  WINDOW before AS (ORDER BY bound / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT arg_min(rest / open_weight, (ratio, place)) AS level FROM o WHERE rest / open_weight < ratio
), t AS (
  SELECT source, source_size, least(bound, coalesce(level * weight, bound)) AS target FROM o, level
), b AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t
), u AS (
  SELECT d.*, source_size, target, whole, target - whole * source_size AS budget, sum(size) OVER (PARTITION BY d.source ORDER BY h, r ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source WHERE size > 0
), e AS (
  SELECT *, min(upto) FILTER (WHERE upto + 0.5 >= budget AND budget > 0) OVER (PARTITION BY source) AS edge FROM u
), taken AS (
  SELECT r, size * CAST(whole + CASE WHEN upto < edge OR (upto = edge AND 2 * (budget - (upto - size)) >= size) THEN 1 ELSE 0 END AS BIGINT) AS taken FROM e
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source LEFT JOIN taken USING (r)
"""


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors by inner product of every vector whose id is divisible by 20; factor 1 searches exactly."""
    return neighbours(table(spark, sf_dir, "embeddings"), k=20, every=20, factor=1.0)


OP7_SQL = """
WITH e AS (
  SELECT vec_id, row_number() OVER () AS r, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), s AS (
  SELECT q.vec_id AS query_id, q.r AS qr, c.vec_id, c.r, list_inner_product(q.v, c.v) AS score
  FROM e q JOIN e c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id, r) AS INTEGER) AS rank, vec_id, score FROM s)
WHERE rank <= 20
"""


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents at a Jaccard similarity of 0.85 of five-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85, width=5).drop("tkey", "first")


OP8_SQL = """
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), g AS (
  SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT r, count(*) AS n FROM g GROUP BY r
), link AS (
  SELECT x.a, x.b FROM (SELECT p.r AS a, q.r AS b, count(*) AS common FROM g p JOIN g q ON p.g = q.g AND p.r < q.r GROUP BY ALL) x JOIN n na ON na.r = x.a JOIN n nb ON nb.r = x.b
  WHERE 100 * common >= 85 * (na.n + nb.n - common)
), both_ways AS (
  SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reach(r, other) AS (
  SELECT r, r FROM n UNION SELECT reach.r, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.other
), least AS (
  SELECT reach.r, min(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.other GROUP BY reach.r
)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, CASE WHEN n.n IS NULL THEN doc_id ELSE component_id END AS component_id,
  doc_id IS NOT DISTINCT FROM CASE WHEN n.n IS NULL THEN doc_id ELSE component_id END AS kept FROM d LEFT JOIN n USING (r) LEFT JOIN least USING (r)
"""


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced; the key comes from spark.scorelake.surrogateKey, and is a fresh random one where that is unset."""
    key = spark.conf.get("spark.scorelake.surrogateKey", None) or os.urandom(32).hex()
    return surrogates.replace(table(spark, sf_dir, "documents").select("doc_id", "text"), key=key)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and digest of every conversation after damage."""
    return conversations.plans(conversations.damaged(table(spark, sf_dir, "conversations")))


def _op11_sql() -> str:
    """A recursion over the rows of all conversations with the cheapest audit of each place, as cost in nine digits and letters."""
    add = lambda v, cost, letter: f"lpad(CAST(CAST(substr({v}, 1, 9) AS INT) + {cost} AS VARCHAR), 9, '0') || substr({v}, 10) || '{letter}'"
    keep = lambda kind, v: f"CASE WHEN NOT gone AND kind = {kind} THEN {add(v, 'cut', 'K')} END"
    rerole = lambda v: f"CASE WHEN NOT gone THEN {add(v, '2 + cut', 'R')} END"
    behind = [
        add("p0", 3, "D"),
        f"least({add('p1', 3, 'D')}, {keep(0, 'p0')})",
        f"least({add('p2', 3, 'D')}, {', '.join(f(v) for v in ('p0', 'p1', 'p3') for f in (lambda v: keep(1, v), rerole))})",
        f"least({add('p3', 3, 'D')}, {keep(2, 'p2')}, {rerole('p2')})",
    ]
    user = f"least(r2, {add('r0', 2, 'I')}, {add('r1', 2, 'I')}, {add('r3', 2, 'I')})"
    return f"""
WITH RECURSIVE bits(n, k, v) AS (
  SELECT CAST(range AS BIGINT), 0, CAST(range AS BIGINT) FROM range(256)
  UNION ALL SELECT n, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8
), crc AS (
  SELECT list(v ORDER BY n) AS tab FROM bits WHERE k = 8
), given AS (
  SELECT conv_id, dense_rank() OVER (ORDER BY conv_id) AS c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ord(x) AS BIGINT))),
           lambda a, b: xor(a >> 8, tab[CAST(xor(a, b) & 255 AS INT) + 1]))) % 20 AS kind FROM conversations, crc
), damaged AS (
  SELECT c, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM given
), placed AS (
  SELECT c, turn, role, text, row_number() OVER w AS i, left(role, 1) AS initial, lag(left(role, 1)) OVER w AS earlier,
         row_number() OVER (PARTITION BY c, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ends
  FROM damaged WINDOW w AS (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy)
), told AS (
  SELECT *, ends = '' AS blank, ends <> '' AND again AS duplicate, ends <> '' AND NOT again AND right(ends, 1) NOT IN ('.', '!', '?') AS truncated,
         CASE initial WHEN 's' THEN 0 WHEN 'u' THEN 1 WHEN 'a' THEN 2 ELSE 3 END AS kind FROM placed
), step AS (
  SELECT c, i, kind, blank OR duplicate AS gone, CAST(truncated AS INT) AS cut FROM told
), counted AS (
  SELECT c, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate,
         count(*) FILTER (WHERE truncated) AS truncated, count(*) FILTER (WHERE i > 1 AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM told GROUP BY c
), way(c, i, p0, p1, p2, p3) AS (
  SELECT c, CAST(0 AS BIGINT), '000000000', CAST(NULL AS VARCHAR), '000000002I', '000000004II' FROM counted
  UNION ALL
  SELECT c, i, r0, r1, r2, least(r3, {add('r2', 2, 'I')}) FROM (
    SELECT c, i, r0, r1, {user} AS r2, r3 FROM (
      SELECT step.c, step.i, {', '.join(f'{x} AS r{k}' for k, x in enumerate(behind))} FROM way JOIN step ON step.c = way.c AND step.i = way.i + 1))
), best AS (
  SELECT way.c, CAST(substr(least(p0, p3), 1, 9) AS BIGINT) AS cost, substr(least(p0, p3), 10) AS audit FROM way JOIN counted ON counted.c = way.c AND counted.n = way.i
), letter AS (
  SELECT c, k, substr(audit, CAST(k AS INT), 1) AS x FROM (SELECT c, audit, unnest(range(1, length(audit) + 1)) AS k FROM best)
), edit AS (
  SELECT c, k, x, sum(CASE WHEN x = 'I' THEN 0 ELSE 1 END) OVER (PARTITION BY c ORDER BY k) AS i FROM letter
), line AS (
  SELECT edit.c, k, x, told.role, CASE WHEN x = 'I' THEN '' ELSE text END AS text,
         sum(CASE WHEN x = 'K' AND initial = 's' THEN 0 ELSE 1 END) OVER (PARTITION BY edit.c ORDER BY k) AS turns FROM edit LEFT JOIN told ON told.c = edit.c AND told.i = edit.i WHERE x <> 'D'
), whole AS (
  SELECT c, string_agg(CASE WHEN x = 'K' THEN role WHEN turns % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY k) AS body FROM line GROUP BY c
)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, c FROM given) LEFT JOIN counted USING (c) LEFT JOIN best USING (c) LEFT JOIN whole USING (c)
"""


OP11_SQL = _op11_sql()


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, tokens and checksum, from token files that are written and read back."""
    folder = f"{shared_folder(spark)}/ids-{uuid.uuid4().hex}"
    token_files.write_ids(table(spark, sf_dir, "documents"), folder)
    read = token_files.read_ids(spark, folder)
    return read.select("doc_id", "start", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op13_infilling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and digests of every document with its middle moved to the end."""
    moved = infilling.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return moved.select(
        "doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"), F.sha2(infilling.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


OP13_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), g AS (
  SELECT doc_id, t, length(t) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d
), c AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM g
), o AS (
  SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CAST(CASE WHEN form <> 'plain' THEN a END AS BIGINT) AS prefix_chars, CAST(CASE WHEN form <> 'plain' THEN b - a END AS BIGINT) AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM o
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline, applied to the documents."""
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_url_filter, op2_language_id, op3_quality_rules, op4_sharding, op5_secret_scan, op6_mixing, op7_neighbours, op8_near_duplicates, op9_packing, op10_surrogates, op11_conversation_repair, op12_token_files, op13_infilling, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filter": OP1_SQL, "op3_quality_rules": OP3_SQL, "op5_secret_scan": OP5_SQL, "op6_mixing": OP6_SQL, "op7_neighbours": OP7_SQL, "op8_near_duplicates": OP8_SQL, "op11_conversation_repair": OP11_SQL, "op13_infilling": OP13_SQL}
