"""Registered corpus queries: thin wrappers that apply each operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm import chat, decontamination, html_extraction, lm_scoring, mixing, quality_rules, simhash, suffix_dedup, token_counts, url_rules
from corvane.llm.common import read_table

#: The rules of the URL query (action, host, path).
URL_RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), wins AS (
  SELECT DISTINCT item_id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS win
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM (SELECT item_id, w, least(13, len(w)) AS k FROM b WHERE len(w) > 0))
), places AS (
  SELECT doc_id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM wins) WHERE len(w) >= k)
), hits AS (
  SELECT p.doc_id, p.i, p.k, x.item_id FROM places p JOIN wins x ON p.k = x.k AND p.win = x.win
), words AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS spot FROM hits) GROUP BY doc_id
), ids AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN ids USING (doc_id)
"""


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(read_table(spark, sf_dir, "documents"))


_LIMITS = quality_rules.NGRAM_LIMITS
OP2_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), places AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT unnest({[3, *_LIMITS]}) AS n) WHERE len(w) >= n)
), again AS (
  SELECT doc_id, n, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, n, g) AS c FROM places) WHERE c > 1
), cover AS (
  SELECT doc_id, n, count(*) AS words, sum(length(w[spot])) AS chars
  FROM (SELECT DISTINCT doc_id, n, unnest(range(i, i + n)) AS spot FROM again) JOIN d USING (doc_id) GROUP BY doc_id, n
), lines AS (
  SELECT doc_id, count(*) FILTER (WHERE k > 1) AS n_dup_lines, sum(strlen(line)) FILTER (WHERE k > 1) AS dup_line_chars, sum(strlen(line)) AS line_chars
  FROM (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line) AS k FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]'))
  GROUP BY doc_id
), x AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda a: length(a))), 0) AS BIGINT) AS word_chars, length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce((SELECT words FROM cover c WHERE c.doc_id = d.doc_id AND n = 3), 0) AS n_repeat_words,
    CAST(coalesce(dup_line_chars, 0) AS BIGINT) AS dup_line_chars, CAST(coalesce(line_chars, 0) AS BIGINT) AS line_chars,
    {", ".join(f"CAST(coalesce((SELECT chars FROM cover c WHERE c.doc_id = d.doc_id AND n = {n}), 0) AS BIGINT) AS dup_chars_{n}" for n in _LIMITS)}
  FROM d LEFT JOIN lines USING (doc_id)
), y AS (SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM x)
SELECT *, NOT (base_failed OR n_symbols > {quality_rules.MAX_SYMBOL_SHARE}::DOUBLE * n_words OR dup_line_chars > {quality_rules.MAX_LINE_SHARE}::DOUBLE * line_chars
  OR {" OR ".join(f"dup_chars_{n} > {x}::DOUBLE * word_chars" for n, x in _LIMITS.items())}) AS kept FROM y
"""


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), str(path))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(read_table(spark, sf_dir, "documents"))


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(read_table(spark, sf_dir, "pages"), URL_RULES)


OP5_SQL = """
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM parts
), rules(action, rhost, rpath) AS (
  VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('block', 'net', '/de/'),
         ('allow', 'example.net', '/de/8'), ('block', 'org', '/es/')
), pairs AS (
  SELECT DISTINCT host, path FROM split
), best AS (
  SELECT host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(action, length(rhost || rpath)) AS action
  FROM pairs JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY host, path
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM split LEFT JOIN best USING (host, path)
"""


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract_pages(read_table(spark, sf_dir, "pages"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scores(read_table(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.suffix_dedup(read_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["length"])
    return out.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2(F.coalesce("kept", F.lit(b"")), 256).alias("kept_sha256")
    )


OP8_SQL = """
WITH h AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), s AS (
  SELECT doc_id, i, substr(x, 2 * i + 1, 100) AS s FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2 - 49)) AS i FROM h WHERE length(x) >= 100)
), f AS (
  SELECT s, min(doc_id) AS m FROM s GROUP BY s HAVING min(doc_id) < max(doc_id)
), c AS (
  SELECT DISTINCT s.doc_id, i FROM s JOIN f ON s.s = f.s WHERE m < s.doc_id
), g AS (
  SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM (SELECT *, CAST(i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -99) + 50 AS INTEGER) AS fresh FROM c)
), spans AS (
  SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM g GROUP BY doc_id, g
), pieces AS (
  SELECT doc_id, a, b, substr(x, 2 * before + 1, 2 * (a - before)) AS piece FROM (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans) JOIN h USING (doc_id)
), kept AS (
  SELECT doc_id, string_agg(piece, '' ORDER BY a) AS head, max(b) AS tail, count(*) AS n_spans, sum(b - a) AS n_removed FROM pieces GROUP BY doc_id
)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(tail, 0) + 1))) AS kept_sha256 FROM h LEFT JOIN kept USING (doc_id)
"""


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(read_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


#: The schemas of the tools that ``tool_turns`` calls (name, param, type, required).
TOOLS = [("search", "query", "string", True), ("search", "limit", "integer", False)]


def tool_turns(conversations: DataFrame) -> DataFrame:
    """The conversations as tool use: a user turn t makes call ``c<t>``, an assistant turn answers the call before it.

    With n the length of a turn's text: calls depend on the user turn before (``c<t-2>``), every fifth (by n) on the one
    after it instead; every fourth lacks its query, has a string for a limit, or names an unknown tool; every seventh
    result names the call after it. Other turns stay as they are.
    """
    n, text = F.length(F.coalesce("text", F.lit(""))), F.coalesce("text", F.lit(""))
    ident = lambda shift: F.concat(F.lit("c"), (F.col("turn") + shift).cast("string"))
    kind = n % 4
    limit = n % 10
    arguments = (
        F.when(kind == 1, F.to_json(F.struct(limit.alias("limit"))))
        .when(kind == 2, F.to_json(F.struct(limit.cast("string").alias("limit"), text.alias("query"))))
        .otherwise(F.to_json(F.struct(limit.alias("limit"), text.alias("query"))))
    )
    needs = F.when(n % 5 == 0, F.array(ident(2))).when(F.col("turn") >= 2, F.array(ident(-2))).otherwise(F.array().cast("array<string>"))
    call = F.concat(
        F.lit('{"tool_calls":[{"id":"'), ident(0), F.lit('","name":"'), F.when(kind == 3, "nobody").otherwise("search"), F.lit('","arguments":'), arguments,
        F.lit(',"depends_on":'), F.to_json(needs), F.lit("}]}"),
    )
    result = F.to_json(F.struct(F.when(n % 7 == 0, ident(1)).otherwise(ident(-1)).alias("tool_call_id"), text.alias("content")))
    return conversations.withColumn("text", F.when(F.col("role") == "user", call).when(F.col("role") == "assistant", result).otherwise(F.col("text")))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    schemas = spark.createDataFrame(TOOLS, chat.SCHEMA_DDL)
    return chat.format_turns(tool_turns(read_table(spark, sf_dir, "conversations")), schemas)


OP10_SQL = """
WITH RECURSIVE t AS (
  SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS x, length(coalesce(text, '')) AS n FROM conversations
), calls AS (
  SELECT conv_id, turn, role, 'c' || turn AS id, CASE WHEN n % 5 = 0 THEN 'c' || (turn + 2) WHEN turn >= 2 THEN 'c' || (turn - 2) END AS needs,
    CASE n % 4 WHEN 1 THEN 'missing_argument' WHEN 2 THEN 'wrong_type' WHEN 3 THEN 'unknown_tool' END AS fault,
    '{"arguments":' || CASE n % 4 WHEN 1 THEN to_json({'limit': n % 10})::VARCHAR WHEN 2 THEN to_json({'limit': CAST(n % 10 AS VARCHAR), 'query': x})::VARCHAR
      ELSE to_json({'limit': n % 10, 'query': x})::VARCHAR END || ',"depends_on":[' || coalesce('"' || needs || '"', '') || '],"id":"' || id || '","name":"' || CASE n % 4 WHEN 3 THEN 'nobody' ELSE 'search' END || '"}' AS json
  FROM t WHERE role = 'user'
), reach(conv_id, id, anc, d) AS (
  SELECT conv_id, id, id, 0 FROM calls
  UNION
  SELECT r.conv_id, r.id, b.id, d + 1 FROM reach r JOIN calls a ON a.conv_id = r.conv_id AND a.id = r.anc JOIN calls b ON b.conv_id = a.conv_id AND b.id = a.needs WHERE d < 100
), levels AS (
  SELECT r.conv_id, r.id, max(d) AS level, max(c.turn) AS top FROM reach r JOIN calls c ON c.conv_id = r.conv_id AND c.id = r.anc GROUP BY ALL
), results AS (
  SELECT conv_id, turn, role, CASE WHEN n % 7 = 0 THEN 'c' || (turn + 1) ELSE 'c' || (turn - 1) END AS id, x FROM t WHERE role = 'assistant'
), answers AS (
  SELECT c.conv_id, c.id, min(r.turn) AS answer FROM calls c JOIN results r ON r.conv_id = c.conv_id AND r.id = c.id AND r.turn > c.turn GROUP BY ALL
)
SELECT conv_id, turn, 'message' AS kind, CAST(NULL AS VARCHAR) AS call_id, CAST(NULL AS BIGINT) AS linked_turn, 'message' AS status,
  turn AS order_turn, CAST(0 AS BIGINT) AS level, to_json({'content': x, 'role': role})::VARCHAR AS message_json
FROM t WHERE role NOT IN ('user', 'assistant')
UNION ALL
SELECT c.conv_id, c.turn, 'call', c.id, answer,
  CASE WHEN fault IS NOT NULL THEN fault WHEN level >= 100 THEN 'cyclic' WHEN needs IS NOT NULL AND NOT EXISTS (SELECT 1 FROM calls o WHERE o.conv_id = c.conv_id AND o.id = c.needs) THEN 'unknown_dependency'
    WHEN answer IS NULL THEN 'unanswered' ELSE 'ok' END,
  CASE WHEN level >= 100 THEN c.turn ELSE top END, CASE WHEN level >= 100 THEN -1 ELSE 2 * level END, '{"role":' || to_json(role)::VARCHAR || ',"tool_call":' || json || '}'
FROM calls c JOIN levels USING (conv_id, id) LEFT JOIN answers USING (conv_id, id)
UNION ALL
SELECT r.conv_id, r.turn, 'result', r.id, CASE WHEN r.turn > c.turn THEN c.turn END,
  CASE WHEN c.turn IS NULL THEN 'orphan' WHEN r.turn > c.turn THEN 'linked' ELSE 'early' END,
  CASE WHEN r.turn > c.turn THEN CASE WHEN level >= 100 THEN c.turn ELSE top END ELSE r.turn END,
  CASE WHEN r.turn > c.turn THEN CASE WHEN level >= 100 THEN 0 ELSE 2 * level + 1 END ELSE 0 END,
  '{"role":' || to_json(r.role)::VARCHAR || ',"tool_result":' || to_json({'content': x, 'tool_call_id': r.id})::VARCHAR || '}'
FROM results r LEFT JOIN calls c ON c.conv_id = r.conv_id AND c.id = r.id LEFT JOIN levels l ON l.conv_id = r.conv_id AND l.id = r.id
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontamination": op1_decontamination,
        "op2_quality_rules": op2_quality_rules,
        "op3_token_counts": op3_token_counts,
        "op4_mixing": op4_mixing,
        "op5_url_rules": op5_url_rules,
        "op6_html_extraction": op6_html_extraction,
        "op7_lm_scoring": op7_lm_scoring,
        "op8_suffix_dedup": op8_suffix_dedup,
        "op9_simhash": op9_simhash,
        "op10_chat": op10_chat,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_decontamination": OP1_SQL, "op2_quality_rules": OP2_SQL, "op5_url_rules": OP5_SQL, "op8_suffix_dedup": OP8_SQL, "op10_chat": OP10_SQL}
