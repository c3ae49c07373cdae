"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import chat, conversation, divergence, embedding, html_text, line_dedup, lm, mixing, quality, sentencepiece_viterbi, simhash, suffix, token_counts
from tessera.llm.common import table
from tessera.session import configure


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_near_dedup(table(configure(spark), sf_dir, "documents"), shingle=3, max_distance=2)


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(configure(spark), sf_dir, "pages")).withColumn("n_chars", F.length("text"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_viterbi.encode(table(configure(spark), sf_dir, "documents"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = mixing.copies(table(configure(spark), sf_dir, "documents"))
    return n.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("n_copies")).alias("taken"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(configure(spark), sf_dir, "documents").select("doc_id", "text")
    return quality.quality_rules(docs, table(spark, sf_dir, "labels")).drop("text")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(configure(spark), sf_dir, "documents"), rule="first")


#: Tools that op7 finds in the conversations, and the fields they take.
TOOLS = {
    "search": {"limit": ("integer", True), "query": ("string", True)},
    "lookup": {"id": ("integer", True), "strict": ("boolean", False)},
}


def op7_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user turn as a tool call, every assistant turn as the result of the turn before it.

    The tool, its arguments (some of them wrong) and the earlier call that a
    call depends on follow from the length of the turn's text.
    """
    turns = table(configure(spark), sf_dir, "conversations").withColumn("n", F.length("text"))
    n, call = F.col("n"), lambda t: F.concat(F.lit("c"), t.cast("string"))
    name = F.element_at(F.array(*[F.lit(x) for x in ("search", "lookup", "other")]), (n % 3 + 1).cast("int"))
    query, limit = F.col("text"), n % 50
    arguments = (F.when(n % 7 == 0, F.col("text"))
                 .when(n % 3 == 0, F.when(n % 5 == 0, F.to_json(F.struct(query.alias("query")))).otherwise(F.to_json(F.struct(query.alias("query"), limit.alias("limit")))))
                 .otherwise(F.when(n % 5 == 0, F.to_json(F.struct(F.lit("yes").alias("strict"), limit.alias("id"))))
                            .when(n % 5 == 1, F.to_json(F.struct(limit.alias("id"), F.lit(1).alias("extra")))).otherwise(F.to_json(F.struct(limit.alias("id"))))))
    parent = F.when(n % 4 < 3, call(F.col("turn") - 2))
    calls = turns.filter("role = 'user'").select("conv_id", call(F.col("turn")).alias("call_id"), "turn", name.alias("name"),
                                                 arguments.alias("arguments"), parent.alias("parent_id"))
    results = turns.filter("role = 'assistant'").select("conv_id", call(F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    return chat.link_tool_calls(calls, results, TOOLS)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.repeated_passages(table(configure(spark), sf_dir, "documents"), min_words=50).drop("th")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest of every text after the deletions, and whether it lost a line."""
    docs = table(configure(spark), sf_dir, "documents").select("doc_id", "text").withColumn("before", F.length("text"))
    return line_dedup.line_dedup(docs).select("doc_id", F.length("text").alias("n_chars"), F.md5("text").alias("text_md5"),
                                              (F.length("text") < F.col("before")).alias("changed"))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.embedding_near_dedup(table(configure(spark), sf_dir, "embeddings"), threshold=0.95)


def op11_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    return lm.lm_scores(table(configure(spark), sf_dir, "documents"), held_out)


def damaged(turns: DataFrame) -> DataFrame:
    """The conversations with a fault in every fourth row: dropped, emptied, unended, repeated or given to the user."""
    read = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select("conv_id", "turn", read("role").alias("role"), read("text").alias("text"),
                        (F.crc32(F.concat(read("conv_id"), F.lit(":"), read("turn"))) % 20).alias("fault"))
    fault = F.col("fault")
    text = F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(fault == 0, F.array().cast("array<int>")).when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(configure(spark), sf_dir, "conversations")
    report = conversation.repair_report(damaged(turns)).withColumnRenamed("conv_id", "id")
    every = turns.select("conv_id").distinct()
    none = F.sha2(F.lit(""), 256)
    return every.join(report, F.col("conv_id").eqNullSafe(F.col("id")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit({"audit": ""}.get(c, 0)) if c != "repaired_sha256" else none).alias(c) for c in conversation.PARTS])


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(configure(spark), sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_simhash_near_dedup, op2_html_extraction, op3_sentencepiece, op4_mix_sources, op5_quality_rules, op6_token_counts, op7_tool_calls,
    op8_suffix_dedup, op9_line_dedup, op10_embedding_near_dedup, op11_lm_scores, op12_conversation_repair, op13_source_divergence)}

ORACLE: dict[str, str] = {}

WORDS = r"'[^\x20\x09-\x0D]+'"

ORACLE["op4_mix_sources"] = f"""
WITH rows AS (SELECT doc_id AS id, source, coalesce(len(regexp_extract_all(text, {WORDS})), 0)::BIGINT AS size FROM documents),
  sources AS (SELECT source, count(*) AS n_source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source),
  weighed AS (SELECT *, 3 * source_size AS cap, ([1, 2, 3])[(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1]::BIGINT AS w FROM sources),
  leveled AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0))::DOUBLE / (sum(w) OVER () - coalesce(sum(w) OVER o, 0))::DOUBLE AS lv
    FROM weighed WINDOW o AS (ORDER BY cap::DOUBLE / w::DOUBLE, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  aimed AS (SELECT source, n_source, source_size, least(cap::DOUBLE, (max(lv) OVER ()) * w) AS target,
    (('0x' || substr(md5('7:' || coalesce(source, '')), 1, 12))::BIGINT % 1099511627776) / 1099511627776::DOUBLE AS u FROM leveled),
  classed AS (SELECT r.*, source_size, target, u, n_source, floor(2 * sqrt(r.size::DOUBLE))::INT AS class,
    CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE 0 END AS rate
    FROM rows r JOIN aimed a ON r.source IS NOT DISTINCT FROM a.source),
  salted AS (SELECT *, ('0x' || substr(md5('7:' || id::VARCHAR), 1, 12))::BIGINT
      % ceil(count(*) OVER (PARTITION BY source, class) / ceil(sqrt(n_source::DOUBLE)))::BIGINT AS salt FROM classed),
  placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY class, salt, size, id) AS k FROM salted)
SELECT id AS doc_id, size, source_size, target,
  size * (floor(k * rate + u) - floor((k - 1) * rate + u))::BIGINT AS taken FROM placed
"""

ORACLE["op7_tool_calls"] = """
WITH RECURSIVE t AS (SELECT *, length(text) AS n, text AS q FROM conversations),
  calls AS (SELECT conv_id, 'c' || turn AS call_id, min(turn) AS turn, count(*) AS n_calls, any_value(n) AS n, any_value(text) AS text, any_value(q) AS q,
    any_value(['search', 'lookup', 'other'][n % 3 + 1]) AS name, any_value(CASE WHEN n % 4 < 3 THEN 'c' || (turn - 2) END) AS parent_id
    FROM t WHERE role = 'user' GROUP BY ALL),
  results AS (SELECT conv_id, 'c' || (turn - 1) AS call_id, min(turn) AS r_turn, count(*) AS n_results, any_value(text) AS content
    FROM t WHERE role = 'assistant' GROUP BY ALL),
  lv AS (SELECT conv_id, call_id, 0 AS level FROM calls c WHERE NOT EXISTS (SELECT 1 FROM calls p WHERE p.conv_id = c.conv_id AND p.call_id = c.parent_id)
    UNION ALL SELECT c.conv_id, c.call_id, level + 1 FROM lv JOIN calls c ON c.conv_id = lv.conv_id AND c.parent_id = lv.call_id),
  said AS (SELECT calls.*, level, CASE WHEN n % 7 = 0 THEN to_json(text)::VARCHAR
      WHEN n % 3 = 0 AND n % 5 = 0 THEN '{"query":' || to_json(q)::VARCHAR || '}'
      WHEN n % 3 = 0 THEN '{"limit":' || n % 50 || ',"query":' || to_json(q)::VARCHAR || '}'
      WHEN n % 5 = 0 THEN '{"id":' || n % 50 || ',"strict":"yes"}' WHEN n % 5 = 1 THEN '{"extra":1,"id":' || n % 50 || '}' ELSE '{"id":' || n % 50 || '}' END AS args,
    CASE WHEN n % 3 = 2 THEN ['unknown_tool'] WHEN n % 7 = 0 THEN ['not_json'] WHEN n % 3 = 0 AND n % 5 = 0 THEN ['missing:limit'] WHEN n % 3 = 0 THEN []
      WHEN n % 5 = 0 THEN ['type:strict'] WHEN n % 5 = 1 THEN ['unknown:extra'] ELSE [] END AS wrong
    FROM calls JOIN lv USING (conv_id, call_id))
SELECT conv_id, call_id, level, coalesce(turn, r_turn) AS turn,
  CASE WHEN n_calls IS NULL THEN 'no_call' WHEN n_results IS NULL THEN 'no_result' ELSE 'linked' END AS status, coalesce(wrong, []) AS errors,
  coalesce(n_calls, 0) AS n_calls, coalesce(n_results, 0) AS n_results,
  '{"arguments":' || coalesce(args, 'null') || ',"call_id":' || to_json(call_id)::VARCHAR || ',"name":' || coalesce(to_json(name)::VARCHAR, 'null')
    || ',"parent_id":' || coalesce(to_json(parent_id)::VARCHAR, 'null') || ',"result":' || coalesce(to_json(content)::VARCHAR, 'null') || '}' AS json
FROM said FULL OUTER JOIN results USING (conv_id, call_id)
"""

SPACE = r"[\x20\x09-\x0D]"

ORACLE["op9_line_dedup"] = f"""
WITH split AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
  lines AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos FROM split),
  seq AS (SELECT doc_id, pos, s, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k, lead(s) OVER (PARTITION BY doc_id ORDER BY pos) AS after
    FROM (SELECT *, regexp_replace(line, '^{SPACE}+|{SPACE}+$', '', 'g') AS s FROM lines) WHERE s <> ''),
  runs AS (SELECT doc_id, k, 2 AS n, [s, after] AS run FROM seq WHERE after IS NOT NULL
    UNION ALL SELECT doc_id, k, 1, [s] FROM seq WHERE len(regexp_extract_all(s, {WORDS})) >= 20),
  later AS (SELECT doc_id, k, n FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, k) AS rn FROM runs) WHERE rn > 1),
  gone AS (SELECT DISTINCT doc_id, pos FROM seq JOIN (SELECT doc_id, unnest(range(k, k + n)) AS k FROM later) USING (doc_id, k)),
  kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS t FROM lines ANTI JOIN gone USING (doc_id, pos) GROUP BY 1)
SELECT doc_id, length(coalesce(t, '')) AS n_chars, md5(coalesce(t, '')) AS text_md5, length(coalesce(t, '')) < length(text) AS changed
FROM documents LEFT JOIN kept USING (doc_id) WHERE text IS NOT NULL
UNION ALL SELECT doc_id, NULL, NULL, NULL FROM documents WHERE text IS NULL
"""

ORACLE["op10_embedding_near_dedup"] = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings),
  near AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.x, b.x) >= 0.95),
  reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, n.b FROM reach r JOIN near n ON n.a = r.b),
  root AS (SELECT a, min(b) AS component_id FROM reach GROUP BY 1)
SELECT vec_id, (SELECT count(*) FROM near WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN root ON a = vec_id
"""

ORACLE["op13_source_divergence"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
  occ AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
  kept AS (SELECT lang, term, count(*)::HUGEINT AS ln FROM occ GROUP BY ALL HAVING count(DISTINCT r) >= 3),
  vocabulary AS (SELECT lang, count(*)::HUGEINT AS v, sum(ln)::HUGEINT AS lt FROM kept GROUP BY lang),
  uses AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM occ SEMI JOIN kept USING (lang, term) GROUP BY ALL),
  groups AS (SELECT g.lang, g.source, coalesce(sum(n), 0)::HUGEINT AS total FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN uses USING (lang, source) GROUP BY ALL),
  shares AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // (total + v) AS p,
    1 + (1000000000::HUGEINT * (ln + 1)) // (lt + v) AS q
    FROM groups g JOIN kept k USING (lang) JOIN vocabulary USING (lang) LEFT JOIN uses u ON u.lang = g.lang AND u.source = g.source AND u.term = k.term),
  pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
  every AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
  marks AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM shares WHERE n > 0 AND p > q),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS k FROM marks)
SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item))::INT AS rank FROM every
UNION ALL SELECT lang, source, 'term', item, value, k::INT FROM ranked WHERE k <= 200
"""
