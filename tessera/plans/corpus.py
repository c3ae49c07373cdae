"""Document corpus jobs: PII redaction and statistics, page text, links,
reachability, chunking, vector retrieval and context assembly."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph, pii, text, vectors
from ..operators.reports import FISCAL_ODD_VALUES, fiscal_check_char, vat_check_digit
from ..operators.sinks import build_chunk_table
from ..session import scratch_dir
from ..sources.tables import read_table
from .reports import _fiscal_sql, _vat_sql

ALPHA = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
K = 5


# The same identifiers as people write them, the ones after each "not" with a wrong check digit.
SPELLED = (" IBAN DE89370400440532013000, IT60 X054 2811 1010 0000 0123 456 not DE89370400440532013001 card 4111 1111 1111 1111, 4111-1111-1111-1111 "
           "not 4111 1111 1111 1112 code rssmra85t10a562s not rssmra85t10a562t call 333 1234567 or 06 1234567")


def pii_source(spark, sf_dir):
    """Documents; every fifth one ends with a line carrying identifiers built
    from its id (half of the tax codes/VAT numbers with a wrong check) and some in other spellings."""
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    i = F.col("doc_id")
    plate = F.concat(F.substring(F.lit(ALPHA), (i % 26 + 1).cast("int"), 1),
                     F.substring(F.lit(ALPHA), ((i / 26).cast("bigint") % 26 + 1).cast("int"), 1),
                     F.lpad((i % 1000).cast("string"), 3, "0"), F.lit("XY"))
    cf15 = F.concat(F.lit("RSSMRA"), F.lpad((i % 100).cast("string"), 2, "0"), F.lit("A"),
                    F.lpad((i % 28 + 1).cast("string"), 2, "0"), F.lit("H"), F.lpad((i % 1000).cast("string"), 3, "0"))
    cf = F.concat(cf15, F.when(i % 10 == 0, fiscal_check_char(cf15)).otherwise(F.lit("Z")))
    vat10 = F.lpad((i * 7919 % 10_000_000_000).cast("string"), 10, "0")
    check = vat_check_digit(vat10)
    vat = F.concat(vat10, F.when(i % 10 == 0, check).otherwise((check + 1) % 10).cast("string"))
    seven = F.lpad((i % 10_000_000).cast("string"), 7, "0")
    line = F.concat(F.lit("\nTarga "), plate, F.lit(" "), plate, F.lit("/AB12345, codice fiscale "), cf, F.lit(", partita IVA 00743110157 "), vat,
                    F.lit(" 00743110157 9"), vat, F.lit(". Passaporto YA"), seven, F.lit(" patente MI"), seven, F.lit("K carta AY "), seven,
                    F.lit(" CA"), F.substring(seven, 3, 5), F.lit("AA tel. +39 02 555 "), F.substring(seven, 4, 4), F.lit(", a"), seven, F.lit("@example.org"), F.lit(SPELLED))
    return d.select("doc_id", F.when(i % 5 == 0, F.concat("text", line)).otherwise(F.col("text")).alias("text"))


def redacted(spark, sf_dir, mode="replace"):
    return pii.redact(pii_source(spark, sf_dir), "text", mode=mode, out_col="text_anon").select("doc_id", "text_anon")


def q_pii_redact(spark, sf_dir):
    return redacted(spark, sf_dir)


def q_pii_mask(spark, sf_dir):
    return redacted(spark, sf_dir, "mask")


def q_pii_entity_counts(spark, sf_dir):
    return pii.pii_entity_counts(redacted(spark, sf_dir), "text_anon")


def q_pii_combinations(spark, sf_dir):
    return pii.pii_combinations(redacted(spark, sf_dir), "text_anon")


def _pages(spark, sf_dir):
    return read_table(spark, sf_dir, "pages", ["url", "html"])


def q_page_text(spark, sf_dir):
    return text.page_text(_pages(spark, sf_dir))


# Links of every kind, added to each page: the URLs have two path segments.
ANCHORS = ("<a href='../x/./y.html?q=1#f'>u</a><A HREF=\"?page=2\">q</A><a class=c href=\"./rel/../sib\">s</a><a href='/abs/../top/'>t</a>"
           "<a href=\"//cdn.example.org/lib\">c</a><a href='mailto:a@b.it'>m</a><a href=\"#here\">h</a>")
PREFIX = "http://"


def _linked_pages(spark, sf_dir):
    return _pages(spark, sf_dir).withColumn("html", F.concat("html", F.lit(ANCHORS)))


def q_link_edges(spark, sf_dir):
    return text.link_edges(_linked_pages(spark, sf_dir))


def q_link_urls(spark, sf_dir):
    """B15 + F4: the sorted distinct links under a base prefix."""
    return text.link_list(text.link_edges(_linked_pages(spark, sf_dir), base_prefix=PREFIX))


HOPS = 12


def q_reachable_urls(spark, sf_dir):
    """H16 from the URL of page 0. Pages also name the next page of their run
    of HOPS pages, so the search goes HOPS pages deep."""
    pages = read_table(spark, sf_dir, "pages", ["page_id", "url", "html"]).withColumn("node", F.regexp_replace("url", "#.*$", ""))
    after = pages.select((F.col("page_id") - 1).alias("page_id"), F.col("node").alias("dst"))
    chain = pages.where((F.col("page_id") + 1) % HOPS != 0).join(after, "page_id").select(F.col("node").alias("src"), "dst")
    return graph.reachable(text.link_edges(pages).unionByName(chain), pages.where("page_id = 0").select("node"))


def q_chunk_fixed(spark, sf_dir):
    return text.chunk_fixed(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), "doc_id", "text")


def q_chunk_recursive(spark, sf_dir):
    return text.chunk_recursive(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), "doc_id", "text")


def q_chunk_recursive_check(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return text.chunk_report(docs, text.chunk_recursive(docs, "doc_id", "text"), "doc_id", "text")


def q_corpus_chunks(spark, sf_dir):
    """Every document chunk with its own vector."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "source"])
    chunks = text.chunk_fixed(docs, "doc_id", "text").join(docs.select("doc_id", "source"), "doc_id")
    return build_chunk_table(chunks.withColumn("embedding", text.letter_vector(F.col("chunk"))), scratch_dir(spark, "chunk-table"))


def label_centroids(spark, sf_dir):
    """Query vectors: the mean embedding of every label (bounded by the label count)."""
    e = read_table(spark, sf_dir, "embeddings", ["label", "embedding"])
    per_dim = e.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(
        F.avg("x").alias("v"))
    return per_dim.groupBy(F.col("label").cast("bigint").alias("query_id")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda s: s["v"]).alias("embedding"))


def q_knn_cosine(spark, sf_dir):
    corpus = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    hits = vectors.knn(label_centroids(spark, sf_dir), corpus, K)
    return hits.select("query_id", "vec_id", F.round("distance", 6).alias("distance"), "rank")


def q_knn_context(spark, sf_dir):
    """K2: the chunks and sources of the kNN hits of every benchmark item."""
    chunks = q_corpus_chunks(spark, sf_dir).withColumnRenamed("id", "vec_id")
    items = read_table(spark, sf_dir, "benchmark", ["item_id", "text"]).select(
        F.col("item_id").alias("query_id"), text.letter_vector(F.col("text")).alias("embedding"))
    return vectors.context(vectors.knn(items, chunks.select("vec_id", "embedding"), K), chunks)


QUERIES = {
    "pii_redact": q_pii_redact,
    "pii_mask": q_pii_mask,
    "pii_entity_counts": q_pii_entity_counts,
    "pii_combinations": q_pii_combinations,
    "page_text": q_page_text,
    "link_edges": q_link_edges,
    "link_urls": q_link_urls,
    "reachable_urls": q_reachable_urls,
    "chunk_fixed": q_chunk_fixed,
    "chunk_recursive": q_chunk_recursive,
    "chunk_recursive_check": q_chunk_recursive_check,
    "knn_cosine": q_knn_cosine,
    "knn_context": q_knn_context,
    "corpus_chunks": q_corpus_chunks,
}

# ---------------------------------------------------------------- DuckDB oracle


def _fiscal_check_sql(code):
    odd = "[" + ", ".join(str(v) for v in FISCAL_ODD_VALUES) + "]"
    terms = []
    for i in range(15):
        pos = f"instr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', substr({code}, {i + 1}, 1))"
        terms.append(f"{odd}[{pos}]" if i % 2 == 0 else f"(CASE WHEN {pos} <= 10 THEN {pos} - 1 ELSE {pos} - 11 END)")
    return f"substr('{ALPHA}', ({' + '.join(terms)}) % 26 + 1, 1)"


def _vat_check_sql(code):
    terms = []
    for i in range(10):
        d = f"TRY_CAST(substr({code}, {i + 1}, 1) AS INTEGER)"
        terms.append(d if i % 2 == 0 else f"(CASE WHEN {d} * 2 > 9 THEN {d} * 2 - 9 ELSE {d} * 2 END)")
    return f"((10 - ({' + '.join(terms)}) % 10) % 10)"


def _luhn_sql(c):
    d = f"cast(substr({c}, length({c}) - i, 1) AS INTEGER)"
    return (f"(list_sum(list_transform(range(length({c})), lambda i: CASE WHEN i % 2 = 1 THEN "
            f"(CASE WHEN 2 * {d} > 9 THEN 2 * {d} - 9 ELSE 2 * {d} END) ELSE {d} END)) % 10 = 0)")


# The oracle knows entities as whole tokens: a text is cut into runs of word
# characters and runs of others, and every run that is an identifier in full is
# replaced. Its shapes are written out here on purpose, apart from the library's.
_TOKEN_RULES = (
    ("CREDIT_CARD", f"regexp_full_match(w, '\\d+') AND length(w) BETWEEN 13 AND 19 AND {_luhn_sql('w')}"),
    ("IT_FISCAL_CODE", f"length(w) = 16 AND {_fiscal_sql('upper(w)')}"),
    ("IT_VAT_CODE", f"length(w) = 11 AND {_vat_sql('w')}"),
    ("IT_DRIVER_LICENSE", "length(w) = 10 AND (regexp_full_match(w, '[A-Z][A-Z]\\d{7}[A-Z]') OR regexp_full_match(w, 'U1[B-DF-HJ-NPR-UW-Z\\d]{7}[A-Z]'))"),
    ("IT_PASSPORT", "length(w) = 9 AND regexp_full_match(lower(w), '[a-z][a-z]\\d{7}')"),
    ("IT_IDENTITY_CARD", "length(w) = 9 AND (regexp_full_match(lower(w), '\\d{7}[a-z][a-z]') OR regexp_full_match(lower(w), '[a-z][a-z]\\d{5}[a-z][a-z]'))"),
    ("IT_VEHICLE_PLATE", "regexp_full_match(w, '[A-Z]{2}\\d{3}[A-Z]{2}') OR regexp_full_match(w, '\\d\\d[A-Z]{2}\\d\\d') "
                         "OR regexp_full_match(w, '[A-Z]{2}\\d{5}') OR regexp_full_match(w, '\\d\\d[A-Z]{3}\\d\\d')"),
)
_STARS = {"IT_FISCAL_CODE": 10, "IT_VEHICLE_PLATE": 2}
_NAMES = ("EMAIL_ADDRESS", "IBAN_CODE", "CREDIT_CARD", "IT_FISCAL_CODE", "IT_VAT_CODE", "IT_DRIVER_LICENSE", "IT_PASSPORT", "IT_IDENTITY_CARD",
          "IT_VEHICLE_PLATE", "PHONE_NUMBER")
_KEYS = ("IT_VEHICLE_PLATE", "IT_FISCAL_CODE", "IT_VAT_CODE")


def _redact_ctes(mode):
    def new(entity):
        n = _STARS.get(entity) if mode == "mask" else None
        return f"'<{entity}>'" if n is None else f"left(w, length(w) - {n}) || repeat('*', {n})"

    case = "CASE " + " ".join(f"WHEN {rule} THEN {new(entity)}" for entity, rule in _TOKEN_RULES) + " ELSE w END"
    spaced = "regexp_replace({}, '(^|\\W)([A-Za-z]{{2}} \\d{{7}})($|\\W)', '\\1<IT_IDENTITY_CARD>\\3', 'g')"
    # IBANs are in the added line only: what becomes of them is written out by hand
    ibans = "replace(replace(t, 'DE89370400440532013000', '<IBAN_CODE>'), 'IT60 X054 2811 1010 0000 0123 456', '<IBAN_CODE>')"
    digits = "replace(replace(w, ' ', ''), '-', '')"
    cards = (f"list_filter(regexp_extract_all(t, '\\b(?:\\d{{4}} \\d{{4}} \\d{{4}} \\d{{4}}|\\d{{4}}-\\d{{4}}-\\d{{4}}-\\d{{4}})\\b'), lambda w: {_luhn_sql(digits)})")
    mobile = "regexp_replace({}, '(^|\\W)(3\\d\\d[ .-]?\\d{{3}}[ .-]?\\d{{3,4}}|0\\d{{1,3}}[ /-]\\d{{5,8}})($|\\W)', '\\1<PHONE_NUMBER>\\3', 'g')"
    return [
        f"r0 AS (SELECT doc_id, list_reduce(list_concat([t], {cards}), lambda acc, w: replace(acc, w, '<CREDIT_CARD>')) AS t FROM (SELECT doc_id, {ibans} AS t FROM src))",
        "r1 AS (SELECT doc_id, regexp_replace(t, '[\\w.%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}', '<EMAIL_ADDRESS>', 'g') AS t FROM r0)",
        f"r2 AS (SELECT doc_id, array_to_string(list_transform(regexp_extract_all(t, '\\w+|\\W+'), lambda w: {case}), '') AS t FROM r1)",
        f"r3 AS (SELECT doc_id, {spaced.format(spaced.format('t'))} AS t FROM r2)",
        "r4 AS (SELECT doc_id, regexp_replace(t, '\\+\\d{1,3} ?\\(?\\d{2,4}\\)?[ -]?\\d{3}[ -]?\\d{3,4}($|\\W)', '<PHONE_NUMBER>\\1', 'g') AS t FROM r3)",
        f"r5 AS (SELECT doc_id, {mobile.format(mobile.format('t'))} AS t FROM r4)",
    ], "r5"


_SRC = f"""
src AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN concat(text, chr(10), 'Targa ', plate, ' ', plate, '/AB12345, codice fiscale ',
  cf15 || CASE WHEN doc_id % 10 = 0 THEN {_fiscal_check_sql('cf15')} ELSE 'Z' END, ', partita IVA 00743110157 ', vat, ' 00743110157 9', vat,
  '. Passaporto YA', seven, ' patente MI', seven, 'K carta AY ', seven, ' CA', substr(seven, 3, 5), 'AA tel. +39 02 555 ', substr(seven, 4, 4),
  ', a', seven, '@example.org{SPELLED}') ELSE text END AS t
  FROM (SELECT *, vat10 || cast(CASE WHEN doc_id % 10 = 0 THEN {_vat_check_sql('vat10')} ELSE ({_vat_check_sql('vat10')} + 1) % 10 END AS VARCHAR) AS vat
  FROM (SELECT doc_id, text,
    concat(substr('{ALPHA}', cast(doc_id % 26 + 1 AS INTEGER), 1), substr('{ALPHA}', cast((doc_id // 26) % 26 + 1 AS INTEGER), 1),
      lpad(cast(doc_id % 1000 AS VARCHAR), 3, '0'), 'XY') AS plate,
    concat('RSSMRA', lpad(cast(doc_id % 100 AS VARCHAR), 2, '0'), 'A', lpad(cast(doc_id % 28 + 1 AS VARCHAR), 2, '0'), 'H',
      lpad(cast(doc_id % 1000 AS VARCHAR), 3, '0')) AS cf15,
    lpad(cast(doc_id * 7919 % 10000000000 AS VARCHAR), 10, '0') AS vat10, lpad(cast(doc_id % 10000000 AS VARCHAR), 7, '0') AS seven FROM documents)))
"""


def _redacted_sql(mode, select):
    ctes, last = _redact_ctes(mode)
    return "WITH " + _SRC + ", " + ", ".join(ctes) + f", red AS (SELECT doc_id, t AS text_anon FROM {last}) " + select


_FOUND = ("list_filter([" + ", ".join(f"CASE WHEN contains(text_anon, '<{e}>') THEN '{e}' END" for e in _NAMES)
          + "], lambda x: x IS NOT NULL)")
_GROUP = ("CASE WHEN len(list_filter(found, lambda x: x IN (" + ", ".join(f"'{e}'" for e in _KEYS)
          + "))) > 0 THEN 'ANY " + "/".join(_KEYS) + "' ELSE 'NONE " + "/".join(_KEYS) + "' END")

_HOST = "^([a-z]+://[^/?#]+)"
_CHUNKS = ("SELECT doc_id, source, chunk_no, substr(text, chunk_no * 800 + 1, 1000) AS chunk FROM (SELECT doc_id, text, source, "
           "unnest(range(greatest(1, cast(ceil((length(text) - 200) / 800) AS INTEGER)))) AS chunk_no FROM documents WHERE length(text) > 0)")


def _vector_sql(t):
    low = f"lower({t})"
    return "cast([" + ", ".join(f"length({low}) - length(replace({low}, '{c}', ''))" for c in "abcdefghilmnoprs") + ", 1] AS FLOAT[])"


# What the added anchors must become, written out per page: its directory, the one above, and the rest by hand.
_EDGES = f"""
pg AS (SELECT page_id, regexp_replace(url, '#.*$', '') AS src, html FROM pages),
pg2 AS (SELECT *, regexp_replace(src, '[?].*$', '') AS bare, regexp_extract(src, '{_HOST}', 1) AS host,
  regexp_extract(regexp_replace(src, '[?].*$', ''), '^(.*/)[^/]*$', 1) AS dir FROM pg),
own AS (SELECT src, host, dir, unnest(regexp_extract_all(html, '<a\\s[^>]*href="([^"]*)"', 1)) AS href FROM pg2),
plain AS (SELECT DISTINCT src, host, regexp_replace(CASE WHEN href LIKE '%://%' THEN href WHEN href LIKE '/%' THEN host || href ELSE dir || href END, '#.*$', '') AS dst
  FROM own WHERE href <> '' AND href NOT LIKE '#%' AND href NOT LIKE 'mailto:%' AND href NOT LIKE 'javascript:%'),
added AS (SELECT src, host, unnest([regexp_replace(dir, '[^/]+/$', '') || 'x/y.html?q=1', bare || '?page=2', dir || 'sib', host || '/top/',
  regexp_extract(src, '^([a-z]+:)', 1) || '//cdn.example.org/lib']) AS dst FROM pg2),
edges AS (SELECT src, dst FROM plain WHERE starts_with(dst, host)),
all_edges AS (SELECT DISTINCT src, host, dst FROM (SELECT * FROM plain UNION ALL SELECT * FROM added))
"""

# Recursive chunks in SQL: pieces by the coarsest separator that leaves them
# longer than a chunk, and then one step of the recursion for each chunk.
def _split_sql(step, parts):
    return (f"p{step} AS (SELECT doc_id, list_append(ord, k) AS ord, parts[k] AS t FROM (SELECT doc_id, ord, parts, "
            f"unnest(range(1, len(parts) + 1)) AS k FROM (SELECT doc_id, ord, CASE WHEN length(t) > {text.CHUNK_SIZE} THEN {parts} "
            f"ELSE [t] END AS parts FROM p{step - 1})) WHERE parts[k] <> '')")


def _after_sql(sep):
    return f"string_split(replace(t, {sep}, {sep} || chr(1)), chr(1))"


_RECURSIVE = (
    "WITH RECURSIVE p0 AS (SELECT doc_id, [0] AS ord, text AS t FROM documents WHERE length(text) > 0), "
    + ", ".join(_split_sql(n, parts) for n, parts in enumerate([
        _after_sql("chr(10) || chr(10)"), _after_sql("chr(10)"), _after_sql("' '"),
        f"list_transform(range(0, length(t), {text.CHUNK_SIZE}), lambda i: substr(t, i + 1, {text.CHUNK_SIZE}))"], 1))
    + ", spans AS (SELECT doc_id, list(e - n ORDER BY ord) AS lo, list(e ORDER BY ord) AS hi FROM (SELECT doc_id, ord, length(t) AS n, "
    "cast(sum(length(t)) OVER (PARTITION BY doc_id ORDER BY ord) AS BIGINT) AS e FROM p4) GROUP BY 1), "
    f"c(doc_id, chunk_no, i, j) AS (SELECT doc_id, 0, cast(1 AS BIGINT), len(list_filter(hi, lambda e: e <= {text.CHUNK_SIZE})) FROM spans "
    f"UNION ALL SELECT doc_id, chunk_no + 1, i2, len(list_filter(hi, lambda e: e - lo[i2] <= {text.CHUNK_SIZE})) FROM ("
    "SELECT c.doc_id, chunk_no, lo, hi, list_filter(range(i + 1, j + 2), lambda m: m = j + 1 OR "
    f"(hi[j] - lo[m] <= {text.CHUNK_OVERLAP} AND hi[j + 1] - lo[m] <= {text.CHUNK_SIZE}))[1] AS i2 "
    "FROM c JOIN spans s ON s.doc_id = c.doc_id WHERE j < len(hi))) "
    "SELECT d.doc_id, chunk_no, lo[i] AS start_index, substr(text, lo[i] + 1, hi[j] - lo[i]) AS chunk "
    "FROM c JOIN spans s ON s.doc_id = c.doc_id JOIN documents d ON d.doc_id = c.doc_id")

ORACLE = {
    "pii_redact": _redacted_sql("replace", "SELECT * FROM red"),
    "pii_mask": _redacted_sql("mask", "SELECT * FROM red"),
    "pii_entity_counts": _redacted_sql(
        "replace", f"SELECT entity, count(*) AS n FROM (SELECT unnest({_FOUND}) AS entity FROM red) GROUP BY 1"),
    "pii_combinations": _redacted_sql(
        "replace", f", f AS (SELECT {_FOUND} AS found FROM red) "
        "SELECT combination, count(*) AS n FROM (SELECT CASE WHEN len(found) = 1 THEN concat('SOLO ', found[1]) "
        "WHEN len(found) > 1 THEN array_to_string(list_sort(found), '-') END AS combination FROM f) "
        f"WHERE combination IS NOT NULL GROUP BY 1 UNION ALL SELECT {_GROUP} AS combination, count(*) AS n FROM f GROUP BY 1"
    ),
    "link_edges": f"WITH {_EDGES} SELECT src, dst FROM all_edges WHERE regexp_extract(dst, '{_HOST}', 1) = host",
    "link_urls": f"WITH {_EDGES} SELECT DISTINCT dst AS url FROM all_edges WHERE dst LIKE 'http://%'",
    "page_text": (
        "SELECT url, t AS text FROM (SELECT url, array_to_string(list_filter(list_transform(regexp_split_to_array(regexp_replace("
        "regexp_extract(html, '(?s)<body[^>]*>(.*?)(</body>|$)', 1), "
        "'(?s)<(script|style|nav|footer|header|aside|form)[ >].*?</(script|style|nav|footer|header|aside|form)>', '<x>', 'g'), '<[^>]*>'), "
        "lambda x: regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(x, '&copy;', '©'), '&middot;', '·'), '&quot;', chr(34)), '&lt;', '<'), "
        "'&gt;', '>'), '&#39;', chr(39)), '&amp;?', '&', 'g'), '^\\s+|\\s+$', '', 'g')), "
        "lambda x: x <> ''), chr(10)) AS t FROM pages) WHERE length(trim(t)) >= 50"),
    "chunk_recursive": _RECURSIVE,
    "chunk_recursive_check": ("SELECT doc_id, cast(length(text) AS INTEGER) AS n_chars, TRUE AS covered, TRUE AS in_size, TRUE AS same_text "
                              "FROM documents WHERE length(text) > 0"),
    "reachable_urls": (
        "WITH RECURSIVE " + _EDGES.strip() + f", steps AS (SELECT src, dst FROM edges UNION ALL SELECT a.src, b.src FROM pg a JOIN pg b "
        f"ON b.page_id = a.page_id + 1 WHERE (a.page_id + 1) % {HOPS} <> 0), r(node) AS (SELECT src FROM pg WHERE page_id = 0 "
        "UNION SELECT e.dst FROM r JOIN steps e ON e.src = r.node) SELECT DISTINCT node FROM r"),
    "chunk_fixed": (
        "SELECT doc_id, chunk_no, cast(chunk_no * 800 AS INTEGER) AS start_index, concat(cast(doc_id AS VARCHAR), '_', "
        "cast(chunk_no AS VARCHAR)) AS chunk_id, substr(text, chunk_no * 800 + 1, 1000) AS chunk FROM (SELECT doc_id, text, "
        "cast(unnest(range(greatest(1, cast(ceil((length(text) - 200) / 800) AS INTEGER)))) AS INTEGER) AS chunk_no "
        "FROM documents WHERE length(text) > 0)"),
    "knn_cosine": (
        "WITH c AS (SELECT query_id, list(v ORDER BY i) AS q FROM (SELECT cast(label AS BIGINT) AS query_id, i, avg(x) AS v "
        "FROM (SELECT label, unnest(embedding) AS x, unnest(range(len(embedding))) AS i FROM embeddings) GROUP BY ALL) "
        "GROUP BY 1), d AS (SELECT c.query_id, e.vec_id, 1 - list_cosine_similarity(c.q, cast(e.embedding AS DOUBLE[])) "
        "AS dist FROM c, embeddings e) SELECT query_id, vec_id, round(dist, 6) AS distance, rank FROM (SELECT *, "
        f"cast(row_number() OVER (PARTITION BY query_id ORDER BY round(dist, 12), vec_id) AS INTEGER) AS rank FROM d) WHERE rank <= {K}"),
    "corpus_chunks": (
        f"SELECT concat(cast(doc_id AS VARCHAR), '_', cast(chunk_no AS VARCHAR)) AS id, {_vector_sql('chunk')} AS embedding, chunk AS document, "
        f"source, cast(chunk_no * 800 AS INTEGER) AS start_index FROM ({_CHUNKS})"),
    "knn_context": (
        f"WITH c AS (SELECT concat(cast(doc_id AS VARCHAR), '_', cast(chunk_no AS VARCHAR)) AS id, source, chunk, cast({_vector_sql('chunk')} AS DOUBLE[]) AS v "
        f"FROM ({_CHUNKS})), q AS (SELECT item_id, cast({_vector_sql('text')} AS DOUBLE[]) AS v FROM benchmark), "
        "d AS (SELECT item_id, id, source, chunk, round(1 - list_cosine_similarity(q.v, c.v), 12) AS dist FROM q, c), "
        f"h AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY dist, id) AS rank FROM d QUALIFY rank <= {K}) "
        "SELECT item_id AS query_id, array_to_string(list_sort(list_distinct(list(source))), ',') AS sources, "
        "string_agg(chunk, chr(10) || '---' || chr(10) ORDER BY rank) AS context FROM h GROUP BY 1"),
}
