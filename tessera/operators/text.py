"""Text jobs: page text, links, chunking.

Fixed-stride chunking is pure Spark (``sequence`` + ``substring`` +
``posexplode``). HTML parsing and separator-aware chunking need real parsing,
so they run as Arrow-batched jobs with small stdlib helpers;
Spark still partitions the pages/documents and every text is processed whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------- fixed values
DROPPED_TAGS = ("script", "style", "nav", "footer", "header", "aside", "form")
MIN_PAGE_TEXT = 50
CHUNK_SIZE = 1000
CHUNK_OVERLAP = 200
SEPARATORS = ("\n\n", "\n", " ", "")
LINK_SKIP_PREFIXES = ("mailto:", "javascript:")
LINK_PATTERN = r"(?i)<a\s[^>]*?href\s*=\s*(\"[^\"]*\"|'[^']*')"
#: Bytes of text whose chunks a task holds at once; a longer document is one piece.
PIECE = 1 << 22
VECTOR_LETTERS = "abcdefghilmnoprs"
ORIGIN_PATTERN = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"
# ------------------------------------------------------------------------------

class _TextCollector(HTMLParser):
    """Text of the first <main> (else <body>) without dropped subtrees below it;
    a dropped tag around <main> does not hide it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.in_main = 0  # open elements of that name since the first <main>
        self.main_done = False
        self.in_body = False
        self.skip = 0
        self.main_skip = 0
        self.main_parts: list[str] = []
        self.body_parts: list[str] = []
        self.seen_main = False

    def handle_starttag(self, tag, attrs):
        if tag == "body":
            self.in_body = True
        if tag == "main" and not self.main_done:
            self.in_main += 1
            self.seen_main = True
        if tag in DROPPED_TAGS:
            self.skip += 1
            self.main_skip += bool(self.in_main)

    def handle_endtag(self, tag):
        if tag in DROPPED_TAGS:
            self.skip -= bool(self.skip)
            self.main_skip -= bool(self.main_skip)
        if tag == "main" and self.in_main:
            self.in_main -= 1
            self.main_done = not self.in_main
        if tag == "body":
            self.in_body = False

    def handle_data(self, data):
        piece = data.strip()
        if piece and self.in_main and not self.main_skip:
            self.main_parts.append(piece)
        if piece and self.in_body and not self.skip:
            self.body_parts.append(piece)

    def text(self) -> str | None:
        if self.seen_main:
            return "\n".join(self.main_parts)
        return "\n".join(self.body_parts) if self.body_parts or self.in_body else None


def extract_text(html: str | None) -> str | None:
    if html is None:
        return None
    parser = _TextCollector()
    parser.feed(html)
    parser.close()
    return parser.text()


def page_text(pages: DataFrame, url_col: str = "url", html_col: str = "html",
              min_len: int = MIN_PAGE_TEXT) -> DataFrame:
    """(url, text) of pages whose extracted text has at least ``min_len`` characters."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = [extract_text(h) for h in b[html_col]]
            yield pd.DataFrame({"url": b[url_col], "text": texts})

    out = pages.select(url_col, html_col).mapInPandas(run, "url string, text string")
    return out.where(F.length(F.trim("text")) >= min_len)


def chunk_fixed(df: DataFrame, id_col: str, text_col: str, size: int = CHUNK_SIZE,
                overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """Chunks of ``size`` characters every ``size - overlap`` characters
    (the last chunk reaches the end of the text); id ``<id>_<j>``."""
    stride = size - overlap
    n = F.greatest(F.lit(1), F.ceil((F.length(text_col) - F.lit(overlap)) / F.lit(stride)).cast("int"))
    # the cuts are exploded, not the text, so no row carries more than its chunk
    cuts = F.transform(F.sequence(F.lit(0), n - 1), lambda j: F.substring(F.col(text_col), j * stride + 1, F.lit(size)))
    rows = df.where(F.length(text_col) > 0).select(id_col, F.posexplode(cuts).alias("chunk_no", "chunk"))
    return rows.select(
        id_col, "chunk_no", (F.col("chunk_no") * F.lit(stride)).alias("start_index"),
        F.concat(F.col(id_col).cast("string"), F.lit("_"), F.col("chunk_no").cast("string")).alias("chunk_id"), "chunk")


def split_spans(text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
                seps: tuple[str, ...] = SEPARATORS) -> list[tuple[int, int]]:
    """Separator-aware chunk spans [start, end) of ``text``: pieces are cut at the
    coarsest separator present, merged up to ``size`` characters, and
    consecutive chunks share up to ``overlap`` trailing characters."""

    def pieces(lo: int, hi: int, level: int) -> list[tuple[int, int]]:
        if hi - lo <= size:
            return [(lo, hi)]
        sep = next((s for s in seps[level:] if s == "" or text.find(s, lo, hi) >= 0), "")
        lvl = seps.index(sep)
        if sep == "":
            return [(i, min(i + size, hi)) for i in range(lo, hi, size)]
        out, start = [], lo
        while start < hi:
            cut = text.find(sep, start, hi)
            end = hi if cut < 0 else cut + len(sep)
            out.extend(pieces(start, end, lvl + 1) if end - start > size else [(start, end)])
            start = end
        return out

    spans = pieces(0, len(text), 0)
    chunks: list[tuple[int, int]] = []
    i = 0
    while i < len(spans):
        start, end = spans[i]
        j = i + 1
        while j < len(spans) and spans[j][1] - start <= size:
            end = spans[j][1]
            j += 1
        chunks.append((start, end))
        if j >= len(spans):
            break
        # Next chunk starts at the earliest piece that keeps the overlap within bounds.
        k = j
        while k - 1 > i and end - spans[k - 1][0] <= overlap and spans[j][1] - spans[k - 1][0] <= size:
            k -= 1
        i = k
    return chunks


def chunk_recursive(df: DataFrame, id_col: str, text_col: str, size: int = CHUNK_SIZE,
                    overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """H19 (separator-aware variant) as an Arrow job over whole texts, in runs of documents of about PIECE bytes."""

    def pieces(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n = pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        cuts = [0, *(np.nonzero(np.diff((np.cumsum(n) - n) // PIECE))[0] + 1).tolist(), len(b)]
        return (b.slice(lo, hi - lo) for lo, hi in zip(cuts[:-1], cuts[1:]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (p for batch in batches for p in pieces(batch)):
            ids, nos, starts, chunks = [], [], [], []
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not text:
                    continue
                for j, (lo, hi) in enumerate(split_spans(text, size, overlap)):
                    ids.append(key)
                    nos.append(j)
                    starts.append(lo)
                    chunks.append(text[lo:hi])
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(nos, pa.int32()), pa.array(starts, pa.int64()), pa.array(chunks, pa.string())],
                                  names=[id_col, "chunk_no", "start_index", "chunk"])

    schema = f"{id_col} bigint, chunk_no int, start_index bigint, chunk string"
    return df.select(F.col(id_col).cast("bigint").alias(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)


def chunk_report(df: DataFrame, chunks: DataFrame, id_col: str, text_col: str, size: int = CHUNK_SIZE) -> DataFrame:
    """H19 invariants per document: chunks follow each other without a gap from
    the first character to the last, each equals the text at its place, and
    none is longer than ``size``."""
    c = chunks.select(F.col(id_col).alias("_id"), "chunk_no", "start_index", "chunk")
    j = df.where(F.length(text_col) > 0).join(c, F.col(id_col) == F.col("_id"))
    j = j.withColumn("_end", F.col("start_index") + F.length("chunk"))
    at = F.struct("chunk_no", "start_index", F.col("_end").alias("end"))
    per = j.groupBy(id_col).agg(
        F.max(F.length(text_col)).alias("n_chars"), F.max(F.length("chunk")).alias("_longest"),
        F.bool_and(F.substr(F.col(text_col), (F.col("start_index") + 1).cast("int"), F.length("chunk")) == F.col("chunk")).alias("same_text"),
        F.array_sort(F.collect_list(at)).alias("_at"))  # bounded by the length of one document
    steps = F.transform(F.sequence(F.lit(1), F.size("_at") - 1), lambda i: F.col("_at")[i]["start_index"] <= F.col("_at")[i - 1]["end"])
    gapless = F.when(F.size("_at") == 1, F.lit(True)).otherwise(F.forall(steps, lambda x: x))
    covered = gapless & (F.col("_at")[0]["start_index"] == 0) & (F.element_at("_at", -1)["end"] == F.col("n_chars"))
    return per.select(id_col, "n_chars", covered.alias("covered"), (F.col("_longest") <= size).alias("in_size"), "same_text")


def _without_dots(path: Column) -> Column:
    """An absolute path with its ``.`` and ``..`` segments resolved."""
    parts = F.split(F.substr(path, F.lit(2)), "/", -1)

    def step(acc: Column, s: Column) -> Column:
        return F.when(s == ".", acc).when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.array_append(acc, s))

    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    last = F.element_at(parts, -1)
    kept = F.when(last.isin(".", ".."), F.array_append(kept, F.lit(""))).otherwise(kept)
    return F.concat(F.lit("/"), F.array_join(kept, "/"))


def link_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html", base_prefix: str | None = None) -> DataFrame:
    """(src, dst) links of every page: empty, '#', mailto: and javascript:
    links dropped; resolved against the page URL (absolute, ``//host``,
    ``/path``, ``?query`` and relative ones, with ``.`` and ``..``); fragment
    cut; distinct. B15: only links that start with ``base_prefix`` are kept,
    or, without one, links on the page's own origin."""
    page = F.regexp_replace(F.col(url_col), "#.*$", "")
    bare = F.regexp_replace(page, r"[?].*$", "")
    origin = F.regexp_extract(page, ORIGIN_PATTERN, 1)
    path = F.substr(bare, F.length(origin) + 1)
    hrefs = pages.select(
        page.alias("src"), origin.alias("origin"), bare.alias("bare"),
        F.regexp_extract(page, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1).alias("scheme"),
        F.when(path == "", F.lit("/")).otherwise(F.regexp_extract(path, "^(.*/)", 1)).alias("dir"),
        F.explode(F.transform(F.regexp_extract_all(F.col(html_col), F.lit(LINK_PATTERN), F.lit(1)), lambda x: F.regexp_replace(x, "^[\"']|[\"']$", "")))
        .alias("href"))
    h = F.trim(F.col("href"))
    keep = (h != "") & ~h.startswith("#") & ~F.lower(h).startswith(LINK_SKIP_PREFIXES[0]) & \
        ~F.lower(h).startswith(LINK_SKIP_PREFIXES[1])
    rows = hrefs.where(keep).select("src", "origin", "bare", "scheme", "dir", F.regexp_replace(h, "#.*$", "").alias("h"))
    h = F.col("h")
    to_path = F.regexp_replace(h, r"[?].*$", "")
    query = F.substr(h, F.length(to_path) + 1)
    whole = F.when(h.startswith("/"), to_path).otherwise(F.concat(F.col("dir"), to_path))
    dst = (F.when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), h)
           .when(h.startswith("//"), F.concat(F.col("scheme"), F.lit(":"), h))
           .when(h.startswith("?"), F.concat(F.col("bare"), h))
           .otherwise(F.concat(F.col("origin"), _without_dots(whole), query)))
    edges = rows.select("src", "origin", dst.alias("dst"))
    if base_prefix is not None:
        scope = F.col("dst").startswith(base_prefix)
    else:
        scope = F.regexp_extract(F.col("dst"), ORIGIN_PATTERN, 1) == F.col("origin")
    return edges.where(scope).select("src", "dst").distinct()


def link_list(edges: DataFrame) -> DataFrame:
    """the distinct linked URLs, sorted."""
    return edges.select(F.col("dst").alias("url")).distinct().orderBy("url")


def letter_vector(col: Column) -> Column:
    """A deterministic vector of a text: how often each of sixteen letters
    occurs in it, and a constant, so no vector is zero. It stands in for the
    embedding model, which is outside this library."""
    low = F.lower(col)
    counts = [(F.length(low) - F.length(F.replace(low, F.lit(c), F.lit("")))).cast("float") for c in VECTOR_LETTERS]
    return F.array(*counts, F.lit(1.0).cast("float"))
