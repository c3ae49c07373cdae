"""Line dedup by winnowing over line hashes.

The lines that hold a word form a document's sequence. Of every window of
``run`` neighbouring line hashes the smallest (the rightmost of equals) is a
fingerprint, so every run of ``run`` lines that two places share has a
fingerprint in both. Positions are joined on fingerprints found twice or more,
and every run of ``run`` lines around such a position is compared: runs that
overlap make longer matches, both ways.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import columns, let, materialise, prefix

#: Lines of the shortest run that counts as repeated.
RUN = 2
#: Words from which a single line counts as a run.
LONG_LINE = 20

SEED = 9


def line_hashes(text: str, long_line: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, hash, is long) of the lines of ``text`` that hold a word; spaces at their ends don't count."""
    at, hashes, long = [], [], []
    for i, line in enumerate(text.encode("utf-8", "surrogatepass").split(b"\n")):
        if line := line.strip():
            at.append(i)
            hashes.append(xxhash.xxh64_intdigest(line, SEED))
            long.append(len(line.split(None, long_line - 1)) >= long_line)
    return np.array(at, np.int64), np.array(hashes, np.uint64), np.array(long, bool)


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Indices of the smallest hash of each window, the rightmost of equals."""
    if len(hashes) < window:
        return np.empty(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(hashes, window)
    return np.unique(np.arange(len(views)) + window - 1 - views[:, ::-1].argmin(axis=1))


def _fingerprints(docs: DataFrame, run: int, long_line: int) -> DataFrame:
    """(id, th, fp, at, around): each fingerprint with the ``run`` - 1 sequence lines at either side.

    ``around`` lists (line position, line hash), ``at`` is the fingerprint's
    place in it. A long line is a fingerprint of its own (at = -1).
    """
    schema = "id long, th long, fp long, at int, around array<struct<line:long,h:long>>"

    def of(i: int, th: int, text: str) -> Iterator[tuple]:
        line, h, long = line_hashes(text, long_line)
        signed = h.view(np.int64)
        pairs = [{"line": a, "h": b} for a, b in zip(line.tolist(), signed.tolist(), strict=True)]
        for k in winnow(h, run).tolist():
            low = max(0, k - run + 1)
            yield i, th, pairs[k]["h"], k - low, pairs[low:k + run]
        for k in np.nonzero(long)[0].tolist():
            yield i, th, pairs[k]["h"] ^ 1, -1, pairs[k:k + 1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.struct([("line", pa.int64()), ("h", pa.int64())]))]
        names = ["id", "th", "fp", "at", "around"]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

        for batch in batches:
            rows: list[tuple] = []
            for i, th, text in zip(*batch.columns, strict=True):
                rows += of(i.as_py(), th.as_py(), text.as_py())
                if len(rows) > 50_000:
                    yield out(rows)
                    rows = []
            if rows:
                yield out(rows)

    return docs.filter("text is not null").mapInArrow(work, schema)


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN,
                   long_line: int = LONG_LINE) -> DataFrame:
    """(id, th, lines): the line positions to delete, sorted, for every document that has any.

    ``th`` is xxhash64 of the text. A line goes if it lies in a run of ``run``
    neighbouring lines, or is a line of ``long_line`` words or more, that also
    occurs earlier: in a document with a smaller (id, th), null ids last, or
    further up in the same one. Lines without a word are skipped when runs are
    formed, and never deleted.
    """
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("th"),
                        F.col(text_col).cast("string").alias("text"))
    fps = materialise(_fingerprints(named, run, long_line), "line_fingerprints")
    often = materialise(fps.groupBy("fp").agg(F.count("*").alias("n")).filter("n > 1").select("fp"), "line_repeats")
    shared = fps.join(often, "fp")
    windows = F.transform(F.sequence(F.lit(0), F.size("around") - run), lambda s: F.slice("around", s + 1, run))
    runs = (shared.withColumn("w", F.explode(F.when(F.col("at") < 0, F.array("around")).when(F.size("around") >= run, windows)))
            .select("id", "th", F.xxhash64(F.transform("w", lambda x: x["h"])).alias("key"), F.transform("w", lambda x: x["line"]).alias("lines"),
                    F.struct(F.col("id").isNull().alias("no_id"), "id", "th", F.col("w")[0]["line"].alias("line")).alias("place")))
    runs = materialise(runs, "line_runs")
    first = materialise(runs.groupBy("key").agg(F.min("place").alias("first"), F.max("place").alias("last"))
                        .filter("first <> last").select("key", "first"), "first_runs")
    later = runs.join(first, "key").filter("place > first")
    return (later.select("id", "th", F.explode("lines").alias("line")).distinct()
            .groupBy("id", "th").agg(F.sort_array(F.collect_list("line")).alias("lines")))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN, long_line: int = LONG_LINE) -> DataFrame:
    """``docs`` with later repeated runs of lines deleted from the text; every row and column stays.

    See :func:`repeated_lines` for what is repeated. A null text stays null, a
    text whose every line goes becomes empty. Rows that repeat an id and a text
    are one document and lose the same lines. An empty table stays empty.
    Other columns pass, whatever their names.
    """
    p = prefix(docs)
    gone = materialise(repeated_lines(docs, id_col, text_col, run, long_line), "deleted_lines")
    gone = gone.select(*[F.col(c).alias(p + c) for c in gone.columns])
    text = docs[text_col]
    same = [docs[id_col].cast("long").eqNullSafe(F.col(p + "id")), F.xxhash64(text.cast("string")) == F.col(p + "th")]
    joined = docs.join(gone.hint("merge"), same, "left")  # the deletions grow with the documents: one plan at every size
    first = F.lit(-1).cast("long")
    kept = let(F.split(text, "\n", -1), lambda lines: let(
        F.concat(F.array(first), F.col(p + "lines"), F.array(F.size(lines).cast("long"))),
        lambda cut: F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(cut) - 2), lambda i: F.slice(
            lines, (cut[i] + 2).cast("int"), (cut[i + 1] - cut[i] - 1).cast("int")))), "\n")))
    new = F.when(F.col(p + "lines").isNull(), text).otherwise(kept)
    return joined.select(*[new.alias(name) if name == text_col else c for name, c in zip(docs.columns, columns(docs), strict=True)])
