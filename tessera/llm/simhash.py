"""SimHash near-duplicates, found by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments. Of at most two differing bits
one segment has none, and the segment after it at most two. The Golay code
(23,12,7) is perfect: every 23-bit word lies within distance 3 of exactly one
codeword. A word's keys are the codewords of itself and of its 23 neighbours
(one or six different ones); two words at distance 2 or less have a common
neighbour, so a common key. The join key is therefore (segment, its exact bits,
codeword index of the next segment), and candidates are verified bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import columns, materialise, prefix
from tessera.llm.components import components

SEED = 42
#: Bit widths of the three segments, lowest bits first.
SEGMENTS = (22, 21, 21)
#: Largest bucket that is compared pair by pair; fingerprints of larger ones meet by their common neighbours.
BUCKET = 64
#: Shingles whose bits are counted at once.
BLOCK = 1 << 16

# Generator polynomial of the binary Golay code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GOLAY = 0xAE3


def _syndromes() -> tuple[np.ndarray, np.ndarray]:
    """(syndrome of each single bit, error pattern of each syndrome)."""
    bit = np.zeros(23, np.int64)
    for i in range(23):
        v = 1 << i
        for j in range(i, 10, -1):
            if v >> j & 1:
                v ^= GOLAY << (j - 11)
        bit[i] = v
    error = np.zeros(1 << 11, np.int64)
    for weight in (1, 2, 3):
        for places in combinations(range(23), weight):
            error[np.bitwise_xor.reduce(bit[list(places)])] = sum(1 << p for p in places)
    return bit, error


def golay_keys(words: np.ndarray) -> np.ndarray:
    """(n, 24) codeword indices of each 23-bit word and its neighbours, sorted; repeats of a row are -1."""
    bit, error = _syndromes()
    words = words.astype(np.int64)
    syndrome = np.zeros_like(words)
    for i in range(23):
        syndrome ^= np.where(words >> i & 1, bit[i], 0)
    flips = np.concatenate([[0], 1 << np.arange(23)])
    near = words[:, None] ^ flips
    index = np.sort((near ^ error[syndrome[:, None] ^ np.concatenate([[0], bit])]) >> 11, axis=1)
    index[:, 1:][index[:, 1:] == index[:, :-1]] = -1
    return index


def fingerprint(text: str | None, shingle: int) -> int:
    """SimHash of the lower-cased (A-Z) word shingles, as an unsigned 64-bit number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII only, for both
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - shingle + 1]
    ends = ends[shingle - 1:] - 1
    total = np.zeros(64, np.int64)
    for at in range(0, len(starts), BLOCK):
        spans = zip(starts[at:at + BLOCK].tolist(), ends[at:at + BLOCK].tolist(), strict=True)
        h = np.array([xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in spans], "<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, th, fp): xxhash64 of the text and its fingerprint as a signed long, for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(fp, pa.int64())], ["id", "th", "fp"])

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    return rows.mapInArrow(run, "id long, th long, fp long")


def _fuzzy_keys(fps: DataFrame) -> DataFrame:
    """(key, fp): the join keys of each fingerprint, 16 on average."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            parts, at = [], 0
            for width in SEGMENTS:
                parts.append((fp >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64))
                at += width
            for i, part in enumerate(parts):
                index = golay_keys(parts[(i + 1) % 3])
                row, col = np.nonzero(index >= 0)
                key = np.int64(i) << 60 | part[row] << 12 | index[row, col]
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[row].view(np.int64))], ["key", "fp"])

    return fps.select("fp").mapInArrow(run, "key long, fp long")


def links(fps: DataFrame, max_distance: int = 2) -> DataFrame:
    """Edges (a, b) that connect exactly the distinct ``fps`` within ``max_distance`` bits of each other.

    A bucket of up to ``BUCKET`` fingerprints is compared pair by pair. The
    fingerprints of larger buckets (many near copies) are looked up by every
    word at distance 1 or less of them: who shares one is within 2 bits, a
    group has at most 65 members, and a star of verified edges connects it.
    """
    keys = _fuzzy_keys(fps)
    sizes = materialise(keys.groupBy("key").count().filter("count > 1"), "buckets")
    shared = materialise(keys.join(sizes, "key"), "candidates")
    pairs = (shared.filter(F.col("count") <= BUCKET).groupBy("key").agg(F.sort_array(F.collect_list("fp")).alias("l"))
             .select(F.explode("l").alias("a"), "l")
             .select("a", F.explode(F.filter("l", lambda b: (b > F.col("a")) & (F.bit_count(b.bitwiseXOR(F.col("a"))) <= max_distance))).alias("b")))
    near = F.concat(F.array(F.lit(0).cast("long")), F.array(*[F.lit(1 << i if i < 63 else -1 << 63).cast("long") for i in range(64)]))
    middle = (shared.filter(F.col("count") > BUCKET).select("fp").distinct()
              .select("fp", F.explode(near).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("middle")))
    if max_distance == 2:
        stars = middle.groupBy("middle").agg(F.sort_array(F.collect_list("fp")).alias("l"))
        stars = stars.select(F.col("l")[0].alias("a"), F.explode("l").alias("b")).filter("a <> b")
    else:  # the middle itself is one of the two
        stars = middle.select(F.col("middle").alias("a"), F.col("fp").alias("b")).filter("a <> b").join(
            fps.select(F.col("fp").alias("a")), "a", "left_semi").select("a", "b")
    return pairs.unionByName(stars.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance)).distinct()


def simhash_near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                       max_distance: int = 2) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hex digits) and component_id.

    Two rows are linked when their fingerprints differ in ``max_distance`` bits
    (0, 1 or 2) or fewer; component_id is the smallest id reachable over links,
    the row's own included. Equal fingerprints are linked without pairs.

    A null text counts as empty; texts without a word have fingerprint zero and
    are linked like any other. A null id is never the smallest; a component
    without any id has component_id null. Repeated rows are each returned, in
    one component. Other columns of ``docs`` are not read; an empty table gives
    an empty one.
    """
    found = _grouped(docs, id_col, text_col, shingle, max_distance)
    return found.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_distance: int) -> DataFrame:
    if max_distance not in (0, 1, 2) or shingle < 1:
        raise ValueError("max_distance must be 0, 1 or 2 and shingle at least 1")
    rows = materialise(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    per_fp = materialise(rows.groupBy("fp").agg(F.min("id").alias("least_id")), "distinct_fingerprints")
    if max_distance:
        roots = components(links(per_fp, max_distance))
        rooted = per_fp.join(roots, per_fp.fp == roots.node, "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
        rooted = materialise(rooted, "rooted")
        least = materialise(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")), "components")
        per_fp = materialise(rooted.join(least, "root").select("fp", "component_id"), "component_of")
    else:
        per_fp = per_fp.withColumnRenamed("least_id", "component_id")
    return rows.join(per_fp, "fp")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """``docs`` with one document of each component of :func:`simhash_near_dedup`: the one with the smallest id.

    Rows that repeat its id are reduced to one, the one with the smallest hash
    of all columns. Rows without an id go if their component has an id, and all
    stay otherwise.
    """
    found = _grouped(docs, id_col, text_col, shingle, max_distance)
    p = prefix(docs)
    kept = found.filter(F.col("id").eqNullSafe(F.col("component_id"))).select(F.col("id").alias(p + "id"), F.col("th").alias(p + "th")).distinct()
    left = docs.join(kept.hint("merge"), [docs[id_col].cast("long").eqNullSafe(kept[p + "id"]), F.xxhash64(docs[text_col].cast("string")) == kept[p + "th"]], "left_semi")
    row = F.struct(*columns(docs))
    one = (left.groupBy(docs[id_col].alias(p + "id"), F.when(docs[id_col].isNull(), F.monotonically_increasing_id()).alias("n"))
           .agg(F.min_by(row, F.xxhash64(row)).alias("row")))
    return one.select("row.*")
