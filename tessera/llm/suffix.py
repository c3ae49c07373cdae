"""Repeated passages by a sparse suffix array.

Only suffixes that start at minimisers are kept: positions whose k-gram of
words has the smallest hash in half a passage. The choice depends on the words
alone, so wherever ``min_words`` words repeat, both places keep a suffix at the
same word of their first half. The suffixes are sorted by the half passage that
they begin with (the block), then by what stands around it, and each is
compared with its neighbour. Where the words as far as a passage can reach to
either side agree too, all passages around the suffix repeat. Where only the
block agrees, the match is extended left and right as far as a passage needs:
every run of ``min_words`` words around the block is compared with those of
the other suffixes that differ from their neighbour.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import columns, materialise, prefix, scratch_table

#: Words of the shortest passage that counts as repeated.
MIN_WORDS = 50
#: Words of the k-grams that minimisers are chosen by.
GRAM = 5
SEED = 23
#: Words whose hashes a task remembers.
HELD = 1 << 19
DOC = ["id", "th"]
#: The order of suffixes: block, surroundings, place.
ORDER = ["key", "around", "no_id", "id", "th", "at"]


class _Hashes(dict):
    """The hash of each word, computed once while it is at hand."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= HELD:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return value


_HASHES = _Hashes()


def word_hashes(text: str | bytes) -> np.ndarray:
    words = (text if isinstance(text, bytes) else text.encode("utf-8", "surrogatepass")).split()  # bytes: at ASCII white space
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


@cache
def _factors(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def _rolled(hashes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """A hash of the ``n`` words from each position in ``at``."""
    odd = _factors(SEED, n)
    total = reduce(lambda acc, j: acc + hashes[at + j] * odd[j], range(n), np.zeros(len(at), np.uint64))
    total = (total ^ total >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)
    return total ^ total >> np.uint64(29)


def suffixes(hashes: np.ndarray, block: int, gram: int = GRAM) -> np.ndarray:
    """Positions of the suffixes kept of a document: the minimisers that a block fits behind."""
    window = block - gram + 1
    if len(hashes) < block:
        return np.empty(0, np.int64)
    grams = _rolled(hashes, np.arange(len(hashes) - gram + 1), gram)
    views = np.lib.stride_tricks.sliding_window_view(grams, window)
    at = np.unique(np.concatenate([i + window - 1 - views[i:i + 65536, ::-1].argmin(axis=1) + np.arange(len(views[i:i + 65536]))
                                   for i in range(0, len(views), 65536)]))
    return at[at + block <= len(hashes)]


def surroundings(hashes: np.ndarray, at: np.ndarray, block: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many words a passage around each suffix can reach before it and behind its block, and a hash of these words."""
    left, right = np.minimum(at, block - gram), np.minimum(len(hashes) - at - block, block)
    padded = np.concatenate([np.zeros(block, np.uint64), hashes, np.zeros(block, np.uint64)])
    at = at + block
    total = np.zeros(len(at), np.uint64)
    odd = _factors(SEED + 1, 2 * block + 2)
    for j in range(block):
        total += np.where(j < left, padded[at - 1 - j], np.uint64(0)) * odd[j]
        total += np.where(j < right, padded[np.minimum(at + block + j, len(padded) - 1)], np.uint64(0)) * odd[block + j]
    total += left.astype(np.uint64) * odd[-2] + right.astype(np.uint64) * odd[-1]
    total = (total ^ total >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)
    return left, right, total ^ total >> np.uint64(29)


def passages_around(hashes: np.ndarray, asked: np.ndarray, size: int, gram: int = GRAM) -> np.ndarray:
    """Starts of the runs of ``size`` words whose first half has its minimiser at one of the positions ``asked``."""
    window, last = size // 2 - gram + 1, len(hashes) - size
    if last < 0:
        return np.empty(0, np.int64)
    out = [np.empty(0, np.int64)]
    for i in range(0, len(asked), 4096):
        at = asked[i:i + 4096, None]
        near = np.clip(at + np.arange(1 - window, window), 0, len(hashes) - gram)
        grams = _rolled(hashes, near.ravel(), gram).reshape(near.shape)
        views = np.lib.stride_tricks.sliding_window_view(grams, window, axis=1)
        start = at + np.arange(1 - window, 1)
        chosen = start + window - 1 - views[:, :, ::-1].argmin(axis=2) == at
        out.append(start[chosen & (start >= 0) & (start <= last)])
    return np.unique(np.concatenate(out))


def _suffix_table(named: DataFrame, block: int) -> DataFrame:
    """(no_id, id, th, at, key, around, left, right): the suffixes kept of each document."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            none, ids, ths, parts = batch["no_id"].to_numpy(zero_copy_only=False), batch["id"].to_numpy(), batch["th"].to_numpy(), []
            for text in batch["text"].cast(pa.binary()):
                hashes = word_hashes(text.as_py())
                at = suffixes(hashes, block)
                parts.append((at, _rolled(hashes, at, block), *surroundings(hashes, at, block)))
            n = [len(p[0]) for p in parts]
            at, key, left, right, around = (np.concatenate(x) for x in zip(*parts)) if parts else [np.empty(0, np.uint64)] * 5
            yield pa.record_batch({"no_id": pa.array(np.repeat(none, n)), "id": pa.array(np.repeat(ids, n)), "th": pa.array(np.repeat(ths, n)),
                                   "at": pa.array(at.astype(np.int64)), "key": pa.array(key.view(np.int64)), "around": pa.array(around.view(np.int64)),
                                   "left": pa.array(left.astype(np.int32)), "right": pa.array(right.astype(np.int32))})

    return named.mapInArrow(work, "no_id boolean, id long, th long, at long, key long, around long, left int, right int")


_COMPARED = "no_id boolean, id long, th long, at long, same boolean, left int, right int, s_none boolean, s_id long"


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes in order → those whose block a neighbour has.

    ``same``: the suffix before it, at an earlier place (s_id), has the same
    surroundings too. Equal rows are one. The first and the last row of a
    partition, whose neighbours are elsewhere, are kept as if they had one.
    """
    names = [*ORDER, "left", "right"]
    before: dict | None = None  # the row before, and whether it was given out
    waiting: list | None = None  # the last row, which waits for the next one

    def out(c: dict, keep: np.ndarray, same: np.ndarray, s: np.ndarray, s_none: np.ndarray) -> pa.RecordBatch:
        at = np.nonzero(keep)[0]
        return pa.record_batch({**{k: pa.array(c[k][at]) for k in ("no_id", "id", "th", "at")}, "same": pa.array(same[at]),
                                "left": pa.array(c["left"][at]), "right": pa.array(c["right"][at]), "s_none": pa.array(s_none[at]), "s_id": pa.array(s[at])})

    for batch in batches:
        c = {k: batch[k].to_numpy(zero_copy_only=False) for k in names}
        if waiting is not None:
            c = {k: np.concatenate([[waiting[i]], c[k]]) for i, k in enumerate(names)}
        n = len(c["key"])
        if not n:
            continue
        prev = {k: np.concatenate([[v[0] if before is None else before[k]], v[:-1]]) for k, v in c.items()}
        known = np.ones(n, bool)
        known[0] = before is not None
        equal = np.logical_and.reduce([c[k] == prev[k] for k in ORDER]) & known
        alike = (c["key"] == prev["key"]) & known
        same = alike & (c["around"] == prev["around"]) & ~equal
        follows = np.append(alike[1:] & ~equal[1:], False)
        keep = (alike | follows | ~known) & ~equal
        waiting = [c[k][-1] for k in names]
        # the last row is judged with the next batch; the one before it is what it is compared with then
        if n > 1:
            yield out({k: v[:-1] for k, v in c.items()}, keep[:-1], same[:-1], prev["id"][:-1], prev["no_id"][:-1])
            before = {k: c[k][-2] for k in names}
    if waiting is not None:
        c = {k: np.array([waiting[i]]) for i, k in enumerate(names)}
        prev = before if before is not None else {k: v[0] for k, v in c.items()}
        equal = before is not None and all(c[k][0] == prev[k] for k in ORDER)
        same = before is not None and not equal and c["key"][0] == prev["key"] and c["around"][0] == prev["around"]
        yield out(c, np.array([not equal]), np.array([same]), np.array([prev["id"]]), np.array([prev["no_id"]]))


def _passages(named: DataFrame, asked: DataFrame, size: int) -> DataFrame:
    """(no_id, id, th, at, keys): the hashes of the runs of ``size`` words around the suffixes asked for, those that follow each other as one row."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, begin, keys = [], [], []
            for k, (text, wanted) in enumerate(zip(batch["text"].cast(pa.binary()), batch["wanted"])):
                hashes = word_hashes(text.as_py())
                starts = passages_around(hashes, np.array(wanted.as_py(), np.int64), size)
                if len(starts):
                    cuts = np.nonzero(np.diff(starts) != 1)[0] + 1
                    runs = np.split(_rolled(hashes, starts, size).view(np.int64), cuts)
                    of += [k] * len(runs)
                    begin += starts[np.concatenate([[0], cuts])].tolist()
                    keys += runs
            rows = batch.take(pa.array(of, pa.int64()))
            yield pa.record_batch([rows["no_id"], rows["id"], rows["th"], pa.array(begin, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                                  names=["no_id", "id", "th", "at", "keys"])

    lists = asked.groupBy("no_id", *DOC).agg(F.sort_array(F.collect_set("at")).alias("wanted"))
    found = named.join(lists.hint("merge"), ["no_id", *DOC])  # rows that repeat an id and a text ask twice
    return found.select("no_id", *DOC, "text", "wanted").mapInArrow(work, "no_id boolean, id long, th long, at long, keys array<long>")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(id, th, start_word, end_word, n_words, source_ids): the passages of ``min_words`` words or more that repeat earlier text.

    Earlier: in a document with a smaller (id, xxhash64 of the text), null ids
    last, or further up in the same one. Words are runs of characters other
    than ASCII white space; positions count words, the end excluded. Exactly
    the words are reported that lie in a run of ``min_words`` words which also
    stands earlier; runs that touch or overlap make one passage, and
    ``source_ids`` lists documents they stand in. Every word reported also
    stands earlier, so deleting all passages never deletes a first occurrence.

    Null and empty texts have no passage. Rows that repeat an id and a text are
    one document. Other columns are not read; an empty table gives an empty one.
    """
    block = min_words // 2
    if block <= GRAM:
        raise ValueError(f"min_words must be at least {2 * GRAM + 2}")
    text = docs[f"`{text_col}`"].cast("string")
    key = docs[f"`{id_col}`"].cast("long")
    named = docs.select(key.isNull().alias("no_id"), F.coalesce(key, F.lit(0)).alias("id"), F.xxhash64(text).alias("th"), text.alias("text")).filter("text is not null")
    table = scratch_table(_suffix_table(named, block), "sampled")  # read twice: for the ranges' bounds, and to sort
    sorted_suffixes = table.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    near = scratch_table(sorted_suffixes.mapInArrow(_compared, _COMPARED), "suffixes")
    source = lambda none, i: F.when(~F.col(none), F.col(i))
    whole = near.filter("same").select("no_id", *DOC, source("s_none", "s_id").alias("f_id"), (F.col("at") - F.col("left")).alias("start"),
                                       (F.col("at") + block + F.col("right")).alias("end")).filter(F.col("end") - F.col("start") >= min_words)
    runs = scratch_table(_passages(named, near.filter("not same"), min_words), "passages")
    place = F.struct("no_id", "id", "th", "at")
    each = runs.select("no_id", *DOC, F.posexplode("keys").alias("k", "key"), F.col("at").alias("from")).select("no_id", *DOC, (F.col("from") + F.col("k")).alias("at"), "key")
    first = each.groupBy("key").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first <> last").select("key", "first")
    first = scratch_table(first, "first_passages")
    again = each.join(first, "key").filter(place > F.col("first"))
    again = again.select("no_id", *DOC, source("first.no_id", "first.id").alias("f_id"), F.col("at").alias("start"), (F.col("at") + min_words).alias("end"))
    order = Window.partitionBy("no_id", *DOC).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = whole.unionByName(again)
    spans = spans.withColumn("begins", F.coalesce(F.col("start") > reach, F.lit(True)).cast("int")).withColumn("span", F.sum("begins").over(order))
    spans = spans.groupBy("no_id", *DOC, "span").agg(F.min("start").alias("start_word"), F.max("end").alias("end_word"),
                                                     F.array_sort(F.collect_set("f_id")).alias("source_ids"))
    return spans.select(source("no_id", "id").alias(id_col), "th", "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"), "source_ids")


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the :func:`repeated_passages` cut out of the text, each with the white space after it.

    Every row and column stays; a null text stays null, and a text that
    repeats earlier ones throughout becomes empty.
    """
    p = prefix(docs)
    cuts = repeated_passages(docs, id_col, text_col, min_words).groupBy(F.col(id_col).alias(p + "id"), F.col("th").alias(p + "th")).agg(
        F.sort_array(F.collect_list(F.struct("start_word", "end_word"))).alias(p + "cuts"))
    cuts = materialise(cuts, "cuts")
    text = docs[text_col]

    @F.pandas_udf("string")
    def cut(texts, spans):
        import re

        def one(t, s):
            if t is None or s is None or not len(s):
                return t
            words = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", t)] + [(len(t), len(t))]
            out, at = [], 0
            for x in s:
                out.append(t[at:words[x["start_word"]][0]])
                at = words[x["end_word"]][0]
            return "".join(out) + t[at:]

        return texts.combine(spans, one)

    joined = docs.join(cuts.hint("merge"), [docs[id_col].cast("long").eqNullSafe(F.col(p + "id")), F.xxhash64(text.cast("string")) == F.col(p + "th")], "left")
    new = F.when(F.col(p + "cuts").isNull(), text).otherwise(cut(text, F.col(p + "cuts")))
    return joined.select(*[new.alias(n) if n == text_col else c for n, c in zip(docs.columns, columns(docs), strict=True)])
