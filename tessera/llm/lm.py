"""LM scoring by a hierarchical Pitman-Yor model.

One restaurant per context (the word before; the end of the text before stands
before a text's first word) and one for all words, the parent that the contexts
share; above it every word is equally likely. The customers of a restaurant are the words read
in its context; each of its tables is a customer of the parent.

All customers of a word, in every context and in the parent, are one row, so
Gibbs sampling needs only that row and the totals of tables of its contexts,
which are summed after every round and joined with the rows that ask for them.
Words read once in a context sit at one table and ask for nothing. The customers of a word in a
context leave together and are seated anew: of up to BIG customers only the
number of tables matters, and it is drawn from its distribution given all
other seats; of more, single customers drawn at random leave and sit down
again, table sizes kept. Then the parent's tables follow in the same way.
Samples of the seating are averaged in the predictive probabilities.

Words are dealt out by runs of their ids (buckets), of which there are more as
there are more blocks of documents, and packed by bucket: one shuffle for the
counts, two small ones a round for the totals, one, a share of the buckets at
a time, in which each block asks the words for what it holds, one that brings
the answers to the block. No step holds more than a block of documents or the
words of one bucket with their contexts, and only single numbers reach the
driver. A given number of ``contexts``, which the word before is hashed to,
keeps all totals in each task instead; its words are streamed in sorted order.
"""

from __future__ import annotations

import math
import random
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import drop_scratch
from tessera.llm.common import scratch_table as written

#: Every word is a context of its own. A number (at most 65,535): contexts that the word before is hashed to; one more is the start of a text.
CONTEXTS = None
#: Rounds of Gibbs sampling after the first seating, each of them a sample.
SAMPLES = 2
SEED = 42
#: Strength of every restaurant; the discounts follow from the counts.
STRENGTH = 1.0
#: Customers of a word in a context, and in the parent, up to which the number of tables is drawn at once.
BIG, BIG_PARENT = 64, 128
#: Cells of one word that are drawn one after another; the rest, which hardly change the parent's share of so frequent a word, together.
STEPS = 32
#: Cells that a task draws together, as far as whole words allow.
CELLS_AT_ONCE = 1 << 18
#: Tokens after which a task closes a block of documents, and the documents a block holds at most.
BLOCK, BLOCK_DOCS = 1 << 21, 1 << 16
#: Places that a task sums up by document before it hands them on.
PLACES = 1 << 21
END = b""

#: Bytes of text that a task takes apart at once; a longer document is one piece.
PIECE = 1 << 24

BLOCKS = ("w binary, block long, n_train long, ctxs binary, learned binary, places binary, key string, doc int, n_tokens long, held boolean")
CELLS = "w binary, c long, ctx binary, n binary"
STATE = "w binary, c long, ctx binary, n binary, t binary, sizes binary, root binary, t_sum binary, roots binary"


def _packed(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary array whose i-th value holds the next ``counts[i]`` of ``values``."""
    ends = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=ends[1:])
    offsets = (ends * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())])


def _flat(column: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary array in one, and how many each has."""
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return np.frombuffer(raw.tobytes(), dtype), np.diff(offsets) // np.dtype(dtype).itemsize


def _squeezed(values: np.ndarray) -> bytes:
    """Numbers by their first bytes, their second bytes and so on, compressed, after the number of bytes."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _loosened(data: bytes, dtype) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    raw = pa.decompress(data[8:], size, "zstd", asbytes=True) if size else b""
    return np.frombuffer(raw, np.uint8).reshape(np.dtype(dtype).itemsize, -1).T.copy().view(dtype).ravel()


def _kind(contexts: int | None) -> type:
    """Contexts are numbered, or they are the 64-bit ids of words."""
    return np.uint64 if contexts is None else np.uint16


def _ids(words: pa.Array) -> np.ndarray:
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False), categorize=False)


def _layout(cells: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where rows of so many contexts and places hold, in bytes, their counts and the low and high bytes of their steps."""
    begin = np.cumsum(cells + 2 * places) - (cells + 2 * places)
    count = np.arange(int(cells.sum())) + np.repeat(begin - (np.cumsum(cells) - cells), cells)
    low = np.arange(int(places.sum())) + np.repeat(begin + cells - (np.cumsum(places) - places), places)
    return count, low, low + np.repeat(places, places)


def _unstepped(steps: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Each next ``counts[i]`` values, given as the first one and the steps from it."""
    total = np.cumsum(steps, dtype=np.int64)
    first = np.cumsum(counts) - counts
    return total - np.repeat(np.concatenate([[0], total])[first], counts)


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of documents of about PIECE bytes."""
    size = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    piece = (np.cumsum(size) - size) // PIECE
    cuts = [0, *(np.nonzero(np.diff(piece))[0] + 1).tolist(), len(batch)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def _coded(text: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The words of texts as codes, the words that the codes stand for, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(text, "")))  # only A-Z change, ASCII white space parts
    flat, ends = lists.flatten(), np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
    there = pc.not_equal(pc.binary_length(flat), 0)
    before = np.concatenate([[0], np.cumsum(there.to_numpy(zero_copy_only=False))])
    coded = flat.filter(there).dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.cast(pa.binary()), np.diff(before[ends])


class _Block:
    """Documents whose words are numbered together."""

    def __init__(self) -> None:
        self.words = [pa.array([END], pa.binary())]  # by run of documents; a word of several runs gets one number in the end
        self.size, self.n_words, self.keys, self.held, self.lengths, self.tokens = 0, 1, [], [], [], []

    def take(self, codes: np.ndarray, words: pa.Array, lengths: np.ndarray, keys: list, held: list) -> None:
        seen = np.zeros(len(words), bool)
        seen[codes] = True
        used = np.nonzero(seen)[0]
        number = np.zeros(len(words), np.int64)
        number[used] = np.arange(self.n_words, self.n_words + len(used))
        tokens = np.zeros(len(codes) + len(lengths), np.int32)  # every text is followed by an END
        tokens[np.arange(len(codes)) + np.repeat(np.arange(len(lengths)), lengths)] = number[codes]
        self.words.append(words.take(pa.array(used)))
        self.n_words += len(used)
        self.tokens.append(tokens)
        self.lengths.append(lengths + 1)
        self.keys += keys
        self.held += held
        self.size += len(tokens)

    def whole(self, block: int) -> Iterator[pa.RecordBatch]:
        """Its words, and its tokens as their numbers, in one row; then its documents."""
        coded = pa.concat_arrays(self.words).dictionary_encode()
        words = coded.dictionary
        lengths, held = np.concatenate(self.lengths), np.array(self.held, bool)
        order = np.argsort(held, kind="stable")  # learned from, then held out
        begin = np.cumsum(lengths) - lengths
        turned = lengths[order]
        at = np.arange(int(lengths.sum())) + np.repeat(begin[order] - (np.cumsum(turned) - turned), turned)
        tokens = coded.indices.to_numpy()[np.concatenate(self.tokens)[at]].astype(np.int32)
        data, size = _flat(words, np.uint8)
        yield pa.record_batch({
            "w": pa.array([_squeezed(data)], pa.binary()), "block": pa.array([block]), "n_train": pa.array([int(lengths[~held].sum())]),
            "ctxs": pa.array([_squeezed(size)], pa.binary()), "learned": pa.nulls(1, pa.binary()), "places": pa.array([_squeezed(tokens)], pa.binary()),
            "key": pa.nulls(1, pa.string()), "doc": pa.nulls(1, pa.int32()), "n_tokens": pa.nulls(1, pa.int64()), "held": pa.nulls(1, pa.bool_())})
        yield self.heads(block, order, lengths, held)

    def heads(self, block: int, order: np.ndarray, lengths: np.ndarray, held: np.ndarray) -> pa.RecordBatch:
        n_docs = len(order)
        none = pa.nulls(n_docs, pa.binary())
        return pa.record_batch({
            "w": none, "block": pa.array(np.full(n_docs, block)), "n_train": pa.nulls(n_docs, pa.int64()), "ctxs": none, "learned": none,
            "places": none, "key": pa.array([self.keys[i] for i in order.tolist()], pa.string()), "doc": pa.array(range(n_docs), pa.int32()),
            "n_tokens": pa.array(lengths[order].astype(np.int64)), "held": pa.array(held[order])})

    def rows(self, block: int, contexts: int | None) -> Iterator[pa.RecordBatch]:
        if contexts is None:
            yield from self.whole(block)
            return
        coded = pa.concat_arrays(self.words).dictionary_encode()
        words = coded.dictionary
        lengths, tokens, held = np.concatenate(self.lengths), coded.indices.to_numpy()[np.concatenate(self.tokens)], np.array(self.held, bool)
        n_docs, n_words = len(lengths), len(words)
        order = np.argsort(held, kind="stable")  # learned from, then held out
        doc = np.empty(n_docs, np.uint64)
        doc[order] = np.arange(n_docs, dtype=np.uint64)
        of = np.fromiter(map(zlib.crc32, words.to_pylist()), np.uint64, n_words) % np.uint64(contexts)
        before = np.empty(len(tokens), np.uint64)
        before[1:] = of[tokens[:-1]]
        before[np.cumsum(lengths) - lengths] = contexts
        places = tokens.astype(np.uint64) << np.uint64(32) | before << np.uint64(16) | np.repeat(doc, lengths)
        del tokens, before
        places.sort()
        cell = (places >> np.uint64(16)).astype(np.int64)
        at = (places & np.uint64(0xFFFF)).astype(np.int32)
        del places
        starts = np.nonzero(np.diff(cell, prepend=-1))[0]
        within = np.arange(len(at)) - np.repeat(starts, np.diff(starts, append=len(at)))
        starts = np.nonzero(within % 255 == 0)[0]  # a context of more places comes again, so a count is a byte
        del within
        cell = cell[starts]
        n = np.diff(starts, append=len(at))
        learned = np.add.reduceat((at < n_docs - held.sum()).astype(np.int64), starts)
        steps = np.diff(at, prepend=np.int32(0))
        steps[starts] = at[starts]
        del at
        word, ctx = cell >> 16, cell & 0xFFFF
        cells, count = np.bincount(word, minlength=n_words), np.bincount(word, n, n_words).astype(np.int64)
        packed = np.empty(int(cells.sum() + 2 * count.sum()), np.uint8)
        for where, what in zip(_layout(cells, count), (n, steps & 0xFF, steps >> 8)):
            packed[where] = what
        yield pa.record_batch({
            "w": words, "block": pa.array(np.full(n_words, block)), "n_train": pa.array(np.bincount(word, learned, n_words).astype(np.int64)),
            "ctxs": _packed(ctx.astype(np.uint16), cells), "learned": _packed(learned.astype(np.uint8), cells),
            "places": _packed(packed, cells + 2 * count),
            "key": pa.nulls(n_words, pa.string()), "doc": pa.nulls(n_words, pa.int32()), "n_tokens": pa.nulls(n_words, pa.int64()),
            "held": pa.nulls(n_words, pa.bool_())})
        yield self.heads(block, order, lengths, held)


def _blocks(batches: Iterator[pa.RecordBatch], contexts: int | None) -> Iterator[pa.RecordBatch]:
    """(key, text, held) → a row for each word of a block with its contexts and places there (for the whole
    block where contexts are not numbered, see :meth:`_Block.whole`), and one for each document.

    A word's places are sorted by context and document: the contexts, how
    often each comes (in the documents learned from, too), and the steps
    between its documents, low and high bytes apart.
    """
    part = TaskContext.get().partitionId()
    number, block = 0, _Block()
    for batch in batches:
        for piece in _pieces(batch):
            codes, words, lengths = _coded(piece["text"])
            keys, held = piece["key"].to_pylist(), piece["held"].to_pylist()
            ends = np.concatenate([[0], np.cumsum(lengths)])
            a = 0
            while a < len(keys):
                sizes = ends[a + 1:] - ends[a] + np.arange(1, len(keys) - a + 1)
                b = min(a + int(np.searchsorted(sizes, BLOCK - block.size)) + 1, a + BLOCK_DOCS - len(block.keys), len(keys))
                block.take(codes[ends[a]:ends[b]], words, lengths[a:b], keys[a:b], held[a:b])
                a = b
                if block.size >= BLOCK or len(block.keys) == BLOCK_DOCS:
                    yield from block.rows(part << 32 | number, contexts)
                    number, block = number + 1, _Block()
    if block.keys:
        yield from block.rows(part << 32 | number, contexts)


def _opened(row: dict) -> tuple[pa.Array, np.ndarray]:
    """A block's words, and its (word, word before) pairs in order, as their numbers; END, number 0, is before a text."""
    size, data = _loosened(row["ctxs"], np.int64), _loosened(row["w"], np.uint8)
    tokens = _loosened(row["places"], np.int32).astype(np.int64)
    pairs = tokens << 32
    pairs[1:] |= tokens[:-1]
    return _packed(data, size), pairs


def _context_counts(batches: Iterator[pa.RecordBatch], kind: type = np.uint16) -> Iterator[pa.RecordBatch]:
    """The contexts of each word of a block among the documents learned from, with their counts."""
    for batch in batches:
        ctx, cells = _flat(batch["ctxs"], kind)
        n = _flat(batch["learned"], np.uint8)[0]
        there = n > 0
        per = np.bincount(np.repeat(np.arange(len(cells)), cells)[there], minlength=len(cells))
        yield pa.record_batch({"w": batch["w"], "ctx": _packed(ctx[there], per), "n": _packed(n[there].astype(np.uint32), per)})


def _merged(batches: Iterator[pa.RecordBatch], kind: type = np.uint16) -> Iterator[pa.RecordBatch]:
    """Rows sorted by word → one row per word: c, and the counts of its contexts. The last word of a batch waits for the next one."""
    held: tuple | None = None  # word, its contexts, their counts

    def out(words: pa.Array, ctx: np.ndarray, n: np.ndarray, per: np.ndarray) -> pa.RecordBatch:
        c = np.bincount(np.repeat(np.arange(len(per)), per), n, len(per)).astype(np.int64)
        return pa.record_batch([words, pa.array(c), _packed(ctx, per), _packed(n, per)], names=["w", "c", "ctx", "n"])

    for batch in batches:
        if not len(batch):
            continue
        words = batch["w"]
        ctx, per = _flat(batch["ctx"], kind)
        n = _flat(batch["n"], np.uint32)[0].astype(np.int64)
        if held is not None:
            words = pa.concat_arrays([pa.array([held[0]], pa.binary()), words])
            ctx, n, per = np.concatenate([held[1], ctx]), np.concatenate([held[2], n]), np.concatenate([[len(held[1])], per])
        new = np.concatenate([[True], pc.not_equal(words[1:], words[:-1]).to_numpy(zero_copy_only=False)])
        first = np.nonzero(new)[0]
        row = np.repeat(np.cumsum(new) - 1, per)
        order = np.lexsort((ctx, row))
        row, ctx = row[order], ctx[order]
        starts = np.nonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (ctx[1:] != ctx[:-1])]))[0]
        n, ctx = np.add.reduceat(n[order], starts), ctx[starts]
        per = np.bincount(row[starts], minlength=len(first))
        last = int(per[-1])
        held = (words[int(first[-1])].as_py(), ctx[len(ctx) - last:], n[len(n) - last:])
        if len(first) > 1:
            yield out(words.take(pa.array(first[:-1])), ctx[:len(ctx) - last], n[:len(n) - last], per[:-1])
    if held is not None:
        yield out(pa.array([held[0]], pa.binary()), held[1], held[2], np.array([len(held[1])]))


_ARROW = {"binary": pa.binary(), "long": pa.int64(), "int": pa.int32(), "double": pa.float64()}


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.record_batch([pa.array(c, _ARROW[kind]) for c, (_, kind) in zip(columns, fields)], names=[name for name, _ in fields])


class Restaurants:
    """What a word's row needs of all others: tables and customers of every context (if they are numbered) and of the parent, discounts and vocabulary."""

    def __init__(self, customers: list[int], tables: list[int], parent_customers: int, parent_tables: int, discount: float, parent_discount: float,
                 vocabulary: int, tokens: int) -> None:
        self.customers, self.tables = customers, tables
        self.parent_customers, self.parent_tables = parent_customers, parent_tables
        self.discount, self.parent_discount = discount, parent_discount
        self.vocabulary, self.tokens = vocabulary, tokens

    def parent(self, customers, tables):
        """The parent's predictive probability of a word with so many customers and tables there."""
        every = STRENGTH + self.parent_customers
        return (customers - self.parent_discount * tables) / every + (STRENGTH + self.parent_discount * self.parent_tables) / every / (self.vocabulary + 1)

    def back_off(self) -> np.ndarray:
        """By context: the share of the parent in the predictive probabilities."""
        return (STRENGTH + self.discount * np.array(self.tables, np.float64)) / (STRENGTH + np.array(self.customers, np.float64))


def seat(rnd: random.Random, n: int, discount: float, others: float, p: Callable[[int], float]) -> list[int]:
    """Table sizes after ``n`` customers of a word sit down one after another, where other words have ``others`` tables.

    ``p(t)`` is the parent's probability of the word when it has t tables here.
    While nobody opens a table the customers at the old ones are an urn:
    the number until the next new table is geometric with a beta variate,
    and how they spread over the tables is drawn from the last table back.
    """
    opened, j = [0], 1
    while j < n:
        t = len(opened)
        rate = rnd.betavariate((STRENGTH + discount * (others + t)) * p(t), j - discount * t)
        gap = 0 if rate >= 1 else n if rate <= 0 else math.log(1 - rnd.random()) / math.log1p(-rate)
        if gap >= n - j:
            break
        j += int(gap)
        opened.append(j)
        j += 1
    sizes, left = [0] * len(opened), n
    for k in range(len(opened) - 1, 0, -1):
        joining = left - opened[k] - 1
        sizes[k] = 1 + (rnd.binomialvariate(joining, rnd.betavariate(1 - discount, opened[k] - discount * k)) if joining > 0 else 0)
        left -= sizes[k]
    sizes[0] = left
    return sizes


def leave(rnd: random.Random, sizes: list[int], n: int) -> None:
    """One of the ``n`` customers leaves."""
    at = rnd.random() * n
    for k, size in enumerate(sizes):
        at -= size
        if at < 0 or k == len(sizes) - 1:
            break
    sizes[k] -= 1
    if not sizes[k]:
        del sizes[k]


def enter(rnd: random.Random, sizes: list[int], n: int, discount: float, others: float, p: Callable[[int], float]) -> None:
    """A customer joins the ``n`` there."""
    t = len(sizes)
    at = rnd.random() * (n - discount * t + (STRENGTH + discount * (others + t)) * p(t))
    for k, size in enumerate(sizes):
        at -= size - discount
        if at < 0:
            sizes[k] += 1
            return
    sizes.append(1)


def _moves(n: int) -> int:
    """Customers of ``n`` that one round moves: the scan is random, and grows with the logarithm."""
    return n.bit_length()


def log_ways(n: int, discount: float) -> np.ndarray:
    """[i, t]: log of the weight of all seatings of i customers, to ``n``, at t tables (a generalised Stirling number)."""
    out = np.full((n + 1, n + 1), -np.inf)
    out[0, 0] = 0.0
    for i in range(1, n + 1):
        t = np.arange(1, n + 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            stay = np.where(t < i, np.log(np.maximum(i - 1 - discount * t, 1e-300)) + out[i - 1, 1:], -np.inf)
        out[i, 1:] = np.logaddexp(out[i - 1, :-1], stay)
    return out


def _uniform(word: np.ndarray, place: np.ndarray, seed: int) -> np.ndarray:
    """A number in [0, 1) for each (word, place), the same in every run: their bits, mixed."""
    with np.errstate(over="ignore"):
        x = word ^ ((place.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) ^ (np.uint64(seed) * np.uint64(0xD1B54A32D192ED03))
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    return (x >> np.uint64(11)).astype(np.float64) / (1 << 53)


def _drawn(log_weight: np.ndarray, u: np.ndarray) -> np.ndarray:
    """An index of each row, with the probabilities of the row's weights."""
    w = np.exp(log_weight - log_weight.max(axis=1, keepdims=True)).cumsum(axis=1)
    return (w < (u * w[:, -1])[:, None]).sum(axis=1)


class Seats:
    """The seating of some words: t tables in each cell (word, context), and the parent's table sizes."""

    def __init__(self, every: Restaurants, seed: int, words: list[bytes] | np.ndarray, cells: np.ndarray, ctx: np.ndarray, n: np.ndarray, t: np.ndarray,
                 sizes: dict[int, list[int]], roots: list[list[int]], ones: np.ndarray | int = 0, tables: np.ndarray | None = None) -> None:
        """``words`` or their ``hash``; ``ones``: cells of one customer that a word has besides; ``tables``: those of each cell's context, where contexts are not numbered."""
        self.all, self.seed, self.ctx, self.n, self.t, self.sizes, self.roots = every, seed, ctx, n, t.copy(), sizes, roots
        self.of = np.repeat(np.arange(len(words)), cells)
        self.hash = words if isinstance(words, np.ndarray) else np.array([zlib.crc32(w) << 32 | zlib.crc32(w[::-1]) for w in words], np.uint64)
        self.n_root = np.bincount(self.of, self.t, len(words)).astype(np.int64) + ones
        self.began = self.n_root.copy()
        self.t_root = np.array([r[0] if k <= BIG_PARENT else len(r) for r, k in zip(roots, self.n_root.tolist())], np.int64)
        self.others = (np.array(every.tables, np.int64)[ctx] if tables is None else tables) - self.t

    def parent(self, word: int, customers: int) -> float:
        return self.all.parent(customers, int(self.t_root[word]))

    def draw(self, cells: np.ndarray) -> None:
        """New numbers of tables of cells of up to BIG customers, given all else."""
        a, word = self.all, self.of[cells]
        beside = self.n_root[word] - self.t[cells]
        n, r, d, d0 = self.n[cells], self.t_root[word], a.discount, a.parent_discount
        u = _uniform(self.hash[word], self.ctx[cells], self.seed)
        high = 1
        while high < BIG:  # a cell of n customers needs n weights
            low, high = high, min(2 * high, BIG)
            band = np.nonzero((n > low) & (n <= high))[0]
            if not len(band):
                continue
            k = np.arange(1, high)
            weight = a.ways[n[band], 1:high + 1].copy()
            rest, tops = beside[band], r[band]
            few = rest + high <= BIG_PARENT
            there = a.parent_customers + self.n_root[word[band]] - self.began[word[band]] - self.t[cells[band]]  # the parent's customers but for these
            more = np.log(STRENGTH + d * (self.others[cells[band]][:, None] + k)) - np.log(np.maximum(STRENGTH + there[:, None] + k, 1e-9))
            more[~few] += np.log(np.maximum(rest[~few][:, None] + k - d0 * tops[~few][:, None], 1e-9))
            weight[:, 1:] += more.cumsum(axis=1)
            weight[few] += a.parent_ways[rest[few][:, None] + np.arange(1, high + 1), tops[few][:, None]]
            new = _drawn(weight, u[band]) + 1
            at = cells[band]
            np.add.at(self.n_root, word[band], new - self.t[at])
            self.t[at] = new

    def round(self, first: bool) -> None:
        """Every cell, then every parent; ``first``: tables of many customers are filled from nobody."""
        a, rnd = self.all, random.Random()
        small = np.nonzero((self.n > 1) & (self.n <= BIG))[0]
        if len(small):
            word = self.of[small]
            begins = np.concatenate([[0], np.nonzero(np.diff(word))[0] + 1])
            step = np.minimum(np.arange(len(small)) - np.repeat(begins, np.diff(np.append(begins, len(small)))), STEPS - 1)
            order = np.argsort(step, kind="stable")
            for part in np.split(small[order], np.nonzero(np.diff(step[order]))[0] + 1):
                self.draw(part)
        for i in np.nonzero(self.n > BIG)[0].tolist():
            word, n, others = int(self.of[i]), int(self.n[i]), int(self.others[i])
            rnd.seed(int(self.hash[word]) ^ (int(self.ctx[i]) << 64) ^ (self.seed << 96))
            beside = int(self.n_root[word]) - int(self.t[i])
            p = lambda t: self.parent(word, max(beside + t, int(self.t_root[word])))  # noqa: B023, E731
            if first:
                self.sizes[i] = seat(rnd, n, a.discount, others, p)
            else:
                for _ in range(_moves(n)):
                    leave(rnd, self.sizes[i], n)
                    enter(rnd, self.sizes[i], n - 1, a.discount, others, p)
            self.t[i] = len(self.sizes[i])
            self.n_root[word] = beside + self.t[i]
        self._parents(rnd)

    def _parents(self, rnd: random.Random) -> None:
        a = self.all
        p0 = 1 / (a.vocabulary + 1)
        few = np.nonzero(self.n_root <= BIG_PARENT)[0]
        u = _uniform(self.hash[few], np.full(len(few), 1 << 16), self.seed)
        high = 0
        while high < BIG_PARENT:
            low, high = high, min(2 * max(high, 1), BIG_PARENT)
            band = np.nonzero((self.n_root[few] > low) & (self.n_root[few] <= high))[0]
            k = np.arange(1, high)
            for s in np.split(band, range(1 << 12, len(band), 1 << 12)):
                if not len(s):
                    continue
                word = few[s]
                weight = a.parent_ways[self.n_root[word], 1:high + 1].copy()
                weight[:, 1:] += (np.log(STRENGTH + a.parent_discount * ((a.parent_tables - self.t_root[word])[:, None] + k)) + math.log(p0)).cumsum(axis=1)
                self.t_root[word] = _drawn(weight, u[s]) + 1
        for i, t in zip(few.tolist(), self.t_root[few].tolist()):
            self.roots[i] = [t]
        for i in np.nonzero(self.n_root > BIG_PARENT)[0].tolist():
            n, old = int(self.n_root[i]), self.roots[i]
            rnd.seed(int(self.hash[i]) ^ (self.seed << 96) ^ (1 << 95))
            others = a.parent_tables - int(self.t_root[i])
            have = sum(old)
            if have <= BIG_PARENT:
                old = seat(rnd, n, a.parent_discount, others, lambda t: p0)
            else:
                while have > n:
                    leave(rnd, old, have)
                    have -= 1
                while have < n:
                    enter(rnd, old, have, a.parent_discount, others, lambda t: p0)
                    have += 1
                for _ in range(_moves(n)):
                    leave(rnd, old, n)
                    enter(rnd, old, n - 1, a.parent_discount, others, lambda t: p0)
            self.roots[i] = old
            self.t_root[i] = len(old)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about CELLS_AT_ONCE cells."""
    some, size = [], 0

    def one() -> pa.RecordBatch:
        return pa.Table.from_batches(some).combine_chunks().to_batches()[0]

    for batch in batches:
        if len(batch):
            some.append(batch)
            size += len(_flat(batch["ctx"], np.uint16)[0])
            if size >= CELLS_AT_ONCE:
                yield one()
                some, size = [], 0
    if some:
        yield one()


def _sampled(batches: Iterator[pa.RecordBatch], every: Restaurants, seed: int, first: bool) -> Iterator[pa.RecordBatch]:
    """The first seating of words and a round over it, or one more round; the seating is added to the samples.

    A word read once sits one way and is only copied. Where contexts are not
    numbered, rows bring the number of their cells of one customer, which are
    not among the others, and the tables of the others' contexts.
    """
    every.ways, every.parent_ways = log_ways(BIG, every.discount), log_ways(BIG_PARENT, every.parent_discount)
    for batch in _gathered(batches):
        exact = "ones" in batch.schema.names
        once = (batch["c"].to_numpy() == 1) & (not exact)
        lone = batch.filter(pa.array(once))
        if len(lone):
            one, n = _packed(np.ones(len(lone), np.int64), np.ones(len(lone), np.int64)), len(lone)
            none = pa.array([b""] * n, pa.binary())
            old = _flat(lone["roots"], np.int64)[0].reshape(n, -1) if not first else np.zeros((n, 0), np.int64)
            sums = np.ones(n, np.int64) if first else _flat(lone["t_sum"], np.int64)[0] + 1
            pairs = np.concatenate([old, np.ones((n, 2), np.int64)], axis=1)
            yield pa.record_batch([lone["w"], lone["c"], lone["ctx"], lone["n"], one, none, one, _packed(sums, np.ones(n, np.int64)),
                                   _packed(pairs.ravel(), np.full(n, pairs.shape[1]))], names=list(STATE_COLUMNS))
        rows = batch.filter(pa.array(~once))
        if not len(rows):
            continue
        ctx, cells = _flat(rows["ctx"], np.uint64 if exact else np.uint16)
        n, _ = _flat(rows["n"], np.int64)
        ones = rows["ones"].to_numpy() if exact else 0
        tables = _flat(rows["tables"], np.int64)[0] if exact else None
        of = np.repeat(np.arange(len(rows)), cells)
        big = np.nonzero(n > BIG)[0].tolist()
        if first:
            t, sizes, roots = np.ones_like(n), {}, [[1]] * len(rows)
        else:
            t, _ = _flat(rows["t"], np.int64)
            flat, at, sizes = _flat(rows["sizes"], np.int64)[0].tolist(), 0, {}
            for i in big:
                sizes[i] = flat[at:at + int(t[i])]
                at += int(t[i])
            flat, per = _flat(rows["root"], np.int64)
            flat, ends = flat.tolist(), np.cumsum(per)
            roots = [flat[a:b] for a, b in zip((ends - per).tolist(), ends.tolist())]
        seats = Seats(every, seed, rows["w"].to_numpy(zero_copy_only=False).tolist(), cells, ctx, n, t, sizes, roots, ones, tables)
        seats.round(first)
        if first:
            tables = tables + seats.t - t if exact else None  # its own ones have changed
            seats = Seats(every, seed + (1 << 20), seats.hash, cells, ctx, n, seats.t, seats.sizes, seats.roots, ones, tables)
            seats.round(False)
        held = np.bincount(of[big], [len(seats.sizes[i]) for i in big], len(rows)).astype(np.int64) if big else np.zeros(len(rows), np.int64)
        flat = np.array([x for i in big for x in seats.sizes[i]], np.int64)
        sums = seats.t if first else _flat(rows["t_sum"], np.int64)[0] + seats.t
        old = _flat(rows["roots"], np.int64)[0].reshape(len(rows), -1) if not first else np.zeros((len(rows), 0), np.int64)
        pairs = np.concatenate([old, seats.n_root[:, None], seats.t_root[:, None]], axis=1)
        pairs, width = pairs.ravel(), pairs.shape[1]
        yield pa.record_batch([rows["w"], rows["c"], rows["ctx"], rows["n"], _packed(seats.t, cells), _packed(flat, held),
                               _packed(np.array([x for r in seats.roots for x in r], np.int64), np.array([len(r) for r in seats.roots], np.int64)),
                               _packed(sums, cells), _packed(pairs, np.full(len(rows), width))], names=list(STATE_COLUMNS))


STATE_COLUMNS = tuple(f.split()[0] for f in STATE.split(", "))
#: Numbers of the totals besides one per context. LONE words are read once.
LONE, WORDS, TOKENS, ONCE, TWICE, PARENT, PARENT_TABLES, PARENT_ONCE, PARENT_TWICE = range(-9, 0)


def _totals(batches: Iterator[pa.RecordBatch], contexts: int | None, state: bool) -> Iterator[pa.RecordBatch]:
    """What a task's words add to the totals: (id, a, b), for each numbered context its customers and tables."""
    customers, tables, extra = np.zeros((contexts or 0) + 1, np.int64), np.zeros((contexts or 0) + 1, np.int64), defaultdict(int)
    for batch in batches:
        ctx, per = _flat(batch["ctx"], _kind(contexts))
        n, _ = _flat(batch["n"], np.int64)
        t = _flat(batch["t"], np.int64)[0] if state else np.ones_like(n)
        ones = batch["ones"].to_numpy() if contexts is None else np.zeros(len(per), np.int64)
        if contexts is not None:
            np.add.at(customers, ctx, n)
            np.add.at(tables, ctx, t)
        extra[LONE] += int(((per == 0) & (ones == 1)).sum())
        per = per + ones
        extra[WORDS] += len(per)
        extra[TOKENS] += int(n.sum() + ones.sum())
        extra[ONCE] += int((n == 1).sum() + ones.sum())
        extra[TWICE] += int((n == 2).sum())
        extra[PARENT] += int(t.sum() + ones.sum())
        extra[PARENT_ONCE] += int((per == 1).sum())
        extra[PARENT_TWICE] += int((per == 2).sum())
        extra[PARENT_TABLES] += _parent_tables(batch["t"], batch["root"], ones) if state else len(per)
    rows = [(k, int(customers[k]), int(tables[k])) for k in np.nonzero(customers)[0].tolist()] + [(k, v, 0) for k, v in extra.items()]
    yield _rows(rows, "id int, a long, b long")


def _parent_tables(t: pa.Array, root: pa.Array, ones: np.ndarray) -> int:
    flat, per = _flat(t, np.int64)
    customers = np.bincount(np.repeat(np.arange(len(per)), per), flat, len(per)) + ones
    sizes, tables = _flat(root, np.int64)
    counted = customers <= BIG_PARENT  # of these the number is kept, of others the sizes
    return int(tables[~counted].sum()) + int(sizes[(np.cumsum(tables) - tables)[counted]].sum())


def _discount(once: int, twice: int) -> float:
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once + twice else 0.5


def restaurants(rows: DataFrame, contexts: int | None, state: bool, lone: int = 0) -> Restaurants:
    """The totals of cells or of a state, beside which are ``lone`` words read once: at most ``contexts`` + 10 rows reach the driver, 9 without numbered contexts."""
    needed = rows.select(*(c for c in ("ctx", "n", "ones", "t", "root") if c in rows.columns))
    parts = needed.mapInArrow(partial(_totals, contexts=contexts, state=state), "id int, a long, b long")
    got = {r[0]: (r[1], r[2]) for r in parts.groupBy("id").agg(F.sum("a"), F.sum("b")).collect()}
    extra = {k: got.get(k, (0, 0))[0] + (lone if k in (WORDS, TOKENS, ONCE, PARENT, PARENT_TABLES, PARENT_ONCE) else 0) for k in range(LONE, 0)}
    by = [got.get(k, (0, 0)) for k in range(contexts + 1)] if contexts is not None else []
    found = Restaurants([a for a, _ in by], [b for _, b in by], extra[PARENT], extra[PARENT_TABLES], _discount(extra[ONCE], extra[TWICE]),
                        _discount(extra[PARENT_ONCE], extra[PARENT_TWICE]), extra[WORDS], extra[TOKENS])
    found.lone = extra[LONE]
    return found


def _sorted(df: DataFrame, *by: str) -> DataFrame:
    return df.repartition(by[0]).sortWithinPartitions(*by)


def learned(blocks: DataFrame, contexts: int, samples: int = SAMPLES, seed: int = SEED) -> tuple[DataFrame, list[Restaurants]]:
    """The words' last state, with the sums of their samples, and the totals of each sample."""
    found = blocks.filter("n_train > 0").select("w", "ctxs", "learned").mapInArrow(_context_counts, "w binary, ctx binary, n binary")
    cells = written(_sorted(found, "w").mapInArrow(_merged, CELLS), "lm-cells")
    first = restaurants(cells, contexts, False)
    state, kept = cells, []
    for k in range(samples):
        every = kept[-1] if kept else first
        before, state = state, written(state.mapInArrow(partial(_sampled, every=every, seed=seed + k, first=not kept), STATE), "lm-seats")
        drop_scratch(before)  # the new state holds all that comes after
        now = restaurants(state, contexts, True)
        now.discount, now.parent_discount = first.discount, first.parent_discount
        kept.append(now)
    return state, kept


_WIDTHS = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.int64}


def _narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (w, number, ctx, b) with the numbers of b in as few bytes as the row's largest needs."""
    for batch in batches:
        flat, per = _flat(batch["b"], np.int64)
        if not len(per):
            continue
        most = np.maximum.reduceat(flat, np.cumsum(per) - per)  # no row is empty
        low = -1
        for width, kind in _WIDTHS.items():
            high = np.iinfo(kind).max
            rows = (most > low) & (most <= high)
            low = high
            if rows.any():
                some = batch.filter(pa.array(rows))
                yield pa.record_batch([some["w"], some["number"], some["ctx"], _packed(flat[np.repeat(rows, per)].astype(kind), per[rows])],
                                      names=["w", "number", "ctx", "b"])


def _numbers(column: pa.Array, cells: np.ndarray, samples: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """n and t of all cells, and the parent's customers and tables by row and sample, of what :func:`_narrow` gave."""
    raw, size = _flat(column, np.uint8)
    count = 2 * cells + 2 * samples
    out = np.zeros((int(count.sum()), 8), np.uint8)
    out[np.arange(8) < np.repeat(size // count, count)[:, None]] = raw
    flat = out.view("<i8").ravel()
    place = np.arange(len(flat)) - np.repeat(np.cumsum(count) - count, count)
    per = np.repeat(cells, count)
    return flat[place < per], flat[(place >= per) & (place < 2 * per)], flat[place >= 2 * per].reshape(len(cells), samples, 2)


def _scored(batches: Iterator[pa.RecordBatch], contexts: int, kept: list[Restaurants]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by word, its state before its places → sums by document."""
    samples = len(kept)
    back = np.stack([r.back_off() for r in kept])  # sample, context
    under = STRENGTH + np.array(kept[0].customers, np.float64)
    d, n_all, v = kept[0].discount, kept[0].tokens, kept[0].vocabulary
    base0 = math.log10(0.5 / (n_all + 0.5 * (v + 1)))
    held: list[tuple] = []
    n_held = 0
    none = np.zeros(0, np.int64)
    nothing = (np.zeros(1, np.int64), np.zeros(1, np.int64), none.astype(np.uint16), none, none, np.zeros((1, samples, 2), np.int64))
    last_word, last = None, nothing  # the word at hand and its (c, number of contexts, contexts, n, t, parents), which go over the ends of batches

    def out() -> Iterator[pa.RecordBatch]:
        nonlocal n_held
        if held:
            block, places, doc, score, base, known = (np.concatenate(x) for x in zip(*held))
            held.clear()
            n_held = 0
            ids, number = np.unique(block, return_inverse=True)
            key, at = np.unique(np.repeat(number << 16, places) | doc, return_inverse=True)
            per = np.bincount(key >> 16, minlength=len(ids))
            yield pa.record_batch({"block": pa.array(ids), "docs": _packed((key & 0xFFFF).astype(np.uint16), per),
                                   "score": _packed(np.bincount(at, score), per),
                                   "base": _packed(np.bincount(at, np.repeat(base, places)), per),
                                   "known": _packed(np.bincount(at, np.repeat(known, places)).astype(np.uint32), per)})

    for batch in batches:
        number, words = batch["number"].to_numpy(), batch["w"]
        if not len(number):
            continue
        known = number < 0
        new = batch.filter(pa.array(known))
        new_ctx, new_cells = _flat(new["ctx"], np.uint16)
        new_n, new_t, new_roots = _numbers(new["b"], new_cells, samples)
        new_c = -number[known]
        # states: the one of the word at hand, that of unknown words, and those of this batch; each row of places points to the state of its word
        differs = np.concatenate([[last_word is None or words[0].as_py() != last_word], pc.not_equal(words[1:], words[:-1]).to_numpy(zero_copy_only=False)])
        word = np.cumsum(differs)
        at = np.concatenate([[-1], np.nonzero(known)[0]])[np.cumsum(known)]  # the last row of a state up to here
        of = np.where((at >= 0) & (word[at] == word), np.cumsum(known) + 1, np.where(word == 0, 0, 1))
        c, sizes, cell_ctx, cell_n, cell_t, roots = (np.concatenate([a, b, x]) for a, b, x in zip(
            last, nothing, (new_c, new_cells, new_ctx, new_n, new_t, new_roots)))
        places = np.nonzero(~known)[0]
        begin, s = np.cumsum(sizes) - sizes, int(of[-1])
        one = slice(int(begin[s]), int(begin[s] + sizes[s]))
        last_word, last = words[len(words) - 1].as_py(), (c[s:s + 1], sizes[s:s + 1], cell_ctx[one], cell_n[one], cell_t[one], roots[s:s + 1])
        if not len(places):
            continue
        rows = batch.take(pa.array(places))
        raw, size = _flat(rows["b"], np.uint8)
        ctx, within = _flat(rows["ctx"], np.uint16)
        per = (size - within) // 2
        count, low, high = _layout(within, per)
        n = raw[count].astype(np.int64)
        docs = _unstepped(raw[low] | raw[high].astype(np.uint16) << 8, n)
        state = of[places]
        of = np.repeat(state, within)  # of each context of each row
        cell_key = np.repeat(np.arange(len(c)) << 16, sizes) | cell_ctx
        parents = np.stack([r.parent(roots[:, k, 0], roots[:, k, 1]) for k, r in enumerate(kept)])
        key = of << 16 | ctx
        found = np.searchsorted(cell_key, key)
        found[found == len(cell_key)] = 0
        hit = cell_key[found] == key if len(cell_key) else np.zeros(len(key), bool)
        p = np.zeros(len(key))
        for k in range(samples):
            p += back[k][ctx] * parents[k][of]
        if hit.any():
            at = found[hit]
            p[hit] += (samples * cell_n[at] - d * cell_t[at]) / under[ctx[hit]]
        base = np.where(c > 0, np.log10((c + 0.5) / (n_all + 0.5 * (v + 1))), base0)
        held.append((rows["number"].to_numpy(), per, docs, np.repeat(np.log10(p / samples), n), base[state], (c > 0)[state]))
        n_held += len(docs)
        if n_held >= PLACES:
            yield from out()
    yield from out()


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block, its documents before the sums → the documents with their whole sums."""
    names = ("key", "n_tokens", "held")
    block, heads, sums = None, [], None

    def out() -> pa.RecordBatch:
        n = len(heads)
        total = sums[:, :n]
        return pa.record_batch([pa.array([h[0] for h in heads], pa.string()), pa.array([h[1] for h in heads], pa.int64()), pa.array([h[2] for h in heads], pa.bool_()),
                                pa.array(total[0]), pa.array(total[1]), pa.array(np.rint(total[2]).astype(np.int64))],
                               names=[*names, "score", "base_score", "n_known"])

    for batch in batches:
        for row in zip(*(batch[k].to_pylist() for k in ("block", "doc", "key", "n_tokens", "held", "docs", "score", "base", "known"))):
            if row[0] != block:
                if heads:
                    yield out()
                block, heads, sums = row[0], [], np.zeros((3, BLOCK_DOCS))
            if row[1] is not None:
                heads.append(row[2:5])
            else:
                at = np.frombuffer(row[5], np.uint16)
                for k, (values, dtype) in enumerate(((row[6], np.float64), (row[7], np.float64), (row[8], np.uint32))):
                    sums[k][at] += np.frombuffer(values, dtype)
    if heads:
        yield out()


WORD_CELLS = "w binary, bucket long, chunk long, c long, ones long, once binary, ctx binary, n binary"
COUNTS = "bucket long, w binary, sizes binary, ctx binary, n binary"
WORD_STATE = STATE + ", bucket long, chunk long, ones long"
#: Words, and cells, that a chunk holds at least, and rows and cells that a task packs by bucket together.
CHUNK, CHUNK_CELLS, PACKED = 1 << 14, 1 << 17, 1 << 20
#: Shares of the buckets that answer one after another.
TURNS = 2
#: Words of a run of ids (a bucket) packed together. What is known of them comes in rows that TOTALS, CELL and SEATED
#: tell apart by their number; the blocks that ask for them come after, under their own numbers.
PARTS = "bucket long, number long, words binary, cells binary"
TOTALS, CELL, SEATED = range(-3, 0)


def _different(values: np.ndarray) -> np.ndarray:
    """The different ones of sorted values."""
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def _pair_counts(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Blocks → by bucket their words among the documents learned from: the text, and the number and the counts of their contexts."""
    for batch in batches:
        for row in batch.to_pylist():
            words, pairs = _opened(row)
            cells, n = np.unique(pairs[:row["n_train"]], return_counts=True)
            ids, per = _ids(words), np.bincount(cells >> 32, minlength=len(words))
            some = np.nonzero(per)[0]
            order = np.argsort(ids[some])
            ctx, n = ids[cells & 0xFFFFFFFF], n.astype(np.uint32)
            at, per, some = _turned(order, per[some]), per[some[order]], some[order]
            ctx, n, words, ends = ctx[at], n[at], words.take(pa.array(some)), np.concatenate([[0], np.cumsum(per)])
            buckets = (ids[some] >> np.uint64(64 - bits)).astype(np.int64)
            starts = np.nonzero(np.diff(buckets, prepend=-1))[0].tolist()
            for a, b in zip(starts, [*starts[1:], len(some)]):
                data, size = _flat(words[a:b], np.uint8)
                yield _rows([(int(buckets[a]), _squeezed(data), _squeezed(np.concatenate([size, per[a:b]])), ctx[ends[a]:ends[b]].tobytes(), _squeezed(n[ends[a]:ends[b]]))], COUNTS)


def _together(parts: list[tuple]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(words, how many contexts each has, contexts, counts) → the same, every word once and its contexts in order."""
    coded = pa.concat_arrays([p[0] for p in parts]).dictionary_encode()
    per, ctx, n = (np.concatenate([p[k] for p in parts]) for k in (1, 2, 3))
    owner = np.repeat(coded.indices.to_numpy(), per)
    order = np.lexsort((ctx, owner))
    owner, ctx = owner[order], ctx[order]
    starts = np.nonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (ctx[1:] != ctx[:-1])]))[0]
    return coded.dictionary, np.bincount(owner[starts], minlength=len(coded.dictionary)), ctx[starts], np.add.reduceat(n[order], starts)


def _merged_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (COUNTS) sorted by bucket → the bucket's words, c and the counts of their contexts. What blocks say is put together as it grows."""
    number, parts, size, most = None, [], 0, PLACES

    def out() -> pa.RecordBatch:
        words, per, ctx, n = _together(parts)
        c = np.bincount(np.repeat(np.arange(len(per)), per), n, len(per)).astype(np.int64)
        return pa.record_batch([words, pa.array(np.full(len(words), number)), pa.array(c), _packed(ctx, per), _packed(n, per)], names=["w", "bucket", "c", "ctx", "n"])

    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != number:
                if parts:
                    yield out()
                number, parts, size, most = row["bucket"], [], 0, PLACES
            lengths, per = _loosened(row["sizes"], np.int64).reshape(2, -1)
            parts.append((_packed(_loosened(row["w"], np.uint8), lengths), per, np.frombuffer(row["ctx"], np.uint64), _loosened(row["n"], np.uint32).astype(np.int64)))
            size += len(parts[-1][2])
            if size >= most:
                parts = [_together(parts)]
                size = len(parts[0][2])
                most = max(PLACES, 2 * size)
    if parts:
        yield out()


def _parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bucket's words, with the contexts of one customer apart. Some buckets are a chunk, which asks for its contexts together."""
    part, k, words, size = TaskContext.get().partitionId(), 0, 0, 0
    for batch in _merged_buckets(batches):
        if words >= CHUNK or size >= CHUNK_CELLS:
            k, words, size = k + 1, 0, 0
        ctx, per = _flat(batch["ctx"], np.uint64)
        n, _ = _flat(batch["n"], np.int64)
        of, one, rows = np.repeat(np.arange(len(per)), per), n == 1, len(per)
        ones = np.bincount(of[one], minlength=rows)
        more = np.bincount(of[~one], minlength=rows)
        words, size = words + int((ones + 2 * more > 1).sum()), size + int(more.sum())
        yield pa.record_batch({
            "w": batch["w"], "bucket": batch["bucket"], "chunk": pa.array(np.full(rows, part << 32 | k)), "c": batch["c"],
            "ones": pa.array(ones), "once": _packed(ctx[one], ones), "ctx": _packed(ctx[~one], more), "n": _packed(n[~one], more)})


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, packed contexts) → the different pairs of them."""
    for batch in batches:
        ctx, per = _flat(batch["ctx"], np.uint64)
        pairs = pd.DataFrame({"ctx": ctx.view(np.int64), "chunk": np.repeat(batch["chunk"].to_numpy(), per)}).drop_duplicates()
        yield pa.RecordBatch.from_pandas(pairs, preserve_index=False)


def _by_context(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(packed contexts, customers, tables) → (ctx, a, b) summed over the batch; without customers each cell is one, at one table."""
    for batch in batches:
        ctx, _ = _flat(batch["ctx"], np.uint64)
        a = _flat(batch["n"], np.int64)[0] if "n" in batch.schema.names else np.ones(len(ctx), np.int64)
        b = _flat(batch["t"], np.int64)[0] if "t" in batch.schema.names else np.ones(len(ctx), np.int64)
        ids, at = np.unique(ctx, return_inverse=True)
        sums = [np.bincount(at, x, len(ids)).astype(np.int64) for x in (a, b)]
        yield pa.record_batch({"ctx": pa.array(ids.view(np.int64)), "a": pa.array(sums[0]), "b": pa.array(sums[1])})


def _context_totals(parts: DataFrame) -> DataFrame:
    return parts.groupBy("ctx").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))


def _bits(blocks: DataFrame) -> int:
    """The bits of a bucket's number: with twice as many buckets as blocks a bucket has about the words of half a block."""
    return max(8, (2 * blocks.filter("w is not null").count() - 1).bit_length())


def _learned_parts(blocks: DataFrame, bits: int, samples: int, seed: int) -> tuple[Callable[[tuple[int, int] | None], DataFrame], list[Restaurants], list[DataFrame]]:
    """With every word as a context: rows (PARTS) of what was learned of the words, by turn or all (None), the totals of each sample, and the tables that the rows read.

    Words read once sit one way: only the others have a state.
    """
    sums = "ctx long, a long, b long"
    found = blocks.filter("w is not null and n_train > 0").select("w", "ctxs", "n_train", "places").mapInArrow(partial(_pair_counts, bits=bits), COUNTS)
    cells = written(_sorted(found, "bucket").mapInArrow(_parted, WORD_CELLS), "lm-cells")
    once = written(_context_totals(cells.select(F.col("once").alias("ctx")).mapInArrow(_by_context, sums)), "lm-once")
    first = restaurants(cells, None, False)
    state, last, kept, totals = cells.filter("c > 1").drop("once"), None, [], []
    for k in range(samples):
        every = kept[-1] if kept else first
        now = totals[-1] if totals else state.select("ctx", "n").mapInArrow(_by_context, sums)
        now = _context_totals(now.unionByName(once))
        answers = state.select("chunk", "ctx").mapInArrow(_asked, "ctx long, chunk long").join(now.select("ctx", "b"), "ctx").select("chunk", "ctx", "b")

        state = written(state.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_seating(every, seed + k, not kept), WORD_STATE), "lm-seats")
        if last is not None:
            drop_scratch(last)
        last = state
        totals.append(written(_context_totals(state.select("ctx", "n", "t").mapInArrow(_by_context, sums)), "lm-tables"))  # beside those of ``once``
        now = restaurants(state, None, True, first.lone)
        now.discount, now.parent_discount = first.discount, first.parent_discount
        kept.append(now)

    def parts(turn: tuple[int, int] | None) -> DataFrame:
        here, theirs = F.lit(True), F.lit(True)
        if turn is not None:
            here, theirs = (F.shiftright(k * turn[1], bits) == turn[0] for k in (F.col("bucket"), F.shiftrightunsigned("ctx", 64 - bits)))
        dealt = [cells.filter(here).select("w", "c", F.col("once").alias("ctx")).mapInArrow(partial(_cell_parts, bits=bits), PARTS),
                 state.filter(here).select("w", "ctx", "n", "t_sum", "roots").mapInArrow(partial(_seat_parts, bits=bits), PARTS)]
        dealt += [t.filter(theirs).mapInArrow(partial(_total_parts, bits=bits, sample=k - 1, samples=samples), PARTS) for k, t in enumerate([once, *totals])]
        return reduce(DataFrame.unionByName, dealt)

    return parts, kept, [cells, once, last, *totals]


def learned_words(blocks: DataFrame, samples: int = SAMPLES, seed: int = SEED) -> tuple[DataFrame, list[Restaurants]]:
    """With every word as a context: a row for each learned word, (id, c, vals, ctx, h), and the totals of each sample.

    vals: the word's customers as a context, then by sample its tables as a
    context and its probability in the parent; ctx, h: its contexts and what
    its own seats there add, summed over the samples.
    """
    parts, kept, _ = _learned_parts(blocks, _bits(blocks), samples, seed)
    return _sorted(parts(None), "bucket", "number").mapInArrow(partial(_worded, kept=kept), "id long, c long, vals binary, ctx binary, h binary"), kept


def _seating(every: Restaurants, seed: int, first: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """One chunk's words, and the tables of the contexts they ask for → the words after a round."""

    def seated(rows: pa.Table, tables: pa.Table) -> pa.Table:
        batch = rows.combine_chunks().to_batches()[0]
        ctx, per = _flat(batch["ctx"], np.uint64)
        known, b = tables["ctx"].to_numpy().view(np.uint64), tables["b"].to_numpy()
        order = np.argsort(known)
        theirs = b[order][np.searchsorted(known, ctx, sorter=order)] if len(ctx) else np.zeros(0, np.int64)
        out = next(_sampled(iter([batch.append_column("tables", _packed(theirs, per))]), every, seed, first))
        return pa.Table.from_batches([pa.record_batch([*out.columns, batch["bucket"], batch["chunk"], batch["ones"]], names=[*STATE_COLUMNS, "bucket", "chunk", "ones"])])

    return seated


def _turned(order: np.ndarray, per: np.ndarray) -> np.ndarray:
    """Where the cells of words come from that are put in this order, of which each has so many."""
    begin, per = (np.cumsum(per) - per)[order], per[order]
    return np.arange(int(per.sum())) + np.repeat(begin - (np.cumsum(per) - per), per)


def _runs(of: np.ndarray, words: np.ndarray, per: np.ndarray, cells: np.ndarray) -> list[tuple[int, bytes, bytes]]:
    """For each number in ``of``: its words' rows and their cells' rows, packed; ids alone, which do not get smaller, as they are."""
    order = np.argsort(of, kind="stable")
    of, words, cells, ends = of[order], words[order], cells[_turned(order, per)], np.cumsum(per[order])
    starts = np.nonzero(np.diff(of, prepend=-1))[0].tolist()
    pack = np.ndarray.tobytes if cells.shape[1] == 1 else _squeezed
    return [(int(of[a]), _squeezed(words[a:b].T.ravel()), pack(cells[int(ends[a - 1]) if a else 0:int(ends[b - 1])].T.ravel()))
            for a, b in zip(starts, [*starts[1:], len(of)])]


def _dealt(some: list[tuple], bits: int, number: int) -> pa.RecordBatch:
    """(ids, words' other numbers, cells of each word, cells) → rows (PARTS): id, number of cells and other numbers of the words, and the cells."""
    ids, words, per, cells = (np.concatenate(x) for x in zip(*some))
    words = np.concatenate([ids.view(np.int64)[:, None], per[:, None], words], axis=1)
    rows = _runs((ids >> np.uint64(64 - bits)).astype(np.int64), words, per, cells)
    return _rows([(bucket, number, *packed) for bucket, *packed in rows], PARTS)


def _parts(batches: Iterator[pa.RecordBatch], bits: int, number: int, of: Callable[[pa.RecordBatch], tuple]) -> Iterator[pa.RecordBatch]:
    some, size = [], 0
    for batch in batches:
        if len(batch):
            some.append(of(batch))
            size += len(batch) + some[-1][3].size
            if size >= PACKED:
                yield _dealt(some, bits, number)
                some, size = [], 0
    if some:
        yield _dealt(some, bits, number)


def _cell_parts(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Learned words: how often they come, and their contexts of one customer."""

    def of(batch: pa.RecordBatch) -> tuple:
        ctx, per = _flat(batch["ctx"], np.int64)
        return _ids(batch["w"]), batch["c"].to_numpy()[:, None], per, ctx[:, None]

    return _parts(batches, bits, CELL, of)


def _seat_parts(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Words read more than once: their customers and tables in the parent, and their other contexts with customers and summed tables."""

    def of(batch: pa.RecordBatch) -> tuple:
        ctx, per = _flat(batch["ctx"], np.int64)
        return _ids(batch["w"]), _flat(batch["roots"], np.int64)[0].reshape(len(batch), -1), per, np.stack([ctx, *(_flat(batch[k], np.int64)[0] for k in ("n", "t_sum"))], axis=1)

    return _parts(batches, bits, SEATED, of)


def _total_parts(batches: Iterator[pa.RecordBatch], bits: int, sample: int, samples: int) -> Iterator[pa.RecordBatch]:
    """What a table adds to the contexts' customers and their tables by sample; -1: that of all samples. Customers are the same in each."""

    def of(batch: pa.RecordBatch) -> tuple:
        vals = np.zeros((len(batch), 1 + samples), np.int64)
        if sample < 1:
            vals[:, 0] = batch["a"].to_numpy()
        vals[:, slice(1, None) if sample < 0 else slice(1 + sample, 2 + sample)] = batch["b"].to_numpy()[:, None]
        return batch["ctx"].to_numpy().view(np.uint64), vals, np.zeros(len(batch), np.int64), np.zeros((0, 1), np.int64)

    return _parts(batches, bits, TOTALS, of)


def _wanted(batches: Iterator[pa.RecordBatch], bits: int, turn: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Blocks → rows (PARTS) of those of their words whose buckets have the turn, which is one of so many: their numbers in the block, and the words they come after there."""
    for batch in batches:
        for row in batch.to_pylist():
            words, pairs = _opened(row)
            pairs.sort()
            cells, ids = _different(pairs), _ids(words)
            per = np.bincount(cells >> 32, minlength=len(words))
            here = np.nonzero((ids >> np.uint64(64 - bits)) * np.uint64(turn[1]) >> np.uint64(bits) == turn[0])[0]
            if len(here):
                asked = cells[_turned(here, per)] & 0xFFFFFFFF
                yield _dealt([(ids[here], here[:, None], per[here], ids.view(np.int64)[asked][:, None])], bits, row["block"])


def _read(row: dict, words: int, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """The words' numbers and the cells', by column."""
    own = np.frombuffer(row["cells"], np.int64) if cells == 1 else _loosened(row["cells"], np.int64)
    return _loosened(row["words"], np.int64).reshape(words, -1), own.reshape(cells, -1)


class _Bucket:
    """What is known of the words of a bucket.

    ids; c, customers and tables by sample as a context, customers and tables in the parent by sample; and by cell, with
    ``per`` of them for each word: contexts, customers, summed tables.
    """

    def __init__(self, parts: list[dict], samples: int) -> None:
        found = {kind: [_read(r, *shape) for r in parts if r["number"] == kind]
                 for kind, shape in ((TOTALS, (3 + samples, 1)), (CELL, (3, 1)), (SEATED, (2 + 2 * samples, 3)))}
        self.ids = np.concatenate([np.zeros(0, np.int64), *(w[0] for some in found.values() for w, _ in some)])
        self.ids.sort()
        self.ids = _different(self.ids)
        self.known = np.zeros((len(self.ids), 2 + 3 * samples), np.int64)
        owners, cells = [np.zeros(0, np.int64)], [np.zeros((3, 0), np.int64)]
        for words, _ in found[TOTALS]:
            np.add.at(self.known[:, 1:2 + samples], np.searchsorted(self.ids, words[0]), words[2:].T)
        for words, ctx in found[CELL]:
            at = np.searchsorted(self.ids, words[0])
            np.add.at(self.known[:, 0], at, words[2])
            self.known[at, 2 + samples:] = 1  # a word read once
            owners.append(np.repeat(at, words[1]))
            cells.append(np.stack([ctx[0], np.ones(ctx.shape[1], np.int64), np.full(ctx.shape[1], samples, np.int64)]))
        for words, seats in found[SEATED]:
            at = np.searchsorted(self.ids, words[0])
            self.known[at, 2 + samples:] = words[2:].T
            owners.append(np.repeat(at, words[1]))
            cells.append(seats)
        owner, cells = np.concatenate(owners), np.concatenate(cells, axis=1)
        order = np.argsort(owner, kind="stable")
        self.owner, self.per = owner[order], np.bincount(owner, minlength=len(self.ids))
        self.ctx, self.n, self.t = cells[:, order]
        self.key = None

    def asked(self, ids: np.ndarray, per: np.ndarray, ctx: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What is known of these words and cells; zeros for what was not learned."""
        if self.key is None:
            key = _pair(self.ctx, self.owner)
            self.order = np.argsort(key)
            self.key = key[self.order]
        words, cells = np.zeros((len(ids), self.known.shape[1]), np.int64), np.zeros((len(ctx), 2), np.int64)
        if len(self.ids):
            at = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
            here = self.ids[at] == ids
            words[here] = self.known[at[here]]
            asking = np.nonzero(np.repeat(here, per))[0]
            of = np.repeat(at, per)[asking]
            if len(self.key):
                found = np.minimum(np.searchsorted(self.key, _pair(ctx[asking], of)), len(self.key) - 1)
                found = self.order[found]
                hit = (self.ctx[found] == ctx[asking]) & (self.owner[found] == of)
                cells[asking[hit], 0], cells[asking[hit], 1] = self.n[found[hit]], self.t[found[hit]]
        return words, cells


def _buckets(batches: Iterator[pa.RecordBatch], samples: int) -> Iterator[tuple[_Bucket, dict | None]]:
    """Rows (PARTS) sorted by bucket and number → each bucket with None, then with each row that asks for some of its words."""
    number, parts, bucket = None, [], None
    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != number:
                if bucket is None and number is not None:
                    yield _Bucket(parts, samples), None
                number, parts, bucket = row["bucket"], [], None
            if row["number"] < 0:
                parts.append(row)
                continue
            if bucket is None:
                bucket, parts = _Bucket(parts, samples), []
                yield bucket, None
            yield bucket, row
    if bucket is None and number is not None:
        yield _Bucket(parts, samples), None


def _in_parent(known: np.ndarray, kept: list[Restaurants]) -> np.ndarray:
    """By word and sample the probability in the parent."""
    at = 2 + len(kept)
    return np.stack([r.parent(known[:, at + 2 * k], known[:, at + 2 * k + 1]) for k, r in enumerate(kept)], axis=1)


def _worded(batches: Iterator[pa.RecordBatch], kept: list[Restaurants]) -> Iterator[pa.RecordBatch]:
    samples = len(kept)
    for b, _ in _buckets(batches, samples):
        vals = np.concatenate([b.known[:, 1:2 + samples], _in_parent(b.known, kept)], axis=1)
        yield pa.record_batch({"id": pa.array(b.ids), "c": pa.array(b.known[:, 0]), "vals": _packed(vals.ravel(), np.full(len(b.ids), vals.shape[1])),
                               "ctx": _packed(b.ctx, b.per), "h": _packed(samples * b.n - kept[0].discount * b.t, b.per)})


def _pair(ctx: np.ndarray, of: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ctx.view(np.uint64) ^ (of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _answered(batches: Iterator[pa.RecordBatch], samples: int) -> Iterator[pa.RecordBatch]:
    """Rows (PARTS) sorted by bucket and number → by block some of its words: their numbers and what is known of them, and their cells' customers and summed tables."""
    some, size = [], 0

    def out() -> pa.RecordBatch:
        return _rows(_runs(*(np.concatenate(x) for x in zip(*some))), "block long, words binary, cells binary")

    for bucket, row in _buckets(batches, samples):
        if row is None:
            continue
        words, ctx = _read(row, 3, 1)
        known, cells = bucket.asked(words[0], words[1], ctx[0])
        some.append((np.full(len(known), row["number"]), np.concatenate([words[2][:, None], known], axis=1), words[1], cells))
        size += known.size + cells.size
        if size >= PLACES:
            yield out()
            some, size = [], 0
    if some:
        yield out()


FOUND = "key string, n_tokens long, held boolean, score double, base_score double, n_known long"


def _scored_block(rows: pa.Table, answers: pa.Table, kept: list[Restaurants]) -> pa.Table:
    """A block's words, tokens and documents, and what was learned of its words → its documents with their sums."""
    samples, d = len(kept), kept[0].discount
    n_all, v = kept[0].tokens, kept[0].vocabulary
    heads = rows.filter(pc.is_null(rows["w"])).select(["doc", "key", "n_tokens", "held"]).sort_by("doc")
    words, pairs = _opened(rows.filter(pc.is_valid(rows["w"])).to_pylist()[0])
    cells, of = np.unique(pairs, return_inverse=True)
    per = np.bincount(cells >> 32, minlength=len(words))
    begin = np.cumsum(per) - per
    known, seats = np.zeros((len(words), 2 + 3 * samples), np.int64), np.zeros((len(cells), 2), np.int64)
    for part in answers.to_pylist():
        said = _loosened(part["words"], np.int64).reshape(3 + 3 * samples, -1)
        number, counts = said[0], per[said[0]]
        known[number] = said[1:].T
        at = np.arange(int(counts.sum())) + np.repeat(begin[number] - (np.cumsum(counts) - counts), counts)
        seats[at] = _loosened(part["cells"], np.int64).reshape(2, -1).T
    word, before = cells >> 32, cells & 0xFFFFFFFF
    parents = _in_parent(known, kept)
    p = samples * seats[:, 0] - d * seats[:, 1]
    for k in range(samples):
        p += (STRENGTH + d * known[:, 2 + k])[before] * parents[word, k]
    p /= samples * (STRENGTH + known[:, 1][before])
    c, token, every = known[:, 0], pairs >> 32, len(heads)
    docs = np.repeat(np.arange(every), heads["n_tokens"].to_numpy())
    base = np.log10((c + 0.5) / (n_all + 0.5 * (v + 1)))
    score, base, known = (np.bincount(docs, x, every) for x in (np.log10(p)[of], base[token], (c > 0)[token]))
    return pa.table({"key": heads["key"], "n_tokens": heads["n_tokens"], "held": heads["held"], "score": pa.array(score), "base_score": pa.array(base),
                     "n_known": pa.array(np.rint(known).astype(np.int64))})


def _by_words(blocks: DataFrame, samples: int, seed: int) -> tuple[DataFrame, int]:
    """Every word is a context: documents with their sums, and the number of tokens learned from."""
    bits = _bits(blocks)
    parts, kept, tables = _learned_parts(blocks, bits, samples, seed)
    whole = blocks.filter("w is not null").select("block", "w", "ctxs", "places")
    answers = []
    for turn in ((k, TURNS) for k in range(TURNS)):  # a share of the buckets at a time, so that not all of them lie in shuffle files together
        asks = whole.mapInArrow(partial(_wanted, bits=bits, turn=turn), PARTS)
        asked = _sorted(parts(turn).unionByName(asks), "bucket", "number")
        answers.append(written(asked.mapInArrow(partial(_answered, samples=samples), "block long, words binary, cells binary"), "lm-answers"))
    answers = reduce(DataFrame.unionByName, answers)
    for t in tables:
        drop_scratch(t)

    def scored(rows: pa.Table, answers: pa.Table) -> pa.Table:
        return _scored_block(rows, answers, kept)

    held = blocks.select("block", "w", "ctxs", "places", "doc", "key", "n_tokens", "held")
    return held.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(scored, FOUND), kept[0].tokens


def _by_numbers(blocks: DataFrame, contexts: int, samples: int, seed: int) -> tuple[DataFrame, int]:
    """Contexts are numbered: documents with their sums, and the number of tokens learned from."""
    state, kept = learned(blocks, contexts, samples, seed)
    none = lambda kind: F.lit(None).cast(kind)
    words = state.select("w", (-F.col("c")).alias("number"), "ctx", F.concat("n", "t_sum", "roots").alias("b")).mapInArrow(
        _narrow, "w binary, number long, ctx binary, b binary")
    places = blocks.filter("w is not null").select("w", F.col("block").alias("number"), F.col("ctxs").alias("ctx"), F.col("places").alias("b"))
    sums = _sorted(words.unionByName(places), "w", "number").mapInArrow(partial(_scored, contexts=contexts, kept=kept),
                                                                      "block long, docs binary, score binary, base binary, known binary")
    heads = blocks.filter("w is null").select("block", "doc", "key", "n_tokens", "held", *[none("binary").alias(c) for c in ("docs", "score", "base", "known")])
    both = heads.unionByName(sums.select("block", none("int").alias("doc"), none("string").alias("key"), none("long").alias("n_tokens"), none("boolean").alias("held"),
                                         "docs", "score", "base", "known"))
    return both.repartition("block").sortWithinPartitions("block", F.col("doc").asc_nulls_last()).mapInArrow(_summed, FOUND), kept[0].tokens


def lm_scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", contexts: int | None = CONTEXTS,
              samples: int = SAMPLES, seed: int = SEED) -> DataFrame:
    """One row per document: (id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Tokens are the words of the whole lower-cased (A-Z) text and one end.
    The model learns from every document whose ``held_out`` is not true;
    score is the log10 probability of the tokens under it, averaged over the
    samples, base_score that of the smoothed word shares, n_known counts
    tokens that the learned documents hold. A null or empty text is one end. Rows with
    null or repeated ids are documents of their own. With nothing learned every
    token has probability 1; an empty table gives an empty one; other columns are ignored.
    """
    key = F.coalesce(F.concat(F.lit("="), docs[f"`{id_col}`"].cast("string")), F.lit(""))
    rows = docs.select(key.alias("key"), docs[f"`{text_col}`"].cast("string").alias("text"), F.coalesce(held_out, F.lit(False)).alias("held"))
    blocks = written(rows.mapInArrow(partial(_blocks, contexts=contexts), BLOCKS), "lm-blocks")
    found, train_tokens = _by_words(blocks, samples, seed) if contexts is None else _by_numbers(blocks, contexts, samples, seed)
    kind = docs.schema[id_col].dataType
    return found.select(F.when(F.col("key") != "", F.substr("key", F.lit(2)).cast(kind)).cast(kind).alias(id_col), F.col("held").alias("held_out"),
                        "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"), "base_score", "score")
